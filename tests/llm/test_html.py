"""Wrappers of hosts: what they drop, their bounds, and their independence of order and batches."""

import json
import random
import re
import time

import pytest

from sightline.llm import html

SF = "/root/testdata/sf0.01"


def whole_of(pages):
    whole = html.wrapper_of(html.read_page(pages[0]))
    for page in pages[1:]:
        whole = html.merge(whole, html.wrapper_of(html.read_page(page)))
    return whole


def extracted(pages):
    plan = html.plan_of(whole_of(pages))
    return [html.extract(p, plan) for p in pages]


def story(i, n=40):
    return " ".join(f"w{i}x{k}" for k in range(n))


def test_names_decide_nothing_inside_an_article():
    pages = [
        f"<article><h1>Head {i}</h1><section id='search-results-explained'><p>Deep {story(i)}</p></section>"
        f"<div class='notice-board'><p>Board {i}</p></div></article>" for i in range(4)]
    assert extracted(pages) == [f"Head {i} Deep {story(i)} Board {i}" for i in range(4)]
    assert extracted(pages[:1]) == [f"Head 0 Deep {story(0)} Board 0"]


def test_named_parts_go_where_the_wrapper_agrees():
    ends = ["<div class='promo-box'>Join us today</div>", "", "<div class='promo-box'>Join us today</div>", ""]
    links = [f"<div class='share-bar'><a href=1>Mail {i}</a> <a href=2>Print {i}</a></div>" for i in range(4)]
    plain = ["<div class='related'>Not a link {i}</div>".format(i=i) for i in range(4)]
    pages = [f"<main><p>{story(i)}</p>{links[i]}{plain[i]}{ends[i]}</main>" for i in range(4)]
    assert extracted(pages) == [f"{story(i)} Not a link {i}" for i in range(4)]


def test_constant_elements_go_and_copies_stay():
    x9 = "<div class=x9>All rights reserved, see the weekly letter</div>"
    pages = [f"<article><p>{story(i)}</p>{x9}<p>same closing words</p></article>" for i in range(3)]
    assert extracted(pages) == [f"{story(i)} same closing words" for i in range(3)]
    whole = f"{story(0)} All rights reserved, see the weekly letter same closing words"
    assert extracted(pages[:1] * 5) == [whole] * 5  # copies of one page are no evidence
    near = [p.replace("w0x3 ", f"w{i} ") for i, p in enumerate([pages[0].replace("<p>w0", "<p class=y>w0")] * 4)]
    kept = extracted([p.replace(x9, f"<div class=z>{story('z', 60)}</div>") for p in near])
    assert all(story("z", 60) in text for text in kept)  # pages that are mostly alike are copies


def test_adverts_and_comments_of_an_article_go():
    pages = [
        f"<article><p>{story(i)}</p><div class='ad wide'>Buy {i}</div><section id=comments><p>Nice {i}</p></section></article>"
        for i in range(3)]
    assert extracted(pages) == [story(i) for i in range(3)]


def test_labels_without_end_are_one():
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(8))
    pages = [
        f"<body><nav>Menu</nav><section class='top'>Site</section><div class='post-{word()}'><h1>T {i}</h1><p>{story(i, 12)}</p></div></body>"
        for i in range(2_000)]
    start = time.perf_counter()
    whole = whole_of(pages)
    plan = html.plan_of(whole)
    assert time.perf_counter() - start < 10 and len(json.dumps(whole)) < 5_000
    assert plan[0] == [["body", "div.*"]]
    assert [html.extract(p, plan) for p in pages[:5]] == [f"T {i} {story(i, 12)}" for i in range(5)]
    few = [p.replace("section", "div") for p in pages[:6]]  # among few pages, labels that do not repeat are one
    assert html.plan_of(whole_of(few))[1] == {"body>div.*": ["div.top"]}
    assert extracted(few) == [f"T {i} {story(i, 12)}" for i in range(6)]


@pytest.mark.parametrize("page", [
    "<article>" + "<hr>".join(f"t {k}" for k in range(20_000)) + "</article>",
    "<body>" + "<div>x" * 8_000 + "</p></span></li>" * 8_000 + "</body>", "<ul>" + "<x>y<li>z" * 8_000, "<p>" + "word " * 300_000,
])
def test_long_pages_take_no_square_time(page):
    start = time.perf_counter()
    assert extracted([page, page.replace("t", "u", 1)])[0]
    assert time.perf_counter() - start < 20


def test_order_and_batches_do_not_matter(spark):
    rng = random.Random(4)
    pages = []
    for i in range(120):
        parts = [f"<p>{story(i, rng.randint(1, 9))}</p>" for _ in range(rng.randint(1, 5))]
        parts += [f"<div class='c{rng.randint(0, 60)}'>block {rng.randint(0, 3)}</div>" for _ in range(rng.randint(0, 4))]
        parts += ["<div class='fix'>constant note</div>"] if rng.random() < 0.9 else []
        rng.shuffle(parts)
        pages.append("<body><div class=m>" + "".join(parts) + "</div><div class='side-menu'><a href=1>x</a></div></body>")
    one = whole_of(pages)
    other = pages[:]
    rng.shuffle(other)
    halves = html.merge(whole_of(other[70:]), html.merge(whole_of(other[:30]), whole_of(other[30:70])))
    assert one == halves
    rows = [(i, f"http://h{i % 3}.net/{i}", p) for i, p in enumerate(pages)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    results = []
    try:
        for size, parts in (("10000", 1), ("3", 7)):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
            results.append(sorted(map(tuple, html.main_text(table.repartition(parts)).collect())))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert results[0] == results[1]


def test_main_text_against_plain_python(spark):
    """Every page of the table, host by host in one process."""
    table = spark.read.parquet(f"{SF}/pages.parquet")
    hosts: dict[str, list] = {}
    for r in table.collect():
        hosts.setdefault(re.sub(r"^[a-z]+://([^/]*).*", r"\1", (r.url or "").lower()), []).append((r.page_id, r.html or ""))
    want = {}
    for pages in hosts.values():
        for (i, _), text in zip(pages, extracted([p for _, p in pages])):
            want[i] = text
    assert {r.page_id: r.text for r in html.main_text(table).collect()} == want


def test_article_of_the_pages_table_in_whole(spark):
    """What lies in the article element of each page, read by patterns alone."""
    import html as entities

    got = {r.page_id: r.text for r in html.main_text(spark.read.parquet(f"{SF}/pages.parquet")).collect()}
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        inside = re.search(r"<article>(.*?)</article>", r.html, re.S)
        if inside:
            bare = re.sub(r"<!--.*?-->|</?(?:b|i|em|strong|a|span)\b[^>]*>", "", inside[1], flags=re.S)
            assert got[r.page_id] == " ".join(entities.unescape(re.sub(r"<[^>]*>", " ", bare)).split())
