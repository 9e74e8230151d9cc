"""Mixing, quality, pages, archives and the pipeline."""

import base64
import hashlib
import random

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sightline.llm import html, mixing, quality, warc
from sightline.session import scratch_path

SF = "/root/testdata/sf0.01"


# -- mixing -----------------------------------------------------------------------------------


def water_fill(sizes, weights=(5, 2, 1), budget=1.5, most=2.0):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full, total = set(), budget * sum(sizes.values())
    while True:
        rest = total - sum(most * sizes[s] for s in full)
        shared = sum(weight[s] for s in sizes if s not in full)
        target = {s: most * sizes[s] if s in full else rest * weight[s] / shared for s in sizes}
        more = {s for s in sizes if s not in full and target[s] >= most * sizes[s]}
        if not more:
            return target
        full |= more


def test_mix(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(["w"] * rng.randint(0, 40)), rng.choice(["a", "b", "B", "é", None, "hot", "hot", "hot"]), 1) for i in range(600)]
    rows += [(1000, None, "a", 1), (1001, "", "empty", 1), (None, "x y", "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, copies int")
    got = mixing.mix_sources(docs, quality=mixing.plain_quality()).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, t, s, _ in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = water_fill(sizes)
    for s in sizes:
        own = [r for r in got if r.source == s]
        assert all(r.source_size == sizes[s] and abs(r.target - want[s]) < 1e-6 for r in own)
        assert abs(sum(r.taken for r in own) - want[s]) <= 20  # half of the largest document
    assert all(r.taken == r.copies * r.size and r.copies <= 2 for r in got)
    again = mixing.mix_sources(docs.repartition(3), quality=mixing.plain_quality()).collect()
    key = lambda r: (str(r.doc_id), r.taken)
    assert sorted(map(key, got)) == sorted(map(key, again))
    assert mixing.mix_sources(docs.limit(0)).collect() == []


def test_better_documents_come_earlier(spark):
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.lit("a b c").alias("text"), F.lit("s").alias("source"),
        F.when(F.col("id") % 2 == 0, 8.0).otherwise(1.0).alias("q"))
    taken = mixing.mix_sources(docs, quality=F.col("q")).groupBy("q").agg(F.avg("copies").alias("c"))
    mean = {r.q: r.c for r in taken.collect()}
    assert mean[8.0] > mean[1.0] + 0.4 and 1 <= mean[1.0] and mean[8.0] <= 2


# -- quality ----------------------------------------------------------------------------------


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = quality.quality_digest(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(held) > 40 and sum(r.predicted == r.quality for r in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)


def test_rules_are_column_expressions(spark):
    rows = [(i, float(i % 10), float(i % 7), float(i % 10 > 4)) for i in range(300)]
    table = spark.createDataFrame(rows, "i int, x double, y double, label double")
    model = quality.fit_rules(table, "label", ["x", "y"])
    assert 0 < len(model.weights) < 20
    scored = table.withColumn("score", model.score({"x": F.col("x"), "y": F.col("y")}))
    assert scored.where("(score >= 0.5) <> (label = 1)").count() == 0


def test_quality_of_odd_tables(spark):
    docs = spark.createDataFrame([(1, None, 9), (2, "", 9), (None, "word " * 9000, 9)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(1, 1), (2, None)], "doc_id long, quality int")
    for given in (labels, labels.limit(0)):
        got = quality.score_quality(docs, quality.train(docs, given)).collect()
        assert len(got) == 3 and all(0 <= r.score <= 1 for r in got)
    assert quality.score_quality(docs.limit(0), quality.train(docs, labels)).collect() == []


# -- pages ------------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T{0}</title><style>p {{x:1}}</style><script>var a = "</p><p>no";</script></head>
<body><header class="site"><h2>Site</h2></header><nav><ul><li><a href="/">Home</a></li></ul></nav>
<div class="cookie-notice">We use cookies {0}</div>{1}<aside>More</aside>
<form>Search <input name=q><button>Go</button></form>
<section id="comments"><p>Nice one {0}</p></section><footer>&copy; Site</footer></body></html>"""


def test_article_pages(spark):
    body = "<article><h1>Head  {0}</h1><p>First &amp; <b>bold</b>\n text {0}<p>Second<br>line &#233;<div class=ad>Buy</div><p>Third</article>"
    rows = [(i, f"http://h.com/{i}", PAGE.format(i, body.format(i))) for i in range(6)]
    rows += [(90, None, None), (91, "no url", ""), (92, "http://alone.org/", "<p>just text"), (None, "http://h.com/x", rows[0][2])]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: (r.text, r.n_chars) for r in html.main_text(table).collect()}
    for i in range(6):
        text = f"Head {i} First & bold text {i} Second line é Third"
        assert got[i] == (text, len(text))
    assert got[90] == got[91] == ("", 0) and got[92] == ("just text", 9) and got[None] == got[0]
    assert html.main_text(table.limit(0)).collect() == []


def test_pages_without_article_element(spark):
    """The container with most of the host's text is the main region."""
    body = '<div id="layout"><div class="menu-left"><a href=1>One</a></div><div class="story"><h1>Title {0}</h1>{1}</div></div>'
    rows = []
    for i in range(8):
        paragraphs = "".join(f"<p>Sentence {i} {k} with some words.</p>" for k in range(1 + i % 4))
        rows.append((i, "http://plain.com/p", PAGE.format(i, body.format(i, paragraphs))))
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    for r in html.main_text(table).collect():
        want = [f"Title {r.page_id}"] + [f"Sentence {r.page_id} {k} with some words." for k in range(1 + r.page_id % 4)]
        assert r.text == " ".join(want)


def extracted(pages):
    whole = html.wrapper_of(html.read_page(pages[0]))
    for page in pages[1:]:
        whole = html.merge(whole, html.wrapper_of(html.read_page(page)))
    return [html.extract(p, html.plan_of(whole)) for p in pages]


def test_text_beside_the_largest_container_is_kept():
    for body in (
        "<div id=wrap><h1>Title {0}</h1><p>Lead {0}</p><div class=story><p>{1}</p></div></div>",
        "<main><h1>Title {0}</h1><p>Lead {0}</p><article><p>{1}</p></article></main>",
        "<article id=a><h1>Title {0}</h1><p>Lead {0}</p></article><article id=b><p>{1}</p></article>",
    ):
        pages = [f"<body><nav>Menu</nav>{body.format(i, f'story {i} ' * 30)}</body>" for i in "xyz"]
        want = [f"Title {i} Lead {i} " + " ".join([f"story {i}"] * 30) for i in "xyz"]
        assert extracted(pages) == want and extracted(pages[:1]) == want[:1]


def test_elements_below_the_depth_close_themselves():
    deep = "<div>" * 200 + "in<nav>menu<p>more</p></nav><form>ask</form>side" + "</div>" * 200
    page = f"<body><div id=wrap><article><p>before</p>{deep}<p>after</p></article></div><footer>end</footer></body>"
    assert extracted([page]) == ["before in side after"]


def test_lists_of_links():
    """An article's own list of links stays; one that is the same on all pages of the host is a menu."""
    links = lambda names: "<ul>" + "".join(f"<li><a href=/>{n}</a></li>" for n in names.split()) + "</ul>"
    pages = [f"<article>{links('Home News About')}<p>text {i}</p>{links(f'one{i} two{i} three{i}')}</article>" for i in "xyz"]
    assert extracted(pages) == [f"text {i} one{i} two{i} three{i}" for i in "xyz"]
    assert extracted(["<article><p>t</p>" + links("a b c") + "</article>"]) == ["t a b c"]


def test_wrappers_are_union_free():
    pages = ["<ul><li>a</li><li>b</li></ul><p>x</p>", "<ul><li>a</li></ul><h2>s</h2><p>y</p>"]
    one, two = (html.wrapper_of(html.read_page(p)) for p in pages)
    items = html.merge(one, two)[3]
    assert [(x[0], x[4], x[5]) for x in items] == [("ul", False, False), ("h2", True, False), ("p", False, False)]
    assert items[0][3][0][5] and items[2][3][0][3] is None  # repeated li, text slot


def test_deep_and_broken_pages():
    deep = "<div>" * 3000 + "inside" + "</div>" * 3000
    assert html.extract(deep, html.plan_of(html.wrapper_of(html.read_page(deep)))) == "inside"
    for broken in ("<", "<a", "<!--", "<p", "a < b", "</p></div>", "<script>x", "<p>1<p>2<li>3<td>4", "&#x110000; &bogus;"):
        assert isinstance(html.extract(broken, []), str)


# -- archives ---------------------------------------------------------------------------------


def brute_records(pages, least=0):
    first = {}
    for i, _, h in pages:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    out = []
    for i, u, h in pages:
        data, f = (h or "").encode(), first.get(h or "")
        again = len(data) >= least and f is not None and (i is None or i > f)
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((i, u, len(data), digest, "revisit" if again else "response", f if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("segment,least", [(1 << 20, 0), (37, 30), (1, 0)])
def test_archives(spark, segment, least):
    """Also with chains of segments, payloads full of record ends, and many splits of a file."""
    rng = random.Random(3)
    bits = ["<p>", "é", "\r\n", "\r\n\r\n", "WARC/1.1", "WARC/1.1\r\n", "\r\n\r\nWARC/1.1\r\n", "x" * 9, "WARC-Type: response\r\n"]
    pages = []
    for i in range(150):
        page = "".join(rng.choice(bits) for _ in range(rng.randint(0, 40)))
        pages.append((i, rng.choice([None, f"http://a.b/{i}"]), rng.choice([page] * 7 + [None] + [p[2] for p in pages[:2]])))
    pages += [(5, "u", pages[5][2]), (None, "n", "only"), (None, "n2", "only"), (None, "x", pages[8][2])]
    table = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        got = warc.warc_round_trip(table, least_bytes=least, segment=segment).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted(map(tuple, got), key=str) == brute_records(pages, least)


def test_archive_of_no_pages(spark):
    table = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.warc_round_trip(table).collect() == []


def test_damaged_archive_is_refused(spark):
    path = scratch_path(spark, "warc")
    warc.write_warc(spark.createDataFrame([(1, "u", "payload")], "page_id long, url string, html string"), path)
    text = spark.read.text(path, wholetext=True).first()[0]
    worse = scratch_path(spark, "warc")
    spark.createDataFrame([(text.replace("payload", "paYload"),)], "value string").write.text(worse)
    with pytest.raises(Exception, match="does not match its digest"):
        warc.read_warc(spark, worse).collect()


# -- pipeline ---------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def stages(spark):
    """Input and result of every stage over the smallest documents."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        path = scratch_path(spark, "stage")
        stage(spark, docs, SF).write.parquet(path)
        out[name] = docs, spark.read.parquet(path)
        docs = out[name][1]
    return out


def rows_of(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_keep_the_columns(stages):
    for name, (before, after) in stages.items():
        assert after.count() <= before.count()
        assert after.columns[:5] == before.columns[:5], name


def test_stage_decisions(spark, stages):
    from tests.llm.test_groups import brute_contamination, brute_groups
    from tests.llm.test_repeats import brute_lines

    before, after = (rows_of(x) for x in stages["lines"])
    sample = [(i, r.text, r.lang) for i, r in before.items()]
    hashes, seen = {}, set()
    for i, text, _ in sorted(sample):
        own = [x for x in text.encode().split(b"\n") if x.strip()]
        hashes[i] = [len(x) >= 20 or x in seen for x in own]  # short lines go if they are exact copies
        seen.update(own)
    for i, r in before.items():
        if i in after:
            lines = after[i].text.encode().split(b"\n")
            assert after[i].n_chars == len(after[i].text) and len(lines) <= len(r.text.split("\n"))
        else:
            assert hashes[i] and all(hashes[i])  # only documents whose lines may all repeat are emptied
    few = sorted(sample)[:60]
    small = spark.createDataFrame(few, "doc_id long, text string, lang string")
    from sightline.llm.lines import dedup_lines

    short = [(i, t[:2000], g) for i, t, g in few]
    small = spark.createDataFrame(short, "doc_id long, text string, lang string")
    got = sorted(((r.doc_id, r.text, r.lang, r.n_lines, r.n_removed) for r in dedup_lines(small).collect()), key=str)
    assert got == brute_lines(short)

    before, after = (rows_of(x) for x in stages["near-duplicates"])
    groups = brute_groups([(i, r.text) for i, r in before.items()], 80)
    assert set(after) == {i for i, g in groups.items() if g[2]}

    before, after = (rows_of(x) for x in stages["decontamination"])
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    hit = brute_contamination([(i, r.text) for i, r in before.items()], bench)
    assert set(after) == {i for i, h in hit.items() if not h[4]}


def test_run(spark, stages):
    assert corpus_pipeline.run(spark, SF).count() == stages["mix"][1].count()


# -- queries ----------------------------------------------------------------------------------


def test_queries_against_sql(spark):
    import oracle

    from sightline.llm.queries import ORACLES, QUERIES

    con = oracle.connect("/root/testdata/sf0.001")
    assert isinstance(con, duckdb.DuckDBPyConnection)
    for name, sql in ORACLES.items():
        assert oracle.compare(spark, con, name, QUERIES[name], sql, "/root/testdata/sf0.001") is None, name
