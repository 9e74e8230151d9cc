"""Goldens of feeds, joins, clean-up, ingest and text."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sightline.operators import aggregates as ag
from sightline.operators import clean, feeds, joins
from sightline.operators import text as tx
from sightline.operators.ordering import add_row_number, exact_quantiles
from sightline.sources import ingest


def test_report_groups_golden(spark):
    gid = "6755399444000513"
    df = spark.createDataFrame(
        [("1.1.1.1", gid), ("2.2.2.2", gid), ("a.com", None), ("b.com", " nan ")], "search_term string, group_id string"
    )
    got = feeds.report_groups(df).collect()
    assert {r.report: r.indicators for r in got} == {
        f"Group_{gid}": ["1.1.1.1", "2.2.2.2"], "a.com": ["a.com"], "b.com": ["b.com"],
    }


@pytest.mark.parametrize("text, want", [("85%", 85.0), ("85.2%", 85.2), ("", None), ("x", None)])
def test_parse_percent(spark, text, want):
    assert clean.parse_percent(spark.createDataFrame([(text,)], "v string"), "v").first().v == want


@pytest.mark.parametrize("url, want", [
    ("HTTP://A.com:80/x/?q=1#f", "http://a.com/x?q=1"), ("https://u:p@B.org:443", "https://b.org/"),
    ("http://b.org:8080/a;p=1", "http://b.org:8080/a"), ("http://b.org/a//", "http://b.org/a"),
])
def test_normalize_url(spark, url, want):
    df = spark.createDataFrame([(url,)], "url string")
    assert tx.normalize_url(df, "url").first().url_normalized == want


def test_upsert_golden(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, v int")
    new = spark.createDataFrame([("b", 2), ("c", 4), ("d", 5)], "k string, v int")
    out = ingest.upsert_table(old, new, "k")
    assert {r.k: (r.v, r.change) for r in out.collect()} == {
        "a": (1, "preserved"), "b": (2, "unchanged"), "c": (4, "updated"), "d": (5, "added"),
    }
    again = ingest.upsert_table(out.drop("change"), new, "k")
    assert {r.k: r.v for r in again.collect()} == {r.k: r.v for r in out.collect()}


def test_skip_known_articles_follows_the_sequence(spark):
    stored = spark.createDataFrame([("old", "u0")], "title string, url string")
    rows = [
        (1, "t1", "u1"), (2, "t2", "u1"), (3, "t2", "u3"), (4, "old", "u4"), (5, "t5", "u0"), (6, "", "u6"),
        (7, "t3", "u3"), (8, "t3", "u8"),
    ]
    new = spark.createDataFrame(rows, "ingest_order long, title string, url string")
    titles, urls, want = {"old"}, {"u0"}, []
    for n, t, u in rows:  # brute force
        if t in titles or u in urls or not (t and u):
            continue
        titles.add(t)
        urls.add(u)
        want.append(n)
    got = ingest.skip_known_articles(stored, new).orderBy("text_id").collect()
    assert [r.ingest_order for r in got] == want and [r.text_id for r in got] == list(range(1, len(want) + 1))


def test_group_documents_keeps_everything_in_parts(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 900, "hot").otherwise("cold").alias("k"), F.col("id").alias("v"))
    out = ingest.group_documents(df, df, "k", parts=8).collect()
    assert sum(len(r.records) for r in out) == 1000
    assert len([r for r in out if r.k == "hot"]) == 8 and len({(r.k, r.part) for r in out}) == len(out)


def test_scan_daily_files_skips_missing(spark, tmp_path):
    header = "indicator,API_UserName,obs_date,OpDiv,indicator_key,observations,curr_date\n"
    for day in ("20240101", "20240103"):
        iso = f"{day[:4]}-{day[4:6]}-{day[6:]}"
        row = f"1.2.3.4 : Ref,00818860012482918321,{iso}, VA ,k,7,{iso}\n"
        (tmp_path / f"part_obs_d{day}.csv").write_text(header + row)
    rows = ingest.clean_observations(ingest.scan_daily_files(spark, str(tmp_path), "2024-01-01", "2024-01-05"))
    got = rows.orderBy("obs_date").collect()
    assert [(r.indicator, r.API_UserName, r.OpDiv) for r in got] == [("1.2.3.4", "00818860012482918321", "VA")] * 2
    assert ingest.scan_daily_files(spark, str(tmp_path), "2023-01-01", "2023-01-02").count() == 0


def test_scan_report_tree(spark, tmp_path):
    for partner, name in (("VA", "rep_20240101.csv"), ("Logs", "rep_20240101.csv"), ("O S", "x20240102.csv"), ("VA", "notes.csv")):
        (tmp_path / partner).mkdir(exist_ok=True)
        (tmp_path / partner / name).write_text("Indicator,Observed Today\na,1\n")
    got = ingest.scan_report_tree(spark, str(tmp_path), exclude=("Logs",)).collect()
    assert sorted((r.Partner, str(r.FileDate)) for r in got) == [("O S", "2024-01-02"), ("VA", "2024-01-01")]
    assert ingest.scan_report_tree(spark, str(tmp_path), day="2024-01-02").count() == 1


def test_scan_report_tree_takes_paths_apart_once_a_file(spark, tmp_path):
    (tmp_path / "VA").mkdir()
    (tmp_path / "VA" / "rep_20240101.csv").write_text("Indicator,Observed Today\na,1\nb,0\n")
    out = ingest.scan_report_tree(spark, str(tmp_path))
    assert "regexp" not in out._jdf.queryExecution().optimizedPlan().toString()  # no pattern in the plan over the rows
    assert [(r.Partner, str(r.FileDate)) for r in out.collect()] == [("VA", "2024-01-01")] * 2


def test_read_json_array(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id": 1, "o": {"x": "p"}},\n {"id": 2, "o": {"x": "q"}}]')
    df = ingest.read_json_records(spark, str(tmp_path), "id long, o struct<x: string>", multi_line=True)
    assert ingest.flatten_record(df).columns == ["id", "o.x"] and df.count() == 2


def test_validate_columns(spark):
    with pytest.raises(ValueError, match="b, c"):
        ingest.validate_columns(spark.range(1).withColumnRenamed("id", "a"), ("a", "b", "c"))


def test_keep_and_drop_partition_the_input(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("indicator"))
    listed = spark.range(50, 150).select(F.col("id").cast("string").alias("indicator"))
    kept, rest = joins.keep_listed(df, listed), joins.drop_reported(df, listed)
    assert kept.count() == 50 and rest.count() == 50 and kept.union(rest).distinct().count() == 100


def test_keyphrase_join_brute_force(spark):
    texts = ["The Quick brown fox.", "a.b (c) éÀ end", "aaaa", "", "quick-brown", "x" * 40, "brown FOX. jumps over the dog"]
    phrases = ["quick brown fox", "QUICK", "aa", "éà", "(c)", "fox. jumps over", "x" * 13, "nothing", "own f"]
    t = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    p = spark.createDataFrame(list(enumerate(phrases)), "pid int, phrase string")
    got = sorted((r.id, r.pid) for r in joins.keyphrase_join(t, p, key="id").collect())
    want = sorted((i, j) for i, a in enumerate(texts) for j, b in enumerate(phrases) if b.lower() in a.lower())
    assert got == want


def test_exact_quantiles_and_positions(spark):
    import numpy as np

    values = [float(v * v % 37) for v in range(500)]
    df = spark.createDataFrame([(i, "g" if i % 3 else "h", v) for i, v in enumerate(values)], "id int, g string, v double")
    for g in ("g", "h"):
        mine = [v for i, v in enumerate(values) if ("g" if i % 3 else "h") == g]
        row = exact_quantiles(df, "v", (0, 0.1, 0.5, 0.99, 1), ("g",)).where(F.col("g") == g).first()
        assert [row[f"q{i}"] for i in range(5)] == pytest.approx(list(np.quantile(mine, (0, 0.1, 0.5, 0.99, 1))))
    got = [r.n for r in add_row_number(df, [F.col("v").desc(), F.col("id")], "n").orderBy(F.col("v").desc(), "id").collect()]
    assert got == list(range(1, 501))


def test_iocs(spark):
    text = (
        "See 1.2.3.4, 256.1.1.1 and evil.example.com; mail a.b@c.org, http://x.y/z?q=(1) "
        + "d41d8cd98f00b204e9800998ecf8427e " + "a" * 40 + " " + "b" * 64 + " again 1.2.3.4"
    )
    iocs = tx.extract_iocs(spark.createDataFrame([(text,)], "t string"), "t").first().iocs
    assert iocs.ips == ["1.2.3.4"]
    assert iocs.domains == ["evil.example.com", "c.org"]
    assert iocs.emails == ["a.b@c.org"] and iocs.urls == ["http://x.y/z?q=(1"]
    assert iocs.hashes.md5 == ["d41d8cd98f00b204e9800998ecf8427e"]
    assert iocs.hashes.sha1 == ["a" * 40] and iocs.hashes.sha256 == ["b" * 64]


def test_refang(spark):
    df = spark.createDataFrame([("1[.]2[.]3[.]4",), ("a.b",)], "v string")
    assert [(r.v, r.is_bracketed) for r in tx.refang(df, "v").collect()] == [("1.2.3.4", True), ("a.b", False)]


PAGE = """<html><head><title> A &amp; B </title><meta content="Desc &#39;q&#39;" name="description">
<meta property='og:title' content='OG'><meta property="og:site_name" content="Site">
<script type="application/ld+json">[{"@type": ["Thing", "NewsArticle"], "datePublished": "2024-05-01"}]</script>
</head><body><div class="nav">menu</div><div class="x article-body y"><div>one</div><p>two &#x41;</p></div>tail
<!-- hidden --><style>p{}</style></body></html>"""


def test_page_metadata_and_text(spark):
    df = spark.createDataFrame([("https://h.org/p", PAGE)], "url string, html string")
    row = tx.page_metadata(df).first()
    assert (row.domain, row.title_tag, row.meta_description) == ("h.org", "A & B", "Desc 'q'")
    assert (row.og_title, row.og_site_name, row.og_description, row.published_time) == ("OG", "Site", None, "2024-05-01")
    assert row.excerpt == "A & B menu one two A tail"
    assert tx.page_text(df).first().text == "one two A"


def test_json_ld_object_and_graph(spark):
    pages = [
        '<script type="application/ld+json">{"@graph": [{"@type": "Article"}], "datePublished": "d1"}</script>',
        '<script type="application/ld+json">{"@type": "Person", "datePublished": "d2"}</script>',
        '<script type="application/ld+json">not json</script>',
    ]
    df = spark.createDataFrame([("u", p) for p in pages], "url string, html string")
    assert [r.published_time for r in tx.page_metadata(df).collect()] == ["d1", None, None]


def test_similar_items_equal_brute_force(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    a, b = rng.normal(size=(60, 8)), rng.normal(size=(45, 8))
    texts = spark.createDataFrame([(i, "traffic w1" if i % 2 else "quiet", v.tolist()) for i, v in enumerate(a)], "id long, text string, vector array<double>")
    items = spark.createDataFrame(
        [(f"T{j:02d}", [f"w{j % 3}"], ["command-and-control"] if j % 2 else [], v.tolist()) for j, v in enumerate(b)],
        "item_id string, keywords array<string>, tactics array<string>, vector array<double>",
    )
    got = tx.similar_items(texts, items, 0.3, 0.1, 3, text_rows=7, block_rows=10).collect()
    want = []
    for i in range(60):
        text, scored = ("traffic w1" if i % 2 else "quiet"), []
        for j in range(45):
            sim = a[i] @ b[j] / np.linalg.norm(a[i]) / np.linalg.norm(b[j])
            hit = f"w{j % 3}" in text
            sim += 0.1 * hit
            final = round(sim + 0.1 * hit + 0.05 * (j % 2 == 1 and "traffic" in text), 2)
            if sim >= 0.3:
                scored.append((-final, -round(sim, 3), f"T{j:02d}"))
        want += [(i, t) for _, _, t in sorted(scored)[:3]]
    assert sorted((r.id, r.item_id) for r in got) == sorted(want)


def test_triage_cases(spark):
    cols = "indicator_type string, isp string, org string, asn_name string, country string, proxy boolean, hosting boolean"
    rows = [
        ("Address", "M247", "x", "", "France", False, True, "malicious_infrastructure", "elevate_score"),
        ("Address", "Amazon", "x", "", "China", True, True, "cloud_hosted", "reduce_score"),
        ("Address", "Net", "x", "", "Iran", False, True, "hosted_infrastructure", "analyst_review"),
        ("Address", "Net", "x", "", "North Korea", False, False, "unknown", "analyst_review"),
        ("Address", None, None, None, None, None, None, "insufficient_data", "no_change"),
        ("Host", "M247", "x", "", "France", True, True, "non_ip", "manual_review"),
    ]
    df = spark.createDataFrame([r[:7] for r in rows], cols)
    got = [(r.behavior, r.recommendation) for r in feeds.triage_infrastructure(df).collect()]
    assert got == [r[7:] for r in rows]


def test_ordered_lookup_and_union(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "indicator string, v int")
    keys = spark.createDataFrame([("c", 1), ("a", 2), ("b", None)], "indicator string, position int")
    assert [r.indicator for r in feeds.ordered_lookup(df, keys).collect()] == ["c", "a", "b"]
    both = feeds.union_feeds(df, keys)
    assert both.columns == ["indicator", "v", "position"] and both.count() == 6


def test_append_history_keeps_last_of_day(spark):
    t = lambda h: datetime(2024, 1, 1, h)
    old = spark.createDataFrame([("a", t(1), 1), ("a", datetime(2023, 12, 31, 5), 0)], "k string, ts timestamp, v int")
    new = spark.createDataFrame([("a", t(1), 2), ("b", t(3), 3)], "k string, ts timestamp, v int")
    assert [(r.k, r.v) for r in ingest.append_history(old, new, "k", "ts").collect()] == [("a", 2), ("a", 0), ("b", 3)]


def test_keywords_tie_by_first_appearance(spark):
    df = spark.createDataFrame([(1, "beta alpha beta gamma Alpha delta abc"), (2, ""), (3, None)], "doc_id int, t string")
    got = {r.doc_id: r.keywords for r in tx.extract_keywords(df, "t", 3).collect()}
    assert got == {1: ["beta", "alpha", "gamma"], 2: [], 3: []}


def test_tfidf_prefers_rare_terms(spark):
    df = spark.createDataFrame([(1, "common rare rare"), (2, "common owl"), (3, "common the")], "doc_id int, t string")
    got = {r.doc_id: r.keywords for r in tx.tfidf_keywords(df, "t", 1).collect()}
    assert got == {1: ["rare"], 2: ["owl"], 3: ["common"]}


def test_rollup_rounds_the_value_of_the_double(spark):
    # means of 31.125, 0.375 and 1.005 (a little less as a double), and a key without any percent
    texts = {"a": ["31%", "31.25%"], "b": ["0.25%", "0.5%"], "c": ["1.005%"], "d": ["unknown"]}
    rows = [(k, float(t.rstrip("%")) if t != "unknown" else None, t, "x", "2024-01-01") for k, v in texts.items() for t in v]
    df = spark.createDataFrame(rows, "Indicator string, n double, p string, c string, FileDate string")
    got = {r[0]: (r[1], r[2]) for r in ag.daily_report_rollup(df, ("n",), ("p",), ("c",)).collect()}
    assert got == {"a": (31.13, "31.12%"), "b": (0.38, "0.38%"), "c": (1.0, "1.00%"), "d": (None, "unknown")}


def test_flag_long_enough_follows_its_sql_on_short_portal_pages(spark, tmp_path):
    from oracle import compare, connect

    from sightline.catalog import ORACLES, QUERIES

    bodies = ["see a.example", "see Größe.kaici", "ends in x.Daß", "host 10.1.2.3 only", "a" * 40, "b" * 32, "plain", "w " * 100]
    pages = [
        (10 * h + n, f"http://{host}/x", f"<html><article><p>{body}</p></article></html>")
        for h, host in enumerate(("www.spam-farm.example.org", "misp.example.org")) for n, body in enumerate(bodies)
    ]
    spark.createDataFrame(pages, "page_id long, url string, html string").toPandas().to_parquet(tmp_path / "pages.parquet")
    con = connect("/root/testdata/sf0.001")
    con.execute(f"CREATE OR REPLACE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet')")
    name = "flag_long_enough"
    assert compare(spark, con, name, QUERIES[name], ORACLES[name], str(tmp_path)) is None


def test_keywords_exchange_no_terms(spark):
    df = spark.createDataFrame([(1, "alpha beta alpha"), (2, None), (3, "no")], "doc_id long, t string")
    out = tx.extract_keywords(df, "t", 3)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    assert {r.doc_id: r.keywords for r in out.collect()} == {1: ["alpha", "beta"], 2: [], 3: []}


def test_keywords_of_texts_that_share_a_key(spark):
    df = spark.createDataFrame([(1, "beta alpha"), (1, "alpha"), (2, "gamma")], "doc_id long, t string")
    assert {r.doc_id: r.keywords for r in tx.extract_keywords(df, "t", 3).collect()} == {1: ["alpha", "beta"], 2: ["gamma"]}


def test_tfidf_joins_rare_terms_apart(spark, monkeypatch):
    texts = [" ".join(f"w{(d * k) % 23}" for k in range(d + 1)) for d in range(40)] + [None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, t string")
    whole = {r.doc_id: r.keywords for r in tx.tfidf_keywords(df, "t", 4).collect()}
    monkeypatch.setattr(tx, "COMMON_TERMS", 3)
    assert {r.doc_id: r.keywords for r in tx.tfidf_keywords(df, "t", 4).collect()} == whole
    assert whole[40] == whole[41] == [] and len(whole) == 42
