"""Run-length panels, phrase automata, the cell index, bucketed tables and density clusters."""

import random
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from sightline.operators import runs as rl
from sightline.operators import text as tx
from sightline.operators import timeseries as ts
from sightline.operators.density import density_clusters
from sightline.operators.feeds import categorize_tags
from sightline.operators.joins import keyphrase_join
from sightline.operators.phrases import phrase_matches
from sightline.sources import buckets
from sightline.sources.ingest import append_history, upsert_table

AS_OF = "2024-03-01"
OBS = "OpDiv string, indicator string, obs_date date, observations long"


@pytest.fixture(scope="module")
def obs(spark):
    """Series of every density, repeated days, a zero day, a day after the panel's end."""
    rng, rows = random.Random(3), []
    start = date(2024, 1, 1)
    for p, shift in (("P", 0), ("Q", 5)):
        for k in range(24):
            days = rng.sample(range(shift, 61), rng.choice([1, 2, 3, 8, 20, 45, 56]))
            rows += [(p, f"i{k}", start + timedelta(d), rng.randint(1, 50)) for d in days for _ in range(rng.choice([1, 1, 2]))]
        run = range(shift, shift + 30)
        rows += [(p, "long run", start + timedelta(d), 1) for d in run]
        rows += [(p, "zeros", start + timedelta(d), 0 if d % 2 else 4) for d in range(shift, 40)]
        rows.append((p, "i1", date(2024, 3, 1), 7))
    return spark.createDataFrame(rows, OBS)


def table_of(df, cols):
    shown = [F.round(c, 9).alias(c) if t == "double" else F.col(c).cast("string").alias(c) for c, t in df.select(*cols).dtypes]
    return sorted((tuple(r) for r in df.select(*shown).collect()), key=str)


@pytest.mark.parametrize("name, columns", [
    ("cumulative_seen", ["cumulative_seen"]), ("days_since_last_seen", ["days_since_last_seen"]), ("seen_streak", ["seen_streak"]),
    ("trend_ratios", ["seen_ratio_diff", "obs_ratio_spike", "seen_streak_prev", "volatility_ratio", "recent_drop_flag"]),
])
def test_daily_features_of_runs_equal_the_dense_panel(obs, name, columns):
    cols = ["OpDiv", "indicator", "date", *columns]
    dense = getattr(ts, name)(ts.dense_panel(obs, AS_OF))
    sparse = getattr(rl, name)(rl.run_length_panel(obs, AS_OF, first_day=True))
    got, want = table_of(sparse, cols), table_of(dense, cols)
    assert len(got) == len(want) and all(
        a[:3] == b[:3] and [float(x or 0) for x in a[3:]] == pytest.approx([float(x or 0) for x in b[3:]], abs=1e-8)
        and [x is None for x in a] == [x is None for x in b] for a, b in zip(got, want))


@pytest.mark.parametrize("min_seen", [1, 2])
def test_series_features_of_runs_equal_the_dense_panel(obs, min_seen):
    panel, sparse = ts.dense_panel(obs, AS_OF, min_seen), rl.run_length_panel(obs, AS_OF, min_seen, first_day=True)
    for dense, runs in (
        (ts.recurrence_features(panel), rl.recurrence_features(sparse, AS_OF)),
        (ts.streak_summary(panel), rl.streak_summary(sparse, AS_OF)),
        (ts.days_since_last_seen(panel, True).select("OpDiv", "indicator", "date", "days_since_last_seen"), rl.days_since_last_seen(sparse, True)),
    ):
        cols = dense.columns
        got, want = table_of(runs, cols), table_of(dense, cols)
        assert len(got) == len(want)
        for a, b in zip(got, want):
            assert [str(x) for x in a[:2]] == [str(x) for x in b[:2]]
            for x, y in zip(a[2:], b[2:]):
                assert x == y or float(x) == pytest.approx(float(y), abs=1e-8)


def test_runs_plan_has_a_row_per_sighting_day(obs):
    text = rl.recurrence_features(rl.run_length_panel(obs, AS_OF), AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in text
    with pytest.raises(ValueError):
        rl.run_length_panel(obs, AS_OF, min_seen=0)


# ----------------------------------------------------------------------------------- phrases

TEXTS = ["The Quick brown fox.", "a.b (c) éÀ end", "aaaa", "", None, "quick-brown", "x" * 40, "brown FOX. jumps over the dog", "Straße 😀 x"]
PHRASES = ["quick brown fox", "QUICK", "aa", "éà", "(c)", "fox. jumps over", "x" * 13, "nothing", "own f", "", None, "aa", "😀 X"]


@pytest.mark.parametrize("share_chars", [1_000, 20])
def test_phrases_in_one_or_more_shares(spark, share_chars):
    t = spark.createDataFrame(list(enumerate(TEXTS)) + [(2, TEXTS[2])], "doc_id int, text string")
    p = spark.createDataFrame(list(enumerate(PHRASES)), "pid int, phrase string")
    out = keyphrase_join(t, p, share_chars=share_chars)
    assert set(out.columns) == {"doc_id", "text", "pid", "phrase"}
    want = [(i, j) for i, a in [*enumerate(TEXTS), (2, TEXTS[2])] for j, b in enumerate(PHRASES) if a and b and b.lower() in a.lower()]
    assert sorted((r.doc_id, r.pid) for r in out.collect()) == sorted(want)
    assert keyphrase_join(t, p.limit(0), share_chars=share_chars).collect() == []


def test_phrase_plan_makes_no_rows_of_characters(spark):
    t = spark.createDataFrame([(1, "a b")], "doc_id int, text string")
    p = spark.createDataFrame([(1, "b")], "pid int, phrase string")
    text = keyphrase_join(t, p)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in text and "MapInArrow" in text
    with pytest.raises(ValueError):
        phrase_matches(t, spark.createDataFrame([("abcdef",)], "_phrase string"), F.col("text"), 3)


def test_categories_by_the_first_rule(spark):
    rules = [("one", ["exact"], ["abc"]), ("two", ["abcd"], ["b", "x y"]), ("three", [], ["zz"])]
    tags = ["EXACT ", "xabcx", "abcd", "b", "X Y", "zzb", "azz", "other", "", None]
    rows = categorize_tags(spark.createDataFrame([(t,) for t in tags], "tag string"), rules, members=[("listed", ["azz"])]).collect()
    assert {r.tag: r.category for r in rows} == {
        "EXACT": "one", "xabcx": "one", "abcd": "one", "b": "two", "X Y": "two", "zzb": "two", "azz": "listed", "other": "other"}
    everything = categorize_tags(spark.createDataFrame([("q",)], "tag string"), [("a", [], ["z"]), ("b", [], [""])]).first()
    assert everything.category == "b"


# -------------------------------------------------------------------------------- similarity


def _vectors(spark, n, m, dims=16, families=12):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(families, dims))
    draw = lambda k: centres[rng.integers(0, families, k)] + 0.25 * rng.normal(size=(k, dims))
    a, b = draw(n), draw(m)
    words = ["alpha", "Beta", "gamma", "delta"]
    texts = [(i, f"about {words[i % 4]} traffic" if i % 3 else None, v.tolist()) for i, v in enumerate(a)]
    items = [(f"T{j:04d}", [words[j % 4], words[(j * 3) % 4]], ["command-and-control"] * (j % 3), v.tolist()) for j, v in enumerate(b)]
    return a, b, texts, items


def _brute(a, b, texts, items, threshold, boost, k):
    sims = a @ b.T / np.outer(np.linalg.norm(a, axis=1), np.linalg.norm(b, axis=1))
    out = []
    for i, (key, text, _) in enumerate(texts):
        low, scored = (text or "").lower(), []
        for j, (name, words, tactics, _) in enumerate(items):
            sim = sims[i, j] + boost * any(w.lower() in low for w in words)
            final = round(sim + boost * sum(w in low for w in words) + 0.05 * len(tactics) * ("traffic" in low), 2)
            if sim >= threshold:
                scored.append((-final, -round(sim, 3), name))
        out += [(key, name) for _, _, name in sorted(scored)[:k]]
    return sorted(out)


def test_cells_miss_nothing_and_few_probes_miss_little(spark):
    a, b, texts, items = _vectors(spark, 150, 400)
    t = spark.createDataFrame(texts + [(900, "alpha", None), (901, "alpha", [0.0] * 16)], "id long, text string, vector array<double>")
    d = spark.createDataFrame(items, "item_id string, keywords array<string>, tactics array<string>, vector array<double>")
    d = d.unionByName(spark.createDataFrame([("none", ["alpha"], None, None)], d.schema))
    want = _brute(a, b, texts, items, 0.85, 0.1, 5)
    got = sorted((r.id, r.item_id) for r in tx.similar_items(t, d, 0.85, 0.1, 5, text_rows=20, block_rows=15).collect())
    assert got == want
    some = {(r.id, r.item_id) for r in tx.similar_items(t, d, 0.85, 0.1, 5, probes=8).collect()}
    assert len(some & set(want)) >= 0.99 * len(want)
    assert tx.similar_items(t, d.limit(0), 0.85).collect() == []


# ------------------------------------------------------------------------------------ buckets


def _files(path, version):
    return {str(p): p.stat().st_mtime_ns for p in (path / "data" / f"version={version}").rglob("*.parquet")}


def test_upsert_rewrites_only_the_buckets_it_hits(spark, rows, tmp_path):
    schema = "indicator string, score int"
    old = spark.createDataFrame([(f"k{i}", i) for i in range(200)], schema)
    path = tmp_path / "scores"
    buckets.create_table(old, str(path), "indicator", 16)
    before = _files(path, 0)
    new = spark.createDataFrame([("k3", 1000, 1), ("k3", 1001, 2), ("fresh", 5, 1)], schema + ", run int")
    touched = buckets.upsert_bucketed(spark, str(path), new, "indicator", 1, ("run",)).count()
    assert 1 <= touched <= 2 and _files(path, 0) == before and len(_files(path, 1)) == touched
    want = rows(upsert_table(old, new, "indicator", ("run",)).drop("change"))
    assert rows(buckets.read_table(spark, str(path), schema)) == want
    # a finished batch is not run again, a half-written one is replaced
    once = _files(path, 1)
    buckets.upsert_bucketed(spark, str(path), new, "indicator", 1, ("run",))
    assert _files(path, 1) == once
    (path / "data" / "version=2" / "bucket=0").mkdir(parents=True)
    (path / "data" / "version=2" / "bucket=0" / "part-torn.parquet").write_bytes(b"torn")
    assert rows(buckets.read_table(spark, str(path), schema)) == want
    again = spark.createDataFrame([("k4", -4), ("k3", -3)], schema)
    buckets.upsert_bucketed(spark, str(path), again, "indicator", 2)
    both = upsert_table(upsert_table(old, new, "indicator", ("run",)).drop("change"), again, "indicator").drop("change")
    assert rows(buckets.read_table(spark, str(path), schema)) == rows(both)


def test_history_reads_only_the_days_of_a_batch(spark, rows, tmp_path):
    day = lambda d, h=0: datetime(2024, 1, d, h)
    schema = "indicator string, score int, scoring_date timestamp"
    log = spark.createDataFrame([(f"k{i}", i, day(1 + i % 3, i % 24)) for i in range(90)], schema)
    path = tmp_path / "history"
    buckets.create_table(log, str(path), "indicator", 4, ts="scoring_date")
    new = spark.createDataFrame([("k2", 7, day(3, 23)), ("k2", 8, day(3, 2)), ("k9", 1, day(4)), ("k5", 5, None)], schema)
    before = _files(path, 0)
    buckets.append_bucketed(spark, str(path), new, "indicator", "scoring_date", 1)
    assert _files(path, 0) == before
    assert all("2024-01-03" in f or "2024-01-04" in f or "none" in f for f in _files(path, 1))
    got = rows(buckets.read_table(spark, str(path), schema))
    assert got == rows(append_history(log, new, "indicator", "scoring_date"))


# ------------------------------------------------------------------------------------ density


def brute_density(points, eps, least):
    n = len(points)
    near = [[j for j in range(n) if sum((x - y) ** 2 for x, y in zip(points[i], points[j])) <= eps * eps] for i in range(n)]
    core = [len(x) >= least for x in near]
    label = list(range(n))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(n):
        for j in near[i]:
            if core[i] and core[j]:
                a, b = root(i), root(j)
                label[max(a, b)] = min(a, b)
    out = []
    for i in range(n):
        around = [root(j) for j in near[i] if core[j]]
        out.append((i, root(i) if core[i] else min(around, default=None), core[i]))
    return out


@pytest.mark.parametrize("d, eps", [(2, 0.12), (3, 0.3)])
def test_density_clusters_equal_brute_force(spark, d, eps):
    rng = np.random.default_rng(d)
    blobs = [rng.normal(c, 0.15, size=(220, d)) for c in rng.uniform(-2, 2, size=(4, d))]
    line = np.linspace(-2, 2, 200)[:, None] * np.ones(d) + rng.normal(0, 0.01, size=(200, d))
    copies = np.repeat(rng.uniform(-3, 3, size=(5, d)), 40, axis=0)
    points = np.round(np.concatenate([*blobs, line, copies, rng.uniform(-3, 3, size=(720, d))]), 3)
    names = [f"f{i}" for i in range(d)]
    rows = [(i, *map(float, p)) for i, p in enumerate(points)]
    df = spark.createDataFrame(rows, "id long, " + ", ".join(f"{n} double" for n in names))
    got = sorted((r.id, r.cluster, r.is_core) for r in density_clusters(df, "id", names, eps, 8).collect())
    want = brute_density(points.tolist(), eps, 8)
    assert len({c for _, c, _ in want}) > 3 and any(c is None for _, c, _ in want)
    assert got == want


def test_density_odd_rows(spark):
    df = spark.createDataFrame([(1, 0.0, None), (2, float("nan"), 1.0), (3, 1.0, 1.0), (4, 1.0, 1.0), (5, -0.0, 0.0)], "id long, x double, y double")
    out = {r.id: (r.cluster, r.is_core) for r in density_clusters(df, "id", ["x", "y"], 0.5, 2).collect()}
    assert out == {1: (None, False), 2: (None, False), 3: (3, True), 4: (3, True), 5: (None, False)}
    assert density_clusters(df.limit(0), "id", ["x", "y"], 0.5, 2).collect() == []
    with pytest.raises(ValueError):
        density_clusters(df, "id", ["x"] * 7, 0.5)


# ---------------------------------------------------------------------- lists, groups, articles


def test_lists_in_parts_of_a_bounded_size(spark):
    from sightline.operators.lists import bounded_lists

    rows = [("hot", i % 700) for i in range(2_000)] + [("cold", 3), ("cold", 1), ("cold", None), (None, 9), ("none", None)]
    df = spark.createDataFrame(rows, "k string, v int").repartition(5)
    got = {(r.k, r.part): r for r in bounded_lists(df, ("k",), F.col("v"), "items", 64).collect()}
    assert [x for p in range(11) for x in got[("hot", p)]["items"]] == list(range(700))
    assert all(len(r["items"]) <= 64 for r in got.values()) and got[("hot", 3)].n == 700
    assert got[("cold", 0)]["items"] == [1, 3] and got[(None, 0)]["items"] == [9] and len(got) == 13


def test_long_lists_go_on_in_parts(spark):
    from sightline.operators import aggregates as ag
    from sightline.operators import feeds, joins

    schema = "indicator string, enrichment array<struct<domains:array<string>,tags:array<string>,country:string,vtMaliciousCount:bigint>>"
    item = lambda i: ([f"d{i}", f"d{i + 1}"], None, "US" if i % 2 else None, i)
    df = spark.createDataFrame([("a", [item(i) for i in range(30)]), ("a", [item(5)]), ("b", [([], [], None, None)])], schema)
    rows = ag.flatten_enrichment(df, part_items=8).orderBy("indicator", "part").collect()
    assert sorted(d for r in rows for d in r.enrich_domains) == sorted(f"d{i}" for i in range(31))
    assert [len(r.enrich_domains) for r in rows] == [8, 8, 8, 7, 0]
    assert rows[0].enrich_country == ["US"] and rows[4].enrich_tags == [] and rows[0].enrich_vtMaliciousCount == 29
    left = spark.createDataFrame([("t", f"l{i}") for i in range(5)] + [("n", None)], "search_term string, link string")
    right = spark.createDataFrame([("t", "r"), ("u", "x")], "search_term string, link string")
    got = {(r.search_term, r.part): r.sources for r in joins.full_outer_sources(left, right, part_items=4).collect()}
    assert got == {("t", 0): "l0, l1, l2, l3", ("t", 1): "l4, r", ("u", 0): "x", ("n", 0): ""}
    groups = spark.createDataFrame([(f"i{k}", "g") for k in range(5)] + [("one", "h"), ("x", None)], "search_term string, group_id string")
    out = feeds.report_groups(groups, part_items=3).collect()
    assert {(r.report, r.part, len(r.indicators)) for r in out} == {("Group_g", 0, 3), ("Group_g", 1, 2), ("one", 0, 1), ("x", 0, 1)}


def test_quantiles_of_many_groups_at_once(spark):
    from sightline.operators import aggregates as ag
    from sightline.operators.ordering import exact_quantiles

    rng = random.Random(5)
    rows = [(rng.choice(["a", "b", "hot", "hot", None]), rng.choice([rng.random() * 100, 7.0, None])) for _ in range(3_000)]
    df = spark.createDataFrame([(g, v, n) for n, (g, v) in enumerate(rows)], "g string, v double, id int")
    got = {r.g: (r.n, r.q0, r.q1) for r in exact_quantiles(df, "v", (0.25, 0.5), ("g",)).collect()}
    for g in ("a", "b", "hot", None):
        own = [v for k, v in rows if k == g and v is not None]
        assert got[g][0] == len(own) and got[g][1:] == pytest.approx(tuple(np.quantile(own, (0.25, 0.5))))
    described = {r.g: r for r in ag.describe_group(df, "g", "v", 6).collect()}
    assert described[None].median == pytest.approx(got[None][2], abs=1e-6) and described["a"]["count"] == got["a"][0]
    plan = ag.describe_group(df, "g", "v")._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan
    filled = {r.id: r.v for r in ag.median_impute_by_key(df, "g", ("v",)).collect()}
    assert all(filled[n] == pytest.approx(got[g][2] if v is None else v) for n, (g, v) in enumerate(rows))


def brute_articles(stored, new):
    titles, urls, out = {t for t, _ in stored}, {u for _, u in stored}, []
    for n, t, u in sorted(new):
        if t and u and t not in titles and u not in urls:
            titles.add(t)
            urls.add(u)
            out.append(n)
    return out


@pytest.mark.parametrize("fold", [100_000, 20])
def test_articles_in_chains_and_crowds(spark, fold):
    """A long chain, a title that very many share, and a random tangle."""
    from sightline.sources.ingest import skip_known_articles

    rng = random.Random(1)
    chain = 60 if fold == 20 else 10_000
    new = [(i, f"t{i // 2}", f"u{(i + 1) // 2}") for i in range(chain)]
    new += [(20_000 + i, "same title", f"v{i}") for i in range(300)] + [(30_000 + i, f"r{rng.randint(0, 60)}", f"s{rng.randint(0, 60)}") for i in range(150)]
    new += [(40_000, None, "w"), (40_001, "t", ""), (40_002, "stored", "x"), (40_003, "y", "known")]
    stored = [("stored", "known")]
    got = skip_known_articles(
        spark.createDataFrame(stored, "title string, url string"), spark.createDataFrame(new, "ingest_order int, title string, url string").repartition(4),
        fold_articles=fold).orderBy("text_id").collect()
    want = brute_articles(stored, new)
    assert [r.ingest_order for r in got] == want and [r.text_id for r in got] == list(range(1, len(want) + 1))
