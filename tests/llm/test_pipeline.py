"""Every stage of the pipeline, over whole texts, against plain Python."""

import hashlib
import math
import random

import pytest
import regex
from pyspark.sql import functions as F

import corpus_pipeline
from sightline.llm import quality
from tests.llm.test_content import water_fill
from tests.llm.test_groups import brute_contamination, brute_groups
from tests.llm.test_repeats import edit_distance, prose

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, predicted string, n_lines string, copies string"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents with junk, repeated lines, copies, benchmark passages, null and empty texts, a very long
    text, repeated and missing ids, and columns named like those that stages add."""
    rng, path = random.Random(8), str(tmp_path_factory.mktemp("sf"))
    words = ["".join(rng.choice("abcdefgé") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    bench = [prose(rng, 14, words) for _ in range(4)]
    base, lines, rows, labels = [], [prose(rng, 6, words) + "." for _ in range(8)] + ["Les.", "x"], [], []
    for i in range(260):
        kind = rng.random()
        good = kind >= 0.2
        if not good:
            text = "\n".join("".join(rng.choice("#$%&*@!9 ") for _ in range(30)) for _ in range(rng.randint(1, 6)))
        elif kind < 0.4 and base:
            text = rng.choice(base).split(" ")
            text[rng.randrange(len(text))] = rng.choice(words)
            text = " ".join(text)
        else:
            parts = [prose(rng, rng.randint(10, 60), words).capitalize() + "." for _ in range(rng.randint(1, 4))]
            parts += [rng.choice(lines) for _ in range(rng.randint(0, 3))]
            parts += [rng.choice(bench)] if rng.random() < 0.1 else []
            rng.shuffle(parts)
            text = "\n".join(parts)
            base.append(text)
        rows.append((i, text, "en", rng.choice(["a", "b", "hot", "hot", None]), len(text)))
        labels.append((i, int(good), 0))
    rows += [(300, None, "en", "a", 0), (301, "", "en", "a", 0), (302, "Les.\nx", "en", "b", 6), (303, " \n ", "en", "b", 3)]
    rows += [(304, (prose(rng, 6_000, words) + ". ") * 2, "en", "hot", 0), rows[5], (None, rows[7][1], "en", "a", 1)]
    docs = [(*r, "s", "p", "n", "c") for r in rows]
    spark.createDataFrame(docs, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(list(enumerate(bench)), "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


@pytest.fixture(scope="module")
def done(spark, folder):
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, folder).write.parquet(path)
        out[name] = docs.collect(), spark.read.parquet(path).collect()
        docs = spark.read.parquet(path)
    return out


def key(row):
    return tuple("" if row[c] is None else str(row[c]) for c in ("doc_id", "text", "source"))


def test_no_column_is_replaced(spark, done):
    for name, (_, after) in done.items():
        assert len(after) and all((r.score, r.predicted, r.n_lines) == ("s", "p", "n") for r in after), name


def brute_statistics(text):
    text = text or ""
    words = [w for w in regex.split(r"[ \t\n\x0b\f\r]+", text) if w]
    n, chars = max(len(words), 1), max(len(text), 1)
    count = lambda pattern: len(regex.findall(pattern, text, regex.A if r"\S" in pattern else 0))
    return {
        "words": float(len(words)), "word_length": len(text) / n, "distinct": len(set(words)) / n, "upper": count("[A-ZÀ-Þ]") / chars,
        "digits": count("[0-9]") / chars, "symbols": count(r"[^\p{L}\p{N} \t\n\x0b\f\r.,]") / chars, "stops": count("[.,]") / n,
        "lines": count("\n") / n, "repeats": count(r"(?<!\S)(\S+)\s\1(?!\S)") / n,
    }


def test_quality(spark, folder, done):
    before, after = done["quality"]
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.train(docs, labels)

    def good(text):
        stats, total = brute_statistics(text), model.intercept
        for rule, weight in model.weights:
            if all(stats[n] <= at if side == "<=" else stats[n] > at for n, side, at in rule):
                total += weight
        return 1 / (1 + math.exp(-total)) >= quality.THRESHOLD

    assert sorted(map(key, after)) == sorted(key(r) for r in before if good(r.text))
    truth = {r.doc_id: r.quality for r in labels.collect()}
    kept = {r.doc_id for r in after}
    assert sum((i in kept) == bool(q) for i, q in truth.items()) >= 0.95 * len(truth)


def test_lines(done):
    before, after = done["lines"]
    order = sorted(before, key=lambda r: (r.doc_id is None, r.doc_id or 0, (r.text or "").encode()))
    seen, want = [], []
    for r in order:
        kept, own = [], (r.text or "").encode().split(b"\n")
        for line in own:
            if len(line) >= 20:
                hit = any(line == x or (len(x) >= 20 and abs(len(line) - len(x)) <= 2 and edit_distance(line, x) <= 2) for x in seen if len(line) < 2_000 or line == x)
            else:
                hit = bool(line.strip()) and line in seen
            seen.append(line)
            if not hit:
                kept.append(line)
        text = b"\n".join(kept).decode()
        if len(kept) == len(own) or text.strip():
            want.append((str(r.doc_id), text, str(r.source), len(text)))
    assert sorted((str(r.doc_id), r.text, str(r.source), r.n_chars) for r in after) == sorted(want)


def test_near_duplicates(done):
    before, after = done["near-duplicates"]
    texts = {}
    for r in before:
        texts.setdefault(r.doc_id, []).append(r.text)
    single = {i: t[0] for i, t in texts.items() if i is not None and len(t) == 1}
    groups = brute_groups(list(single.items()), 80)
    twice = {i for i, t in texts.items() if len(t) > 1}
    kept = {r.doc_id for r in after}
    assert {i for i in kept if i in single} >= {i for i, g in groups.items() if g[2]} - twice
    assert {i for i in single if i not in kept} <= {i for i, g in groups.items() if not g[2]} | {
        i for i in single if any(single[i] == t for j in twice for t in texts[j])}
    if not twice:
        assert {i for i in kept if i is not None} == {i for i, g in groups.items() if g[2]}


def test_decontamination(spark, folder, done):
    before, after = done["decontamination"]
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    hit = brute_contamination([(key(r), r.text) for r in before], bench)
    assert any(h[4] for h in hit.values())
    assert sorted(map(key, after)) == sorted(key(r) for r in before if not hit[key(r)][4])


def test_mix(done):
    before, after = done["mix"]
    sizes, rows = {}, []
    for r in before:
        words = len([w for w in regex.split(r"[ \t\n\x0b\f\r]+", r.text or "") if w])
        sizes[r.source] = sizes.get(r.source, 0) + words
        quality_ = max(0.25, 1 - abs(len(r.text or "") / (words + 1) - 6) / 8)
        name = "11" if r.doc_id is None else f"11:{r.doc_id}"
        u = (int(hashlib.md5(name.encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        rows.append((-math.log(u) / quality_, r.doc_id is not None, r.doc_id or 0, words, r.source))
    targets, want = water_fill(sizes), []
    for source, size in sizes.items():
        epochs = math.floor(targets[source] / size) if size else 0
        rest, done_words = targets[source] - epochs * size, 0
        for _, _, doc_id, words, _ in sorted(r for r in rows if r[4] == source):
            copies = epochs + (done_words + words / 2 <= rest) if words else 0
            done_words += words
            if copies:
                want.append((doc_id, words, copies))
    assert sorted((r.doc_id or 0, r.size, r.taken // r.size) for r in after) == sorted(want)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_empty_tables(spark, folder, name):
    docs = spark.read.parquet(f"{folder}/documents.parquet").where(F.lit(False))
    out = dict(corpus_pipeline.STAGES)[name](spark, docs, folder)
    assert out.collect() == [] and set(docs.columns) <= set(out.columns)


def test_run_is_the_stages_in_turn(spark, folder, done):
    got = sorted((key(r), r.copies) for r in corpus_pipeline.run(spark, folder).collect())
    assert got == sorted((key(r), r.copies) for r in done["mix"][1])
