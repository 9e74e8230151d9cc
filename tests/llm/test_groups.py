"""MinHash groups, vector links and decontamination against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest

from sightline.llm import minhash
from sightline.llm.components import components
from sightline.llm.decontaminate import contamination_digest, mark_contamination, remove_contamination
from sightline.llm.minhash import drop_near_duplicates, near_duplicates
from sightline.llm.neighbours import near_vectors

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def prose(rng, n, words):
    return " ".join(rng.choice(words) for _ in range(n))


def vocabulary(rng):
    return ["".join(rng.choice("abcdeéXY1") for _ in range(rng.randint(1, 6))) for _ in range(60)]


def shingles(text):
    words = (text or "").translate(LOWER).encode().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}


def brute_groups(docs, percent):
    sets = {i: shingles(t) for i, t in docs}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a, i in enumerate(ids):
        for j in ids[:a]:
            if sets[i] and sets[j]:
                n = len(sets[i] & sets[j])
                if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                    u, v = find(i), find(j)
                    parent[max(u, v)] = min(u, v)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


@pytest.fixture(scope="module")
def near_texts():
    rng = random.Random(7)
    words = vocabulary(rng)
    base = [prose(rng, rng.randint(30, 200), words) for _ in range(30)]
    docs = []
    for i in range(400):
        k = rng.random()
        if k < 0.1:
            t = rng.choice(base)
        elif k < 0.6:
            t = rng.choice(base[:6] if k < 0.4 else base).split()
            for _ in range(rng.randint(1, 5)):
                t[rng.randrange(len(t))] = rng.choice(words)
            t = " ".join(t)
        elif k < 0.7:
            t = prose(rng, rng.randint(0, 6), words)
        elif k < 0.75:
            t = rng.choice([None, "", " \n"])
        else:
            t = prose(rng, rng.randint(5, 100), words)
        docs.append((i * 3, t))
    return docs


@pytest.mark.parametrize("block", [2048, 7])
def test_near_duplicates(spark, near_texts, block, monkeypatch):
    """Also with lists in many pieces."""
    monkeypatch.setattr(minhash, "LIST_BLOCK", block)
    docs = spark.createDataFrame(near_texts, "doc_id long, text string")
    got = {r[0]: tuple(r[1:]) for r in near_duplicates(docs, 85).collect()}
    assert got == brute_groups(near_texts, 85)


def test_near_duplicates_shuffled_ids(spark, near_texts, monkeypatch):
    monkeypatch.setattr(minhash, "BROADCAST_IDS", 0)
    docs = spark.createDataFrame([(i, t, 1) for i, t in near_texts], "doc_id long, text string, key int")
    kept = {i for i, (_, _, k) in brute_groups(near_texts, 80).items() if k}
    done = drop_near_duplicates(docs)
    assert done.columns == docs.columns and {r.doc_id for r in done.collect()} == kept


def test_near_duplicates_odd_rows(spark):
    rows = [(1, "a b c d e f"), (1, "x y z w v u"), (2, "X y z w v u"), (None, "a b c d e f"), (4, None), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, near_duplicates(docs).collect()), key=str)
    assert got == [(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (4, 0, 4, True), (4, 0, 4, True), (None, 2, None, True)]
    assert near_duplicates(docs.limit(0)).collect() == []


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 140)}}


def brute_vectors(rows, threshold=0.98):
    ok = [i for i, (_, e, l) in enumerate(rows) if e and l is not None and all(x is not None and np.isfinite(x) for x in e) and any(e)]
    unit = {i: np.array(rows[i][1]) / np.linalg.norm(np.array(rows[i][1])) for i in ok}
    parent, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in ok:
        for b in ok:
            if a < b and rows[a][2] == rows[b][2] and unit[a] @ unit[b] >= threshold:
                links[a], links[b] = links[a] + 1, links[b] + 1
                parent[find(a)] = find(b)
    least = {}
    for i, row in enumerate(rows):
        least[find(i)] = min(least.get(find(i), row[0]), row[0])
    return sorted((r[0], links[i], least[find(i)], r[0] == least[find(i)]) for i, r in enumerate(rows))


def test_vectors(spark):
    rng = np.random.default_rng(1)
    centres, rows = rng.standard_normal((20, 16)), []
    odd = [None, [], [0.0] * 16, [1.0, None] * 8, [float("nan")] * 16, [float("inf")] + [1.0] * 15]
    for i in range(400):
        k = rng.random()
        if k < 0.3:
            e = centres[rng.integers(3)] + rng.standard_normal(16) * 0.09
        elif k < 0.5:
            e = centres[rng.integers(20)] + rng.standard_normal(16) * 0.1
        elif k < 0.55:
            e = centres[0]
        elif k < 0.6:
            e = odd[rng.integers(len(odd))]
        else:
            e = rng.standard_normal(16)
        e = e if e is None else [None if x is None else float(np.float32(x)) for x in e]
        rows.append((i, e, None if rng.random() < 0.03 else int(rng.integers(2))))
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    assert sorted(map(tuple, near_vectors(table).collect())) == brute_vectors(rows)
    assert near_vectors(table.limit(0)).collect() == []


NORMAL = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_contamination(docs, bench, w=10):
    windows, out = {}, {}
    for i, t in bench:
        words = NORMAL.findall((t or "").translate(LOWER))
        size = min(w, len(words))
        for k in range(len(words) - size + 1 if words else 0):
            windows.setdefault(tuple(words[k : k + size]), set()).add(i)
    for i, t in docs:
        words = NORMAL.findall((t or "").translate(LOWER))
        hit, items = [False] * len(words), set()
        for size in {len(x) for x in windows}:
            for k in range(len(words) - size + 1):
                found = windows.get(tuple(words[k : k + size]))
                if found:
                    items |= found
                    hit[k : k + size] = [True] * size
        names = ",".join(sorted(map(str, items)))
        out[i] = (len(words), sum(hit), len(items), hashlib.sha256(names.encode()).hexdigest(), any(hit))
    return out


def test_contamination(spark):
    rng = random.Random(9)
    words = vocabulary(rng)
    bench = [(i, prose(rng, rng.choice([3, 5, 9, 10, 14, 30]), words)) for i in range(25)]
    bench += [(90, None), (91, ""), (92, "..."), (0, "repeat it again please")]
    docs = []
    for i in range(200):
        t = prose(rng, rng.randint(0, 60), words)
        if rng.random() < 0.4:
            t += "-" + (rng.choice(bench)[1] or "").replace("a", "A") + "! " + prose(rng, 4, words)
        docs.append((i, rng.choice([t] * 5 + [None])))
    table = spark.createDataFrame([(i, t, "s", 3) for i, t in docs], "doc_id long, text string, items string, n_words int")
    items = spark.createDataFrame(bench, "item_id long, text string")
    want = brute_contamination(docs, bench)
    assert {r[0]: tuple(r[1:]) for r in contamination_digest(table, items).collect()} == want
    # the same by many broadcasts of a bounded size
    shares = mark_contamination(table, items, broadcast_windows=20)
    assert {r.doc_id: r.n_hit for r in shares.collect()} == {i: w[1] for i, w in want.items()}
    left = remove_contamination(table, items)
    assert left.columns == table.columns
    assert {r.doc_id for r in left.collect()} == {i for i, w in want.items() if not w[4]}
    assert contamination_digest(table.limit(0), items).collect() == []
    assert contamination_digest(table, items.limit(0)).where("contaminated").count() == 0


def test_spans_are_cut_from_the_text(spark):
    docs = spark.createDataFrame([(1, "Intro: One, TWO three-four! End é.", "k")], "doc_id long, text string, items string")
    items = spark.createDataFrame([(5, "one two three four")], "item_id long, text string")
    row = remove_contamination(docs, items, remove="spans").first()
    assert row.text == "Intro: ! End é." and row["items"] == "k"


def test_vectors_with_few_links(spark, monkeypatch):
    """A few pairs in many lone vectors: a sample without links is no evidence that all were found."""
    from sightline.llm import neighbours

    first = neighbours.first_lists
    monkeypatch.setattr(neighbours, "first_lists", lambda nodes, most, seed: first(nodes, most, seed).limit(0))  # the orders show nothing
    rng = np.random.default_rng(5)
    e = rng.standard_normal((3000, 48))
    for i in range(2):
        e[1500 + i] = e[i] + rng.standard_normal(48) * 0.12
    rows = [(i, [float(x) for x in e[i]], 1) for i in range(len(e))]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    unit = e / np.linalg.norm(e, axis=1)[:, None]
    links = ((unit @ unit.T >= 0.98).sum(1) - 1).tolist()
    assert sum(links) == 4
    assert {r.vec_id: r.n_links for r in near_vectors(table).collect()} == dict(enumerate(links))


def test_vectors_take_tasks_by_their_bytes(spark):
    """No step has a task for each shuffle partition: the driver keeps account of every task."""
    rng = np.random.default_rng(7)
    e = rng.standard_normal((90, 16))
    e[60:] = e[:30] + rng.standard_normal((30, 16)) * 0.03
    rows = [(i, [float(x) for x in e[i]], 1) for i in range(len(e))]
    context, before = spark.sparkContext, spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    context.setJobGroup("vectors-by-bytes", "")
    try:
        table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
        assert sorted(map(tuple, near_vectors(table).collect())) == brute_vectors(rows)
        status = context.statusTracker()
        stages = {i for job in status.getJobIdsForGroup("vectors-by-bytes") for i in status.getJobInfo(job).stageIds}
        tasks = [info.numTasks for i in stages if (info := status.getStageInfo(i)) and info.numCompletedTasks]
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert tasks and max(tasks) <= 3 * context.defaultParallelism


def test_vectors_of_two_close_groups(spark, monkeypatch):
    """Lists that fill up with a vector's own group don't lose the links to the other group."""
    from sightline.llm import neighbours

    monkeypatch.setattr(neighbours, "search", _no_search)
    rng = np.random.default_rng(6)
    e = rng.standard_normal((300, 32))
    e /= np.linalg.norm(e, axis=1)[:, None]
    e[1] -= e[1] @ e[0] * e[0]
    e[1] = 0.985 * e[0] + np.sqrt(1 - 0.985**2) * e[1] / np.linalg.norm(e[1])
    for k, i in ((0, 100), (1, 200)):
        e[i : i + 100] = e[k] + rng.standard_normal((100, 32)) * 0.0008
    rows = [(i, [float(x) for x in e[i]], 1) for i in range(300)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert sorted(map(tuple, near_vectors(table).collect())) == brute_vectors(rows)


def _no_search(*_):
    raise AssertionError("compared with a whole label")


def test_vectors_like_a_corpus_without_full_search(spark, monkeypatch):
    """A hot label, rare pairs near the threshold, dense clumps, and clumps that few links join."""
    from sightline.llm import neighbours

    monkeypatch.setattr(neighbours, "search", _no_search)
    rng = np.random.default_rng(12)
    e = rng.standard_normal((2600, 64))
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)

    def turned(x, cosine):
        aside = rng.standard_normal(len(x))
        aside = unit(aside - (aside @ x) * x)
        return cosine * x + np.sqrt(1 - cosine**2) * aside

    e = unit(e)
    for i in range(60):  # rare pairs
        e[100 + i] = turned(e[i], rng.uniform(0.9805, 0.999))
    for clump, (begin, size) in enumerate(((300, 300), (700, 120), (900, 60))):  # dense clumps
        for i in range(begin, begin + size):
            e[i] = turned(e[200 + clump], rng.uniform(0.9955, 0.9999))
    for k in range(4):  # clumps of 25 around centres that lie 0.983 apart, one after the other
        centre = e[210] if k == 0 else turned(centre, 0.983)
        e[1000 + 25 * k : 1025 + 25 * k] = [turned(centre, 0.99999) for _ in range(25)]
    rows = [(i, [float(x) for x in v], 1 if i < 2000 else int(rng.integers(2, 5))) for i, v in enumerate(e)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    want = {w[0]: w for w in brute_links(rows)}
    got = {r.vec_id: tuple(r) for r in near_vectors(table).collect()}
    assert sum(r[1] for r in got.values()) >= 0.99 * sum(w[1] for w in want.values())
    assert all(got[i][1] <= want[i][1] for i in want)
    assert sum(got[i][2] == want[i][2] for i in want) >= 0.99 * len(want)
    monkeypatch.undo()
    assert {r.vec_id: tuple(r) for r in near_vectors(table, exhaustive=True).collect()} == want


def brute_links(rows, threshold=0.98):
    """``brute_vectors`` for clean vectors, by one product for each label."""
    x, labels = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = (x @ x.T >= threshold) & (labels[:, None] == labels[None, :])
    np.fill_diagonal(near, False)
    least = np.arange(len(rows))
    while True:
        lower = np.minimum(least, np.where(near, least[None, :], len(rows)).min(1))
        if (lower == least).all():
            break
        least = lower
    return [(i, int(near[i].sum()), int(least[i]), bool(least[i] == i)) for i in range(len(rows))]


def test_families_in_one_list_get_a_centre_each():
    """Two families of near copies that share some coordinates: a pair per member, and no link lost."""
    import pyarrow as pa

    from sightline.llm import blocks as B
    from sightline.llm import minhash

    rule, rng = minhash.Rule(85, 5), np.random.default_rng(3)
    base = rng.integers(0, 60_000, (2, minhash.COORDINATES), dtype=np.uint16)
    base[1, :30] = base[0, :30]
    signs = np.repeat(base, 800, axis=0)
    for row in signs:
        row[rng.integers(minhash.COORDINATES)] = rng.integers(0, 60_000)
    ids, n = np.arange(1600), len(signs)
    table = pa.table({
        "lists": [B.pack(np.full(n, 5, np.uint64))], "sides": [B.pack(np.zeros(n, np.uint8))], "ids": [B.pack(ids)],
        "sizes": [B.pack(np.full(n, 100))], "signs": [B.pack(signs)]})
    pairs = minhash._pairs(table, rule)
    assert pairs.num_rows < 2_000
    centres: dict[int, set[int]] = {}
    for u, v in zip(pairs.column("u").to_pylist(), pairs.column("v").to_pylist()):
        centres.setdefault(u, {u}).add(v)
    for i, j in rng.integers(0, n, (4_000, 2)).tolist():
        if i != j and (signs[i] == signs[j]).sum() >= rule.matches:
            assert any(i in own and j in own for own in centres.values())


def test_one_share_of_the_benchmark_is_alive(spark, monkeypatch):
    """Each share's broadcast is destroyed before the next is made, and the windows are made once."""
    from sightline.llm import decontaminate

    docs = spark.createDataFrame([(i, " ".join(f"w{i + k}" for k in range(30))) for i in range(40)], "doc_id long, text string")
    items = spark.createDataFrame([(i, " ".join(f"w{i + k}" for k in range(12))) for i in range(20)], "item_id long, text string")
    alive, most, made = set(), [], []
    context = type(spark.sparkContext)
    send, windows = context.broadcast, decontaminate.item_windows

    def broadcast(self, value):
        out = send(self, value)
        if isinstance(value, decontaminate.GramSet):
            alive.add(id(out))
            most.append(len(alive))
            destroy = out.destroy
            out.destroy = lambda *a, **k: (alive.discard(id(out)), destroy(*a, **k))
        return out

    monkeypatch.setattr(context, "broadcast", broadcast)
    monkeypatch.setattr(decontaminate, "item_windows", lambda *a: (made.append(1), windows(*a))[1])
    got = {r.doc_id: r.n_hit for r in mark_contamination(docs, items, broadcast_windows=6).collect()}
    assert len(most) > 5 and max(most) == 1 and len(made) == 1
    monkeypatch.undo()
    assert got == {r.doc_id: r.n_hit for r in mark_contamination(docs, items).collect()}
