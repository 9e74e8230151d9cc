"""MinHash near-dedup by a signature-coordinate inverted join (operator 6)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.session import pin

from . import blocks as B
from .components import components

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
COORDINATES = 64
LIST_BLOCK = 2048  # members of a posting list that are compared in one piece
BROADCAST_IDS = 1_000_000  # ids of a broadcast semi-join (8 MB); more are joined by a shuffle
SLICE_BYTES = 4 << 20


@dataclass(frozen=True)
class Rule:
    """Link texts with ``100 * intersection >= percent * union`` of their shingle sets."""

    percent: int
    words: int = 5

    @property
    def matches(self) -> int:
        """Coordinates that must agree: six standard deviations below what the least similar pair
        that counts has on average, so that about one such pair in a thousand million is lost."""
        p = self.percent / 100
        return max(1, int(COORDINATES * p - 6 * (COORDINATES * p * (1 - p)) ** 0.5))


# -- shingle sets and signatures --------------------------------------------------------------


def shingle_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    """Sorted 64-bit hashes of the distinct shingles of each text."""
    buf, begins, counts = B.split_words([t.translate(LOWER) for t in texts])
    tokens = B.piece_hashes(buf, begins)
    grams = B.gram_hashes(tokens, words) if len(tokens) >= words else np.zeros(0, np.uint64)
    out, at = [], 0
    for n in counts.tolist():
        if n >= words:
            ordered = np.sort(grams[at : at + n - words + 1])
            out.append(ordered[B.group_starts(ordered)])
        elif n:
            out.append(B.gram_hashes(tokens[at : at + n], n) ^ np.uint64(n))
        else:
            out.append(np.zeros(0, np.uint64))
        at += n
    return out


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[list, list[bytes]]]:
    ids, column = batch.column(0).to_pylist(), batch.column(1)
    begin = 0
    while begin < len(ids):
        end, size, texts = begin, 0, []
        while end < len(ids) and size < SLICE_BYTES:
            texts.append(column[end].as_py() or b"")
            size += len(texts[-1])
            end += 1
        yield ids[begin:end], texts
        begin = end


def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(6)
    high = np.iinfo(np.uint64).max
    return (rng.integers(0, high, COORDINATES, np.uint64) | np.uint64(1), rng.integers(0, high, COORDINATES, np.uint64))


def set_key(sets: list[np.ndarray]) -> np.ndarray:
    """64-bit key of each set, from its size and two sums over its hashes; 0 for the empty set."""
    sizes = np.array([len(x) for x in sets], np.int64)
    full = np.flatnonzero(sizes)
    out = np.zeros(len(sets), np.uint64)
    if len(full):
        every = np.concatenate(sets)
        starts = (np.cumsum(sizes) - sizes)[full]
        one, two = np.add.reduceat(B.mix(every), starts), np.add.reduceat(B.mix(~every), starts)
        out[full] = B.mix(one ^ B.mix(two + sizes[full].astype(np.uint64)))
    return out.view(np.int64)


def _sign(words: int):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _multipliers()
        for batch in batches:
            for ids, texts in _slices(batch):
                sets = shingle_sets(texts, words)
                sizes = np.array([len(s) for s in sets], np.int64)
                full = np.flatnonzero(sizes)
                every = np.concatenate(sets)
                starts = (np.cumsum(sizes) - sizes)[full]
                signs = np.zeros((len(ids), COORDINATES), np.uint32)
                if len(full):
                    for k in range(COORDINATES):
                        value = ((every * a[k] + b[k]) >> np.uint64(32)).astype(np.uint32)
                        signs[full, k] = np.minimum.reduceat(value, starts)
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()),
                    pa.array(set_key(sets)),
                    pa.array([B.pack(s) for s in signs], pa.binary()),
                ], ["doc_id", "n_shingles", "key", "signature"])

    return step


def _sets(words: int):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in _slices(batch):
                sets = shingle_sets(texts, words)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(set_key(sets)), pa.array([B.pack(s) for s in sets], pa.binary())], ["id", "shingles"])

    return step


# -- candidates -------------------------------------------------------------------------------


def _coordinate_keys(signs: np.ndarray) -> np.ndarray:
    """One 64-bit key for each coordinate and value."""
    return B.mix(signs.astype(np.uint64) | (np.arange(COORDINATES, dtype=np.uint64) << np.uint64(32)))


def _read_classes(table: pa.Table):
    table = table.sort_by("id")
    signs = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint32).reshape(-1, COORDINATES)
    return table.column("id").to_numpy(), table.column("n").to_numpy(), signs


def _send_coordinates(table: pa.Table, n: int) -> pa.Table:
    _, _, signs = _read_classes(table)
    keys = np.sort(_coordinate_keys(signs).reshape(-1))
    starts = B.group_starts(keys)
    keys, counts = keys[starts], np.diff(np.append(starts, len(keys)))
    part = B.part_of(keys, n)
    order, edges = B.by_part(part, n)
    full = [p for p in range(n) if edges[p] < edges[p + 1]]
    cut = lambda x, p: B.pack(x[order[edges[p] : edges[p + 1]]])
    return pa.table({
        "part": pa.array(full, pa.int32()),
        "block": pa.array([table.column("block")[0].as_py()] * len(full), pa.int32()),
        "keys": pa.array([cut(keys, p) for p in full], pa.binary()),
        "counts": pa.array([cut(counts.astype(np.uint32), p) for p in full], pa.binary()),
    })


def _total(table: pa.Table) -> pa.Table:
    """Length of the posting list of every key."""
    keys = B.cells(table, "keys", np.uint64)
    every, place = np.unique(np.concatenate(keys), return_inverse=True)
    totals = np.zeros(len(every), np.int64)
    np.add.at(totals, place.reshape(-1), np.concatenate(B.cells(table, "counts", np.uint32)).astype(np.int64))
    cuts = np.split(totals[place.reshape(-1)], np.cumsum([len(k) for k in keys])[:-1])
    return pa.table({
        "block": table.column("block"), "part": table.column("part"), "keys": table.column("keys"),
        "totals": pa.array([B.pack(c) for c in cuts], pa.binary()),
    })


def _post(classes: pa.Table, answers: pa.Table, n: int, rule: Rule) -> pa.Table:
    """Post each class under the rarest of its coordinates.

    Two classes that agree in T of K coordinates share one among the K - T + 1 that come first in an
    order common to all, here the rarest first; so the other T - 1, the longest lists, are skipped.
    A list longer than LIST_BLOCK is dealt into pieces, and each pair of pieces meets once.
    """
    out: dict[str, list] = {k: [] for k in ("part", "lists", "sides", "ids", "sizes", "signs")}
    if classes.num_rows and answers.num_rows:
        ids, sizes, signs = _read_classes(classes)
        known = np.concatenate(B.cells(answers, "keys", np.uint64))
        totals = np.concatenate(B.cells(answers, "totals", np.int64))
        order = np.argsort(known)
        keys = _coordinate_keys(signs)
        total = totals[order][np.searchsorted(known[order], keys)]
        by_row = np.lexsort((keys, total), axis=1)[:, : COORDINATES - rule.matches + 1]
        rows = np.repeat(np.arange(len(ids)), by_row.shape[1])
        keys = np.take_along_axis(keys, by_row, 1).reshape(-1)
        total = np.take_along_axis(total, by_row, 1).reshape(-1)
        rows, keys, total = rows[total > 1], keys[total > 1], total[total > 1]
        take, low, high, sides = deal_pieces(ids[rows], -(-total // LIST_BLOCK))
        rows, keys = rows[take], keys[take]
        lists = B.mix(keys + B.mix((low.astype(np.uint64) << np.uint64(32)) | high.astype(np.uint64)))
        part = B.part_of(lists, n)
        order, edges = B.by_part(part, n)
        short = signs.astype(np.uint16)
        for p in range(n):
            at = order[edges[p] : edges[p + 1]]
            if len(at):
                out["part"].append(p)
                out["lists"].append(B.pack(lists[at]))
                out["sides"].append(B.pack(sides[at]))
                out["ids"].append(B.pack(ids[rows[at]]))
                out["sizes"].append(B.pack(sizes[rows[at]]))
                out["signs"].append(B.pack(short[rows[at]]))
    return pa.table({k: pa.array(v, pa.int32() if k == "part" else pa.binary()) for k, v in out.items()})


def deal_pieces(ids: np.ndarray, pieces: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Each row once for every pair of pieces that has its own: row, both pieces, and the row's side
    (0 where the pair is one piece with itself, else 1 or 2)."""
    mine = (B.mix(ids.astype(np.uint64)) % pieces.astype(np.uint64)).astype(np.int64)
    take = np.repeat(np.arange(len(ids)), pieces)
    other = B.ranges(np.zeros(len(pieces), np.int64), pieces)
    low, high = np.minimum(mine[take], other), np.maximum(mine[take], other)
    return take, low, high, np.where(low == high, 0, np.where(mine[take] == low, 1, 2)).astype(np.uint8)


def _centre(signs: np.ndarray) -> int:
    """Row that agrees most with the others of the list (with 256 of them at most)."""
    some = np.unique(np.linspace(0, len(signs) - 1, min(len(signs), 256)).astype(np.int64))
    return int(some[np.argmax([(signs[some] == signs[i]).sum() for i in some])])


def _pairs(table: pa.Table, rule: Rule) -> pa.Table:
    """Pairs (centre, member) of a list that agree in enough coordinates.

    Members that agree with one centre are compared later by what they differ in from it
    (``_compare_differences``).  A member that agrees with one that it shares no centre with becomes a
    centre itself, so families in one list cost a pair per member each, and not all pairs.
    """
    join = lambda c, t: np.concatenate(B.cells(table, c, t))
    lists, sides, ids, sizes = (join(c, t) for c, t in (("lists", np.uint64), ("sides", np.uint8), ("ids", np.int64), ("sizes", np.int64)))
    signs = np.frombuffer(b"".join(table.column("signs").to_pylist()), np.uint16).reshape(-1, COORDINATES)
    order = np.lexsort((ids, lists))
    starts = B.group_starts(lists[order])

    def fits(x: int, rest: np.ndarray) -> np.ndarray:
        """Sizes that may belong to a link; they are not asked of a centre's members."""
        return 100 * np.minimum(sizes[rest], sizes[x]) >= rule.percent * np.maximum(sizes[rest], sizes[x])

    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for a, b in zip(starts.tolist(), np.append(starts[1:], len(order)).tolist()):
        at = order[a:b]
        if len(at) < 2:
            continue
        agrees = lambda k: ((signs[at] == signs[at[k]]).sum(1) >= rule.matches) & (np.arange(len(at)) != k)
        first = _centre(signs[at])
        centres, members = [first], agrees(first)[None, :]
        for k in np.flatnonzero(~members[0]).tolist():
            if k == first:
                continue
            own, mine = agrees(k), members[:, k]
            met = members[mine].any(0)  # those that share a centre with k, and its centres, are paired already
            met[np.array(centres)[mine]] = True
            if sides[at[k]]:
                met |= sides[at] == sides[at[k]]
            if (own & ~met & fits(at[k], at)).any():
                centres.append(k)
                members = np.concatenate((members, own[None, :]))
        for k, own in zip(centres, members):
            left.append(np.full(own.sum(), ids[at[k]]))
            right.append(ids[at[own]])
    u, v = np.concatenate(left), np.concatenate(right)
    keep = np.unique(np.stack((u, v), 1), axis=0)
    return pa.table({"u": pa.array(keep[:, 0]), "v": pa.array(keep[:, 1])})


def candidates(classes: DataFrame, rule: Rule) -> DataFrame:
    """Candidate pairs (u, v) of ``classes`` (id, n, signature), u being the centre."""
    n = B.parts(classes.sparkSession)
    base = B.deal(classes.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")), "block", n)
    sent = B.on_groups(base, "block", lambda t: _send_coordinates(t, n), "part int, block int, keys binary, counts binary")
    totals = B.on_groups(B.deal(sent, "part", n), "part", _total, "block int, part int, keys binary, totals binary")
    posted = B.with_answers(
        base, totals, n, lambda c, a: _post(c, a, n, rule),
        "part int, lists binary, sides binary, ids binary, sizes binary, signs binary")
    return B.on_groups(B.deal(posted, "part", n), "part", lambda t: _pairs(t, rule), "u long, v long").distinct()


# -- confirmation on full sets ----------------------------------------------------------------


def linked(percent: int, both: np.ndarray, one: np.ndarray, other: np.ndarray) -> np.ndarray:
    return 100 * both >= percent * (one + other - both)


def _confirm(percent: int):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u, v, a, b = batch.columns
            size_u, size_v, both, differences = [], [], [], []
            for x, y in zip(a, b):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                apart = np.setxor1d(x, y, assume_unique=True)
                size_u.append(len(x))
                size_v.append(len(y))
                both.append((len(x) + len(y) - len(apart)) // 2)
                differences.append(B.pack(apart))
            ok = linked(percent, *(np.array(x, np.int64) for x in (both, size_u, size_v)))
            yield pa.RecordBatch.from_arrays(
                [u, v, pa.array(size_v, pa.int64()), pa.array(ok, pa.bool_()), pa.array(differences, pa.binary())],
                ["u", "v", "n", "linked", "differences"])

    return step


def confirmed(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, rule: Rule) -> DataFrame:
    """(u, v, n, linked, differences): is each pair similar enough in its full shingle sets, the size of
    v, and the shingles that only one of the two has."""
    ids = pairs.select(F.explode(F.array("u", "v")).alias("id")).distinct()
    ids = ids.join(nodes, "id").select("doc_id").distinct()
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    # written, so that both joins shuffle plain rows and a centre of very many pairs can be split
    sets = pin(texts.join(ids, "doc_id", "left_semi").mapInArrow(_sets(rule.words), "id long, shingles binary").dropDuplicates(["id"]))
    left = sets.select(F.col("id").alias("v"), F.col("shingles").alias("b"))
    right = sets.select(F.col("id").alias("u"), F.col("shingles").alias("a"))
    return pairs.join(left, "v").join(right, "u").select("u", "v", "a", "b").mapInArrow(
        _confirm(rule.percent), "u long, v long, n long, linked boolean, differences binary")


def _compare_differences(percent: int):
    def step(table: pa.Table) -> pa.Table:
        """Links among the members of a centre, exactly, from what each differs in from the centre.

        What two sets differ in is what their differences differ in, so their common shingles follow
        from the number of common differences.  A member not linked with the centre shares a difference
        with all that it is linked with; the lists of its differences are merged by counting.  Links
        that join what is joined already are left out.
        """
        left, right = [], []
        table = table.sort_by([("u", "ascending"), ("low", "ascending"), ("high", "ascending"), ("v", "ascending")])
        u, low, high, side, v, n, ok = (table.column(c).to_numpy() for c in ("u", "low", "high", "side", "v", "n", "linked"))
        cells = table.column("differences").to_pylist()
        new = np.concatenate(([True], (u[1:] != u[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1]))) if len(u) else np.zeros(0, bool)
        starts = np.flatnonzero(new)
        for a, b in zip(starts.tolist(), np.append(starts[1:], len(u)).tolist()):
            lists = [np.frombuffer(c, np.uint64) for c in cells[a:b]]
            sizes = np.array([len(x) for x in lists])
            owner = np.repeat(np.arange(b - a), sizes)
            code = np.unique(np.concatenate(lists), return_inverse=True)[1].reshape(-1)
            by_code = np.argsort(code, kind="stable")
            heads = np.concatenate(([0], np.cumsum(np.bincount(code))))
            ends = np.cumsum(sizes)
            size, join_, sides, keys = n[a:b], ok[a:b], side[a:b], v[a:b]
            root = np.where(join_, -1, np.arange(b - a))  # those linked with the centre are one
            for x in np.flatnonzero(~join_):
                own = code[ends[x] - sizes[x] : ends[x]]
                met = owner[by_code[B.ranges(heads[own], heads[own + 1] - heads[own])]]
                apart = sizes[x] + sizes - 2 * np.bincount(met, minlength=b - a)
                both = (size[x] + size - apart) // 2
                hit = linked(percent, both, np.full(b - a, size[x]), size) & (root != root[x])
                if sides[x]:
                    hit &= sides != sides[x]
                for y in np.flatnonzero(hit):
                    if root[y] != root[x]:
                        left.append(keys[x])
                        right.append(keys[y])
                        old, to = root[x], root[y]
                        root[root == old] = to
        return pa.table({"u": pa.array(left, pa.int64()), "v": pa.array(right, pa.int64())})

    return step


def links_of_centres(found: DataFrame, rule: Rule) -> DataFrame:
    """Links (u, v) between members of the same centre; a centre's members meet in pieces."""
    n = B.parts(found.sparkSession)
    sizes = found.groupBy("u").agg(
        F.ceil(F.count(F.lit(1)) / LIST_BLOCK).cast("int").alias("pieces"), F.count(F.lit(1)).alias("members"),
        F.sum((~F.col("linked")).cast("int")).alias("open"))
    rows = found.join(sizes.where("members > 1 AND open > 0"), "u").withColumn(
        "mine", F.pmod(F.xxhash64("v"), F.col("pieces")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).select(
        "u", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"), "v", "n", "linked", "differences",
        F.when(F.col("mine") == F.col("other"), 0).when(F.col("mine") < F.col("other"), 1).otherwise(2).alias("side"))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("u", "low", "high"), F.lit(n)).cast("int"))
    return B.on_groups(B.deal(rows, "part", n), "part", _compare_differences(rule.percent), "u long, v long")


def near_duplicates(
    docs: DataFrame, percent: int = 80, words: int = 5, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """Group texts of which at least ``percent`` per cent of the word shingles are common.

    Words lie between ASCII white space, A-Z in lower case; a text's set has its distinct
    ``words``-word shingles (64-bit hashes), or its whole sequence if it has fewer words.  Texts with
    equal sets form one class, found by grouping on a key of the set.  A class posts its id under the
    coordinate-value pairs of its MinHash signature, rarest first and without the longest lists
    (see ``_post``).  In each list, centres are paired with the members that agree with them in
    ``Rule.matches`` of the coordinates, until every two members that agree share a centre.
    Pairs are confirmed on their full sets.  Members of one centre are compared exactly by their
    differences from it, so a large group of near copies costs a pair per member, not all pairs.

    Returns (doc_id, n_shingles, component_id, kept): component_id is the least id reachable over
    links, itself included, kept tells whether that is the row's own.  Null and empty texts have no
    shingles and are linked with nothing.  Rows that share an id are judged row by row: each gets
    the group of its own text.  Rows without id are left out of
    groups (component_id null, kept true).  Other columns are ignored.
    """
    rule = Rule(percent, words)
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("data"))
    prints = pin(texts.mapInArrow(_sign(words), "doc_id long, n_shingles long, key long, signature binary"))
    nodes = pin(
        prints.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy(F.col("key").alias("id"))
        .agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("signature").alias("signature"))
    )
    found = pin(confirmed(pin(candidates(nodes, rule)), nodes, texts, rule))
    links = found.where("linked").select("u", "v").unionByName(links_of_centres(found, rule))
    named = nodes.select("id", "doc_id").join(components(links), "id", "left").withColumn("component", F.coalesce("component", "id"))
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = named.join(least, "component").select(F.col("id").alias("key"), "component_id")
    own = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return prints.join(named, "key", "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), own).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)))


def drop_near_duplicates(
    docs: DataFrame, percent: int = 80, words: int = 5, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """``docs`` without those of which a near-duplicate with a smaller id stays.

    Rows that share an id go together, once none of them is kept.  The removed ids are broadcast if
    their number, counted first, allows it.
    """
    done = near_duplicates(docs, percent, words, text, doc_id)
    removed = pin(done.groupBy("doc_id").agg(F.max("kept").alias("kept")).where("NOT kept").select(F.col("doc_id").alias("_removed")))
    removed = F.broadcast(removed) if removed.count() <= BROADCAST_IDS else removed
    return docs.join(removed, docs[doc_id] == removed["_removed"], "left_anti")
