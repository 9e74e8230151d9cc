"""Embedding near-dedup by NN-descent (operator 8)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from sightline.session import pin

from . import blocks as B
from .components import components

NEIGHBOURS = 10
TABLES = 4  # sorted orders that give the first lists
PLANES = 10  # sign bits of such an order
WINDOW = 6  # neighbours on either side in it
CHUNK = 128  # vectors that meet at a node at a time
BLOCK = 1024  # members of a component that are compared in one piece
ROUNDS = 12
ATTEMPTS = 6
PROBES = 1024  # vectors with a planted neighbour, by which the recall is measured
FOUND = 0.999  # share of the probes that ends the descent at once
OUTWARD = 32  # passes from component to component at most
SEARCH_BLOCK = 8192  # vectors of one side of a full search that meet in one task
PART_BYTES = 4 << 20  # of vectors in a part, each of which is sent to all its neighbours

_NODE = "key long, label long, weight long, least_id long, vector binary"
_LISTS = "part int, keys binary, near binary, cosines binary"
_SEEN = _LISTS + ", u binary, v binary"  # with the pairs that the edges seen so far connect
_FAR = -2.0


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors that can be linked, in double precision, with a key of their label and numbers."""
    for batch in batches:
        ids, keys, labels, vectors = [], [], [], []
        for i, values, label in zip(*(c.to_pylist() for c in batch.columns)):
            key = vector = None
            if values and label is not None and all(v is not None for v in values):
                array = np.array(values, np.float64) + 0.0
                if np.isfinite(array).all() and array.any() and np.isfinite(array @ array) and array @ array > 0:
                    vector = array.tobytes()
                    digest = hashlib.blake2b(vector + str(label).encode(), digest_size=8).digest()
                    key = int.from_bytes(digest, "little", signed=True) & ~1  # odd keys are those of probes
            ids.append(i)
            keys.append(key)
            labels.append(None if label is None else int(label))
            vectors.append(vector)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(keys, pa.int64()), pa.array(labels, pa.int64()), pa.array(vectors, pa.binary())],
            ["vec_id", "key", "label", "vector"])


def _matrix(cells: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors of rows with equal dimension; shorter ones are filled with zeros."""
    width = max((len(c) for c in cells), default=8) // 8
    out = np.zeros((len(cells), width))
    for i, c in enumerate(cells):
        out[i, : len(c) // 8] = np.frombuffer(c, np.float64)
    norms = np.sqrt((out * out).sum(1))
    return out / norms[:, None], np.array([len(c) for c in cells])


def _cosines(x: np.ndarray, y: np.ndarray, dims: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    out = x @ y.T
    if dims is not None:
        out[dims[0][:, None] != dims[1][None, :]] = _FAR
    return out


def _best(keys: np.ndarray, near: np.ndarray, cosines: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lists of the ``most`` nearest of each key, from (key, neighbour, cosine) rows."""
    order = np.lexsort((B.mix(near.view(np.uint64) ^ keys.view(np.uint64)), -cosines, keys))
    keys, near, cosines = keys[order], near[order], cosines[order]
    # repeated neighbours have the same cosine and so the same place
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (near[1:] != near[:-1])
    keys, near, cosines = keys[new], near[new], cosines[new]
    starts = B.group_starts(keys)
    sizes = np.diff(np.append(starts, len(keys)))
    rank = np.arange(len(keys)) - np.repeat(starts, sizes)
    lists = np.zeros((len(starts), most), np.int64)
    values = np.full((len(starts), most), _FAR)
    row = np.repeat(np.arange(len(starts)), sizes)
    ok = rank < most
    lists[row[ok], rank[ok]], values[row[ok], rank[ok]] = near[ok], cosines[ok]
    return keys[starts], lists, values


def _order_keys(seed: int):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, _ = _matrix(batch.column(2).to_pylist())
            for t in range(TABLES):
                rng = np.random.default_rng([seed, t])
                planes = rng.standard_normal((max(x.shape[1], 4096), PLANES + 1))[: x.shape[1]]
                side = x @ planes
                code = ((side[:, :PLANES] > 0) @ (1 << np.arange(PLANES))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(x), t, np.int32)), batch.column(1), pa.array(code), pa.array(side[:, PLANES]),
                    batch.column(0), batch.column(3), batch.column(2)], ["t", "label", "code", "along", "key", "comp", "vector"])

    return step


def _windows(n: int):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in batches:
            # of a run of one component its ends are enough: they meet those before and after it
            place = [batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("t", "label", "code", "comp")]
            same = np.all([x[1:] == x[:-1] for x in place], axis=0)
            inner = np.zeros(batch.num_rows, bool)
            inner[1:-1] = same[1:] & same[:-1]
            batch = batch.filter(pa.array(~inner))
            table = pa.Table.from_batches([batch]) if before is None else pa.concat_tables([before, pa.Table.from_batches([batch])])
            before = table.slice(max(0, table.num_rows - WINDOW))
            x, dims = _matrix(table.column("vector").to_pylist())
            keys, t, label, comp = (table.column(c).to_numpy() for c in ("key", "t", "label", "comp"))
            left, right, cosines = [], [], []
            for gap in range(1, WINDOW + 1):
                a, b = slice(0, max(0, len(keys) - gap)), slice(gap, None)
                ok = (t[a] == t[b]) & (label[a] == label[b]) & (comp[a] != comp[b]) & (dims[a] == dims[b])
                value = (x[a] * x[b]).sum(1)[ok]
                left += [keys[a][ok], keys[b][ok]]
                right += [keys[b][ok], keys[a][ok]]
                cosines += [value, value]
            none = np.zeros(0, np.int64)
            yield from _to_parts(np.concatenate(left), np.concatenate(right), np.concatenate(cosines), n, none, none).to_batches()

    return step


def _to_parts(keys: np.ndarray, near: np.ndarray, cosines: np.ndarray, n: int, u: np.ndarray, v: np.ndarray) -> pa.Table:
    """(key, neighbour, cosine) rows packed for the parts of their keys, and pairs (u, v) for those of u."""
    order, edges = B.by_part(B.part_of(keys.view(np.uint64), n), n)
    order_u, edges_u = B.by_part(B.part_of(u.view(np.uint64), n), n)
    full = [p for p in range(n) if edges[p] < edges[p + 1] or edges_u[p] < edges_u[p + 1]]
    cut = lambda x, order, edges: pa.array([B.pack(x[order[edges[p] : edges[p + 1]]]) for p in full], pa.binary())
    return pa.table({
        "part": pa.array(full, pa.int32()), "keys": cut(keys, order, edges), "near": cut(near, order, edges),
        "cosines": cut(cosines, order, edges), "u": cut(u, order_u, edges_u), "v": cut(v, order_u, edges_u)})


def _unpack(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    empty = np.zeros(0, np.int64)
    return tuple(
        np.concatenate([empty.astype(t), *B.cells(table, c, t)])
        for c, t in (("keys", np.int64), ("near", np.int64), ("cosines", np.float64)))


def _keep_best(most: int, threshold: float):
    def step(lists: pa.Table, news: pa.Table) -> pa.Table:
        """Merge new neighbours into the lists of a part; edges stay seen when a list drops them."""
        table = lists if lists.num_rows else news
        old, new = _unpack(lists), _unpack(news)
        keys, near, cosines = (np.concatenate(x) for x in zip(old, new))
        edge = (cosines >= threshold) & ((keys | near) & 1 == 0)  # probes connect nothing
        ends = [np.concatenate([own[edge], *B.cells(lists, c, np.int64), *B.cells(news, c, np.int64)]) for own, c in ((keys, "u"), (near, "v"))]
        u, v = _forest(*ends)
        keys, near, cosines = _best(keys, near, cosines, most)
        full = cosines[:, -1] >= threshold  # such a list may lack links
        probe = keys & 1 == 1
        # a probe is found if it is linked with its own vector, or with nothing but near copies
        found = int((probe & (full | ((near == (keys ^ 1)[:, None]) & (cosines >= threshold)).any(1))).sum())
        saturated = keys[full & ~probe]
        flat = cosines.reshape(-1)
        ok = flat > _FAR
        keys, near, flat = np.repeat(keys, most)[ok], near.reshape(-1)[ok], flat[ok]
        return pa.table({
            "part": pa.array([table.column("part")[0].as_py()], pa.int32()),
            "keys": pa.array([B.pack(keys)], pa.binary()), "near": pa.array([B.pack(near)], pa.binary()),
            "cosines": pa.array([B.pack(flat)], pa.binary()), "u": pa.array([B.pack(u)], pa.binary()),
            "v": pa.array([B.pack(v)], pa.binary()), "saturated": pa.array([B.pack(saturated)], pa.binary()),
            "total": pa.array([float(flat.sum())]), "found": pa.array([found], pa.int64())})

    return step


def _visit(n: int, most: int):
    def step(nodes: pa.Table, lists: pa.Table) -> pa.Table:
        """Each vector goes to its neighbours, with the least cosine of its full list."""
        out: dict[str, list] = {k: [] for k in ("part", "places", "keys", "comps", "floors", "vectors", "widths")}
        if nodes.num_rows and lists.num_rows:
            keys, near, cosines = _unpack(lists)
            own = nodes.column("key").to_numpy()
            at = np.argsort(own)
            row = at[np.minimum(np.searchsorted(own[at], keys), len(own) - 1)]
            starts = B.group_starts(keys)
            sizes = np.diff(np.append(starts, len(keys)))
            floor = np.where(sizes >= most, np.minimum.reduceat(cosines, starts), _FAR)
            floor = np.repeat(floor, sizes)
            vectors, comps = nodes.column("vector").to_pylist(), nodes.column("comp").to_numpy()
            order, edges = B.by_part(B.part_of(near.view(np.uint64), n), n)
            for p in range(n):
                i = order[edges[p] : edges[p + 1]]
                if len(i):
                    cells = [vectors[r] for r in row[i]]
                    out["part"].append(p)
                    out["places"].append(B.pack(near[i]))
                    out["keys"].append(B.pack(keys[i]))
                    out["comps"].append(B.pack(comps[row[i]]))
                    out["floors"].append(B.pack(floor[i]))
                    out["vectors"].append(b"".join(cells))
                    out["widths"].append(B.pack(np.array([len(c) for c in cells], np.uint32)))
        return pa.table({k: pa.array(v, pa.int32() if k == "part" else pa.binary()) for k, v in out.items()})

    return step


def _cells_of(table: pa.Table) -> list[bytes]:
    out = []
    for data, widths in zip(table.column("vectors").to_pylist(), B.cells(table, "widths", np.uint32)):
        edge = np.concatenate(([0], np.cumsum(widths, dtype=np.int64))).tolist()
        out += [data[a:b] for a, b in zip(edge, edge[1:])]
    return out


def _meet(n: int, most: int, threshold: float):
    def step(table: pa.Table) -> pa.Table:
        """Vectors that chose one node as neighbour are compared with each other there, piece by piece."""
        join = lambda c, t: np.concatenate(B.cells(table, c, t))
        places, keys, comps, floors = join("places", np.int64), join("keys", np.int64), join("comps", np.int64), join("floors", np.float64)
        x, dims = _matrix(_cells_of(table))
        order = np.lexsort((B.mix(keys.view(np.uint64)), places))
        starts = B.group_starts(places[order])
        none = np.zeros(0, np.int64)
        left, right, cosines, us, vs = [none], [none], [np.zeros(0)], [none], [none]
        waiting, merged = 0, 0
        for a, b in zip(starts.tolist(), np.append(starts[1:], len(order)).tolist()):
            if b - a < 2:
                continue
            pieces = [order[c : min(c + CHUNK, b)] for c in range(a, b, CHUNK)]
            for at in pieces:
                for to in pieces:
                    s = _cosines(x[at], x[to], (dims[at], dims[to]))
                    s[comps[at][:, None] == comps[to][None, :]] = _FAR
                    i, j = np.nonzero((s >= threshold) & ((keys[at][:, None] | keys[to][None, :]) & 1 == 0))
                    us.append(keys[at[i]])
                    vs.append(keys[to[j]])
                    waiting += len(i)
                    if waiting > merged + (1 << 20):
                        u, v = _forest(np.concatenate(us), np.concatenate(vs))
                        us, vs, waiting, merged = [u], [v], len(u), len(u)
                    if len(to) > most + 1:
                        limit = np.partition(s, -most, axis=1)[:, -most]
                        s[s < limit[:, None]] = _FAR
                    i, j = np.nonzero(s > floors[at][:, None])
                    left.append(keys[at[i]])
                    right.append(keys[to[j]])
                    cosines.append(s[i, j])
        u, v = _forest(np.concatenate(us), np.concatenate(vs))
        return _to_parts(np.concatenate(left), np.concatenate(right), np.concatenate(cosines), n, u, v)

    return step


def first_lists(nodes: DataFrame, most: int, seed: int) -> DataFrame:
    """Neighbours of sorted orders: by label, signs of random projections and one more projection.

    The orders are range-partitioned, so vectors that are all alike spread over many tasks.  Nodes of
    one ``comp`` are no neighbours.
    """
    n = _number(nodes)
    keyed = nodes.select("key", "label", "vector", "comp").mapInArrow(
        _order_keys(seed), "t int, label long, code int, along double, key long, comp long, vector binary")
    order = ["t", "label", "code", "along", "key"]
    found = keyed.repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(_windows(n), _SEEN)
    return found


def _merged(lists: DataFrame | None, news: DataFrame, n: int, most: int, threshold: float) -> DataFrame:
    right = B.deal(news, "part", n).groupBy("part")
    left = B.deal(lists.drop("saturated", "total", "found") if lists is not None else news.limit(0), "part", n).groupBy("part")
    return pin(left.cogroup(right).applyInArrow(_keep_best(most, threshold), _SEEN + ", saturated binary, total double, found long"))


def descend(nodes: DataFrame, lists: DataFrame, most: int, threshold: float, asked: int = 0) -> DataFrame:
    """Refine the lists until a round raises the sum of their cosines by less than 0.1 per cent, or, with
    ``asked`` probes, by less than 5 per cent and finds no further probe, or until nearly all probes are
    found and a further round has been made."""
    n = _number(nodes)
    base = B.deal(nodes.select("part", "key", "vector", "comp"), "part", n).groupBy("part")
    total, found = (x or 0 for x in lists.agg(F.sum("total"), F.sum("found")).first())
    for _ in range(ROUNDS):
        sent = base.cogroup(B.deal(lists.drop("u", "v", "saturated", "found"), "part", n).groupBy("part")).applyInArrow(
            _visit(n, most), "part int, places binary, keys binary, comps binary, floors binary, vectors binary, widths binary")
        news = B.on_groups(B.deal(sent, "part", n), "part", _meet(n, most, threshold), _SEEN)
        lists = _merged(lists, news, n, most, threshold)
        before, met, known = total, found, asked and found >= FOUND * asked
        total, found = (x or 0 for x in lists.agg(F.sum("total"), F.sum("found")).first())
        if known or total - before <= (0.05 if asked and found <= met else 0.001) * abs(total):
            break
    return lists


def _saturated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = np.concatenate([np.zeros(0, np.int64), *B.cells(pa.Table.from_batches([batch]), "saturated", np.int64)])
        yield pa.RecordBatch.from_arrays([pa.array(keys)], ["key"])


def _links(threshold: float):
    def step(table: pa.Table) -> pa.Table:
        """Weights linked with each member, within a component or between two of its pieces."""
        x, dims = _matrix(table.column("vector").to_pylist())
        key, weight, side = (table.column(c).to_numpy() for c in ("key", "weight", "side"))
        one, two = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        links = np.zeros(len(key), np.int64)
        if len(two):
            s = _cosines(x[one], x[two], (dims[one], dims[two])) >= threshold
            links[one], links[two] = s @ weight[two], weight[one] @ s
        else:
            s = _cosines(x, x, (dims, dims)) >= threshold
            np.fill_diagonal(s, False)
            links = s @ weight
        return pa.table({"key": pa.array(key), "links": pa.array(links, pa.int64())})

    return step


def component_links(nodes: DataFrame, groups: DataFrame, threshold: float) -> DataFrame:
    """Exact links of every member of a component: a full list is enlarged to the whole component.

    A component is dealt into pieces of about BLOCK members; each piece meets itself and each other
    piece once, and only sums of links leave a task.
    """
    sizes = groups.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("pieces"))
    rows = nodes.join(groups, "key").join(sizes, "component").withColumn("mine", F.pmod(F.xxhash64("key"), F.col("pieces")).cast("int"))
    rows = rows.select("component", "key", "weight", "vector", "mine", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("other"))
    pair = rows.select(
        "component", F.least("mine", "other").alias("a"), F.greatest("mine", "other").alias("b"), "key", "weight", "vector",
        F.when(F.col("mine") <= F.col("other"), 0).otherwise(1).alias("side"))
    found = pair.groupBy("component", "a", "b").applyInArrow(_links(threshold), "key long, links long")
    return found.groupBy("key").agg(F.sum("links").alias("links"))


def _forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """At most one pair for each id, which connect the same ids as the pairs given."""
    ids, at = np.unique(np.concatenate((u, v)), return_inverse=True)
    a, b = at.reshape(-1)[: len(u)], at.reshape(-1)[len(u) :]
    root = np.arange(len(ids))
    while len(a):
        x, y = root[a], root[b]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]
        open_ = root[a] != root[b]
        a, b = a[open_], b[open_]
    ok = root != np.arange(len(ids))
    return ids[ok], ids[root[ok]]


def _search(threshold: float):
    def step(table: pa.Table) -> pa.Table:
        """Links between a block of queries and a block of nodes, as a forest, and their numbers."""
        x, dims = _matrix(table.column("vector").to_pylist())
        key, component, side = (table.column(c).to_numpy() for c in ("key", "component", "side"))
        one, two = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        u, v, found, total = np.zeros(0, np.int64), np.zeros(0, np.int64), 0, 0
        for c in range(0, len(one) if len(two) else 0, CHUNK):
            at = one[c : c + CHUNK]
            s = _cosines(x[at], x[two], (dims[at], dims[two])) >= threshold
            i, j = np.nonzero(s & (key[at][:, None] != key[two][None, :]))
            i, j = at[i], two[j]
            total += len(i)
            found += int((component[i] == component[j]).sum())
            u, v = _forest(np.concatenate((u, key[i])), np.concatenate((v, key[j])))
        return pa.table({
            "u": pa.array([B.pack(u)], pa.binary()), "v": pa.array([B.pack(v)], pa.binary()),
            "found": pa.array([found], pa.int64()), "total": pa.array([total], pa.int64())})

    return step


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of packed pairs."""
    for batch in batches:
        table = pa.Table.from_batches([batch])
        u, v = (np.concatenate([np.zeros(0, np.int64), *B.cells(table, c, np.int64)]) for c in ("u", "v"))
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])


def search(queries: DataFrame, nodes: DataFrame, groups: DataFrame, threshold: float) -> DataFrame:
    """All links of ``queries``, a part of ``nodes``: every query meets every node of its label.

    Both sides are dealt into pieces of about SEARCH_BLOCK; each row (u, v, found, total) holds a forest of the
    links of two pieces, their number and how many of them lie inside a component of ``groups``.
    """
    named = lambda df: df.join(groups, "key", "left").select(
        "key", "label", "vector", F.coalesce("component", "key").alias("component"))
    pieces = lambda df, name: df.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / SEARCH_BLOCK).cast("int").alias(name))
    counts = pin(pieces(queries, "asked").join(pieces(nodes, "all"), "label"))
    mine = lambda of: F.pmod(F.xxhash64("key", F.lit(3)), F.col(of)).cast("int")
    every = lambda of: F.explode(F.sequence(F.lit(0), F.col(of) - 1))
    columns = ["label", "key", "component", "vector"]
    left = named(queries).join(counts, "label").select(*columns, F.lit(0).alias("side"), mine("asked").alias("a"), every("all").alias("b"))
    right = named(nodes).join(counts, "label").select(*columns, F.lit(1).alias("side"), every("asked").alias("a"), mine("all").alias("b"))
    return pin(left.unionByName(right).groupBy("label", "a", "b").applyInArrow(_search(threshold), "u binary, v binary, found long, total long"))


def probes(nodes: DataFrame, threshold: float, seed: int, most: int = PROBES) -> DataFrame:
    """Up to ``most`` nodes, by hash, each turned by a known angle: its cosine with the original lies
    evenly between the threshold and 1.  A probe's key is that of its original with the last bit set."""
    chosen = nodes.orderBy(F.xxhash64("key", F.lit(seed)), "key").limit(most)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, cells = [], []
            for key, cell in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                x = np.frombuffer(cell, np.float64)
                rng = np.random.default_rng([seed, key & 0xFFFFFFFFFFFF])
                x = x / np.sqrt(x @ x)
                aside = rng.standard_normal(len(x))
                aside -= (aside @ x) * x
                length = np.sqrt(aside @ aside)
                cosine = threshold + (1 - threshold) * (0.001 + 0.998 * rng.random())
                turned = cosine * x + np.sqrt(1 - cosine * cosine) * aside / length if length > 1e-9 else x
                keys.append(key | 1)
                cells.append(turned.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), batch.column(1), pa.array(cells, pa.binary()), pa.array(keys, pa.int64())],
                ["key", "label", "vector", "comp"])

    return chosen.select("key", "label", "vector").mapInArrow(step, "key long, label long, vector binary, comp long")


def outward(nodes: DataFrame, edges: DataFrame, full: DataFrame, most: int, threshold: float, seed: int) -> DataFrame:
    """Components after the full lists of ``full`` (key) have been enlarged outwards.

    A list full of links is full of its own clump, and what it may lack are links with others.  So
    nodes with full lists get new ones, of nodes outside their component only; a clump stands in the
    sorted orders by the ends of its runs.  Found edges join components, and lists that are full again
    go on, until none is full or nothing is found.  Only links between two nodes with full lists
    depend on this: of all others, one end had room.
    """
    groups = components(edges.mapInArrow(_pairs, "u long, v long")).withColumnRenamed("id", "key")
    for level in range(OUTWARD):
        full = pin(full)
        if full.isEmpty():
            break
        own = pin(nodes.drop("comp").join(full, "key", "left_semi").join(groups.withColumnRenamed("component", "comp"), "key"))
        n = parts_for(own.select(F.length("vector").alias("size")))
        own = pin(in_parts(own, n))
        lists = descend(own, _merged(None, first_lists(own, most, seed + 100 + level), n, most, threshold), most, threshold)
        if not lists.agg(F.sum(F.length("u"))).first()[0]:
            break
        # each node and its component stand for all edges before, so no level adds to the next one's input
        known = groups.select(F.col("key").alias("u"), F.col("component").alias("v"))
        found = lists.select("u", "v").mapInArrow(_pairs, "u long, v long")
        groups = components(known.unionByName(found)).withColumnRenamed("id", "key")
        full = lists.select("saturated").mapInArrow(_saturated, "key long")
    return groups


def near_vectors(
    vectors: DataFrame, threshold: float = 0.98, neighbours: int = NEIGHBOURS, recall: float = 0.99, seed: int = 8,
    vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", exhaustive: bool = False,
) -> DataFrame:
    """Link vectors of one label with a cosine of at least ``threshold``.

    Equal vectors of a label form one node.  Nodes get first neighbour lists from sorted orders
    (``first_lists``), which NN-descent refines: each node visits its neighbours, and nodes that meet
    at one are compared and enter each other's lists.  Every edge above the threshold that a round sees
    is kept, as pairs that connect the same nodes, also where a list drops it.  A list whose worst cosine
    is still above the threshold is enlarged by neighbours outside its component (``outward``).  The
    edges give components, and links are counted in each of them exactly (``component_links``).

    The recall is audited by probes: ``PROBES`` vectors get a planted neighbour at a known cosine, which
    takes part in the descent without connecting anything, and the share of them that is found tells
    how many of the true links are.  Other sorted orders join once if it is below ``FOUND``, and as long
    as it is below ``recall``, when lists also grow by half, at most five times; if that is not enough,
    or with ``exhaustive``, every vector is compared with its whole label (``search``).

    Returns (vec_id, n_links, component_id, kept).  Vectors that are null, empty, zero or hold null or
    non-finite numbers, and vectors without label, link with nothing; vectors of different dimension
    do not link.  Rows that share an id are separate vectors.  Rows without id count as links but have
    no component_id of their own.  Other columns are ignored.
    """
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding), F.col(label).cast("long").alias("label"))
    read = pin(rows.mapInArrow(_read, "vec_id long, key long, label long, vector binary"))
    valid = read.where("key IS NOT NULL")
    weights = valid.groupBy("key").agg(
        F.first("label").alias("label"), F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("least_id"), F.first("vector").alias("vector"))
    n = parts_for(valid.groupBy("key").agg(F.max(F.length("vector")).alias("size")))
    nodes = pin(weights.withColumn("comp", F.col("key")).transform(in_parts, n))
    if exhaustive:
        groups = _searched(nodes, threshold)
    else:
        planted = probes(nodes, threshold, seed).transform(in_parts, n)
        both = pin(nodes.select(*planted.columns).unionByName(planted))
        asked, lists, most = both.where(F.col("key").bitwiseAND(F.lit(1)) == 1).count(), None, neighbours
        for attempt in range(ATTEMPTS):
            lists = _merged(lists, first_lists(both, most, seed + attempt), n, most, threshold)
            lists = descend(both, lists, most, threshold, asked)
            found = lists.agg(F.sum("found")).first()[0] or 0
            if found >= FOUND * asked or attempt and found >= recall * asked:
                full = lists.select("saturated").mapInArrow(_saturated, "key long")
                groups = outward(nodes, lists.select("u", "v"), full, most, threshold, seed)
                break
            most += most // 2 if found < recall * asked else 0
        else:
            groups = _searched(nodes, threshold)
    links = component_links(nodes, groups, threshold)
    names = nodes.select("key", "weight", "least_id").join(groups, "key", "left").withColumn("component", F.coalesce("component", "key"))
    least = names.groupBy("component").agg(F.min("least_id").alias("component_id"))
    told = names.join(least, "component").join(links, "key", "left").select(
        "key", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id")
    out = read.select("vec_id", "key").join(told, "key", "left")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _searched(nodes: DataFrame, threshold: float) -> DataFrame:
    """Components of all links, by comparing every node with its whole label."""
    nothing = nodes.select("key", F.col("key").alias("component")).limit(0)
    edges = search(nodes, nodes, nothing, threshold).select("u", "v").mapInArrow(_pairs, "u long, v long")
    return components(edges).withColumnRenamed("id", "key")


def parts_for(sizes: DataFrame) -> int:
    """How many parts vectors of these sizes (``size`` in bytes) fill.

    A part is a task in every step of every round, of which the driver keeps account, and sends a row to
    each other part.  So their number follows the vectors and not the session: two a core at least, and
    at most as many as there are shuffle partitions.
    """
    spark = sizes.sparkSession
    filled = -(-(sizes.agg(F.sum("size")).first()[0] or 0) // PART_BYTES)
    return min(B.parts(spark), max(2 * spark.sparkContext.defaultParallelism, filled))


def in_parts(nodes: DataFrame, n: int) -> DataFrame:
    """``nodes`` with the part of each key; the column's metadata hold the number of parts."""
    rows = nodes.drop("part").withColumn("part", F.lit(0))
    part = StructField("part", IntegerType(), True, {"parts": n})
    return rows.mapInArrow(_own_part(n), StructType([*rows.drop("part").schema, part]))


def _number(nodes: DataFrame) -> int:
    return nodes.schema["part"].metadata["parts"]


def _own_part(n: int):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("part")
            part = B.part_of(batch.column(batch.schema.get_field_index("key")).to_numpy().view(np.uint64), n)
            yield batch.set_column(at, "part", pa.array(part.astype(np.int32)))

    return step
