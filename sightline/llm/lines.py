"""Line dedup by a segment-partition edit join (operator 2)."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks as B

LIST_BLOCK = 1024  # lines of one segment that are compared in one piece


@dataclass(frozen=True)
class Spec:
    edits: int  # lines this near count as copies
    shortest: int  # shorter lines, in bytes, are not compared by edits
    exact: int  # exact copies of lines that are not blank and have so many bytes are found


# -- edit distance ----------------------------------------------------------------------------


def near(a: bytes, b: bytes, edits: int) -> bool:
    """Is the edit distance at most ``edits``?  Bit-parallel over a band of 2 * edits + 1 diagonals.

    A column of the band is a word whose bit k stands for the row (column - edits + k); ``up`` and
    ``down`` hold where the distance rises or falls from one row to the next.
    """
    if abs(len(a) - len(b)) > edits:
        return False
    if a == b:
        return True
    low, end = 0, min(len(a), len(b))
    step = 64
    while low < end and a[low : low + step] == b[low : low + step]:
        low += step
    low = min(low, end)
    while low < end and a[low] == b[low]:
        low += 1
    i, j = len(a), len(b)
    while i - step >= low and j - step >= low and a[i - step : i] == b[j - step : j]:
        i, j = i - step, j - step
    while i > low and j > low and a[i - 1] == b[j - 1]:
        i, j = i - 1, j - 1
    a, b = a[low:i], b[low:j]
    m, n = len(a), len(b)
    if not m or not n:
        return max(m, n) <= edits
    rows: dict[int, int] = {}
    for k, c in enumerate(a):
        rows[c] = rows.get(c, 0) | 1 << k
    width = 2 * edits + 1
    mask, bottom = (1 << width) - 1, 1 << (width - 1)
    up, down = mask & ~((1 << edits) - 1), 0
    distance = min(m, edits)
    for column in range(1, n + 1):
        shift = column - edits - 1
        own = rows.get(b[column - 1], 0)
        same = (own >> shift if shift >= 0 else own << -shift) & mask
        flat = ((((same & up) + up) ^ up) | same | down) & mask  # no change along the diagonal
        right_up = (down | ~(flat | up)) & mask
        right_down = flat & up
        if column + edits <= m:
            distance += not flat & bottom
        else:
            last = 1 << (m - column + edits)
            distance += bool(right_up & last) - bool(right_down & last)
        if distance - (n - column) > edits and column + edits > m:
            return False
        up = (right_down | ~((flat >> 1) | right_up)) & mask
        down = (flat >> 1) & right_up
    return distance <= edits


# -- blocks -----------------------------------------------------------------------------------


@dataclass
class Block:
    number: int
    ids: np.ndarray
    lines: list[list[bytes]]
    distinct: list[bytes]  # long enough lines of the block, for exact copies, in order of first place
    docs: np.ndarray  # document id and line number of the first place of each
    places: np.ndarray


def load(table: pa.Table, spec: Spec) -> Block:
    number, ids, texts = B.read_block(table)
    lines = [t.split(b"\n") for t in texts]
    known: dict[bytes, int] = {}
    docs, places = [], []
    for d, own in enumerate(lines):
        for i, line in enumerate(own):
            if (len(line) >= spec.shortest or (len(line) >= spec.exact and line.strip())) and line not in known:
                known[line] = len(known)
                docs.append(ids[d])
                # rows that share an id follow each other: a later row's lines come after
                places.append((d << 32) + i)
    return Block(number, ids, lines, list(known), np.array(docs, np.int64), np.array(places, np.int64))


def segments(lengths: np.ndarray, i: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and size of segment ``i`` of ``n``; sizes differ by one at most, the last are longer."""
    size, longer = lengths // n, lengths % n
    return i * size + np.maximum(i - (n - longer), 0), size + (i >= n - longer)


def line_keys(lines: list[bytes], spec: Spec) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of the segments of each line (one column a segment), and the probes: keys and lines.

    A line within ``edits`` edits keeps one of the edits + 1 segments of a shorter or equal one
    whole.  A probe is a substring that may be such a segment: for every length the other line may
    have and each of its segments, those starts that leave few enough edits on either side.  The
    start of a line's own segment is not probed, as two equal segments meet by themselves.
    """
    n = spec.edits + 1
    own = np.zeros((len(lines), n), np.uint64)
    probes, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    sizes = np.array([len(x) for x in lines], np.int64)
    begins = np.cumsum(sizes) - sizes
    total = int(sizes.sum())
    for i, j, begin, end in B.slices(begins, total):
        data = np.frombuffer(b"".join(lines[i:j]), np.uint8).astype(np.uint64) + np.uint64(1)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(data * B.powers(B.BASE, end - begin), dtype=np.uint64)))
        inverse = B.powers(B.BASE_INVERSE, end - begin)
        at, length = begins[i:j] - begin, sizes[i:j]

        def key(start: np.ndarray, size: np.ndarray, other: np.ndarray, k: int) -> np.ndarray:
            value = (sums[start + size] - sums[start]) * inverse[np.minimum(start, end - begin - 1)]
            return B.mix(value ^ B.mix((other.astype(np.uint64) << np.uint64(8)) | np.uint64(k)))

        for k in range(n):
            start, size = segments(length, k, n)
            own[i:j, k] = key(at + start, size, length, k)
        for less in range(spec.edits + 1):
            other = length - less
            for k in range(n):
                start, size = segments(other, k, n)
                for shift in range(max(-k, less - (spec.edits - k)), min(k, less + spec.edits - k) + 1):
                    if less == 0 and shift == 0:
                        continue
                    ok = np.flatnonzero((start + shift >= 0) & (start + shift + size <= length) & (other >= spec.shortest))
                    probes.append(key(at[ok] + start[ok] + shift, size[ok], other[ok], k))
                    owners.append(ok + i)
    return own, np.concatenate(probes), np.concatenate(owners)


def _cells(n: int, number: int, memo: bytes, columns: dict[str, dict[int, bytes]]) -> pa.Table:
    """One row for each part with content; the part of the block's own number brings the memo back."""
    at = sorted({number, *[p for c in columns.values() for p in c]})
    return pa.table({
        "part": pa.array(at, pa.int32()), "block": pa.array([number] * len(at), pa.int32()),
        "memo": pa.array([memo if p == number else None for p in at], pa.binary()),
        **{k: pa.array([c.get(p, b"") for p in at], pa.binary()) for k, c in columns.items()},
    })


def _memo(answers: pa.Table) -> bytes:
    return next(m for m in answers.column("memo").to_pylist() if m is not None)


def _by_part(keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    order, edges = B.by_part(B.part_of(keys, n), n)
    return order, edges, [p for p in range(n) if edges[p] < edges[p + 1]]


def _joined(block: Block, first: np.ndarray, spec: Spec) -> np.ndarray:
    """The first lines of their copies that are long enough for the edit join."""
    return np.flatnonzero(first & np.array([len(x) >= spec.shortest for x in block.distinct], bool))


def _digests(block: Block) -> np.ndarray:
    return np.frombuffer(b"".join(hashlib.blake2b(x, digest_size=16).digest() for x in block.distinct), np.uint64).reshape(-1, 2)


def send_digests(table: pa.Table, spec: Spec, n: int) -> pa.Table:
    block = load(table, spec)
    digest = _digests(block)
    order, edges, full = _by_part(digest[:, 0], n)
    cut = lambda x: {p: B.pack(x[order[edges[p] : edges[p + 1]]]) for p in full}
    return _cells(n, block.number, b"", {"digests": cut(digest), "docs": cut(block.docs), "places": cut(block.places)})


def find_first(table: pa.Table) -> pa.Table:
    """Which lines of each block are the first of their copies in all blocks."""
    digests = [np.frombuffer(x, np.uint64).reshape(-1, 2) for x in table.column("digests").to_pylist()]
    every = np.concatenate(digests)
    docs, places = (np.concatenate(B.cells(table, c, np.int64)) for c in ("docs", "places"))
    order = np.lexsort((places, docs, every[:, 1], every[:, 0]))
    ordered = every[order]
    first = np.zeros(len(every), bool)
    if len(every):
        new = np.concatenate(([True], (ordered[1:] != ordered[:-1]).any(1)))
        first[order] = new
    cuts = np.split(first, np.cumsum([len(d) for d in digests])[:-1])
    return _answer(table, bits=[B.pack(np.packbits(c)) for c in cuts])


def _answer(table: pa.Table, **columns: list[bytes]) -> pa.Table:
    return pa.table({
        "block": table.column("block"), "part": table.column("part"), "memo": table.column("memo"),
        **{k: pa.array(v, pa.binary()) for k, v in columns.items()},
    })


def _bits(answers: pa.Table, edges: np.ndarray, total: int, column: str = "bits") -> np.ndarray:
    """The bits of all parts in the order by part."""
    out = np.zeros(total, bool)
    for p, cell in zip(answers.column("part").to_pylist(), answers.column(column).to_pylist()):
        size = edges[p + 1] - edges[p]
        out[edges[p] : edges[p + 1]] = np.unpackbits(np.frombuffer(cell, np.uint8), count=size)
    return out


def send_segments(table: pa.Table, answers: pa.Table, spec: Spec, n: int) -> pa.Table:
    """Segment and probe keys of the lines that are the first of their copies."""
    if not table.num_rows:
        return _cells(n, 0, b"", {"own": {}, "probes": {}}).slice(0, 0)
    block = load(table, spec)
    order, edges, _ = _by_part(_digests(block)[:, 0], n)
    first = np.zeros(len(block.distinct), bool)
    first[order] = _bits(answers, edges, len(order))
    own, probes, _ = line_keys([block.distinct[i] for i in _joined(block, first, spec)], spec)
    columns = {}
    for name, keys in (("own", own.reshape(-1)), ("probes", probes)):
        order, edges, full = _by_part(keys, n)
        columns[name] = {p: B.pack(keys[order[edges[p] : edges[p + 1]]]) for p in full}
    return _cells(n, block.number, B.pack(np.packbits(first)), columns)


def meet(table: pa.Table) -> pa.Table:
    """How many keys each segment meets: other segments and probes; and each probe: segments."""
    own, probes = B.cells(table, "own", np.uint64), B.cells(table, "probes", np.uint64)
    all_own, all_probes = np.sort(np.concatenate(own)), np.sort(np.concatenate(probes))
    count = lambda where, keys: np.searchsorted(where, keys, "right") - np.searchsorted(where, keys, "left")
    segments_, probed = [], []
    for a, b in zip(own, probes):
        met, asked = count(all_own, a), count(all_probes, a)
        segments_.append(B.pack(np.where(met + asked > 1, met + asked, 0).astype(np.uint32)))
        met = count(all_own, b)
        probed.append(B.pack(np.where(met, met + count(all_probes, b), 0).astype(np.uint32)))
    return _answer(table, own=segments_, probes=probed)


def send_lines(table: pa.Table, answers: pa.Table, spec: Spec, n: int) -> pa.Table:
    """The lines whose keys met others, with these keys, to the parts of the keys."""
    names = ("keys", "kinds", "lines", "data", "sizes", "docs", "places")
    if not table.num_rows:
        return _cells(n, 0, b"", {k: {} for k in names}).slice(0, 0)
    block = load(table, spec)
    memo = _memo(answers)
    first = np.unpackbits(np.frombuffer(memo, np.uint8), count=len(block.distinct)).astype(bool)
    chosen = _joined(block, first, spec)
    own, probes, owners = line_keys([block.distinct[i] for i in chosen], spec)
    totals = []
    for name, keys in (("own", own.reshape(-1)), ("probes", probes)):
        order, edges, _ = _by_part(keys, n)
        met = np.zeros(len(keys), np.int64)
        for p, cell in zip(answers.column("part").to_pylist(), B.cells(answers, name, np.uint32)):
            met[order[edges[p] : edges[p + 1]]] = cell
        totals.append(met)
    keys = np.concatenate((own.reshape(-1), probes))
    kinds = np.concatenate((np.zeros(own.size, np.uint8), np.ones(len(probes), np.uint8)))
    line = chosen[np.concatenate((np.repeat(np.arange(len(chosen)), own.shape[1]), owners))] if len(chosen) else owners
    total = np.concatenate(totals)
    hit = total > 0
    keys, kinds, line, total = keys[hit], kinds[hit], line[hit], total[hit]
    # long lists go in pieces, each to all pairs of pieces that have its own
    pieces = -(-total // LIST_BLOCK)
    mine = (B.mix(line.astype(np.uint64) + np.uint64(block.number << 32)) % pieces.astype(np.uint64)).astype(np.int64)
    take = np.repeat(np.arange(len(keys)), pieces)
    other = B.ranges(np.zeros(len(pieces), np.int64), pieces)
    low, high = np.minimum(mine[take], other), np.maximum(mine[take], other)
    keys = B.mix(keys[take] + B.mix((low.astype(np.uint64) << np.uint64(32)) | high.astype(np.uint64)))
    kinds, line = kinds[take], line[take]
    order, edges, full = _by_part(keys, n)
    columns: dict[str, dict[int, bytes]] = {k: {} for k in names}
    for p in full:
        at = order[edges[p] : edges[p + 1]]
        sent, place = np.unique(line[at], return_inverse=True)
        columns["keys"][p], columns["kinds"][p] = B.pack(keys[at]), B.pack(kinds[at])
        columns["lines"][p] = B.pack(place.reshape(-1).astype(np.uint32))
        texts = [block.distinct[i] for i in sent]
        columns["data"][p] = b"".join(texts)
        columns["sizes"][p] = B.pack(np.array([len(x) for x in texts], np.uint32))
        columns["docs"][p], columns["places"][p] = B.pack(block.docs[sent]), B.pack(block.places[sent])
        columns.setdefault("sent", {})[p] = B.pack(sent.astype(np.uint32))
    columns.setdefault("sent", {})
    return _cells(n, block.number, memo, columns)


def verify(table: pa.Table, spec: Spec) -> pa.Table:
    """Which of the lines sent have an earlier line within the edits."""
    cells = {c: B.cells(table, c, t) for c, t in (
        ("keys", np.uint64), ("kinds", np.uint8), ("lines", np.uint32), ("sizes", np.uint32), ("docs", np.int64), ("places", np.int64), ("sent", np.uint32))}
    texts: list[bytes] = []
    base = []
    for data, sizes in zip(table.column("data").to_pylist(), cells["sizes"]):
        base.append(len(texts))
        edge = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64))).tolist()
        texts += [data[a:b] for a, b in zip(edge, edge[1:])]
    docs, places = np.concatenate(cells["docs"]), np.concatenate(cells["places"])
    rank = np.empty(len(texts), np.int64)
    rank[np.lexsort((places, docs))] = np.arange(len(texts))
    keys, kinds = np.concatenate(cells["keys"]), np.concatenate(cells["kinds"])
    line = np.concatenate([x.astype(np.int64) + b for x, b in zip(cells["lines"], base)])
    order = np.lexsort((rank[line], keys)) if len(keys) else np.zeros(0, np.int64)
    starts = B.group_starts(keys[order])
    later = np.zeros(len(texts), bool)
    for a, b in zip(starts.tolist(), np.append(starts[1:], len(order)).tolist()):
        seen: list[tuple[int, int]] = []
        for x, kind in zip(line[order[a:b]].tolist(), kinds[order[a:b]].tolist()):
            if not later[x]:
                mine = texts[x]
                later[x] = any(
                    y != x and not (kind and other) and near(texts[y], mine, spec.edits) for y, other in seen)
            seen.append((x, kind))
    cuts = np.split(later, base[1:])
    return _answer(
        table, removed=[B.pack(s[c]) for s, c in zip(cells["sent"], cuts)])


def finish(table: pa.Table, answers: pa.Table, spec: Spec) -> pa.Table:
    """Each document without the lines that repeat an earlier one."""
    block = load(table, spec) if table.num_rows else None
    if block is None:
        return table.select([]).slice(0, 0)
    keep = np.unpackbits(np.frombuffer(_memo(answers), np.uint8), count=len(block.distinct)).astype(bool)
    for cell in B.cells(answers, "removed", np.uint32):
        keep[cell] = False
    known = {x: i for i, x in enumerate(block.distinct)}
    kept, counts, removed = [], [], []
    open_ = keep.tolist()  # a kept line stays at its first place only
    for own in block.lines:
        out = []
        for x in own:
            i = known.get(x)
            if i is None or open_[i]:
                out.append(x)
                if i is not None:
                    open_[i] = False
        kept.append(b"\n".join(out).decode())
        counts.append(len(own))
        removed.append(len(own) - len(out))
    order = B.read_order(table.column("doc_id").fill_null(B.NULL_ID).to_numpy(), table.column("data").to_pylist())
    columns = {
        "kept": pa.array(kept, pa.string()), "n_lines": pa.array(counts, pa.int64()),
        "n_removed": pa.array(removed, pa.int64()), "rest": table.column("rest").take(pa.array(order)),
    }
    return pa.table(columns)


def dedup_lines(
    docs: DataFrame, edits: int = 2, shortest: int = 20, text: str = "text", doc_id: str = "doc_id", exact: int | None = None
) -> DataFrame:
    """Drop each line that is within ``edits`` edits of a line that comes earlier.

    Lines lie between line feeds; edits insert, delete or replace a UTF-8 byte.  Earlier means a
    smaller id, or the same document and a smaller line number; lines are judged on the input, so a
    line also goes if the earlier one goes itself.  Lines shorter than ``shortest`` bytes are not
    compared by edits; their exact copies go from ``exact`` bytes on, unless blank (None: they stay).

    Exact copies are found by a 128-bit digest.  The first of each is split into edits + 1 segments;
    segments meet the substrings of other lines that may equal them, and lines that meet are
    verified by a banded bit-parallel edit distance (``near``).  Keys travel packed (``blocks.py``);
    segments with long lists are compared in pieces.

    Returns ``docs`` with ``text`` replaced by the kept lines (a null text becomes empty), plus n_lines and
    n_removed, which replace columns of these names.  Rows that share an id follow each other in the
    order of their texts; rows without id come after all others.
    """
    shortest = max(shortest, edits + 1)
    spec, n = Spec(edits, shortest, shortest if exact is None else exact), B.parts(docs.sparkSession)
    names = docs.columns
    plain = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    at = {c: f"c{i}" for i, c in enumerate(names)}
    carry = [c for name, c in at.items() if name != text] or [F.lit(0).alias("none")]
    base = B.in_blocks(plain, n, at[text], at[doc_id], carry)
    base = base.select("block", "doc_id", "data", "rest")
    memo = "part int, block int, memo binary, "
    back = "block int, part int, memo binary, "
    digests = B.on_groups(base, "block", lambda t: send_digests(t, spec, n), memo + "digests binary, docs binary, places binary")
    firsts = B.on_groups(B.deal(digests, "part", n), "part", find_first, back + "bits binary")
    keys = B.with_answers(base, firsts, n, lambda t, a: send_segments(t, a, spec, n), memo + "own binary, probes binary")
    met = B.on_groups(B.deal(keys, "part", n), "part", meet, back + "own binary, probes binary")
    sent = B.with_answers(
        base, met, n, lambda t, a: send_lines(t, a, spec, n),
        memo + "keys binary, kinds binary, lines binary, data binary, sizes binary, docs binary, places binary, sent binary")
    removed = B.on_groups(B.deal(sent, "part", n), "part", lambda t: verify(t, spec), back + "removed binary")
    rest = base.schema["rest"].dataType.simpleString()
    out = B.with_answers(
        base, removed, n, lambda t, a: finish(t, a, spec), f"kept string, n_lines long, n_removed long, rest {rest}")
    columns = [F.col("kept").alias(text) if c == text else F.col(f"rest.{at[c]}").alias(c) for c in names
               if c not in ("n_lines", "n_removed")]
    return out.select(*columns, "n_lines", "n_removed")


def line_digest(docs: DataFrame) -> DataFrame:
    """One row per document with its counts of lines and a digest of the text that stays."""
    done = dedup_lines(docs.select("doc_id", "text"), exact=1)
    return done.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"), F.col("text").alias("kept"))
