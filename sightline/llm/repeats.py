"""Windows of tokens that repeat across documents, by super-k-mers dealt to minimiser buckets.

Shared by the byte windows of ``substring.py`` (suffix arrays) and the word windows of
``passages.py`` (sorted windows); the two differ in their tokens and in how a bucket orders them.

1. A window belongs to its minimiser, the least hash of the grams in it; equal windows have equal
   minimisers.  Consecutive windows with one minimiser form a run.  Each block sends the distinct
   minimisers of its runs to their parts, where those met once only are ruled out.
2. Runs of the others travel to their part as one packed string each, equal strings of a block
   once, with the place of the first.  The part orders all windows of its strings exactly and
   answers, for each string and window, whether the window also starts earlier elsewhere.
3. The block marks the tokens covered.

Runs of very long texts are cut every ``CHUNK`` windows, so the working memory of the hashes does
not grow with a text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import blocks as B

CHUNK = 1 << 20
SUB = 16  # buckets of a part, ordered one after the other
_KEYS = "part int, block int, keys binary, again binary"
_MASKS = "block int, part int, mask binary"
_STRINGS = "part int, block int, mask binary, data binary, sizes binary, buckets binary, docs binary, starts binary"
_ANSWERS = "block int, part int, mask binary, earlier binary"


@dataclass(frozen=True)
class Spec:
    """What counts as a token and a window."""

    window: int
    gram: int
    within: bool  # an earlier start in the same document counts, too
    words: bool  # tokens are words (else bytes)


@dataclass
class Block:
    """A block's tokens: hashes or bytes, with the documents they belong to."""

    number: int
    ids: np.ndarray
    texts: list[bytes]
    buf: np.ndarray
    tokens: np.ndarray
    edges: np.ndarray | None  # byte where each word begins, and the end of the last
    counts: np.ndarray
    offsets: np.ndarray  # first token of each document, and the total

    def cuts(self, first: np.ndarray, n: np.ndarray) -> list[bytes]:
        """The bytes of ``n`` tokens from ``first`` on, for each of the two."""
        data, end = self.buf.data, first + n
        if self.edges is not None:
            first, end = self.edges[first], self.edges[end] - 1
        return [bytes(data[a:b]) for a, b in zip(first.tolist(), end.tolist())]


def load(table: pa.Table, spec: Spec) -> Block:
    number, ids, texts = B.read_block(table)
    if spec.words:
        buf, begins, counts = B.split_words(texts)
        tokens, edges = B.piece_hashes(buf, begins), np.append(begins, len(buf))
    else:
        buf = tokens = np.frombuffer(b"".join(texts), np.uint8)
        edges, counts = None, np.array([len(t) for t in texts], np.int64)
    return Block(number, ids, texts, buf, tokens, edges, counts, np.concatenate(([0], np.cumsum(counts))))


def find_runs(block: Block, spec: Spec) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows and minimiser of each run, and (where repeats inside a
    document count) whether the run holds its minimiser twice; windows stay inside documents."""
    w, total = spec.window, len(block.tokens)
    firsts, counts, keys, twice = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, bool)]
    inside = np.zeros(total + 1, bool)
    inside[B.ranges(block.offsets[:-1], np.maximum(block.counts - w + 1, 0))] = True
    for at in range(0, total - w + 1, CHUNK):
        end = min(at + CHUNK, total - w + 1)
        grams = B.gram_hashes(block.tokens[at : end + w - 1], spec.gram)
        least = B.sliding_min(grams, w - spec.gram + 1)
        ok = inside[at:end]
        new = ok.copy()
        new[1:] &= ~ok[:-1] | (least[1:] != least[:-1])  # documents with windows are at least a token apart
        begin = np.flatnonzero(new)
        if len(begin):
            owner = np.cumsum(new)[ok] - 1
            count = np.bincount(owner, minlength=len(begin))
            firsts.append(begin + at)
            counts.append(count)
            keys.append(least[begin])
            if spec.within:
                size = count + w - spec.gram
                same = grams[B.ranges(begin, size)] == np.repeat(least[begin], size)
                twice.append(np.add.reduceat(same, np.cumsum(size) - size, dtype=np.int64) > 1)
    return np.concatenate(firsts), np.concatenate(counts), np.concatenate(keys), np.concatenate(twice)


def keys_by_part(keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Order of the keys, where each distinct key begins in it, the distinct keys' order by part,
    and where each part begins (n + 1 numbers)."""
    order = np.argsort(keys)
    starts = B.group_starts(keys[order])
    part = B.part_of(keys[order[starts]], n)
    by_part, edges = B.by_part(part, n)
    return order, starts, by_part, edges


def send_keys(table: pa.Table, spec: Spec, n: int) -> pa.Table:
    """Distinct minimisers of a block, and whether they came twice inside it."""
    block = load(table, spec)
    first, _, key, twice = find_runs(block, spec)
    order, starts, by_part, edges = keys_by_part(key, n)
    if spec.within:
        again = np.diff(np.append(starts, len(order))) > 1
        if len(starts):
            again |= np.logical_or.reduceat(twice[order], starts)
    else:
        owner = (np.searchsorted(block.offsets, first, "right") - 1)[order]
        again = np.minimum.reduceat(owner, starts) != np.maximum.reduceat(owner, starts) if len(starts) else starts
    keys, again = key[order[starts]][by_part], again[by_part]
    full = [p for p in range(n) if edges[p] < edges[p + 1]]
    return pa.table({
        "part": pa.array(full, pa.int32()),
        "block": pa.array([block.number] * len(full), pa.int32()),
        "keys": pa.array([B.pack(keys[edges[p] : edges[p + 1]]) for p in full], pa.binary()),
        "again": pa.array([B.pack(np.packbits(again[edges[p] : edges[p + 1]])) for p in full], pa.binary()),
    })


def rule_out(table: pa.Table) -> pa.Table:
    """Which of the keys of each block also occur elsewhere."""
    keys = B.cells(table, "keys", np.uint64)
    again = [np.unpackbits(a, count=len(k)).astype(bool) for a, k in zip(B.cells(table, "again", np.uint8), keys)]
    sizes = [len(k) for k in keys]
    every = np.concatenate(keys)
    order = np.argsort(every)
    ordered = every[order]
    met = np.zeros(len(every), bool)
    if len(every) > 1:
        same = ordered[1:] == ordered[:-1]
        met[1:] |= same
        met[:-1] |= same
    marked = np.empty(len(every), bool)
    marked[order] = met
    marked |= np.concatenate(again)
    cuts = np.split(marked, np.cumsum(sizes)[:-1])
    return pa.table({
        "block": table.column("block"),
        "part": table.column("part"),
        "mask": pa.array([B.pack(np.packbits(c)) for c in cuts], pa.binary()),
    })


@dataclass
class Marked:
    """Runs whose minimiser occurs elsewhere, and the distinct strings of a block in the order of
    their buckets; ``first`` is the first run of each string."""

    begin: np.ndarray
    count: np.ndarray
    string: np.ndarray
    strings: list[bytes]
    bucket: np.ndarray
    first: np.ndarray


def marked_strings(block: Block, spec: Spec, n: int, masks: dict[int, bytes]) -> Marked:
    begin, count, key, _ = find_runs(block, spec)
    order, starts, by_part, edges = keys_by_part(key, n)
    marked = np.zeros(len(starts), bool)
    for p, mask in masks.items():
        size = edges[p + 1] - edges[p]
        marked[by_part[edges[p] : edges[p + 1]]] = np.unpackbits(np.frombuffer(mask, np.uint8), count=size)
    hit = np.zeros(len(key), bool)
    hit[order] = np.repeat(marked, np.diff(np.append(starts, len(key))))
    begin, count, key = begin[hit], count[hit], key[hit]
    known: dict[bytes, int] = {}
    string = np.array([known.setdefault(cut, len(known)) for cut in block.cuts(begin, count + spec.window - 1)], np.int64)
    first = B.group_starts(np.maximum.accumulate(string))  # numbered as they come
    bucket = B.part_of(key[first], n) * SUB + (B.mix(key[first]) & np.uint64(SUB - 1)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    strings = list(known)
    return Marked(
        begin, count, rank[string] if len(string) else string, [strings[i] for i in order], bucket[order], first[order])


def send_strings(docs: pa.Table, answers: pa.Table, spec: Spec, n: int) -> pa.Table:
    """The packed strings of the runs whose minimiser occurs elsewhere, each once a block."""
    out: dict[str, list] = {k: [] for k in ("part", "block", "mask", "data", "sizes", "buckets", "docs", "starts")}
    if docs.num_rows and answers.num_rows:
        block = load(docs, spec)
        masks = dict(zip(answers.column("part").to_pylist(), answers.column("mask").to_pylist()))
        marked = marked_strings(block, spec, n, masks)
        where = marked.begin[marked.first]
        owner = np.searchsorted(block.offsets, where, "right") - 1
        sizes = np.array([len(s) for s in marked.strings], np.uint32)
        edges = np.searchsorted(marked.bucket, np.arange(n + 1) * SUB)
        for p in range(n):
            own = slice(edges[p], edges[p + 1])
            if edges[p] < edges[p + 1]:
                out["part"].append(p)
                out["block"].append(block.number)
                out["mask"].append(masks[p])
                out["data"].append(b"".join(marked.strings[own]))
                out["sizes"].append(B.pack(sizes[own]))
                out["buckets"].append(B.pack(np.bincount(marked.bucket[own] - p * SUB, minlength=SUB).astype(np.uint32)))
                out["docs"].append(B.pack(block.ids[owner[own]]))
                out["starts"].append(B.pack((where - block.offsets[owner])[own]))
    kinds = {"part": pa.int32(), "block": pa.int32()}
    return pa.table({k: pa.array(v, kinds.get(k, pa.binary())) for k, v in out.items()})


Order = Callable[[list[bytes]], tuple[np.ndarray, np.ndarray, np.ndarray]]


def find_earlier(table: pa.Table, spec: Spec, order: Order) -> pa.Table:
    """For each string of each block, window by window: does it start earlier elsewhere?

    ``order`` takes the distinct strings and returns the number of tokens of each and, for every
    window, (string order) the number of its class of equal windows.
    """
    data = table.column("data").to_pylist()
    sizes, counts = B.cells(table, "sizes", np.uint32), B.cells(table, "buckets", np.uint32)
    docs, starts = B.cells(table, "docs", np.int64), B.cells(table, "starts", np.int64)
    ends = [np.cumsum(x, dtype=np.int64) for x in sizes]
    firsts = [np.concatenate(([0], np.cumsum(x, dtype=np.int64))) for x in counts]
    answers: list[list[np.ndarray]] = [[] for _ in data]
    for s in range(SUB):
        known: dict[bytes, int] = {}
        entries, places, owners = [], [], []
        for i in range(len(data)):
            a, b = int(firsts[i][s]), int(firsts[i][s + 1])
            edge = [int(ends[i][a - 1]) if a else 0, *ends[i][a:b].tolist()]
            entries.append(np.array(
                [known.setdefault(data[i][x:y], len(known)) for x, y in zip(edge, edge[1:])], np.int64))
            owners.append(docs[i][a:b])
            places.append(starts[i][a:b])
        if not known:
            continue
        rank = np.unique(np.concatenate(owners), return_inverse=True)[1].reshape(-1)
        place = rank.astype(np.int64) << 32
        if spec.within:
            place = place + np.concatenate(places)
        lengths, classes, n_classes = order(list(known))
        windows = lengths - spec.window + 1
        begin = np.cumsum(windows) - windows
        first = np.full(len(known), np.iinfo(np.int64).max)
        np.minimum.at(first, np.concatenate(entries), place)
        own = np.repeat(first, windows)
        if spec.within:
            own = own + B.ranges(np.zeros(len(windows), np.int64), windows)
        least = np.full(int(n_classes), np.iinfo(np.int64).max)
        np.minimum.at(least, classes, own)
        least = least[classes]
        at = 0
        for i, entry in enumerate(entries):
            n = windows[entry]
            mine = np.repeat(place[at : at + len(entry)], n)
            if spec.within:
                mine = mine + B.ranges(np.zeros(len(entry), np.int64), n)
            answers[i].append(least[B.ranges(begin[entry], n)] < mine)
            at += len(entry)
    return pa.table({
        "block": table.column("block"), "part": table.column("part"), "mask": table.column("mask"),
        "earlier": pa.array([B.pack(np.packbits(np.concatenate(x))) for x in answers], pa.binary()),
    })


def covered(docs: pa.Table, answers: pa.Table, spec: Spec, n: int) -> Iterator[tuple[Block, int, np.ndarray]]:
    """Every document of a block with the flags of its covered tokens."""
    if not docs.num_rows:
        return
    block = load(docs, spec)
    edge = np.zeros(len(block.tokens) + 1, np.int32)
    if answers.num_rows:
        rows = answers.select(["part", "mask", "earlier"]).to_pylist()
        marked = marked_strings(block, spec, n, {r["part"]: r["mask"] for r in rows})
        windows = marked.count[marked.first]
        totals = np.bincount(marked.bucket // SUB, windows, n).astype(np.int64)
        earlier = np.concatenate([
            np.unpackbits(np.frombuffer(r["earlier"], np.uint8), count=totals[r["part"]])
            for r in sorted(rows, key=lambda r: r["part"])
        ]).astype(bool)
        first = marked.first[marked.string]  # run of the string's first start in this block
        local = first == np.arange(len(first))
        if not spec.within:
            owner = block.ids[np.searchsorted(block.offsets, marked.begin, "right") - 1]
            local |= owner == owner[first]
        told = marked.string[local]
        bits = earlier[B.ranges((np.cumsum(windows) - windows)[told], windows[told])]
        where = np.concatenate((
            B.ranges(marked.begin[local], marked.count[local])[bits], B.ranges(marked.begin[~local], marked.count[~local])))
        edge += np.bincount(where, minlength=len(edge)).astype(np.int32)
        edge -= np.bincount(where + spec.window, minlength=len(edge)).astype(np.int32)
    flags = np.cumsum(edge[:-1]) > 0
    for d in range(len(block.ids)):
        yield block, d, flags[block.offsets[d] : block.offsets[d + 1]]


def repeated(
    docs: DataFrame, spec: Spec, order: Order, result: Callable[[Iterator], pa.Table], schema: str,
    text: str = "text", doc_id: str = "doc_id",
) -> DataFrame:
    """Run the three steps; ``result`` makes a block's rows from its documents and their flags."""
    n = B.parts(docs.sparkSession)
    base = B.in_blocks(docs, n, text, doc_id)
    keys = B.on_groups(base, "block", lambda t: send_keys(t, spec, n), _KEYS)
    masks = B.on_groups(B.deal(keys, "part", n), "part", rule_out, _MASKS)
    strings = B.with_answers(base, masks, n, lambda d, a: send_strings(d, a, spec, n), _STRINGS)
    answers = B.on_groups(B.deal(strings, "part", n), "part", lambda t: find_earlier(t, spec, order), _ANSWERS)
    return B.with_answers(base, answers, n, lambda d, a: result(covered(d, a, spec, n)), schema)


def runs_of(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each maximal run of true begins and ends."""
    step = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)
