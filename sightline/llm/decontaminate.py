"""Benchmark decontamination by a broadcast set of normalised n-grams (operator 10)."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.session import pin, scratch_path

from . import blocks as B

WINDOW = 10
BROADCAST_WINDOWS = 500_000  # windows of one broadcast, about 50 MB; more windows take more passes
SLICE_BYTES = 4 << 20  # texts hashed at a time

#: ASCII letters in lower case, digits and bytes of other characters stay; all else parts words
NORMAL = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
_MARKS = ", _n_words long, _spans array<struct<start: long, end: long>>, _items array<long>"


def normal_words(text: str | bytes | None) -> list[bytes]:
    data = text.encode() if isinstance(text, str) else text or b""
    return data.translate(NORMAL).split()


def _item_windows(window: int):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams, sizes, ids = [], [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = normal_words(text)
                size = min(window, len(words))
                for i in range(len(words) - size + 1 if words else 0):
                    grams.append(b" ".join(words[i : i + size]))
                    sizes.append(size)
                    ids.append(item)
            yield pa.RecordBatch.from_arrays(
                [pa.array(grams, pa.binary()), pa.array(sizes, pa.int32()), pa.array(ids, pa.int64())],
                ["gram", "size", "item_id"])

    return step


class GramSet:
    """Windows by hash, for texts hashed in slices; every hit is confirmed on the words themselves."""

    def __init__(self, rows: list) -> None:
        self.by_size: dict[int, tuple[np.ndarray, np.ndarray, dict[int, dict[bytes, list[int]]]]] = {}
        for size in sorted({r["size"] for r in rows}):
            own = [r for r in rows if r["size"] == size]
            buf, begins, _ = B.split_words([r["gram"] for r in own])
            hashes = B.gram_hashes(B.piece_hashes(buf, begins), size)[::size]
            known: dict[int, dict[bytes, list[int]]] = {}
            for h, r in zip(hashes.tolist(), own):
                known.setdefault(h, {}).setdefault(bytes(r["gram"]), []).extend(r["items"])
            sieve = np.zeros(1 << 20, bool)
            sieve[hashes & np.uint64(len(sieve) - 1)] = True
            self.by_size[size] = np.unique(hashes), sieve, known

    def hits(self, texts: list[bytes]) -> tuple[np.ndarray, list[list[tuple[int, int]]], list[set[int]]]:
        """Number of words, spans of words that windows cover, and items met, of each text."""
        buf, begins, counts = B.split_words([t.translate(NORMAL) for t in texts])
        offsets = np.concatenate(([0], np.cumsum(counts)))
        words = B.piece_hashes(buf, begins)
        ends = np.concatenate((begins[1:], [len(buf)])) - 1
        spans: list[list[tuple[int, int]]] = [[] for _ in texts]
        items: list[set[int]] = [set() for _ in texts]
        for size, (hashes, sieve, known) in self.by_size.items():
            if len(words) < size:
                continue
            grams = B.gram_hashes(words, size)
            at = np.flatnonzero(sieve[grams & np.uint64(len(sieve) - 1)])
            at = at[hashes[np.minimum(np.searchsorted(hashes, grams[at]), len(hashes) - 1)] == grams[at]]
            owner = np.searchsorted(offsets, at, "right") - 1
            inside = at + size <= offsets[owner + 1]
            for p, d in zip(at[inside].tolist(), owner[inside].tolist()):
                found = known[int(grams[p])].get(buf[begins[p] : ends[p + size - 1]].tobytes())
                if found is not None:
                    items[d].update(found)
                    first = p - int(offsets[d])
                    spans[d].append((first, first + size))
        return counts, [merge(s) for s in spans], items


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def _mark(broadcast, text: str):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams: GramSet = broadcast.value
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text)).cast(pa.binary())
            begin = 0
            while begin < batch.num_rows:
                end, size = begin, 0
                while end < batch.num_rows and (end == begin or size < SLICE_BYTES):
                    value = column[end]
                    size += value.as_buffer().size if value.is_valid else 0
                    end += 1
                part = batch.slice(begin, end - begin)
                texts = [x or b"" for x in column.slice(begin, end - begin).to_pylist()]
                counts, spans, items = grams.hits(texts)
                before = part.select(["_spans", "_items"]).to_pylist()
                rows = [
                    (merge(s + [(x["start"], x["end"]) for x in old["_spans"] or []]), sorted(i | set(old["_items"] or [])))
                    for s, i, old in zip(spans, items, before)
                ]
                pair = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                arrays = {
                    "_n_words": pa.array(counts, pa.int64()),
                    "_spans": pa.array([[{"start": a, "end": b} for a, b in s] for s, _ in rows], pair),
                    "_items": pa.array([i for _, i in rows], pa.list_(pa.int64())),
                }
                yield pa.RecordBatch.from_arrays(
                    [arrays.get(n, c) for n, c in zip(part.schema.names, part.columns)], part.schema.names)
                begin = end

    return step


def item_windows(benchmark: DataFrame, window: int = WINDOW, text: str = "text", item_id: str = "item_id") -> DataFrame:
    """(gram, size, items): the distinct windows of all items, with the items that hold each."""
    rows = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).cast("string").alias("text"))
    grams = rows.mapInArrow(_item_windows(window), "gram binary, size int, item_id long")
    return grams.groupBy("gram", "size").agg(F.array_sort(F.collect_set("item_id")).alias("items"))


def _passed(docs: DataFrame, benchmark: DataFrame, window: int, text: str, broadcast_windows: int) -> DataFrame:
    """``docs`` with _n_words, _spans and _items after every share of the windows."""
    spark = docs.sparkSession
    grams = pin(item_windows(benchmark, window, text))
    # an item of a window's list costs as much as a window
    slices = max(1, math.ceil((grams.agg(F.sum(F.size("items") + 1)).first()[0] or 0) / 2 / broadcast_windows))
    out = docs.drop("_n_words", "_spans", "_items").withColumns({
        "_n_words": F.lit(0).cast("long"),
        "_spans": F.array().cast("array<struct<start: bigint, end: bigint>>"),
        "_items": F.array().cast("array<bigint>"),
    })
    schema = out.schema
    for field in schema.fields:
        field.nullable = True
    for i in range(slices):
        share = grams.where(F.pmod(F.xxhash64("gram"), F.lit(slices)) == i)
        sent = spark.sparkContext.broadcast(GramSet(share.collect()))
        out = out.mapInArrow(_mark(sent, text), schema)
        if i + 1 < slices:  # only one share is alive, in the driver and in every worker
            path = scratch_path(spark, "marked")
            out.write.parquet(path)
            sent.destroy()
            out = spark.read.schema(schema).parquet(path)
    return out


def mark_contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text",
    broadcast_windows: int = BROADCAST_WINDOWS,
) -> DataFrame:
    """Add n_words, n_hit, hit_spans (word ranges), items and contaminated to ``docs``.

    Words are runs of ASCII letters in lower case, digits and non-ASCII characters.  A window is
    ``window`` consecutive words of an item, or the whole of a shorter item; a document word inside
    any occurrence of a window is hit.  The distinct windows of the items form a hash set that is
    broadcast; the texts' windows are looked up by hash, in place and without a shuffle, and each hit
    is confirmed on its words.  Windows are counted first: of more than ``broadcast_windows`` each
    broadcast holds a share by hash.  The documents then pass one share after the other, and what a
    share has marked is written before the next is made, so only one is in memory at a time.

    Null texts and items without words have no windows and hit nothing; repeated items and documents
    are treated alike; a null item id is an item without name, which hits but is not listed.  All
    columns of ``docs`` stay; one named like an added column is replaced.
    """
    hit = F.aggregate("_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return _passed(docs, benchmark, window, text, broadcast_windows).withColumns({
        "n_words": F.col("_n_words"), "n_hit": hit, "hit_spans": F.col("_spans"), "items": F.col("_items"),
        "contaminated": F.size("_spans") > 0,
    }).drop("_n_words", "_spans", "_items")


def _cut(spans: str, text: str):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            texts = batch.column(names.index(text)).to_pylist()
            for i, ranges in enumerate(batch.column(names.index(spans)).to_pylist()):
                if ranges:
                    data = texts[i].encode()
                    plain = np.frombuffer(data.translate(NORMAL), np.uint8) != 32
                    step_ = np.diff(np.concatenate(([0], plain.astype(np.int8), [0])))
                    begins, ends = np.flatnonzero(step_ == 1), np.flatnonzero(step_ == -1)
                    kept, at = [], 0
                    for r in ranges:
                        kept.append(data[at : begins[r["start"]]])
                        at = int(ends[r["end"] - 1])
                    texts[i] = b"".join([*kept, data[at:]]).decode()
            columns = list(batch.columns)
            columns[names.index(text)] = pa.array(texts, batch.schema.field(text).type)
            yield pa.RecordBatch.from_arrays(columns, names)

    return step


def remove_contamination(
    docs: DataFrame, benchmark: DataFrame, remove: str = "documents", window: int = WINDOW, text: str = "text",
    broadcast_windows: int = BROADCAST_WINDOWS,
) -> DataFrame:
    """Documents without what they share with the benchmark: whole contaminated documents go
    (``remove="documents"``) or only the hit spans of their text (``remove="spans"``).  Columns named _n_words, _spans or _items are dropped."""
    marked = _passed(docs, benchmark, window, text, broadcast_windows)
    if remove == "documents":
        return marked.where(F.size("_spans") == 0).drop("_n_words", "_spans", "_items")
    if remove != "spans":
        raise ValueError("remove is 'documents' or 'spans'")
    return marked.mapInArrow(_cut("_spans", text), marked.schema).drop("_n_words", "_spans", "_items")


def contamination_digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document with its counts, a digest of its items and whether any window occurs."""
    marked = mark_contamination(docs.select("doc_id", "text"), benchmark)
    names = F.concat_ws(",", F.array_sort(F.col("items").cast("array<string>")))
    return marked.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(names, 256).alias("items_sha256"), "contaminated",
    )
