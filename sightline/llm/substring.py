"""Suffix-array dedup of byte strings (operator 1)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks as B
from .repeats import Spec, repeated, runs_of
from .suffix_array import bucket_pointers

GRAM = 20  # bytes of a minimiser; only decides how windows are dealt
SCHEMA = "doc_id long, n_bytes long, n_removed long, spans array<struct<start: long, end: long>>, kept binary"


def _order(window: int):
    def order(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        lengths = np.array([len(s) for s in strings], np.int64)
        buf = np.frombuffer(b"".join(strings), np.uint8).astype(np.uint16) + np.uint16(1)
        _, pointer = bucket_pointers(buf, window)
        return lengths, pointer[B.ranges(np.cumsum(lengths) - lengths, lengths - window + 1)], len(buf)

    return order


def _rows(documents: Iterator) -> pa.Table:
    ids, sizes, removed, starts, ends, kept = [], [], [], [], [], []
    for block, d, flags in documents:
        a, b = runs_of(flags)
        ids.append(block.ids[d])
        sizes.append(len(flags))
        removed.append(int(flags.sum()))
        starts.append(a)
        ends.append(b)
        text = block.texts[d]
        kept.append(np.frombuffer(text, np.uint8)[~flags].tobytes() if len(a) else text)
    n_spans = np.array([len(a) for a in starts], np.int64)
    pairs = pa.StructArray.from_arrays(
        [pa.array(np.concatenate(x) if x else np.zeros(0, np.int64), pa.int64()) for x in (starts, ends)], ["start", "end"])
    return pa.table({
        "doc_id": B.id_array(np.array(ids, np.int64)), "n_bytes": pa.array(sizes, pa.int64()),
        "n_removed": pa.array(removed, pa.int64()),
        "spans": pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(n_spans))), pa.int32()), pairs),
        "kept": pa.array(kept, pa.binary()),
    })


def remove_repeated_bytes(
    docs: DataFrame, window: int = 50, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """Remove each byte covered by a ``window``-byte string that also starts in an earlier document.

    Earlier means a smaller id.  Strings are judged on the input texts (UTF-8), overlaps count, and
    matches stay inside documents.  Windows are dealt by minimiser (see ``repeats.py``); a bucket
    orders the suffixes of its strings by bucket-pointer refinement, and equal windows are
    neighbours in that suffix array.

    Returns (doc_id, n_bytes, n_removed, spans, kept): the maximal removed runs as byte ranges and
    the bytes that stay.  A null text is empty.  Documents shorter than ``window`` keep everything.
    Rows that share an id are not earlier than each other; rows without id come after all others.
    Other columns are ignored.  An empty table gives no rows.
    """
    spec = Spec(window, min(GRAM, window), within=False, words=False)
    return repeated(docs, spec, _order(window), _rows, SCHEMA, text, doc_id)


def substring_digest(docs: DataFrame) -> DataFrame:
    """One row per document with its counts of bytes and a digest of those that stay."""
    done = remove_repeated_bytes(docs)
    return done.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
