"""Super-k-mer dedup of word windows (operator 7)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks as B
from .repeats import Spec, repeated, runs_of

GRAM = 8  # words of a minimiser; only decides how windows are dealt
SCHEMA = "doc_id long, n_words long, n_removed long, spans array<struct<start: long, end: long>>, kept string"


def _order(window: int):
    def order(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sort the windows of a bucket word by word: halves first, then pairs of halves."""
        lists = [s.split(b" ") for s in strings]
        lengths = np.array([len(x) for x in lists], np.int64)
        codes: dict[bytes, int] = {}
        rank = np.array([codes.setdefault(w, len(codes)) for x in lists for w in x], np.int64)
        size, n = 1, len(rank)
        while size < window:
            step = min(size, window - size)
            pair = (rank[: n - step] << 32) | rank[step:]
            n -= step
            rank = np.unique(pair, return_inverse=True)[1].reshape(-1)
            size += step
        starts = B.ranges(np.cumsum(lengths) - lengths, lengths - window + 1)
        return lengths, rank[starts], len(rank)

    return order


def _rows(documents: Iterator) -> pa.Table:
    ids, sizes, removed, starts, ends, kept = [], [], [], [], [], []
    for block, d, flags in documents:
        a, b = runs_of(flags)
        first, n = int(block.offsets[d]), len(flags)
        ids.append(block.ids[d])
        sizes.append(n)
        removed.append(int(flags.sum()))
        starts.append(a)
        ends.append(b)
        i, j = np.concatenate(([0], b)), np.concatenate((a, [n]))
        kept.append(b" ".join(block.cuts(first + i[j > i], (j - i)[j > i])).decode())
    n_spans = np.array([len(a) for a in starts], np.int64)
    pairs = pa.StructArray.from_arrays(
        [pa.array(np.concatenate(x) if x else np.zeros(0, np.int64), pa.int64()) for x in (starts, ends)], ["start", "end"])
    return pa.table({
        "doc_id": B.id_array(np.array(ids, np.int64)), "n_words": pa.array(sizes, pa.int64()),
        "n_removed": pa.array(removed, pa.int64()),
        "spans": pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(n_spans))), pa.int32()), pairs),
        "kept": pa.array(kept, pa.string()),
    })


def remove_repeated_passages(
    docs: DataFrame, window: int = 20, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """Remove each word covered by a window of ``window`` words that also starts earlier.

    Words lie between ASCII white space and are compared unchanged.  Earlier means a smaller id, or
    the same document and a smaller word number.  Windows are judged on the input.  Consecutive
    windows with one minimiser travel as one packed string to its bucket, which sorts its windows
    exactly (see ``repeats.py``).

    Returns (doc_id, n_words, n_removed, spans, kept): removed runs as word ranges, and the words
    that stay, joined by one space.  A null text has no words.  Documents of fewer words than a
    window keep all.  Rows that share an id count as documents that follow each other in the order
    of their texts; rows without id come after all others.  Other columns are ignored.  An empty
    table gives no rows.
    """
    spec = Spec(window, min(GRAM, window), within=True, words=True)
    return repeated(docs, spec, _order(window), _rows, SCHEMA, text, doc_id)


def passage_digest(docs: DataFrame) -> DataFrame:
    """One row per document with its counts of words and a digest of the words that stay."""
    done = remove_repeated_passages(docs)
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
