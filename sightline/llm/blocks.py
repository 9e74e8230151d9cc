"""Blocks of documents that exchange packed arrays.

Documents are dealt once by a hash of their id into as many blocks as there are shuffle
partitions.  A step over a block answers with a few rows of packed arrays, each addressed to a
*part* of a hash space (again as many as there are shuffle partitions); a step over a part answers
with rows addressed to blocks.  So billions of small keys travel as a few binary cells, equal keys
of a block are merged before they travel, and a hot key costs at most one entry per block.
Everything is one lazy plan of shuffles: a lost executor costs the recomputation of its blocks.
The number of shuffle partitions must be set so that a block fits a task, as for any shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NULL_ID = np.iinfo(np.int64).max  # a document without id comes after all others


def parts(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def deal(df: DataFrame, column: str, n: int) -> DataFrame:
    """Rows to the partition that ``column`` (0 to n-1) names."""
    return df.repartitionById(n, F.col(column))


def in_blocks(
    docs: DataFrame, n: int, text: str | Column = "text", doc_id: str = "doc_id", carry: Sequence[str] = ()
) -> DataFrame:
    """(block, doc_id, data): every document's UTF-8 bytes, dealt by its id; columns to ``carry``
    travel in a struct named rest."""
    body = F.col(text) if isinstance(text, str) else text
    rows = docs.select(
        F.pmod(F.xxhash64(F.col(doc_id).cast("long")), F.lit(n)).cast("int").alias("block"),
        F.col(doc_id).cast("long").alias("doc_id"),
        F.coalesce(body.cast("binary"), F.lit("").cast("binary")).alias("data"),
        *([F.struct(*carry).alias("rest")] if carry else []),
    )
    return deal(rows, "block", n)


def on_groups(df: DataFrame, key: str, step: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    return df.groupBy(key).applyInArrow(step, schema)


def with_answers(
    blocks: DataFrame, answers: DataFrame, n: int, step: Callable[[pa.Table, pa.Table], pa.Table], schema: str
) -> DataFrame:
    """``step`` over each block together with the answers addressed to it."""
    return blocks.groupBy("block").cogroup(deal(answers, "block", n).groupBy("block")).applyInArrow(step, schema)


def read_block(table: pa.Table) -> tuple[int, np.ndarray, list[bytes]]:
    """Block number, ids and texts, in id order (rows that share an id by text; no id last)."""
    ids = table.column("doc_id").fill_null(NULL_ID).to_numpy()
    data = table.column("data").to_pylist()
    order = read_order(ids, data)
    return table.column("block")[0].as_py(), ids[order].astype(np.int64), [data[i] for i in order]


def read_order(ids: np.ndarray, data: list[bytes]) -> list[int]:
    return sorted(range(len(data)), key=lambda i: (ids[i], data[i]))


def id_array(ids: np.ndarray) -> pa.Array:
    return pa.array(ids, pa.int64(), mask=ids == NULL_ID)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def part_of(keys: np.ndarray, n: int) -> np.ndarray:
    return (mix(keys ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(n)).astype(np.int64)


def by_part(part: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Stable order by part, and where each part begins in it (n + 1 numbers)."""
    order = np.argsort(part.astype(np.uint16) if n <= 1 << 16 else part, kind="stable")
    return order, np.concatenate(([0], np.cumsum(np.bincount(part, minlength=n))))


def pack(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x).tobytes()


def cells(table: pa.Table, column: str, dtype) -> list[np.ndarray]:
    return [np.frombuffer(x, dtype) for x in table.column(column).to_pylist()]


BASE, BASE_INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    known = _powers.get(base)
    if known is None or len(known) < n:
        size = 1 << max(16, (n - 1).bit_length())
        factor = np.full(size, base, np.uint64)
        factor[0] = 1
        known = np.cumprod(factor, dtype=np.uint64)
        if size <= 1 << 21:
            _powers[base] = known
    return known[:n]


def slices(starts: np.ndarray, total: int, most: int = 1 << 20):
    """Runs of consecutive pieces of about ``most`` bytes: (first piece, last piece + 1, begin, end)."""
    i = 0
    while i < len(starts):
        begin = int(starts[i])
        j = max(i + 1, int(np.searchsorted(starts, begin + most, "right")) - 1)
        j = min(j, len(starts))
        end = total if j >= len(starts) else int(starts[j])
        yield i, j, begin, end
        i = j


def piece_hashes(buf: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """64-bit hash of each piece; a piece reaches to the start of the next."""
    out = np.empty(len(starts), np.uint64)
    for i, j, begin, end in slices(starts, len(buf)):
        terms = (buf[begin:end].astype(np.uint64) + np.uint64(1)) * powers(BASE, end - begin)
        at = starts[i:j] - begin
        out[i:j] = mix(np.add.reduceat(terms, at) * powers(BASE_INVERSE, end - begin)[at])
    return out


def split_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words between ASCII white space: bytes with one space after each word, where each word
    begins, and the number of words of each text."""
    counts, out = np.zeros(len(texts), np.int64), []
    for i, text in enumerate(texts):
        words = text.split()
        counts[i] = len(words)
        if words:
            out.append(b" ".join(words))
    buf = np.frombuffer(b" ".join(out) + b" ", np.uint8) if out else np.zeros(0, np.uint8)
    ends = np.flatnonzero(buf == 32)
    return buf, np.concatenate(([0], ends[:-1] + 1)) if out else ends, counts


def gram_hashes(tokens: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` tokens from each position on, built by doubling."""
    whole, covered, piece, size = None, 0, tokens.astype(np.uint64), 1
    while True:
        if n & size:
            if whole is None:
                whole, covered = piece, size
            else:
                m = len(tokens) - covered - size + 1
                whole = whole[:m] * np.uint64(pow(BASE, size, 1 << 64)) + piece[covered : covered + m]
                covered += size
        if covered == n:
            return mix(whole)
        piece = piece[:-size] * np.uint64(pow(BASE, size, 1 << 64)) + piece[size:]
        size *= 2


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    rest = width - size
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def group_starts(sorted_values: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate(([True], sorted_values[1:] != sorted_values[:-1])))


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers starts[0], starts[0]+1, … of each range, one range after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.arange(total) - np.repeat(before - starts, lengths)
