"""Alignment of two tokenizers' tokens, with corpus-wide counts of linked ids (operator 12).

Tokens of both sides that share bytes are linked.  How many documents hold an id pair linked is
counted outside memory: documents gather in *runs* of bounded size; a run sorts its pair-document
records, deals the pairs with their number of documents by a radix of the first id over parts of the
id space, and compresses them with zstd.  A part merges the runs with a heap; since they come in the
order of the first id, each id's counts are complete, and their maximum known, when the next id
begins, and the answers stream back to the runs while the merge goes on.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.session import scratch_path

from . import blocks as B

#: Fixed value: how the byte-level tokenizer cuts a text into pieces.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PIECE_BPE = "/opt/tokenizers/piece_bpe_32k.model"
RUN_RECORDS = 2_000_000  # pair-document records of a run
FRAME_PAIRS = 1 << 13  # pairs of a compressed frame
MERGE_PAIRS = 1 << 20  # pairs that the merge gathers before it counts

_RUN = (
    "run string, part int, frame int, pairs binary, ids array<long>, numbers array<long>, digests array<string>, "
    "records binary, n_pairs long"
)
_ANSWER = "run string, part int, frame int, counts binary"
_DONE = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)


class Tokenizers:
    """Both tokenizers, loaded once per Python worker, and the bytes of their tokens."""

    _loaded: dict[tuple[str, str], Tokenizers] = {}

    def __init__(self, byte_bpe: str, piece_bpe: str) -> None:
        import sentencepiece
        import tiktoken

        with open(byte_bpe, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.a = tiktoken.Encoding("bytes", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})
        self.a_lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.a_lengths[rank] = len(token)
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_bpe)
        self.b_bytes = [self._piece(i) for i in range(self.b.vocab_size())]
        self.b_lengths = np.array([len(x) for x in self.b_bytes], np.int64)
        most = max(len(self.a_lengths), len(self.b_lengths))
        self.written = [f"{i}{end}" for i in range(most) for end in ",|;"]

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    @classmethod
    def load(cls, byte_bpe: str, piece_bpe: str) -> Tokenizers:
        key = byte_bpe, piece_bpe
        if key not in cls._loaded:
            cls._loaded[key] = cls(byte_bpe, piece_bpe)
        return cls._loaded[key]

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of ``text`` after a space by both; none if one of them does not keep its bytes."""
        none = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not text:
            return none
        data = b" " + text.encode()
        a, b = self.a.encode_ordinary(" " + text), self.b.encode(text)
        if self.a.decode_bytes(a) != data or b"".join(map(self.b_bytes.__getitem__, b)) != data:
            return none
        return np.array(a, np.int64), np.array(b, np.int64)


def align(tokens: Tokenizers, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, int, str]:
    """Linked pairs (first id in the high half) and how often each occurs, the number of groups, and
    the groups as ``a1,a2|b1;a3|b2,b3``.

    Two tokens overlap in one piece between consecutive ends of either side, so every such end is a
    link of the tokens that it lies in.
    """
    if not len(a):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), 0, ""
    a_ends, b_ends = np.cumsum(tokens.a_lengths[a]), np.cumsum(tokens.b_lengths[b])
    ends = np.union1d(a_ends, b_ends)
    links = a[np.searchsorted(a_ends, ends)] << 32 | b[np.searchsorted(b_ends, ends)]
    pairs, times = np.unique(links, return_counts=True)
    common = np.intersect1d(a_ends, b_ends, assume_unique=True)
    a_group, b_group = np.searchsorted(common, a_ends), np.searchsorted(common, b_ends)
    a_upto = np.searchsorted(a_group, np.arange(len(common)), "right")
    b_before = np.searchsorted(b_group, np.arange(len(common)))
    codes = np.empty(len(a) + len(b), np.int64)
    codes[np.arange(len(a)) + b_before[a_group]] = 3 * a + (a_ends == common[a_group])
    codes[np.arange(len(b)) + a_upto[b_group]] = 3 * b + 2 * (b_ends == common[b_group])
    groups = "".join(map(tokens.written.__getitem__, codes.tolist()))[:-1]
    return pairs, times, len(common), groups


def _press(*arrays: np.ndarray) -> bytes:
    """Integer arrays, bytes of equal weight side by side, compressed."""
    out = []
    for x in arrays:
        x = np.ascontiguousarray(x)
        out.append(np.array([len(x), x.itemsize], np.int64).tobytes())
        out.append(x.view(np.uint8).reshape(-1, x.itemsize).T.tobytes())
    return zstandard.ZstdCompressor(level=3).compress(b"".join(out))


def _unpress(data: bytes) -> list[np.ndarray]:
    """Arrays of unsigned integers from ``_press``."""
    data, at, out = zstandard.ZstdDecompressor().decompress(data), 0, []
    while at < len(data):
        n, width = np.frombuffer(data, np.int64, 2, at)
        body = np.frombuffer(data, np.uint8, n * width, at + 16).reshape(width, n)
        out.append(np.ascontiguousarray(body.T).view(f"u{width}").ravel())
        at += 16 + int(n * width)
    return out


def _least(x: np.ndarray) -> np.ndarray:
    """The same numbers in the narrowest unsigned type."""
    return x.astype(np.min_scalar_type(int(x.max()) if len(x) else 0))


class _Run:
    """Documents up to a bounded number of pair-document records."""

    def __init__(self, parts: int) -> None:
        self.parts, self.ids, self.numbers, self.digests = parts, [], [], []
        self.pairs: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.records = 0

    def add(self, tokens: Tokenizers, doc_id: int | None, text: str | None) -> None:
        a, b = tokens.encode(text)
        pairs, times, n_groups, groups = align(tokens, a, b)
        self.ids.append(doc_id)
        self.numbers += [len(a), len(b), n_groups, int(times.sum())]
        self.digests.append(hashlib.sha256(groups.encode()).hexdigest() if groups else "")
        self.pairs.append(pairs)
        self.times.append(times)
        self.records += len(pairs)

    def rows(self) -> Iterator[dict]:
        """One row with the documents and their records, and the frames of pairs for each part."""
        name = uuid.uuid4().hex
        pairs = np.concatenate(self.pairs)
        doc = np.repeat(np.arange(len(self.pairs)), [len(x) for x in self.pairs])
        # parts in turn, in each of them by first id, second id and document
        part = B.part_of((pairs >> 32).astype(np.uint64), self.parts)
        order = np.lexsort((pairs, part))
        pairs, part, doc, times = pairs[order], part[order], doc[order], np.concatenate(self.times)[order]
        starts = B.group_starts(pairs)
        holders = np.diff(np.append(starts, len(pairs)))
        pairs, part = pairs[starts], part[starts]
        yield {
            "run": name, "part": -1, "frame": 0, "ids": self.ids, "numbers": self.numbers, "digests": self.digests,
            "records": _press(_least(holders), _least(doc), _least(times)), "n_pairs": len(pairs),
        }
        begins = B.group_starts(part)
        for begin, end in zip(begins, np.append(begins[1:], len(part))):
            for frame, i in enumerate(range(begin, end, FRAME_PAIRS)):
                own = pairs[i : min(end, i + FRAME_PAIRS)]
                yield {
                    "run": name, "part": int(part[begin]), "frame": frame,
                    "pairs": _press(np.diff(own, prepend=0).astype(np.uint64), _least(holders[i : i + len(own)])),
                }


def _runs(byte_bpe: str, piece_bpe: str, parts: int, most: int, schema: pa.Schema):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, run = Tokenizers.load(byte_bpe, piece_bpe), _Run(parts)
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                run.add(tokens, doc_id.as_py(), text.as_py())
                if run.records >= most:
                    yield pa.RecordBatch.from_pylist(list(run.rows()), schema)
                    run = _Run(parts)
        if run.ids:
            yield pa.RecordBatch.from_pylist(list(run.rows()), schema)

    return step


class _Merge:
    """Pairs of all runs of a part in the order of their first id."""

    def __init__(self, frames: list[dict]) -> None:
        self.frames: dict[str, list[dict]] = {}
        for frame in sorted(frames, key=lambda f: (f["run"], f["frame"])):
            self.frames.setdefault(frame["run"], []).append(frame)

    def counted(self) -> Iterator[list[tuple[str, np.ndarray, np.ndarray]]]:
        """Lists of (run, number of documents of each pair, is it the first id's highest)."""
        waiting = {run: [self._read(run, 0)] for run in self.frames}
        heap = [(int(own[0][0][-1]) >> 32, run, 1) for run, own in waiting.items() if len(self.frames[run]) > 1]
        heapq.heapify(heap)
        gathered = sum(len(own[0][0]) for own in waiting.values())
        while heap:
            # all ids before the last one of the run that is read least far are complete
            if gathered >= MERGE_PAIRS:
                done, waiting = self._split(waiting, heap[0][0])
                gathered = sum(len(p) for own in waiting.values() for p, _ in own)
                if done:
                    yield self._count(done)
            _, run, at = heapq.heappop(heap)
            frame = self._read(run, at)
            waiting.setdefault(run, []).append(frame)
            gathered += len(frame[0])
            if at + 1 < len(self.frames[run]):
                heapq.heappush(heap, (int(frame[0][-1]) >> 32, run, at + 1))
        if waiting:
            yield self._count(self._split(waiting, None)[0])

    def _read(self, run: str, at: int) -> tuple[np.ndarray, np.ndarray]:
        pairs, holders = _unpress(self.frames[run][at].pop("pairs"))
        return np.cumsum(pairs.astype(np.int64)), holders.astype(np.int64)

    @staticmethod
    def _split(waiting, floor):
        done, left = {}, {}
        for run, own in waiting.items():
            pairs, holders = np.concatenate([p for p, _ in own]), np.concatenate([h for _, h in own])
            cut = len(pairs) if floor is None else int(np.searchsorted(pairs, int(floor) << 32))
            if cut:
                done[run] = pairs[:cut], holders[:cut]
            if cut < len(pairs):
                left[run] = [(pairs[cut:], holders[cut:])]
        return done, left

    @staticmethod
    def _count(done) -> list[tuple[str, np.ndarray, np.ndarray]]:
        every, back = np.unique(np.concatenate([p for p, _ in done.values()]), return_inverse=True)
        counts = np.bincount(back, np.concatenate([h for _, h in done.values()])).astype(np.int64)
        starts = B.group_starts(every >> 32)
        highest = np.repeat(np.maximum.reduceat(counts, starts), np.diff(np.append(starts, len(every))))
        best, out, at = counts == highest, [], 0
        for run, (pairs, _) in done.items():
            own = back[at : at + len(pairs)]
            out.append((run, counts[own], best[own]))
            at += len(pairs)
        return out


def _count_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    frames = [row for batch in batches for row in batch.to_pylist()]
    part, schema = frames[0]["part"], pa.schema(
        [("run", pa.string()), ("part", pa.int32()), ("frame", pa.int32()), ("counts", pa.binary())])
    for number, answers in enumerate(_Merge(frames).counted()):
        yield pa.RecordBatch.from_pylist([
            {"run": run, "part": part, "frame": number, "counts": _press(_least(counts * 2 + best))}
            for run, counts, best in answers
        ], schema)


def _finish(homes: pa.Table, answers: pa.Table) -> pa.Table:
    """The documents of a run with the sums of their links' counts."""
    home = homes.to_pylist()[0]
    holders, doc, times = _unpress(home["records"])
    cells = sorted(answers.to_pylist(), key=lambda x: (x["part"], x["frame"]))
    marked = np.concatenate([_unpress(x["counts"])[0].astype(np.int64) for x in cells] or [np.zeros(0, np.int64)])
    if len(marked) != home["n_pairs"]:
        raise ValueError(f"{len(marked)} counts for {home['n_pairs']} pairs of a run")
    each, n = np.repeat(marked, holders.astype(np.int64)), len(home["ids"])
    times = times.astype(np.int64)
    sums = np.bincount(doc, (each >> 1) * times, n).astype(np.int64)
    best = np.bincount(doc, (each & 1) * times, n).astype(np.int64)
    numbers = np.array(home["numbers"], np.int64).reshape(n, 4)
    arrays = [pa.array(home["ids"], pa.int64()), *[pa.array(numbers[:, i]) for i in range(4)]]
    return pa.Table.from_arrays(
        [*arrays, pa.array(best), pa.array(sums), pa.array(home["digests"], pa.string())],
        ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])


def align_tokens(
    docs: DataFrame, byte_bpe: str = BYTE_BPE, piece_bpe: str = PIECE_BPE, run_records: int = RUN_RECORDS, text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every document.

    ``byte_bpe`` is a byte-level vocabulary as ranks (side A, given a space and the text), and
    ``piece_bpe`` a piece model that adds the space itself (side B); both paths must exist on every
    executor.  Strings of special tokens are plain text.  Where tokens of both sides end at the same
    byte a group ends; a link is a pair of tokens that share bytes.  An id pair's count is the number
    of documents that hold it linked; n_best counts the links whose pair has the highest count of
    its A id, ties included, and count_sum adds up the counts of all links.

    Runs are written once to the shared folder, so the counts and the documents they return to come
    from the same copy; a run's share of a part is one compressed cell or few, with each pair once,
    so that no id or pair is a hot key.  Null and empty texts, and texts whose tokens do not give
    back the bytes of space and text, have no tokens: zeros and an empty groups_sha256.  Rows that
    repeat an id are documents of their own; a null id is kept.  Other columns are not read.
    """
    spark = docs.sparkSession
    parts = B.parts(spark)
    schema = pa.schema([
        ("run", pa.string()), ("part", pa.int32()), ("frame", pa.int32()), ("pairs", pa.binary()),
        ("ids", pa.list_(pa.int64())), ("numbers", pa.list_(pa.int64())), ("digests", pa.list_(pa.string())),
        ("records", pa.binary()), ("n_pairs", pa.int64()),
    ])
    rows = docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string"))
    path = scratch_path(spark, "token-runs")
    rows.mapInArrow(_runs(byte_bpe, piece_bpe, parts, run_records, schema), _RUN).write.parquet(path)
    runs = spark.read.parquet(path)
    frames = runs.where("part >= 0").select("run", "part", "frame", "pairs")
    answers = B.deal(frames, "part", parts).groupBy("part").applyInArrow(_count_part, _ANSWER)
    homes = runs.where("part < 0").select("run", "ids", "numbers", "digests", "records", "n_pairs")
    return homes.groupBy("run").cogroup(answers.groupBy("run")).applyInArrow(_finish, _DONE)
