"""Byte-string, word-window and line dedup against brute force."""

import hashlib
import random

import pytest

from sightline.llm.lines import dedup_lines, near
from sightline.llm.passages import passage_digest, remove_repeated_passages
from sightline.llm.substring import remove_repeated_bytes, substring_digest
from sightline.llm.suffix_array import bucket_pointers

SCHEMA = "doc_id long, text string, block int, part string"


def prose(rng, n, words):
    return " ".join(rng.choice(words) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    """Copies, shared passages, periodic texts, nulls, empty texts, repeated ids and no id."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6))) for _ in range(60)]
    base = [prose(rng, rng.randint(30, 120), words) for _ in range(15)]
    rows = []
    for i in range(120):
        k = rng.random()
        if k < 0.2:
            t = rng.choice(base)
        elif k < 0.5:
            b = rng.choice(base).split()
            a = rng.randint(0, len(b) - 1)
            t = prose(rng, rng.randint(0, 30), words) + " " + " ".join(b[a : a + 60]) + "\n" + prose(rng, 5, words)
        elif k < 0.6:
            t = rng.choice(["of ", "of the ", "x"]) * rng.randint(1, 90)
        elif k < 0.7:
            t = rng.choice([None, "", " \n\t"])
        else:
            t = prose(rng, rng.randint(1, 80), words) + "  " + prose(rng, 9, words)
        rows.append((i, t))
    rows += [(3, "dup " * 40), (3, "dup " * 40), (None, base[0]), (None, base[0] + " x"), (200, "long " + "word " * 3000)]
    return rows


def by_id(rows):
    out = {}
    for row in rows:
        out.setdefault(row[0], []).append(tuple(row[1:]))
    return {k: sorted(v) for k, v in out.items()}


def sha(data):
    return hashlib.sha256(data).hexdigest()


def brute_bytes(rows, w=50):
    first, out = {}, []
    key = lambda i: i if i is not None else 1 << 62
    for i, t in rows:
        b = (t or "").encode()
        for k in range(len(b) - w + 1):
            first[b[k : k + w]] = min(first.get(b[k : k + w], 1 << 63), key(i))
    for i, t in rows:
        b = (t or "").encode()
        hit = [False] * len(b)
        for k in range(len(b) - w + 1):
            if first[b[k : k + w]] < key(i):
                hit[k : k + w] = [True] * w
        spans = sum(h and (j == 0 or not hit[j - 1]) for j, h in enumerate(hit))
        out.append((i, len(b), sum(hit), spans, sha(bytes(c for c, h in zip(b, hit) if not h))))
    return by_id(out)


def test_byte_windows(spark, texts):
    docs = spark.createDataFrame([(i, t, 1, "z") for i, t in texts], SCHEMA)
    assert by_id(substring_digest(docs).collect()) == brute_bytes(texts)
    assert substring_digest(docs.limit(0)).collect() == []


def test_byte_spans_and_kept_bytes(spark):
    shared = "0123456789" * 6
    docs = spark.createDataFrame([(1, "a" + shared), (2, shared + "é")], "doc_id long, text string")
    row = remove_repeated_bytes(docs).where("doc_id = 2").first()
    assert [tuple(s) for s in row.spans] == [(0, 60)] and bytes(row.kept) == "é".encode()


@pytest.mark.parametrize("depth", [1, 3, 7, 8, 20, 50])
def test_bucket_pointers_order_suffixes(depth):
    import numpy as np

    rng = np.random.default_rng(depth)
    tokens = rng.integers(1, 4, 400).astype(np.uint16)
    order, pointer = bucket_pointers(tokens, depth)
    padded = [*tokens.tolist(), *[0] * depth]
    grams = [tuple(padded[i : i + depth]) for i in range(400)]
    assert [grams[i] for i in order] == sorted(grams)
    same = {}
    for gram, p in zip(grams, pointer.tolist()):
        assert same.setdefault(gram, p) == p
    assert len(set(same.values())) == len(same)


def brute_words(rows, w=20):
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, (r[1] or "").encode()))
    seen, out = set(), []
    for i, t in rows:
        words = (t or "").encode().split()
        hit = [False] * len(words)
        for k in range(len(words) - w + 1):
            window = tuple(words[k : k + w])
            if window in seen:
                hit[k : k + w] = [True] * w
            seen.add(window)
        out.append((i, len(words), sum(hit), sha(b" ".join(x for x, h in zip(words, hit) if not h))))
    return by_id(out)


def test_word_windows(spark, texts):
    docs = spark.createDataFrame([(i, t, 1, "z") for i, t in texts], SCHEMA)
    assert by_id(passage_digest(docs).collect()) == brute_words(texts)
    assert passage_digest(docs.limit(0)).collect() == []


def test_word_spans(spark):
    shared = " ".join(f"w{i}" for i in range(25))
    docs = spark.createDataFrame([(1, shared), (2, f"new  {shared}\tend")], "doc_id long, text string")
    row = remove_repeated_passages(docs).where("doc_id = 2").first()
    assert [tuple(s) for s in row.spans] == [(1, 26)] and row.kept == "new end"


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_banded_distance():
    rng = random.Random(3)
    for _ in range(4000):
        a = bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 14)))
        b = bytearray(a)
        for _ in range(rng.randint(0, 4)):
            i, k = rng.randint(0, len(b)), rng.random()
            if k < 0.33:
                b.insert(i, rng.choice(b"abc"))
            elif b:
                i = min(i, len(b) - 1)
                b[i : i + 1] = b"" if k < 0.66 else bytes([rng.choice(b"abc")])
        for edits in (0, 1, 2, 3):
            assert near(a, bytes(b), edits) == (edit_distance(a, bytes(b)) <= edits)


def brute_lines(docs, edits=2, shortest=20):
    rows = sorted(docs, key=lambda r: (r[0] is None, r[0] or 0, (r[1] or "").encode()))
    seen, out = [], []
    for row in rows:
        lines, kept = (row[1] or "").encode().split(b"\n"), []
        for line in lines:
            if len(line) >= shortest:
                hit = any(abs(len(line) - len(x)) <= edits and edit_distance(line, x) <= edits for x in seen)
                seen.append(line)
                if hit:
                    continue
            kept.append(line)
        out.append((row[0], b"\n".join(kept).decode(), row[2], len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def test_lines(spark):
    rng = random.Random(4)
    words = ["".join(rng.choice("abcé") for _ in range(rng.randint(1, 5))) for _ in range(30)]
    base = [prose(rng, rng.randint(2, 20), words) for _ in range(10)]

    def changed(s):
        out = list(s)
        for _ in range(rng.randint(0, 3)):
            i = rng.randint(0, len(out))
            if rng.random() < 0.5:
                out.insert(i, rng.choice("abc"))
            elif out:
                del out[min(i, len(out) - 1)]
        return "".join(out)

    docs = []
    for i in range(90):
        lines = [changed(rng.choice(base)) if rng.random() < 0.5 else prose(rng, rng.randint(0, 14), words) for _ in range(rng.randint(0, 6))]
        docs.append((i, rng.choice(["\n".join(lines)] * 6 + [None, ""]), "en", 5))
    docs += [(7, "x" * 50, "a", 1), (7, "x" * 50, "a", 1), (None, base[0], "b", 2)]
    table = spark.createDataFrame(docs, "doc_id long, text string, lang string, n_lines int")
    done = dedup_lines(table)
    assert done.columns == ["doc_id", "text", "lang", "n_lines", "n_removed"]
    assert sorted((tuple(r) for r in done.collect()), key=str) == brute_lines(docs)
    assert dedup_lines(table.limit(0)).collect() == []


def test_long_lists_meet_in_pieces(spark, monkeypatch):
    from sightline.llm import lines

    monkeypatch.setattr(lines, "LIST_BLOCK", 3)
    docs = [(i, "a line that is nearly always the same %s" % c, "en", 0) for i, c in enumerate("abcdefghijklmnop")]
    table = spark.createDataFrame(docs, "doc_id long, text string, lang string, n_lines int")
    assert sorted((tuple(r) for r in dedup_lines(table).collect()), key=str) == brute_lines(docs)


def test_short_copies(spark):
    """The query drops exact copies of lines of any length that are not blank."""
    from sightline.llm.lines import line_digest

    rows = [(1, "Les.\n\nx\nLet."), (2, "Les.\n\nx\nx y\n "), (3, "Les.\n ")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.kept, r.n_lines, r.n_removed) for r in line_digest(table).collect()}
    assert got == {1: ("Les.\n\nx\nLet.", 4, 0), 2: ("\nx y\n ", 5, 2), 3: (" ", 2, 1)}
