"""License scans, token alignment and infilling against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from sightline.llm import alignment, fim, licenses

LETTERS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# -- licenses ---------------------------------------------------------------------------------


def words_of(text):
    return re.findall(licenses.WORD, (text or "").translate(LETTERS))


def brute_licenses(text):
    """The digest of a text by comparing all its places with all templates."""
    words, spans = words_of(text), []
    for number, t in enumerate(licenses.TEMPLATES):
        own = words_of(t.text)
        grams, diagonals = len(own) - 2, {}
        for pos in range(len(words) - 2):
            for tpos in range(grams):
                if words[pos : pos + 3] == own[tpos : tpos + 3]:
                    diagonals.setdefault(pos - tpos, set()).add(tpos)
        groups, last = [], None
        for d in sorted(diagonals):
            if last is None or t.phrase or d - last > min(8, len(own) // 4):
                groups.append([])
            groups[-1].append(d)
            last = d
        for group in groups:
            start = min(d + min(diagonals[d]) for d in group)
            end = max(d + max(diagonals[d]) + 3 for d in group)
            together = len(set().union(*(diagonals[d] for d in group)))
            best = max(len(diagonals[d]) for d in group)
            share = (together if end - start <= len(own) + 8 + len(own) // 4 else best) / grams
            if share >= (1 if t.phrase else 0.8):
                spans.append((number, t.label, start, share))
    base = [(label, start) for number, label, start, _ in spans if number < 3]
    starts = [s for _, s in base]
    return (
        len(words), len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted({b for b, _ in base})),
        ",".join(sorted({s[1] for s in spans})), max((s[3] for s in spans), default=0.0))


def license_texts():
    rng = random.Random(4)
    words = [*"the of software license mit under and version rights a".split(), "é", "2", "İstanbul", "K"]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    texts = [None, "", "...", "cc by", "CC BY-NC 4.0", "cc by nc cc by nc", "Released under the MIT License.", "under the mit licensKe", "K cc by nc"]
    texts += ["UNDER THE MİT LICENSE", " under\nthe-mit_license!Apache License, Version 2.0; all rights   reserved", "mit license under the " * 200]
    for t in licenses.TEMPLATES:
        own = t.text.split()
        texts += [t.text, f"{prose(9)} {t.text.upper()} {prose(5)}", " ".join(own[: len(own) // 2]), " ".join(w for w in own if rng.random() > 0.06)]
        cut = rng.randrange(len(own))
        texts += [" ".join([*own[:cut], "really", "new", *own[cut:]]), " ".join([*own[:cut], *["filler"] * 12, *own[cut:]]), f"{t.text} {t.text}"]
    return texts + [prose(rng.randint(0, 80)) for _ in range(40)] + [prose(30_000) + " under the mit license"]


def test_licenses(spark):
    rows = [(i, t, "clash", 1) for i, t in enumerate(license_texts())]
    rows += [(3, "Released under the MIT License.", "x", 1), (3, "Released under the MIT License.", "y", 2), (None, "cc-by-nc", "z", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, labels string, key int").repartition(3)
    got = licenses.scan_licenses(docs).collect()
    cols = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels")
    short = lambda r: (str(r[0]), *map(str, r[1:7]), round(r[7], 9))
    want = sorted(short((i, *brute_licenses(t))) for i, t, _, _ in rows)
    assert sorted(short((r.doc_id, *(r[c] for c in cols), r.score)) for r in got) == want
    assert licenses.license_digest(docs.limit(0)).collect() == []
    spans = {r.doc_id: r.spans for r in got}
    assert [(s.label, s.start, s.end) for s in spans[5]] == [("cc-by-nc", 0, 3), ("cc-by-nc", 3, 6)]


def test_license_templates(spark, monkeypatch):
    with pytest.raises(ValueError):
        licenses.template_grams(spark, [licenses.Template("x", "two words")])
    docs = spark.createDataFrame([(1, "All Rights Reserved; one two three four")], "doc_id long, text string")
    monkeypatch.setattr(licenses, "BROADCAST_GRAMS", 0)  # joined by a shuffle
    own = [licenses.Template("mine", "one two three four", True), licenses.Template("all", "all rights reserved")]
    row = licenses.scan_licenses(docs, own, base=1).first()
    assert (row.n_base, row.first_word, row.base_labels, row.labels, row.score) == (1, 3, "mine", "all,mine", 1.0)


# -- token alignment --------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokens():
    return alignment.Tokenizers.load(alignment.BYTE_BPE, alignment.PIECE_BPE)


def odd_texts():
    rng = random.Random(6)
    bits = ["the ", "Straße", " \n", "\t\t", "é", "漢字", "😀", "1234", "...", "<|endoftext|>", "<s>", "</s>", "<unk>", "<0x41>", "▁", "\x00", "ﬁ", " ", "a" * 30]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(1, 60))) for _ in range(150)]
    return texts + [None, "", " ", "\n", "▁", "x" * 20_000, "word " * 4_000, "the same text", "the same text"] + [rng.choice(texts[:5]) for _ in range(40)]


def test_byte_vocabularies_agree(tokens):
    """The rank file is the vocabulary of the json file, and both give the same ids."""
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    whole.encode_special_tokens = True
    seen = [i for i in range(256) if chr(i).isprintable() and i not in (32, 160, 173)]
    names = {chr(i): i for i in seen} | {chr(256 + k): i for k, i in enumerate(i for i in range(256) if i not in seen)}
    for token, rank in list(whole.get_vocab(with_added_tokens=False).items())[::7]:
        if rank < len(tokens.a_lengths):
            assert tokens.a.decode_single_token_bytes(rank) == bytes(names[c] for c in token)
    for text in odd_texts():
        if text:
            assert tokens.a.encode_ordinary(" " + text) == whole.encode(" " + text, add_special_tokens=False).ids


def brute_alignment(tokens, rows):
    linked, pairs, out = [], Counter(), []
    for _, text in rows:
        data = (" " + text).encode() if text else b""
        a, b = (tokens.a.encode_ordinary(" " + text), tokens.b.encode(text)) if text else ([], [])
        sides = [[tokens.a.decode_single_token_bytes(x) for x in a], [tokens.b_bytes[x] for x in b]]
        if any(b"".join(s) != data for s in sides):
            a, b, sides = [], [], [[], []]
        ranges = []
        for side in sides:
            at, own = 0, []
            for piece in side:
                own.append((at, at + len(piece)))
                at += len(piece)
            ranges.append(own)
        links, k = [], 0
        for x, (begin, end) in zip(a, ranges[0]):
            while k < len(b) and ranges[1][k][1] <= begin:
                k += 1
            j = k
            while j < len(b) and ranges[1][j][0] < end:
                links.append((x, b[j]))
                j += 1
        both, groups, i, j = {e for _, e in ranges[0]} & {e for _, e in ranges[1]}, [], 0, 0
        for e in sorted(both):
            m = next(p for p in range(i, len(a)) if ranges[0][p][1] == e) + 1
            n = next(p for p in range(j, len(b)) if ranges[1][p][1] == e) + 1
            groups.append(",".join(map(str, a[i:m])) + "|" + ",".join(map(str, b[j:n])))
            i, j = m, n
        linked.append(links)
        pairs.update(set(links))
        out.append((len(a), len(b), len(groups), len(links), sha(";".join(groups)) if groups else ""))
    most = {}
    for (x, _), n in pairs.items():
        most[x] = max(most.get(x, 0), n)
    return [
        (*row[:4], sum(pairs[p] == most[p[0]] for p in links), sum(pairs[p] for p in links), row[4]) for row, links in zip(out, linked)]


@pytest.mark.parametrize("run_records, frame, gather", [(2_000_000, 1 << 13, 1 << 20), (300, 16, 40)])
def test_alignment(spark, tokens, run_records, frame, gather):
    """Also with many runs, frames of a few pairs and a merge that counts while it reads."""
    rows = list(enumerate(odd_texts())) + [(3, "again"), (3, "again"), (None, "no id")]
    docs = spark.createDataFrame([(i, t, "n", 7) for i, t in rows], "doc_id long, text string, run string, part int").repartition(3)
    old = alignment.FRAME_PAIRS, alignment.MERGE_PAIRS
    alignment.FRAME_PAIRS, alignment.MERGE_PAIRS = frame, gather
    try:
        got = alignment.align_tokens(docs, run_records=run_records).collect()
    finally:
        alignment.FRAME_PAIRS, alignment.MERGE_PAIRS = old
    want = [(i, *w) for (i, _), w in zip(rows, brute_alignment(tokens, rows))]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert any(w[1] == 0 and t for w, (_, t) in zip(want, rows))  # some texts are not kept by a tokenizer
    assert alignment.align_tokens(docs.limit(0)).collect() == []


def test_merge_counts_while_it_reads():
    """Runs of many frames, ids that span frames, and answers in the order of each run's pairs."""
    rng, runs, total = np.random.default_rng(2), {}, Counter()
    frames = []
    for r in range(9):
        pairs = np.unique(rng.integers(0, 40, 600) << 32 | rng.integers(0, 60, 600))
        holders = rng.integers(1, 9, len(pairs))
        runs[str(r)] = pairs, holders
        total.update(dict(zip(pairs.tolist(), holders.tolist())))
        for frame, i in enumerate(range(0, len(pairs), 7)):
            own = pairs[i : i + 7]
            frames.append({"run": str(r), "frame": frame, "pairs": alignment._press(
                np.diff(own, prepend=0).astype(np.uint64), alignment._least(holders[i : i + 7]))})
    best = {}
    for p, n in total.items():
        best[p >> 32] = max(best.get(p >> 32, 0), n)
    rng.shuffle(frames)
    old, alignment.MERGE_PAIRS = alignment.MERGE_PAIRS, 50
    try:
        answers = list(alignment._Merge(frames).counted())
    finally:
        alignment.MERGE_PAIRS = old
    assert len(answers) > 10
    for r, (pairs, _) in runs.items():
        counts = np.concatenate([c for step in answers for run, c, _ in step if run == r])
        highest = np.concatenate([b for step in answers for run, _, b in step if run == r])
        assert counts.tolist() == [total[p] for p in pairs.tolist()]
        assert highest.tolist() == [total[p] == best[p >> 32] for p in pairs.tolist()]


# -- fill in the middle -----------------------------------------------------------------------


def brute_fim(doc_id, text, rate=100, spm=50, seed=7):
    text, lines = text or "", re.findall(r"[^\n]*\n|[^\n]+", text or "")
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(lines)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    if h[3] % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def fim_texts():
    rng = random.Random(3)
    bits = ["a", "é", "😀", "\n", "\n\n", "$1", "\\", "<", "<P", ">", "{2}+", "\r\n", " ", " ", "\t", "."]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    return texts + [None, "", "\n", "<P>", "x<M>y", "no newline", "\n" * 5_000, "line\n" * 20_000, "x" * 200_000, "x" * 100_000 + "\n" + "y" * 100_000]


@pytest.mark.parametrize("rate, spm", [(100, 50), (60, 0), (0, 50)])
def test_infilling(spark, rate, spm):
    rows = list(enumerate(fim_texts())) + [(None, "a\nb\nc"), (5, "a\nb"), (5, "a\nb")]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, form string, n int")
    done = fim.fill_in_middle(docs, rate, spm).withColumn("again", fim.restore())
    got = [(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.again == (r.text or "")) for r in done.collect()]
    want = [(i, *brute_fim(i, t, rate, spm), True) for i, t in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert {"doc_id", "text"} <= set(done.columns) and len(done.columns) == len(set(done.columns))


def test_infilling_digest(spark):
    rows = list(enumerate(fim_texts()))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = {i: (*(w := brute_fim(i, t))[:4], sha(w[4]), sha(t or "")) for i, t in rows}
    assert {r.doc_id: tuple(r)[1:] for r in fim.fim_digest(docs).collect()} == want
    assert fim.fim_digest(docs.limit(0)).collect() == []
    plan = fim.fim_digest(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
