"""Periodic runs, suffix dedup and token alignment against brute force, on awkward tables."""

import hashlib
import re
from collections import Counter
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from stratalog.llm import periodic_runs, queries, suffix_dedup, token_alignment

DOCS = "doc_id long, text string"
AWKWARD = [
    (1, "hello world"), (2, None), (3, ""), (4, " \t\n"), (5, "  two  spaces \n x"), (6, "a▁b"), (7, "<|endoftext|> and </s> <s> <unk> <0x41>"),
    (8, "日本語テキスト🙂 é ​ é"), (9, "tab\tand\r\nnewline\n\n"), (None, "hello world"), (1, "hello world"), (1, "another text of the id"), (10, "x" * 3000), (11, " nbsp"), (12, "trailing "), (13, "don't we'll"),
    (14, "\x00null\x01"), (15, "０full width ﬁ ligature"), (None, None), (16, "ab " * 4000), (17, "ab " * 3000), (18, "é" * 120), (19, "é" * 90), (20, "z" * 49), (21, "z" * 50), (22, "z" * 50), (None, "ab " * 100),
]


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def with_clashes(spark, rows):
    """The rows as a table whose other columns are named as internal ones."""
    return spark.createDataFrame([(*r, 1, "x", 0) for r in rows], f"{DOCS}, block int, body string, id int")


def brute_runs(codes):
    n, out = len(codes), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and codes[j] == codes[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                out.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((i, size, q) for (i, size), q in out.items()), key=lambda r: (r[0], r[2]))


def test_runs_against_brute_force():
    rng = np.random.default_rng(0)
    for t in range(800):
        c = rng.integers(0, int(rng.integers(1, 5)), int(rng.integers(0, 140)))
        if t % 3 == 0 and len(c) > 10:
            a = int(rng.integers(len(c)))
            p = int(rng.integers(1, max(2, (len(c) - a) // 4 + 1)))
            for i in range(a + p, len(c)):
                c[i] = c[i - p]
        if t % 5 == 0 and len(c) > 8:
            c = np.concatenate([c, c, c, c, rng.integers(0, 3, 3), c, c, c, c])
        c = np.unique(c, return_inverse=True)[1]
        assert periodic_runs.runs_of(c) == brute_runs(c.tolist())
        if len(c) > 8:
            most = len(c) // 4
            assert periodic_runs.lag_matches(c, most)[1:].tolist() == [int((c[q:] == c[:-q]).sum()) for q in range(1, most + 1)]


def test_runs_of_long_texts():
    # frequent words by FFT, rare ones by differences, whole texts of one period
    rng = np.random.default_rng(1)
    c = np.minimum(rng.zipf(1.3, 30_000), 5_000)
    c[10_000:14_000] = np.tile(c[10_000:10_100], 40)
    c = np.unique(c, return_inverse=True)[1]
    most = len(c) // 4
    got = periodic_runs.lag_matches(c, most)
    assert all(got[q] == (c[q:] == c[:-q]).sum() for q in (1, 2, 99, 100, 101, 200, 5_000, most))
    assert any(p == 100 and n >= 4_000 for _, n, p in periodic_runs.runs_of(c))
    assert periodic_runs.runs_of(np.zeros(1_000_000, np.int64)) == [(0, 1_000_000, 1)]
    assert periodic_runs.runs_of(np.tile(np.arange(7), 50_000)) == [(0, 350_000, 7)]


def test_periodic_run_query(spark, tmp_path):
    rng = np.random.default_rng(2)
    rows = AWKWARD + [(i, " ".join(rng.choice(["a", "b", "c", "dd"], int(rng.integers(1, 60))))) for i in range(100, 500)]
    with_clashes(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    want = []
    for i, text in rows:
        w = (text or "").encode().split()
        n, h = len(w), crc32(str(i).encode())
        if i is not None and h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
        runs = brute_runs(w) if n < 3_000 else [(0, n, 1)]
        gone = {k for s, size, q in runs for k in range(s + q, s + size)}
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
        text = "".join(f"{s},{size},{q}\n" for s, size, q in runs)
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        want.append((i, len(runs), *best, 1000 * best[1] // best[2] if runs else None, hashlib.sha256(text.encode()).hexdigest(), hashlib.sha256(kept).hexdigest(), n))
    assert rows_of(queries.op12_periodic_run_detection(spark, str(tmp_path))) == sorted(want, key=str)
    assert sum(r[1] for r in want) > 20
    assert periodic_runs.periodic_runs(spark.createDataFrame([], DOCS)).collect() == []


def brute_bytes(rows, span):
    first = {}
    for i, t in rows:
        t = (t or "").encode()
        for p in range(len(t) - span + 1) if i is not None else ():
            first[t[p : p + span]] = min(i, first.get(t[p : p + span], i))
    out = []
    for i, t in rows:
        t = (t or "").encode()
        gone = np.zeros(len(t), bool)
        for p in range(len(t) - span + 1) if i is not None else ():
            if first[t[p : p + span]] < i:
                gone[p : p + span] = True
        turns = np.flatnonzero(np.diff(gone, prepend=False, append=False))
        out.append((i, len(t), int(gone.sum()), len(turns) // 2, hashlib.sha256(np.frombuffer(t, np.uint8)[~gone].tobytes()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("span", [20, 33, 50])
def test_suffix_dedup_against_brute_force(spark, span):
    """With slabs of a few bytes too, which put each mark in a slab of its own."""
    rng = np.random.default_rng(span)
    word = lambda n: "".join(rng.choice(list("abc"), int(n)))
    pool = [word(rng.integers(30, 200)) for _ in range(6)]
    rows = list(AWKWARD)
    for _ in range(80):
        parts = [word(rng.integers(0, 40)) if rng.random() < 0.6 else pool[rng.integers(6)][int(rng.integers(0, 20)) :][: int(rng.integers(20, 200))] for _ in range(int(rng.integers(0, 9)))]
        rows.append((int(rng.integers(0, 50)) if rng.random() < 0.95 else None, "".join(parts)))
    assert rows_of(suffix_dedup.summary(suffix_dedup.repeated_bytes(with_clashes(spark, rows), span))) == brute_bytes(rows, span)
    texts = sorted({t[p : p + span + 9] for _, x in rows for t in [(x or "").encode()] for p in range(0, len(t) - span, 7)})
    least = np.arange(len(texts))[::-1].copy()
    marks = {t: suffix_dedup._marks(np.frombuffer(t, np.uint8), span)[0] for t in texts}
    alike = [t for t in texts if (suffix_dedup._marks(np.frombuffer(t, np.uint8), span) == marks[t]).all()]
    one = suffix_dedup._settled(alike, least[: len(alike)], span)
    suffix_dedup.SLAB, kept = 8, suffix_dedup.SLAB
    try:
        assert (suffix_dedup._settled(alike, least[: len(alike)], span) == one).all() and one.any()
    finally:
        suffix_dedup.SLAB = kept
    assert suffix_dedup.repeated_bytes(spark.createDataFrame([], DOCS), span).collect() == []


def test_suffix_dedup_keeps_what_it_says(spark):
    a, b = "".join(chr(97 + i * i % 23) for i in range(200)), "the middle of it "
    found = {r.doc_id: r for r in suffix_dedup.repeated_bytes(spark.createDataFrame([(5, a), (9, b + a[20:120] + b)], DOCS)).collect()}
    assert bytes(found[9].kept) == (b + b).encode() and [tuple(s) for s in found[9].spans] == [(len(b), 100)]
    assert bytes(found[5].kept) == a.encode() and found[5].spans == []


def test_ranks_by_doubling_find_equal_windows():
    rng = np.random.default_rng(3)
    for span in (17, 32, 50, 64):
        body = rng.integers(97, 99, 900).astype(np.uint8)
        body[500:640] = body[100:240]
        starts = np.arange(len(body) - span + 1)
        found, rank = suffix_dedup._repeats(body, starts, span)
        groups = {}
        for p in starts.tolist():
            groups.setdefault(body[p : p + span].tobytes(), []).append(p)
        want = sorted(g for g in groups.values() if len(g) > 1)
        got = {}
        for p, r in zip(found.tolist(), rank.tolist(), strict=True):
            got.setdefault(r, []).append(p)
        assert sorted(got.values()) == want


@pytest.fixture(scope="module")
def sides():
    byte_level = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    byte_level.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    byte_of = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}

    def spell_a(i):
        return bytes(byte_of[c] for c in byte_level.id_to_token(i))

    def spell_b(i):
        piece = pieces.id_to_piece(i)
        byte = re.fullmatch("<0x(..)>", piece)
        return bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()

    return (lambda t: byte_level.encode(" " + t, add_special_tokens=False).ids, spell_a), (pieces.encode, spell_b)


def places(ids, spell):
    out, at = [], 0
    for i in ids:
        out.append((at, at := at + len(spell(i)), i))
    return out


def brute_alignment(rows, sides):
    (encode_a, spell_a), (encode_b, spell_b) = sides
    docs, count = [], Counter()
    for doc, text in rows:
        a, b = (encode_a(text), encode_b(text)) if text else ([], [])
        whole = f" {text}".encode()
        if not text or b"".join(map(spell_a, a)) != whole or b"".join(map(spell_b, b)) != whole:
            docs.append((doc, 0, 0, 0, [], ""))
            continue
        a, b = places(a, spell_a), places(b, spell_b)
        groups, last = [], 0
        for end in sorted({e for _, e, _ in a} & {e for _, e, _ in b}):
            groups.append("|".join(",".join(str(i) for s, e, i in x if s >= last and e <= end) for x in (a, b)) if len(a) < 2_000 else None)
            last = end
        if None in groups:  # long texts: walk along
            groups, x, y = [], 0, 0
            for end in sorted({e for _, e, _ in a} & {e for _, e, _ in b}):
                u, v = x, y
                while x < len(a) and a[x][1] <= end:
                    x += 1
                while y < len(b) and b[y][1] <= end:
                    y += 1
                groups.append(",".join(str(i) for _, _, i in a[u:x]) + "|" + ",".join(str(i) for _, _, i in b[v:y]))
        links, low = [], 0
        for s, e, i in a:
            while b[low][1] <= s:
                low += 1
            k = low
            while k < len(b) and b[k][0] < e:
                links.append((i, b[k][2]))
                k += 1
        count.update(links)
        docs.append((doc, len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    top = {}
    for (_, b), n in count.items():
        top[b] = max(n, top.get(b, 0))
    return sorted([(d, a, b, g, len(x), sum(count[p] == top[p[1]] for p in x), sum(count[p] for p in x), s) for d, a, b, g, x, s in docs], key=str)


def test_alignment_against_brute_force(spark, sides):
    rows = AWKWARD + [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).collect()]
    args = (*queries.BYTE_BPE[1:], public_tokenizers.path("piece_bpe_32k.model"))
    want = brute_alignment(rows, sides)
    assert rows_of(token_alignment.align_tokens(with_clashes(spark, rows), *args)) == want
    assert sum(w[1] == 0 for w in want) >= 4
    assert token_alignment.align_tokens(spark.createDataFrame([], DOCS), *args).collect() == []


def test_alignment_survives_a_full_piece_table(spark, sides, monkeypatch):
    monkeypatch.setattr(token_alignment, "PIECES", 5)
    aligner = token_alignment.Aligner(token_alignment.byte_side(*queries.BYTE_BPE[1:]), token_alignment.piece_side(public_tokenizers.path("piece_bpe_32k.model")))
    texts = [t or "" for _, t in AWKWARD if len(t or "") < 200]
    got = []
    for some in token_alignment._slabs(texts, 40):
        a, b, groups, links, codes, digests = aligner.slab(some)
        assert len(codes) == links.sum()
        got += zip(some, a.tolist(), b.tolist(), groups.tolist(), links.tolist(), digests, strict=True)
    assert got == [(t, a, b, g, n, s) for t in texts for _, a, b, g, n, _, _, s in brute_alignment([(0, t)], sides)]
