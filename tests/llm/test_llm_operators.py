"""Operators for training corpora against brute force, on small tables with awkward rows."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as tokenizers_dir
import pytest
from pyspark.sql import functions as F

from stratalog.llm import decontamination, ngram_join, packing, queries, sharding, substring_dedup, token_counts, toxicity, url_rules, vector_search, warc_fixity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
PASSAGE = " ".join(f"w{i}" for i in range(60))


def words(text):
    return (text or "").encode().split()


@pytest.fixture(scope="module")
def rows():
    base = " ".join(f"Tok{i % 97}é{i}" for i in range(300))
    near = base.replace("Tok5é5 ", "changed ")
    texts = [base, near, base, None, "", "   ", "one two", "One  TWO", f"{PASSAGE} tail one", f"head {PASSAGE}", "x " * 400, "y" * 5000, base + " " + PASSAGE, "a\tb\nc\x0bd\x0ce\rf g h i j k l m", " ".join(map(str, range(4000)))]
    out = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    return [*out, (None, base, "en", "s", 1), (2, base, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    # an extra column whose name clashes with internal ones
    return spark.createDataFrame(rows, DOCS).withColumn("block", F.lit("z")).withColumn("id", F.lit(1))


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_substring_dedup_is_exact(docs, rows, empty):
    got = sorted((tuple(r) for r in substring_dedup.remove_repeats(docs).collect()), key=str)
    first = {}
    for i, t, *_ in rows:
        w = words(t)
        for p in range(len(w) - 12):
            if i is not None:
                k = tuple(w[p : p + 13])
                first[k] = min(first.get(k, i), i)
    want = []
    for i, t, *_ in rows:
        w = words(t)
        gone = set()
        for p in range(len(w) - 12):
            if i is not None and first[tuple(w[p : p + 13])] < i:
                gone |= set(range(p, p + 13))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        want.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    assert got == sorted(want, key=str)
    assert substring_dedup.remove_repeats(empty).collect() == []


def test_without_repeats_keeps_columns(docs, rows):
    out = substring_dedup.without_repeats(docs)
    assert out.columns == docs.columns
    by = {r.doc_id: r for r in out.collect()}
    assert by[0].text == rows[0][1] and 3 in by and by[9].text == "head" and by[9].n_chars == 4


def jaccard_brute(rows):
    sets = {}
    for i, t, *_ in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[p : p + 5]) for p in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    least = {i: i for i in sets if i is not None}
    changed = True
    while changed:
        changed = False
        for a in least:
            for b in least:
                x, y = sets[a], sets[b]
                if x and y and 100 * len(x & y) >= 80 * len(x | y) and least[a] != least[b]:
                    least[a] = least[b] = min(least[a], least[b])
                    changed = True
    return sorted(((i, len(sets[i]), least.get(i)) for i, *_ in rows), key=str)


@pytest.mark.parametrize("tile", [2, 256])
def test_ngram_join_is_exact(spark, docs, rows, tile):
    chain = [" ".join(f"c{j + 3 * i}" for j in range(60)) for i in range(12)]  # links between neighbours only
    more = rows + [(100 + i, t, "en", "s", 1) for i, t in enumerate(chain)]
    got = sorted((tuple(r) for r in ngram_join.jaccard_components(spark.createDataFrame(more, DOCS), tile).collect()), key=str)
    assert got == jaccard_brute(more)


def test_ngram_join_of_nothing(empty):
    assert ngram_join.jaccard_components(empty).collect() == []


def test_link_tile_finds_every_link():
    rng = np.random.default_rng(3)
    sets = []
    for _ in range(60):
        base = rng.integers(0, 1 << 62, 40, dtype=np.uint64) if not sets or rng.random() < 0.4 else sets[rng.integers(len(sets))].copy()
        base[: rng.integers(0, 6)] = rng.integers(0, 1 << 62, 1, dtype=np.uint64)
        sets.append(np.unique(base))
    labels, _ = ngram_join.link_tile(sets, np.arange(60), np.ones(60, bool))
    want = np.arange(60)
    for _ in range(60):
        for i in range(60):
            for j in range(i):
                both = len(set(sets[i]) & set(sets[j]))
                if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                    want[i] = want[j] = min(want[i], want[j])
    assert (labels == want).all()


def test_packing_round_trip(docs, rows, empty):
    got = packing.pack(docs, *queries.BYTE_BPE).collect()
    from tokenizers import Tokenizer

    encode = Tokenizer.from_file(queries.BYTE_BPE[0]).encode
    want = Counter()
    for i, t, *_ in rows:
        ids = np.array([*encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        cuts = [0, *range(len(ids) % 1024 or 1024, len(ids) + 1, 1024)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            want[i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        end = 0
        for offset, n in sorted(b):
            assert offset == end
            end += n
        assert end <= 1024
    assert packing.pack(empty, *queries.BYTE_BPE).collect() == []


def test_packing_search_reaches_the_bound():
    import random

    counts = Counter(random.Random(5).choices(range(1, 1024), k=3000))
    found = packing.evolve(counts, [], 1, 1024)
    used = Counter()
    for p, m in found.items():
        assert sum(p) <= 1024
        for k in p:
            used[k] += m
    assert used == counts
    assert packing.n_bins(found) <= math.ceil(sum(k * n for k, n in counts.items()) / 1024) * 1.01 + 1
    child = packing.crossover(found, packing.best_fit(counts, 1024), counts, 1024, random.Random(1))
    assert sum((Counter({k: m * c for k, c in Counter(p).items()}) for p, m in child.items()), Counter()) == counts


def test_special_strings_are_tokens_where_the_library_says_so(spark):
    text = "a <|endoftext|> b"
    r = packing.token_pieces(spark.createDataFrame([(1, text)], "doc_id long, text string"), *queries.BYTE_BPE).first()
    from tokenizers import Tokenizer

    ids = np.array([*Tokenizer.from_file(queries.BYTE_BPE[0]).encode(text, add_special_tokens=False).ids, 2], "<u4")
    assert (r.length, r.ids_crc32) == (len(ids), zlib.crc32(ids.tobytes()))


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "byte_bpe_50k.json"])
def test_token_counts_match_the_library(spark, docs, rows, empty, name):
    path = tokenizers_dir.path(name)
    odd = ["a  b", " a", "a ", "\n\n a", "a▁ b", "<s>x</s>", "tab\t x", "é\u00a0 ü", "  ", "\n", "a \n b", "x" * 300 + " y"]
    extra = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(odd)], "doc_id long, text string")
    got = {(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.count_tokens(docs.select("doc_id", "text").union(extra), path).collect()}
    from stratalog.llm._pretokens import encoder

    encode = encoder(path)
    want = {(i, len((t or "").encode()), n := len(encode(t or "")), n > 4096) for i, t in [(r[0], r[1]) for r in rows] + [(1000 + i, t) for i, t in enumerate(odd)]}
    assert got == want
    assert token_counts.count_tokens(empty, path).collect() == []


def test_url_rules(spark):
    urls = [None, "", "no scheme", "http://NET/x", "http://a.net", "http://b.example.net/en/1", "http://example.com/de/?q", "https://x.org/fr/", "http://org/fr/a#b", "http://notexample.com/de/", "http://spam-x.org/", "http://a.net?b/c", "http://a.example.net/en", "x://h/wp-login.php"]
    pages = spark.createDataFrame([*enumerate(urls), (None, "http://net/")], "page_id long, url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_rules.filter_urls(pages).collect()}

    def brute(url):
        m = re.search(r"://([^/?#]*)([^?#]*)", url or "", re.S)
        host, path = (m[1].lower(), m[2]) if m else ("", "")
        fits = [(len(n), n, v) for n, v in url_rules.HOST_RULES if (host == n.partition("/")[0] or host.endswith("." + n.partition("/")[0])) and path.startswith("/" + n.partition("/")[2])]
        own = "block" if any(re.search(p, (url or "").lower()) for p, _ in url_rules.PATTERN_RULES) else "allow"
        return (host, path, max(fits)[1], max(fits)[2]) if fits else (host, path, None, own)

    assert all(got[i] == brute(u) for i, u in enumerate(urls))
    assert got[None][2] == "net/"


def test_vector_search_is_exact(spark):
    rng = np.random.default_rng(1)
    v = [(i, [float(x) for x in np.round(rng.standard_normal(6) * 0.3, 2)]) for i in range(150)]
    v += [(150, None), (151, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (152, [float("nan")] * 6), (None, [1.0] * 6), (7, v[3][1]), (200, [0.5, 0.5]), (100, [-1.0] * 6), (250, []), *((50, [0.5] * 6),) * 9]
    df = spark.createDataFrame(v, "vec_id long, embedding array<float>")
    good = [(i, np.floor(256 * np.pad(np.array(x, np.float32).astype(float), (0, 6 - len(x)))).astype(int)) for i, x in v if i is not None and x is not None and None not in x and not np.isnan(x).any()]  # empty vectors take part
    want = []
    for a, (i, q) in enumerate(good):
        if i % 50 == 0:
            ranked = sorted((-int(q @ x), j) for b, (j, x) in enumerate(good) if b != a)[:5]
            want += [(i, k + 1, j, -d) for k, (d, j) in enumerate(ranked)]
    for size in (1 << 25, 64 * 48):
        assert sorted(map(tuple, vector_search.top_k(df.withColumn("q", F.lit(1)), block_bytes=size).collect())) == sorted(want)
    assert vector_search.top_k(df.where("false")).collect() == []
    huge = spark.createDataFrame([(0, [1e300]), (50, [1e300]), (1, [-1.0])], "vec_id long, embedding array<double>")
    most = (1 << 63) - 1
    assert sorted(map(tuple, vector_search.top_k(huge).collect())) == [(0, 1, 50, most), (0, 2, 1, -most - 1), (50, 1, 0, most), (50, 2, 1, -most - 1)]


def test_sharding(spark, docs):
    table = sharding.lookup_table()
    counts = Counter(table)
    assert max(counts.values()) - min(counts.values()) <= 1
    fewer = sharding.lookup_table(sharding.SHARDS[:-1])
    moved = sum(a != b for a, b in zip(table, fewer, strict=True) if a != len(sharding.SHARDS) - 1)
    assert moved < 0.05 * len(table)
    out = sharding.assign(docs.withColumn("slot", F.lit("mine")), "doc_id").collect()
    assert len(out) == docs.count() and all(r.shard == sharding.SHARDS[table[r.slot]] for r in out)
    assert all(r.slot == sharding._number("" if r.doc_id is None else str(r.doc_id)) % sharding.SLOTS for r in out)


def test_fixity_audit(spark):
    pages = spark.createDataFrame([(i, f"http://h/{i}", "x" * (i * 37 % 9000)) for i in range(600)] + [(None, None, None), (None, "u", "b")], "page_id long, url string, html string")
    left = warc_fixity.records(pages)
    assert warc_fixity.audit(left, left).collect() == []
    lost, rotten = 100, {5, 300, 599}
    right = left.where(F.coalesce(F.col("page_id") != lost, F.lit(True))).withColumn("digest", F.when(F.col("page_id").isin(*rotten), F.sha2(F.col("digest"), 256)).otherwise(F.col("digest")))
    where = {r.page_id: (r.file, r.offset) for r in left.collect()}
    got = {(r.file, r.offset): r.status for r in warc_fixity.audit(left, right).collect()}
    assert got == {where[lost]: "missing"} | {where[i]: "corrupt" for i in rotten}
    assert {r.status for r in warc_fixity.audit(right, left).collect()} == {"extra", "corrupt"}
    assert warc_fixity.audit(left.where("false"), left.where("false")).collect() == []


def test_decontamination(spark, docs):
    item = " ".join(f"item{i} word" for i in range(20))
    bench = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "one two"), (5, item)], "item_id long, text string")
    broken = item.replace("item10", "other").replace("item3 ", "else ")
    extra = spark.createDataFrame([(50, f"{PASSAGE} {item.upper()} {PASSAGE}"), (51, broken), (52, item[:-12])], "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontamination.contaminated(docs.select("doc_id", "text").union(extra), bench).collect()}
    assert {(50, 1), (50, 5), (6, 4), (7, 4)} <= set(got)
    assert (51, 1) not in got and got[50, 1].start_word == 60 and got[50, 1].similarity == 1.0
    assert decontamination.contaminated(docs.where("false"), bench).collect() == []


def test_toxicity_learns_stems_and_ignores_labels(spark):
    rng = np.random.default_rng(2)
    vocabulary = [f"{a}{b}" for a in ("tion", "ere", "ouv", "mal", "str") for b in ("an", "el", "ith", "or", "us", "em")]
    text = lambda n: [str(x) for x in rng.choice(vocabulary, n)]
    rows, labels = [], []
    for i in range(500):
        w, y = text(int(rng.integers(5, 90))), int(i % 3 == 0)
        if y:
            w.insert(int(rng.integers(len(w))), f"vile{rng.integers(1000)}")
        rows.append((i, " ".join(w)))
        labels.append((i, y))
    rows += [(500, None), (501, ""), (502, " \n"), (None, "tionan vile77")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(df, lab).collect()}
    held = [i for i, _ in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i].held_out == (i in set(held)) for i, _ in labels)
    assert np.mean([got[i].predicted == y for i, y in labels if i in set(held)]) > 0.93
    assert got[500].score == got[501].score == got[502].score == 0.0 and got[None].held_out is False
    assert {r.score for r in toxicity.toxicity(df, lab.where("toxic = 0")).collect()} == {0.0}
    assert toxicity.toxicity(df.where("false"), lab).collect() == []


def test_network_gradients():
    net = toxicity.Network(3)
    x = np.random.default_rng(1).standard_normal((7, toxicity.INPUT))
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    at = np.random.default_rng(2).integers(0, 7, (3, 6))
    mask = np.array([[1.0] * 6, [1.0] * 4 + [0.0] * 2, [1.0] + [0.0] * 5])
    loss = lambda: net.forward(*net.gates(x), at, mask).astype(np.float64).sum()
    _, kept = net.forward(*net.gates(x), at, mask, keep=True)
    grad, _ = net.backward(at, mask, x, np.ones(3), kept)
    for name in ("Uf", "Ub", "Wf", "A", "v", "o"):
        w = net.w[name].reshape(-1)
        old, eps = w[1], 1e-2
        w[1] = old + eps
        up = loss()
        w[1] = old - eps
        down = loss()
        w[1] = old
        assert abs((up - down) / (2 * eps) - grad[name].reshape(-1)[1]) < 5e-3, name


def test_windows_overlap_and_cover():
    for n in (0, 1, 31, 32, 33, 100, 1000):
        starts = toxicity.windows(n)
        assert {p for s in starts for p in range(s, min(n, s + toxicity.SPAN))} == set(range(n))
