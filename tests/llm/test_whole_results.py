"""Cases in which an operator once did less than the whole job."""

from collections import Counter

import numpy as np

from stratalog.llm import decontamination, ngram_join, toxicity

DOCS = "doc_id long, text string"


def similarity(a, b):
    x, y = (Counter(tuple(w[p : p + 5]) for p in range(len(w) - 4)) for w in (a, b))
    both = (x & y).total()
    return both / (x.total() + y.total() - both)


def test_decontamination_finds_every_similar_truncation(spark):
    # the longest words, around which anchors are chosen, lie at an end or in the middle
    items = [[f"w{i}x{k}" + "long" * (i == at) for i in range(n)] for k, (n, at) in enumerate([(9, 8), (14, 0), (40, 39), (41, 0), (60, 30), (104, 103)])]
    items += [r.text.lower().split() for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").orderBy("item_id").limit(12).collect()]
    docs, want = [], {}
    for k, w in enumerate(items):
        for a in range(len(w) // 4 + 1):
            for b in range(len(w), len(w) - len(w) // 4 - 1 + a, -1):
                if (s := similarity(w[a:b], w)) >= 0.8:
                    want[len(docs), k] = (0, s)
                    docs.append((len(docs), " ".join(w[a:b])))
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.start_word, r.similarity) for r in decontamination.contaminated(spark.createDataFrame(docs, DOCS), bench).collect()}
    lost = sorted(set(want) - set(got))
    assert not lost, (len(lost), len(want), [(k, len(items[k]), want[i, k]) for i, k in lost[:20]])
    assert all(got[p] == want[p] for p in want)


def test_decontamination_keeps_rows_of_one_id_apart(spark):
    item = [f"w{i}" + "long" * (i in (18, 19, 20)) for i in range(40)]
    near = " ".join(item[:-2])
    decoys = [" ".join([*(f"x{k}y{i}" for i in range(k)), *item[10:28]]) for k in range(6)]
    ids = [*range(20), None]
    docs = [(i, t) for i in ids for t in (*decoys[:3], near, *decoys[3:])]
    got = decontamination.contaminated(spark.createDataFrame(docs, DOCS), spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.item_id, r.start_word) for r in got) == sorted((-1 if i is None else i, 1, 0) for i in ids)


def test_toxicity_sees_long_words_whole(spark):
    body = "".join(chr(0x4E00 + 7 * i % 5000) for i in range(700))
    for text in (body, body[:61], body[:62], body[:63], body[:124], "İ" * 40, "short, words. " * 9, "a" * 200 + " b " + "_" * 99):
        want = set()
        for w in text.split():
            m = f"<{w.lower().strip(toxicity._EDGE) or '_'}>"
            want |= set(toxicity.Features([f" {m[i : i + n]}" for n in toxicity.GRAMS for i in range(len(m) - n + 1)]).grams)
        assert set(toxicity.Features(toxicity.words_of(text)).grams) == want
    assert toxicity.words_of("a b\tc") == ["a", "b", "c"] and toxicity.words_of(" \n") == []
    score = toxicity.Scorer(toxicity.Network(1))
    assert len(set(score([body, body[:500] + "x", body[:62] + "other"]))) == 3


def test_toxicity_learns_from_the_end_of_unspaced_texts(spark):
    rng = np.random.default_rng(4)
    stems = [f"{a}{b}" for a in ("tion", "ere", "ouv", "mal", "str") for b in ("an", "el", "ith", "or", "us", "em")]
    texts, toxic = [], []
    for i in range(500):
        toxic.append(int(i % 3 == 0))
        texts.append("".join([*rng.choice(stems, 40), *["vilevile"] * toxic[-1], *rng.choice(stems, 3)]))
    scores = toxicity.Scorer(toxicity.train(texts[:400], toxic[:400]))(texts[400:])
    assert np.mean((scores >= 0.5) == toxic[400:]) > 0.93


def test_decontamination_against_brute_force(spark):
    rng = np.random.default_rng(8)
    items = [[f"i{k}w{rng.integers(n)}" for _ in range(n)] for k, n in enumerate([6, 9, 15, 22, 30, 41, 60, 90, 140])]  # words and shingles repeat
    docs = []
    for w in items:
        for rate in np.linspace(0.0, 0.05, 16):
            noisy = [x if rng.random() > rate else f"n{rng.integers(9999)}" for x in w]
            cut = noisy[int(rng.integers(3)) :] if rng.random() < 0.3 else noisy
            around = [[f"a{rng.integers(50)}" for _ in range(int(rng.integers(30)))] for _ in range(2)]
            docs.append(around[0] + cut + (cut[-7:] if rng.random() < 0.3 else []) + around[1])
    docs += [w[: len(w) * 9 // 10] for w in items] + [w + w for w in items]
    want = {}
    for i, d in enumerate(docs):
        for k, w in enumerate(items):
            scores = [(similarity(d[s : s + len(w)], w), -s) for s in range(max(0, len(d) - len(w)) + 1) if len(d[s : s + len(w)]) >= 5]
            if scores and max(scores)[0] >= 0.8:
                want[i, k] = (-max(scores)[1], max(scores)[0])
    rows = [(i, " ".join(d)) for i, d in enumerate(docs)] + [(None, None), (7, ""), (8, " \t")]
    bench = spark.createDataFrame([(k, " ".join(w), "x") for k, w in enumerate(items)] + [(99, " ".join(items[3]), "x")], "item_id long, text string, size string")
    table = spark.createDataFrame([(*r, 1) for r in rows + rows[:5]], "doc_id long, text string, row int")  # repeats, and columns named as internal ones
    found = decontamination.contaminated(table, bench).collect()
    got = {(r.doc_id, r.item_id): (r.start_word, r.similarity) for r in found}
    assert len(got) == len(found) and {i for i, k in got if k == 99} == {i for i, k in got if k == 3}
    got = {p: x for p, x in got.items() if p[1] != 99}
    assert set(got) <= set(want) and len(got) >= 0.99 * len(want) and len(want) > 90
    assert sum(got[p] != want[p] for p in got) <= 0.01 * len(got)
    assert decontamination.contaminated(table, bench.where("false")).collect() == []


def test_the_multi_index_finds_all_within_the_radius(spark):
    rng = np.random.default_rng(9)
    base = [int(x) for x in rng.integers(-(1 << 63), 1 << 63, 40, dtype=np.int64)]
    prints = []
    for i in range(400):
        x = base[i % 40] % (1 << 64)
        for b in rng.choice(64, int(rng.integers(14, 25)), replace=False):
            x ^= 1 << int(b)
        prints.append((10, x - (1 << 64) if x >> 63 else x))
    of = spark.createDataFrame([(k, 10, x) for k, x in enumerate(base)], "item long, size int, print long")
    got = {(r.print, r.item) for r in decontamination.near(spark.createDataFrame(prints, "size int, print long"), of).collect()}
    want = {(x, k) for _, x in prints for k, y in enumerate(base) if ((x ^ y) % (1 << 64)).bit_count() <= decontamination.RADIUS}
    assert got == want and len(want) > 100


def test_a_wide_component_keeps_every_link(spark):
    """One rare shingle joins all documents to one loose component of many sizes; its true links lie within and across size bands."""
    rng = np.random.default_rng(5)
    texts = []
    for size in (8, 10, 20, 25, 31, 60, 75, 76, 140):
        for k in range(3):
            base = ["all", "of", "them", "share", "this", *(f"s{size}k{k}w{i}" for i in range(size))]
            texts += [base, base[: len(base) - int(len(base) * 0.1)], [*base[5:], *base[:5]], [*base, "tail", f"t{rng.integers(9)}"]]
    rows = [(i, " ".join(w)) for i, w in enumerate(texts)]
    sets = [{tuple(w[p : p + 5]) for p in range(len(w) - 4)} for w in texts]
    least = list(range(len(texts)))
    for _ in range(4):
        for a in range(len(texts)):
            for b in range(a):
                if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    least[a] = least[b] = min(least[a], least[b])
    df = spark.createDataFrame(rows, DOCS)
    for tile in (3, 10, 256):
        assert {r.doc_id: r.component_id for r in ngram_join.jaccard_components(df, tile).collect()} == dict(enumerate(least))
