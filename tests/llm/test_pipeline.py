"""The pipeline against brute force over each stage's own input."""

import hashlib

import corpus_pipeline
from stratalog.llm import toxicity

SF = "/root/testdata/sf0.001"


def test_stages_do_what_their_operators_say(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        docs = stage(spark, docs, SF).cache()
        seen[name] = (before, docs.collect())
        if name != "best_fit_packing":
            assert docs.columns == columns
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    before, after = seen["toxicity"]
    net = toxicity.fit(spark.read.parquet(f"{SF}/documents.parquet"), labels)
    scores = dict(zip(before, toxicity.Scorer(net)([before[i].text or "" for i in before]), strict=True))
    assert {r.doc_id for r in after} == {i for i, s in scores.items() if s < 0.5}

    before, after = seen["ngram_jaccard_join"]
    sets = {}
    for i, r in before.items():
        w = (r.text or "").encode().lower().split()
        sets[i] = {tuple(w[p : p + 5]) for p in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    least = {i: i for i in sets}
    for _ in range(3):
        for a in sorted(sets):
            for b in sets:
                if b < a and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    least[a] = least[b] = min(least[a], least[b])
    assert {r.doc_id for r in after} == {i for i in least if least[i] == i}

    before, after = seen["substring_dedup"]
    first = {}
    for i in sorted(before):
        w = (before[i].text or "").encode().split()
        for p in range(len(w) - 12):
            first.setdefault(tuple(w[p : p + 13]), i)
    for r in after:
        w = (before[r.doc_id].text or "").encode().split()
        gone = {q for p in range(len(w) - 12) if first[tuple(w[p : p + 13])] < r.doc_id for q in range(p, p + 13)}
        want = b" ".join(x for k, x in enumerate(w) if k not in gone).decode() if gone else before[r.doc_id].text
        assert hashlib.sha256((r.text or "").encode()).digest() == hashlib.sha256((want or "").encode()).digest()

    before, after = seen["benchmark_decontamination"]
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = {r.doc_id for r in after}
    holds = {i for i, r in before.items() if any(" ".join(x.lower().split()) in " ".join((r.text or "").lower().split()) for x in items)}
    assert holds.isdisjoint(kept) and len(before) - len(kept) <= len(holds) + 3

    before, after = seen["best_fit_packing"]
    assert {r.doc_id for r in after} == set(before)
