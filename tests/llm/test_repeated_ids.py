"""Rows that share an id, or have none, with equal and with other texts: operators and pipeline stages against brute force."""

import math

import duckdb
import pytest

import corpus_pipeline
from stratalog.llm import _blocks, ngram_join, queries, vector_search, warc_fixity

DOCS = "doc_id long, text string"
A = " ".join(f"w{i}" for i in range(60))
NEAR = A + " tail"
ALONE = " ".join(f"u{i}" for i in range(60))
OTHER = " ".join(f"o{i}" for i in range(40))
ROWS = [(1, A), (2, NEAR), (2, ALONE), (3, OTHER)]


def components(rows):
    """(id, text) to component, over the rows' sets."""
    sets = []
    for _, t in rows:
        w = (t or "").lower().split()
        sets.append({tuple(w[p : p + 5]) for p in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    least = [i for i, _ in rows]
    for _ in rows:
        for a in range(len(rows)):
            for b in range(len(rows)):
                if None not in (rows[a][0], rows[b][0]) and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    least[a] = least[b] = min(least[a], least[b])
    return [(i, len(s), c) for (i, _), s, c in zip(rows, sets, least, strict=True)]


MANY = [*ROWS, (3, ALONE.upper()), (4, OTHER + " x"), (4, OTHER + " x"), (5, "few words"), (5, "few  words"), (5, None), (6, ""), (None, A), (None, NEAR), (None, None), (7, A + " "), (0, OTHER + " y z"), (2, "few words")]


@pytest.mark.parametrize("order", [1, -1])
@pytest.mark.parametrize("rows", [ROWS, MANY])
def test_components_of_rows_that_share_an_id(spark, rows, order):
    df = spark.createDataFrame(rows[::order], DOCS)
    for tile in (2, 256):
        got = sorted(map(tuple, ngram_join.jaccard_components(df, tile).collect()), key=str)
        assert got == sorted(components(rows), key=str)


@pytest.mark.parametrize("order", [1, -1])
def test_the_stage_keeps_one_row_of_each_group(spark, order):
    df = spark.createDataFrame(ROWS[::order], DOCS)
    assert sorted(map(tuple, corpus_pipeline.ngram_jaccard_join(spark, df, "").collect())) == [(1, A), (2, ALONE), (3, OTHER)]
    wide = spark.createDataFrame([(*r, k, {"a": "b"}) for k, r in enumerate(MANY[::order])], f"{DOCS}, key int, tag map<string,string>")
    kept = corpus_pipeline.ngram_jaccard_join(spark, wide, "")
    assert kept.columns == wide.columns
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    assert sorted(t for i, t in rows if i is None and t) == sorted([A, NEAR]) and (None, None) in rows
    groups = {}
    for (i, t), (_, n, c) in zip(MANY, components(MANY), strict=True):
        if i is not None and n:
            groups.setdefault(c if (i, t) != (2, "few words") else c, set()).add((i, t))
    left = [(i, t) for i, t in rows if i is not None and t]
    # of each group of linked sets one row is left, that of the smallest id
    assert sorted(i for i, _ in left) == [0, 1, 2, 2]
    assert {t for i, t in left if i == 2} == {ALONE, "few words"}
    assert sorted((i, t) for i, t in rows if i is not None and not t) == [(5, None), (6, "")] or sorted(((i, t or "") for i, t in rows if i is not None and not t)) == [(5, ""), (6, "")]


def test_rows_without_an_id_lie_in_many_blocks(spark):
    df = spark.createDataFrame([(None, f"text {i}") for i in range(1000)] + [(7, f"text {i}") for i in range(1000)], DOCS)
    dealt = _blocks.dealt(df, 32)
    assert dealt.where("id IS NULL").select("block").distinct().count() == 32
    assert dealt.where("id = 7").select("block").distinct().count() == 32


def oracle(con_tables, sql):
    con = duckdb.connect()
    for name, rows, kind in con_tables:
        con.sql(f"create table {name} ({kind})")
        con.executemany(f"insert into {name} values ({','.join('?' * len(rows[0]))})", rows)
    out = con.sql(sql)
    return out.columns, out.fetchall()


def test_warc_audit_of_repeated_pages(spark, tmp_path):
    pages = [(13, "http://a/", "one body"), (13, "http://a/", "another body"), (13, "http://a/", "one body"), (5, "u", None), (110, None, ""), (1, "http://b/", "x" * 300_000), (216, "v", "w"), (13, None, "one body")]
    spark.createDataFrame([(*p, "x", 1) for p in pages], "page_id long, url string, html string, digest string, offset int").write.parquet(f"{tmp_path}/pages.parquet")
    got = queries.op5_warc_fixity(spark, str(tmp_path))
    columns, want = oracle([("pages", pages, "page_id bigint, url varchar, html varchar")], warc_fixity.ORACLE)
    assert sorted(map(tuple, got.select(*columns).collect()), key=str) == sorted(want, key=str) and len(want) == 7


def test_vectors_of_any_shape(spark):
    rows = [(0, [0.5, 0.25]), (1, []), (2, [1.0]), (3, None), (4, [float("nan"), 1.0]), (5, [-0.5, 0.75]), (50, []), (100, [0.5, 0.25]), (6, [None, 1.0]), (0, [0.125, -1.0])]
    rows += [(7, [1e308, -1e308]), (150, [3e9, 2e12]), (150, [3e9, 2e12]), (8, [-4e15, 1.5])]
    got = sorted(map(tuple, vector_search.top_k(spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, work int"), 50, 3).collect()))
    part = [(i, [math.floor(256 * x) if abs(x) < 1e300 else 256 * int(x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    want = []
    for n, (i, q) in enumerate(part):
        if i % 50 == 0:
            near = lambda s: max(-(1 << 63), min((1 << 63) - 1, s))
            scores = sorted((-near(sum(x * y for x, y in zip(q, v, strict=False))), j) for m, (j, v) in enumerate(part) if m != n)
            want += [(i, k + 1, j, -s) for k, (s, j) in enumerate(scores[:3])]
    assert got == sorted(want)
