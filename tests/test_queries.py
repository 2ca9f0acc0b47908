"""Registered queries of the engine against their SQL, on the smallest tables."""

import os

import duckdb
import pytest

from stratalog import queries

SF = "/root/testdata/sf0.01"
NAMES = (
    "lines_to_stats", "src_vpc_flow", "parse_json_flatten", "parse_csv", "parse_tsv_zeek", "parse_leef", "ts_formats", "coerce_ip", "syslog_rfc5424_sd", "sniff_formats", "bom_strip", "dlq_rows", "zone_lpm", "ioc_first_hit",
    "ioc_cidr", "geo_lookup", "dlq_recent", "dlq_counts", "dlq_sample", "search", "recent", "parse_dissect", "parse_grok",
    "stats_by_source", "timeseries", "dlq_stats", "merkle_root_batches", "inclusion_proofs", "tamper_detect", "chain_fold", "verify_chain_lag", "reprocess_compare", "compact_unify", "sql_asof", "sql_grouping_sets",
    "stream_dedup", "stream_tumbling", "stream_sliding", "stream_session", "stream_sealed", "grok_reasons", "parse_json_deep",
    "map_required_errors", "validate_errors", "dlq_replay_unresolved", "ioc_hash", "ioc_all_hosts", "netctx_all", "completeness_by_class", "roundtrip_rates",
)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.sql(f"create view {f.split('.')[0]} as select * from '{SF}/{f}'")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query_gives_what_its_sql_gives(spark, con, name):
    df = queries.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    relation = con.sql(queries.ORACLE[name])
    assert sorted(relation.columns) == columns
    key = lambda r: [(x is None, str(x)) for x in r]
    got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=key)
    want = sorted(relation.select(*(f'"{c}"' for c in columns)).fetchall(), key=key)
    assert got == want


def test_every_query_has_sql_or_is_known_not_to():
    assert set(queries.QUERIES) - set(queries.ORACLE) == {"sql_approx_distinct"}
