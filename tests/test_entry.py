"""The driver contract: registered queries, oracle keys and the flagship."""

import os
import sys

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as entry  # noqa: E402

from conftest import SF  # noqa: E402


def test_every_query_has_an_oracle():
    from terrafold.plans.registry import QUERIES

    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "created_datetime" not in df.columns and "fips_code" in df.columns


def _check(spark, name):
    con = duckdb.connect()
    for t in ["customer", "supplier", "part", "orders", "nation", "region"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = entry.queries()[name](spark, SF)
    got = sorted(tuple("NULL" if v is None else str(round(v, 6) if isinstance(v, float) else v)
                       for _, v in sorted(r.asDict().items())) for r in df.collect())
    res = con.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    exp = sorted(tuple("NULL" if v is None else str(round(v, 6) if isinstance(v, float) else v)
                       for _, v in sorted(zip(cols, row))) for row in res.fetchall())
    assert sorted(df.columns) == sorted(cols)
    assert got == exp


def test_oracle_small_queries(spark):
    for name in ["prefix_map", "area_code", "null_sentinels", "strip_srid", "last_loaded_date",
                 "target_contract_violations", "shape_rejects", "manifest_long_prefixes", "simplify_ladder", "self_intersections"]:
        _check(spark, name)


def test_oracle_shapes(spark):
    for name in ["ring_faults", "polar_areas", "valid_rungs", "great_circle_significance", "large_ring_crossings", "geography_wkb"]:
        _check(spark, name)


def test_oracle_deliveries(spark):
    for name in ["delivery_ledger", "history_switch", "header_bound_scan"]:
        _check(spark, name)


def test_every_query_names_its_tables():
    assert set(entry.input_tables()) == set(entry.queries())
