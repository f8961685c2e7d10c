"""Publish checks and load."""

import pytest
from pyspark.sql import functions as F

from terrafold.operators import publish


SCHEMA = ("geo_type string, neighborhood_type string, geo_id string, name string, fips_code string, "
          "state_abbr string, state_fips_code string, metro string, incorporated_place string, county string, "
          "county_fips_code string, longitude double, latitude double, geoloc string")


def frame(spark, rows):
    cols = [c.split()[0] for c in SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r[c] for c in cols) for r in rows], SCHEMA)


def landing_row(**kw):
    base = dict(geo_type="neighborhood_lev_m", neighborhood_type="Neighborhood Level 1", geo_id="g", name="n",
                fips_code="06037", state_abbr="CA", state_fips_code="06", metro="m", incorporated_place=None,
                county="c", county_fips_code="037", longitude=1.5, latitude=2.5, geoloc="POLYGON ((0 0, 1 0, 1 1, 0 0))")
    base.update(kw)
    return base


def test_violations(spark):
    rows = [landing_row(geo_id="ok"), landing_row(geo_id="long", name="x" * 201), landing_row(geo_id="nulltype", geo_type=None),
            landing_row(geo_id="lat", latitude=1234.5)]
    df = frame(spark, rows)
    got = sorted(tuple(r) for r in publish.violations(df).collect())
    assert got == [("lat", "latitude", "decimal(9,6)"), ("long", "name", "length>200"), ("nulltype", "geo_type", "not null")]
    ok, bad = publish.split_violations(df)
    assert [r["geo_id"] for r in ok.collect()] == ["ok"] and bad.count() == 3
    typed_rules = [r for r in publish.TYPED_RULES if r.column == "fips_code"]
    assert not typed_rules[0].nullable


def test_load_table_default_stamp_and_count(spark, tmp):
    spark.sql("CREATE SCHEMA IF NOT EXISTS tf_pub_test")
    spark.sql("DROP TABLE IF EXISTS tf_pub_test.landing")
    spark.sql(f"""CREATE TABLE tf_pub_test.landing (created_datetime TIMESTAMP DEFAULT current_timestamp(),
        geo_type STRING, neighborhood_type STRING, geo_id STRING, name STRING, fips_code STRING, state_abbr STRING,
        state_fips_code STRING, metro STRING, incorporated_place STRING, county STRING, county_fips_code STRING,
        longitude DECIMAL(9,6), latitude DECIMAL(9,6), geoloc STRING) USING PARQUET LOCATION '{tmp}/landing'""")
    df = frame(spark, [landing_row(geo_id=str(i)) for i in range(5)])
    assert publish.load_table(df, "tf_pub_test.landing") == 5
    assert publish.load_table(df.limit(2), "tf_pub_test.landing") == 2        # truncate-then-load
    t = spark.table("tf_pub_test.landing")
    assert t.where(F.col("created_datetime").isNull()).count() == 0


def test_count_mismatch_raises(spark):
    a = spark.range(3)
    with pytest.raises(RuntimeError):
        publish.validate_count(a, spark.range(2))


def test_typed_parses_geometry(spark):
    df = frame(spark, [landing_row(), landing_row(geo_id="b", geoloc="junk")])
    out = {r["geo_id"]: r for r in publish.typed(df).collect()}
    assert out["g"]["shape"] is not None and out["b"]["shape"] is None
