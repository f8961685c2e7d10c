"""C3-C9 column functions, with the edge values of SURVEY section 2.3."""

from decimal import Decimal

from pyspark.sql import functions as F

from terrafold.functions import clean


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_pad_code_truncates_and_fills(spark):
    df = spark.createDataFrame([("6",), ("123",), ("",), (None,), ("06",)], "c string")
    out = [r[0] for r in df.select(clean.pad_code("c", 2)).collect()]
    assert out == ["06", "12", "00", None, "06"]


def test_pad_code_idempotent(spark):
    df = spark.createDataFrame([("7",), ("12345",), ("",)], "c string")
    once = df.select(clean.pad_code("c", 3).alias("c"))
    twice = once.select(clean.pad_code("c", 3).alias("c"))
    assert rows(once) == rows(twice)


def test_area_code_null_if_either_null(spark):
    df = spark.createDataFrame([("6", "37"), (None, "1"), ("1", None), ("123", "4567")], "a string, b string")
    out = [r[0] for r in df.select(clean.area_code("a", 2, "b", 3)).collect()]
    assert out == ["06037", None, None, "12456"]


def test_nullif_text_and_decimal_zero(spark):
    df = spark.createDataFrame([("", Decimal("0.000000")), ("x", Decimal("1.5")), (None, None)],
                               "s string, d decimal(9,6)")
    out = rows(df.select(clean.nullif("s", ""), clean.nullif("d", 0)))
    assert out == [(None, None), ("x", Decimal("1.500000")), (None, None)]


def test_prefix_map_first_match_and_no_match(spark):
    df = spark.createDataFrame([("neighborhoods-1m-x.tsv",), ("neighborhoods-4s",), ("neighborhoods-5z",), (None,)], "f string")
    out = [r[0] for r in df.select(clean.prefix_map("f", clean.GEO_TYPE_RULES)).collect()]
    assert out == ["neighborhood_lev_m", "neighborhood_lev_s", None, None]


def test_strip_srid_only_4326(spark):
    df = spark.createDataFrame([("SRID=4326;POINT (1 2)",), ("SRID=3857;POINT (1 2)",),
                                ("SRID=4326;SRID=4326;P",)], "g string")
    out = [r[0] for r in df.select(clean.strip_srid("g")).collect()]
    assert out == ["POINT (1 2)", "SRID=3857;POINT (1 2)", "P"]


def test_clean_neighborhoods_keeps_order(spark):
    from terrafold.operators.curate import clean_neighborhoods
    from terrafold.sources.contract import NEIGHBORHOODS_STAGE

    cols = [f.name for f in NEIGHBORHOODS_STAGE.fields if f.name not in ("created_datetime", "load_date", "_bad_data")]
    df = spark.createDataFrame([tuple([None] * len(cols))], ", ".join(
        f"{c} {'decimal(9,6)' if c in ('longitude', 'latitude') else 'string'}" for c in cols))
    df = df.withColumn("geo_type", F.lit("neighborhoods-2n.tsv")).withColumn("state_fips_code", F.lit("6"))
    out = clean_neighborhoods(df)
    assert out.columns == cols
    r = out.first()
    assert r["geo_type"] == "neighborhood_lev_n" and r["state_fips_code"] == "06" and r["fips_code"] is None
