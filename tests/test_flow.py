"""The boundaries product end to end on supplied data (sf0.001)."""

import pytest

from terrafold.operators import geometry
from terrafold.plans import boundaries
from terrafold.plans.registry import LANDING_DDL

from conftest import SF


def test_stage_curate_publish_shape(spark, tmp):
    curated = boundaries.curated_customers(spark, SF)
    spark.sql("CREATE SCHEMA IF NOT EXISTS tf_flow")
    spark.sql("DROP TABLE IF EXISTS tf_flow.landing")
    spark.sql(LANDING_DDL.format(table="tf_flow.landing", location=f"{tmp}/landing"))
    out = boundaries.publish_and_shape(spark, curated, "tf_flow.landing", f"{tmp}/shapes")
    n_rejected = out.rejected.count()
    assert out.loaded + n_rejected == curated.count()
    assert out.rejected.where("geo_type IS NOT NULL").count() == 0      # only unmapped prefixes fail
    assert out.shapes.count() == out.loaded and out.shape_rejects.count() == 0
    assert out.key_violations.count() == 0
    assert set(r[0] for r in out.shapes.select("geoloc_reduced_level").distinct().collect()) == {500}
    assert not spark.catalog.tableExists("tf_flow.landing")            # staging dropped


def test_duplicate_keys_publish_nothing(spark, tmp):
    curated = boundaries.curated_customers(spark, SF)
    spark.sql("CREATE SCHEMA IF NOT EXISTS tf_flow")
    spark.sql("DROP TABLE IF EXISTS tf_flow.gated")
    spark.sql(LANDING_DDL.format(table="tf_flow.gated", location=f"{tmp}/landing"))
    spark.createDataFrame([("old",)], "id string").write.parquet(f"{tmp}/shapes")
    twice = curated.unionByName(curated.limit(1))
    with pytest.raises(geometry.KeyViolations) as e:
        boundaries.publish_and_shape(spark, twice, "tf_flow.gated", f"{tmp}/shapes")
    assert e.value.violations.count() == 1
    assert [r["id"] for r in spark.read.parquet(f"{tmp}/shapes").collect()] == ["old"]      # the old shape table stays
    assert spark.catalog.tableExists("tf_flow.gated") and spark.table("tf_flow.gated").count() > 1
