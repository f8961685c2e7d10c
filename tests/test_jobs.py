"""Job entry points, and the plans they rest on."""

import zipfile

import pytest

from terrafold import jobs
from terrafold.operators import delivery, stage
from terrafold.plans import derive

from conftest import SF


def test_land_stage_curate_publish_shape(spark, tmp, tmp_path):
    lines = [r for r in derive.boundary_lines(derive.table(spark, SF, "customer")).collect()]
    (tmp_path / "zips").mkdir()
    with zipfile.ZipFile(tmp_path / "zips" / "20240115-neighborhoods-x.zip", "w") as z:
        for m in sorted({r["member"] for r in lines}):
            z.writestr(f"data/{m}", "".join(r["value"] + "\n" for r in lines if r["member"] == m))
    n = len({r["member"] for r in lines})
    land = ["land", "--in", f"{tmp}/zips", "--out", f"{tmp}/raw", "--ledger", f"{tmp}/ledger"]
    assert jobs.main(land, spark) == {"new": n, "empty": 0} and jobs.main(land, spark) == {"resent": n, "empty": 0}
    got = jobs.main(["stage", "--in", f"{tmp}/raw", "--out", f"{tmp}/hist", "--bad", f"{tmp}/bad"], spark)
    assert got["good"] + got["bad"] == len(lines) and got["bad"] > 0
    assert {str(r[0]) for r in spark.read.orc(f"{tmp}/hist").select("load_date").distinct().collect()} == {"2024-01-15"}
    assert jobs.main(["curate", "--in", f"{tmp}/hist", "--out", f"{tmp}/snap"], spark) == {"rows": got["good"]}
    from terrafold.plans.registry import LANDING_DDL
    spark.sql("CREATE SCHEMA IF NOT EXISTS tf_jobs")
    spark.sql("DROP TABLE IF EXISTS tf_jobs.landing")
    spark.sql(LANDING_DDL.format(table="tf_jobs.landing", location=f"{tmp}/landing"))
    pub = jobs.main(["publish", "--in", f"{tmp}/snap", "--table", "tf_jobs.landing", "--bad", f"{tmp}/refused"], spark)
    assert pub["loaded"] + pub["refused"] == got["good"] and pub["refused"] > 0
    out = jobs.main(["shape", "--table", "tf_jobs.landing", "--out", f"{tmp}/shapes", "--bad", f"{tmp}/no_shape"], spark)
    assert out["shapes"] + out["untyped"] + out["rejected"] == pub["loaded"]
    assert out["key_violations"] == 0


def test_a_step_names_its_missing_arguments(spark, capsys):
    with pytest.raises(SystemExit):
        jobs.main(["publish", "--in", "x"], spark)
    assert "--table" in capsys.readouterr().err


def test_bounded_marks_do_not_shuffle_the_manifest(spark):
    items = spark.range(1000).selectExpr("cast(id as string) AS file_date", "CASE WHEN id % 2 = 0 THEN 'neighborhoods' ELSE 'community_info' END AS product")
    marks = spark.createDataFrame([("neighborhoods", "10"), ("community_info", "20"), ("other", "5")], "product string, last_date string")
    inv = delivery.new_inventory(items, marks, products=["neighborhoods", "community_info"])
    plan = inv._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert inv.where("is_new").count() == 494 + 490


def test_history_is_gathered_by_date(spark, tmp):
    df = spark.range(0, 1000, 1, 16).selectExpr("id", "date_add(DATE '2024-01-01', cast(id % 3 as int)) AS load_date")
    stage.write_history(df, f"{tmp}/h")
    assert len(spark.read.orc(f"{tmp}/h").inputFiles()) == 3


def test_only_the_written_partitions_are_registered(spark, tmp):
    df = spark.range(10).selectExpr("id", "date_add(DATE '2024-01-01', cast(id % 2 as int)) AS load_date")
    stage.write_history(df, f"{tmp}/h")
    spark.sql("CREATE SCHEMA IF NOT EXISTS tf_jobs")
    spark.sql("DROP TABLE IF EXISTS tf_jobs.h")
    spark.sql(f"CREATE TABLE tf_jobs.h (id BIGINT, load_date DATE) USING ORC PARTITIONED BY (load_date) LOCATION '{tmp}/h'")
    stage.register(spark, "tf_jobs.h", ["2024-01-02"])
    assert [r[0] for r in spark.sql("SHOW PARTITIONS tf_jobs.h").collect()] == ["load_date=2024-01-02"]
    stage.register(spark, "tf_jobs.h")
    assert spark.sql("SHOW PARTITIONS tf_jobs.h").count() == 2
