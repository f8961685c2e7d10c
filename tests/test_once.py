"""Jobs that parse wide lines once, and queries that build their rows once."""

from pyspark.sql import functions as F

from terrafold.operators import stage
from terrafold.sources.contract import BAD


def test_one_pass_stages_what_two_passes_do(spark, tmp_path):
    rows = [("1", "a", None, "20240101", "m"), ("2", "b", None, "20240102", "m"), (None, None, "broken\tline", "20240102", "m"), ("3", "c", None, "20240102", "m")]
    df = spark.createDataFrame(rows, f"k string, v string, {BAD} string, parent_folder_name string, file_name string")
    runs = [({}, ["2024-01-01", "2024-01-02"], df), ({}, ["2024-01-01", "2024-01-02"], df.where("k = '3'")), ({"load_date": "2024-01-05"}, ["2024-01-05"], df)]
    for given, days, parsed in runs:  # the second run withdraws all rows of one date, and finds no bad line
        got = {}
        for strategy in ("reparse", "once"):
            base = f"{tmp_path}/{strategy}"
            counts = stage.run(spark, parsed, f"{base}/h", f"{base}/bad", strategy=strategy, reload_dates=days, **given)
            kept = spark.read.schema("k string, v string, load_date date").orc(f"{base}/h").collect()
            bad = spark.read.text(f"{base}/bad").collect()
            got[strategy] = counts, sorted((r["k"], r["v"], str(r["load_date"])) for r in kept), sorted(r["value"] for r in bad)
        assert got["once"] == got["reparse"]
    assert got["once"][0] == {"good": 3, "bad": 1} and len(got["once"][1]) == 4


def test_wide_lines_are_parsed_once_and_never_shuffled(spark, tmp_path):
    from pyspark.sql import types as T

    from terrafold.operators import landing
    from terrafold.plans import community

    contract = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.IntegerType()), T.StructField(BAD, T.StringType())])
    lines = spark.range(40).select(F.lit("community_info").alias("product"), F.lit("20240115").alias("file_date"), F.lit("community-x.tsv").alias("member"),
                                   F.expr("concat(id, '\t', if(id % 10 = 0, 'x', cast(id AS string)))").alias("value"))
    landing.land(lines, f"{tmp_path}/raw", rebalance=False)
    parses = spark.sparkContext.accumulator(0)
    read = community.scan_landing

    def counted(*a, **k):
        return read(*a, **k).mapInArrow(lambda batches: (parses.add(b.num_rows) or b for b in batches), read(*a, **k).schema)
    community.scan_landing = counted
    try:
        counts = community.stage_community(spark, f"{tmp_path}/raw", contract, f"{tmp_path}/h", f"{tmp_path}/bad", days=["20240115"], load_date="2024-01-15")
    finally:
        community.scan_landing = read
    assert counts == {"good": 36, "bad": 4} and parses.value == 40
    assert spark.read.text(f"{tmp_path}/bad").count() == 4 and spark.read.orc(f"{tmp_path}/h").count() == 36


def test_the_flow_and_the_key_check_build_their_rows_once(spark, monkeypatch):
    from terrafold.plans import boundaries, registry
    from tests.conftest import SF

    staged, shaped = [], []
    stage_, outcomes = boundaries.staged_customers, registry.geometry.outcomes
    monkeypatch.setattr(boundaries, "staged_customers", lambda *a, **k: (staged.append(1), stage_(*a, **k))[1])
    monkeypatch.setattr(registry.geometry, "outcomes", lambda *a, **k: (shaped.append(k.get("partitions") or a[-1]), outcomes(*a, **k))[1])
    registry.q_publish_flow(spark, SF)
    assert len(staged) == 1 and len(shaped) == 1 and shaped[0]  # a small landing table is spread over the cores
    plan = registry.q_key_violations(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "ArrowEvalPython" not in plan and "shape_fault" not in plan
