"""Physical-plan shape: the properties the design relies on at scale."""

from terrafold.operators import curate
from terrafold.operators import geometry as G
from terrafold.plans import boundaries
from terrafold.sources.contract import NEIGHBORHOODS_RAW, NEIGHBORHOODS_STAGE
from terrafold.sources.delimited import scan_landing

from conftest import SF


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_stage_and_curate_are_narrow_and_pruned(spark):
    st = boundaries.staged_customers(spark, SF)
    scan = scan_landing(spark, f"{st.raw}/product=neighborhoods", NEIGHBORHOODS_RAW,
                        prefix="neighborhoods", dates=["20240115"])
    p = plan(scan)
    assert "StartsWith(member" in p and "(file_date" in p          # partition pruning, not a post-filter
    snap = curate.snapshot(curate.scan(spark, st.history, NEIGHBORHOODS_STAGE, dates=["2024-01-15"]),
                           steps=[curate.clean_neighborhoods])
    p = plan(snap)
    assert "Exchange" not in p                                      # no shuffle in curate
    assert "PartitionFilters: [isnotnull(load_date" in p
    assert "file_name" not in p.split("ReadSchema:")[1].split("\n")[0]   # lineage columns not read


def test_geometry_never_shuffles_on_keys(spark):
    df = spark.createDataFrame([(str(i), "POLYGON ((0 0, 1 0, 1 1, 0 1, 0 0))") for i in range(50)],
                               "geo_id string, geoloc string")
    table, _ = G.shapes(df)
    p = plan(table)
    assert "hashpartitioning" not in p                              # only a round-robin spread of a small input
    assert p.count("(.*)") == 1                                     # the WKT body is extracted once


def test_key_check_is_partially_aggregated(spark):
    df = spark.createDataFrame([("01", str(i % 7)) for i in range(100)], "fips_code string, id string")
    p = plan(G.key_violations(df))
    assert p.count("HashAggregate") >= 2                            # map-side partial before the shuffle
