"""Contracted scan, bad-row split and history."""

import datetime as dt
import os

from pyspark.sql import functions as F

from terrafold.functions.dates import load_date_from_path
from terrafold.operators import curate, landing, stage
from terrafold.plans import catalog, derive
from terrafold.plans.boundaries import curate_boundaries, stage_boundaries
from terrafold.sources import contract as C
from terrafold.sources.delimited import scan_folder

GOOD = "\t".join(["g1", " Name ", "CA", "6", "Metro", "", "County", "37", "-80.1234567", "34.5", "SRID=4326;POLYGON ((0 0, 1 0, 1 1, 0 1, 0 0))"])
ZERO = "\t".join(["g2", '""', "CA", "06", "M", "P", "C", "123", "0", "0", "POLYGON ((0 0, 1 0, 1 1, 0 1, 0 0))"])
TEXT_NUM = "\t".join(["g3", "n", "CA", "6", "M", "P", "C", "1", "abc", "1", "x"])
SHORT = "\t".join(["g4", "n", "CA", "6", "M"])
LONG = GOOD.replace("g1", "g5") + "\textra"
HEADER = "\t".join(f.name for f in C.NEIGHBORHOODS_RAW.fields if f.name != C.BAD)


def write_drop(root, day, name, lines):
    os.makedirs(f"{root}/{day}", exist_ok=True)
    with open(f"{root}/{day}/{name}", "w") as fh:
        fh.write("\n".join(lines) + "\n")


def test_contract_roundtrip(tmp):
    path = C.save(C.NEIGHBORHOODS_RAW, f"{tmp}/raw.json")
    back = C.load(path)
    assert back == C.NEIGHBORHOODS_RAW
    assert back["geo_id"].metadata == {"original_name": "id"}


def test_contract_roundtrip_through_spark(spark, tmp):
    for contract in (C.NEIGHBORHOODS_RAW, derive.wide_contract()):
        assert C.load(C.save(contract, f"{tmp}/c", spark), spark) == contract
    path = C.save(C.NEIGHBORHOODS_RAW, f"{tmp}/pretty.json")    # many lines, one record
    assert C.load(path, spark) == C.NEIGHBORHOODS_RAW


def test_wide_lines_tell_every_column_apart():
    w = derive.wide_contract(with_bad=False)
    assert len(w.fields) == 619 and len(set(w.fieldNames())) == 619
    texts = [derive.wide_value_sql(j, t) for j, t in enumerate(derive.wide_types(), 1)]
    assert len(set(texts)) == 619


def test_require_fails_on_missing(spark):
    import pytest

    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError):
        C.require(df, ["file_name"])


def test_scan_folder_split_and_lineage(spark, tmp):
    write_drop(f"{tmp}/raw", "20240115", "neighborhoods-1m.tsv", [HEADER, GOOD, ZERO, TEXT_NUM, SHORT, LONG])
    write_drop(f"{tmp}/raw", "20240115", "other.tsv", [GOOD])  # not matched by the prefix
    parsed = scan_folder(spark, f"{tmp}/raw/20240115", C.NEIGHBORHOODS_RAW, prefix="neighborhoods")
    st = stage.stamp(parsed, load_date_from_path(f"{tmp}/raw/20240115"), labels=("geo_type", "neighborhood_type"),
                     contract=C.NEIGHBORHOODS_RAW)
    good, bad, cached = stage.split(st, strategy="persist")
    g = {r["geo_id"]: r for r in good.collect()}
    b = sorted(r[0] for r in bad.collect())
    cached.unpersist()
    assert set(g) == {"g1", "g2"}
    assert len(b) == 4  # header, bad number, short row, long row
    assert HEADER in b and SHORT in b
    r = g["g1"]
    assert r["name"] == "Name" and r["incorporated_place"] is None          # trimmed; empty -> NULL
    assert str(r["longitude"]) == "-80.123457"                                 # rounded to the contract scale
    assert r["file_name"] == "neighborhoods-1m.tsv" and r["parent_folder_name"] == "20240115"
    assert r["geo_type"] == "neighborhoods-1m.tsv" and r["load_date"] == dt.date(2024, 1, 15)
    assert g["g2"]["name"] is None                                             # quoted empty -> NULL


def test_load_date_from_path():
    assert load_date_from_path("/x/raw/20220111") == dt.date(2022, 1, 11)
    assert load_date_from_path("/x/raw/file_date=20220111/") == dt.date(2022, 1, 11)
    assert load_date_from_path("/x/raw/latest", default=dt.date(2000, 1, 1)) == dt.date(2000, 1, 1)


def _land(spark, root, day, lines, member="neighborhoods-1m.tsv"):
    df = spark.createDataFrame([(v,) for v in lines], "value string").select(
        F.lit("neighborhoods").alias("product"), F.lit(day).alias("file_date"), F.lit(member).alias("member"), "value")
    landing.land(df, root)


def test_stage_good_plus_bad_is_raw_and_reload_keeps_other_dates(spark, tmp):
    raw, hist, bad = f"{tmp}/raw", f"{tmp}/hist", f"{tmp}/bad"
    lines = [HEADER, GOOD, ZERO, TEXT_NUM, SHORT, LONG]
    _land(spark, raw, "20240101", lines)
    _land(spark, raw, "20240201", lines + [GOOD.replace("g1", "g9")])
    counts = stage_boundaries(spark, raw, hist, bad, days=["20240101", "20240201"])
    assert counts["good"] + counts["bad"] == 13 and counts["good"] == 5
    # reload day 1 with fewer rows: day 2 must stay (dynamic overwrite)
    _land(spark, f"{tmp}/again", "20240101", [HEADER, GOOD])
    stage_boundaries(spark, f"{tmp}/again", hist, bad, days=["20240101"], load_date="2024-01-01")
    h = spark.read.orc(hist).groupBy(F.col("load_date").cast("string").alias("d")).count()
    assert {r["d"]: r["count"] for r in h.collect()} == {"2024-01-01": 1, "2024-02-01": 3}
    # catalog table over the history, partitions registered
    catalog.register(spark, C.NEIGHBORHOODS_STAGE, "tf_test.neighborhoods_hist", hist, partition_by="load_date")
    assert spark.table("tf_test.neighborhoods_hist").count() == 4
    latest = curate.latest_dates(spark, "tf_test.neighborhoods_hist")
    assert latest == ["2024-02-01"]
    one_day = curate.scan(spark, hist, C.NEIGHBORHOODS_STAGE, dates=latest)
    assert one_day.count() == 3
    # curate: contract read, fips_code filled, audit columns gone, stamp first
    cur = curate_boundaries(spark, hist, f"{tmp}/cur")
    assert cur.columns[0] == "created_datetime" and "load_date" not in cur.columns and "file_name" not in cur.columns
    r = cur.where("geo_id = 'g2'").first()
    assert r["fips_code"] == "06123" and r["longitude"] is None and r["geoloc"].startswith("POLYGON")
    assert r["geo_type"] == "neighborhood_lev_m" and r["neighborhood_type"] == "Neighborhood Level 1"


def test_contract_orc_scan_missing_and_extra(spark, tmp):
    df = spark.createDataFrame([(1, "a", "x")], "k long, name string, extra string")
    df.withColumn("load_date", F.lit("2024-01-01").cast("date")).write.partitionBy("load_date").orc(f"{tmp}/o")
    schema = "k long, name string, missing string, load_date date"
    out = curate.scan(spark, f"{tmp}/o", schema=spark.createDataFrame([], schema).schema)
    assert out.columns == ["k", "name", "missing", "load_date"]
    r = out.first()
    assert r["missing"] is None and r["load_date"] == dt.date(2024, 1, 1)
    assert curate.drop_audit(out).columns == ["k", "name", "missing"]


def test_ddl_generated_from_contract():
    text = catalog.ddl(C.NEIGHBORHOODS_STAGE, "db.t", "/loc", partition_by="load_date",
                       properties=catalog.EMPTY_AS_NULL_PROPERTIES)
    assert "`_bad_data`" not in text and "PARTITIONED BY (load_date)" in text
    assert text.index("`geoloc`") < text.index("`load_date`")
    wide = catalog.ddl(derive.wide_contract(), "db.w", "/w")
    assert wide.count("`c") == 619


def test_reparse_strategy_matches_persist(spark, tmp):
    from terrafold.operators import stage as S

    raw = f"{tmp}/raw"
    lines = [HEADER, GOOD, ZERO, TEXT_NUM, SHORT, LONG]
    _land(spark, raw, "20240101", lines)
    from terrafold.sources.delimited import scan_landing

    out = {}
    for strategy in ("persist", "reparse"):
        parsed = scan_landing(spark, f"{raw}/product=neighborhoods", C.NEIGHBORHOODS_RAW, prefix="neighborhoods")
        counts = S.run(spark, parsed, f"{tmp}/h_{strategy}", f"{tmp}/b_{strategy}", labels=("geo_type",),
                       contract=C.NEIGHBORHOODS_RAW, strategy=strategy)
        good = sorted(r["geo_id"] for r in spark.read.orc(f"{tmp}/h_{strategy}").collect())
        bad = sorted(r[0] for r in spark.read.text(f"{tmp}/b_{strategy}").collect())
        out[strategy] = (counts, good, bad)
    assert out["persist"] == out["reparse"]
    assert out["persist"][0] == {"good": 2, "bad": 4} and TEXT_NUM in out["persist"][2]


def test_rerun_is_idempotent(spark, tmp):
    """A retried job (e.g. after losing executors) leaves the same state:
    landing and staging the same delivery twice changes nothing."""
    raw, hist, bad = f"{tmp}/raw", f"{tmp}/hist", f"{tmp}/bad"
    lines = [HEADER, GOOD, ZERO, TEXT_NUM, SHORT, LONG]
    snapshots = []
    for _ in range(2):
        _land(spark, raw, "20240101", lines)
        counts = stage_boundaries(spark, raw, hist, bad, days=["20240101"])
        h = sorted((r["geo_id"], str(r["load_date"])) for r in spark.read.orc(hist).collect())
        b = sorted(r[0] for r in spark.read.text(bad).collect())
        landed = sorted(r[0] for r in spark.read.text(f"{raw}/product=neighborhoods").collect())
        snapshots.append((counts, h, b, landed))
    assert snapshots[0] == snapshots[1]


def test_shipped_contracts_are_the_code_constants():
    here = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "terrafold", "contracts")
    assert C.load(os.path.join(here, "neighborhoods_raw.json")) == C.NEIGHBORHOODS_RAW
    assert C.load(os.path.join(here, "neighborhoods_stage.json")) == C.NEIGHBORHOODS_STAGE
    lineage = {"created_datetime", "geo_type", "neighborhood_type", "fips_code", "load_date"}
    assert set(C.NEIGHBORHOODS_STAGE.fieldNames()) - lineage == set(C.NEIGHBORHOODS_RAW.fieldNames())


def test_reload_without_good_rows_clears_the_date(spark, tmp):
    hist = f"{tmp}/hist"
    _land(spark, f"{tmp}/raw", "20240101", [HEADER, GOOD])
    _land(spark, f"{tmp}/raw", "20240201", [HEADER, GOOD])
    stage_boundaries(spark, f"{tmp}/raw", hist, days=["20240101", "20240201"])
    _land(spark, f"{tmp}/again", "20240101", [SHORT, LONG])
    counts = stage_boundaries(spark, f"{tmp}/again", hist, days=["20240101"])
    assert counts == {"good": 0, "bad": 2}  # counted although no folder was given
    assert [str(r[0]) for r in spark.read.orc(hist).select("load_date").collect()] == ["2024-02-01"]


def _switch_table(spark, tmp, name):
    spark.sql("CREATE SCHEMA IF NOT EXISTS tf_reload")
    catalog.register(spark, C.NEIGHBORHOODS_STAGE, f"tf_reload.{name}", f"{tmp}/table", partition_by="load_date", repair=False)
    return f"tf_reload.{name}"


def _reload(spark, tmp, table, n, lines, days=("20240115",)):
    from terrafold.plans.boundaries import reload_boundaries

    df = spark.createDataFrame([("neighborhoods", d, "neighborhoods-1m.tsv", v) for d in days for v in lines], "product string, file_date string, member string, value string")
    landing.land(df, f"{tmp}/raw{n}")
    return reload_boundaries(spark, f"{tmp}/raw{n}", table, f"{tmp}/runs", f"{tmp}/bad{n}", days=list(days), bad_by="parent_folder_name")


def _ids(spark, table):
    return sorted((str(r["load_date"]), r["geo_id"]) for r in spark.table(table).collect())


def test_reload_parses_once_and_splits(spark, tmp):
    table = _switch_table(spark, tmp, "once")
    got = _reload(spark, tmp, table, 1, [HEADER, GOOD, ZERO, TEXT_NUM, SHORT, LONG], days=("20240115", "20240116"))
    assert got == {"good": 4, "bad": 8}
    assert _ids(spark, table) == [("2024-01-15", "g1"), ("2024-01-15", "g2"), ("2024-01-16", "g1"), ("2024-01-16", "g2")]
    bad = spark.read.text(f"{tmp}/bad1")
    assert sorted(r[0] for r in bad.where("parent_folder_name = 20240115").select("value").collect()) == sorted([HEADER, TEXT_NUM, SHORT, LONG])
    # the same rows as the two-pass job
    stage_boundaries(spark, f"{tmp}/raw1", f"{tmp}/hist", f"{tmp}/bad_two", days=["20240115", "20240116"])
    cols = [c for c in C.NEIGHBORHOODS_STAGE.fieldNames() if c not in ("created_datetime", C.BAD)]
    two = spark.read.schema(C.NEIGHBORHOODS_STAGE).orc(f"{tmp}/hist").select(*cols)
    assert sorted(map(str, spark.table(table).select(*cols).collect())) == sorted(map(str, two.collect()))


def test_one_scan_of_the_text_feeds_both_outcomes(spark, tmp, monkeypatch):
    plans = []
    monkeypatch.setattr(stage, "switch", lambda *a: None)
    write = type(spark.range(1).write).orc

    def orc(self, path, **kw):
        plans.append((path, self._df._jdf.queryExecution().executedPlan().toString()))
        return write(self, path, **kw)
    monkeypatch.setattr(type(spark.range(1).write), "orc", orc)
    _reload(spark, tmp, _switch_table(spark, tmp, "plan"), 1, [GOOD, SHORT])
    assert len(plans) == 1 and plans[0][1].count("FileScan csv") == 1 and "InMemoryTableScan" not in plans[0][1]


def test_a_run_that_fails_before_the_switch_leaves_the_old_rows(spark, tmp, monkeypatch):
    import pytest

    table = _switch_table(spark, tmp, "fails")
    _reload(spark, tmp, table, 1, [GOOD, ZERO])
    with monkeypatch.context() as m:
        m.setattr(stage, "switch", lambda *a: (_ for _ in ()).throw(RuntimeError("lost the driver")))
        with pytest.raises(RuntimeError, match="lost the driver"):
            _reload(spark, tmp, table, 2, [GOOD.replace("g1", "g9")])
    assert _ids(spark, table) == [("2024-01-15", "g1"), ("2024-01-15", "g2")]
    _reload(spark, tmp, table, 3, [GOOD.replace("g1", "g9")])
    assert _ids(spark, table) == [("2024-01-15", "g9")]
    _reload(spark, tmp, table, 4, [SHORT])
    assert _ids(spark, table) == []


def test_a_failed_snapshot_leaves_the_old_one(spark, tmp):
    import pytest

    spark.sql("CREATE SCHEMA IF NOT EXISTS tf_reload")
    spark.sql("DROP TABLE IF EXISTS tf_reload.snap")
    spark.sql(f"CREATE TABLE tf_reload.snap (id BIGINT) USING ORC LOCATION '{tmp}/none'")
    curate.replace(spark.range(3), "tf_reload.snap", f"{tmp}/snaps")
    with pytest.raises(Exception):
        curate.replace(spark.range(5).selectExpr("raise_error('bad row') AS id"), "tf_reload.snap", f"{tmp}/snaps")
    assert spark.table("tf_reload.snap").count() == 3
    curate.replace(spark.range(5), "tf_reload.snap", f"{tmp}/snaps")
    assert spark.table("tf_reload.snap").count() == 5


def test_headers_bind_columns(spark, tmp):
    import bz2

    from terrafold.sources.delimited import column_order, scan_headed

    names = [f.metadata.get("original_name", f.name) for f in C.NEIGHBORHOODS_RAW.fields if f.name != C.BAD]
    fields = GOOD.split("\t")
    back = list(reversed(range(11)))
    write_drop(f"{tmp}/v", "20240115", "neighborhoods-a.tsv", ["\t".join(names), GOOD, SHORT])
    os.makedirs(f"{tmp}/v/20240115/with space")
    with open(f"{tmp}/v/20240115/neighborhoods b%20c.tsv.bz2", "wb") as fh:
        fh.write(bz2.compress(("\t".join(f' "{names[i].upper()}" ' for i in back) + "\r\n" + "\t".join(fields[i] for i in back).replace("g1", "g7") + "\n").encode()))
    write_drop(f"{tmp}/v", "20240115", "neighborhoods-x.tsv", ["\t".join(names[:-1] + ["what"]), GOOD])
    write_drop(f"{tmp}/v", "20240115", "neighborhoods-y.tsv", [GOOD])
    open(f"{tmp}/v/20240115/neighborhoods-empty.tsv", "w").close()
    df = scan_headed(spark, f"{tmp}/v/20240115", C.NEIGHBORHOODS_RAW, prefix="neighborhoods")
    assert df.columns == scan_folder(spark, f"{tmp}/v/20240115", C.NEIGHBORHOODS_RAW, prefix="neighborhoods").columns
    rows = df.collect()
    good = {r["geo_id"]: r for r in rows if r[C.BAD] is None}
    assert set(good) == {"g1", "g7"} and good["g7"]["state_abbr"] == "CA" and good["g7"]["geoloc"].startswith("SRID") and good["g7"]["metro"] == "Metro"
    assert good["g1"]["parent_folder_name"] == "20240115" and good["g7"]["file_name"].endswith(".tsv.bz2")
    bad = sorted((r["file_name"], r[C.BAD]) for r in rows if r[C.BAD] is not None)
    assert bad == sorted([("neighborhoods-a.tsv", SHORT), ("neighborhoods-x.tsv", "\t".join(names[:-1] + ["what"])), ("neighborhoods-x.tsv", GOOD), ("neighborhoods-y.tsv", GOOD)])
    assert column_order("\t".join(names + names[:1]), C.without(C.NEIGHBORHOODS_RAW, C.BAD)) is None
