"""Manifest, watermark and new-delivery detection (M1-M9), F1/F2 edges."""

import json

import pytest
from pyspark.sql import functions as F

from terrafold.operators import delivery


def write_manifest(tmp, items, stamp="2022-01-11T18:57:53.123Z"):
    doc = {"result": {"last-updated": stamp, "inventory": [{"filename": f, "url": "u/" + f} for f in items]}}
    with open(f"{tmp}/m.json", "w") as fh:
        json.dump(doc, fh, indent=2)
    return f"{tmp}/m.json"


def test_manifest_classify_and_new(spark, tmp):
    items = ["20220110-neighborhoods-1m.zip", "20220111-neighborhoods-2n.zip",
             "20220112-neighborhoods-community-info.zip", "20220112-other.zip", "draft-neighborhoods.zip"]
    m = delivery.manifest(spark, write_manifest(tmp, items), multi_line=True)
    listing = spark.createDataFrame([("neighborhoods", n) for n in ["20211001", "20220111", "tmp", "2022_01"]],
                                    "product string, name string")
    wm = delivery.last_loaded(listing, products=["neighborhoods", "community_info"])
    assert {r["product"]: r["last_date"] for r in wm.collect()} == {"neighborhoods": "20220111",
                                                                     "community_info": "00000000"}
    inv = {r["filename"]: r for r in delivery.new_inventory(m, wm).collect()}
    assert inv["20220111-neighborhoods-2n.zip"]["is_new"] is False          # equal date: strict
    assert inv["20220110-neighborhoods-1m.zip"]["is_new"] is False
    assert inv["20220112-neighborhoods-community-info.zip"]["product"] == "community_info"
    assert inv["20220112-neighborhoods-community-info.zip"]["is_new"] is True
    assert inv["20220112-other.zip"]["product"] == ""
    assert inv["draft-neighborhoods.zip"]["prefix_ok"] is False and inv["draft-neighborhoods.zip"]["is_new"] is None
    assert m.first()["upload_date"] == "20220111"
    flags = {r["product"]: r["has_new"] for r in delivery.new_product_flags(delivery.new_inventory(m, wm)).collect()}
    assert flags == {"neighborhoods": False, "community_info": True}
    # combined watermark: the larger date hides the other product's pending files
    comb = delivery.new_inventory(m, wm, combined_mark=True)
    assert sorted(r["filename"] for r in comb.where("is_new").collect()) == [
        "20220112-neighborhoods-community-info.zip", "20220112-other.zip"]


def test_empty_listing_gives_zero_date(spark):
    listing = spark.createDataFrame([], "product string, name string")
    wm = delivery.last_loaded(listing, products=["neighborhoods"])
    assert [tuple(r) for r in wm.collect()] == [("neighborhoods", "00000000")]
    assert delivery.combined(wm).first()["last_date"] == "00000000"


def test_numeric_compare_not_string(spark):
    listing = spark.createDataFrame([("p", "9"), ("p", "10")], "product string, name string")
    assert delivery.last_loaded(listing).first()["last_date"] == "10"


def test_bad_upload_stamp_raises(spark, tmp):
    m = delivery.manifest(spark, write_manifest(tmp, ["20220101-neighborhoods.zip"], stamp="yesterday"), multi_line=True)
    with pytest.raises(Exception):
        delivery.upload_date(m).collect()


def test_gate_is_string_compare(spark):
    df = spark.createDataFrame([("20220111", "20220112"), ("20220112", "20220112")], "a string, b string")
    assert [r[0] for r in df.select(delivery.gate(F.col("a"), F.col("b"))).collect()] == [True, False]
