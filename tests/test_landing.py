"""Archive unpack (L1) and raw landing (L2), F3 edges."""

import io
import random
import zipfile

import pytest

from terrafold.operators import delivery, landing
from terrafold.sources import archive


def test_unpack_and_land(spark, tmp):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        zf.writestr("deep/folder/neighborhoods-1m.tsv", "a\tb\nc\td\n")
        zf.writestr("readme.txt", "skip me\n")
        zf.writestr("empty.tsv", "")
    import os
    os.makedirs(f"{tmp}/zips")
    with open(f"{tmp}/zips/20220112-neighborhoods-x.zip", "wb") as fh:
        fh.write(buf.getvalue())
    lines = landing.label(archive.unpack(spark, f"{tmp}/zips"))
    got = sorted(tuple(r) for r in lines.select("product", "file_date", "member", "value").collect())
    assert got == [("neighborhoods", "20220112", "neighborhoods-1m.tsv", "a\tb"),
                   ("neighborhoods", "20220112", "neighborhoods-1m.tsv", "c\td")]
    landing.land(lines, f"{tmp}/raw")
    back = spark.read.text(f"{tmp}/raw/product=neighborhoods/file_date=20220112/member=neighborhoods-1m.tsv")
    assert sorted(r[0] for r in back.collect()) == ["a\tb", "c\td"]
    listing = delivery.listing(spark, f"{tmp}/raw")
    assert [tuple(r) for r in listing.collect()] == [("neighborhoods", "20220112")]


def zipped(path, members, method=zipfile.ZIP_DEFLATED):
    with zipfile.ZipFile(path, "w", method) as z:
        for name, data in members.items():
            if isinstance(data, bytes):
                z.writestr(name, data)
            else:  # a streamed member with 64-bit sizes
                with z.open(name, "w", force_zip64=True) as f:
                    for part in data:
                        f.write(part)


def test_members_are_partitions_and_lines_are_those_of_the_files(spark, tmp_path):
    rng = random.Random(1)
    texts = {}
    for k, method in enumerate((zipfile.ZIP_DEFLATED, zipfile.ZIP_STORED, zipfile.ZIP_BZIP2)):
        files = {f"d{i}/m{k}-{i}.tsv": "".join(rng.choice("ab\té漢") * rng.randrange(0, 50) + rng.choice(["\n", "\r\n"]) for _ in range(300)) + "no end" for i in range(4)}
        zipped(tmp_path / f"2022011{k}-neighborhoods.zip", {n: t.encode() for n, t in files.items()} | {"notes.txt": b"skip"}, method)
        texts |= {n.split("/")[1]: t for n, t in files.items()}
    (tmp_path / "deep").mkdir()
    zipped(tmp_path / "deep" / "20220120-x.zip", {"big.tsv": (b"0123456789\n" * 100_000 for _ in range(8))})   # 8.8 MB of repeats inflate from little
    df = archive.unpack(spark, str(tmp_path), batch_rows=70)
    assert "binaryFile" not in df._jdf.queryExecution().toString()
    got = {}
    for r in df.where("member <> 'big.tsv'").orderBy("member", "line_no").collect():
        got.setdefault(r["member"], []).append(r["value"])
    assert got == {n: [x.rstrip("\r\n") for x in t.splitlines(True)] for n, t in texts.items()}
    big = df.where("member = 'big.tsv'")
    assert big.count() == 800_000 and big.agg({"line_no": "max"}).first()[0] == 799_999 and big.select("value").distinct().count() == 1
    archive.PACK_BYTES, was = 1, archive.PACK_BYTES
    try:
        parts = archive.ZipReader({"path": str(tmp_path), "suffix": ".tsv"}).partitions()
    finally:
        archive.PACK_BYTES = was
    assert len(parts) == 13 and all(len(p.members) == 1 for p in parts)


def test_a_damaged_member_fails(tmp_path):
    zipped(tmp_path / "a.zip", {"m.tsv": b"hello world\n" * 5000}, zipfile.ZIP_STORED)
    data = bytearray((tmp_path / "a.zip").read_bytes())
    data[200] ^= 1
    (tmp_path / "a.zip").write_bytes(bytes(data))
    reader = archive.ZipReader({"path": str(tmp_path), "suffix": ".tsv"})
    with pytest.raises(ValueError, match="damaged"):
        list(reader.read(reader.partitions()[0]))


def test_empty_members_land_as_empty_files(spark, tmp_path):
    zipped(tmp_path / "20220112-neighborhoods.zip", {"a.tsv": b"x\n", "none.tsv": b""})
    root = f"{tmp_path}/raw"
    landing.land(spark.createDataFrame([("neighborhoods", "20220112", "none.tsv", "old")], "product string, file_date string, member string, value string"), root)
    found = landing.label(archive.members(spark, str(tmp_path)))
    landing.land(landing.label(archive.unpack(spark, str(tmp_path))), root)
    assert landing.land_empty(found, root) == 1
    assert sorted(r[0] for r in spark.read.text(root).select("member").union(spark.read.text(root).select("value")).collect()) == ["a.tsv", "x"]
    import os
    assert [f for f in os.listdir(f"{root}/product=neighborhoods/file_date=20220112/member=none.tsv") if not f.startswith(".")] == ["part-empty.txt"]


def test_ledger_tells_new_changed_renamed_and_resent(spark, tmp_path):
    (tmp_path / "one").mkdir()
    (tmp_path / "two").mkdir()
    zipped(tmp_path / "one" / "20220112-neighborhoods.zip", {"a.tsv": b"a\n", "b.tsv": b"b\n", "e.tsv": b""})
    zipped(tmp_path / "two" / "20220112-neighborhoods.zip", {"a.tsv": b"a\n", "b.tsv": b"B\n", "c.tsv": b"a\n", "d.tsv": b"d\n", "e.tsv": b"", "f.tsv": b""})
    path = f"{tmp_path}/ledger"
    first = landing.label(archive.members(spark, f"{tmp_path}/one"))
    assert {r["arrival"] for r in landing.arrivals(first, landing.ledger(spark, path)).collect()} == {"new"}
    landing.record(first, path)
    landing.record(first, path)
    got = landing.arrivals(landing.label(archive.members(spark, f"{tmp_path}/two")), landing.ledger(spark, path))
    assert {r["member"]: r["arrival"] for r in got.collect()} == {
        "a.tsv": "resent", "b.tsv": "changed", "c.tsv": "renamed", "d.tsv": "new", "e.tsv": "resent", "f.tsv": "new"}
    assert got.count() == 6
