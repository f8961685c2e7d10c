"""Delivery archives -> text lines (L1).

A Python data source reads the directory at the end of every zip archive by ranged
reads and plans one partition per member (small members of one archive share one).
A task seeks to its member, inflates it piece by piece and emits bounded batches, so neither an archive
nor a member is ever held whole, and the members of one archive are unpacked side by side."""

from __future__ import annotations

import bz2
import fnmatch
import io
import os
import posixpath
import struct
import sys
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

LINES_SCHEMA = "archive string, member string, line_no long, value string"
MEMBERS_SCHEMA = "archive string, member string, bytes long, crc long"
FORMAT = "zip_members"
#: Compressed bytes read at once, and members that share a partition up to so many.
PIECE, PACK_BYTES = 1 << 20, 8 << 20


@dataclass
class Member:
    """Where a member's bytes lie, as the archive's directory has it."""

    path: str
    name: str
    offset: int
    packed: int
    size: int
    crc: int
    method: int


@dataclass
class Members(InputPartition):
    members: list[Member]


def _open(path: str):
    filesystem, inner = fs.FileSystem.from_uri(path if "://" in path else os.path.abspath(path))
    return filesystem, inner


def _archives(path: str, glob: str) -> list[str]:
    """Full paths of the archives below a folder (or the one archive named)."""
    path = path.rstrip("/")
    filesystem, inner = _open(path)
    scheme = path[: -len(inner)] if "://" in path and path.endswith(inner) else ""  # what names the store, if it is no local path
    info = filesystem.get_file_info(inner)
    found = [info] if info.type == fs.FileType.File else filesystem.get_file_info(fs.FileSelector(inner, recursive=True))
    return sorted(f"{scheme}{f.path}" for f in found if f.type == fs.FileType.File and fnmatch.fnmatch(posixpath.basename(f.path), glob))


def directory(path: str, suffix: str) -> list[Member]:
    """Members of an archive whose name ends with ``suffix``, read from its directory alone."""
    filesystem, inner = _open(path)
    with filesystem.open_input_file(inner) as f, zipfile.ZipFile(f) as z:
        out = []
        for i in z.infolist():
            if i.is_dir() or not i.filename.endswith(suffix):
                continue
            if i.flag_bits & 1:
                raise ValueError(f"{path}: {i.filename} is encrypted")
            out.append(Member(path, i.filename, i.header_offset, i.compress_size, i.file_size, i.CRC, i.compress_type))
    return out


def _inflater(method: int):
    if method == zipfile.ZIP_STORED:
        return None
    if method == zipfile.ZIP_DEFLATED:
        return zlib.decompressobj(-15)
    if method == zipfile.ZIP_BZIP2:
        return bz2.BZ2Decompressor()
    raise ValueError(f"unsupported compression method {method}")


def pieces(m: Member) -> Iterator[bytes]:
    """A member's content in pieces, checked against its size and checksum."""
    filesystem, inner = _open(m.path)
    inflate, left, size, crc = _inflater(m.method), m.packed, 0, 0
    with filesystem.open_input_file(inner) as f:
        f.seek(m.offset)
        # local header: 30 bytes, then its own copies of name and extra field
        head = f.read(30)
        name, extra = struct.unpack("<HH", head[26:30])
        f.seek(m.offset + 30 + name + extra)
        while left:
            got = f.read(min(PIECE, left))
            if not got:
                raise ValueError(f"{m.path}: {m.name} ends early")
            left -= len(got)
            for out in _inflated(inflate, got):
                size, crc = size + len(out), zlib.crc32(out, crc)
                yield out
    if size != m.size or crc != m.crc:
        raise ValueError(f"{m.path}: {m.name} is damaged")


def _inflated(inflate, got: bytes) -> Iterator[bytes]:
    """What a piece inflates to, itself in bounded pieces: a few bytes can hold gigabytes."""
    if inflate is None:
        yield got
    elif isinstance(inflate, bz2.BZ2Decompressor):
        while got or not (inflate.needs_input or inflate.eof):
            out = inflate.decompress(got, 4 * PIECE)
            got = b""
            if out:
                yield out
            if inflate.eof:
                return
    else:
        while got:
            out = inflate.decompress(got, 4 * PIECE)
            got = inflate.unconsumed_tail
            if out:
                yield out


class _Stream(io.RawIOBase):
    def __init__(self, parts: Iterator[bytes]):
        self.parts, self.rest = parts, memoryview(b"")

    def readable(self) -> bool:
        return True

    def readinto(self, b) -> int:
        while not self.rest:
            part = next(self.parts, None)
            if part is None:
                return 0
            self.rest = memoryview(part)
        n = min(len(b), len(self.rest))
        b[:n] = self.rest[:n]
        self.rest = self.rest[n:]
        return n


class ZipReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.glob, self.suffix = options["path"], options.get("glob", "*.zip"), options.get("suffix", "")
        self.encoding, self.rows, self.bytes = options.get("encoding", "utf-8"), int(options.get("batchrows", "50000")), int(options.get("batchbytes", str(16 << 20)))
        self.lines = options.get("what", "lines") == "lines"

    def partitions(self) -> list[InputPartition]:
        out = []
        for archive in _archives(self.path, self.glob):
            pack, total = [], 0
            for m in directory(archive, self.suffix):
                if pack and self.lines and total + m.packed > PACK_BYTES:
                    out.append(Members(pack))
                    pack, total = [], 0
                pack.append(m)
                total += m.packed
            if pack:
                out.append(Members(pack))
        return out or [Members([])]

    def read(self, partition: Members) -> Iterator[pa.RecordBatch]:
        if not self.lines:
            rows = [(posixpath.basename(m.path), posixpath.basename(m.name), m.size, m.crc) for m in partition.members]
            cols = list(zip(*rows, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.string(), pa.int64(), pa.int64()), strict=True)],
                                             names=["archive", "member", "bytes", "crc"])
            return
        for m in partition.members:
            archive, member = posixpath.basename(m.path), posixpath.basename(m.name)
            values, first, size = [], 0, 0
            for line in io.TextIOWrapper(io.BufferedReader(_Stream(pieces(m)), PIECE), encoding=self.encoding, newline=""):
                values.append(line.rstrip("\r\n"))
                size += len(line)
                if len(values) >= self.rows or size >= self.bytes:
                    yield _batch(archive, member, first, values)
                    values, first, size = [], first + len(values), 0
            if values:
                yield _batch(archive, member, first, values)


def _batch(archive: str, member: str, first: int, values: list[str]) -> pa.RecordBatch:
    n = len(values)
    return pa.RecordBatch.from_arrays([pa.array([archive] * n, pa.string()), pa.array([member] * n, pa.string()), pa.array(range(first, first + n), pa.int64()),
                                       pa.array(values, pa.string())], names=["archive", "member", "line_no", "value"])


class ZipMembers(DataSource):
    """Lines of the members of zip archives, or (what=members) the members themselves with size and checksum."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return LINES_SCHEMA if self.options.get("what", "lines") == "lines" else MEMBERS_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return ZipReader(dict(self.options))


def _read(spark: SparkSession, path: str, **options) -> DataFrame:
    # the worker that plans a data source gets no package of this session, so the classes travel by value
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(ZipMembers)
    return spark.read.format(FORMAT).options(path=path, **{k: str(v) for k, v in options.items()}).load()


def unpack(spark: SparkSession, path: str, suffix: str = ".tsv", glob: str = "*.zip",
           batch_rows: int = 50_000, encoding: str = "utf-8", batch_bytes: int = 16 << 20) -> DataFrame:
    """L1: one row per line of every member ending with ``suffix``; the
    member name is its base name, folders inside the archive are dropped. A batch
    ends at ``batch_rows`` lines or ``batch_bytes`` characters: a line can hold a whole polygon.
    A damaged or cut member fails the job. An empty member has no line (see :func:`members`)."""
    return _read(spark, path, suffix=suffix, glob=glob, batchrows=batch_rows, encoding=encoding, batchbytes=batch_bytes)


def members(spark: SparkSession, path: str, suffix: str = ".tsv", glob: str = "*.zip") -> DataFrame:
    """Every member ending with ``suffix``, empty ones too: archive, member, bytes, crc. Only the archives' directories are read."""
    return _read(spark, path, what="members", suffix=suffix, glob=glob)
