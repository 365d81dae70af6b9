"""WARC records in ZIP packages: written by Spark's file writer, read back by byte ranges.

A package is a ZIP file of stored members: ``archive/*.warc.gz``, one gzip member per
record, each followed by its index ``indexes/*.cdxj`` (one line per record: place,
length). Reading takes steps, each a table:

1. ``members``: central directories, ZIP64 ones too, by a few reads at the end of each file.
2. ``locations``: lines of the index members, joined to the archive members they
   name; archive members no index names are walked record by record.
3. ``records``: ranges sorted by file and place, read in spans, parsed. No member is
   read as a whole, nothing is extracted to disk.

Files are opened where tasks run, by their URI (``pyarrow.fs``: file, hdfs, viewfs,
s3, gs, abfs).
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import zlib
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import zip_files
from .common import parallelism, stored
from .zip_files import BadPackage

MEMBER_BYTES = 4 << 20  # an archive member is closed when it has so many
SPAN = 4 << 20  # neighbouring ranges are read together up to this length
STEP = 1 << 18  # bytes read at once where a member is walked
DATE = "2020-01-01T00:00:00Z"

# Names of the formats.
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
GZIP = b"\x1f\x8b"

_LINE_END = re.compile(rb"\r?\n")


# --- records ---------------------------------------------------------------------
def base32(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode("ascii")


def _field(name: str, value: str | None) -> str:
    """A header line; line ends inside a value are percent-encoded, a missing value gives none."""
    if value is None:
        return ""
    return f"{name}: " + value.replace("\r", "%0D").replace("\n", "%0A") + "\r\n"


def record(kind: str, record_id: str, own: str | None, uri: str | None, digest: str, payload: bytes, refers_to: str | None, date: str) -> bytes:
    """One WARC record; that of a revisit has the response's headers but no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if kind == "revisit":
        http, payload = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n", b""
    head = (
        f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:uuid:{record_id}>\r\nWARC-Date: {date}\r\n"
        + _field("WARC-Target-URI", uri)
        + f"WARC-Payload-Digest: sha1:{digest}\r\n"
        + _field("X-Capture-ID", own)
        + (f"WARC-Profile: {IDENTICAL}\r\nWARC-Refers-To: <urn:uuid:{refers_to}>\r\n" if kind == "revisit" else "")
        + f"Content-Type: application/http;msgtype=response\r\nContent-Length: {len(http) + len(payload)}\r\n\r\n"
    )
    return b"".join([head.encode("utf-8", "surrogatepass"), http, payload, b"\r\n\r\n"])


def _headers(raw: bytes) -> dict[str, str]:
    out = {}
    for line in _LINE_END.split(raw)[1:]:
        name, _, value = line.partition(b":")
        out.setdefault(name.strip().lower().decode("latin-1"), value.strip().decode("utf-8", "replace"))
    return out


def parsed(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (names in lower case) and payload of one record, gzipped or not."""
    if raw[:2] == GZIP:
        unzip = zlib.decompressobj(31)
        raw = unzip.decompress(raw) + unzip.flush()
        if not unzip.eof:
            raise BadPackage("a record's gzip member is cut")
    if raw[:5] != b"WARC/":
        raise BadPackage("no record at this place")
    head, gap, rest = raw.partition(b"\r\n\r\n")
    fields = _headers(head)
    length = int(fields.get("content-length", "-1"))
    if not gap or length < 0 or length > len(rest):
        raise BadPackage("a record is cut")
    block = rest[:length]
    if fields.get("content-type", "").startswith("application/http"):
        block = block.partition(b"\r\n\r\n")[2]
    return fields, block


# --- writing ---------------------------------------------------------------------
def _uuid(text: Column) -> Column:
    """A name-based identifier: a digest in the usual groups."""
    return F.regexp_replace(F.md5(text.cast("binary")), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def _keyed(pages: DataFrame, own: str, uri: str, payload: str) -> DataFrame:
    """own, uri, body, size, digest (hexadecimal SHA-1) and key: one for rows alike in id, address and payload."""
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    named = pages.select(F.col(own).alias("own"), F.col(uri).alias("uri"), body.alias("body"))
    named = named.withColumn("size", F.octet_length("body").cast("long")).withColumn("digest", F.sha1("body"))
    of_row = F.to_json(F.struct(F.col("own").cast("string"), F.col("uri"), F.col("digest")), {"ignoreNullFields": "false"})
    return named.withColumn("key", _uuid(of_row))


def captures(pages: DataFrame, own: str, uri: str, payload: str, least_bytes: int = 0) -> DataFrame:
    """Records to write: kind, record_id, own (text), uri, digest, body, refers_to.

    Of rows with equal payloads of at least ``least_bytes`` bytes that with the
    greatest id (then address) is the response; smaller payloads are all responses.
    Payloads are moved only where the planner can't broadcast the thin table of rows
    that are no response; a payload's rows are counted in parts first.
    """
    rows = _keyed(pages, own, uri, payload)
    alike = rows.groupBy("key", "digest", "size", "own", "uri").agg(F.count(F.lit(1)).alias("n"))
    alike = stored(alike, "captures")
    shared = alike.where(F.col("size") >= least_bytes).groupBy("digest").agg(
        F.max(F.struct("own", "uri", "key"))["key"].alias("response"), F.count(F.lit(1)).alias("keys")
    )
    # Only payloads of several rows are joined back: others are their own response.
    others = alike.join(shared.where("keys > 1"), "digest").where("key <> response")
    others = stored(others.select("key", "digest", "own", "uri", "n", "response"), "revisits")
    several = alike.where("n > 1")

    once = rows.join(others.select("key"), "key", "left_anti").join(several.select("key"), "key", "left_anti")
    repeated = several.join(others.select("key"), "key", "left_anti")
    big = F.col("size") >= least_bytes
    # Rows alike in all: the first is the response, the others revisit it, or all are responses when small.
    bodies = rows.join(repeated.select("key", "n"), "key").groupBy("key", "digest", "size", "own", "uri", "n").agg(F.first("body").alias("body"))
    copies = bodies.withColumn("nth", F.explode(F.when(big, F.array(F.lit(1))).otherwise(F.sequence(F.lit(1), F.col("n").cast("int")))))
    again = repeated.where(big).withColumn("nth", F.explode(F.sequence(F.lit(2), F.col("n").cast("int")))).withColumn("response", F.col("key"))
    thin = others.withColumn("nth", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))

    nth_id = F.when(F.col("nth") == 1, F.col("key")).otherwise(_uuid(F.concat_ws(":", "key", "nth")))
    text = F.col("own").cast("string").alias("own")
    none = F.lit(None).cast("string")

    def response(df: DataFrame, record_id: Column) -> DataFrame:
        return df.select(F.lit("response").alias("kind"), record_id.alias("record_id"), text, "uri", "digest", "body", none.alias("refers_to"))

    def revisit(df: DataFrame) -> DataFrame:
        return df.select(
            F.lit("revisit").alias("kind"), nth_id.alias("record_id"), text, "uri", "digest",
            F.lit(None).cast("binary").alias("body"), F.col("response").alias("refers_to"),
        )

    return response(once, F.col("key")).unionByName(response(copies, nth_id)).unionByName(revisit(thin)).unionByName(
        revisit(again.select(*thin.columns))
    )


def write(records: DataFrame, path: str, member_bytes: int = MEMBER_BYTES, zip64_from: int = zip_files.MOST32, date: str = DATE) -> None:
    """One package per task under ``path``; what a lost task left is never seen."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        package, number = zip_files.Writer(zip64_from), 0
        data, lines, size = [], [], 0

        def closed() -> pa.RecordBatch:
            nonlocal number, data, lines, size
            piece = package.member(f"archive/{number:05d}.warc.gz", b"".join(data))
            piece += package.member(f"indexes/{number:05d}.cdxj", "".join(lines).encode())
            number, data, lines, size = number + 1, [], [], 0
            return row(piece)

        def row(piece: bytes) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([piece[:-1]], pa.binary())], names=["piece"])

        any_row = False
        for batch in batches:
            columns = [batch.column(c) for c in ("kind", "record_id", "own", "uri", "digest", "body", "refers_to")]
            for i in range(batch.num_rows):
                any_row = True
                kind, record_id, own, uri, digest, body, refers_to = (c[i].as_py() for c in columns)
                digest = base32(bytes.fromhex(digest))
                raw = record(kind, record_id, own, uri, digest, body or b"", refers_to, date)
                zipped = zlib.compressobj(1, zlib.DEFLATED, 31)
                zipped = zipped.compress(raw) + zipped.flush()
                about = {"url": uri or "", "digest": f"sha1:{digest}", "offset": str(size), "length": str(len(zipped)), "filename": f"{number:05d}.warc.gz"}
                lines.append(f"{record_id} {date[:4]} {json.dumps(about)}\n")
                data.append(zipped)
                size += len(zipped)
                if size >= member_bytes:
                    yield closed()
        if lines:
            yield closed()
        if any_row:
            yield row(package.end())

    pieces = records.mapInArrow(pack, "piece binary")
    pieces.select(F.col("piece").cast("string").alias("value")).write.option("lineSep", "\n").option("compression", "none").text(path)


# --- reading ---------------------------------------------------------------------
@contextmanager
def _open(uri: str):
    uri = re.sub("^file:/+", "file:///", uri)
    uri = re.sub("^s3[an]:", "s3:", uri)
    system, path = pafs.FileSystem.from_uri(uri)
    with system.open_input_file(path) as f:
        yield f


def _tasks(df: DataFrame, *keys: str) -> DataFrame:
    return df.repartition(parallelism(df.sparkSession), *keys)


def _rows(names: list[str], kinds: list[pa.DataType], rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else ([] for _ in names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _flushed(found: Iterator[tuple], names: list[str], kinds: list[pa.DataType], at_once: int = 5000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for r in found:
        held.append(r)
        if len(held) >= at_once:
            yield _rows(names, kinds, held)
            held = []
    yield _rows(names, kinds, held)


def packages(spark: SparkSession, path: str) -> DataFrame:
    """(path, size) of the files below ``path``; contents are not read. Empty files hold no package."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", F.col("length").alias("size")).where("size > 0")


def members(files: DataFrame) -> DataFrame:
    """(path, name, at, length, problem) of every member; a file that is no package has one row with its problem."""
    names = ["path", "name", "at", "length", "problem"]
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]

    def of_file(path: str, size: int) -> Iterator[tuple]:
        try:
            with _open(path) as f:
                for m in zip_files.members(f, size):
                    if m.name.endswith("/"):
                        continue
                    if m.method != zip_files.STORED or m.encrypted:
                        yield path, m.name, None, m.length, "not stored: its bytes can't be read by ranges"
                        continue
                    yield path, m.name, zip_files.data_at(f, m), m.length, None
        except (BadPackage, OSError) as e:
            yield path, None, None, None, str(e)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, size in zip(batch.column("path").to_pylist(), batch.column("size").to_pylist(), strict=True):
                yield from _flushed(of_file(path, size), names, kinds)

    return _tasks(files, "path").mapInArrow(read, "path string, name string, at long, length long, problem string")


def _lines(f, at: int, length: int) -> Iterator[bytes]:
    held = b""
    for start in range(at, at + length, STEP):
        *whole, held = (held + zip_files.read_at(f, start, min(STEP, at + length - start))).split(b"\n")
        yield from whole
    if held:
        yield held


def _index(parts: DataFrame) -> DataFrame:
    """(path, file, offset, length) of the lines of all index members."""

    def of_member(path: str, at: int, length: int) -> Iterator[tuple]:
        with _open(path) as f:
            for line in _lines(f, at, length):
                brace = line.find(b"{")
                if brace >= 0:
                    about = json.loads(line[brace:])
                    yield path, about["filename"].rpartition("/")[2], int(about["offset"]), int(about["length"])

    names, kinds = ["path", "file", "offset", "length"], [pa.string(), pa.string(), pa.int64(), pa.int64()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.select(["path", "at", "length"]).to_pylist():
                yield from _flushed(of_member(r["path"], r["at"], r["length"]), names, kinds)

    return _tasks(parts, "path", "at").mapInArrow(read, "path string, file string, offset long, length long")


def walk(f, at: int, length: int) -> Iterator[tuple[int, int]]:
    """(place, length) of the records of an archive member without an index, from its own bytes.

    Plain records are stepped over by their lengths, gzip members are unzipped in bounded steps.
    """
    end = at + length
    while at < end:
        start = at
        if zip_files.read_at(f, at, min(2, end - at)) == GZIP:
            unzip = zlib.decompressobj(31)
            while not unzip.eof:
                if at >= end:
                    raise BadPackage("the last record is cut")
                data = zip_files.read_at(f, at, min(STEP, end - at))
                at += len(data)
                while data and not unzip.eof:
                    unzip.decompress(data, STEP)
                    data = unzip.unconsumed_tail
            at -= len(unzip.unused_data)
        else:
            head, gap = b"", -1
            while gap < 0:
                if start + len(head) >= end:
                    raise BadPackage("the last record is cut")
                head += zip_files.read_at(f, start + len(head), min(4096, end - start - len(head)))
                gap = head.find(b"\r\n\r\n")
            if head[:5] != b"WARC/":
                raise BadPackage("no record at this place")
            at = start + gap + 4 + int(_headers(head[:gap]).get("content-length", "0"))
            at += len(b"\r\n\r\n")
        yield start, at - start


def _walked(parts: DataFrame) -> DataFrame:
    def of_member(path: str, at: int, length: int) -> Iterator[tuple]:
        try:
            with _open(path) as f:
                for start, n in walk(f, at, length):
                    yield path, start, n, None
        except (BadPackage, OSError, zlib.error) as e:
            yield path, at, None, str(e)

    names, kinds = ["path", "at", "length", "problem"], [pa.string(), pa.int64(), pa.int64(), pa.string()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.select(["path", "at", "length"]).to_pylist():
                yield from _flushed(of_member(r["path"], r["at"], r["length"]), names, kinds)

    return _tasks(parts, "path", "at").mapInArrow(read, "path string, at long, length long, problem string")


def locations(parts: DataFrame) -> DataFrame:
    """(path, at, length, problem) of every record of the archive members of ``parts`` (see ``members``)."""
    good = parts.where("problem is null")
    archives = good.where(F.col("name").rlike(r"(?i)\.warc(\.gz)?$")).withColumn("file", F.regexp_extract("name", "([^/]*)$", 1))
    lines = stored(_index(good.where(F.col("name").rlike(r"(?i)\.cdxj?$"))), "index")
    named = lines.join(archives.select("path", "file", F.col("at").alias("start")), ["path", "file"])
    known = named.select("path", (F.col("start") + F.col("offset")).alias("at"), "length", F.lit(None).cast("string").alias("problem"))
    alone = archives.join(lines.select("path", "file").distinct(), ["path", "file"], "left_anti")
    bad = parts.where("problem is not null").select("path", "at", F.lit(None).cast("long").alias("length"), "problem")
    return known.unionByName(_walked(alone)).unionByName(bad)


def _spans(ranges: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, int, list[tuple[int, int]]]]:
    """Neighbouring ranges of one file as one read of at most SPAN bytes (or one longer range)."""
    held: list[tuple[int, int]] = []
    path, first, last = "", 0, 0
    for p, at, n in ranges:
        if held and p == path and at >= first and max(last, at + n) - first <= SPAN and at - last <= STEP:
            held.append((at, n))
            last = max(last, at + n)
            continue
        if held:
            yield path, first, last, held
        path, first, last, held = p, at, at + n, [(at, n)]
    if held:
        yield path, first, last, held


def records(places: DataFrame, with_payload: bool = True) -> DataFrame:
    """One row per record: path, at, record_type, record_id, own, uri, digest, refers_to, payload_bytes, payload_digest, payload, problem.

    ``digest`` is what the header states, ``payload_digest`` that of the payload read.
    A record or package that can't be read is a row with its problem. Ranges are dealt
    by file and place, so a package of any size is read by many tasks.
    """
    names = ["path", "at", "record_type", "record_id", "own", "uri", "digest", "refers_to", "payload_bytes", "payload_digest", "payload", "problem"]
    kinds = [pa.string(), pa.int64(), *[pa.string()] * 6, pa.int64(), pa.string(), pa.binary(), pa.string()]

    def identifier(value: str | None) -> str | None:
        return value if value is None else value.strip("<>").removeprefix("urn:uuid:")

    def row(path: str, at: int, raw: bytes) -> tuple:
        try:
            fields, payload = parsed(raw)
        except (BadPackage, ValueError, zlib.error) as e:
            return path, at, *[None] * 9, str(e)
        stated = fields.get("warc-payload-digest")
        found = base32(hashlib.sha1(payload).digest())
        kind = fields.get("warc-type")
        differs = kind != "revisit" and stated is not None and stated.startswith("sha1:") and stated[5:] != found
        return (
            path, at, kind, identifier(fields.get("warc-record-id")), fields.get("x-capture-id"), fields.get("warc-target-uri"),
            None if stated is None else stated.removeprefix("sha1:"), identifier(fields.get("warc-refers-to")),
            len(payload), found, payload if with_payload else None, "the payload has another digest" if differs else None,
        )

    def of_spans(rows: list[tuple[str, int, int]]) -> Iterator[tuple]:
        opened, path_now = None, None
        try:
            for path, first, last, own in _spans(rows):
                try:
                    if path != path_now:
                        if opened:
                            opened.__exit__(None, None, None)
                        opened, path_now = None, None
                        opened = _open(path)
                        f, path_now = opened.__enter__(), path
                    data = zip_files.read_at(f, first, last - first)
                except (BadPackage, OSError) as e:
                    yield from ((path, at, *[None] * 9, str(e)) for at, _ in own)
                    continue
                yield from (row(path, at, data[at - first : at - first + n]) for at, n in own)
        finally:
            if opened:
                opened.__exit__(None, None, None)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(*(batch.column(c).to_pylist() for c in ("path", "at", "length")), strict=True))
            yield from _flushed(of_spans(rows), names, kinds, 200)

    schema = (
        "path string, at long, record_type string, record_id string, own string, uri string, digest string, "
        "refers_to string, payload_bytes long, payload_digest string, payload binary, problem string"
    )
    good = places.where("problem is null").select("path", "at", "length")
    dealt = good.repartitionByRange(parallelism(places.sparkSession), "path", "at").sortWithinPartitions("path", "at")
    bad = places.where("problem is not null").select(
        "path", "at", *(F.lit(None).cast(k).alias(c) for c, k in (x.split() for x in schema.split(", ")[2:-1])), "problem"
    )
    return dealt.mapInArrow(read, schema).unionByName(bad)


def read_back(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """``records`` of all packages below ``path``."""
    return records(stored(locations(stored(members(packages(spark, path)), "members")), "locations"), with_payload)


def resolved(found: DataFrame) -> DataFrame:
    """Per response and revisit: own, record_type, payload_bytes, payload_digest, refers_to (the response's own).

    A revisit has the payload of the response it names. A response named by a third
    of all records is one row of the smaller side; the join splits the other.
    """
    good = found.where("problem is null and record_type in ('response', 'revisit')")
    responses = good.where("record_type = 'response'")
    target = responses.select(
        F.col("record_id").alias("target"), F.col("own").alias("target_own"),
        F.col("payload_bytes").alias("target_bytes"), F.col("payload_digest").alias("target_digest"),
    )
    revisits = good.where("record_type = 'revisit'").join(target, F.col("refers_to") == F.col("target"), "left")
    return responses.select("own", "record_type", "payload_bytes", "payload_digest", F.lit(None).cast("string").alias("refers_to")).unionByName(
        revisits.select(
            "own", "record_type", F.col("target_bytes").alias("payload_bytes"), F.coalesce("target_digest", "digest").alias("payload_digest"),
            F.col("target_own").alias("refers_to"),
        )
    )
