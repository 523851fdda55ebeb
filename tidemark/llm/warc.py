"""WARC archives with a two-level capture index.

Pages are sorted by their reversed-host URL key and written as archives of
singly compressed records. Beside each archive lie its captures: lines in key
order, compressed in blocks, and a sparse directory with one line per block.
A search finds the archives that may hold a key, binary-searches the directory
and then the block, and reads only the byte ranges of the records it wants.
Because records lie in key order, the captures of a block are one range.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.ship import ship
from tidemark.scale import materialise

_BLOCK_LINES = 1000
_BLOCK_BYTES = 8 << 20
_ARCHIVE_BYTES = 512 << 20
_GAP = 64 << 10
_LEVEL = 4
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NO_URL = "-"


def url_key(url: Column) -> Column:
    """Host labels from the last to the first, then path and query: ``com,example)/a?b``.

    Scheme, user, port and fragment are left out. What has no host is its own
    key; a null or empty url has the key ``-``.
    """
    pattern = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)(?::[0-9]*)?([^#]*)"
    host = F.lower(F.regexp_extract(url, pattern, 1))
    labels = F.array_join(F.reverse(F.split(host, "[.]")), ",")
    key = F.concat(labels, F.lit(")"), F.regexp_extract(url, pattern, 2))
    return F.when(F.coalesce(url, F.lit("")) == "", _NO_URL).when(host == "", url).otherwise(key)


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    """One WARC record; a revisit (``refers_to`` given) keeps the headers but not the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    body = http.encode() + (payload if refers_to is None else b"")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {date}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + "".join(c if c >= " " else f"%{ord(c):02X}" for c in url))
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {_PROFILE}"]
    lines += [
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(body)}",
    ]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """Headers (lower-case names), the payload's full length, and the payload (None in a revisit)."""
    head, _, body = data.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"no WARC record: {version[:40]!r}")
    headers = {name.lower(): value for name, _, value in (line.partition(": ") for line in lines)}
    body = body[: int(headers["content-length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    if headers["warc-type"] == "revisit":
        return {"headers": headers, "length": length, "payload": None}
    if headers["warc-payload-digest"] != f"sha1:{_digest(payload)}" or len(payload) != length:
        raise ValueError(f"record {headers['warc-record-id']} does not have the payload it names")
    return {"headers": headers, "length": length, "payload": payload}


# Names that Hadoop has for stores which pyarrow knows by others.
_SCHEMES = {"s3a": "s3", "s3n": "s3", "wasb": "abfs", "wasbs": "abfss"}
_KNOWN = {"file", "hdfs", "viewfs", "s3", "gs", "gcs", "abfs", "abfss"}


def store_uri(folder: str) -> str:
    """``folder`` as pyarrow names its store; a ValueError for stores it cannot write."""
    scheme, colon, rest = folder.partition(":")
    if not colon or "/" in scheme:
        return folder
    scheme = _SCHEMES.get(scheme.lower(), scheme.lower())
    if scheme not in _KNOWN:
        raise ValueError(f"archives cannot be written to {scheme}: folders; known are {', '.join(sorted(_KNOWN))}")
    return f"{scheme}:{rest}"


def _open(folder: str) -> tuple[pafs.FileSystem, str]:
    uri = store_uri(folder)
    return pafs.FileSystem.from_uri(uri) if uri.partition(":")[0] in _KNOWN else (pafs.LocalFileSystem(), uri)


class _Writer:
    """One archive with its captures and their directory."""

    def __init__(self, folder: str):
        self.files, root = _open(folder)
        self.files.create_dir(root, recursive=True)
        self.name = f"part-{uuid.uuid4().hex}"  # a name of its own for every attempt
        self.root = root
        self.records = self.files.open_output_stream(f"{root}/{self.name}.warc.gz", compression=None)
        self.index = self.files.open_output_stream(f"{root}/{self.name}.cdx.z", compression=None)
        self.directory: list[list] = []
        self.lines: list[str] = []
        self.at = self.begin = self.index_at = 0

    def add(self, key: str, page_id, data: bytes) -> None:
        member = zlib.compressobj(_LEVEL, wbits=31)
        member = member.compress(data) + member.flush()
        self.lines.append(json.dumps([key, page_id, self.at, len(member)]))
        self.records.write(member)
        self.at += len(member)
        if len(self.lines) >= _BLOCK_LINES or self.at - self.begin >= _BLOCK_BYTES:
            self._end_block()

    def _end_block(self) -> None:
        if self.lines:
            block = zlib.compress("\n".join(self.lines).encode())
            first, last = (json.loads(self.lines[i])[0] for i in (0, -1))
            self.directory.append([first, last, self.index_at, len(block)])
            self.index.write(block)
            self.index_at += len(block)
            self.lines, self.begin = [], self.at

    def close(self) -> dict:
        self._end_block()
        self.records.close()
        self.index.close()
        with self.files.open_output_stream(f"{self.root}/{self.name}.dir") as out:
            out.write(json.dumps(self.directory).encode())
        return {"archive": self.name, "first_key": self.directory[0][0], "last_key": self.directory[-1][1]}


def _written(batches, folder: str, date: str) -> Iterator[pa.RecordBatch]:
    writer, done = None, []
    for batch in batches:
        for row in zip(*(c for c in batch.columns), strict=True):
            page_id, url, html, key, refers_to = (x.as_py() for x in row)
            writer = writer or _Writer(folder)
            payload = (html or "").encode("utf-8", "surrogatepass")
            writer.add(key, page_id, record(page_id, url, payload, _digest(payload), refers_to, date))
            if writer.at >= _ARCHIVE_BYTES:
                done.append(writer.close())
                writer = None
    if writer:
        done.append(writer.close())
    if done:
        yield pa.RecordBatch.from_pylist(done)


def write(pages: DataFrame, folder: str, least_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html) under ``folder``.

    Of records with equal payloads of at least ``least_bytes`` bytes the one
    with the largest page_id is a response, the others revisit it; rows that
    repeat this page_id are responses too. Null html is an empty payload.
    Other columns are not read. ``folder`` is a path or a URI of a store that
    ``store_uri`` knows (``s3a:`` too); others are refused before anything is
    written. Returns a row per archive: archive, first_key, last_key. A task that is run
    again writes files of other names, and only those it returns count.
    """
    store_uri(folder)
    ship(pages.sparkSession)
    bytes_ = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", "html", url_key(F.col("url")).alias("key"), F.sha1(bytes_).alias("sha"))
    long = rows.where(F.octet_length(bytes_) >= least_bytes)
    kept = long.groupBy("sha").agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("rows"))
    kept = materialise(kept.where("rows > 1").select("sha", "keeper"), "payloads")
    refers_to = F.when(~F.col("page_id").eqNullSafe(F.col("keeper")), F.col("keeper"))
    rows = rows.join(kept, "sha", "left").select("page_id", "url", "html", "key", refers_to.alias("refers_to"))
    parts = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(parts, "key", "page_id").sortWithinPartitions("key", "page_id")
    written = ordered.mapInArrow(
        lambda batches: _written(batches, folder, date), "archive string, first_key string, last_key string"
    )
    return materialise(written, "archives")


@lru_cache(maxsize=64)
def _directory(folder: str, archive: str) -> tuple[list[str], list[list]]:
    files, root = _open(folder)
    with files.open_input_file(f"{root}/{archive}.dir") as file:
        rows = json.loads(file.read())
    return [row[1] for row in rows], rows


def _blocks(batches, folder: str, listed) -> Iterator[pa.RecordBatch]:
    """For every key the blocks that may hold it, by binary search."""
    archives = listed.value
    lasts = [last for _, last, _ in archives]
    for batch in batches:
        for key in batch.column("key").to_pylist():
            found = []
            for first, _, archive in archives[bisect.bisect_left(lasts, key) :]:
                if first > key:
                    break
                ends, rows = _directory(folder, archive)
                for begin, _, offset, length in rows[bisect.bisect_left(ends, key) :]:
                    if begin > key:
                        break
                    found.append({"archive": archive, "offset": offset, "length": length, "key": key})
            for at in range(0, len(found), 10_000):
                yield pa.RecordBatch.from_pylist(found[at : at + 10_000], _BLOCK)


_BLOCK = pa.schema([("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("key", pa.string())])
_CAPTURE = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("archive", pa.string()),
        ("offset", pa.int64()),
        ("payload", pa.binary()),
    ]
)


def _id(urn: str | None) -> int | None:
    number = urn[len("<urn:page:") : -1] if urn else ""
    return int(number) if number else None


def _captures(folder: str, archive: str, offset: int, length: int, keys: list[str], payload: bool):
    """The records of ``keys`` in one block, by ranges that merge where they lie together."""
    files, root = _open(folder)
    with files.open_input_file(f"{root}/{archive}.cdx.z") as file:
        file.seek(offset)
        lines = [json.loads(x) for x in zlib.decompress(file.read(length)).decode().split("\n")]
    names = [line[0] for line in lines]
    wanted = []
    for key in sorted(keys):
        wanted += lines[bisect.bisect_left(names, key) : bisect.bisect_right(names, key)]
    with files.open_input_file(f"{root}/{archive}.warc.gz") as file:
        at = 0
        while at < len(wanted):
            end = at
            while end + 1 < len(wanted) and wanted[end + 1][2] - sum(wanted[end][2:]) <= _GAP:
                end += 1
            begin = wanted[at][2]
            file.seek(begin)
            data = file.read(sum(wanted[end][2:]) - begin)
            for _, page_id, place, size in wanted[at : end + 1]:
                found = parse(zlib.decompress(data[place - begin : place - begin + size], wbits=31))
                headers = found["headers"]
                yield {
                    "page_id": page_id,
                    "url": headers.get("warc-target-uri"),
                    "payload_bytes": found["length"],
                    "payload_digest": headers["warc-payload-digest"].removeprefix("sha1:"),
                    "record_type": headers["warc-type"],
                    "refers_to": _id(headers.get("warc-refers-to")),
                    "archive": archive,
                    "offset": place,
                    "payload": found["payload"] if payload else None,
                }
            at = end + 1


def _read(batches, folder: str, payload: bool) -> Iterator[pa.RecordBatch]:
    block, keys = None, []

    def records():
        if block is None:
            return
        rows, size = [], 0
        for row in _captures(folder, *block, keys, payload):
            rows.append(row)
            size += len(row["payload"] or b"")
            if size > _BLOCK_BYTES:
                yield pa.RecordBatch.from_pylist(rows, _CAPTURE)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, _CAPTURE)

    for batch in batches:
        for archive, offset, length, key in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if block != (archive, offset, length):
                yield from records()
                block, keys = (archive, offset, length), []
            keys.append(key)
    yield from records()


def lookup(archives: DataFrame, folder: str, keys: DataFrame, payload: bool = False) -> DataFrame:
    """Every capture of every key of ``keys`` (key): a row per record.

    Keys that are null or in no archive give no row, repeated keys count once.
    The list of archives, a row for each 512 MB or written partition, is broadcast;
    a key with many captures is split by its blocks. With ``payload`` the rows
    carry the payload, null in revisits.
    """
    spark = archives.sparkSession
    ship(spark)
    listed = sorted((r["first_key"], r["last_key"], r["archive"]) for r in archives.collect())
    listed = spark.sparkContext.broadcast(listed)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Keys are few bytes but each may read many blocks. Dealt by their own values Spark would merge them again.
    wanted = keys.select("key").where("key is not null").distinct().repartition(parts, F.xxhash64("key"))
    found = wanted.mapInArrow(
        lambda batches: _blocks(batches, folder, listed), "archive string, offset long, length long, key string"
    )
    found = found.repartition(parts, "archive", "offset").sortWithinPartitions("archive", "offset")
    schema = (
        "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
        "refers_to long, archive string, offset long, payload binary"
    )
    rows = found.mapInArrow(lambda batches: _read(batches, folder, payload), schema)
    return rows if payload else rows.drop("payload")
