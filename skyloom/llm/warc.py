"""WARC archives with a two-level capture index.

Records are gzip members of archive files. The index has one line per record, sorted by reversed-host URL key; lines
lie in compressed blocks of shard files (first level), and a sparse directory has each block's first key and place
(second level). A lookup bisects the directory, reads the byte ranges of the blocks that can hold its key, bisects
their lines, and reads the byte ranges of the records. Files are opened through pyarrow's file systems, by URI.

The directory has `max_blocks` entries and one per shard at most, whatever the size of the crawl; that bound is why
lookups may hold it whole. Blocks grow instead. A block's entry is the shortest string that parts its first key from the
last key before it, so URLs that share a long path are told apart and entries stay short; `key_chars` bounds them.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
import zlib
from bisect import bisect_left, bisect_right
from dataclasses import dataclass
from itertools import chain
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.llm.common import cut, shared_dir, tasks

LINE = "key string, page_id long, file string, offset long, length long"
RECORD = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, read_digest string, payload binary"


@dataclass(frozen=True)
class Warc:
    """min_revisit: payloads below it are always stored. file_bytes: an archive file is closed beyond it. read_bytes: neighbouring records are read at once up to it."""

    min_revisit: int = 100
    file_bytes: int = 64 << 20
    block_lines: int = 256
    max_blocks: int = 65_536
    key_chars: int = 1024
    read_bytes: int = 1 << 20


def url_key(url: str | None) -> str:
    """Reversed host, then path and query: http://www.A.com:80/x?y -> com,a,www)/x?y. Null is the empty key; what can't be split is its own key."""
    if not url:
        return ""
    try:
        u = urlsplit(url.strip())
        host = (u.hostname or "").rstrip(".")
        port = f":{u.port}" if u.port and u.port not in (80, 443) else ""
    except ValueError:
        return url.lower()
    return ",".join(reversed(host.split("."))) + port + ")" + (u.path or "/") + (f"?{u.query}" if u.query else "")


def _open(uri: str):
    return fs.FileSystem.from_uri(uri)


def decide(pages: DataFrame, p: Warc, id_col: str, payload: Column) -> DataFrame:
    """pages with n, digest and refers_to: the smallest id among equal payloads of at least min_revisit bytes, null for that row itself."""
    rows = pages.withColumn("__n", F.octet_length(payload).cast("long")).withColumn("__digest", F.sha2(payload.cast("binary"), 256))
    firsts = rows.where(F.col("__n") >= p.min_revisit).groupBy("__digest").agg(F.min(id_col).alias("__first"), F.count("*").alias("__times")).where("__times > 1").drop("__times")
    firsts = cut(firsts, "payloads")  # Spark knows its size from now on
    return rows.join(firsts, "__digest", "left").withColumn("__refers", F.when((F.col("__n") >= p.min_revisit) & (F.col("__first") != F.col(id_col)), F.col("__first")))


def _record(page: int | None, url: str | None, body: bytes, digest: str, refers: int | None, n: int) -> bytes:
    name = "none" if page is None else str(page)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % n
    block = http if refers is not None else http + body
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{name}>", "WARC-Date: 1970-01-01T00:00:00Z",
        *([] if url is None else [f"WARC-Target-URI: {' '.join(url.split())}"]), f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {n}",
        *([f"WARC-Refers-To: <urn:page:{refers}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"] if refers is not None else []),
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """The columns of RECORD of one record. read_digest: of the payload bytes as read, null for a revisit."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    found = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[: int(found["Content-Length"])]
    kind, refers = found["WARC-Type"], found.get("WARC-Refers-To")
    number = lambda s: None if s == "<urn:page:none>" else int(s[10:-1])
    body = block.partition(b"\r\n\r\n")[2] if kind == "response" else None
    return {
        "page_id": number(found["WARC-Record-ID"]), "url": found.get("WARC-Target-URI"), "record_type": kind, "refers_to": number(refers) if refers else None,
        "payload_bytes": int(found["X-Payload-Length"]), "payload_digest": found["WARC-Payload-Digest"].removeprefix("sha256:"),
        "read_digest": None if body is None else hashlib.sha256(body).hexdigest(), "payload": body}


def write_archives(pages: DataFrame, folder: str, p: Warc = Warc(), id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write a record per row to gzip archive files under folder; LINE rows. A file has a name of its own for each attempt of a task, and only files of the attempt that succeeded are named in the result."""
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = decide(pages.select(id_col, url_col, html_col), p, id_col, payload).select(F.col(id_col).cast("long"), F.col(url_col).cast("string"), payload.cast("binary"), "__digest", F.col("__refers").cast("long"), "__n")

    def run(batches):
        system, base = _open(folder)
        name, out, at = "", None, 0
        for b in batches:
            lines = []
            for page, url, body, digest, refers, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if out is None or at >= p.file_bytes:
                    if out is not None:
                        out.close()
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = system.open_output_stream(f"{base}/{name}", compression=None)
                member = gzip.compress(_record(page, url, body, digest, refers, n), 5, mtime=0)
                out.write(member)
                lines.append({"key": url_key(url), "page_id": page, "file": name, "offset": at, "length": len(member)})
                at += len(member)
            if lines:
                yield pa.RecordBatch.from_pylist(lines, pa.schema([("key", pa.string()), ("page_id", pa.int64()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())]))
        if out is not None:
            out.close()

    _make(pages.sparkSession, folder)
    return cut(rows.mapInArrow(run, LINE), "lines")


def _make(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)


def write_index(lines: DataFrame, folder: str, p: Warc = Warc()) -> DataFrame:
    """Write sorted blocks of lines to shard files under folder; the directory: (first, shard, block, offset, length, lines), sorted by first and block."""
    _make(lines.sparkSession, folder)
    per_block = max(p.block_lines, -(-lines.count() // p.max_blocks))
    ordered = lines.repartitionByRange(tasks(lines.sparkSession), "key", "page_id", "file", "offset").sortWithinPartitions("key", "page_id", "file", "offset")

    def run(batches):
        system, base = _open(folder)
        before = None
        name, out, at, number, held = f"{TaskContext.get().partitionId():07d}-{uuid.uuid4().hex}.idx", None, 0, 0, []  # names sort as keys do
        for b in chain(batches, [None]):
            if b is not None:
                held += list(zip(*(c.to_pylist() for c in b.columns), strict=True))
            done = []
            while held and (len(held) >= per_block or b is None):
                now, held = held[:per_block], held[per_block:]
                if out is None:
                    out = system.open_output_stream(f"{base}/{name}", compression=None)
                body = zlib.compress("\n".join(f"{_quoted(k)} {'-' if i is None else i} {f} {o} {n}" for k, i, f, o, n in now).encode(), 6)
                out.write(body)
                done.append({"first": _parting(before, now[0][0])[: p.key_chars], "shard": name, "block": number, "offset": at, "length": len(body), "lines": len(now)})
                at, number, before = at + len(body), number + 1, now[-1][0]
            if done:
                yield pa.RecordBatch.from_pylist(done)
        if out is not None:
            out.close()

    return cut(ordered.mapInArrow(run, "first string, shard string, block long, offset long, length long, lines long"), "directory")


def _parting(last: str | None, first: str) -> str:
    """The shortest beginning of first that is greater than last, a key before it; first itself where they are equal or none is before."""
    if last is None or last == first:
        return first
    return first[: next((i for i, (a, b) in enumerate(zip(last, first, strict=False)) if a != b), len(last)) + 1]


def _quoted(key: str) -> str:
    return key.replace("%", "%25").replace(" ", "%20").replace("\n", "%0A").replace("\r", "%0D")


class _Ranges:
    """Byte ranges of files, neighbouring ones in one read."""

    def __init__(self, folder: str, read_bytes: int):
        (self.system, self.base), self.most = _open(folder), read_bytes
        self.name, self.file, self.at, self.held = "", None, 0, b""

    def get(self, name: str, offset: int, length: int) -> bytes:
        if name != self.name:
            self.file, self.name, self.at, self.held = self.system.open_input_file(f"{self.base}/{name}"), name, 0, b""
        if offset < self.at or offset + length > self.at + len(self.held):
            self.at, self.held = offset, self.file.read_at(max(length, self.most), offset)
        return self.held[offset - self.at : offset - self.at + length]


def lookup(wanted: DataFrame, directory: DataFrame, index: str, p: Warc = Warc(), url_col: str = "url") -> DataFrame:
    """LINE rows of all captures whose URL key is that of a wanted URL. Equal keys are looked up once."""
    spark = wanted.sparkSession
    places = sorted((r["first"], r.shard, r.block, r.offset, r.length) for r in directory.collect())  # at most max_blocks and one per shard
    # sorted by first key, then by shard name and block: the order of the lines
    held = spark.sparkContext.broadcast(places)

    def keyed(batches):
        for b in batches:
            yield pa.record_batch([pa.array([url_key(u) for u in b.column(0).to_pylist()], pa.string())], ["key"])

    keys = wanted.select(F.col(url_col).cast("string")).distinct().mapInArrow(keyed, "key string").distinct()

    def place(batches):
        firsts = [x[0] for x in held.value]
        for b in batches:
            out = []
            for k in b.column(0).to_pylist():
                short = k[: p.key_chars]
                for i in range(max(0, bisect_left(firsts, short) - 1), bisect_right(firsts, short)):
                    out.append({"key": k, "at": i})
            if out:
                yield pa.RecordBatch.from_pylist(out, pa.schema([("key", pa.string()), ("at", pa.int64())]))

    def read(batches):
        ranges, at, lines, names = _Ranges(index, 0), -1, [], []
        for b in batches:
            out = []
            for k, i in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if i != at:
                    _, shard, _, offset, length = held.value[i]
                    lines = [x.split(" ") for x in zlib.decompress(ranges.get(shard, offset, length)).decode().split("\n")]
                    at, names = i, [(x[0].replace("%0D", "\r").replace("%0A", "\n").replace("%20", " ").replace("%25", "%")) for x in lines]
                for j in range(bisect_left(names, k), bisect_right(names, k)):
                    _, page, name, offset, length = lines[j]
                    out.append({"key": k, "page_id": None if page == "-" else int(page), "file": name, "offset": int(offset), "length": int(length)})
            if out:
                yield pa.RecordBatch.from_pylist(out, pa.schema([("key", pa.string()), ("page_id", pa.int64()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())]))

    placed = keys.mapInArrow(place, "key string, at long").repartition("at").sortWithinPartitions("at", "key")
    return placed.mapInArrow(read, LINE)


def read_records(lines: DataFrame, archives: str, p: Warc = Warc(), payloads: bool = True) -> DataFrame:
    """RECORD rows for LINE rows, by range reads in the order of the files' bytes; payloads=False leaves the payload null once its digest is known."""
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("read_digest", pa.string()), ("payload", pa.binary())])

    def run(batches):
        ranges = _Ranges(archives, p.read_bytes)
        for b in batches:
            out, size = [], 0
            for name, offset, length in zip(*(b.column(c).to_pylist() for c in ("file", "offset", "length")), strict=True):
                got = parse(gzip.decompress(ranges.get(name, offset, length)))
                size += got["payload_bytes"]
                out.append(got if payloads else got | {"payload": None})
                if size > p.read_bytes * 8 or len(out) >= 4096:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)

    span = F.floor(F.col("offset") / (16 << 20))  # a large file is read by several tasks
    return lines.repartition(F.col("file"), span).sortWithinPartitions("file", "offset").mapInArrow(run, RECORD)


@dataclass(frozen=True)
class Archive:
    archives: str
    index: str
    directory: DataFrame


def build(pages: DataFrame, p: Warc = Warc(), id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> Archive:
    """Write archives and index in new shared folders.

    Null html is an empty payload, a null URL has the empty key. Rows that repeat an id and a payload are both responses;
    rows without id revisit the smallest id among their copies, and are responses where no copy has one. White space in a
    URL is written as a blank. An empty table makes an index without blocks; lookups then find nothing.
    """
    spark = pages.sparkSession
    archives, index = shared_dir(spark, "warc"), shared_dir(spark, "cdx")
    lines = write_archives(pages, archives, p, id_col, url_col, html_col)
    return Archive(archives, index, write_index(lines, index, p))


def captures(wanted: DataFrame, archive: Archive, p: Warc = Warc(), url_col: str = "url", payloads: bool = True) -> DataFrame:
    """RECORD rows of every capture of the wanted URLs."""
    return read_records(lookup(wanted, archive.directory, archive.index, p, url_col), archive.archives, p, payloads)


ORACLE_SQL = """
WITH d AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
f AS (SELECT body, min(page_id) AS first FROM d WHERE strlen(body) >= 100 GROUP BY body)
SELECT page_id, strlen(d.body) AS payload_bytes, sha256(d.body) AS payload_digest,
  CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN first <> page_id THEN first END AS refers_to
FROM d LEFT JOIN f ON d.body = f.body
"""
