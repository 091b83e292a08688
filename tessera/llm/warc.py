"""WARC archives with a two-level capture index.

``write`` stores a record per page, each compressed by itself, in files of bounded size that begin with a warcinfo record: an HTTP
message with the payload for a response; for a revisit its head and the reference. Of payloads of at least REVISIT bytes that are equal (SHA-1 and length) the largest page id is
the response. ``index`` sorts the captures by reversed-host URL key, then page id, into compressed blocks of LINES captures,
and keeps of each block its first capture, its file and its place: the sparse directory, itself split by part file, with
a top level of one entry a part. ``lookup`` finds the part of a capture in the top level, its block in the part's
directory, and its line in the block, each by binary search. ``fetch`` then reads the records by ranges, in file order, ranges that
touch or nearly touch at once.

Keys hold the page id, so pages of one host, or even of one URL, are spread over parts like any others. Groups of equal
payloads are reduced to their response before any shuffle; joining it back is left to the skew join.

Null html is an empty payload; a null URL has the key ")". Rows with equal id and payload are one capture each, all of the same
type, with the same answer. Null ids sort first and are never a response that others refer to. An empty table gives no
files and no rows. Other columns are ignored. A very long payload is one record, and takes memory in proportion to itself.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

#: Smallest payload that is replaced by a revisit; bytes of an archive; captures of a block; captures of an index part.
REVISIT, FILE_BYTES, LINES, PART = 1000, 32 << 20, 500, 50_000
#: Ranges closer than this are read at once, up to so many bytes; bytes of records that a task reads.
GAP, READ, TASK_BYTES = 64 << 10, 8 << 20, 64 << 20
_RECORDS = "key string, page_id long, path string, offset long, length long"


def surt(url: str | None) -> str:
    """Key of a URL: its host's labels from the last, then the path and query; no scheme, port or fragment."""
    m = re.match(r"(?i)(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)(?::\d*)?([^#]*)", url or "")
    if not m:
        return ")" + (url or "").partition("#")[0]
    return ",".join(reversed(m[1].lower().split("."))) + ")" + (m[2] or "/")


def rank(page_id: int | None) -> int:
    return -(1 << 63) if page_id is None else page_id


def _packed(head: list[str], body: bytes) -> bytes:
    pack = zlib.compressobj(1, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join([*head, f"Content-Length: {len(body)}", "", ""]).encode() + body + b"\r\n\r\n") + pack.flush()


def info(name: str, stamp: str) -> bytes:
    """The warcinfo record that a file begins with."""
    head = ["WARC/1.1", "WARC-Type: warcinfo", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>", f"WARC-Date: {stamp}", f"WARC-Filename: {name}", "Content-Type: application/warc-fields"]
    return _packed(head, b"software: tessera\r\nformat: WARC File Format 1.1\r\n")


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, stamp: str) -> bytes:
    """One compressed record. The digest is hex; in the archive it stands in base 32, as usual there."""
    sha = "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {stamp}", f"WARC-Target-URI: {re.sub(r'[\x00-\x20]', '', url or '')}", f"WARC-Payload-Digest: {sha}",
    ]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    return _packed([*head, "Content-Type: application/http; msgtype=response"], http + (payload if refers_to is None else b""))


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of a compressed record."""
    raw = zlib.decompress(data, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in head.decode().split("\r\n")[1:])
    n = int(fields.get("Content-Length", -1))
    if not raw.startswith(b"WARC/1.1\r\n") or rest[n:] != b"\r\n\r\n":
        raise ValueError("not a WARC record")
    return fields, rest[:n]


def payload_of(block: bytes) -> tuple[int, bytes]:
    """The length that the HTTP head of a block gives, and what follows the head."""
    head, _, body = block.partition(b"\r\n\r\n")
    return int(re.search(rb"(?i)\r\ncontent-length: (\d+)", head)[1]), body


def revisits(pages: DataFrame) -> DataFrame:
    """(page_id, digest, refers_to) of the pages that revisit another."""
    about = pages.filter(F.col("bytes") >= REVISIT).select("page_id", "digest", "bytes")
    first = about.groupBy("digest", "bytes").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).filter("n > 1 AND refers_to IS NOT NULL").drop("n")
    return about.join(first, ["digest", "bytes"]).filter(~F.col("page_id").eqNullSafe(F.col("refers_to"))).select("page_id", "digest", "refers_to").distinct()


def write(pages: DataFrame, folder: str | None = None, stamp: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write the archives; return (key, page_id, path, offset, length) of each capture."""
    spark = pages.sparkSession
    C.prepare(spark)
    folder = folder or C.shared_dir(spark)
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload")).withColumn("digest", F.sha1("payload")).withColumn("bytes", F.octet_length("payload"))
    again = C.handed(revisits(rows), "revisits")
    same = F.col("p.page_id").eqNullSafe(F.col("r.page_id")) & (F.col("p.digest") == F.col("r.digest"))
    ready = rows.alias("p").join(again.alias("r"), same, "left").select("p.page_id", "p.url", "p.payload", "p.digest", "r.refers_to")

    def run(batches):
        import pyarrow as pa

        fs, out, path, at = None, None, "", 0
        try:
            for batch in batches:
                found = []
                for page, url, payload, digest, refers in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                    if out is None:
                        path = f"{folder}/pages-{uuid.uuid4().hex}.warc.gz"
                        fs, local = C.open_fs(path)
                        fs.create_dir(local.rpartition("/")[0], recursive=True)
                        out = fs.open_output_stream(local, compression=None)
                        at = out.write(info(local.rpartition("/")[2], stamp))
                    data = record(page, url, payload, digest, refers, stamp)
                    out.write(data)
                    found.append((surt(url), page, path, at, len(data)))
                    at += len(data)
                    if at >= FILE_BYTES:
                        out.close()
                        out = None
                columns = list(zip(*found, strict=True)) or [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()), strict=True)], names=["key", "page_id", "path", "offset", "length"])
        finally:
            if out is not None:
                out.close()

    return C.handed(ready.mapInArrow(run, _RECORDS), "captures")


def index(captures: DataFrame, folder: str | None = None) -> DataFrame:
    """Write the index blocks; return the directory (part, key, page_id, path, offset, length), the first capture of each block."""
    spark = captures.sparkSession
    folder = folder or C.shared_dir(spark)
    parts = C.partitions(spark, captures.count(), PART)

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part, lines, blocks, entries, at = TaskContext.get().partitionId(), [], [], [], 0
        path = f"{folder}/index-{part:06d}-{uuid.uuid4().hex}.cdx.z"

        def flush():
            nonlocal lines, at
            data = zlib.compress("".join(x[2] for x in lines).encode("utf-8", "surrogatepass"), 6)
            entries.append((part, lines[0][0], lines[0][1], path, at, len(data)))
            blocks.append(data)
            lines, at = [], at + len(data)

        for batch in batches:
            for key, page, warc, offset, length in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                lines.append((key, page, "\t".join((key.replace("\t", "%09").replace("\n", "%0A"), "" if page is None else str(page), warc, str(offset), str(length))) + "\n"))
                if len(lines) == LINES:
                    flush()
        if lines:
            flush()
        if blocks:
            C.write_bytes(path, b"".join(blocks))
        columns = list(zip(*entries, strict=True)) or [()] * 6
        types = (pa.int32(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["part", "key", "page_id", "path", "offset", "length"])

    # keys of the lines and of the order agree: control characters are written escaped
    clean = captures.withColumn("key", F.regexp_replace(F.regexp_replace("key", "\t", "%09"), "\n", "%0A"))
    ordered = clean.repartitionByRange(parts, "key", "page_id").sortWithinPartitions("key", "page_id", "path", "offset")
    return C.handed(ordered.mapInArrow(run, "part int, key string, page_id long, path string, offset long, length long"), "directory")


def _order(key: str, page: int | None) -> tuple[bytes, int]:
    return key.encode("utf-8", "surrogatepass"), rank(page)


def lookup(wanted: DataFrame, directory: DataFrame) -> DataFrame:
    """(page_id, path, offset, length) of the captures wanted, as (page_id, url)."""
    best = F.min(F.struct(F.col("key"), F.col("page_id"))).alias("first")
    top = sorted((_order(r.first.key, r.first.page_id), r.part) for r in C.small(directory.groupBy("part").agg(best), 1 << 20, "parts of the index"))
    bounds, parts = [x for x, _ in top], [p for _, p in top]

    def place(batches):
        import pyarrow as pa

        for batch in batches:
            pages = batch.column(0).to_pylist()
            keys = [surt(u).replace("\t", "%09").replace("\n", "%0A") for u in batch.column(1).to_pylist()]
            part = [parts[max(0, bisect_right(bounds, _order(k, p)) - 1)] if parts else 0 for k, p in zip(keys, pages, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(keys, pa.string()), batch.column(0)], names=["part", "key", "page_id"])

    def find(left, right):
        import pyarrow as pa

        schema = pa.schema([("page_id", pa.int64()), ("path", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])
        entries = sorted((_order(k, p), path, at, n) for k, p, path, at, n in zip(*(right.column(c).to_pylist() for c in ("key", "page_id", "path", "offset", "length")), strict=True))
        firsts, found, last, order, lines = [e[0] for e in entries], [], None, [], []
        goals = {_order(k, p): p for k, p in zip(left.column("key").to_pylist(), left.column("page_id").to_pylist(), strict=True)}
        for goal, page in sorted(goals.items(), key=lambda x: x[0]):
            # equal captures may run over several blocks: from the last block that begins before the goal on
            block = max(0, bisect_left(firsts, goal) - 1)
            while block < len(entries) and (firsts[block] <= goal):
                if block != last:
                    _, path, at, n = entries[block]
                    lines = [x.split("\t") for x in zlib.decompress(C.read_bytes(path, at, n)).decode("utf-8", "surrogatepass").split("\n")[:-1]]
                    order, last = [_order(x[0], int(x[1]) if x[1] else None) for x in lines], block
                for i in range(bisect_left(order, goal), len(order)):
                    if order[i] != goal:
                        break
                    found.append((page, lines[i][2], int(lines[i][3]), int(lines[i][4])))
                block += 1
        columns = list(zip(*found, strict=True)) or [()] * 4
        return pa.table([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)

    asked = wanted.select(F.col("page_id").cast("long").alias("page_id"), "url").mapInArrow(place, "part int, key string, page_id long").distinct()
    return asked.groupBy("part").cogroup(directory.groupBy("part")).applyInArrow(find, "page_id long, path string, offset long, length long")


def fetch(places: DataFrame, size: int = 0) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of the records at the places; responses are checked against
    their digest. size: bytes of the records in all, for the number of tasks."""

    def run(batches):
        import pyarrow as pa

        types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
        opened, path = None, None
        for batch in batches:
            rows, found, i = list(zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True)), [], 0
            while i < len(rows):
                start, j, end = rows[i][1], i, rows[i][1] + rows[i][2]
                while j + 1 < len(rows) and rows[j + 1][0] == rows[i][0] and rows[j + 1][1] <= end + GAP and rows[j + 1][1] + rows[j + 1][2] - start <= READ:
                    j += 1
                    end = max(end, rows[j][1] + rows[j][2])
                if rows[i][0] != path:
                    if opened is not None:
                        opened.close()
                    path = rows[i][0]
                    fs, local = C.open_fs(path)
                    opened = fs.open_input_file(local)
                data = opened.read_at(end - start, start)
                for _, at, n in rows[i : j + 1]:
                    fields, block = parse(data[at - start : at - start + n])
                    size, body = payload_of(block)
                    kind, digest = fields["WARC-Type"], base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                    refers = fields.get("WARC-Refers-To")
                    if kind != "revisit" and (hashlib.sha1(body).hexdigest() != digest or len(body) != size):
                        raise ValueError("a record doesn't hold its payload")
                    page = fields["WARC-Record-ID"][10:-1]
                    found.append((int(page) if page else None, size, digest, kind, int(refers[10:-1]) if refers else None))
                i = j + 1
            columns = list(zip(*found, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])
        if opened is not None:
            opened.close()

    n = C.partitions(places.sparkSession, size, TASK_BYTES)
    ordered = places.select("path", "offset", "length").repartition(n, "path", F.floor(F.col("offset") / READ)).sortWithinPartitions("path", "offset")
    return ordered.mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def archive(pages: DataFrame) -> DataFrame:
    """Write the pages and their index, look every page up and read it back."""
    captures = write(pages)
    size = captures.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    return fetch(lookup(pages, index(captures)), size)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive(C.table(spark, sf_dir, "pages", "page_id", "url", "html"))


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest FROM p),
w AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS top FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN top END AS refers_to FROM w
"""
