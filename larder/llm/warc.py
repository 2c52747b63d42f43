"""WARC archives: one gzip member per record, written by Spark tasks, and a
splittable reader.

Archives hold no index. A reading task gets a byte range of a file, scans it
for the gzip magic, accepts a candidate as a member only if its first bytes
decode to a WARC header, and owns the records that start inside its range; the
last one may run past the range's end.

Files are opened with pyarrow's file systems (local or shared folders, HDFS,
object stores), so the folder may be any URI of those.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm.common import materialise, pick, spread_join
from larder.sources.files import scratch_path

MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1\r\n"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


@dataclass(frozen=True)
class WarcParams:
    """``min_payload``: shortest payload that may be a revisit; ``split_bytes``:
    byte range of a reading task; ``date``: the WARC-Date of written records;
    ``file_bytes``: an archive file is closed beyond this size."""
    min_payload: int = 0
    split_bytes: int = 32 << 20
    file_bytes: int = 1 << 30
    date: str = "1970-01-01T00:00:00Z"
    level: int = 6


def _fs(path: str):
    from pyarrow import fs
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path)


def digest(payload: bytes) -> str:
    """Bare base32 SHA-1, upper case."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(page_id, url, payload: bytes, refers, p: WarcParams) -> bytes:
    name = "urn:page" if page_id is None else f"urn:page:{quote(str(page_id))}"  # no id is another name than any id
    lines = [f"WARC-Type: {'response' if refers is None else 'revisit'}", f"WARC-Record-ID: <{name}>",
             f"WARC-Date: {p.date}", f"WARC-Payload-Digest: sha1:{digest(payload)}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + quote(url, safe="!#$&'()*+,/:;=?@[]~%"))
    if refers is not None:
        lines += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: <urn:page:{quote(str(refers))}>"]
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + (payload if refers is None else b"")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    data = VERSION + "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"
    z = zlib.compressobj(p.level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def mark_revisits(pages: DataFrame, p: WarcParams) -> DataFrame:
    """``pages (page_id, url, html)`` with ``refers_to``: the smallest page_id
    with an equal payload of at least ``min_payload`` bytes, where that is
    another one, else null. Payloads are compared by SHA-1 and length."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    marked = pages.withColumn("sum", F.sha1(payload)).withColumn("size", F.octet_length(payload))
    thin = marked.filter(F.col("size") >= p.min_payload).groupBy("sum").agg(
        F.min("page_id").alias("first"), F.count(F.lit(1)).alias("copies")).filter("copies > 1").drop("copies")
    joined = spread_join(marked, thin, "sum", "left")
    other = (F.col("size") >= p.min_payload) & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select("page_id", "url", "html", F.when(other, F.col("first")).alias("refers_to"))


def write_warc(pages: DataFrame, folder: str, params: WarcParams = WarcParams(), id_col: str = "page_id",
               url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write one record per row below ``folder``; return the manifest ``(path,
    bytes, records)`` of the files that count.

    Every attempt of a task writes files of its own name, and only finished
    attempts reach the manifest, so a lost executor or a second attempt leaves
    at most an unlisted file. A null html is an empty payload, a null url gives
    no target; rows that repeat a payload's smallest page_id are all responses."""
    p = params
    rows = mark_revisits(pick(pages, page_id=id_col, url=url_col, html=html_col), p)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = path = None
        size = count = 0

        def listed():
            return pa.record_batch([pa.array([path]), pa.array([size], pa.int64()), pa.array([count], pa.int64())],
                                   names=["path", "bytes", "records"])

        for batch in batches:
            for page, url, html, refers in zip(*[batch.column(n) for n in ("page_id", "url", "html", "refers_to")], strict=True):
                if out is None:
                    path, size, count = f"{folder}/part-{uuid.uuid4().hex}.warc.gz", 0, 0
                    system, local = _fs(path)
                    system.create_dir(local.rsplit("/", 1)[0], recursive=True)
                    out = system.open_output_stream(local, compression=None)
                data = _record(page.as_py(), url.as_py(), (html.as_py() or "").encode("utf-8", "replace"), refers.as_py(), p)
                out.write(data)
                size, count = size + len(data), count + 1
                if size >= p.file_bytes:
                    out.close()
                    yield listed()
                    out = None
        if out is not None:
            out.close()
            yield listed()

    return materialise(rows.mapInArrow(run, "path string, bytes long, records long"), "warc-manifest")


def list_warc(spark: SparkSession, folder: str) -> DataFrame:
    """``path, bytes`` of the archives below a folder that Spark can list;
    contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").option("recursiveFileLookup", "true")
    return files.load(folder).select("path", F.col("length").alias("bytes"))


def _member(view, start: int, more) -> tuple:
    """(data, end) of the gzip member at ``start`` of the buffer, or None if its
    first bytes are no WARC header. ``more()`` appends to the buffer and tells
    whether there was more."""
    z = zlib.decompressobj(31)
    parts, head, at = [], b"", start
    while not z.eof:
        if at >= len(view()):
            if not more():
                return None  # cut off: no whole record starts here
            continue
        step = bytes(view()[at:at + (1 << 16)])
        try:
            parts.append(z.decompress(step))
        except zlib.error:
            return None
        at += len(step)
        if len(head) < len(VERSION):
            head = b"".join(parts)[:len(VERSION)]
            if not (head.startswith(b"WARC/1.") or b"WARC/1.".startswith(head)):
                return None
    if not head.startswith(b"WARC/1."):
        return None
    return b"".join(parts), at - len(z.unused_data)


def range_records(path: str, start: int, end: int) -> Iterator[bytes]:
    """The decoded records that start in ``[start, end)`` of a file. At most a
    piece of the file and one record are held."""
    system, local = _fs(path)
    piece = 1 << 20
    with system.open_input_file(local) as f:
        total = f.size()
        buffer, base, at = bytearray(), start, 0

        def more() -> bool:
            if base + len(buffer) >= total:
                return False
            buffer.extend(f.read_at(min(piece, total - base - len(buffer)), base + len(buffer)))
            return True

        while base + at < end:
            hit = buffer.find(MAGIC, at)
            if hit < 0 or base + hit >= end:
                at = max(at, len(buffer) - len(MAGIC) + 1) if hit < 0 else hit
                if hit >= 0 or base + at >= end or not more():
                    return
            else:
                found = _member(lambda: buffer, hit, more)
                if found is None:
                    at = hit + 1
                else:
                    yield found[0]
                    at = found[1]
            if at > 4 * piece:
                del buffer[:at]
                base, at = base + at, 0


def parse(data: bytes) -> dict:
    """Header fields by lower-case name, with ``block`` and ``payload``."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    block = rest[:int(fields.get("content-length", 0))]
    fields["block"] = block
    fields["payload"] = block.partition(b"\r\n\r\n")[2] if "application/http" in fields.get("content-type", "") else block
    return fields


def _name(value):
    """The id in a record's name: null for a record without one, and for other archives' names the name."""
    name = value.strip("<>") if value else "urn:page"
    return None if name == "urn:page" else unquote(name.removeprefix("urn:page:"))


def read_warc(files: DataFrame, params: WarcParams = WarcParams()) -> DataFrame:
    """One row per record of ``files (path, bytes)``: ``record_id, record_type,
    target_uri, payload, payload_digest, refers_to``; the digest is computed
    from a response's payload and read from a revisit's header.

    Files are cut into byte ranges of ``split_bytes``, dealt out over the tasks;
    an empty file has no range. A payload cannot hold a whole gzip member of a
    WARC record in plain bytes (a stored block of one inside an archive would
    be taken for a record by a range that starts in it); UTF-8 text never does."""
    p = params
    ranges = files.filter("bytes > 0").select("path", F.explode(F.expr(
        f"sequence(0L, (bytes - 1) div {p.split_bytes}L)")).alias("k")).select(
        "path", (F.col("k") * p.split_bytes).alias("start"), ((F.col("k") + 1) * p.split_bytes).alias("end"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["record_id", "record_type", "target_uri", "payload", "payload_digest", "refers_to"]

        def batch_of(rows):
            kinds = [pa.string(), pa.string(), pa.string(), pa.binary(), pa.string(), pa.string()]
            return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

        rows, size = [], 0
        for batch in batches:
            for path, start, end in zip(*[batch.column(n).to_pylist() for n in ("path", "start", "end")], strict=True):
                for data in range_records(path, start, end):
                    f = parse(data)
                    kind = f.get("warc-type")
                    given = f.get("warc-payload-digest", "").removeprefix("sha1:")
                    rows.append((_name(f.get("warc-record-id")), kind, f.get("warc-target-uri"), f["payload"],
                                 given if kind == "revisit" else digest(f["payload"]), _name(f.get("warc-refers-to"))))
                    size += len(data)
                    if size > 4 << 20:
                        yield batch_of(rows)
                        rows, size = [], 0
        if rows:
            yield batch_of(rows)

    n = files.sparkSession.conf.get("spark.sql.shuffle.partitions")
    return ranges.repartition(int(n)).mapInArrow(
        run, "record_id string, record_type string, target_uri string, payload binary, payload_digest string, refers_to string")


def round_trip(pages: DataFrame, params: WarcParams = WarcParams()) -> DataFrame:
    """Write ``pages``, read the archives back and describe every record:
    ``page_id, payload_bytes, payload_digest, record_type, refers_to``. A
    revisit takes its payload's length and digest from the response that it
    refers to."""
    folder = scratch_path(pages.sparkSession, "llm-warc")
    kind = pick(pages, page_id="page_id").schema["page_id"].dataType
    got = read_warc(write_warc(pages, folder, params), params).select(
        F.col("record_id").cast(kind).alias("page_id"), "record_type", F.octet_length("payload").cast("long").alias("n"),
        "payload_digest", F.col("refers_to").cast(kind).alias("refers_to"))
    got = materialise(got, "warc-records")
    revisits = got.filter("record_type = 'revisit'").select("page_id", "refers_to")
    asked = revisits.select(F.col("refers_to").alias("page_id")).distinct()
    full = got.filter("record_type = 'response'").join(asked, "page_id").groupBy(F.col("page_id").alias("refers_to")).agg(
        F.first("n").alias("payload_bytes"), F.first("payload_digest").alias("payload_digest"))
    revisits = got.filter("record_type = 'revisit'").select("page_id", "refers_to", "record_type")
    revisits = spread_join(revisits, full, "refers_to").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return got.filter("record_type = 'response'").select(
        "page_id", F.col("n").alias("payload_bytes"), "payload_digest", "record_type", "refers_to").unionByName(revisits)
