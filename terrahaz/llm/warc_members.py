"""WARC archives: monolithic gzip streams and their normaliser.

``write_monolithic`` writes a table of records as gzip files that are one stream each (Spark's own
text writer and committer: the record separator of the format is the line separator).
``normalise`` inflates every such stream once, front to back, and writes each record as a gzip
member of its own, with a sidecar (one JSON line per record: offset and length) beside it.
``read_records`` goes through the sidecar's offsets, so any record is read without the ones before.

A file is one task's work, because a gzip stream has no entry points; memory is one record, not the
file. Files are named by their source and written under a temporary name first, so a repeated task
leaves the same bytes.

Defined cases: null html is empty; null url is ``about:blank``; of equal payloads the row with
the largest id is the response and rows without id are revisits, unless no row has an id: then all
are responses, as are repeated rows of that largest id. No rows give no files.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from urllib.parse import urlsplit

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrahaz.llm import tables
from terrahaz.session import scratch

DEDUP_BYTES = 1000
LEVEL = 6
READ_BYTES = 1 << 20
SEPARATOR = "\r\n\r\n"
#: Profile URI of the format's revisit records.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def records(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            least: int = DEDUP_BYTES) -> DataFrame:
    """``record``: one WARC record per row as text, without the separator that ends it. The block
    is an HTTP response; a revisit holds its head only."""
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(url_col), F.lit("about:blank")).alias("url"),
                     F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    rows = rows.withColumn("bytes", F.octet_length("html").cast("long")).withColumn("digest", F.sha1("html"))
    same = (
        rows.where(F.col("bytes") >= least).groupBy("digest", "bytes").agg(F.max("id").alias("response"), F.count("*").alias("n"))
        .where("n > 1 and response is not null").select("digest", "bytes", "response")
    )
    rows = rows.join(same, ["digest", "bytes"], "left")
    again = F.col("response").isNotNull() & (F.col("id").isNull() | (F.col("id") < F.col("response")))
    end = "\r\n"
    url = F.regexp_replace("url", r"[\x00-\x20\x7f]", "%20")
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{end}Content-Type: text/html; charset=utf-8{end}Content-Length: "),
                    F.col("bytes").cast("string"), F.lit(end + end))
    block = F.when(again, head).otherwise(F.concat(head, "html"))
    name = F.concat(F.lit("<urn:page:"), F.coalesce(F.col("id").cast("string"), F.lit("none")), F.lit(">"))
    kind = F.when(again, F.lit("revisit")).otherwise(F.lit("response"))
    refers = F.when(again, F.concat(
        F.lit(f"WARC-Profile: {PROFILE}{end}WARC-Refers-To: <urn:page:"), F.col("response").cast("string"), F.lit(f">{end}"))).otherwise("")
    record = F.concat(
        F.lit(f"WARC/1.1{end}WARC-Type: "), kind, F.lit(f"{end}WARC-Record-ID: "), name, F.lit(f"{end}WARC-Target-URI: "), url,
        F.lit(f"{end}WARC-Payload-Digest: sha1:"), F.col("digest"), F.lit(end), refers,
        F.lit(f"Content-Type: application/http; msgtype=response{end}Content-Length: "),
        F.octet_length(block).cast("string"), F.lit(end + end), block)
    return rows.select(record.alias("record"))


def write_monolithic(rows: DataFrame, folder: str) -> None:
    rows.select("record").write.option("compression", "gzip").option("lineSep", SEPARATOR).text(folder)


def _store(uri: str):
    """File system and path of a URI that all executors reach (file, hdfs, s3, gs, ...)."""
    scheme = urlsplit(uri).scheme
    if not scheme:
        return pafs.LocalFileSystem(), uri
    if scheme == "file":
        return pafs.LocalFileSystem(), urlsplit(uri).path
    return pafs.FileSystem.from_uri({"s3a": "s3", "s3n": "s3"}.get(scheme, scheme) + uri[len(scheme) :])


def inflated(stream):
    """Bytes of a gzip stream, of one or more members, piece by piece."""
    inflate = zlib.decompressobj(31)
    while data := stream.read(READ_BYTES):
        while data:
            yield inflate.decompress(data, READ_BYTES)
            while inflate.unconsumed_tail:
                yield inflate.decompress(inflate.unconsumed_tail, READ_BYTES)
            data = inflate.unused_data
            if inflate.eof:
                inflate = zlib.decompressobj(31)
            elif not data:
                break
    if (rest := inflate.flush()):
        yield rest


def split_records(chunks):
    """Whole records (head, block) of a stream of bytes; the separator after each is checked."""
    held, more = bytearray(), iter(chunks)

    def fill(n: int) -> bool:
        while len(held) < n:
            got = next(more, None)
            if got is None:
                return False
            held.extend(got)
        return True

    while fill(1):
        at = held.find(b"\r\n\r\n")
        while at < 0:
            size = len(held)
            if not fill(size + 1):
                raise ValueError("a record head is cut off")
            at = held.find(b"\r\n\r\n", max(0, size - 3))
        head = bytes(held[: at + 4])
        length = int(header(head, "Content-Length"))
        if not fill(len(head) + length + 4):
            raise ValueError("a record is cut off")
        block = bytes(held[len(head) : len(head) + length])
        if held[len(head) + length : len(head) + length + 4] != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")
        del held[: len(head) + length + 4]
        yield head, block


def header(head: bytes, name: str) -> str | None:
    for line in head.split(b"\r\n"):
        key, colon, value = line.partition(b":")
        if colon and key.strip().lower() == name.lower().encode():
            return value.strip().decode("utf-8", "replace")
    return None


def member(record: bytes, level: int = LEVEL) -> bytes:
    deflate = zlib.compressobj(level, zlib.DEFLATED, 31)
    return deflate.compress(record) + deflate.flush()


def _rewrite(source: str, folder: str, level: int) -> list[dict]:
    """One monolithic file to ``<name>.warc.gz`` and ``<name>.index.jsonl`` in ``folder``."""
    store, path = _store(source)
    sink, base = _store(folder)
    stem = path.rsplit("/", 1)[-1].removesuffix(".gz").removesuffix(".txt")
    name, temporary = f"{base}/{stem}.warc.gz", f"{base}/_{stem}-{uuid.uuid4().hex}"
    found, offset = [], 0
    with store.open_input_stream(path, compression=None) as stream, sink.open_output_stream(temporary, compression=None) as out:
        for head, block in split_records(inflated(stream)):
            data = member(head + block + SEPARATOR.encode(), level)
            out.write(data)
            found.append({"archive": f"{folder}/{stem}.warc.gz", "offset": offset, "length": len(data),
                          "record_id": header(head, "WARC-Record-ID"), "record_type": header(head, "WARC-Type")})
            offset += len(data)
    sink.move(temporary, name)
    with sink.open_output_stream(f"{temporary}-index", compression=None) as out:
        for r in found:
            out.write((json.dumps({k: v for k, v in r.items() if k != "archive"}) + "\n").encode())
    sink.move(f"{temporary}-index", f"{base}/{stem}.index.jsonl")
    return found


def normalise(spark: SparkSession, monolithic: str, folder: str | None = None, level: int = LEVEL) -> DataFrame:
    """Rewrite every file of ``monolithic``; the index (``archive, offset, length, record_id,
    record_type``) is returned as a table that is staged beside the sidecars."""
    folder = (folder or scratch(spark, "warc")).rstrip("/")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(monolithic).select("path")
    names = sorted(r["path"] for r in files.collect())  # names only
    ddl = "archive string, offset long, length long, record_id string, record_type string"
    if not names:
        return spark.createDataFrame([], ddl)
    sink, base = _store(folder)
    sink.create_dir(base, recursive=True)

    def run(batches):
        for b in batches:
            for source in b["path"].to_pylist():
                rows = _rewrite(source, folder, level)
                if rows:
                    yield {c: [r[c] for r in rows] for c in rows[0]}

    work = spark.createDataFrame([(n,) for n in names], "path string").repartition(len(names), "path")
    return tables.staged(tables.map_batches(work, ddl, run), "warc-index")


def read_records(index: DataFrame) -> DataFrame:
    """The records behind an index: ``record_id, record_type, payload_bytes, payload_digest,
    refers_to, url, payload`` (a revisit has no payload; its size and digest are as it states)."""

    def run(batches):
        for b in batches:
            out = {c: [] for c in ("record_id", "record_type", "payload_bytes", "payload_digest", "refers_to", "url", "payload")}
            name, file = None, None
            for archive, offset, length in zip(*(b[c].to_pylist() for c in ("archive", "offset", "length")), strict=True):
                if archive != name:
                    store, path = _store(archive)
                    name, file = archive, store.open_input_file(path)
                file.seek(offset)
                (head, block), = split_records([zlib.decompress(file.read(length), 31)])
                top, _, payload = block.partition(b"\r\n\r\n")
                kind = header(head, "WARC-Type")
                if kind == "revisit":
                    size, digest, payload = int(header(top, "Content-Length")), header(head, "WARC-Payload-Digest").removeprefix("sha1:"), None
                else:
                    size, digest = len(payload), hashlib.sha1(payload).hexdigest()
                for c, v in zip(out, (header(head, "WARC-Record-ID"), kind, size, digest, header(head, "WARC-Refers-To"),
                                      header(head, "WARC-Target-URI"), payload), strict=True):
                    out[c].append(v)
            yield out

    return tables.map_batches(
        index.select("archive", "offset", "length"),
        "record_id string, record_type string, payload_bytes long, payload_digest string, refers_to string, url string, payload binary", run)
