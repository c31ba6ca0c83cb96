"""WARC archives: revisit resolution, writing of deduplicated archives with fresh headers, and reading.

Headers (id, digest, length) are shuffled by payload digest without the payload;
the smallest id of a digest is the original response, other records of the same
payload become revisits of it. Archives are written by Spark's own text writer
(a record ends with CR LF CR LF, the writer's line separator), so that a lost or
repeated task leaves no partial archive, and any file system that Spark writes
to will do.
"""

import gzip
import hashlib
import io
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annalist.llm.common import cut, small_batches

#: Payloads of fewer bytes are stored each time.
LEAST_BYTES = 100
#: Bytes of payload that an archive holds on average, and at most (but for a single record of more); one archive is read as one value.
ARCHIVE_BYTES, MOST_BYTES = 16 << 20, 256 << 20
#: Bytes of the headers of a record, about.
HEADERS = 600
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = "\r\n\r\n"


def capture(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """One record (id, url, payload, bytes, digest) per row; a null payload is empty, a null url too. Other columns are left out, whatever their names. A payload is a string, so of 2 GB at most."""
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    return pages.select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"), payload.alias("payload"), F.octet_length(payload).cast("long").alias("bytes"), F.sha2(payload, 256).alias("digest")
    )


def originals(records: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """For each digest that is found again: id and url of its original, the smallest id."""
    return records.where((F.col("bytes") >= least) & F.col("id").isNotNull()).groupBy("digest").agg(F.min("id").alias("original"), F.min_by("url", "id").alias("original_url"), F.count("*").alias("n")).where("n > 1").drop("n")


def resolve(records: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """records with `original` and `original_url` where a record revisits another, else null.

    Rows that repeat the smallest id are all responses. A null id is a response
    that nothing refers to. Payloads under `least` bytes are never revisits.
    """
    found = cut(originals(records, least), "warc-originals")
    headers = records.where(F.col("bytes") >= least).select("id", "digest")
    # an id may carry several payloads when rows repeat an id, so the digest is part of the key
    keyed = headers.join(found, "digest").where("id <> original").select("id", "digest", "original", "original_url").dropDuplicates(["id", "digest"])
    return records.join(keyed, ["id", "digest"], "left")


def _urn(record_id):
    h = F.sha2(F.concat(F.lit("annalist:"), record_id), 256)
    part = lambda a, n: F.substring(h, a, n)
    return F.concat(F.lit("<urn:uuid:"), part(1, 8), F.lit("-"), part(9, 4), F.lit("-"), part(13, 4), F.lit("-"), part(17, 4), F.lit("-"), part(21, 12), F.lit(">"))


def _line(value):
    return F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def record_text(date: str):
    """A whole record, but for the CR LF CR LF after it; date is that of its headers."""
    again = F.col("original").isNotNull()
    own = F.coalesce(F.col("id").cast("string"), F.lit("null"))
    http = F.when(again, F.lit("")).otherwise(F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes"), F.lit(_END)))
    block_bytes = F.when(again, F.lit(0)).otherwise(F.octet_length(http) + F.col("bytes"))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(again, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), _urn(F.concat(own, F.lit(" "), F.col("digest"))),
        F.lit(f"\r\nWARC-Date: {date}\r\nWARC-Target-URI: "), _line(F.col("url")),
        F.lit("\r\nWARC-Payload-Digest: sha256:"), F.col("digest"),
        F.when(F.col("id").isNull(), "").otherwise(F.concat(F.lit("\r\nX-Page-ID: "), own)),
        F.when(again, F.concat(F.lit(f"\r\nWARC-Profile: {PROFILE}\r\nWARC-Refers-To: "), _urn(F.concat(F.col("original").cast("string"), F.lit(" "), F.col("digest"))), F.lit("\r\nWARC-Refers-To-Target-URI: "), _line(F.col("original_url")), F.lit("\r\nX-Refers-To-Page-ID: "), F.col("original"), F.lit("\r\nX-Payload-Length: "), F.col("bytes"))).otherwise(""),
        F.lit("\r\nContent-Type: application/http;msgtype=response\r\nContent-Length: "), block_bytes, F.lit(_END),
    )
    return F.concat(head, http, F.when(again, F.lit("")).otherwise(F.col("payload")))


def write(resolved: DataFrame, path: str, date: str | None = None, archive_bytes: int = ARCHIVE_BYTES, most_bytes: int = MOST_BYTES) -> None:
    """Gzipped archives of about archive_bytes of payload each under path, none of more than most_bytes unless it is a single record.

    `date` (as 2024-01-31T00:00:00Z; now if not given) goes into the fresh headers.
    Archives have no warcinfo record, and are compressed as a whole. Spark cuts
    files by records: where so many of the largest would be too many bytes, the
    records far above the mean are written to archives of their own.
    """
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    told = resolved.select(F.avg("bytes").alias("mean"), F.max("bytes").alias("most")).first()
    mean, most = (told["mean"] or 0) + HEADERS, (told["most"] or 0) + HEADERS
    usual = max(1, int(archive_bytes / mean))
    limit = most_bytes // usual - HEADERS

    def put(records: DataFrame, per_file: int, mode: str) -> None:
        records.select(record_text(date).alias("value")).write.mode(mode).option("lineSep", _END).option("compression", "gzip").option("maxRecordsPerFile", per_file).text(path)

    if usual * most <= most_bytes:
        put(resolved, usual, "error")
    else:
        put(resolved.where(F.col("bytes") <= limit), usual, "error")
        put(resolved.where(F.col("bytes") > limit), max(1, int(most_bytes // most)), "append")


def parse(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers with lower-case names, block) of each record; blocks are read by their length alone."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record: {line[:40]!r}")
        headers = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip().lower()] = value.strip()
        block = stream.read(int(headers["content-length"]))
        if len(block) != int(headers["content-length"]):
            raise ValueError("a record is cut short")
        yield headers, block


SCHEMA = "id bigint, url string, record_type string, record_id string, digest string, bytes bigint, refers_to bigint, payload string"


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records of all archives under path. The digest of a response is computed from its payload, and its bytes are counted; a revisit has those of its headers and no payload.

    An archive is decompressed as a stream, a record at a time; Arrow batches are bounded by bytes.
    """
    small_batches(spark)
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

        for files in batches:
            for content in files.column("content"):
                rows, size = [], 0
                with gzip.open(io.BytesIO(content.as_buffer())) as stream:
                    for h, block in parse(stream):
                        number = lambda k, h=h: int(h[k]) if k in h else None
                        row = [number("x-page-id"), h.get("warc-target-uri"), h["warc-type"], h["warc-record-id"], h["warc-payload-digest"].removeprefix("sha256:")]
                        if h["warc-type"] == "revisit":
                            row += [number("x-payload-length"), number("x-refers-to-page-id"), None]
                        else:
                            payload = block.partition(b"\r\n\r\n")[2]
                            row[4] = hashlib.sha256(payload).hexdigest()
                            row += [len(payload), None, payload.decode() if payloads else None]
                        rows.append(row)
                        size += len(block) + 500
                        if size > 4 << 20:
                            yield batch(rows)
                            rows, size = [], 0
                if rows:
                    yield batch(rows)

    return spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content").mapInArrow(run, SCHEMA)
