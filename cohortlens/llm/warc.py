"""WARC archives with revisit records: written without repeated payloads, read back, deduplicated again.

An archive is a folder of gzip files of WARC 1.1 records.  ``resolve`` decides on
headers alone, shuffled by payload digest: of the records with equal payloads the
one with the largest id becomes the response, the others revisit it.  ``write``
takes each payload once, by its digest, and gives every record fresh headers.
``read`` streams the files as lines that end in CRLF and puts records together
again by their Content-Length; ``records`` joins revisits to the responses they
refer to.  ``rewrite`` does all of this for an archive from elsewhere.

Payloads move only once for each distinct one within a task.  The headers of a
frequent payload are counted within tasks first, and what is joined to them is
one row for each digest, so the join can be split.

Defined results: a null payload is empty; a payload shorter than ``least_bytes``
is never revisited, all its records are responses; null ids come before all
others; of rows that agree in all, one is the response; an empty table gives an
archive without records; other columns are not looked at.  Blanks and control
characters of a URL are written as %20.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from urllib.parse import unquote_plus

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm.common import stored
from cohortlens.session import scratch_path

CRLF = "\r\n"
RECORDS_PER_FILE = 20_000
DEAL = 64  # rows that agree in all are counted apart by the task they come from, in so many parts

#: Fixed values of the WARC 1.1 format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: Extension fields: the id of the record's row, and the payload's length for records without payload.
ID_FIELD, LENGTH_FIELD = "X-Source-Id", "X-Payload-Length"


def sha1_base32(data: Column) -> Column:
    """Upper-case base32 of the SHA-1 of a binary column: 20 bits (5 hex, 4 base32 digits) at a time."""
    hexed = F.sha1(data)
    four = [F.lpad(F.conv(F.substring(hexed, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*four), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def bodies(pages: DataFrame, page_id: str, url: str, payload: str) -> DataFrame:
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(page_id).alias("id"), F.regexp_replace(F.coalesce(F.col(url).cast("string"), F.lit("urn:unknown")), r"[\x00-\x20\x7F]", "%20").alias("url"), body.alias("payload"))
    return rows.select("id", "url", F.octet_length("payload").cast("bigint").alias("bytes"), sha1_base32(F.col("payload")).alias("digest"), "payload")


def resolve(headers: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(id, url, bytes, digest, copy, kept_id, kept_url, kept): a row for each of ``headers`` (id, url, bytes, digest).

    ``kept`` says that the row is a response; others revisit kept_id.
    """
    part = F.pmod(F.spark_partition_id(), F.lit(DEAL)).alias("part")
    alike = stored(headers.select("id", "url", "bytes", "digest", part).groupBy("digest", "bytes", "id", "url", "part").agg(F.count(F.lit(1)).alias("n")), "headers")
    # the largest row of a digest; nulls are smallest
    first = alike.filter(F.col("bytes") >= least_bytes).groupBy("digest", "bytes").agg(F.max(F.struct("id", "url", "part")).alias("k"))
    first = first.select("digest", "bytes", F.col("k.id").alias("kept_id"), F.col("k.url").alias("kept_url"), F.col("k.part").alias("kept_part"))
    rows = alike.join(first, ["digest", "bytes"], "left").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "n")))
    same = F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("url") == F.col("kept_url")) & (F.col("part") == F.col("kept_part")) & (F.col("copy") == 1)
    return rows.select(
        "id", "url", "bytes", "digest", F.concat_ws("-", "part", "copy").alias("copy"), "kept_id", "kept_url",
        F.concat_ws("-", "kept_part", F.lit(1)).alias("kept_copy"), (F.col("kept_part").isNull() | same).alias("kept"),
    )


def named(digest: Column, key: Column, url: Column, copy: Column) -> Column:
    """A record's own URI, a function of all that tells it from others."""
    h = F.md5(F.concat_ws("\n", digest, F.coalesce(key.cast("string"), F.lit("\n")), url, copy))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def record(payload: Column, date: Column) -> Column:
    """The bytes of a record (as a string column) but for its last CRLF, from the columns of ``resolve``."""
    c = F.col
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(CRLF))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), c("bytes").cast("string"), F.lit(CRLF + CRLF))
    block = F.when(c("kept"), F.concat(http, payload.cast("string"))).otherwise(http)
    size = F.octet_length(http) + F.when(c("kept"), c("bytes")).otherwise(0)
    fields = [
        F.lit(VERSION + CRLF),
        line("WARC-Type", F.when(c("kept"), "response").otherwise("revisit")),
        line("WARC-Record-ID", named(c("digest"), c("id"), c("url"), c("copy"))),
        line("WARC-Date", date),
        line("WARC-Target-URI", c("url")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), c("digest"))),
        F.coalesce(line(ID_FIELD, F.url_encode(c("id").cast("string"))), F.lit("")),
        F.when(c("kept"), F.lit("")).otherwise(F.concat(
            line("WARC-Profile", F.lit(PROFILE)),
            line("WARC-Refers-To", named(c("digest"), c("kept_id"), c("kept_url"), c("kept_copy"))),
            line("WARC-Refers-To-Target-URI", F.coalesce("kept_url", F.lit(""))),
            line(LENGTH_FIELD, c("bytes")),
        )),
        F.lit(f"Content-Type: application/http; msgtype=response{CRLF}"),
        line("Content-Length", size),
        F.lit(CRLF),
    ]
    return F.concat(*fields, block, F.lit(CRLF))


def write(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", payload: str = "html", least_bytes: int = 0, date: Column | None = None) -> str:
    """Archive of a record for each row of ``pages`` below ``path``; equal payloads are written once."""
    rows = bodies(pages, page_id, url, payload)
    decided = resolve(rows.drop("payload"), least_bytes)
    # each distinct payload moves once from every task that has it
    payloads = rows.groupBy("digest", "bytes").agg(F.first("payload").alias("payload"))
    date = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'") if date is None else date
    full = decided.filter("kept").join(payloads, ["digest", "bytes"]).select(record(F.col("payload"), date).alias("value"))
    short = decided.filter("NOT kept").select(record(F.lit(""), date).alias("value"))
    full.union(short).write.option("lineSep", CRLF).option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)
    return path


def parsed(lines: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of each record of a stream of lines that ended in CRLF."""
    for line in lines:
        if not line:
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"A record is expected, found {line[:40]!r}")
        fields = {}
        for line in lines:
            if not line:
                break
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        size = int(fields["content-length"])
        block = [next(lines, b"")]
        have = len(block[0])
        while have < size:
            block.append(next(lines))
            have += 2 + len(block[-1])
        if have != size:
            raise ValueError(f"A record of {size} bytes ends within a line")
        yield fields, b"\r\n".join(block)


READ = "record_id string, type string, url string, source_id string, digest string, bytes bigint, refers_to string"


def read(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """A row for each response or revisit record of the gzip files below ``path``: record_id, type, url, source_id, digest, bytes, refers_to.

    Of a response, digest and length are those of the payload that was read.  A
    revisit has the digest and length its headers give.  Files are streamed, so
    their size does not matter; a record has to fit into a task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = 0

        def out() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            kinds = [pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
            names = ["record_id", "type", "url", "source_id", "digest", "bytes", "refers_to", "payload"]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays if payloads else arrays[:7], names if payloads else names[:7])

        for f, block in parsed(v.as_py() or b"" for batch in batches for v in batch.column(0)):
            kind = f.get("warc-type")
            if kind not in ("response", "revisit"):
                continue
            body = block.partition(b"\r\n\r\n")[2] if f.get("content-type", "").startswith("application/http") else block
            if kind == "response":
                digest, n = base64.b32encode(hashlib.sha1(body).digest()).decode(), len(body)
            else:
                digest, n, body = f.get("warc-payload-digest", "").rpartition(":")[2], int(f[LENGTH_FIELD.lower()]) if LENGTH_FIELD.lower() in f else None, None
            source = f.get(ID_FIELD.lower())
            rows.append((f.get("warc-record-id"), kind, f.get("warc-target-uri"), None if source is None else unquote_plus(source), digest, n, f.get("warc-refers-to"), body))
            size += 500 + len(body or b"") * payloads
            if size > 8_000_000:
                yield out()
                rows, size = [], 0
        if rows:
            yield out()

    schema = READ + ", payload binary" * payloads
    return spark.read.option("lineSep", CRLF).text(path).select(F.col("value").cast("binary")).mapInArrow(run, schema)


def records(spark: SparkSession, path: str, kind: str = "string") -> DataFrame:
    """(source_id, url, bytes, digest, type, refers_to): of a revisit, length and refers_to (a source id) come from its response.

    ``kind`` is the type of the source ids.
    """
    found = stored(read(spark, path), "records")
    # the responses that are revisited, one row for each
    origin = found.filter("type = 'response'").select(F.col("record_id").alias("refers_to"), F.col("source_id").alias("o_id"), F.col("bytes").alias("o_bytes"), F.col("digest").alias("o_digest"))
    revisits = found.filter("type = 'revisit'").join(origin, "refers_to", "left")
    cast = lambda c: F.col(c).cast(kind)
    return revisits.select(
        cast("source_id").alias("source_id"), "url", F.coalesce("o_bytes", "bytes").alias("bytes"), F.coalesce("o_digest", "digest").alias("digest"), "type", cast("o_id").alias("refers_to"),
    ).unionByName(found.filter("type = 'response'").select(cast("source_id").alias("source_id"), "url", "bytes", "digest", "type", F.lit(None).cast(kind).alias("refers_to")))


def rewrite(spark: SparkSession, source: str, path: str, least_bytes: int = 0, kind: str = "string") -> str:
    """Deduplicated copy of the archive ``source``, with fresh headers.

    Revisits of the source get their payload back from their response (by the
    record they refer to, else by digest); one whose response is not there is an error.
    """
    found = stored(read(spark, source, payloads=True), "payloads")
    full = found.filter("type = 'response'")
    by_digest = full.groupBy("digest").agg(F.first("payload").alias("d_payload"))
    by_record = full.select(F.col("record_id").alias("refers_to"), F.col("payload").alias("r_payload"))
    back = found.filter("type = 'revisit'").drop("payload").join(by_record, "refers_to", "left").join(by_digest, "digest", "left")
    missing = F.raise_error(F.concat(F.lit("No response for the revisit "), F.col("record_id"))).cast("binary")
    back = back.select("source_id", "url", F.coalesce("r_payload", "d_payload", missing).alias("payload"))
    pages = full.select("source_id", "url", "payload").unionByName(back).withColumn("source_id", F.col("source_id").cast(kind))
    return write(pages, path, "source_id", "url", "payload", least_bytes)


def deduplicated(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html", least_bytes: int = 0) -> DataFrame:
    """Writes the archive of ``pages`` to the shared folder and reads it back: a row of ``records`` for each page."""
    spark = pages.sparkSession
    kind = pages.schema[page_id].dataType.simpleString()
    return records(spark, write(pages, scratch_path(spark, "warc"), page_id, url, payload, least_bytes), kind)
