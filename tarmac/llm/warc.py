"""Content-addressed WARC archive.

``write_archive`` splits records in two tables below one folder:

* ``payloads``: each distinct payload once, under its SHA-256, with its SHA-1
  (base32, as WARC headers state it) and the record that carries it;
* ``headers``: each record's exact header block, with the SHA-256 of its payload.

Payloads of one SHA-256 are verified equal as they are stored, by their lengths and MD5s.
``read_archive`` joins them back to whole records, checks each payload against
its digest, and takes every field from the lines of the WARC header, which end at CRLF and
nowhere else, as a WARC reader would.
Of the records with one payload that with the largest id is the ``response``; the
others are ``revisit`` records that refer to it.

Grouping happens by digest with partial sums, so a payload shared by a third of
all rows reaches its group as one row per task; joins on it are left to AQE's
skew handling.

Defined results:

* null payload: archived as an empty one; null URL: no ``WARC-Target-URI`` line;
* control characters and Unicode line ends in a URL are percent-encoded, each by its own UTF-8
  bytes, as a header must be; so no URL can add a field;
* null id: never referred to; a revisit if a record of the same payload has an id;
* rows repeated with the largest id are all responses;
* an empty table gives an empty archive; other columns are not archived.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.operators.joins import scratch_path

CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Payloads below this many bytes are always stored as responses.
MIN_REVISIT_BYTES = 0
ARCHIVE_DATE = "2024-01-01T00:00:00Z"


def base32_sha1(data: Column) -> Column:
    """SHA-1 of a binary column in upper-case base32 (160 bits are 32 digits, no padding)."""
    digest = F.sha1(data)
    fives = [F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.upper(F.concat(*fives)), "0123456789ABCDEFGHIJKLMNOPQRSTUV",
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


#: What must not stand in a header value: C0 and C1 control characters, DEL, line and paragraph separators.
UNSAFE = [chr(c) for c in (*range(0x20), *range(0x7F, 0xA0), 0x2028, 0x2029)]


def encoded(value: Column) -> Column:
    """``value`` with every unsafe character percent-encoded by its UTF-8 bytes."""
    codes = F.array(*[F.struct(F.lit(c).alias("c"), F.lit("".join(f"%{b:02X}" for b in c.encode())).alias("p"))
                      for c in UNSAFE])
    return F.when(value.rlike(r"[\x00-\x1F\x7F-\x9F\x{2028}\x{2029}]"), F.aggregate(
        codes, value, lambda text, x: F.replace(text, x["c"], x["p"]))).otherwise(value)


def _line(name: str, *value: Column) -> Column:
    """A header line; nothing if a part of its value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), *value, F.lit(CRLF)), F.lit(""))


def _record_id(page: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), page.cast("string"), F.lit(">"))


def write_archive(pages: DataFrame, path: str, key: str = "page_id", url: str = "url",
                  payload: str = "html", min_bytes: int = MIN_REVISIT_BYTES) -> None:
    """Write one WARC record for each row of ``pages`` below ``path``."""
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    rows = pages.select(F.col(key).cast("long").alias("id"), encoded(F.col(url)).alias("url"), body.alias("payload")) \
        .withColumn("sha256", F.sha2("payload", 256))
    seal = F.struct(F.octet_length("payload").alias("bytes"), F.md5("payload").alias("md5"))
    payloads = rows.groupBy("sha256").agg(
        F.max("id").alias("holder"), F.first("payload").alias("payload"),
        F.min(seal).alias("least"), F.max(seal).alias("most"))
    checked = payloads.withColumn("payload", F.when(F.col("least") == F.col("most"), F.col("payload"))
                                  .otherwise(F.raise_error(F.lit("payloads of one digest differ"))))
    checked.select("sha256", base32_sha1(F.col("payload")).alias("sha1"), "holder",
                   F.col("most.bytes").cast("long").alias("bytes"), "payload") \
        .write.parquet(f"{path}/payloads")

    spark = pages.sparkSession
    facts = spark.read.parquet(f"{path}/payloads").select(
        "sha256", "sha1", F.col("holder"), "bytes")
    named = rows.drop("payload").join(facts, "sha256")
    repeats = (F.col("bytes") >= min_bytes) & F.col("holder").isNotNull() \
        & ~F.col("id").eqNullSafe(F.col("holder"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}"),
                    _line("Content-Length", F.col("bytes").cast("string")), F.lit(CRLF))
    length = F.octet_length(F.col("http")) + F.when(F.col("repeats"), 0).otherwise(F.col("bytes"))
    revisit = lambda line: F.when(F.col("repeats"), line).otherwise(F.lit(""))
    header = F.concat(
        F.lit(f"WARC/1.1{CRLF}WARC-Type: "),
        F.when(F.col("repeats"), F.lit("revisit")).otherwise(F.lit("response")), F.lit(CRLF),
        _line("WARC-Record-ID", _record_id(F.col("id"))),
        _line("WARC-Target-URI", F.col("url")),
        F.lit(f"WARC-Date: {ARCHIVE_DATE}{CRLF}"),
        revisit(F.concat(_line("WARC-Refers-To", _record_id(F.col("holder"))),
                         F.lit(f"WARC-Profile: {PROFILE}{CRLF}"))),
        _line("WARC-Payload-Digest", F.lit("sha1:"), F.col("sha1")),
        F.lit(f"Content-Type: application/http; msgtype=response{CRLF}"),
        _line("Content-Length", length.cast("string")), F.lit(CRLF), F.col("http"))
    named.withColumn("repeats", repeats).withColumn("http", http) \
        .select("sha256", header.alias("header")).write.parquet(f"{path}/headers")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Every record: ``record`` (its exact bytes), ``payload`` (of the record it revisits, if it
    is a revisit) and the fields read from its header block."""
    payloads = spark.read.parquet(f"{path}/payloads").select("sha256", "payload")
    headers = spark.read.parquet(f"{path}/headers")
    good = F.when(F.sha2("payload", 256) == F.col("sha256"), F.col("payload")) \
        .otherwise(F.raise_error(F.lit("payload does not match its digest")))
    lines = F.split(F.substring_index("header", CRLF + CRLF, 1), CRLF)  # those of the WARC header alone

    def field(name: str, pattern: str) -> Column:
        value = F.substring(F.get(F.filter(lines, lambda x: x.startswith(f"{name}: ")), F.lit(0)), len(name) + 3, 1 << 30)
        return F.when(value.rlike(rf"(?s)\A{pattern}\z"), F.regexp_extract(value, rf"(?s)\A{pattern}\z", 1))

    whole = headers.join(payloads, "sha256").withColumn("payload", good)
    kind = field("WARC-Type", "(response|revisit)")
    return whole.select(
        field("WARC-Record-ID", "<urn:page:(-?[0-9]+)>").cast("long").alias("page_id"),
        kind.alias("record_type"),
        field("WARC-Target-URI", "(.*)").alias("url"),
        field("WARC-Refers-To", "<urn:page:(-?[0-9]+)>").cast("long").alias("refers_to"),
        field("WARC-Payload-Digest", "sha1:([A-Z2-7]+)").alias("stated_digest"),
        F.concat(F.col("header").cast("binary"),
                 F.when(kind == "response", F.col("payload")).otherwise(F.lit(b"")),
                 F.lit(b"\r\n\r\n")).alias("record"),
        "payload")


def archive_folder(spark: SparkSession) -> str:
    """A new folder in the cluster's shared checkpoint folder."""
    return scratch_path(spark, "archive")


def archive_report(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Archive ``pages``, read the archive back, and state each record's payload and type."""
    spark = pages.sparkSession
    path = path or archive_folder(spark)
    write_archive(pages, path)
    return read_archive(spark, path).select(
        "page_id", F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32_sha1(F.col("payload")).alias("payload_digest"), "record_type", "refers_to")
