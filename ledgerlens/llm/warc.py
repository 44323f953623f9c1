"""A content-addressed WARC archive: payloads once by digest, headers apart, records by joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerlens.llm.frames import shared_folder

#: Payloads from this many bytes are revisited instead of written again.
MIN_REVISIT_BYTES = 1000
_END = "\r\n"


def _uri(url: Column) -> Column:
    """The address as one header line: control characters are percent-encoded."""
    out = F.coalesce(url, F.lit(""))
    for code in (*range(32), 127):
        out = F.replace(out, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return out


def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(">"))


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html", min_revisit_bytes: int = MIN_REVISIT_BYTES) -> None:
    """Write a WARC record for every row of ``pages`` below ``path``.

    ``path/payloads`` holds each distinct payload once, under its SHA-256;
    ``path/headers`` the exact header bytes of every record with the payload's
    SHA-256.  Of the records with equal payloads of ``min_revisit_bytes`` or
    more, the one with the largest id is the response and the others are
    revisits that refer to it; smaller payloads are always responses.

    Groups of copies are pre-aggregated before the shuffle (one payload for each
    task and digest), so a payload that a third of all pages share is no hot key.

    * null html: an empty payload; null url: an empty address
    * null id: never the largest; without another id in its group, a response
    * rows that repeat an id and payload have the same type
    * empty table: empty archive
    """
    rows = pages.select(
        pages[f"`{id_col}`"].cast("bigint").alias("page_id"), pages[f"`{url_col}`"].alias("url"),
        F.coalesce(pages[f"`{html_col}`"], F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    rows.groupBy("digest").agg(F.first("payload").alias("payload")).write.parquet(f"{path}/payloads")

    slim = rows.select("page_id", "url", "digest", F.sha1("payload").alias("sha1"),
                       F.octet_length("payload").cast("bigint").alias("n_bytes"))
    # one row for each digest; joined on the digest, where a hot group is split by the skew join
    largest = (slim.where(F.col("n_bytes") >= min_revisit_bytes)
               .groupBy("digest").agg(F.max("page_id").alias("response_id")))
    revisit = F.col("response_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response_id"))
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), _record_id(F.col("page_id"))),
        F.concat(F.lit("WARC-Target-URI: "), _uri(F.col("url"))),
        F.lit("WARC-Date: 1970-01-01T00:00:00Z"),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), _record_id(F.col("response_id")))),
        F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("sha1")),
        F.lit("Content-Type: text/html"),
        F.concat(F.lit("Content-Length: "), F.when(revisit, F.lit(0)).otherwise(F.col("n_bytes")).cast("string")),
    ]
    header = F.concat(F.concat_ws(_END, *lines), F.lit(_END + _END)).cast("binary")
    (slim.join(largest, "digest", "left").select(header.alias("header"), "digest")
     .write.parquet(f"{path}/headers"))


def _field(name: str) -> Column:
    found = F.regexp_extract(F.col("head"), rf"\r\n{name}: ([^\r\n]*)", 1)
    return F.when(found != "", found)


def read_archive(spark: SparkSession, path: str, with_records: bool = True) -> DataFrame:
    """Read an archive back: page_id, url, payload_bytes, payload_digest (SHA-1 in hex of the
    stored payload), record_type, refers_to, verified, and with ``with_records`` also the
    full payload and the original record's bytes.

    Headers are parsed from their stored bytes and joined with the payloads on the SHA-256.
    ``verified`` says that the stored payload has both its SHA-256 and the header's SHA-1;
    a header without a stored payload fails the read.
    """
    stored = spark.read.parquet(f"{path}/payloads").select(
        "digest", F.col("payload"), F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"), (F.sha2("payload", 256) == F.col("digest")).alias("intact"))
    if not with_records:
        stored = stored.drop("payload")
    heads = spark.read.parquet(f"{path}/headers").withColumn("head", F.col("header").cast("string"))
    page = r"<urn:page:(-?\d+)>"
    out = heads.join(stored, "digest", "left").select(
        F.regexp_extract(_field("WARC-Record-ID"), page, 1).try_cast("bigint").alias("page_id"),
        F.coalesce(_field("WARC-Target-URI"), F.lit("")).alias("url"),
        F.coalesce(F.col("payload_bytes"), F.raise_error(F.concat(F.lit("no payload "), F.col("digest"))).cast("bigint"))
        .alias("payload_bytes"),
        "payload_digest", _field("WARC-Type").alias("record_type"),
        F.regexp_extract(_field("WARC-Refers-To"), page, 1).try_cast("bigint").alias("refers_to"),
        (F.col("intact") & (_field("WARC-Payload-Digest") == F.concat(F.lit("sha1:"), F.col("payload_digest"))))
        .alias("verified"),
        *([F.col("payload"),
           F.concat(F.col("header"), F.when(_field("WARC-Type") == "revisit", F.lit("").cast("binary"))
                    .otherwise(F.col("payload")), F.lit(_END + _END).cast("binary")).alias("record")]
          if with_records else []))
    return out


def rebuild_records(spark: SparkSession, path: str) -> DataFrame:
    """Every original record of an archive, as bytes: (page_id, record_type, refers_to, url, header, record).

    Only responses have a body, so only they meet the stored payloads, on the SHA-256: a payload that many
    pages share is joined once.  A response without a stored payload fails the read."""
    heads = spark.read.parquet(f"{path}/headers").withColumn("head", F.col("header").cast("string"))
    page = r"<urn:page:(-?\d+)>"
    heads = heads.select(
        F.regexp_extract(_field("WARC-Record-ID"), page, 1).try_cast("bigint").alias("page_id"),
        _field("WARC-Type").alias("record_type"),
        F.regexp_extract(_field("WARC-Refers-To"), page, 1).try_cast("bigint").alias("refers_to"),
        F.coalesce(_field("WARC-Target-URI"), F.lit("")).alias("url"), "header", "digest")
    end = F.lit(_END + _END).cast("binary")
    stored = spark.read.parquet(f"{path}/payloads").select("digest", "payload")
    missing = F.raise_error(F.concat(F.lit("no payload "), F.col("digest"))).cast("binary")
    full = (heads.where(F.col("record_type") == "response").join(stored, "digest", "left")
            .withColumn("record", F.concat("header", F.coalesce("payload", missing), end)).drop("payload"))
    short = heads.where(F.col("record_type") != "response").withColumn("record", F.concat("header", end))
    return full.unionByName(short).drop("digest")


def rebuilt(pages: DataFrame) -> DataFrame:
    """Archive ``pages``, rebuild every record and read it: page_id, payload_bytes, payload_digest,
    record_type, refers_to, verified.

    Bytes and SHA-1 are those of the record's own body, cut out by its Content-Length; a revisit's are those
    of the body of the response that it refers to.  ``verified`` says that the body ends where the record
    does and has the SHA-1 of the header.  Nulls, repeated rows and empty tables: as in ``write_archive``."""
    path = shared_folder(pages.sparkSession, "warc")
    write_archive(pages, path)
    read = rebuild_records(pages.sparkSession, path).withColumn("head", F.col("header").cast("string"))
    start = F.octet_length("header")
    size = _field("Content-Length").cast("int")
    body = F.substring(F.col("record"), start + 1, size)
    facts = read.select(
        "page_id", "record_type", "refers_to", F.regexp_extract(_field("WARC-Payload-Digest"), "sha1:([0-9a-f]*)", 1).alias("said"),
        F.octet_length(body).cast("bigint").alias("payload_bytes"), F.sha1(body).alias("payload_digest"),
        (F.octet_length("record") == start + size + 4).alias("whole"))
    own = facts.where(F.col("record_type") == "response").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
        (F.col("whole") & (F.col("said") == F.col("payload_digest"))).alias("verified"))
    # one row for each response that can be referred to
    referred = (facts.where((F.col("record_type") == "response") & F.col("whole") & (F.col("payload_bytes") >= MIN_REVISIT_BYTES))
                .select(F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("said"), "payload_bytes").distinct())
    other = (facts.where(F.col("record_type") != "response").drop("payload_bytes")
             .join(referred, ["refers_to", "said"], "left").select(
                 "page_id", "payload_bytes", F.col("said").alias("payload_digest"), "record_type", "refers_to",
                 (F.col("whole") & F.col("payload_bytes").isNotNull()).alias("verified")))
    return own.unionByName(other)


def archived(pages: DataFrame, with_records: bool = False) -> DataFrame:
    """Write ``pages`` to a new archive in the shared folder and read it back."""
    path = shared_folder(pages.sparkSession, "warc")
    write_archive(pages, path)
    return read_archive(pages.sparkSession, path, with_records)
