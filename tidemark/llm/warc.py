"""WARC archives: written with revisit records, read back by boundary-chain verification.

Writing: a page whose payload stands in another page of larger id becomes a revisit of that page. One row is one record,
and the end of a record is the line separator of Spark's text writer, so archives are plain files written by tasks.

Reading: the text reader splits files, and the tasks cut them at every occurrence of the magic, inside payloads too. Each
occurrence is a candidate record whose header states its successor's offset. Pointer jumping from the start of each file
(the successor's successor, and so on, doubling the step each round) keeps the candidates that can be reached; magic inside
a payload can't. A payload that was cut is put together again from the pieces between its record and the successor.

Defined results: null html has an empty payload, a null id is written as ``null`` and read as null; of repeated rows of the
largest id each is a response; blanks and control characters in a URL are percent-encoded; an empty table gives archives
without records and no row; other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.bitmap import may_hold
from tidemark.session import durable, scratch_path

MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: five hexadecimal digits are four of base32."""
    digest = F.sha1(payload)
    parts = (F.lpad(F.conv(F.substring(digest, i, 5), 16, 32), 4, "0") for i in range(1, 41, 5))
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def write_warc(pages: DataFrame, path: str, min_bytes: int = 0, per_file: int = 1000) -> None:
    """Write ``pages`` (page_id, url, html) as archives of at most ``per_file`` records."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(
        "page_id", "url", payload.alias("payload"), base32_sha1(payload.cast("binary")).alias("digest"),
        F.octet_length(payload).alias("size"),
    )
    repeated = rows.filter(F.col("size") >= min_bytes).groupBy("digest").agg(
        F.max("page_id").alias("first"), F.count("*").alias("n")
    )
    # Written once, so that the join has a plain exchange on either side and a hot payload can be split.
    repeated = durable(repeated.filter("n > 1").select("digest", "first"), "payloads")
    # Most payloads stand once; a bit map keeps those out of the shuffle.
    suspect = may_hold(repeated, "digest")("digest")
    alone = rows.filter(~suspect).withColumn("first", F.lit(None).cast(pages.schema["page_id"].dataType))
    met = rows.filter(suspect).join(repeated.hint("merge"), "digest", "left")
    rows = alone.unionByName(met).withColumn(
        "revisit",
        F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")) & (F.col("size") >= min_bytes),
    )
    uri = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20\x7F]", "%20")
    name = F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("null")), F.lit(">"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), "size", F.lit(END)
    )
    block = F.when(F.col("revisit"), F.lit("")).otherwise(F.col("payload"))
    fields = F.concat(
        F.lit(MAGIC + "WARC-Type: "), F.when(F.col("revisit"), "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), name, F.lit(f"\r\nWARC-Date: {DATE}\r\nWARC-Target-URI: "), uri,
        F.lit("\r\nWARC-Payload-Digest: sha1:"), "digest",
        F.when(
            F.col("revisit"),
            F.concat(F.lit("\r\nWARC-Refers-To: <urn:page:"), "first", F.lit(f">\r\nWARC-Profile: {PROFILE}")),
        ).otherwise(""),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        (F.octet_length(http) + F.octet_length(block)).cast("string"), F.lit(END), http, block,
    )
    rows.select(fields.alias("value")).write.option("lineSep", END).option("maxRecordsPerFile", per_file).text(path)


def _field(head: Column, name: str) -> Column:
    return F.regexp_extract(head, rf"(?im)^{name}:[\x20\t]*([^\r\n]*)", 1)


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """The text between occurrences of the magic: (file, split, place, value), in the order of each split."""
    return (
        spark.read.option("lineSep", MAGIC).option("recursiveFileLookup", "true").text(path)
        .select(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
            F.monotonically_increasing_id().alias("place"), "value",
        )
    )


def _located(rows: DataFrame) -> DataFrame:
    """``rows`` (with ``size``) and the ``offset`` of the magic before each: a prefix sum in a split, and over splits."""
    within = Window.partitionBy("file", "split").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    over = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("file", "split").agg(F.sum("size").alias("total"))
    starts = starts.select("file", "split", F.coalesce(F.sum("total").over(over), F.lit(0)).alias("base"))
    rows = rows.withColumn("before", F.coalesce(F.sum("size").over(within), F.lit(0)))
    rows = rows.join(starts, ["file", "split"])
    return rows.withColumn("offset", F.col("base") + F.col("before") - len(MAGIC)).drop("base", "before", "place")


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """(file, offset, next, ...) of every occurrence of the magic, with the header fields that follow it."""
    head = F.substring_index("value", END, 1)
    length = _field(head, "Content-Length")
    rows = pieces(spark, path).withColumn("head", head).select(
        "file", "split", "place",
        (F.octet_length("value") + len(MAGIC)).cast("long").alias("size"),
        (F.octet_length("head") + len(MAGIC) + len(END)).cast("long").alias("skip"),
        F.when(length.rlike(r"^\d{1,18}$"), length.cast("long")).alias("length"),
        _field(F.col("head"), "WARC-Type").alias("record_type"),
        _field(F.col("head"), "WARC-Record-ID").alias("record_id"),
        _field(F.col("head"), "WARC-Refers-To").alias("refers_to"),
        _field(F.col("head"), "WARC-Payload-Digest").alias("stated"),
        *_payload(F.expr("substring(cast(value as binary), octet_length(head) + 5)")),
    )
    rows = _located(rows).filter("offset >= 0")
    return rows.withColumn("next", F.col("offset") + F.col("skip") + F.col("length") + len(END))


def _payload(block: Column) -> list[Column]:
    """Size and digest of the payload of an HTTP response block; the end of the record may follow it."""
    http = F.substring_index(block.cast("string"), END, 1)
    size = _field(http, "Content-Length")
    bytes_ = F.when(size.rlike(r"^\d{1,18}$"), size.cast("long"))
    body = F.call_function("substring", block, F.octet_length(http) + len(END) + 1, bytes_.cast("int"))
    return [bytes_.alias("payload_bytes"), base32_sha1(body).alias("found"), F.octet_length(body).cast("long").alias("body_bytes")]


def reachable(links: DataFrame) -> DataFrame:
    """(file, offset) of the candidates of ``links`` (file, offset, next) on the chain from offset 0 of their file."""
    keys = ["file", "offset"]
    known = durable(links.select(*keys), "candidates")
    step = links.join(known.withColumnRenamed("offset", "next"), ["file", "next"], "left_semi").select(*keys, "next")
    step = durable(step, "step")
    reached = durable(known.filter("offset = 0"), "reached")
    count = reached.count()
    while True:
        more = reached.join(step, keys).select("file", F.col("next").alias("offset"))
        reached = durable(reached.union(more).distinct(), "reached")
        now = reached.count()
        if now == count:
            return reached
        count = now
        onward = step.select("file", F.col("offset").alias("next"), F.col("next").alias("_last"))
        step = durable(step.join(onward, ["file", "next"]).select(*keys, F.col("_last").alias("next")), "step")


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, record_type, refers_to, payload_bytes, payload_digest, intact) of every record of the archives.

    ``intact`` tells that a response's payload, as read, has the stated length and digest.
    """
    found = durable(candidates(spark, path), "found")
    kept = reachable(found.filter("next IS NOT NULL").select("file", "offset", "next"))
    records = durable(found.join(kept, ["file", "offset"], "left_semi"), "records")

    # Records whose payload holds the magic: their pieces, read again, in order.
    cut = records.filter(F.col("offset") + F.col("size") < F.col("next")).select(
        "file", F.col("offset").alias("record"), F.col("next").alias("stop")
    )
    spans = found.select("file", "offset").join(cut, "file").filter("offset >= record AND offset < stop")
    spans = durable(spans.select("file", "offset", "record"), "spans")
    if spans.isEmpty():
        whole = records
    else:
        raw = _located(
            pieces(spark, path).withColumn("size", (F.octet_length("value") + len(MAGIC)).cast("long"))
        ).join(spans, ["file", "offset"])
        parts = F.array_sort(F.collect_list(F.struct("offset", F.col("value").cast("binary").alias("value"))))
        joined = raw.groupBy("file", "record").agg(parts.alias("parts")).select(
            "file", F.col("record").alias("offset"),
            F.aggregate(
                F.slice("parts", 2, F.size("parts")), F.col("parts")[0]["value"],
                lambda a, x: F.concat(a, F.lit(MAGIC).cast("binary"), x["value"]),
            ).alias("value"),
        )
        block = F.expr("substring(value, skip - 9)")
        mended = joined.join(records.drop("payload_bytes", "found", "body_bytes"), ["file", "offset"])
        mended = mended.select(*[c for c in records.columns if c not in ("payload_bytes", "found", "body_bytes")], *_payload(block))
        whole = records.join(mended.select("file", "offset"), ["file", "offset"], "left_anti").unionByName(mended)

    def number(name: str) -> Column:
        return F.regexp_extract(F.col(name), r"^<urn:page:(-?\d+)>$", 1).try_cast("long")

    digest = F.regexp_replace("stated", "^sha1:", "")
    return whole.select(
        number("record_id").alias("page_id"),
        "record_type",
        number("refers_to").alias("refers_to"),
        "payload_bytes",
        digest.alias("payload_digest"),
        ((F.col("record_type") == "revisit") | (F.col("found") == digest) & (F.col("body_bytes") == F.col("payload_bytes"))).alias("intact"),
    )


def archive(pages: DataFrame, path: str | None = None, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` to archives under ``path`` (default: the shared folder) and read them back."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_warc(pages, path, min_bytes)
    return read_warc(spark, path)
