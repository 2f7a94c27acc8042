"""WARC archives: written with Spark's text writer, read back by boundary-chain verification.

Writing: one record per page. Of pages with equal payloads the one with the smallest page_id becomes a
`response`, the others become `revisit` records without payload that refer to it. Files are plain WARC/1.1,
so a reader can split them anywhere.

Reading: every task finds the places in its split where the version line stands. Each is only a candidate:
its Content-Length says where its successor would begin. Pointer jumping from offset 0 of each file doubles
the reached stretch of the chain per round, and what it doesn't reach (a version line inside a payload, even
a whole record in there) is no record. A chain that doesn't end at its file's end is an error, unless
`strict` is off; then the records up to there are returned. Payloads don't travel: expressions on them are
evaluated where they are read. Only for records with a version line inside, the files that hold them are
read again and their parts put together.

A null payload is empty, a null url leaves its header out, and a null page_id is written as `null` and read
back null; it is never what a revisit refers to unless all pages of that payload have none (then all are
responses). Pages repeated as a whole are each written; those with the smallest page_id are all responses.
An empty table gives files without records. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablewright.session import materialize

MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"

# A record longer than this spans several buckets when parts are looked up by place.
_BUCKET = 1 << 20


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in upper-case base32, as payload digests are written."""
    digits = F.sha1(payload.cast("binary"))
    groups = [F.lpad(F.conv(F.substring(digits, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _uri(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(">"))


def page_of(uri: Column) -> Column:
    return F.regexp_extract(uri, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0, records_per_file: int = 20_000) -> None:
    """Write page_id, url, html as archives below `path`. Payloads under `least_bytes` are never revisits."""
    pages = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("payload"))
    pages = pages.withColumn("digest", base32_sha1(F.col("payload")))
    size = F.octet_length("payload")
    # Only digests that occur more than once; written first, so that its true size decides how it is joined.
    firsts = pages.where(size >= least_bytes).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    firsts = materialize(firsts.where("n > 1 AND first IS NOT NULL").select("digest", "first"), label="firsts")
    pages = pages.join(firsts, "digest", "left")
    revisit = F.col("first").isNotNull() & (size >= least_bytes) & ~F.col("page_id").eqNullSafe(F.col("first"))
    block = F.concat(F.lit(HTTP), F.when(revisit, "").otherwise(F.col("payload")))
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    fields = [
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), _uri(F.col("page_id"))),
        F.lit("WARC-Date: " + DATE),
        F.concat(F.lit("WARC-Target-URI: "), url),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), _uri(F.col("first")), F.lit("\r\nWARC-Profile: " + PROFILE))),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    ]
    record = F.concat(F.lit(MAGIC), F.concat_ws("\r\n", *fields), F.lit(END), block)
    pages.select(record.alias("value")).write.option("lineSep", END).option("maxRecordsPerFile", records_per_file).text(path)


def _parts(spark: SparkSession, path: str) -> DataFrame:
    """What stands between version lines: file, block, seq, file_size, value."""
    lines = spark.read.option("lineSep", MAGIC).text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("file_size"),
        F.monotonically_increasing_id().alias("seq"),
        "value",
    )


def _located(parts: DataFrame) -> DataFrame:
    """With `offset`, the byte at which the version line before the part begins (negative: none)."""
    full = F.col("size") + len(MAGIC)
    in_split = Window.partitionBy("file", "block").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    in_file = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # One row per split of a file.
    splits = parts.groupBy("file", "block").agg(F.sum(full).alias("bytes"))
    splits = splits.select("file", "block", F.coalesce(F.sum("bytes").over(in_file), F.lit(0)).alias("base"))
    located = parts.withColumn("inner", F.coalesce(F.sum(full).over(in_split), F.lit(0))).join(splits, ["file", "block"])
    return located.withColumn("offset", F.col("base") + F.col("inner") - len(MAGIC)).drop("base", "inner", "seq", "block")


def _field(header: Column, name: str) -> Column:
    found = F.regexp_extract(header, rf"(?mi)^{name}:[ \t]*([^\r\n]*)", 1)
    return F.when(found != "", found)


def _payload(value: Column) -> Column:
    """The payload of a part that holds one record: behind its header and that of HTTP, without the end."""
    head = F.locate(END, value)
    is_http = F.substring(value, F.lit(1), head).contains("application/http")
    http = F.locate(END, F.substring(value, head + len(END), F.char_length(value)))
    start = head + len(END) + F.when(is_http & (http > 0), http + len(END) - 1).otherwise(0)
    return F.substring(value, start, F.char_length(value) - start + 1 - len(END))


def reachable(edges: DataFrame) -> DataFrame:
    """file, offset of the nodes that can be reached from offset 0 by following `next`."""
    nodes = edges.select("file", "offset", F.col("next").alias("jump"), (F.col("offset") == 0).alias("reached"))
    nodes = materialize(nodes, label="chain")
    while True:
        far = nodes.select("file", F.col("offset").alias("jump"), F.col("jump").alias("far"))
        hit = nodes.where("reached AND jump IS NOT NULL").select("file", F.col("jump").alias("offset"), F.lit(True).alias("hit"))
        nodes = nodes.join(far, ["file", "jump"], "left").join(hit, ["file", "offset"], "left")
        nodes = nodes.select("file", "offset", F.col("far").alias("jump"), (F.col("reached") | F.col("hit").isNotNull()).alias("reached"))
        nodes = materialize(nodes, label="chain")
        if nodes.where("reached AND jump IS NOT NULL").isEmpty():
            return nodes.where("reached").select("file", "offset")


def read_archives(spark: SparkSession, path: str, derive: dict[str, Callable[[Column], Column]], strict: bool = True) -> DataFrame:
    """Records below `path`: file, offset, record_type, record_id, target_uri, digest, refers_to, and what
    `derive` makes of each payload (pass the identity for the payload itself)."""
    value = F.col("value")
    header = F.substring(value, F.lit(1), F.locate(END, value) - 1)
    length = _field(F.col("header"), "Content-Length").try_cast("long")
    named = {"record_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI"}
    named |= {"digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To"}
    parts = _parts(spark, path)
    slim = parts.withColumns({"size": F.octet_length(value).cast("long"), "header": F.when(F.locate(END, value) > 0, header)})
    slim = slim.select(
        *("file", "block", "file_size", "seq", "size"),
        (F.octet_length("header") + len(END) + length + len(END)).alias("needs"),
        *(_field(F.col("header"), field).alias(name) for name, field in named.items()),
        *(make(_payload(value)).alias(name) for name, make in derive.items()),
    )
    slim = materialize(_located(slim).where("offset >= 0 AND needs IS NOT NULL"), label="records")
    slim = slim.withColumn("next", F.col("offset") + len(MAGIC) + F.col("needs"))
    records = slim.join(reachable(slim.select("file", "offset", "next")), ["file", "offset"])
    if strict:
        sizes = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("file"), F.col("length"))
        ends = records.groupBy("file").agg(F.max("next").alias("end"))
        broken = sizes.where("length > 0").join(ends, "file", "left").where("end IS NULL OR end <> length").limit(3).collect()
        if broken:
            raise ValueError("the chain of records does not reach the end of " + ", ".join(r["file"] for r in broken))
    whole = records.where(F.col("needs") == F.col("size"))
    parted = records.where(F.col("needs") != F.col("size"))
    columns = ["file", "offset", *named, *derive]
    if parted.isEmpty():
        return whole.select(*columns)
    again = parts.join(parted.select("file").distinct(), "file", "left_semi").withColumn("size", F.octet_length("value").cast("long"))
    again = _located(again).select("file", F.col("offset").alias("at"), "value")
    again = again.withColumn("bucket", F.floor(F.col("at") / _BUCKET))
    spans = parted.select("file", "offset", "next", *named).withColumn(
        "bucket", F.explode(F.sequence(F.floor(F.col("offset") / _BUCKET), F.floor((F.col("next") - 1) / _BUCKET)))
    )
    inside = spans.join(again, ["file", "bucket"]).where("at >= offset AND at < next")
    joined = inside.groupBy("file", "offset", *named).agg(F.sort_array(F.collect_list(F.struct("at", "value"))).alias("parts"))
    text = F.array_join(F.transform("parts", lambda p: p["value"]), MAGIC)
    joined = joined.select("file", "offset", *named, *(make(_payload(text)).alias(name) for name, make in derive.items()))
    return whole.select(*columns).unionAll(joined.select(*columns))


def page_digests(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to from records read with these two derived.

    A revisit's figures are those of the response that it refers to.
    """
    responses = records.where("record_type = 'response'")
    plain = responses.select(
        page_of(F.col("record_id")).alias("page_id"),
        F.col("payload_bytes").cast("long"),
        "payload_digest",
        "record_type",
        F.lit(None).cast("long").alias("refers_to"),
    )
    known = responses.groupBy(F.col("record_id").alias("refers_to"), F.concat(F.lit("sha1:"), F.col("payload_digest")).alias("digest"))
    known = known.agg(F.first("payload_bytes").cast("long").alias("payload_bytes"), F.first("payload_digest").alias("payload_digest"))
    revisits = records.where("record_type = 'revisit'").select("record_id", "refers_to", "digest", "record_type")
    revisits = revisits.join(known, ["refers_to", "digest"], "left")
    return plain.unionAll(
        revisits.select(
            page_of(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type", page_of(F.col("refers_to")).alias("refers_to")
        )
    )
