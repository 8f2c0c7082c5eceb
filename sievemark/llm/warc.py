"""WARC archives of pages: written as request, response and metadata records, and read back as captures.

Every page becomes three records. Payloads are known by their SHA-256: of those that are equal and have
``LEAST_BYTES`` or more, the one of the smallest page is a response, and the others are revisits of it, with
all headers but no payload. Request and metadata name their response in WARC-Concurrent-To.

Archives are text files to Spark: it writes them in parallel, compressed, one for each split of the
pages, and reads them by a record separator. A payload that holds its version mark is stored in base64, so
none is ever cut. Headers and payloads are told apart by bytes, so payloads need not be UTF-8. What is
read back is checked: a record whose length is not the stated one stops the job.

Transactions are assembled by joining records on the identifier of their response; each capture is one nested
row. Payload length and digest are computed before that join, so a caller who asks for them
alone moves no payloads.

Defined results: a null payload is empty. Pages equal in id and payload, if that is the smallest id, are
all responses. A null page id comes after all others. A null URL is left out of the records; bytes of
a URL that do not belong in a header are percent-encoded. An empty table gives an empty archive
and no captures. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..plans.durable import stored
from ..plans.lookup import join_groups

LEAST_BYTES = 100
DATE = "2024-01-01T00:00:00Z"
_VERSION = "WARC/1.1\r\n"
_BETWEEN = "\r\n\r\n"
# Fixed value: the profile of a revisit with an identical payload, as the WARC standard names it.
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def decided(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    least_bytes: int = LEAST_BYTES,
    max_broadcast: int | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """(page_id, url, payload, digest, original): with the page whose payload it repeats, null if none."""
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(
        F.col(id_col).cast("bigint").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        payload.alias("payload"),
        F.sha2(payload, 256).alias("digest"),
        # Small payloads have no group.
        F.when(F.octet_length(payload) >= least_bytes, F.unhex(F.sha2(payload, 256))).alias("key"),
    )
    first = F.min(F.struct(F.col("page_id").isNull().alias("unknown"), "page_id", F.col("url").isNull(), "url"))
    groups = (
        rows.where("key is not null")
        .groupBy("key")
        .agg(F.count("*").alias("size"), first.alias("first"))
        .where("size > 1")
        .select("key", "size", F.struct("first.page_id", "first.url").alias("first"))
    )
    groups = stored(groups, "equal_payloads")
    counted = groups.agg(F.count("*").alias("groups"), F.sum("size").alias("rows")).first()
    joined = join_groups(
        rows, groups, keys=["key"], size="size", facts=["first"], row_id="page_id",
        group_count=counted.groups, grouped_rows=counted.rows or 0,
        max_broadcast=max_broadcast, hot_rows=hot_rows,
    )
    repeats = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first.page_id"))
    return joined.select(
        "page_id", "url", "payload", "digest",
        F.when(repeats, F.struct("first.page_id", "first.url")).alias("original"),
    )


def _uuid(*parts: Column) -> Column:
    """A record identifier from some values."""
    digest = F.md5(F.concat_ws("\n", *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts]).cast("binary"))
    dashed = F.concat_ws("-", *[F.substring(digest, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    return F.concat(F.lit("<urn:uuid:"), dashed, F.lit(">"))


def _header_value(value: Column) -> Column:
    """Printable ASCII as it is, all else percent-encoded."""
    odd = value.rlike(r"[^\x21-\x7E]")
    return F.when(odd, F.replace(F.replace(F.url_encode(value), F.lit("%2F"), F.lit("/")), F.lit("%3A"), F.lit(":"))
                  ).otherwise(value)


def _head(**fields: Column | str | None) -> Column:
    """Header lines; a field that is null is left out."""
    lines = [
        F.concat(F.lit(f"{name.replace('_', '-')}: "), F.lit(value) if isinstance(value, str) else value)
        for name, value in fields.items()
    ]
    return F.concat_ws("\r\n", *lines)


def _record(head: Column, block: Column) -> Column:
    """A record up to the blank lines that end it; ``block`` is binary."""
    length = F.concat(F.lit("\r\nContent-Length: "), F.octet_length(block).cast("string"), F.lit(_BETWEEN))
    return F.concat(F.concat(F.lit(_VERSION), head, length).cast("binary"), block).cast("string")


def write_archives(captures: DataFrame, path: str, date: str = DATE, compression: str = "gzip") -> None:
    """Archives of ``decided`` pages, in a folder that must not exist yet."""
    url = _header_value(F.col("url"))
    numbered = captures.withColumns({
        "number": F.monotonically_increasing_id(),  # tells repeated rows apart; used in this one job only
        "wrapped": F.contains(F.col("payload"), F.lit(_VERSION.strip().encode())),
        "size": F.octet_length("payload"),
    })
    response_id = _uuid(F.lit("response"), F.col("page_id"), F.col("digest"), F.col("number"))
    common = {"WARC_Target_URI": url, "WARC_Date": date}

    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("size").cast("string"),
        F.when(F.col("wrapped"), F.lit("\r\nContent-Transfer-Encoding: base64")).otherwise(F.lit("")),
        F.lit(_BETWEEN),
    ).cast("binary")
    body = F.when(F.col("wrapped"), F.base64("payload").cast("binary")).otherwise(F.col("payload"))
    digest = F.concat(F.lit("sha256:"), F.col("digest"))
    kind = {"Content_Type": "application/http; msgtype=response"}
    response = _record(
        _head(WARC_Type="response", WARC_Record_ID=F.col("response_id"), **common, WARC_Payload_Digest=digest, **kind),
        F.concat(http, body),
    )
    revisit = _record(
        _head(
            WARC_Type="revisit", WARC_Record_ID=F.col("response_id"), **common, WARC_Payload_Digest=digest,
            WARC_Profile=_PROFILE, WARC_Refers_To_Target_URI=_header_value(F.col("original.url")),
            WARC_Refers_To_Page=F.col("original.page_id").cast("string"), **kind,
        ),
        http,
    )
    host = F.regexp_extract(url, "^[^:/?#]+://([^/?#]*)", 1)
    target = F.coalesce(F.regexp_extract(url, "^[^:/?#]+://[^/?#]*([^#]*)", 1), F.lit(""))
    asked = F.concat(
        F.lit("GET "), F.when(F.startswith(target, F.lit("/")), target).otherwise(F.concat(F.lit("/"), target)),
        F.lit(" HTTP/1.1\r\nHost: "), F.coalesce(host, F.lit("")), F.lit(_BETWEEN),
    )
    request = _record(
        _head(
            WARC_Type="request", WARC_Record_ID=_uuid(F.lit("request"), F.col("response_id")),
            WARC_Concurrent_To=F.col("response_id"), **common, Content_Type="application/http; msgtype=request",
        ),
        asked.cast("binary"),
    )
    known = F.concat_ws(
        "\r\n", F.concat(F.lit("page-id: "), F.col("page_id").cast("string")), F.concat(F.lit("page-url: "), url)
    )
    metadata = _record(
        _head(
            WARC_Type="metadata", WARC_Record_ID=_uuid(F.lit("metadata"), F.col("response_id")),
            WARC_Concurrent_To=F.col("response_id"), **common, Content_Type="application/warc-fields",
        ),
        known.cast("binary"),
    )
    own = F.when(F.col("original").isNull(), response).otherwise(revisit)
    (
        numbered.withColumn("response_id", response_id)
        .select(F.explode(F.array(request, own, metadata)).alias("value"))
        .write.option("lineSep", _BETWEEN)
        .option("compression", compression)
        .text(path)
    )


def _field(head: str, name: str) -> Column:
    """A header field; null if it is not there."""
    return F.nullif(F.regexp_extract(head, rf"(?im)^{name}:[ \t]*([^\r\n]*)", 1), F.lit(""))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, record_id, type, concurrent_to, head, block): all records of the archives of a folder."""
    read = spark.read.option("lineSep", _BETWEEN + _VERSION).text(path).select(
        F.col("_metadata.file_name").alias("file"),
        F.col("value").cast("binary").alias("record"),
        F.substring_index("value", _BETWEEN, 1).alias("head"),
    )
    after = F.octet_length("head") + len(_BETWEEN)
    cut = read.where("octet_length(record) > 0").select(
        "file",
        "head",
        _field("head", "Content-Length").try_cast("bigint").alias("length"),
        F.substring(F.col("record"), after + 1, F.greatest(F.octet_length("record") - after, F.lit(0))).alias("rest"),
    )
    # The last record of a file keeps the blank lines that end it.
    size = F.octet_length("rest")
    ended = F.substring(F.col("rest"), size - (len(_BETWEEN) - 1), F.lit(len(_BETWEEN))) == F.lit(_BETWEEN.encode())
    whole = (size == F.col("length")) | ((size == F.col("length") + len(_BETWEEN)) & ended)
    block = F.substring(F.col("rest"), F.lit(1), F.col("length").cast("int"))
    broken = F.raise_error(F.concat(F.lit("a record is not as long as it says, in "), F.col("file")))
    return cut.select(
        "file",
        _field("head", "WARC-Record-ID").alias("record_id"),
        _field("head", "WARC-Type").alias("type"),
        _field("head", "WARC-Concurrent-To").alias("concurrent_to"),
        "head",
        F.when(F.coalesce(whole, F.lit(False)), block).otherwise(broken).alias("block"),
    )


def captures(records: DataFrame) -> DataFrame:
    """One row for every response or revisit, with its request and its metadata, null if there are none.

    (record_id, type, target_uri, page_id, payload_bytes, payload_digest, refers_to, payload, request, metadata).
    """
    answers = records.where(F.col("type").isin("response", "revisit")).withColumn(
        "http", F.substring_index(F.col("block").cast("string"), _BETWEEN, 1)
    )
    after = F.octet_length("http") + len(_BETWEEN)
    sent = F.substring(F.col("block"), after + 1, F.greatest(F.octet_length("block") - after, F.lit(0)))
    stated = F.regexp_replace(_field("head", "WARC-Payload-Digest"), "^sha256:", "")
    is_response = F.col("type") == "response"
    wrapped = _field("http", "Content-Transfer-Encoding") == "base64"
    answers = answers.withColumn("sent", sent).select(
        "record_id",
        "type",
        _field("head", "WARC-Target-URI").alias("target_uri"),
        _field("head", "WARC-Refers-To-Page").try_cast("bigint").alias("refers_to"),
        stated.alias("stated"),
        _field("http", "Content-Length").try_cast("bigint").alias("stated_bytes"),
        F.when(
            is_response,
            F.when(F.coalesce(wrapped, F.lit(False)), F.unbase64(F.col("sent").cast("string"))).otherwise(F.col("sent")),
        ).alias("payload"),
    )
    answers = answers.select(
        "record_id",
        "type",
        "target_uri",
        "refers_to",
        # A revisit has no payload to measure; its headers tell.
        F.coalesce(F.octet_length("payload").cast("bigint"), "stated_bytes").alias("payload_bytes"),
        F.coalesce(F.sha2("payload", 256), "stated").alias("payload_digest"),
        "payload",
    )

    def beside(kind: str) -> DataFrame:
        fields = F.struct("record_id", "head", "block").alias(kind)
        return records.where(F.col("type") == kind).select(F.col("concurrent_to").alias("record_id"), fields)

    page = _field("text", "page-id").try_cast("bigint")
    return (
        answers.join(beside("request"), "record_id", "left")
        .join(beside("metadata"), "record_id", "left")
        .withColumn("text", F.col("metadata.block").cast("string"))
        .select(
            "record_id", "type", "target_uri", page.alias("page_id"), "payload_bytes", "payload_digest", "refers_to",
            "payload", "request", "metadata",
        )
    )
