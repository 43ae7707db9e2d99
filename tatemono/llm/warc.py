"""WARC archives: written by Spark's text writer, read back by boundary chains.

Writing: a record is a row of text, and the writer's line separator is the
blank line that ends a record. Records with a payload that another record has
too become revisits of the one with the largest page_id.

Reading: the files are split at every occurrence of the magic, wherever a
split of a file begins, so one archive is read by many tasks. An occurrence is
only a candidate: it may lie inside a payload. Each candidate with a readable
header names its successor, the offset where its declared length ends. Pointer
jumping from the start of each file, with the length of the jump doubled in
every round, retains the records that the chain of successors reaches, and
nothing else. A record whose payload holds the magic is put together again
from its pieces. Their texts are read once more and found by their digests, so
the two reads may split the files differently.

Nulls and edges: a NULL html is an empty payload, a NULL url gives no target
header, a url with control characters or line separators is percent-encoded and
comes back as it was, and a NULL page_id no record id; such a row never is the original of
another one, unless no row with that payload has an id, when all of them are
responses. Rows that repeat the largest page_id are all responses. An empty
table gives no record. Other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tatemono.operators.joins import lookup_join
from tatemono.sources import scratch

MAGIC = "WARC/1.1\r\n"
BLANK = "\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"
LEAST_REVISIT_BYTES = 0

# A url that a header line cannot hold as it is: controls and line separators,
# blanks at its ends, nothing at all. It is percent-encoded, and a header says so.
_UNFIT = r"[\x00-\x1F\x7F-\x9F\u2028\u2029]|^ | $|^$"

_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"  # fixed value: RFC 4648
_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"


def sha1_base32(data: Column) -> Column:
    """SHA-1 in upper-case base32: 40 bits, 10 hex digits, are 8 characters."""
    hexadecimal = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(hexadecimal, at, 10), 16, 32), 8, "0") for at in (1, 11, 21, 31)]
    return F.translate(F.concat(*parts), _DIGITS, _ALPHABET)


def _header(name: str, value: Column) -> Column:
    """A header line; none where the value is NULL."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def write_warc(pages: DataFrame, path: str, date: str = DATE, least_revisit_bytes: int = LEAST_REVISIT_BYTES) -> None:
    """One record per row of ``pages`` in archives below ``path``."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long"), "url", payload.alias("payload"))
    data = F.col("payload").cast("binary")
    # equal digests of two kinds stand for equal payloads
    rows = rows.withColumns({"digest": sha1_base32(data), "check": F.xxhash64(data), "bytes": F.octet_length("payload")})
    originals = (
        rows.where(F.col("bytes") >= least_revisit_bytes)
        .groupBy("digest", "check")
        .agg(F.max("page_id").alias("original"), F.count(F.lit(1)).alias("_count"))
        .where(F.col("_count") > 1)
    )
    joined = lookup_join(rows, scratch.store(originals, "originals"), ["digest", "check"], ["page_id", "url"], "_count")
    revisit = F.col("original").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original"))
    record_id = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    unfit = F.coalesce(F.col("url").rlike(_UNFIT), F.lit(False))
    record = F.concat(
        F.lit(MAGIC),
        _header("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _header("WARC-Record-ID", record_id(F.col("page_id"))),
        _header("WARC-Date", F.lit(date)),
        _header("WARC-Target-URI", F.when(unfit, F.url_encode("url")).otherwise(F.col("url"))),
        _header("X-Target-URI-Encoding", F.when(unfit, F.lit("form"))),
        _header("WARC-Refers-To", F.when(revisit, record_id(F.col("original")))),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        _header("X-Payload-Length", F.col("bytes").cast("string")),
        _header("Content-Type", F.lit("text/html; charset=utf-8")),
        _header("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("bytes").cast("string"))),
        F.lit("\r\n"),
        F.when(revisit, F.lit("")).otherwise(F.col("payload")),
    )
    joined.select(record.alias("value")).write.option("lineSep", BLANK).text(path)


def _field(head: Column, name: str, value: str = "([^\r]*)") -> Column:
    # d: nothing but a line feed ends a line
    found = F.regexp_extract(head, rf"(?imd)^{name}: *{value}\r?$", 1)
    return F.when(found != "", found)


def _number(head: Column, name: str, value: str) -> Column:
    return _field(head, name, value).try_cast("long")


def _url(head: Column) -> Column:
    line = _field(head, "WARC-Target-URI")
    encoded = _field(head, "X-Target-URI-Encoding") == "form"
    return F.when(encoded, F.coalesce(F.url_decode(line), F.lit(""))).otherwise(line)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """What lies between occurrences of the magic. ``at`` orders the pieces of
    a block of a file. ``block`` and ``at`` depend on how the files are split,
    so they hold for one read only."""
    return spark.read.option("lineSep", MAGIC).text(path).select(
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        "value",
    )


def _content() -> dict[str, Column]:
    """Digests of two kinds of a piece; where equal, the pieces are."""
    return {"content": F.sha1(F.col("value").cast("binary")), "content_check": F.xxhash64("value")}


def _candidates(spark: SparkSession, path: str, payloads: bool) -> DataFrame:
    """Stored pieces with what their headers say."""
    rows = _pieces(spark, path).withColumns(
        {"size": F.octet_length("value").cast("long"), "head": F.substring_index("value", BLANK, 1)}
    )
    head = F.col("head")
    rows = rows.withColumn("head_bytes", F.octet_length("head").cast("long")).withColumn(
        "length", F.when(F.col("head_bytes") < F.col("size"), _number(head, "Content-Length", r"(\d{1,18})"))
    )
    whole = F.coalesce(F.col("size") == F.col("head_bytes") + len(BLANK) * 2 + F.col("length"), F.lit(False))
    rows = rows.withColumn("whole", whole)
    payload = F.when(F.col("whole"), _payload(F.col("value")))
    rows = rows.select(
        "file", "block", "at", "size", "head_bytes", "length", "whole",
        *[c.alias(n) for n, c in _content().items()],
        _field(head, "WARC-Type").alias("record_type"),
        _number(head, "WARC-Record-ID", r"<urn:page:(-?\d{1,19})>").alias("page_id"),
        _url(head).alias("url"),
        _number(head, "WARC-Refers-To", r"<urn:page:(-?\d{1,19})>").alias("refers_to"),
        _field(head, "WARC-Payload-Digest", "sha1:([A-Z2-7]{32})").alias("declared"),
        _number(head, "X-Payload-Length", r"(\d{1,18})").alias("full_bytes"),
        F.when(F.col("whole"), sha1_base32(payload)).alias("digest"),
        (payload if payloads else F.lit(None).cast("binary")).alias("payload"),
    )
    return scratch.store(rows, "pieces")


def _payload(value: Column) -> Column:
    data = value.cast("binary")
    return F.substring(data, (F.col("head_bytes") + len(BLANK) + 1).cast("int"), F.col("length").cast("int"))


def _offsets(pieces: DataFrame) -> DataFrame:
    """Stored ``file, block, at, off, jump, reached`` of the candidates. A
    piece's place is the sum of the sizes before it: of whole blocks, and
    inside its block."""
    magic = len(MAGIC)
    sizes = pieces.select("file", "block", "at", (F.col("size") + magic).alias("n"), "head_bytes", "length")
    blocks = sizes.groupBy("file", "block").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("_count"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("file", "block", "_count", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    joined = lookup_join(sizes, scratch.store(blocks, "blocks"), ["file", "block"], ["at"], "_count")
    inside = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    # what stands before a file's first magic is not a candidate
    off = F.col("before") + F.coalesce(F.sum("n").over(inside), F.lit(0)) - magic
    ends = F.col("off") + magic + F.col("head_bytes") + 2 * len(BLANK) + F.col("length")
    nodes = joined.withColumn("off", off).where(F.col("off") >= 0).withColumn("jump", ends)
    return scratch.store(nodes.select("file", "block", "at", "off", "jump", (F.col("off") == 0).alias("reached")), "nodes")


def reachable(nodes: DataFrame) -> DataFrame:
    """Candidates ``file, off`` that the chain from offset 0 of their file
    reaches, by pointer jumping over ``file, off, jump, reached``.

    After k rounds the first 2**k records of a file are marked, and ``jump``
    leads 2**k records on. Each round is stored."""
    nodes = scratch.store(nodes.select("file", "off", "jump", "reached"), "chain")
    while not nodes.where((F.col("off") == 0) & F.col("jump").isNotNull()).isEmpty():
        hit = nodes.where(F.col("reached") & F.col("jump").isNotNull())
        hit = hit.select("file", F.col("jump").alias("off"), F.lit(True).alias("hit"))
        on = nodes.select("file", F.col("off").alias("jump"), F.col("jump").alias("further"))
        moved = nodes.join(on, ["file", "jump"], "left").join(hit.distinct(), ["file", "off"], "left")
        marked = F.col("reached") | F.coalesce("hit", F.lit(False))
        nodes = scratch.store(moved.select("file", "off", F.col("further").alias("jump"), marked.alias("reached")), "chain")
    return nodes.where("reached").select("file", "off")


def _texts(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """Stored ``value`` of each content in ``wanted``, and ``_count``, how many
    pieces have it. Only the contents link this read to the first one."""
    contents = list(_content())
    counts = scratch.store(wanted.groupBy(*contents).agg(F.count(F.lit(1)).alias("_count")), "contents")
    if scratch.measure(counts).broadcastable:
        counts = F.broadcast(counts)
    found = _pieces(spark, path).withColumns(_content()).join(counts, contents)
    return scratch.store(found.groupBy(*contents).agg(F.first("value").alias("value"), F.first("_count").alias("_count")), "texts")


def _assembled(
    spark: SparkSession, path: str, cut: DataFrame, nodes: DataFrame, records: DataFrame, pieces: DataFrame
) -> DataFrame:
    """``file, off, payload`` of the records ``cut`` (with ``file, off,
    head_bytes, length``), whose payload holds the magic. A piece belongs to
    the last record that begins at or before it."""
    begins = nodes.join(records.withColumn("begins", F.col("off")), ["file", "off"], "left")
    blocks = begins.groupBy("file", "block").agg(F.max("begins").alias("last"), F.count(F.lit(1)).alias("_count"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("file", "block", "_count", F.max("last").over(earlier).alias("carried"))
    begins = lookup_join(begins, scratch.store(blocks, "carried"), ["file", "block"], ["at"], "_count")
    inside = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    owner = F.coalesce(F.max("begins").over(inside), F.col("carried"))
    owned = begins.select("file", "block", "at", F.col("off").alias("place"), owner.alias("off"))
    contents = list(_content())
    owned = owned.join(cut, ["file", "off"]).join(pieces.select("file", "block", "at", *contents), ["file", "block", "at"])
    wanted = scratch.store(owned.drop("block", "at"), "wanted")
    texts = lookup_join(wanted, _texts(spark, path, wanted), contents, ["file", "place"], "_count")
    grouped = texts.groupBy("file", "off", "head_bytes", "length").agg(
        F.array_sort(F.collect_list(F.struct("place", "value"))).alias("parts")  # one record
    )
    value = F.array_join(F.transform("parts", lambda p: p["value"]), MAGIC)
    return grouped.select("file", "off", _payload(value).alias("whole_payload"))


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records of the archives below ``path``: ``record_type, page_id, url,
    refers_to, payload_bytes, payload_digest, payload, valid``.

    ``payload_bytes`` and ``payload_digest`` of a response are those of the
    payload as read, of a revisit those its header declares. ``valid`` tells
    whether a response's payload has the declared digest. ``payloads=False``
    leaves the payload NULL.
    """
    pieces = _candidates(spark, path, payloads)
    nodes = _offsets(pieces)
    records = scratch.store(reachable(nodes), "records")
    placed = nodes.select("file", "block", "at", "off").join(records, ["file", "off"])
    found = scratch.store(placed.join(pieces, ["file", "block", "at"]), "found")
    cut = found.where(~F.col("whole") & F.col("length").isNotNull())
    if not cut.isEmpty():
        joined = _assembled(spark, path, cut.select("file", "off", "head_bytes", "length"), nodes, records, pieces)
        found = found.join(joined, ["file", "off"], "left").withColumns(
            {
                "digest": F.coalesce("digest", sha1_base32(F.col("whole_payload"))),
                "payload": F.coalesce("payload", "whole_payload") if payloads else F.col("payload"),
            }
        )
    revisit = F.col("record_type") == "revisit"
    return found.select(
        "record_type",
        "page_id",
        "url",
        "refers_to",
        F.when(revisit, F.col("full_bytes")).otherwise(F.col("length")).alias("payload_bytes"),
        F.when(revisit, F.col("declared")).otherwise(F.col("digest")).alias("payload_digest"),
        "payload",
        F.coalesce(revisit | (F.col("digest") == F.col("declared")), F.lit(False)).alias("valid"),
    )


def round_trip(pages: DataFrame) -> DataFrame:
    """Pages written to archives in the shared folder and read back."""
    spark = pages.sparkSession
    path = scratch.new_path(spark, "warc")
    write_warc(pages, path)
    return read_warc(spark, path, payloads=False)
