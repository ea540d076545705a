"""WARC archives of pages: records written in segments, read back and reassembled.

Writing is DataFrame work. A record's block is an HTTP response whose payload is framed in chunks; a block
longer than `segment_bytes` is cut into a first record and continuation records, each with its segment
number and the identifier of the first. Spark's text writer commits the files: a record ends in CR LF CR LF,
whose last byte is the writer's line separator, so the files are plain WARC/1.1 streams, compressed whole.
Their size is bounded by the records in a file and the bytes of a segment.

Reading parses each archive where Spark read it, by the records' Content-Length. Continuations are grouped
by the identifier of their origin, ordered by segment number and checked for gaps and against the total
length; then the chunks are decoded and the payload's digest is compared.
"""

from __future__ import annotations

import gzip
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import texts
from tidemark.session import scratch_path

SEGMENT_BYTES = 1 << 14
CHUNK_BYTES = 1 << 12
RECORDS_PER_FILE = 1000
#: Smaller payloads are never replaced by a revisit.
REVISIT_BYTES = 1000
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_NL = "\r\n"


def _bytes(*parts: Column | str) -> Column:
    """Strings and binary columns in a row, as bytes."""
    return F.concat(*[(F.lit(p) if isinstance(p, str) else p).cast("binary") for p in parts])


def chunked(payload: Column, size: int = CHUNK_BYTES) -> Column:
    """Chunked transfer framing: each chunk after its size in hexadecimal, then an empty chunk."""
    count = F.ceil(F.octet_length(payload) / size).cast("int")
    numbers = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))

    def chunk(k: Column) -> Column:
        part = F.substring(payload, k * size + 1, F.lit(size))
        return _bytes(F.lower(F.hex(F.octet_length(part).cast("long"))), _NL, part, _NL)

    joined = F.array_join(F.transform(numbers, lambda k: chunk(k).cast("string")), "")
    return _bytes(joined, f"0{_NL}{_NL}")


def page_records(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Pages with payload, digest, and for a revisit the page_id of the response with the same payload.

    Of equal payloads of at least `revisit_bytes` the largest page_id is the response; pages that repeat both
    payload and that id are all responses, and so are pages without id. A null html is an empty payload.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload")
    )
    rows = rows.withColumn("digest", F.sha1("payload")).withColumn("size", F.octet_length("payload").cast("long"))
    # Counted over narrow rows, combined before their shuffle: only digests with two pages or more go on
    repeated = rows.filter(F.col("size") >= revisit_bytes).groupBy("digest", "size")
    repeated = repeated.agg(F.max("page_id").alias("top"), F.min("page_id").alias("low")).filter("low < top")
    rows = rows.join(repeated.drop("low"), ["digest", "size"], "left")
    return rows.withColumn("refers_to", F.when(F.col("page_id") < F.col("top"), F.col("top"))).drop("top")


def _identifier(page_id: Column, url: Column, digest: Column) -> Column:
    """The identifier of a page's record: the same for rows that repeat id, address and payload."""
    h = F.md5(_bytes(F.coalesce(page_id.cast("string"), F.lit("-")), " ", F.coalesce(url, F.lit("-")), " ", digest))
    groups = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *groups), F.lit(">"))


def warc_records(records: DataFrame, segment_bytes: int = SEGMENT_BYTES, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One binary WARC record a row, without its last byte (the line separator)."""
    head = F.lit(f"HTTP/1.1 200 OK{_NL}Content-Type: text/html; charset=utf-8{_NL}Transfer-Encoding: chunked{_NL}{_NL}")
    revisit = F.col("refers_to").isNotNull()
    block = F.when(revisit, head.cast("binary")).otherwise(_bytes(head, chunked(F.col("payload"), chunk_bytes)))
    rows = records.select(
        "page_id", "url", "digest", "refers_to", _identifier(F.col("page_id"), F.col("url"), F.col("digest")).alias("id"), block.alias("block")
    )
    total = F.octet_length("block")
    rows = rows.withColumn("total", total).withColumn("segments", F.greatest(F.ceil(total / segment_bytes), F.lit(1)).cast("int"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(1), F.col("segments"))).alias("number"))
    body = F.substring(F.col("block"), (F.col("number") - 1) * segment_bytes + 1, F.lit(segment_bytes))
    rows = rows.withColumn("body", body).drop("block")
    first, cut = F.col("number") == 1, F.col("segments") > 1
    own = F.when(first, F.col("id")).otherwise(
        F.concat(F.expr("substring(id, 1, length(id) - 1)"), F.lit("-"), F.col("number").cast("string"), F.lit(">"))
    )

    def line(name: str, value: Column, when: Column | None = None) -> Column:
        # A line break inside a value would end the header
        value = F.translate(value.cast("string"), _NL, "  ")
        text = F.concat(F.lit(f"{name}: "), value, F.lit(_NL))
        return F.coalesce(text if when is None else F.when(when, text), F.lit(""))

    kind = F.when(~first, "continuation").when(F.col("refers_to").isNotNull(), "revisit").otherwise("response")
    header = F.concat(
        F.lit(f"WARC/1.1{_NL}"),
        line("WARC-Type", kind),
        line("WARC-Record-ID", own),
        line("WARC-Date", F.lit(DATE)),
        line("WARC-Target-URI", F.col("url")),
        line("Content-Type", F.lit("application/http; msgtype=response"), first),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest")), first),
        line("WARC-Profile", F.lit(PROFILE), first & F.col("refers_to").isNotNull()),
        line("X-Page-ID", F.col("page_id"), first),
        line("X-Refers-To-Page-ID", F.col("refers_to"), first),
        line("WARC-Segment-Number", F.col("number"), cut),
        line("WARC-Segment-Origin-ID", F.col("id"), ~first),
        line("WARC-Segment-Total-Length", F.col("total"), cut & (F.col("number") == F.col("segments"))),
        line("Content-Length", F.octet_length("body")),
        F.lit(_NL),
    )
    return rows.select(_bytes(header, F.col("body"), F.lit("\r\n\r")).alias("record"))


def write(pages: DataFrame, path: str, segment_bytes: int = SEGMENT_BYTES, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write the pages (page_id, url, html) as archives under a path. Other columns are not read."""
    records = warc_records(page_records(pages), segment_bytes)
    text = records.select(F.col("record").cast("string").alias("value"))  # the bytes as they are
    writer = text.write.option("lineSep", "\n").option("compression", "gzip").option("maxRecordsPerFile", records_per_file)
    writer.text(path)


# Reading

RECORD = (
    "id string, type string, origin string, number int, total long, digest string, page_id long, refers_to long, "
    "profile string, content_type string, block binary"
)
_RECORD_SCHEMA = pa.schema(
    [("id", pa.string()), ("type", pa.string()), ("origin", pa.string()), ("number", pa.int32()), ("total", pa.int64()),
     ("digest", pa.string()), ("page_id", pa.int64()), ("refers_to", pa.int64()), ("profile", pa.string()),
     ("content_type", pa.string()), ("block", pa.binary())]
)


def parse(archive: bytes) -> Iterator[dict]:
    """The records of one archive. Anything that is no record raises an error, as what follows it can't be found."""
    at = 0
    while at < len(archive):
        end = archive.index(b"\r\n\r\n", at)
        lines = archive[at:end].decode("utf-8", "replace").split(_NL)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        fields = {name.lower(): value.strip() for name, _, value in (line.partition(":") for line in lines[1:])}
        start = end + 4
        past = start + int(fields["content-length"])
        if archive[past : past + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} doesn't end where it says")
        number = lambda key: int(fields[key]) if fields.get(key) else None
        yield {
            "id": fields["warc-record-id"],
            "type": fields["warc-type"],
            "origin": fields.get("warc-segment-origin-id"),
            "number": number("warc-segment-number"),
            "total": number("warc-segment-total-length"),
            "digest": fields.get("warc-payload-digest", "").removeprefix("sha1:") or None,
            "page_id": number("x-page-id"),
            "refers_to": number("x-refers-to-page-id"),
            "profile": fields.get("warc-profile"),
            "content_type": fields.get("content-type"),
            "block": archive[start:past],
        }
        at = past + 4


def read(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archives under a path, continuations as their own rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch["content"]:
                data = content.as_py()
                data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
                rows, size = [], 0
                for record in parse(data):
                    rows.append(record)
                    size += len(record["block"])
                    if size > 1 << 23:
                        yield pa.RecordBatch.from_pylist(rows, _RECORD_SCHEMA)
                        rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, _RECORD_SCHEMA)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, RECORD)


def reassemble(records: DataFrame) -> DataFrame:
    """Whole records: id, type, digest, page_id, refers_to, block, whole (false for a damaged one).

    Records without segment number are whole as they are. The others are grouped by the identifier of their
    origin; a record that was archived more than once gives a row each time. A group that lacks a segment, has
    two versions of one, or whose bytes don't add up to the total length keeps its row with a null block.
    """
    kept = ["type", "digest", "page_id", "refers_to"]
    single = records.filter("number IS NULL").select("id", *kept, "block", F.lit(True).alias("whole"))
    cut = records.filter("number IS NOT NULL").withColumn("origin", F.coalesce("origin", "id"))
    first = F.when(F.col("number") == 1, F.struct(*kept))
    groups = cut.groupBy(F.col("origin").alias("id")).agg(
        F.count(F.lit(1)).alias("n"),
        F.max("total").alias("total"),
        F.max(first).alias("head"),
        F.array_sort(F.collect_set(F.struct("number", "block"))).alias("parts"),
    )
    count = F.size("parts")
    numbers = F.transform("parts", lambda p: p["number"])
    block = F.array_join(F.transform("parts", lambda p: p["block"].cast("string")), "").cast("binary")  # the bytes as they are
    whole = (numbers == F.sequence(F.lit(1), count)) & (F.octet_length("joined") == F.col("total")) & (F.col("n") % count == 0)
    groups = groups.withColumn("joined", block).withColumn("whole", F.coalesce(whole, F.lit(False)))
    times = F.when(F.col("whole"), F.array_repeat(F.lit(1), (F.col("n") / count).cast("int"))).otherwise(F.array(F.lit(1)))
    groups = groups.select("id", "head.*", F.when(F.col("whole"), F.col("joined")).alias("block"), "whole", F.explode(times).alias("copy"))
    return single.unionByName(groups.drop("copy"))


def decode_chunks(body: bytes) -> bytes | None:
    """The payload of a chunked body; None if the framing is broken. Extensions and trailers are passed over."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            return None
        try:
            size = int(body[at:end].split(b";")[0], 16)
        except ValueError:
            return None
        if size == 0:
            return b"".join(out)
        part = body[end + 2 : end + 2 + size]
        if len(part) < size or body[end + 2 + size : end + 4 + size] != b"\r\n":
            return None
        out.append(part)
        at = end + 4 + size


def http_payload(block: Column) -> Column:
    """The decoded payload of an HTTP response block; null for none, or a broken one."""

    def run(column: pa.Array) -> pa.Array:
        out = []
        for value in texts(column):
            head, found, body = value.partition(b"\r\n\r\n")
            framed = b"transfer-encoding: chunked" in head.lower()
            out.append(None if not found else decode_chunks(body) if framed else body)
        return pa.array(out, pa.binary())

    return F.arrow_udf(run, "binary")(block)


def payloads(records: DataFrame) -> DataFrame:
    """Reassembled records with payload and intact (the digest of the payload is the recorded one); revisits
    have neither."""
    decoded = F.when(F.col("type") == "response", http_payload(F.col("block")))
    rows = reassemble(records).withColumn("payload", decoded).drop("block")
    return rows.withColumn("intact", F.sha1("payload") == F.col("digest"))


def archived_pages(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, intact) of each archived page.

    A revisit's size and integrity are those of the response that it refers to, met by an ordinary join on
    the digest, in which a payload that many pages share is one row on the side of the responses.
    """
    from tidemark.session import materialize

    rows = payloads(read(spark, path)).withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    rows = materialize(rows.select("page_id", "payload_bytes", "digest", "type", "refers_to", "intact"), "warc-pages")
    responses = rows.filter("type = 'response'")
    origin = responses.groupBy(F.col("page_id").alias("refers_to"), "digest").agg(
        F.max("payload_bytes").alias("bytes"), F.max("intact").alias("sound")
    )
    revisits = rows.filter("type = 'revisit'").join(origin, ["refers_to", "digest"], "left")
    revisits = revisits.select(
        "page_id", F.col("bytes").alias("payload_bytes"), "digest", "type", "refers_to", F.col("sound").alias("intact")
    )
    both = responses.unionByName(revisits)
    return both.select(
        "page_id", "payload_bytes", F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"), "refers_to", "intact"
    )


def round_trip(pages: DataFrame) -> DataFrame:
    """Write the pages to archives in the scratch folder and read them back."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write(pages, path)
    return archived_pages(spark, path)
