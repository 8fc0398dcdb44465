"""WARC archives: writing with revisit records, and reading by verified record boundaries."""

from __future__ import annotations

import base64
import gzip
import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstile.llm.columns import in_bytes, text_or_empty
from turnstile.llm.staging import fresh_path, staged

MAGIC = b"WARC/1.0\r\n"
CLOSE = "\r\n\r\n"
FILE_BYTES = 8 << 20
_DATE = "2000-01-01T00:00:00Z"  # archives of the same pages are equal byte for byte
_URL_BREAK = r"[\x00-\x20\x7F]"


def _digests(pages: DataFrame) -> DataFrame:
    """page_id, url, html and payload_digest: bare base32 of the SHA-1 of the UTF-8 html."""

    def run(batches):
        for batch in batches:
            sums = [base64.b32encode(hashlib.sha1(v or b"").digest()).decode() for v in in_bytes(batch.column(2))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sums, pa.string())], names=["page_id", "url", "html", "payload_digest"])

    return pages.mapInArrow(run, "page_id long, url string, html string, payload_digest string")


def write_archives(pages: DataFrame, path: str, least: int = 0, page: str = "page_id", url: str = "url", html: str = "html", file_bytes: int = FILE_BYTES) -> None:
    """One record a page under path, in gzip files of about file_bytes, unpacked, at the pages' mean size.

    Of pages with equal payloads of at least `least` bytes, the one with the largest id is a
    response and the others are revisits that refer to it; smaller payloads are all responses.
    Rows that repeat the largest id are responses too. A null id comes below all; a group of
    null ids only is all responses. Null html: empty payload. A url's blanks and control
    characters are percent-encoded; a null url is left out. Spark's text writer puts the two line
    ends that close a record after each, so a record is one row of text and a failed task's
    file never shows.
    """
    clean = pages.select(F.col(page).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), text_or_empty(html).alias("html"))
    named = _digests(clean)
    groups = _digests(clean).groupBy("payload_digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("_n"))
    largest = groups.filter("_n > 1").drop("_n")  # payloads that stand alone need no partner
    size = F.octet_length("html")
    joined = named.join(largest, "payload_digest", "left")
    again = (size >= least) & F.col("refers_to").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers_to"))
    end = "\r\n"
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{end}Content-Type: text/html; charset=utf-8{end}Content-Length: "), size.cast("string"), F.lit(CLOSE))
    block = F.when(again, http).otherwise(F.concat(http, "html"))
    shown = F.regexp_replace("url", _URL_BREAK, "%20")
    number = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("none"))
    record = F.concat(
        F.lit(f"WARC/1.0{end}WARC-Type: "),
        F.when(again, "revisit").otherwise("response"),
        F.lit(f"{end}WARC-Record-ID: <urn:page:"),
        number("page_id"),
        F.lit(f">{end}WARC-Date: {_DATE}{end}"),
        F.when(F.col("url").isNotNull(), F.concat(F.lit("WARC-Target-URI: "), shown, F.lit(end))).otherwise(""),
        F.lit("WARC-Payload-Digest: sha1:"),
        F.col("payload_digest"),
        F.when(
            again,
            F.concat(
                F.lit(f"{end}WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest{end}WARC-Refers-To: <urn:page:"),
                number("refers_to"),
                F.lit(">"),
            ),
        ).otherwise(""),
        F.lit(f"{end}Content-Type: application/http; msgtype=response{end}Content-Length: "),
        F.octet_length(block).cast("string"),
        F.lit(CLOSE),
        block,
    )
    every = clean.agg(F.sum(size), F.count("*")).first()
    per_file = max(1, file_bytes * every[1] // max(every[0] or 0, 1))
    joined.select(record.alias("value")).write.option("lineSep", CLOSE).option("maxRecordsPerFile", per_file).option("compression", "gzip").text(path)


_LENGTH = re.compile(rb"\r\ncontent-length:[ \t]*(\d+)[ \t]*\r\n", re.IGNORECASE)


def candidates(content: bytes) -> list[tuple[int, int, int, int]]:
    """(offset, successor, block start, block end) wherever the magic stands in an archive and headers
    with a length follow; also inside payloads."""
    out = []
    at = content.find(MAGIC)
    while at >= 0:
        head_end = content.find(b"\r\n\r\n", at)
        length = _LENGTH.search(content, at, head_end + 2) if head_end >= 0 else None
        if length:
            block = head_end + 4
            end = block + int(length[1])
            if end + 4 <= len(content) and content[end : end + 4] == b"\r\n\r\n":
                out.append((at, end + 4, block, end))
        at = content.find(MAGIC, at + 1)
    return out


def _unpacked(content: bytes) -> bytes:
    return gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)


_FIELDS = "path string, offset long, successor long, block long, block_end long, page_id long, url string, record_type string, payload_digest string, refers_to long, payload_bytes long, payload_intact boolean"
_KINDS = [pa.string(), *[pa.int64()] * 5, pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.bool_()]


def record_candidates(spark: SparkSession, path: str) -> DataFrame:
    """Candidate records of the archives under path: path, offset, successor, block and block_end, and what
    headers and payload say: page_id, url, record_type, payload_digest, refers_to, payload_bytes and
    payload_intact (whether the payload has the digest its header names), the last two of a
    response only."""

    def run(batches):
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1), strict=True):
                data = _unpacked(content.as_buffer().to_pybytes())
                out = []
                for offset, successor, block, end in candidates(data):
                    head = _headers(data[offset : block - 4])
                    digest = head.get("warc-payload-digest", "").removeprefix("sha1:")
                    size = intact = None
                    if head.get("warc-type") == "response":
                        payload = _payload(data, block, end)
                        size, intact = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode() == digest
                    named = (_page(head.get("warc-record-id")), head.get("warc-target-uri"), head.get("warc-type"), digest, _page(head.get("warc-refers-to")))
                    out.append((name.as_py(), offset, successor, block, end, *named, size, intact))
                columns = list(zip(*out, strict=True)) or [[]] * len(_KINDS)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _KINDS, strict=True)], names=[f.split()[0] for f in _FIELDS.split(", ")])

    return _files(spark, path).select("path", "content").mapInArrow(run, _FIELDS)


def reachable(found: DataFrame) -> DataFrame:
    """The candidates that a chain of successors reaches from the start of their file.

    Pointer jumping: after k rounds a candidate's jump leads 2**k records on, and the reached set
    holds the first 2**k records of each file; so the rounds are the logarithm of the most
    candidates in a file. Magic inside a payload is the successor of no reached record.
    """
    found = staged(found, "candidates")
    places = found.select("path", "offset", "successor")
    most = found.groupBy("path").count().agg(F.max("count")).first()[0] or 0
    jumps = places.select("path", "offset", F.col("successor").alias("to"))
    reached = places.filter("offset = 0").select("path", "offset")
    span = 1
    while span < most:
        onward = reached.join(jumps, ["path", "offset"]).select("path", F.col("to").alias("offset"))
        onward = onward.join(places.select("path", "offset"), ["path", "offset"], "left_semi")
        reached = reached.union(onward)
        further = jumps.select("path", F.col("offset").alias("to"), F.col("to").alias("beyond"))
        jumps = jumps.join(further, ["path", "to"]).select("path", "offset", F.col("beyond").alias("to"))
        reached, jumps = staged(reached, "reached"), staged(jumps, "jumps")
        span *= 2
    return found.join(reached, ["path", "offset"], "left_semi")


def _headers(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:]) if k}


def _payload(data: bytes, block: int, end: int) -> bytes:
    """What follows the HTTP headers of a block."""
    return data[block:end].partition(b"\r\n\r\n")[2]


def _page(text: str | None) -> int | None:
    number = re.fullmatch(r"<urn:page:(-?\d+)>", text or "")
    return int(number[1]) if number else None


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records on the verified chain of their archive, as record_candidates() gives them."""
    return reachable(record_candidates(spark, path))


def read_payloads(spark: SparkSession, records: DataFrame, path: str) -> DataFrame:
    """(page_id, payload) of the responses among records: each archive, of bounded size as it was written,
    meets the list of its records."""
    lists = records.filter("record_type = 'response'").groupBy("path").agg(F.sort_array(F.collect_list(F.struct("block", "block_end", "page_id"))).alias("records"))

    def run(batches):
        for batch in batches:
            for content, places in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                data = _unpacked(content.as_buffer().to_pybytes())
                payloads = [_payload(data, p["block"], p["block_end"]) for p in places]
                yield pa.RecordBatch.from_arrays([pa.array([p["page_id"] for p in places], pa.int64()), pa.array(payloads, pa.binary())], names=["page_id", "payload"])

    return _files(spark, path).select("path", "content").join(lists, "path").select("content", "records").mapInArrow(run, "page_id long, payload binary")


def archived(pages: DataFrame, least: int = 0) -> DataFrame:
    """Write pages to fresh archives in the shared folder, read them back, and give each page's
    payload_bytes and payload_digest; a revisit has them from the response it refers to."""
    spark = pages.sparkSession
    path = fresh_path(spark, "warc")
    write_archives(pages, path, least)
    records = read_archives(spark, path).drop("path", "offset", "successor", "block", "block_end")
    records = staged(records, "records")
    sizes = records.filter("record_type = 'response'").groupBy(F.col("page_id").alias("refers_to")).agg(F.max("payload_bytes").alias("_bytes"))
    whole = records.join(sizes, "refers_to", "left")
    return whole.withColumn("payload_bytes", F.coalesce("payload_bytes", "_bytes")).drop("_bytes")
