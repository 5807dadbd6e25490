"""WARC archives of web captures and their assembly into one row per capture.

Each page is written as three records of one transaction: the response (or,
for a payload already archived, a revisit that refers to it), the request and
a metadata record; the latter two name the response in WARC-Concurrent-To.
Spark's text writer makes the archives: a row holds the three records and the
line separator is the blank double line that ends a WARC record. Reading
follows Content-Length, so payloads may hold any text, record headers too.

Record ids are derived from the capture (page id, URL, payload digest), so a
retried task writes the same records. Captures equal in all of these share
their ids; assembly counts their response records and returns as many rows.

Edge cases: a NULL payload is empty; payloads under ``least_shared`` bytes
never become revisits; of equal payloads the smallest page id is the response
(NULL ids come last); a NULL URL leaves the header out, line breaks in a URL
are percent-escaped; an empty table writes no records and reads as no rows;
other columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortium.llm.common import shared_path, stored

LEAST_SHARED = 100
ARCHIVE_BYTES = 8 << 20
WARC_DATE = "2020-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = "\r\n"
RECORD_END = CRLF * 2

RECORDS = ("record_type string, record_id string, concurrent_to string, target_uri string, refers_to string, "
           "page_id long, payload_bytes long, payload_digest string, payload string, fields map<string,string>")
NAMES = [f.split()[0] for f in RECORDS.split(", ")]


def _urn(kind: str, *key: Column) -> Column:
    h = F.md5(F.concat_ws("|", F.lit(kind), *(F.coalesce(k.cast("string"), F.lit("\0")) for k in key)))
    return F.concat(F.lit("<urn:uuid:"), *(x for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
                                          for x in ([F.lit("-")] if a > 1 else []) + [F.substring(h, a, n)]), F.lit(">"))


def _record(headers: list[tuple[str, Column | str]], block: Column) -> Column:
    """Headers with a NULL value are left out; Content-Length counts bytes."""
    lines = [F.concat(F.lit(f"{name}: "), v if isinstance(v, Column) else F.lit(v), F.lit(CRLF)) for name, v in headers]
    lines = [F.coalesce(x, F.lit("")) for x in lines]
    return F.concat(F.lit("WARC/1.1" + CRLF), *lines, F.lit("Content-Length: "),
                    F.octet_length(block).cast("string"), F.lit(RECORD_END), block)


def transactions(pages: DataFrame, least_shared: int = LEAST_SHARED) -> DataFrame:
    """One row per page: ``value`` holds its three records, ``size`` their bytes."""
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    base = base.withColumns({"digest": F.sha2(F.col("html"), 256), "size": F.octet_length("html")})
    # the first capture of each repeated payload; (is null, id, url) orders them
    own = F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "url")
    firsts = (base.where(F.col("size") >= least_shared).groupBy("digest")
              .agg(F.min(own).alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first"))
    # stored: a join straight above the aggregate on its key could not be split, and one payload may be a third of all
    x = base.join(stored(firsts, "first-captures"), "digest", "left")
    uri = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    key = (F.col("page_id"), F.col("url"), F.col("digest"))
    rid = _urn("response", *key)
    revisit = F.col("first").isNotNull() & ~(F.col("first.page_id").eqNullSafe(F.col("page_id")))
    http = F.concat(F.lit("HTTP/1.1 200 OK" + CRLF + "Content-Type: text/html; charset=utf-8" + CRLF + "Content-Length: "),
                    F.col("size").cast("string"), F.lit(RECORD_END))
    digest = F.concat(F.lit("sha256:"), F.col("digest"))
    common = [("WARC-Date", WARC_DATE), ("WARC-Target-URI", uri)]
    http_type = ("Content-Type", "application/http; msgtype=response")
    response = _record([("WARC-Type", "response"), ("WARC-Record-ID", rid), *common, ("WARC-Payload-Digest", digest),
                        http_type], F.concat(http, F.col("html")))
    again = _record([("WARC-Type", "revisit"), ("WARC-Record-ID", rid), *common, ("WARC-Payload-Digest", digest),
                     ("WARC-Profile", REVISIT_PROFILE),
                     ("WARC-Refers-To", _urn("response", F.col("first.page_id"), F.col("first.url"), F.col("digest"))),
                     http_type], http)
    request = _record([("WARC-Type", "request"), ("WARC-Record-ID", _urn("request", *key)), ("WARC-Concurrent-To", rid),
                       *common, ("Content-Type", "application/http; msgtype=request")],
                      F.concat(F.lit("GET "), F.coalesce(uri, F.lit("/")), F.lit(" HTTP/1.1" + RECORD_END)))
    metadata = _record([("WARC-Type", "metadata"), ("WARC-Record-ID", _urn("metadata", *key)), ("WARC-Concurrent-To", rid),
                        *common, ("Content-Type", "application/warc-fields")],
                       F.coalesce(F.concat(F.lit("page_id: "), F.col("page_id").cast("string"), F.lit(CRLF)), F.lit("")))
    value = F.concat_ws(RECORD_END, request, F.when(revisit, again).otherwise(response), metadata)
    return x.select(value.alias("value"), "size")


def write_archives(pages: DataFrame, path: str, least_shared: int = LEAST_SHARED, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Gzipped archives of about ``archive_bytes`` each (before compression)."""
    mean = pages.agg(F.avg(F.octet_length(F.col("html").cast("string")))).head()[0] or 0
    records = max(1, int(archive_bytes // (mean + 2048)))
    (transactions(pages, least_shared).select("value").write.option("lineSep", RECORD_END).option("compression", "gzip")
     .option("maxRecordsPerFile", records).text(path))


def parse_records(content: bytes):
    """(headers, block) of each record of one archive, by Content-Length."""
    at = 0
    while at < len(content):
        if not content.startswith(b"WARC/1.", at):
            raise ValueError(f"no record at byte {at}")
        end = content.index(b"\r\n\r\n", at)
        headers = {}
        for line in content[at:end].decode("utf-8").split(CRLF)[1:]:
            name, _, v = line.partition(": ")
            headers[name.lower()] = v
        size = int(headers["content-length"])
        yield headers, content[end + 4:end + 4 + size]
        at = end + 4 + size
        while content.startswith(b"\r\n", at):
            at += 2


def _row(headers: dict, block: bytes, with_payload: bool) -> tuple:
    kind = headers["warc-type"]
    size = digest = payload = page = None
    if kind in ("response", "revisit"):
        head, _, body = block.partition(b"\r\n\r\n")
        size = int(re.search(rb"(?im)^content-length: (\d+)", head)[1])
        digest = headers["warc-payload-digest"].removeprefix("sha256:")
        if kind == "response":
            if size != len(body) or digest != hashlib.sha256(body).hexdigest():
                raise ValueError(f"payload of {headers['warc-record-id']} differs from its digest")
            payload = body.decode("utf-8") if with_payload else None
    elif kind == "metadata" and (m := re.search(rb"page_id: (-?\d+)", block)):
        page = int(m[1])
    return (kind, headers["warc-record-id"], headers.get("warc-concurrent-to"), headers.get("warc-target-uri"),
            headers.get("warc-refers-to"), page, size, digest, payload, list(headers.items()))


def _read(with_payload: bool):
    def run(batches):
        kinds = [pa.string()] * 5 + [pa.int64()] * 2 + [pa.string()] * 2 + [pa.map_(pa.string(), pa.string())]
        for b in batches:
            for content in b.column("content"):
                rows = [_row(h, x, with_payload) for h, x in parse_records(gzip.decompress(content.as_py()))]
                for i in range(0, len(rows), 2000):
                    cols = zip(*rows[i:i + 2000])
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=NAMES)
    return run


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row per record of all archives below ``path``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(_read(with_payload), RECORDS)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``request``, ``response`` (a response or
    revisit record) and ``metadata``, joined through their concurrent-to ids;
    ``refers_to_page`` is the page whose payload a revisit repeats."""
    kept = F.struct("record_type", "record_id", "target_uri", "refers_to", "payload_bytes", "payload_digest", "payload")
    kind = F.col("record_type")
    main = kind.isin("response", "revisit")
    captures = (records.groupBy(F.coalesce("concurrent_to", "record_id").alias("capture_id"))
                .agg(F.first(F.when(main, kept), True).alias("response"),
                     F.max(F.when(kind == "request", F.struct("record_id", "target_uri"))).alias("request"),
                     F.max(F.when(kind == "metadata", F.struct("record_id", "page_id"))).alias("metadata"),
                     F.count(F.when(main, 1)).cast("int").alias("copies"))
                .where("copies > 0"))
    captures = (captures.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
                .drop("_copy", "copies"))
    # the pages that revisits may name; stored, so that a payload with many revisits can be split
    first_pages = stored(captures.where(F.col("response.record_type") == "response")
                         .select(F.col("capture_id").alias("_first"), F.col("metadata.page_id").alias("_page"))
                         .dropDuplicates(["_first"]), "warc-pages")
    # a response refers to nothing: its own id spreads those rows and its own page is not reported
    refers = F.coalesce("response.refers_to", "capture_id")
    joined = captures.join(first_pages, refers == F.col("_first"), "left")
    page = F.when(F.col("response.refers_to").isNotNull(), F.col("_page"))
    return joined.withColumn("refers_to_page", page).drop("_first", "_page")


def archive_and_assemble(pages: DataFrame, with_payload: bool = True, path: str | None = None) -> DataFrame:
    spark = pages.sparkSession
    path = path or shared_path(spark, "warc")
    write_archives(pages, path)
    return assemble(read_archives(spark, path, with_payload))
