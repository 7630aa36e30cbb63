"""WARC archives: written from a table of pages, read back, and assembled into one nested row a capture.

Each page becomes three records of one transaction: a request, a response (or a revisit) and a metadata record. The
request and the metadata name the response by WARC-Concurrent-To; assembly joins the three through these identifiers.

Of pages with equal payloads of at least ``revisit_from`` bytes the one with the largest id is the response and the
others revisit it (WARC-Refers-To); smaller ones are all responses. Payloads are equal when their SHA-256 is.

Spark's own writer and reader move the bytes, so archives can be in any store that Spark reaches; records are UTF-8, a
record's end is the writer's line separator, and an archive is one gzip stream (Spark's writer makes no member a record). Archives hold about ARCHIVE_BYTES before compression, and never more than
MOST_BYTES plus a page; pages of more than LARGE bytes have archives of their own, so that they make no others short.

Cases: a null payload is empty; a null url leaves out the header and comes back as null; control characters and spaces
in urls are percent-encoded; a null id leaves out its field and comes back as null (it is never referred to, as ids come
after nulls); rows that repeat id and payload are captures of their own; an empty table gives an empty archive and no
captures. Further columns are not read and may have any name. Ids are whole numbers.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import HOT_PARTS, fresh_path, written

ARCHIVE_BYTES, MOST_BYTES, LARGE = 64 << 20, 1 << 30, 1 << 20
DATE = "2024-01-01T00:00:00Z"
RECORD = "record_id string, type string, concurrent_to string, refers_to string, target string, digest string, http_length long, payload binary, page_id string, block_bytes long"
_SCHEMA = pa.schema([("record_id", pa.string()), ("type", pa.string()), ("concurrent_to", pa.string()), ("refers_to", pa.string()), ("target", pa.string()), ("digest", pa.string()), ("http_length", pa.int64()), ("payload", pa.binary()), ("page_id", pa.string()), ("block_bytes", pa.int64())])


def _urn(kind: str, *parts: Column) -> Column:
    """A record id by rule, so that a record can be named before it is written."""
    h = F.md5(F.concat_ws("|", F.lit(kind), *parts))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _safe(url: Column) -> Column:
    out = url
    for code in [*range(0x21), 0x7F]:
        out = F.replace(out, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return F.when(url.rlike(r"[\x00-\x20\x7F]"), out).otherwise(url)


def _record(kind: Column, record_id: Column, target: Column, more: list[Column], content_type: str, block: Column) -> Column:
    line = lambda name, value: F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))).otherwise(F.lit(""))
    head = [F.lit("WARC/1.1\r\n"), line("WARC-Type", kind), line("WARC-Record-ID", record_id), line("WARC-Date", F.lit(DATE)), line("WARC-Target-URI", target), *more]
    return F.concat(*head, F.lit(f"Content-Type: {content_type}\r\nContent-Length: "), F.octet_length(block).cast("string"), F.lit("\r\n\r\n"), block)


def write_archives(pages: DataFrame, revisit_from: int = 1000, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> str:
    """Writes the archives below the shared folder and returns their path."""
    spark = pages.sparkSession
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), _safe(F.col(url_col).cast("string")).alias("url"), html.alias("html"))
    rows = rows.withColumns({"n": F.octet_length("html").cast("long"), "sha": F.sha2(F.encode("html", "UTF-8"), 256)})
    keys = written(rows.select("id", "n", "sha"), "payloads")
    groups = written(keys.where(F.col("n") >= revisit_from).groupBy("sha").agg(F.max("id").alias("ref"), F.count(F.lit(1)).alias("m")).where("m > 1"), "payload-groups")
    # payloads of hot groups, HOT_PARTS groups at most, learn their response from a broadcast and stay where they are; the
    # others' key is their digest, and that of rows that need no more is their own, so that no key gathers many payloads
    least = (groups.agg(F.sum("m")).first()[0] or 0) / HOT_PARTS
    hot = groups.where(F.col("m") > least).select("sha", F.col("ref").alias("hot_ref"))
    rows = rows.join(F.broadcast(hot), "sha", "left")
    alone = F.concat_ws("|", F.lit("alone"), "sha", F.col("id").cast("string"))
    rows = rows.withColumn("key", F.when(F.col("hot_ref").isNull(), F.col("sha")).otherwise(alone))
    cold = groups.where(F.col("m") <= least).select(F.col("sha").alias("key"), F.col("ref").alias("cold_ref"))
    rows = rows.join(cold, "key", "left").withColumn("ref", F.coalesce("hot_ref", "cold_ref")).drop("key", "hot_ref", "cold_ref")
    copy = F.lit(0)
    if not keys.groupBy("id", "sha").count().where("count > 1").isEmpty():
        rows = rows.withColumn("copy", F.row_number().over(W.partitionBy("id", "sha").orderBy("url")) - 1)
        copy = F.col("copy")

    revisit = F.col("ref").isNotNull() & ~F.col("id").eqNullSafe(F.col("ref"))
    key = [F.coalesce(F.col("id").cast("string"), F.lit("")), F.col("sha"), copy.cast("string")]
    response = _urn("response", *key)
    refers = F.when(revisit, _urn("response", F.col("ref").cast("string"), F.col("sha"), F.lit("0")))
    line = lambda name, value: F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))).otherwise(F.lit(""))
    sha1 = F.concat(F.lit("sha1:"), F.sha1(F.encode("html", "UTF-8")))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("n").cast("string"), F.lit("\r\n\r\n"))
    profile = F.when(revisit, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
    together = line("WARC-Concurrent-To", response)
    path_of = F.coalesce(F.regexp_extract("url", r"^[^:]*://[^/?#]*([^#]*)", 1), F.lit(""))
    records = F.array(
        _record(F.lit("request"), _urn("request", *key), F.col("url"), [together], "application/http; msgtype=request", F.concat(F.lit("GET "), F.when(path_of == "", "/").otherwise(path_of), F.lit(" HTTP/1.1\r\n\r\n"))),
        _record(
            F.when(revisit, "revisit").otherwise("response"), response, F.col("url"), [line("WARC-Refers-To", refers), line("WARC-Profile", profile), line("WARC-Payload-Digest", sha1)],
            "application/http; msgtype=response", F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("html"))),
        ),
        _record(F.lit("metadata"), _urn("metadata", *key), F.col("url"), [together], "application/warc-fields", F.concat(line("page-id", F.col("id").cast("string")), F.lit("fetchTimeMs: 0\r\n"))),
    )
    path, large = fresh_path(spark, "warc"), F.col("n") > LARGE
    for group in keys.groupBy(large.alias("large")).agg(F.avg("n").alias("mean"), F.max("n").alias("most")).collect():  # two rows at most
        per_file = max(1, min(ARCHIVE_BYTES // (int(group["mean"]) + 2000), MOST_BYTES // (group["most"] + 2000))) * 3
        some = rows.where(large if group["large"] else ~large).select(F.explode(records).alias("value"))
        some.write.mode("append").option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", per_file).text(path)
    if keys.isEmpty():
        rows.select(F.explode(records).alias("value")).write.option("compression", "gzip").text(path)
    return path


def parsed(stream: io.BufferedIOBase) -> Iterator[dict]:
    """The records of one archive, one after another; lengths, never separators, say where a block ends."""
    while True:
        first = stream.readline()
        if not first:
            return
        if not first.strip():
            continue
        if not first.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {first[:40]!r}")
        head: dict[str, str] = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8").rstrip("\r\n").partition(": ")
            head[name.lower()] = value
        length = int(head["content-length"])
        block = stream.read(length)
        if len(block) != length:
            raise ValueError("an archive ends within a record")
        kind = head["warc-type"]
        out = {"record_id": head["warc-record-id"], "type": kind, "concurrent_to": head.get("warc-concurrent-to"), "refers_to": head.get("warc-refers-to"), "target": head.get("warc-target-uri"), "block_bytes": length}
        if kind in ("response", "revisit"):
            http, _, payload = block.partition(b"\r\n\r\n")
            fields = dict(x.split(": ", 1) for x in http.decode("latin-1").split("\r\n")[1:])
            out["http_length"] = int(fields["Content-Length"])
            out["digest"] = head["warc-payload-digest"].partition(":")[2].lower()
            if kind == "response":
                if len(payload) != out["http_length"] or hashlib.sha1(payload).hexdigest() != out["digest"]:
                    raise ValueError(f"the payload of {out['record_id']} is not the one that was written")
                out["payload"] = payload
        elif kind == "metadata":
            out["page_id"] = dict(x.split(": ", 1) for x in block.decode("utf-8").split("\r\n") if x).get("page-id")
        yield out


def _batches(contents: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in contents:
        for content in batch.column(0):
            data = pa.BufferReader(content.as_buffer())
            rows, size = [], 0
            for row in parsed(io.BufferedReader(gzip.GzipFile(fileobj=data))):
                rows.append(row)
                size += row["block_bytes"]
                if size > 4 << 20:
                    yield pa.RecordBatch.from_pylist(rows, _SCHEMA)
                    rows, size = [], 0
            yield pa.RecordBatch.from_pylist(rows, _SCHEMA)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives below a path."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(_batches, RECORD)


def captures(records: DataFrame) -> DataFrame:
    """One nested row a transaction: the response or revisit with what names it in WARC-Concurrent-To."""
    records = written(records, "warc-records")
    responses = records.where(F.col("type").isin("response", "revisit")).select(
        F.col("record_id").alias("id"), F.struct("record_id", "type", "refers_to", "target", "digest", "http_length", "payload").alias("response")
    )
    requests = records.where("type = 'request'").select(F.col("concurrent_to").alias("id"), F.struct("record_id", "target", "block_bytes").alias("request"))
    metadata = records.where("type = 'metadata'").select(F.col("concurrent_to").alias("id"), F.struct("record_id", F.col("page_id").cast("long").alias("page_id")).alias("metadata"))
    return responses.join(requests, "id", "left").join(metadata, "id", "left").drop("id")


def archived(pages: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every page, from its archives."""
    rows = captures(read_archives(pages.sparkSession, write_archives(pages)))
    named = rows.select(F.col("response.record_id").alias("id"), "metadata.page_id", "response.type", "response.refers_to", "response.digest", "response.http_length", "request.record_id")
    named = written(named, "captures")
    target = named.where("type = 'response'").select(F.col("id").alias("refers_to"), F.col("page_id").alias("refers_to_page")).dropDuplicates(["refers_to"])
    return named.join(target, "refers_to", "left").select(
        "page_id", F.col("http_length").alias("payload_bytes"), F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"), F.col("refers_to_page").alias("refers_to")
    )
