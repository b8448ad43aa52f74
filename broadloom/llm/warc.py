"""WARC archives: written and read by Spark, with transactions assembled by joins.

Every page becomes three records: a request, a response (or, for a payload that
an earlier page holds, a revisit) and metadata; request and metadata name the
first by WARC-Concurrent-To. Archives are written by Spark's text writer with
the record end as the line separator, so they go to any file system Spark
writes to. Reading parses records by Content-Length and joins the three records
of a capture into one nested row.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadloom.llm.common import shared_folder, sized_join, stored

END = "\r\n"
#: Payloads of fewer bytes are always stored again.
REVISIT_BYTES = 100
#: Bytes of payload in an archive file: about so many on average, and never more than the most, as a file is read as one value.
FILE_BYTES, MOST_BYTES = 64 << 20, 1 << 30
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def _urn(*parts: F.Column) -> F.Column:
    h = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts]))
    return F.concat(F.lit("<urn:uuid:"), *[x for i, (a, n) in enumerate([(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]) for x in ([F.lit("-")] if i else []) + [F.substring(h, a, n)]], F.lit(">"))


def _record(kind: str | F.Column, record_id: F.Column, block: F.Column, content_type: str, *more: tuple[str, F.Column]) -> F.Column:
    """Header, empty line and block of one record; a field whose value is null is left out."""
    field = lambda name, value: F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(END)))
    kind = F.lit(kind) if isinstance(kind, str) else kind
    fields = [("WARC-Type", kind), ("WARC-Record-ID", record_id), ("WARC-Date", F.lit("2024-01-01T00:00:00Z")), *more, ("Content-Type", F.lit(content_type)), ("Content-Length", F.octet_length(block))]
    return F.concat(F.lit("WARC/1.1" + END), *[F.coalesce(field(n, v), F.lit("")) for n, v in fields], F.lit(END), block)


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """Writes the archives of ``pages`` as gzip files under ``folder``.

    Null html is an empty payload, a null url leaves the target out, control
    characters of a url are percent-encoded. Of pages with equal payloads of at
    least REVISIT_BYTES, those of the smallest id are responses, the others
    (null ids too) revisits without payload. Which ids those are is found from
    digests; pages are joined with the smallest ids of repeated payloads alone.
    """
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), html.alias("html"), F.sha2(html, 256).alias("digest"))
    long = rows.filter(F.octet_length("html") >= REVISIT_BYTES).groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    firsts = stored(long.filter("n > 1 AND first_id IS NOT NULL").select("digest", "first_id"))
    rows = sized_join(rows, firsts, ["digest"], "left").withColumn("mid", F.monotonically_increasing_id())
    revisit = F.coalesce(F.coalesce(F.col("page_id") > F.col("first_id"), F.lit(True)) & F.col("first_id").isNotNull(), F.lit(False))
    safe = F.col("url")
    for code in [*range(33), 127]:
        safe = F.replace(safe, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    main = _urn(F.lit("main"), F.col("page_id"), F.col("digest"), F.col("mid"))
    target, to, digest = ("WARC-Target-URI", safe), ("WARC-Concurrent-To", main), ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest")))
    path = F.coalesce(F.regexp_replace(safe, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", ""), F.lit("/"))
    request = _record("request", _urn(F.lit("request"), F.col("page_id"), F.col("digest"), F.col("mid")), F.concat(F.lit("GET "), path, F.lit(" HTTP/1.1\r\n\r\n")), "application/http; msgtype=request", target, to)
    profile = ("WARC-Profile", F.when(revisit, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")))
    response = _record(F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")), main, F.concat(F.lit(_HTTP), F.when(revisit, F.lit("")).otherwise(F.col("html"))), "application/http; msgtype=response", target, digest, profile)
    facts = F.concat(F.coalesce(F.concat(F.lit("pageId: "), F.col("page_id").cast("string"), F.lit(END)), F.lit("")), F.lit("payloadBytes: "), F.octet_length("html").cast("string"), F.lit(END))
    metadata = _record("metadata", _urn(F.lit("metadata"), F.col("page_id"), F.col("digest"), F.col("mid")), facts, "application/warc-fields", target, to)
    records = rows.select(F.explode(F.array(request, response, metadata)).alias("value"))
    records.write.option("lineSep", END + END).option("compression", "gzip").option("maxRecordsPerFile", file_records(pages, html_col)).text(folder)


def file_records(pages: DataFrame, html_col: str = "html") -> int:
    """Records in an archive file, three for a page, by the mean and the greatest payload of ``pages``."""
    size = F.coalesce(F.octet_length(html_col), F.lit(0)) + 1024
    mean, most = pages.agg(F.avg(size), F.max(size)).first()
    return 3 * max(1, int(min(FILE_BYTES / (mean or 1024), MOST_BYTES / (most or 1024))))


_RECORDS = "record_id string, type string, concurrent_to string, target_uri string, digest string, payload_bytes long, payload_sha256 string, page_id long, stated_bytes long"
_ARROW = pa.schema([(n, pa.int64() if t == "long" else pa.string()) for n, t in (x.split() for x in _RECORDS.split(", "))])


def parse_records(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record of a WARC stream; a cut-off record is an error."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        fields = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8").partition(":")
            fields[name.strip()] = value.strip()
        size = int(fields["Content-Length"])
        block = stream.read(size)
        if len(block) != size:
            raise ValueError("a WARC record is cut off")
        yield fields, block


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column("content"):
            rows: list[dict] = []
            raw = io.BytesIO(content.as_py())
            for fields, block in parse_records(io.BufferedReader(gzip.GzipFile(fileobj=raw))):
                row = dict.fromkeys(_ARROW.names)
                row |= {"record_id": fields["WARC-Record-ID"], "type": fields["WARC-Type"], "concurrent_to": fields.get("WARC-Concurrent-To"), "target_uri": fields.get("WARC-Target-URI"), "digest": fields.get("WARC-Payload-Digest")}
                if row["type"] in ("response", "revisit"):
                    payload = block.partition(b"\r\n\r\n")[2]
                    row |= {"payload_bytes": len(payload), "payload_sha256": hashlib.sha256(payload).hexdigest()}
                elif row["type"] == "metadata":
                    facts = dict(x.split(": ", 1) for x in block.decode("utf-8").split(END) if x)
                    row |= {"page_id": int(facts["pageId"]) if "pageId" in facts else None, "stated_bytes": int(facts["payloadBytes"])}
                rows.append(row)
                if len(rows) == 1000:
                    yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)
                    rows = []
            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record of the archives under ``folder``; payloads as their length and SHA-256."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return files.select("content").mapInArrow(_read, _RECORDS)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: structs ``response``, ``request`` and ``metadata`` (null where absent).

    Request and metadata are joined to the response or revisit that they were
    concurrent to. Records whose response is missing are not captures.
    """
    of = lambda kind, *cols: records.filter(F.col("type") == kind).select(F.col("concurrent_to").alias("record_id"), F.struct("record_id", *cols).alias(kind))
    main = records.filter(F.col("type").isin("response", "revisit")).select("record_id", F.struct("record_id", "type", "target_uri", "digest", "payload_bytes", "payload_sha256").alias("response"))
    return main.join(of("request", "target_uri"), "record_id", "left").join(of("metadata", "page_id", "stated_bytes"), "record_id", "left").drop("record_id")


def captures(spark: SparkSession, folder: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every capture in the archives.

    A response's payload is measured as read; a revisit takes both figures from the
    response of its digest, which it refers to.
    """
    nested = stored(assemble(stored(read_records(spark, folder))))
    flat = nested.select(F.col("metadata.page_id").alias("page_id"), F.col("response.type").alias("record_type"), F.col("response.payload_bytes").alias("bytes"), F.col("response.payload_sha256").alias("sha"), F.substring_index("response.digest", ":", -1).alias("digest"))
    wanted = flat.filter("record_type = 'revisit'").select("digest").distinct()
    heads = flat.filter("record_type = 'response'").join(wanted, "digest", "left_semi").groupBy("digest").agg(F.min("page_id").alias("head_id"), F.first("bytes").alias("head_bytes"), F.first("sha").alias("head_sha"))
    again = F.col("record_type") == "revisit"
    return sized_join(flat, stored(heads), ["digest"], "left").select(
        "page_id",
        F.when(again, F.col("head_bytes")).otherwise(F.col("bytes")).alias("payload_bytes"),
        F.when(again, F.col("head_sha")).otherwise(F.col("sha")).alias("payload_digest"),
        "record_type",
        F.when(again, F.col("head_id")).alias("refers_to"),
    )


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of the whole pages table, written to the shared folder and read back."""
    folder = shared_folder(spark)
    write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    return captures(spark, folder)


SQL = {
    "op8_warc": """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
q AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha256(payload) AS payload_digest FROM p),
r AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS head FROM q)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> head THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> head THEN head END AS refers_to
FROM r
"""
}
