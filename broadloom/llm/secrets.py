"""Secret scans with an incremental ledger of content-addressed blobs.

Every version of a text is a path; its content is a blob, addressed by SHA-256.
The ledger records which (blob, rule set version) pairs were scanned and what was
found. A scan reads only the pairs that the ledger lacks, each blob once however
many paths hold it, and joins the findings back to all paths.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadloom.llm.common import sized_join, stored
from broadloom.session import free_names

#: Base kinds in their fixed order, then the kinds that this method adds.
BASE = ("assign", "access", "hex")
ADDED = ("bearer", "pem", "jwt")
KINDS = (*BASE, *ADDED)

_ANY_CASE = lambda words: "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in words)
RULES = {
    "assign": re.compile(
        "(" + _ANY_CASE(["password", "passwd", "secret", "token"]) + "|" + _ANY_CASE(["api"]) + "_?" + _ANY_CASE(["key"]) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    ),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]{24,}"),
    "bearer": re.compile(r"\b[Bb]earer\x20+[A-Za-z0-9._~+/-]{16,}=*"),
    # header lines and body of any length; neither goes on over five hyphens, so a text is read once
    "pem": re.compile(r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----(?:\s*+[A-Za-z-]++:(?:(?!-----)[^\r\n])*+)*+[A-Za-z0-9+/=\s]*+-----END [A-Z0-9 ]*PRIVATE KEY-----"),
    "jwt": re.compile(r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
}
KEEPS = {"assign": lambda m: len(m.group(2)) >= 6, "access": lambda m: m.end() - m.start() >= 20}
#: Changes with the rules, so that a changed rule set scans every blob anew.
RULES_VERSION = hashlib.sha256("\n".join(f"{k} {r.pattern}" for k, r in RULES.items()).encode()).hexdigest()[:16]

_SPAN = "array<struct<kind:string,start:int,end:int>>"
LEDGER = f"blob string, rules string, spans {_SPAN}"
_ARROW = pa.schema({"blob": pa.string(), "rules": pa.string(), "spans": pa.list_(pa.struct({"kind": pa.string(), "start": pa.int32(), "end": pa.int32()}))})


def find_secrets(text: str) -> list[dict]:
    """Spans of all kinds, leftmost and non-overlapping in each kind, by start and kind; ends exclusive, in code points."""
    spans = []
    for order, (kind, rule) in enumerate(RULES.items()):
        keep = KEEPS.get(kind)
        spans += [(m.start(), order, m.end(), kind) for m in rule.finditer(text) if keep is None or keep(m)]
    return [{"kind": kind, "start": start, "end": end} for start, _, end, kind in sorted(spans)]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = [find_secrets(t.as_py()) for t in batch.column("text")]
        yield pa.RecordBatch.from_pydict({"blob": batch.column("blob"), "rules": [RULES_VERSION] * len(spans), "spans": spans}, schema=_ARROW)


def _paths(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.sha2(text, 256).alias("blob"), text.alias("text"))


def scan_unseen(docs: DataFrame, ledger: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The ledger entries to append: one for each blob that the ledger lacks under these rules.

    Of the paths of a blob only the one of smallest id (null ids first) is read by
    the rules. Which rows those are is found from digests alone; the texts are
    joined with the rows to leave out where these are counted as few, else by shuffle.
    """
    paths = _paths(docs, id_col, text_col)
    ids = stored(paths.select("doc_id", "blob"))
    repeated = ids.groupBy("blob").agg(F.min(F.struct("doc_id")).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("blob", "first")
    skip = sized_join(ids, stored(repeated), ["blob"], "inner").filter(~F.col("doc_id").eqNullSafe(F.col("first.doc_id"))).select("doc_id", "blob")
    if ledger is not None:
        seen = ledger.filter(F.col("rules") == RULES_VERSION).select("blob")
        skip = skip.unionByName(ids.join(seen, "blob", "left_semi"))
    tagged = lambda df: df.withColumn("id_tag", F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    unseen = sized_join(tagged(paths), stored(tagged(skip).select("id_tag", "blob").distinct()), ["id_tag", "blob"], "left_anti")
    return unseen.select("blob", "text").mapInArrow(_scan, LEDGER).dropDuplicates(["blob"])


def secret_scan(docs: DataFrame, ledger: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(findings of every path, the ledger after this scan).

    Findings: doc_id, blob, spans, for every input row, rows without secrets too
    (empty spans). Null text is the empty blob. Repeated rows are paths of one
    blob. With an empty table both results hold no new rows. Other columns are not read.
    """
    new = stored(scan_unseen(docs, ledger, id_col, text_col))
    after = new if ledger is None else ledger.unionByName(new)
    found = stored(after.filter((F.col("rules") == RULES_VERSION) & (F.size("spans") > 0)).select("blob", "spans"))
    paths = _paths(docs, id_col, text_col).select("doc_id", "blob")
    findings = sized_join(paths, found, ["blob"], "left").withColumn("spans", F.coalesce("spans", F.array().cast(_SPAN)))
    return findings.select("doc_id", "blob", "spans"), after


def _joined(spans) -> F.Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with every secret span replaced by ``[SECRET]``; n_chars follows where it exists.

    Overlapping spans are replaced as one. Rows without findings, null and empty texts
    pass unchanged; repeated rows each come out; an empty table stays empty. Other
    columns, of whatever names, are kept as they are.
    """
    kept, schema = docs.columns, docs.schema
    blob, spans, made = free_names(docs, "blob", "spans", "made")
    ledger = stored(scan_unseen(docs))
    hit = stored(ledger.filter(F.size("spans") > 0).select(F.col("blob").alias(blob), F.col("spans").alias(spans)))
    with_spans = sized_join(docs.withColumn(blob, F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)), hit, [blob], "left")
    parts = F.aggregate(
        F.col(spans),
        F.struct(F.lit("").alias("done"), F.lit(0).alias("at")),
        lambda acc, s: F.struct(
            F.when(s["start"] >= acc["at"], F.concat(acc["done"], F.substring(F.col("text"), acc["at"] + 1, s["start"] - acc["at"]), F.lit("[SECRET]"))).otherwise(acc["done"]).alias("done"),
            F.greatest(acc["at"], s["end"]).alias("at"),
        ),
    )
    clean = F.when(F.col(spans).isNull(), F.col("text")).otherwise(F.concat(F.col(f"{made}.done"), F.substring(F.col("text"), F.col(f"{made}.at") + 1, F.length("text"))))
    out = with_spans.withColumn(made, F.when(F.col(spans).isNotNull(), parts)).withColumn("text", clean)
    if "n_chars" in kept:
        out = out.withColumn("n_chars", F.when(F.col(spans).isNull(), F.col("n_chars")).otherwise(F.length("text").cast(schema["n_chars"].dataType)))
    return out.select(*kept)


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in the whole documents table, from an empty ledger."""
    findings, _ = secret_scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return findings.select("doc_id", *[of(k).alias(f"n_{k}") for k in BASE], F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


SQL: dict[str, str] = {}
