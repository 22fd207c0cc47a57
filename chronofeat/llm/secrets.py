"""Secret scans with an incremental ledger of blobs.

Every version of every path is content-addressed (SHA-256 of its text).  The
ledger is a Parquet table of ``(blob, rule, version)`` with the spans found.
Only blobs that lack a rule at its present version are scanned, once each and
for the lacking rules only; findings are then joined back to all paths.
Everything runs in built-in functions: ``regexp_extract_all`` gives the
matches, ``split`` the gaps between them, and running sums of both lengths
give the places in code points.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import List, Optional, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import let, materialise, own_names_aside, text_or_empty


@dataclass(frozen=True)
class SecretRule:
    """A rule: matches of ``pattern`` (leftmost, non-overlapping) whose
    ``group`` holds at least ``min_length`` code points.  Change ``version``
    with the pattern, so that blobs are scanned anew for this rule."""
    kind: str
    pattern: str
    group: int = 0
    min_length: int = 1
    version: int = 1
    base: bool = False


#: A private key in PEM form: from its BEGIN mark to the END mark of that label, if that is the next mark; else to the
#: end of the base64 lines (of 24 characters or more, and a shorter last one) that follow, and the mark alone if none
#: do.  Line ends may be written as \\n, as in JSON.  Loops are possessive: no backtracking, no recursion in Java.
_PEM_GAP = r"(?:\s|\\[nr])++"
_PEM = (r"-----BEGIN ([A-Z ]{0,40})PRIVATE KEY-----(?:(?:[^-]|-(?!----))*+-----END \1PRIVATE KEY-----"
        rf"|(?:{_PEM_GAP}(?:Proc-Type|DEK-Info):\x20?[^\s\\]++)*+(?:{_PEM_GAP}[A-Za-z0-9+/=]{{24,}}+)++"
        rf"(?:{_PEM_GAP}(?:[A-Za-z0-9+/=]++(?![^\r\n\\])|(?=[A-Za-z]*+[0-9+/=])[A-Za-z0-9+/=]++(?!\S)))?+)?+")

#: A run of at least 16 (18) characters is the same match as a run of any length that is dropped below that.
RULES = (
    SecretRule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
               group=2, min_length=12, base=True),
    SecretRule("access", r"AKIA[A-Z0-9]{14,}", min_length=18, base=True),
    SecretRule("hex", r"[0-9a-f]{16,}", min_length=16, base=True),
    SecretRule("pem", _PEM, version=3),
    SecretRule("hub", r"gh[pousr]_[A-Za-z0-9]{36,}", min_length=40),
)

_SPANS = "array<struct<start:int,rank:int,kind:string,end:int>>"
_HITS = "array<struct<rank:int,nth:int,len:int,gap:int,ok:boolean>>"
_LEDGER = f"blob string, kind string, version int, spans {_SPANS}"


def _read_ledger(spark, path: str) -> DataFrame:
    try:
        return spark.read.schema(_LEDGER).parquet(path)
    except AnalysisException:              # no ledger there yet
        types = [c.split(" ", 1) for c in ("blob string", "kind string", "version int", f"spans {_SPANS}")]
        return spark.range(0).select(*[F.lit(None).cast(t).alias(c) for c, t in types])


def _hit_rows(matches: Column, values: Column, gaps: Column, rank: int, min_length: int) -> Column:
    """A struct for every match: its place in the list, length, gap before it, and whether it is long enough."""
    return let(values, lambda v: let(gaps, lambda g: F.transform(matches, lambda x, i: F.struct(
        F.lit(rank).alias("rank"), i.alias("nth"), F.length(x).alias("len"), F.get(g, i).alias("gap"),
        (F.length(F.get(v, i)) >= min_length).alias("ok")))))


def _scan(blobs: DataFrame, rules: Sequence[SecretRule]) -> DataFrame:
    """``(blob, kind, spans)`` of the blobs that have any; ``blobs`` has
    ``blob, text, lacking`` (kinds to look for)."""
    parts: List[DataFrame] = []
    look = blobs
    for r in rules:
        look = look.withColumn(f"__cf_{r.kind}", F.when(
            F.array_contains("lacking", r.kind), F.regexp_extract_all("text", F.lit(r.pattern), F.lit(0))))
    hit = [F.col(f"__cf_{r.kind}") for r in rules]
    found = look.where(" or ".join(f"size(__cf_{r.kind}) > 0" for r in rules))
    entries = []
    for rank, (r, m) in enumerate(zip(rules, hit)):
        value = F.regexp_extract_all("text", F.lit(r.pattern), F.lit(r.group)) if r.group else m
        gaps = F.transform(F.split("text", r.pattern), lambda x: F.length(x))
        hits = _hit_rows(m, value, gaps, rank, r.min_length)
        entries.append(F.when(F.size(m) > 0, hits).otherwise(F.array().cast(_HITS)))
    rows = found.select("blob", F.explode(F.concat(*entries)).alias("e")).select("blob", "e.*") \
        .dropDuplicates(["blob", "rank", "nth"])     # a version that is listed twice
    order = Window.partitionBy("blob", "rank").orderBy("nth")
    end = F.sum(F.col("gap") + F.col("len")).over(order).cast("int")
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    spans = rows.withColumn("end", end).where("ok").select(
        "blob", F.get(kinds, F.col("rank")).alias("kind"),
        F.struct((F.col("end") - F.col("len")).alias("start"), F.col("rank"),
                 F.get(kinds, F.col("rank")).alias("kind"), F.col("end")).alias("span"))
    return spans.groupBy("blob", "kind").agg(F.sort_array(F.collect_list("span")).alias("spans"))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 rules: Sequence[SecretRule] = RULES, ledger: Optional[str] = None) -> DataFrame:
    """One row per input row: ``doc_id, blob, spans`` (array of start, rank,
    kind, end; by start, then by the rules' order; code points, end exclusive).

    ``ledger`` is the path of the ledger, created at first use and appended to
    by every call; without one a fresh ledger in the shared folder is used.

    Defined cases: null text counts as empty; rows with a null or repeated id
    are paths like any other; an empty table gives an empty result; other
    columns are not looked at.  Two calls on one ledger must not overlap."""
    spark = docs.sparkSession
    ledger = ledger or scratch_path(spark, "secret-ledger")
    text = text_or_empty(text_col)
    blob = F.sha2(text.cast("binary"), 256)
    paths = materialise(docs.select(F.col(id_col).alias("doc_id"), blob.alias("blob")), "blob-paths")
    # a handful of literal rows
    wanted = spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules])))
    seen = _read_ledger(spark, ledger).join(F.broadcast(wanted), ["kind", "version"]) \
        .groupBy("blob").agg(F.collect_set("kind").alias("seen"))
    lacking = F.array_except(F.array(*[F.lit(r.kind) for r in rules]), F.coalesce("seen", F.array().cast("array<string>")))
    pending = paths.groupBy("blob").agg(F.min("doc_id").alias("rep_id")).join(seen, "blob", "left") \
        .select("blob", "rep_id", lacking.alias("lacking")).where(F.size("lacking") > 0)
    pending = materialise(pending, "blob-pending")
    texts = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), blob.alias("blob"))
    p = pending.withColumnRenamed("blob", "p_blob")
    unseen = texts.join(p, (F.col("blob") == F.col("p_blob")) & F.col("doc_id").eqNullSafe(F.col("rep_id"))) \
        .select("blob", "text", "lacking")
    found = _scan(unseen, rules)
    entries = pending.select("blob", F.explode("lacking").alias("kind")).join(found, ["blob", "kind"], "left") \
        .join(F.broadcast(wanted), "kind") \
        .select("blob", "kind", "version", F.coalesce("spans", F.array().cast(_SPANS)).alias("spans"))
    entries.write.mode("append").parquet(ledger)
    known = _read_ledger(spark, ledger).join(F.broadcast(wanted), ["kind", "version"]) \
        .where(F.size("spans") > 0) \
        .groupBy("blob").agg(F.sort_array(F.flatten(F.collect_list("spans"))).alias("spans"))
    # written first, so both sides of the join are plain exchanges and Spark can split a blob with many paths
    return paths.join(materialise(known, "blob-findings"), "blob", "left") \
        .select("doc_id", "blob", F.coalesce("spans", F.array().cast(_SPANS)).alias("spans"))


def spans_text(spans, kinds: Optional[Sequence[str]] = None):
    """``kind:start:end`` of the spans, comma-joined; of ``kinds`` only if given."""
    s = spans if kinds is None else F.filter(spans, lambda e: e["kind"].isin(*kinds))
    return F.array_join(F.transform(s, lambda e: F.concat_ws(
        ":", e["kind"], e["start"].cast("string"), e["end"].cast("string"))), ",")


def redact(text, spans, mark: str = "[REDACTED]"):
    """``text`` with every stretch covered by spans replaced by one ``mark``."""
    def step(acc, e):
        new = e["start"] >= acc["at"]
        return F.struct(
            F.when(new, F.concat(acc["out"], F.substring(text, acc["at"] + 1, e["start"] - acc["at"]), F.lit(mark)))
            .otherwise(acc["out"]).alias("out"), F.greatest(acc["at"], e["end"]).alias("at"))
    return F.aggregate(spans, F.struct(F.lit("").alias("out"), F.lit(0).alias("at")), step,
                       lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))


@own_names_aside
def redact_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: Optional[str] = "n_chars",
                   rules: Sequence[SecretRule] = RULES, ledger: Optional[str] = None) -> DataFrame:
    """``docs`` with each secret replaced by ``[REDACTED]``; every row stays, in
    its own columns.  ``length_col``, where the table has it, follows the new
    text of a changed row.  Rows that repeat id and text are redacted alike; a
    null text stays null."""
    found = scan_secrets(docs, id_col, text_col, rules, ledger).where(F.size("spans") > 0) \
        .select(F.col("doc_id").alias("__cf_id"), F.col("blob").alias("__cf_blob"), F.col("spans").alias("__cf_spans")) \
        .dropDuplicates(["__cf_id", "__cf_blob"])
    blob = F.sha2(text_or_empty(text_col).cast("binary"), 256)
    rows = docs.withColumn("__cf_key", blob)
    rows = rows.join(found, F.col(id_col).eqNullSafe(F.col("__cf_id")) & (F.col("__cf_key") == F.col("__cf_blob")), "left")
    clean = F.when(F.col("__cf_spans").isNull(), F.col(text_col)).otherwise(redact(F.col(text_col), F.col("__cf_spans")))
    changed = rows.withColumn("__cf_clean", clean)
    out = []
    for c in docs.columns:
        if c == text_col:
            out.append(F.col("__cf_clean").alias(c))
        elif c == length_col:
            out.append(F.when(F.col("__cf_spans").isNull(), F.col(c)).otherwise(
                F.length("__cf_clean")).cast(docs.schema[c].dataType).alias(c))
        else:
            out.append(F.col(c))
    return changed.select(*out)
