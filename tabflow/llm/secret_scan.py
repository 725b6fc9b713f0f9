"""Secret scans over an incremental blob ledger (DataFrame and SQL functions only).

Every historical version of a path is content-addressed (SHA-256 of its text). A
ledger remembers which (blob, rule version) pairs were scanned and what they
contain; a scan reads only the unseen pairs (one representative row per blob),
adds them to the ledger, and joins the findings back to every path holding the
blob. A second scan of the same versions scans nothing; a new rule version scans
every blob for that rule only.

A rule is a pattern whose matches (leftmost, non-overlapping) count when a
condition holds on the match. Spans are code point offsets, end exclusive: the
text between matches (``split``) and the matches (``regexp_extract_all``) alternate,
so running sums of their lengths are the offsets.

Defined results: null text is the empty text; equal texts (any number of copies)
are one blob; repeated rows each get their findings; an empty table gives an empty
result and an empty ledger; other columns of the input are not read.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import col, cut, fresh, text_of, union_all


@dataclass(frozen=True)
class Rule:
    """``kind``, ``version`` (raise it when the rule changes), ``pattern``, smallest length of group ``group``;
    ``hint`` is a cheaper pattern every text with a match also has; ``base`` marks the contract's kinds."""

    kind: str
    version: int
    pattern: str
    min_len: int
    group: int = 0
    base: bool = False
    hint: str | None = None


# The base kinds in their listed order, then the added ones.
RULES = (
    Rule("assign", 1, r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         8, 2, True, r"(?i:passw|secret|token|api_?key)"),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 16, 0, True, r"AKIA"),
    Rule("hex", 1, r"[0-9a-f]{32,}", 32, 0, True),
    # with its body: to the END line, else over the base64 lines that follow (64 hold any usual key)
    Rule("private_key", 2, r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:[A-Za-z0-9+/=\x20\x09-\x0D]*-----END [A-Z ]*PRIVATE KEY-----"
         r"|(?:[\x20\x09-\x0D]*[A-Za-z0-9+/=]{8,}){0,64})", 1, 0, False, r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 1, 0, False),
)


def spans(text: Column, rule: Rule) -> Column:
    """``array<struct<s:long, e:long>>``: the rule's matches in ``text`` that meet its condition."""
    pieces = F.split(text, rule.pattern, -1)
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    tested = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else found
    # (gap before, match, tested part) per match; a fold keeps the running end
    steps = F.zip_with(
        F.slice(pieces, F.lit(1), F.size(found)),
        F.arrays_zip(found.alias("m"), tested.alias("t")),
        lambda gap, x: F.struct(F.length(gap).cast("long").alias("gap"), F.length(x["m"]).cast("long").alias("len"),
                                F.length(x["t"]).cast("long").alias("ok")))
    empty = F.array().cast("array<struct<s:bigint,e:bigint,ok:bigint>>")
    folded = F.aggregate(
        steps, F.struct(F.lit(0).cast("long").alias("at"), empty.alias("out")),
        lambda acc, x: F.struct(
            (acc["at"] + x["gap"] + x["len"]).alias("at"),
            F.concat(acc["out"], F.array(F.struct((acc["at"] + x["gap"]).alias("s"),
                                                  (acc["at"] + x["gap"] + x["len"]).alias("e"),
                                                  x["ok"].alias("ok")))).alias("out")))["out"]
    kept = F.transform(F.filter(folded, lambda x: x["ok"] >= F.lit(rule.min_len)),
                       lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e")))
    # most texts have no match: the fold runs only where a (cheap) search says so
    none = F.array().cast("array<struct<s:bigint,e:bigint>>")
    return F.when(text.rlike(rule.hint or rule.pattern), kept).otherwise(none)


def blobs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(doc_id, blob)``: the content address of every version."""
    return docs.select(col(id_col).alias("doc_id"), F.sha2(text_of(text_col), 256).alias("blob"))


class Ledger:
    """The scanned (blob, kind, version) pairs and their findings, as Parquet under a shared folder.

    Each scan writes one folder named after the scan, so a retried scan (same ``scan_id``) rewrites only
    its own folder. Two scans of the same blobs at once both write their pairs; findings count equal
    entries once. ``path`` defaults to a new folder under the session's checkpoint folder; pass a lasting
    one to scan incrementally across runs.
    """

    SCHEMA = "blob string, kind string, version int, spans array<struct<s:bigint,e:bigint>>"

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark = spark
        self.path = path or scratch_path(spark, f"blob-ledger-{uuid.uuid4().hex}")
        self._empty = path is None

    def read(self) -> DataFrame:
        """Every entry written; a pair that two scans wrote is there twice."""
        if self._empty or not self._exists():
            return self.spark.createDataFrame([], self.SCHEMA)
        return self.spark.read.schema(self.SCHEMA + ", scan string").parquet(self.path).drop("scan")

    def append(self, entries: DataFrame, scan_id: str | None = None) -> None:
        """Write one scan's entries; writing a ``scan_id`` again replaces them."""
        entries.select("blob", "kind", "version", "spans").write.mode("overwrite").parquet(f"{self.path}/scan={scan_id or uuid.uuid4().hex}")
        self._empty = False

    def _exists(self) -> bool:
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(self.path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def scan(docs: DataFrame, ledger: Ledger, id_col: str = "doc_id", text_col: str = "text",
         rules: tuple[Rule, ...] = RULES, scan_id: str | None = None) -> DataFrame:
    """Scan the unseen (blob, rule version) pairs of ``docs`` into ``ledger``; returns ``(doc_id, blob)`` of every row.

    The unseen blobs are found on addresses alone; only one row per unseen blob
    reaches the patterns.
    """
    addressed = cut(blobs(docs, id_col, text_col))
    wanted = addressed.select("blob").distinct()
    known = ledger.read().select("blob", "kind", "version").distinct()
    todo = []
    for r in rules:
        seen = known.where((F.col("kind") == r.kind) & (F.col("version") == r.version)).select("blob")
        todo.append(wanted.join(seen, "blob", "left_anti").select("blob", F.lit(r.kind).alias("kind")))
    # one row per unseen blob with the kinds still to run on it
    need = union_all(todo).groupBy("blob").agg(F.collect_set("kind").alias("kinds"))
    # the representative of a blob: the same text whichever row it comes from
    texts = docs.select(F.sha2(text_of(text_col), 256).alias("blob"), text_of(text_col).alias("text"))
    one = _one_per_blob(texts)
    work = one.join(need, "blob")
    found = F.array(*[
        F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"), spans(F.col("text"), r).alias("spans"))
        for r in rules])
    entries = (work.select("blob", "kinds", F.explode(found).alias("f"))
               .where(F.array_contains("kinds", F.col("f.kind"))).select("blob", "f.kind", "f.version", "f.spans"))
    ledger.append(entries, scan_id)
    return addressed


def _one_per_blob(texts: DataFrame) -> DataFrame:
    """One (blob, text) row per content address; copies are merged map-side before any shuffle."""
    return texts.groupBy("blob").agg(F.any_value("text").alias("text"))


def findings(addressed: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``(doc_id, blob, found array<struct<kind, ord, s, e>>)``: the ledger joined back to every path."""
    order = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(i))])
    versions = union_all([addressed.sparkSession.range(1).select(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"))
                          for r in rules])
    per_blob = (ledger.read().join(F.broadcast(versions), ["kind", "version"])  # one row per rule
                .where(F.size("spans") > 0)
                # a set: equal entries of two scans are one
                .groupBy("blob").agg(F.array_sort(F.flatten(F.collect_set(F.transform(
                    "spans", lambda x: F.struct(x["s"].alias("s"), order[F.col("kind")].alias("ord"),
                                                x["e"].alias("e"), F.col("kind").alias("kind")))))).alias("found")))
    none = F.array().cast("array<struct<s:bigint,ord:int,e:bigint,kind:string>>")
    return addressed.join(per_blob, "blob", "left").withColumn("found", F.coalesce("found", none))


def mask(text: Column, found: Column, token: str = "[secret]") -> Column:
    """``text`` with every found span replaced by ``token`` (overlapping spans are masked once)."""
    state = F.aggregate(
        found, F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out")),
        lambda acc, x: F.when(x["e"] <= acc["at"], acc).when(
            x["s"] < acc["at"], F.struct(x["e"].alias("at"), acc["out"].alias("out"))).otherwise(
            F.struct(x["e"].alias("at"),
                     F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), (x["s"] - acc["at"]).cast("int")),
                              F.lit(token)).alias("out"))))
    return F.when(F.size(found) == 0, text).otherwise(
        F.concat(state["out"], F.substring(text, (state["at"] + 1).cast("int"), F.length(text))))


def redact(docs: DataFrame, ledger: Ledger, id_col: str = "doc_id", text_col: str = "text",
           rules: tuple[Rule, ...] = RULES, length_col: str | None = None) -> DataFrame:
    """``docs`` with secrets masked in the text; rows without findings are unchanged (null text stays null).

    ``length_col``, if the table has it, gets the new length of a masked text.
    """
    scan(docs, ledger, id_col, text_col, rules)
    blob, found = fresh(docs, "blob"), fresh(docs, "found")
    addressed = docs.withColumn(blob, F.sha2(text_of(text_col), 256))
    per_blob = (findings(ledger.read().select("blob").distinct(), ledger, rules).where(F.size("found") > 0)
                .select(F.col("blob").alias(blob), F.col("found").alias(found)))
    none = F.array().cast("array<struct<s:bigint,ord:int,e:bigint,kind:string>>")
    joined = addressed.join(per_blob, blob, "left").withColumn(found, F.coalesce(col(found), none))
    clean = F.size(col(found)) == 0
    out = joined.withColumn(text_col, F.when(clean, col(text_col)).otherwise(mask(col(text_col), col(found))))
    if length_col in docs.columns:
        new = F.length(col(text_col)).cast(docs.schema[length_col].dataType)
        out = out.withColumn(length_col, F.when(clean, col(length_col)).otherwise(new))
    return out.select(*[col(c) for c in docs.columns])
