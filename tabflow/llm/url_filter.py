"""URL filter: explicit host/path rules first, then a tree of path templates per host.

1. ``parts``: host (after the first ``://``, A-Z lowered) and path of a url.
2. ``rule_for``: the longest rule whose host is the url's host or a parent domain of it
   and whose path starts the url's path.
3. Template tree: per host, grown level by level. Under a node (the template so far), a segment with at least
   ``min_support`` pages *under that node* is a branch of its own, however many such siblings it has and however
   large the host; rarer segments are variable and generalise to ``*``. Where labels follow the segments (of the rare
   segments with two or more pages none is labelled in part, and some are labelled and some are not), those without labels
   go to a branch ``*~`` of their own instead, so they take no verdict from labels that are not about them. A
   node with fewer than ``min_support`` pages has no branches below, nor has one ``max_depth`` segments down.
4. Branches of a host that differ in one constant segment are merged when their labelled
   reject rates are statistically alike (each within ``z`` standard errors of the pooled
   rate); branches without labels stay on their own.
5. A template is rejected when its smoothed labelled purity,
   ``(rejected + strength / 2) / (labelled + strength)``, reaches ``purity``: a few rejects
   are not enough, and a template without labels scores one half. A page without a rule
   takes its template's verdict.

Work goes by distinct paths, not pages: pages are counted once per (host, path), the levels regroup those counts (a few
small aggregations and equi-joins on written tables, which Spark can split for a hot host), and one join brings a path's
template and verdict back to its pages.

Defined results: a null url, or one without ``://``, has empty host and path and is allowed;
repeated rows count and are judged each; an empty table gives an empty result; other columns
of the input are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, cut, stored, union_all

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class UrlRule:
    host: str
    path: str
    verdict: str  # allow or block

    @property
    def name(self) -> str:
        return self.host + self.path


# The rules of the contract, as listed.
RULES = (UrlRule("com", "/", "allow"), UrlRule("example.com", "/en/", "block"), UrlRule("www.example.com", "/en/", "allow"),
         UrlRule("net", "/es/", "block"), UrlRule("net", "/fr/", "block"))

MIN_SUPPORT, Z, STRENGTH, PURITY, MAX_DEPTH = 3, 2.0, 2.0, 0.9, 12


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path columns of a url column."""
    at = F.locate("://", url)
    rest = F.substr(url, at + 3)
    ok = F.coalesce(at > 0, F.lit(False))
    host = F.when(ok, F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)).otherwise(F.lit(""))
    path = F.when(ok, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).otherwise(F.lit(""))
    return host, path


def rule_for(host: Column, path: Column, rules: tuple[UrlRule, ...] = RULES) -> Column:
    """The longest fitting rule as ``struct<name, verdict>``, null if none fits. The rule list is a short literal."""
    chosen = F.lit(None).cast("struct<name:string,verdict:string>")
    for r in sorted(rules, key=lambda r: len(r.name)):  # longer rules wrap shorter ones
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        chosen = F.when(fits, F.struct(F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def templates(paths: DataFrame, min_support: int = MIN_SUPPORT, max_depth: int = MAX_DEPTH) -> DataFrame:
    """``paths(host, segments, n, labelled, rejected)`` with each path's ``template``."""
    counts = ["n", "labelled", "rejected"]
    open_ = paths.select("host", "segments", *counts, F.lit("").alias("node"))
    done, depth = [], 0
    while True:
        more = F.size("segments") > depth
        done.append(open_.where(~more))
        open_ = open_.where(more)
        if depth == max_depth:
            rest = F.repeat(F.lit("/*"), F.size("segments") - depth)
            done.append(open_.withColumn("node", F.concat("node", rest)))
            break
        kids = stored(open_.groupBy("host", "node", F.element_at("segments", depth + 1).alias("s")).agg(*[F.sum(c).alias(c) for c in counts]), "url-branches")
        pair = (F.col("n") >= 2) & (F.col("n") < min_support)
        whole, none = F.col("labelled") == F.col("n"), F.col("labelled") == 0
        nodes = kids.groupBy("host", "node").agg(F.sum("n").alias("all"), F.count_if(pair & whole).alias("w"), F.count_if(pair & none).alias("u"),
                                                 F.count_if(pair & ~whole & ~none).alias("m"))
        apart = (F.col("m") == 0) & (F.col("w") > 0) & (F.col("u") > 0)
        name = F.when(F.col("n") >= min_support, F.col("s")).when(apart & none, "*~").otherwise("*")
        named = stored(kids.join(nodes, ["host", "node"]).select("host", "node", "s", name.alias("name"), "all"), "url-names")
        step = open_.withColumn("s", F.element_at("segments", depth + 1)).join(named, ["host", "node", "s"])
        depth += 1
        small = F.col("all") < min_support  # no branch can follow: the rest is variable
        step = step.withColumn("node", F.concat("node", F.lit("/"), "name", F.when(small, F.repeat(F.lit("/*"), F.size("segments") - depth)).otherwise(F.lit(""))))
        step = stored(step.select("host", "segments", *counts, "node", small.alias("small")), "url-level")
        done.append(step.where("small").drop("small"))
        open_ = step.where("not small").drop("small")
        if not open_.where(F.size("segments") > depth).take(1):
            done.append(open_)
            break
    template = F.when(F.col("node") == "", "/").otherwise(F.col("node"))
    return union_all(done).select("host", "segments", *counts, template.alias("template"))


def template_verdicts(counts: DataFrame, z: float = Z, strength: float = STRENGTH, purity: float = PURITY) -> DataFrame:
    """``(host, template, labelled, rejected, score, reject)`` from template counts ``(host, template, n, labelled, rejected)``."""
    counts = cut(counts)
    rate = F.col("rejected") / F.col("labelled")
    names = F.slice(F.split("template", "/"), 2, 1_000_000)
    # one row per constant position: the template with that position opened is the branch point
    point = (counts.where(F.col("labelled") > 0).withColumn("names", names)
             .select("*", F.explode(F.filter(F.sequence(F.lit(1), F.size("names")),
                                             lambda i: F.element_at("names", i) != F.lit("*"))).alias("i"))
             .withColumn("parent", F.array_join(F.transform("names", lambda s, k: F.when(k + 1 == F.col("i"), F.lit("<>")).otherwise(s)), "/")))
    pool = point.groupBy("host", "parent").agg(F.sum("labelled").alias("pl"), F.sum("rejected").alias("pr"),
                                               F.count(F.lit(1)).alias("branches")).where("branches > 1")
    p = F.col("pr") / F.col("pl")
    alike = F.abs(rate - p) <= F.lit(z) * F.sqrt(p * (1 - p) / F.col("labelled"))
    merged = (point.join(pool, ["host", "parent"]).where(alike)
              # the branches that are alike pool their labels; several branch points: the one with most labels
              .groupBy("host", "parent").agg(F.sum("labelled").alias("ml"), F.sum("rejected").alias("mr"),
                                             F.collect_list("template").alias("members"))
              .select("host", "ml", "mr", F.explode("members").alias("template"))
              .groupBy("host", "template").agg(F.max(F.struct("ml", "mr")).alias("m")))
    joined = counts.join(merged, ["host", "template"], "left")
    lab = F.coalesce(F.col("m.ml"), F.col("labelled"))
    rej = F.coalesce(F.col("m.mr"), F.col("rejected"))
    score = (rej + F.lit(strength / 2)) / (lab + F.lit(strength))
    return joined.select("host", "template", lab.alias("labelled"), rej.alias("rejected"), score.alias("score"),
                         (score >= F.lit(purity)).alias("reject"))


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: tuple[UrlRule, ...] = RULES,
          label_col: str | None = None) -> DataFrame:
    """``(page_id, url, host, path, rule, verdict, template, score)`` for every page row.

    Labels of the template tree: ``label_col`` (``allow``/``block``, null unlabelled) if given,
    else the verdicts of the rules.
    """
    host, path = parts(col(url_col))
    label = col(label_col) if label_col else F.lit(None).cast("string")
    base = pages.select(col(id_col).alias("page_id"), col(url_col).alias("url"), host.alias("host"), path.alias("path"),
                        label.alias("label"))
    base = base.withColumn("r", rule_for(F.col("host"), F.col("path"), rules)).withColumn(
        "segments", F.filter(F.split("path", "/"), lambda s: s != F.lit("")))
    if not label_col:
        base = base.withColumn("label", F.col("r.verdict"))
    paths = stored(base.groupBy("host", "segments").agg(
        F.count(F.lit(1)).alias("n"), F.count("label").alias("labelled"), F.count_if(F.col("label") == "block").alias("rejected")), "url-paths")
    placed = stored(templates(paths), "url-templates")
    counts = placed.groupBy("host", "template").agg(*[F.sum(c).alias(c) for c in ("n", "labelled", "rejected")])
    verdicts = stored(template_verdicts(counts).select("host", "template", "score", "reject"), "url-verdicts")
    # one row per distinct path, written, so that Spark knows its size and can split a hot path's pages
    found = stored(placed.select("host", "segments", "template").join(verdicts, ["host", "template"]), "url-judged")
    out = base.join(found, ["host", "segments"], "left")
    by_tree = F.when(F.coalesce("reject", F.lit(False)), "block").otherwise("allow")
    return out.select("page_id", "url", "host", "path", F.col("r.name").alias("rule"),
                      F.coalesce(F.col("r.verdict"), by_tree).alias("verdict"), "template", "score")
