"""The registered queries of the operators: whole tables, production parameters, digest columns of the contracts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, html_text, jaccard_join, mixing, quality, secret_scan, sentence_spans, sharded_kmeans, simhash, sketches, suffix_dedup, token_align, url_filter
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
OPERATORS: dict[str, str] = {}


def query(number: int, sql: str | None = None):
    def deco(fn):
        QUERIES[fn.__name__] = fn
        OPERATORS[fn.__name__] = f"L{number}"
        if sql:
            ORACLE[fn.__name__] = sql
        return fn
    return deco


@query(1)
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of 100-byte strings that start earlier."""
    d = suffix_dedup.deduplicate(table(spark, sf_dir, "documents"))
    return d.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query(2)
def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken from every document by the mixture (sources weigh 5, 2, 1, repeating; 150 % of all words)."""
    out = mixing.mix(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken", "copies")


def _joined(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")


def _count(kind: str) -> Column:
    return F.size(F.filter("found", lambda x: x["kind"] == F.lit(kind))).cast("long")


def _duck_spans(kind: str, ordinal: int, pattern: str, tested: str, min_len: int) -> str:
    """DuckDB list of (s, ord, e, kind) structs of one rule: gaps and matches alternate, as in the operator."""
    p = pattern.replace("'", "''")
    return f"""
      list_transform(list_filter(range(1, len(regexp_extract_all(t, '{p}')) + 1),
          lambda i: length(regexp_extract_all(t, '{p}', {tested})[i]) >= {min_len}),
        lambda i: {{'s': list_sum(list_transform(string_split_regex(t, '{p}')[1:i], lambda x: length(x)))::BIGINT
                        + coalesce(list_sum(list_transform(regexp_extract_all(t, '{p}')[1:i-1], lambda x: length(x))), 0)::BIGINT,
                   'ord': {ordinal},
                   'e': list_sum(list_transform(string_split_regex(t, '{p}')[1:i], lambda x: length(x)))::BIGINT
                        + list_sum(list_transform(regexp_extract_all(t, '{p}')[1:i], lambda x: length(x)))::BIGINT,
                   'kind': '{kind}'}})"""


_PARTS = ", ".join(f"{_duck_spans(r.kind, i, r.pattern, str(r.group), r.min_len)} AS k{i}" for i, r in enumerate(secret_scan.RULES))
_ALL = " || ".join(f"k{i}" for i in range(len(secret_scan.RULES)))
_BASE = " || ".join(f"k{i}" for i, r in enumerate(secret_scan.RULES) if r.base)
_TEXT = "array_to_string(list_transform(list_sort({0}), lambda x: x.kind || ':' || x.s || ':' || x.e), ',')"
OP8_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
     m AS (SELECT doc_id, {_PARTS} FROM d)
SELECT doc_id, len(k0)::BIGINT AS n_assign, len(k1)::BIGINT AS n_access, len(k2)::BIGINT AS n_hex,
       sha256({_TEXT.format(_BASE)}) AS base_sha256, {_TEXT.format(_ALL)} AS spans
FROM m"""


@query(8, OP8_SQL)
def op8_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document through a new blob ledger: counts, digest of the base spans, all spans."""
    ledger = secret_scan.Ledger(spark)
    addressed = secret_scan.scan(table(spark, sf_dir, "documents"), ledger)
    f = secret_scan.findings(addressed, ledger)
    base = [r.kind for r in secret_scan.RULES if r.base]
    base_found = F.filter("found", lambda x: x["kind"].isin(*base))
    return f.select("doc_id", *[_count(k).alias(f"n_{k}") for k in base], F.sha2(_joined(base_found), 256).alias("base_sha256"),
                    _joined(F.col("found")).alias("spans"))


@query(3)
def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page and its length in code points."""
    return html_text.extract(table(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query(4)
def op4_simhash_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate class of every document."""
    c = simhash.classes(table(spark, sf_dir, "documents"))
    return c.select("doc_id", simhash.hex_of(F.col("fp")).alias("fingerprint"), "component_id")


_FITS = " ".join(
    f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN {{'name': '{r.name}', 'verdict': '{r.verdict}'}}"
    for r in sorted(url_filter.RULES, key=lambda r: -len(r.name)))
def _levels_sql() -> str:
    """The tree's levels, one by one: ``o`` open paths, ``k`` branches under each node, ``f`` how a node's rare branches split."""
    u, out = url_filter, []
    out.append("o0 AS MATERIALIZED (SELECT host, segments, count(*) AS n, count(r.verdict) AS l, count(*) FILTER (WHERE r.verdict = 'block') AS r, '' AS node FROM base GROUP BY host, segments)")
    for d in range(u.MAX_DEPTH):
        out.append(f"k{d} AS MATERIALIZED (SELECT host, node, segments[{d + 1}] AS s, sum(n) AS n, sum(l) AS l FROM o{d} WHERE len(segments) > {d} GROUP BY ALL)")
        out.append(f"f{d} AS (SELECT host, node, bool_and(NOT (n >= 2 AND n < {u.MIN_SUPPORT} AND l > 0 AND l < n)) AND bool_or(n >= 2 AND n < {u.MIN_SUPPORT} AND l = n) "
                   f"AND bool_or(n >= 2 AND n < {u.MIN_SUPPORT} AND l = 0) AS apart FROM k{d} GROUP BY host, node)")
        out.append(f"o{d + 1} AS MATERIALIZED (SELECT o.host, o.segments, o.n, o.l, o.r, o.node || '/' || CASE WHEN k.n >= {u.MIN_SUPPORT} THEN k.s WHEN f.apart AND k.l = 0 THEN '*~' ELSE '*' END AS node "
                   f"FROM o{d} o JOIN k{d} k ON o.host = k.host AND o.node = k.node AND o.segments[{d + 1}] = k.s JOIN f{d} f ON o.host = f.host AND o.node = f.node WHERE len(o.segments) > {d})")
    last = " UNION ALL ".join([*(f"SELECT host, segments, node FROM o{d} WHERE len(segments) = {d}" for d in range(u.MAX_DEPTH)),
                               f"SELECT host, segments, node || repeat('/*', (len(segments) - {u.MAX_DEPTH})::INTEGER) FROM o{u.MAX_DEPTH}"])
    return ",\n".join([*out, f"t AS (SELECT host, segments, CASE WHEN node = '' THEN '/' ELSE node END AS template FROM ({last}) x)",
                        "placed AS (SELECT b.*, t.template FROM base b JOIN t ON b.host = t.host AND b.segments = t.segments)"])


OP9_SQL = f"""
WITH u AS (SELECT page_id, coalesce(strpos(url, '://'), 0) AS mark, url FROM pages),
p AS (SELECT page_id,
             CASE WHEN mark > 0 THEN translate(regexp_extract(substr(url, mark + 3), '^([^/?#]*)', 1), '{url_filter.UPPER}', '{url_filter.LOWER}') ELSE '' END AS host,
             CASE WHEN mark > 0 THEN regexp_extract(substr(url, mark + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path FROM u),
base AS (SELECT *, CASE {_FITS} END AS r, list_filter(string_split(path, '/'), lambda x: x <> '') AS segments FROM p),
{_levels_sql()},
counts AS (SELECT host, template, count(r.verdict) AS labelled, count(*) FILTER (WHERE r.verdict = 'block') AS rejected FROM placed GROUP BY host, template),
point AS (SELECT *, array_to_string(list_transform(names, lambda x, k: CASE WHEN k = i THEN '<>' ELSE x END), '/') AS parent FROM
          (SELECT *, string_split(template, '/')[2:] AS names FROM counts WHERE labelled > 0) c, unnest(range(1, len(names) + 1)) AS t(i) WHERE names[i] <> '*'),
pool AS (SELECT host, parent, sum(labelled) AS pl, sum(rejected) AS pr FROM point GROUP BY host, parent HAVING count(*) > 1),
alike AS (SELECT point.* FROM point JOIN pool USING (host, parent) WHERE abs(CAST(rejected AS DOUBLE) / labelled - CAST(pr AS DOUBLE) / pl)
          <= CAST({url_filter.Z} AS DOUBLE) * sqrt((CAST(pr AS DOUBLE) / pl) * (1 - CAST(pr AS DOUBLE) / pl) / labelled)),
pooled AS (SELECT host, parent, sum(labelled) AS ml, sum(rejected) AS mr FROM alike GROUP BY host, parent),
merged AS (SELECT a.host, a.template, max({{'ml': g.ml, 'mr': g.mr}}) AS m FROM alike a JOIN pooled g ON a.host = g.host AND a.parent = g.parent GROUP BY 1, 2),
verdicts AS (SELECT c.host, c.template, (CAST(coalesce(m.mr, rejected) AS DOUBLE) + {url_filter.STRENGTH / 2}::DOUBLE)
                    / (CAST(coalesce(m.ml, labelled) AS DOUBLE) + {url_filter.STRENGTH}::DOUBLE) AS score
             FROM counts c LEFT JOIN merged USING (host, template))
SELECT page_id, host, path, r.name AS rule, coalesce(r.verdict, CASE WHEN score >= CAST({url_filter.PURITY} AS DOUBLE) THEN 'block' ELSE 'allow' END) AS verdict,
       template, score FROM placed JOIN verdicts USING (host, template)"""


@query(9, OP9_SQL)
def op9_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict for every page url: the longest fitting rule's, else its template's."""
    return url_filter.judge(table(spark, sf_dir, "pages")).select(
        "page_id", "host", "path", "rule", "verdict", "template", "score")


@query(5)
def op5_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; labels of fold 0 are never learnt from."""
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.classify(docs, model)


@query(6)
def op6_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item: one row per (document, item)."""
    return decontam.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query(10)
def op10_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the sentences of spans that occur earlier."""
    return sentence_spans.deduplicate(table(spark, sf_dir, "documents"))


@query(7)
def op7_scaled_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text, and their likeness to the document's."""
    d = sketches.with_next(table(spark, sf_dir, "documents")).withColumn(
        "edited", sketches.edited(F.col("text"), F.col("next_text")))
    d = sketches.with_sketch(d, "edited", "edited_sketch")
    return d.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        sketches.encode(F.col("sketch")).alias("fingerprint"), sketches.encode(F.col("edited_sketch")).alias("edited_fingerprint"),
        sketches.alike(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        sketches.alike(F.col("sketch"), F.col("next_sketch")).alias("near_next"))


@query(11)
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment of the two tokenizers' tokens on every document, and how usual its links are in the corpus."""
    files = token_align.load()
    return token_align.score(token_align.align(table(spark, sf_dir, "documents"), files), files)


OP12_SQL = f"""
WITH RECURSIVE w AS (SELECT row_number() OVER () AS rid, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{url_filter.UPPER}', '{url_filter.LOWER}'),
       '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words FROM documents),
s AS MATERIALIZED (SELECT rid, doc_id, list_sort(list_distinct(CASE WHEN len(words) = 0 THEN [] ELSE list_transform(range(1, greatest(len(words) - {jaccard_join.SHINGLE - 1}, 1) + 1),
       lambda i: array_to_string(words[i:i + {jaccard_join.SHINGLE - 1}], ' ')) END)) AS grams FROM w),
reps AS MATERIALIZED (SELECT min(rid) AS rep, grams, len(grams) AS n FROM s WHERE len(grams) > 0 GROUP BY grams),
tok AS MATERIALIZED (SELECT rep, n, unnest(grams) AS t FROM reps),
common AS (SELECT a.rep AS a, b.rep AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS o FROM tok a JOIN tok b ON a.t = b.t AND a.rep < b.rep
           AND 100 * least(a.n, b.n) >= {jaccard_join.PERCENT} * greatest(a.n, b.n) GROUP BY a.rep, b.rep),
link AS MATERIALIZED (SELECT a, b FROM common WHERE 100 * o >= {jaccard_join.PERCENT} * (na + nb - o) UNION SELECT b, a FROM common WHERE 100 * o >= {jaccard_join.PERCENT} * (na + nb - o)),
reach(rep, node) AS (SELECT rep, rep FROM reps UNION SELECT r.rep, l.b FROM reach r JOIN link l ON r.node = l.a),
low AS (SELECT r.grams, min(s.doc_id) AS low, any_value(r.rep) AS rep FROM reps r JOIN s ON s.grams = r.grams GROUP BY r.grams),
comp AS (SELECT reach.rep, min(low.low) AS component_id FROM reach JOIN low ON low.rep = reach.node GROUP BY reach.rep)
SELECT s.doc_id, len(s.grams)::BIGINT AS n_shingles, CASE WHEN len(s.grams) = 0 THEN s.doc_id ELSE c.component_id END AS component_id
FROM s LEFT JOIN low l ON l.grams = s.grams LEFT JOIN comp c ON c.rep = l.rep"""


@query(12, OP12_SQL)
def op12_jaccard_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of shingles and Jaccard class of every document."""
    return jaccard_join.classes(table(spark, sf_dir, "documents"))


def _kmeans_sql() -> str:
    """The rounds unrolled; exact integers (floor division of negatives by hand)."""
    km = sharded_kmeans
    dist = f"list_sum(list_transform(range(1, {km.DIMS} + 1), lambda i: (p.x[i] - c.x[i]) * (p.x[i] - c.x[i])))::BIGINT"
    near = ("SELECT rid, vec_id, x, arg_min(k, {{'d': d, 'k': k}}) AS k, min(d) AS d FROM "
            f"(SELECT p.rid, p.vec_id, p.x, c.k, {dist} AS d FROM p, {{0}} c) GROUP BY ALL")
    ctes = [f"""p AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda e: floor({km.SCALE} * CAST(e AS DOUBLE))::BIGINT) AS x
      FROM embeddings WHERE len(embedding) = {km.DIMS} AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {km.DIMS})""",
            f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id IS NULL, sha256('{km.SEED_TEXT}' || vec_id), x) - 1 AS k, x FROM p
      ORDER BY k LIMIT {km.K})"""]
    for r in range(km.ROUNDS + 1):
        ctes.append(f"a{r} AS MATERIALIZED ({near.format(f'c{r}')})")
        if r < km.ROUNDS:
            ctes.append(f"""m{r} AS (SELECT k, i, sum(x[i])::BIGINT AS s, count(*) AS n FROM a{r}, unnest(range(1, {km.DIMS} + 1)) AS t(i) GROUP BY k, i)""")
            ctes.append(f"""c{r + 1} AS MATERIALIZED (SELECT c.k, coalesce(w.x, c.x) AS x FROM c{r} c LEFT JOIN
      (SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY i) AS x FROM m{r} GROUP BY k) w ON c.k = w.k)""")
    r = km.ROUNDS
    return "WITH " + ",\n".join(ctes) + f"""
SELECT a.vec_id, a.k::INTEGER AS cluster, a.d AS distance, (sum(a.d) OVER (PARTITION BY a.k))::BIGINT AS cluster_inertia,
       (sum(a.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256 FROM a{r} a JOIN c{r} c ON a.k = c.k"""


@query(13, _kmeans_sql())
def op13_sharded_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster and exact squared distance of every usable vector after the Lloyd rounds."""
    return sharded_kmeans.with_inertia(*sharded_kmeans.cluster(table(spark, sf_dir, "embeddings")))
