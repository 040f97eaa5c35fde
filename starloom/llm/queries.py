"""The queries of this subpackage: each applies an operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.centroids import CLUSTERS, DIMENSIONS, ROUNDS, cluster_vectors, with_centroid_sha
from starloom.llm.common import UPPER, table
from starloom.llm.decontam import decontaminate
from starloom.llm.exact_dedup import exact_duplicates
from starloom.llm.hard_negatives import hard_negatives
from starloom.llm.language_id import identify
from starloom.llm.license_scan import scan_licenses
from starloom.llm.packing import pack
from starloom.llm.quality_rules import score_quality
from starloom.llm.sharding import consistent_shards
from starloom.llm.simhash import near_duplicates
from starloom.llm.substrings import remove_repeats
from starloom.llm.token_counts import VOCABULARY, count_tokens, load_pieces
from starloom.llm.url_filter import BLOCK_GLOBS, SITE_RULES, filter_urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_FOLD = f"translate(coalesce({{}}, ''), '{UPPER}', '{UPPER.lower()}')"


def query(key: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[key] = fn
        if sql:
            ORACLES[key] = " ".join(sql.split())
        return fn

    return wrap


@query(
    "op1_exact_dedup",
    f"""
    WITH k AS (SELECT doc_id, sha256({_FOLD.format('text')}) AS text_sha256 FROM documents),
    g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM k GROUP BY text_sha256)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, k.text_sha256 FROM k JOIN g ON k.text_sha256 = g.text_sha256
    """,
)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


@query("op2_simhash_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)


@query("op3_sharding")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows law: the bounds leave no slack, so the counts of shards differ by one at most."""
    return consistent_shards(table(spark, sf_dir, "documents"), 40, slack=0.0).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "home_shard", "moved"
    )


@query("op4_token_counts")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), load_pieces(VOCABULARY))


@query("op5_best_fit_packing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


@query("op6_language_id")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents")).select("row.doc_id", "held_out", "lang_pred", "score", "phrase_chars")


@query("op7_license_scan")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def _rule_sql() -> tuple[str, str]:
    """CASE expressions for the longest site rule and its verdict."""
    rules = sorted(SITE_RULES, key=lambda r: -len(r[1] + r[2]))
    fits = {(h, p): f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')" for _, h, p in rules}
    rule = " ".join(f"WHEN {fits[h, p]} THEN '{h}{p}'" for _, h, p in rules)
    verdict = " ".join(f"WHEN {fits[h, p]} THEN '{v}'" for v, h, p in rules)
    return f"CASE {rule} END", f"CASE {verdict} END"


def _glob_sql(glob: str) -> str:
    """A glob as an anchored pattern of the SQL engine."""
    out, i = "", 0
    while i < len(glob):
        two = glob[i : i + 2] == "**"
        out += ".*" if two else {"*": "[^/]*", "?": "[^/]"}.get(glob[i], "\\" + glob[i] if not glob[i].isalnum() else glob[i])
        i += 2 if two else 1
    return f"WHEN regexp_full_match(full_url, '(?s){out}') THEN '{glob}'"


@query(
    "op8_url_filter",
    f"""
    WITH a AS (SELECT page_id, {_FOLD.format("regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1)")} AS host,
      regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
    b AS (SELECT *, '.' || host || path AS full_url, {_rule_sql()[0]} AS rule, {_rule_sql()[1]} AS said FROM a),
    c AS (SELECT *, CASE {" ".join(map(_glob_sql, BLOCK_GLOBS))} END AS own_rule FROM b)
    SELECT page_id, host, path, rule, coalesce(said, CASE WHEN own_rule IS NULL THEN 'allow' ELSE 'block' END) AS verdict, own_rule FROM c
    """,
)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"))


_WORDS = f"regexp_extract_all({_FOLD.format('text')}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


@query(
    "op9_benchmark_decontamination",
    f"""
    WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
    i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
    iw AS (SELECT item_id, p, least(len(w), 10) AS n, array_to_string(w[p:p + least(len(w), 10) - 1], ' ') AS k
      FROM i, unnest(range(1, greatest(len(w) - 9, least(len(w), 1)) + 1)) t(p)),
    dw AS (SELECT doc_id, p, n, array_to_string(w[p:p + n - 1], ' ') AS k FROM d, (SELECT DISTINCT n FROM iw) s, unnest(range(1, len(w) - n + 2)) t(p)),
    h AS (SELECT doc_id, dw.p AS p, item_id, iw.p AS q, n FROM dw JOIN iw USING (k, n)),
    g AS (SELECT doc_id, count(DISTINCT p + x) AS n_hit FROM h, unnest(range(0, n)) t(x) GROUP BY doc_id),
    r AS (SELECT doc_id, n, p - row_number() OVER (PARTITION BY doc_id, item_id, p - q ORDER BY p) AS run, item_id, p - q AS diagonal FROM h),
    m AS (SELECT doc_id, max(length) AS longest FROM (SELECT doc_id, count(*) + any_value(n) - 1 AS length FROM r GROUP BY doc_id, item_id, diagonal, run) GROUP BY doc_id),
    o AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM h) GROUP BY doc_id)
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
      coalesce(longest, 0) AS longest, n_hit IS NOT NULL AS contaminated
    FROM d LEFT JOIN g USING (doc_id) LEFT JOIN m USING (doc_id) LEFT JOIN o USING (doc_id)
    """,
)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("hits", "matches")


@query("op10_suffix_array_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("spans")


_FINITE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"


@query(
    "op11_hard_negatives",
    f"""
    WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
      list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings WHERE label IS NOT NULL AND {_FINITE}),
    s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
      CAST(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i])) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
    p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
    n AS (SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
      CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
      FROM p JOIN s ON s.anchor_id = p.anchor_id WHERE NOT same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score)
    SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
    """,
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives(rows, F.col("vec_id") % 100 == 0)


def _rounds_sql() -> str:
    """A pair of tables per round: vectors with the nearest centroid, then the centroids that follow."""
    distance = f"list_sum(list_transform(range(1, {DIMENSIONS + 1}), lambda i: (v[i] - c[i]) * (v[i] - c[i])))"
    out = []
    for r in range(ROUNDS + 1):
        out.append(
            f"a{r} AS MATERIALIZED (SELECT vec_id, any_value(v) AS v, min({{'d': CAST({distance} AS BIGINT), 'k': k}}) AS m FROM v, c{r} GROUP BY row, vec_id)"
        )
        if r < ROUNDS:
            sums = f"(SELECT m.k AS k, i, sum(v[i]) AS s, count(*) AS n FROM a{r}, range(1, {DIMENSIONS + 1}) t(i) GROUP BY m.k, i)"
            means = f"(SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM {sums} GROUP BY k)"
            out.append(f"c{r + 1} AS MATERIALIZED (SELECT o.k, coalesce(x.c, o.c) AS c FROM c{r} o LEFT JOIN {means} x ON o.k = x.k)")
    return ", ".join(out)


@query(
    "op12_centroid_clusters",
    f"""
    WITH v AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
      FROM embeddings WHERE len(embedding) = {DIMENSIONS} AND {_FINITE}),
    c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY sha256('3:' || vec_id), v) - 1 AS INTEGER) AS k, v AS c FROM v QUALIFY k < {CLUSTERS}),
    {_rounds_sql()},
    t AS (SELECT m.k AS k, CAST(sum(m.d) AS BIGINT) AS i FROM a{ROUNDS} GROUP BY m.k)
    SELECT vec_id, m.k AS cluster, m.d AS distance, t.i AS cluster_inertia, CAST((SELECT sum(i) FROM t) AS BIGINT) AS inertia,
      sha256(array_to_string(c.c, ',')) AS centroid_sha256
    FROM a{ROUNDS} JOIN t ON t.k = m.k JOIN c{ROUNDS} c ON c.k = m.k
    """,
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = with_centroid_sha(cluster_vectors(table(spark, sf_dir, "embeddings")))
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


@query("op13_quality_rules")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
