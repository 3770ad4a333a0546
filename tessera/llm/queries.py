"""The training-data queries of the driver's contract, and their SQL where SQL can tell."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import table


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.quality import quality_scores

    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def quality_domains(labels: DataFrame) -> DataFrame:
    """Domains of the mixing queries: the quality that the labelled table gives a document."""
    return labels.select("doc_id", F.concat(F.lit("quality"), F.col("quality").cast("string")).alias("domain"))


#: What op2 asks for: tokens of good quality only, half as many as there are. Rates of junk stop at zero.
TARGETS, SHARE = {"quality0": 0.0, "quality1": 1.0}, 0.5


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.mixing import mixing_rates

    return mixing_rates(table(spark, sf_dir, "documents"), quality_domains(table(spark, sf_dir, "labels")), TARGETS, share=SHARE)


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.pii import BASE_KINDS, personal_data, spelled

    found = personal_data(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select("doc_id", *map(count, BASE_KINDS), F.sha2(spelled(base).cast("binary"), 256).alias("base_sha256"), spelled(F.col("spans")).alias("spans"))


def op4_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.html_text import page_text

    return page_text(table(spark, sf_dir, "pages"))


def op7_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.lattice_lm import lm_scores

    return lm_scores(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.toxicity import toxicity

    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.tokens import token_files

    return token_files(table(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.decontamination import contaminated

    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.exact_dedup import exact_duplicates

    return exact_duplicates(table(spark, sf_dir, "documents"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.vector_codes import vector_codes

    return vector_codes(table(spark, sf_dir, "embeddings"))


def op12_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.cover_tree import top_k

    return top_k(table(spark, sf_dir, "embeddings"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.divergence import source_divergence

    return source_divergence(table(spark, sf_dir, "documents"))


OP10_SQL = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents
)
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER (PARTITION BY text_sha256) AS kept,
       text_sha256
FROM d
"""


USABLE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"


def op11_sql(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """Plain k-means rounds of every part position: each part against each entry."""
    steps = [
        f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE {USABLE}
), cut AS MATERIALIZED (
  SELECT r, p, v[p * (len(v) // {parts}) + 1 : (p + 1) * (len(v) // {parts})] AS part FROM kept, range({parts}) AS t(p)
), first AS (
  SELECT r, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT {entries}
), b0 AS MATERIALIZED (
  SELECT p, e, part AS c FROM first JOIN cut USING (r)
)"""
    ]
    for i in range(rounds + 1):
        steps.append(f"""far{i} AS (
  SELECT r, cut.p, e, list_sum(list_transform(list_zip(part, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d FROM cut JOIN b{i} ON cut.p = b{i}.p
), a{i} AS MATERIALIZED (
  SELECT r, p, CAST(min(d) AS BIGINT) AS d, arg_min(e, (d, e)) AS e FROM far{i} GROUP BY r, p
)""")
        if i < rounds:
            steps.append(f"""m{i} AS (
  SELECT p, e, j, CAST(floor(sum(part[j]) / CAST(count(*) AS DOUBLE)) AS BIGINT) AS x FROM a{i} JOIN cut USING (r, p), generate_series(1, len(part)) AS t(j) GROUP BY p, e, j
), b{i + 1} AS MATERIALIZED (
  SELECT p, e, coalesce(moved.c, b{i}.c) AS c FROM b{i} LEFT JOIN (SELECT p, e, list(x ORDER BY j) AS c FROM m{i} GROUP BY p, e) AS moved USING (p, e)
)""")
    return f"""WITH {", ".join(steps)},
coded AS (
  SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY r
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM b{rounds}) AS codebooks_sha256
FROM kept JOIN coded USING (r)"""


OP12_SQL = f"""
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings WHERE {USABLE}
), s AS (
  SELECT q.vec_id AS query_id, q.r, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v AS q JOIN v AS c ON q.r <> c.r WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) <= 5
"""

OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), w AS (
  SELECT r, lang, source, unnest(terms) AS term FROM d
), kept AS (
  SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 30
), lang_sums AS (
  SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang
), cells AS (
  SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term
), groups AS (
  SELECT lang, source, coalesce(total, 0) AS total
  FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN (SELECT lang, source, sum(n) AS total FROM cells GROUP BY lang, source) USING (lang, source)
), prices AS (
  SELECT lang, source, term, coalesce(cells.n, 0) AS n,
         1 + CAST(1000000000 * CAST(coalesce(cells.n, 0) + 5 AS HUGEINT) // (groups.total + 5 * v) AS BIGINT) AS p,
         1 + CAST(1000000000 * CAST(kept.n + 5 AS HUGEINT) // (lang_sums.total + 5 * v) AS BIGINT) AS q
  FROM groups JOIN lang_sums USING (lang) JOIN kept USING (lang) LEFT JOIN cells USING (lang, source, term)
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(f, 0) AS BIGINT) AS value
  FROM groups AS a JOIN groups AS b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS f FROM prices AS x JOIN prices AS y ON x.lang = y.lang AND x.term = y.term GROUP BY ALL
  ) AS s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), both_parts AS (
  SELECT * FROM pairs UNION ALL SELECT lang, source, 'term', term, p - q FROM prices WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM both_parts QUALIFY part = 'pair' OR row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) <= 50
"""


def queries() -> dict:
    return {
        "op1_quality": op1_quality,
        "op2_mixing": op2_mixing,
        "op3_personal_data": op3_personal_data,
        "op4_page_text": op4_page_text,
        "op5_token_files": op5_token_files,
        "op6_simhash": op6_simhash,
        "op7_lattice_lm": op7_lattice_lm,
        "op8_toxicity": op8_toxicity,
        "op9_decontamination": op9_decontamination,
        "op10_exact_dedup": op10_exact_dedup,
        "op11_vector_codes": op11_vector_codes,
        "op12_top_k": op12_top_k,
        "op13_source_divergence": op13_source_divergence,
    }


def oracle_sql() -> dict[str, str]:
    return {"op10_exact_dedup": OP10_SQL, "op11_vector_codes": op11_sql(), "op12_top_k": OP12_SQL, "op13_source_divergence": OP13_SQL}
