"""Registered queries of this package and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES, ORACLE = {}, {}

TOKENIZER = "byte_bpe_50k.json"


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


@query("op1_document_fingerprints")
def document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from demandloom.llm.fingerprint import edited_fingerprints

    return edited_fingerprints(table(spark, sf_dir, "documents"))


@query(
    "op2_url_filters",
    """
    WITH rules(rule, verdict) AS (VALUES ('com/', 'allow'), ('example.com/en/', 'block'),
        ('www.example.com/en/', 'allow'), ('net/es/', 'block'), ('net/fr/', 'block')),
    cut AS (SELECT page_id,
        translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*(/[^?#]*)', 1) AS path FROM pages),
    split AS (SELECT *, split_part(rule, '/', 1) AS h, substr(rule, strpos(rule, '/')) AS p FROM rules)
    SELECT c.page_id, c.host, c.path, b.rule, coalesce(b.verdict, 'allow') AS verdict
    FROM cut c LEFT JOIN (
        SELECT host, path, rule, verdict FROM (SELECT DISTINCT host, path FROM cut)
        JOIN split ON ends_with('.' || host, '.' || h) AND starts_with(path, p)
        QUALIFY row_number() OVER (PARTITION BY host, path ORDER BY length(rule) DESC) = 1) b
      ON b.host = c.host AND b.path = c.path""",
)
def url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from demandloom.llm.url_filter import RULES, rule_table, url_filter

    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter(pages, rule_table(spark, RULES)).drop("url")


@query("op4_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from demandloom.llm.packing import best_fit

    return best_fit(table(spark, sf_dir, "documents"), tokenizer_path())


@query("op5_personal_data")
def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from demandloom.llm import pii

    return pii.span_digest(pii.personal_data(table(spark, sf_dir, "documents")))


@query("op8_ngram_jaccard_join")
def ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from demandloom.llm.jaccard_join import similarity_classes

    return similarity_classes(table(spark, sf_dir, "documents"))


@query("op6_embedding_near_dedup")
def embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from demandloom.llm.embedding_dedup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op9_sentencepiece_codec")
def sentencepiece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    from demandloom.llm.sentencepiece_codec import coded

    return coded(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


@query("op3_toxicity")
def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from demandloom.llm import toxicity as tox

    return tox.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op7_line_dedup")
def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from demandloom.llm.line_dedup import without_repeated_lines

    out = without_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_kept", F.sha2("text", 256).alias("kept_sha256"))


@query("op10_language_model_scores")
def language_model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from demandloom.llm.language_model import language_model_scores as scores

    return scores(table(spark, sf_dir, "documents"))


def _rounds(step, n: int) -> str:
    """SQL steps 0 to n - 1, each naming the tables of its round and the next."""
    return ",".join(step.format(a=i, b=i + 1) for i in range(n))


FINITE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"


@query(
    "op11_centroid_clustering",
    f"""
    WITH q AS MATERIALIZED (
      SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
      FROM embeddings WHERE {FINITE} AND len(embedding) = 64),
    p AS MATERIALIZED (SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM q),
    c0 AS MATERIALIZED (SELECT c, d, x FROM p JOIN (
      SELECT vec_id, row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS c FROM q QUALIFY c < 16) USING (vec_id)),
    {_rounds('''n{a} AS MATERIALIZED (SELECT vec_id, c, distance FROM (
      SELECT vec_id, c, sum((p.x - k.x) * (p.x - k.x)) AS distance FROM p JOIN c{a} k USING (d) GROUP BY vec_id, c)
      QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, c) = 1),
    m{a} AS (SELECT c, d, sum(x) AS s, count(*) AS n FROM p JOIN n{a} USING (vec_id) GROUP BY c, d),
    c{b} AS MATERIALIZED (SELECT k.c, k.d, coalesce((s - ((s % n) + n) % n) // n, k.x) AS x FROM c{a} k LEFT JOIN m{a} USING (c, d))''', 3)},
    f AS MATERIALIZED (SELECT vec_id, c, distance FROM (
      SELECT vec_id, c, sum((p.x - k.x) * (p.x - k.x)) AS distance FROM p JOIN c3 k USING (d) GROUP BY vec_id, c)
      QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, c) = 1),
    h AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY d)) AS centroid_sha256 FROM c3 GROUP BY c)
    SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
      CAST(sum(distance) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
    FROM f JOIN h USING (c)""",
)
def centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    from demandloom.llm.centroid_clustering import centroid_clusters

    return centroid_clusters(table(spark, sf_dir, "embeddings"))


@query(
    "op12_vector_codes",
    f"""
    WITH q AS MATERIALIZED (
      SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v, len(embedding) // 16 AS w
      FROM embeddings WHERE {FINITE}),
    p AS MATERIALIZED (SELECT vec_id, (d - 1) // w AS p, (d - 1) % w AS d, x
      FROM (SELECT vec_id, w, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM q)),
    c0 AS MATERIALIZED (SELECT p, e, d, x FROM p JOIN (
      SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM q QUALIFY e < 64) USING (vec_id)),
    {_rounds('''n{a} AS MATERIALIZED (SELECT vec_id, p, e FROM (
      SELECT vec_id, p, e, sum((p.x - k.x) * (p.x - k.x)) AS error FROM p JOIN c{a} k USING (p, d) GROUP BY vec_id, p, e)
      QUALIFY row_number() OVER (PARTITION BY vec_id, p ORDER BY error, e) = 1),
    m{a} AS (SELECT p, e, d, sum(x) AS s, count(*) AS n FROM p JOIN n{a} USING (vec_id, p) GROUP BY p, e, d),
    c{b} AS MATERIALIZED (SELECT k.p, k.e, k.d, coalesce((s - ((s % n) + n) % n) // n, k.x) AS x FROM c{a} k LEFT JOIN m{a} USING (p, e, d))''', 2)},
    f AS (SELECT vec_id, p, e, error FROM (
      SELECT vec_id, p, e, sum((p.x - k.x) * (p.x - k.x)) AS error FROM p JOIN c2 k USING (p, d) GROUP BY vec_id, p, e)
      QUALIFY row_number() OVER (PARTITION BY vec_id, p ORDER BY error, e) = 1),
    g AS (SELECT vec_id, lower(string_agg(printf('%02x', CAST(e AS INTEGER)), '' ORDER BY p)) AS code, CAST(sum(error) AS BIGINT) AS error FROM f GROUP BY vec_id)
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
      (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p, e, d)) FROM c2) AS codebooks_sha256
    FROM g JOIN q USING (vec_id)""",
)
def vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from demandloom.llm.vector_codes import vector_codes as codes

    return codes(table(spark, sf_dir, "embeddings"))


@query("op13_license_scan")
def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from demandloom.llm.license_scan import license_scan as scan

    return scan(table(spark, sf_dir, "documents"))
