"""A training-corpus pipeline: documents to packed sequences in five stages.

Each stage gets what the one before kept and returns a DataFrame; between
stages it is written as Parquet to the shared folder and read again, so a lost
executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.llm import jaccard_join, line_dedup, packing, pii, toxicity
from demandloom.llm.queries import table, tokenizer_path
from demandloom.operators.ordered import with_positions
from demandloom.sources.io import settle


def rows_of(docs: DataFrame) -> DataFrame:
    """(doc_id, text, row): each document beside itself as one value, so that no column of the table can clash."""
    return docs.select(F.col("doc_id"), F.col("text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def documents(rows: DataFrame, columns: list[str], text: Column) -> DataFrame:
    """The documents of ``row`` with another text and its number of characters."""
    new = {"text": text, "n_chars": F.when(F.col("row.text").isNull(), F.col("row.n_chars")).otherwise(F.char_length(text).cast("long")) if "n_chars" in columns else None}
    return rows.select(*[new[c].alias(c) if c in new else F.col(f"row.`{c}`").alias(c) for c in columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is at least 0.3 go; null text scores as empty."""
    return toxicity.without_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier one, exactly or nearly, go; so do documents of which nothing else is left.

    Documents that were null or blank before stay as they are.
    """
    left = line_dedup.without_repeated_lines(rows_of(docs))
    emptied = (F.col("n_kept") < F.col("n_lines")) & ~F.rlike("text", F.lit(r"\S"))
    return documents(left.where(~F.coalesce(emptied, F.lit(False))), docs.columns, F.col("text"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows linked by like five-word shingles the first by doc_id stays, null ids before all, equal ids by their values.

    Where ids are not unique, or missing, rows are told apart by their place in
    that order, so they are compared like all others.  Texts without words all
    stay.
    """
    rows = rows_of(docs)
    if not docs.groupBy("doc_id").count().where("count > 1 or doc_id is null").isEmpty():
        ordered = with_positions(rows.withColumn("hash", F.xxhash64("text")), ["doc_id", "hash"])
        rows = ordered.select(F.col("_pos").alias("doc_id"), "text", "row")
    classes = jaccard_join.similarity_classes(rows)
    gone = settle(classes.where("doc_id <> component_id").select("doc_id"), "near-copies")
    return documents(rows.join(gone, "doc_id", "left_anti"), docs.columns, F.col("text"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data become their kind in angle brackets; all rows stay."""
    rows = rows_of(docs)
    base, added = pii.span_columns(rows.select("doc_id", "text"))
    spans = rows.withColumn("_base", base).withColumn("_added", added)
    text = F.when(F.size("_base") + F.size("_added") > 0, pii.redacted(F.col("text"), F.concat("_base", "_added"))).otherwise(F.col("text"))
    return documents(spans, docs.columns, text)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens."""
    return packing.best_fit(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard", drop_near_copies),
    ("personal_data", redact),
    ("packing", pack),
]

#: No SQL: the first stage is a fitted machine; tests/llm holds the others against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
