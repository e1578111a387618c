import sys
from pathlib import Path

sys.path[:0] = [str(Path(__file__).resolve().parents[1])]

from pyspark.sql import types as T  # noqa: E402

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])


def docs_of(spark, rows):
    """Documents from (doc_id, text) with extra columns that clash with names used inside."""
    from pyspark.sql import functions as F

    extra = {n: F.lit("x") for n in ("n", "token", "_id", "u", "v", "length", "h", "_salt", "sig")}
    return spark.createDataFrame(rows, DOCS).withColumns(extra)
