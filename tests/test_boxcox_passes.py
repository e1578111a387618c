"""Box-Cox parameters take many passes over the values, but make them once."""

from pyspark.sql import functions as F

from demandloom.operators import scaling as S


def test_values_are_made_once(spark):
    made = spark.sparkContext.accumulator(0)

    def value(i):
        made.add(1)
        return float(i * i + 1)

    df = spark.range(300).select(F.udf(value, "double")("id").alias("x"))
    row = S.transform_params(df, "x", "box-cox").first()
    assert made.value == 300 and row["constant"] == 0.0
    plain = spark.range(300).select((F.col("id") * F.col("id") + 1).cast("double").alias("x"))
    assert row["lambda"] == S.boxcox_lambda(plain, "x")
