"""Shared by the tests."""


def one_col(spark, values, expr, dtype="string"):
    """Evaluate ``expr(col('v'))`` over a list of values, keeping input order."""
    from pyspark.sql import functions as F
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {dtype}")
    return [r[0] for r in df.select(expr(F.col("v")).alias("o"), "i").orderBy("i").collect()]
