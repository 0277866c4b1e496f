"""The contract gate makes its rows once, however often it looks at them."""

from pyspark.sql import functions as F

from spendloom.sources.contract import split_contract


def test_raw_rows_are_made_once(spark):
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def cell(key):
        made.add(1)
        return "x%d" % (key % 5)

    keys = [(i // 2 if i < 20 else i,) for i in range(60)]
    raw = spark.createDataFrame(keys, "row_idx long").select(
        F.lit("s").alias("statement_id"), F.lit(0).alias("table_idx"), "row_idx",
        F.array(F.lit("Date")).alias("headers"), F.array(cell("row_idx")).alias("cells"))
    kept, rejected = split_contract(raw)
    assert kept.count() == 50 and rejected.agg(F.sum("copies")).first()[0] == 10
    assert made.value == 60
