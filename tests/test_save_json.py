"""The JSON sink gives back every row it was given, whole."""

from pyspark.sql import functions as F

import __spark_entry__ as entry

LONG = 20_000_001  # one character more than a JSON reader takes unless told otherwise


def test_rows_come_back_whole(spark, tmp_path):
    texts = [None, "", "null", 'a\r\n"\\ \u0000\u2028', "\ufeffé漢\U0001f600"]
    rows = [(n, 0, role, t) for n, t in enumerate(texts) for role in ("user", "assistant", None)]
    rows += [(None, None, None, None)] * 2 + [(7, 1, "system", "twice")] * 2
    schema = "conv_id bigint, turn bigint, role string, text string"
    long = spark.createDataFrame([(8, 0, "assistant", "é")], schema).withColumn(
        "text", F.repeat("text", F.lit(LONG)))
    spark.createDataFrame(rows, schema).union(long).write.parquet(f"{tmp_path}/conversations.parquet")
    given = spark.read.parquet(f"{tmp_path}/conversations.parquet")
    got, want = (df.select("conv_id", "turn", "role", F.length("text").alias("n"), F.md5("text")) for df in (
        entry.queries()["save_json"](spark, str(tmp_path)), given))
    assert got.count() == len(rows) + 1 and got.where(f"n = {LONG}").count() == 1
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
