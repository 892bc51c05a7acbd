from pyspark.sql import Window
from pyspark.sql import functions as F

from ordermart.operators.keys import assign_surrogate_keys, highest_key


def test_keys_equal_a_global_row_number(spark):
    df = spark.range(5000).select(F.md5(F.col("id").cast("string")).alias("k"))
    keyed = assign_surrogate_keys(df, "sk", ["k"], start=100)
    expected = df.withColumn("sk", F.row_number().over(Window.orderBy("k")) + 100)
    assert keyed.columns == ["sk", "k"]
    assert keyed.exceptAll(expected.select("sk", "k")).count() == 0 and keyed.count() == 5000


def test_hot_leading_value_is_split_and_numbered_without_gaps(spark):
    df = spark.range(0, 6000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("hot"), "id"
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        keyed = assign_surrogate_keys(df, "sk", ["hot", "id"])
        sizes = [r["count"] for r in keyed.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) == 8 and max(sizes) < 1500  # the hot third alone is 2000 rows
    low, high, distinct = keyed.agg(F.min("sk"), F.max("sk"), F.count_distinct("sk")).first()
    assert (low, high, distinct) == (1, 6000, 6000)


def test_keys_do_not_change_when_read_again(spark):
    df = spark.range(1000).select((F.rand(1) * 1e9).cast("long").alias("v"), "id")
    keyed = assign_surrogate_keys(df, "sk", ["v", "id"])
    assert keyed.exceptAll(keyed.repartition(3)).count() == 0
    assert keyed.agg(F.count_distinct("sk")).first()[0] == 1000


def test_no_rows(spark):
    keyed = assign_surrogate_keys(spark.range(0), "sk", ["id"])
    assert keyed.count() == 0 and keyed.schema["sk"].dataType.simpleString() == "bigint"
    assert highest_key(keyed, "sk") == 0
