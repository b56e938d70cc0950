"""W1 ordered IDs equal a global row_number; skew-safe joins keep every row."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from alertlake.operators import dedup
from alertlake.operators.skew import join_back


def test_ordered_ids_equal_row_number(spark):
    df = spark.range(5000).select((F.col("id") % 7).alias("a"), (F.col("id") * 7919 % 5000).alias("b"))
    got = dedup.assign_ordered_ids(df, ["a", "b"], out_col="seq", start=11)
    ref = df.withColumn("rn", F.row_number().over(Window.orderBy("a", "b")) + 10)
    j = got.join(ref, ["a", "b"])
    assert j.count() == 5000 and j.where("seq <> rn").count() == 0


def test_no_single_partition_exchange(spark):
    df = spark.range(1000).select(F.col("id").alias("k"))
    plan = dedup.assign_ordered_ids(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_hot_rows_are_not_shuffled(spark):
    """One key at 90 %: its rows get their statistics where they are, so no task holds them alone."""
    rows = spark.range(20000).repartition(8).select(F.when(F.col("id") < 18000, F.lit("hot")).when(F.col("id") < 18010, None).otherwise(
        F.concat(F.lit("k"), (F.col("id") % 100).cast("string"))).alias("key"), "id")
    stats = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
    out = join_back(rows, stats, ["key"], "n", hot_rows=1000)
    assert out.count() == 20000
    assert [tuple(r) for r in out.where("key = 'hot'").select("first", "n").distinct().collect()] == [(0, 18000)]
    assert [tuple(r) for r in out.where("key is null").select("first", "n").distinct().collect()] == [(18000, 10)]
    tasks = out.where("key = 'hot'").groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) >= 8 and max(r["count"] for r in tasks) < 6000


def test_duplicate_links(spark):
    b = spark.createDataFrame([(1, "E1", "k1"), (2, "E2", "k1"), (3, "E3", "k2"), (4, "E4", "k3")],
                              "ord int, ID string, Cle_dedup string")
    amap = spark.createDataFrame([("k3", "E0")], "Cle_dedup string, _arch_id string")
    out = {r["ID"]: r["Doublon_ID"] for r in dedup.link_duplicates(b, archive_map=amap).collect()}
    assert out == {"E1": "", "E2": "E1", "E3": "", "E4": "E0"}


def test_rank_within_group(spark):
    df = spark.createDataFrame([("a", 3), ("a", 1), ("b", 2), ("a", 2)], "g string, o int")
    out = sorted((r["g"], r["o"], r["rank"]) for r in dedup.rank_within_group(df, ["g"], ["o"]).collect())
    assert out == [("a", 1, 1), ("a", 2, 2), ("a", 3, 3), ("b", 2, 1)]
