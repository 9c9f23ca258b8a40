import pytest
from pyspark.sql import functions as F

from calipers.operators.heavy import heavy_keys, lookup_join


@pytest.fixture(scope="module")
def sides(spark):
    # nine tenths of the rows hold key 7 or no key
    key = F.when(F.col("id") % 10 < 5, 7).when(F.col("id") % 10 < 9, None).otherwise(F.col("id"))
    rows = spark.range(20_000, numPartitions=16).select(F.col("id").alias("row"), key.alias("k"))
    lookup = spark.range(0, 20_000, 2).select((F.col("id") + 5).alias("k"), (F.col("id") * 3).alias("v"))
    return rows, lookup


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_same_rows_as_a_plain_join(sides, how):
    rows, lookup = sides
    plain, split = rows.join(lookup, ["k"], how), lookup_join(rows, lookup, ["k"], how, share=100)
    names = sorted(plain.columns)
    assert split.select(names).exceptAll(plain.select(names)).isEmpty() and split.count() == plain.count()


def test_heavy_keys(sides):
    assert [r["k"] for r in heavy_keys(sides[0], ["k"], 100).collect()] == [7]
    assert heavy_keys(sides[0].limit(0), ["k"]).count() == 0


def test_no_task_gets_the_heavy_key(spark, sides):
    """Rows of the shuffled branch: the heavy key and nulls are not among them, so tasks are even."""
    rows, lookup = sides
    light = rows.where("k IS NOT NULL").join(heavy_keys(rows, ["k"], 100), ["k"], "left_anti")
    sizes = [r["n"] for r in light.repartition(8, "k").groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 2_000 and max(sizes) < 2 * sum(sizes) / 8
    plan = lookup_join(rows, lookup, ["k"], "left", share=100)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
