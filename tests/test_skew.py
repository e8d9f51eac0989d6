from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusloom.operators import select, skew


def facts(spark, n=4000):
    """A third of the rows has key 'hot'."""
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 50))
    return spark.range(n).select("id", key.alias("k"))


def test_lookup_join_with_hot_key(spark):
    left = facts(spark)
    right = left.select("k").distinct().where("k <> 'k7'").withColumn("v", F.upper("k"))
    plain = left.join(right, "k", "left")
    hot = skew.hot_keys(left, ["k"], ["id"], floor=500, look=4)
    assert [r.k for r in hot.collect()] == ["hot"]
    cut = skew.lookup_join(left, right, ["k"], ["id"], floor=500, look=4)
    assert sorted(map(tuple, cut.collect())) == sorted(map(tuple, plain.collect()))
    inner = skew.lookup_join(left, right, ["k"], ["id"], how="inner", floor=500, look=4)
    assert inner.count() == plain.where("v is not null").count()


def test_hot_key_is_cut_evenly(spark):
    hot = skew.hot_keys(facts(spark), ["k"], ["id"], floor=500, look=4).first()
    # a third of all rows in slices of a ten-thousandth
    assert 3000 < hot._slices < 3700


def test_no_hot_keys_on_even_data(spark):
    even = spark.range(1000).select("id", (F.col("id") % 100).alias("k"))
    assert skew.hot_keys(even, ["k"], ["id"], floor=500, look=4) is None


def test_positions_equal_window(spark):
    df = facts(spark).withColumn("name", F.sha2(F.col("id").cast("string"), 256))
    ranked = skew.positions(df, ["k"], ["name", "id"])
    w = W.partitionBy("k").orderBy("name", "id")
    rule = df.select(
        "id", F.row_number().over(w).alias("p"), F.count(F.lit(1)).over(W.partitionBy("k")).alias("n")
    )
    found = {r.id: (r.position, r.members) for r in ranked.collect()}
    assert found == {r.id: (r.p, r.n) for r in rule.collect()}


def test_positions_spread_a_hot_group(spark):
    one_group = spark.range(8000).select(F.lit("g").alias("g"), "id")
    laid = one_group.repartitionByRange(4, "g", "id")
    sizes = [r.n for r in laid.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 4 and max(sizes) < 4000
    ranked = skew.positions(one_group, ["g"], ["id"])
    assert ranked.where("position <> id + 1 OR members <> 8000").count() == 0


def test_keep_first_limits_before_the_shuffle(spark):
    df = spark.range(1000).select(F.col("id").alias("ordinal"), (F.col("id") % 7).alias("k"))
    kept = select.keep_first(df, "k")
    assert sorted(r.ordinal for r in kept.collect()) == list(range(7))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan


def test_selection(spark):
    df = spark.createDataFrame(
        [(0, "a", "A"), (1, "", "B"), (2, "c", None), (3, "d", "D"), (4, "a", "A2")],
        "ordinal int, entity_id string, name string",
    )
    kept = select.required_fields(df, "entity_id", "name")
    assert [r.ordinal for r in kept.orderBy("ordinal").collect()] == [0, 3, 4]
    first = select.keep_first(kept, "entity_id")
    assert [r.ordinal for r in select.first_n(first, 1).collect()] == [0]
    assert select.first_n(first, None) is first
    assert select.allow_list(first, ("d",)).count() == 1
    assert select.allow_list(first, tuple(str(i) for i in range(2000)) + ("d",)).count() == 1
    assert select.allow_list(first, None) is first
    last = {r.entity_id: (r.ordinal, r.name) for r in select.last_write(kept).collect()}
    assert last == {"a": (0, "A2"), "d": (3, "D")}
