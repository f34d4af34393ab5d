import pytest
from pyspark.sql import functions as F

from conftest import rows
from kestrel.functions.ordering import dense_positions, partition_starts, sorted_ids
from kestrel.session import Held


@pytest.mark.parametrize("parts", [1, 3, 17])
def test_positions_follow_the_order(spark, parts):
    df = spark.range(0, 500, numPartitions=4).select((F.col("id") * 7919 % 500).alias("v"), (F.col("id") % 3).alias("g"))
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        with Held(spark) as held:
            placed = sorted_ids(df, F.col("g").desc(), "v", name="pos", held=held)
            assert sum(1 for _ in partition_starts(placed, "pos")) <= parts
            got = sorted((r.pos, -r.g, r.v) for r in dense_positions(placed, "pos").collect())
            again = sorted((r.pos, -r.g, r.v) for r in dense_positions(placed, "pos").repartition(5).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert [p for p, _, _ in got] == list(range(500)) and got == again
    assert [(g, v) for _, g, v in got] == sorted((-(i % 3), i * 7919 % 500) for i in range(500))


def test_equal_rows_part_by_a_tie(spark):
    df = spark.range(0, 2000, numPartitions=4).select(F.lit("x").alias("k"), F.monotonically_increasing_id().alias("tie"))
    with Held(spark) as held:
        placed = dense_positions(sorted_ids(df, "k", "tie", held=held))
        assert sorted(r[0] for r in rows(placed, "id")) == list(range(2000))


def test_empty_frame(spark):
    with Held(spark) as held:
        assert rows(dense_positions(sorted_ids(spark.range(0), "id", name="pos", held=held), "pos")) == []
