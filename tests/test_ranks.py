import random

import pytest
from pyspark.sql import functions as F

from corpusmill.functions import keys, ranks
from corpusmill.sources import landed


@pytest.mark.parametrize("size", [5_000_000, 40, 3])
def test_positions_equal_a_sorted_list(spark, size):
    rng = random.Random(1)
    rows = [(rng.choice([None, "a", "b", "zz", "é"]), rng.randint(0, 5), f"t{i % 7}") for i in range(300)]
    df = spark.createDataFrame(rows, "name string, n int, `odd col` string").repartition(5)
    out = ranks.ranked(df, ["name", "n"], "at", size=size).collect()
    assert sorted(r["at"] for r in out) == list(range(300))
    got = [(r["name"], r["n"]) for r in sorted(out, key=lambda r: r["at"])]
    assert got == sorted(((a, b) for a, b, _ in rows), key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    assert sorted((r["name"] or "", r["n"], r["odd col"]) for r in out) == sorted((a or "", b, c) for a, b, c in rows)


def test_equal_keys_do_not_depend_on_partitions(spark):
    df = spark.range(200).select(F.lit(1).alias("k"), F.col("id"))
    a, b = (ranks.ranked(df.repartition(n), "k", size=30).collect() for n in (2, 7))
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_one_row_many_times_is_no_hot_range(spark):
    df = spark.range(500).select(F.lit("same").alias("k"))
    out = ranks.ranked(df, "k", size=20)
    assert sorted(r["rank"] for r in out.collect()) == list(range(500))
    sizes = out.withColumn("p", F.spark_partition_id()).groupBy("p").count().agg(F.max("count")).head()[0]
    assert sizes <= 200


def test_empty_table(spark):
    assert ranks.ranked(spark.range(0), "id").columns == ["id", "rank"]
    assert ranks.ranked(spark.range(0), "id").count() == 0


def test_sequential_id_of_string_keys(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("a",)], "k string")
    out = landed.sequential_id(df, "k", size=2)
    assert [tuple(r) for r in out.orderBy("id").collect()] == [
        ("item_0000", None), ("item_0001", "a"), ("item_0002", "a"), ("item_0003", "b")]


@pytest.mark.parametrize("few", [0, 1_000])
def test_first_rows_of_groups_of_any_size(spark, monkeypatch, few):
    monkeypatch.setattr(keys, "FEW_ROWS", few)
    rows = [(i, "hot" if i % 10 else [None, "a", "b"][i // 10 % 3], (i * 37) % 50) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, g string, v int").repartition(4)
    got = {(r.g, r["rank"]): (r.v, r.id) for r in keys.first_per_group(df, 60, "g", [F.desc("v"), F.asc("id")]).collect()}
    want = {}
    for g in ("hot", None, "a", "b"):
        for at, (v, i) in enumerate(sorted(((v, i) for i, x, v in rows if x == g), key=lambda p: (-p[0], p[1]))[:60]):
            want[g, at + 1] = (v, i)
    assert got == want
