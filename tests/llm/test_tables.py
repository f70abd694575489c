import pathlib
import random

from corpusmill.llm.graph import components
from corpusmill.llm.tables import Scratch, fresh


def test_tables_are_written_dropped_and_kept(spark):
    scratch = Scratch(spark, "test")
    a, b = (scratch.write(spark.range(n), f"t{n}") for n in (3, 5))
    assert (a.count(), b.count()) == (3, 5)
    scratch.write(spark.range(1), "more")
    scratch.drop("t3")
    scratch.drop("t3")
    scratch.drop("never written")
    assert {p.name for p in pathlib.Path(scratch.folder).iterdir()} == {"t5", "more"}
    scratch.keep_only("t5")
    assert {p.name for p in pathlib.Path(scratch.folder).iterdir()} == {"t5"} and b.count() == 5


def test_fresh_names(spark):
    df = spark.range(1).selectExpr("id", "1 AS _a", "2 AS __A", "3 AS b")
    assert fresh(df, "_a", "c", "B") == ["___a", "c", "_B"]


def test_components_equal_union_find(spark):
    rng = random.Random(5)
    links = [(i, i + 1) for i in range(60)] + [(100, k) for k in range(101, 140)] + [(7, 7)]
    links += [(rng.randint(200, 400), rng.randint(200, 400)) for _ in range(120)]
    rng.shuffle(links)
    up = {x: x for link in links for x in link}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in links:
        low, high = sorted((root(a), root(b)))
        up[high] = low
    scratch = Scratch(spark, "components")
    found = {r["id"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long"), scratch, "c").collect()}
    assert found == {x: root(x) for x in up if any(x in link and link[0] != link[1] for link in links)}
    assert len(scratch.names) <= 4                            # what a turn has read is dropped
    none = components(spark.createDataFrame([], "a long, b long"), Scratch(spark, "none"), "c")
    assert none.columns == ["id", "component"] and none.count() == 0
