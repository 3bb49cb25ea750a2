"""Known values and edge cases of the label model's operators."""

import pytest
from pyspark.sql import functions as F

from auralith.operators import graph, iaa, qa


def test_kappa_known_value(spark):
    pairs = [(1, 1)] * 3 + [(1, 0)] * 2 + [(0, 1)] * 2 + [(0, 0)] * 3
    assert iaa.cohen_kappa(spark.createDataFrame(pairs, "a int, b int")).first()["kappa"] == pytest.approx(0.2)


def test_degenerate_kappas(spark):
    same = spark.createDataFrame([(3, 3)] * 4, "a int, b int")
    assert iaa.cohen_kappa(same).first()["kappa"] == 0
    assert iaa.weighted_kappa(same).first()["kappa"] == 1


def test_overlap_touching_nested_single(spark):
    events = spark.createDataFrame([(1, 0, 10), (1, 10, 20), (2, 0, 100), (2, 10, 20), (2, 50, 60), (3, 5, 6)], "clip int, onset_us long, offset_us long")
    assert {r["clip"]: r["has_overlap"] for r in qa.clip_overlap(events).collect()} == {1: False, 2: True, 3: False}


def test_outliers(spark):
    rows = [(i, "AGG", 1, 100.0 + i / 100, -20.0) for i in range(9)] + [(9, "AGG", 1, 400.0, -20.0), (10, "VIC", 1, 1.0, -3.0)]
    assert [r["clip"] for r in qa.outlier_clips(spark.createDataFrame(rows, "clip int, role string, intensity int, f0 double, rms double")).collect()] == [9]


def test_components_transitive_and_alone(spark):
    pairs = spark.createDataFrame([("a", 1), ("b", 1), ("b", 2), ("c", 2), ("d", None), ("e", 9)], "clip string, speaker int")
    assert {r["clip"]: r["root"] for r in graph.components(pairs).collect()} == {"a": "a", "b": "a", "c": "a", "d": "d", "e": "e"}


def test_splits_are_disjoint_and_sized(spark):
    pairs = spark.range(400).select(F.col("id").alias("clip"), (F.col("id") % 130).alias("speaker"))
    out = graph.splits(graph.components(pairs)).join(pairs, "clip")
    assert out.groupBy("speaker").agg(F.countDistinct("split").alias("n")).where("n > 1").isEmpty()
    n = {r["split"]: r["count"] for r in out.groupBy("split").count().collect()}
    assert abs(n["train"] - 280) <= 5 and abs(n["val"] - 60) <= 5
    with pytest.raises(ValueError):
        graph.splits(pairs, train=1.0)


def test_checkpoints_forget_exploding_estimates(spark):
    """A table that is joined with itself round after round keeps an estimate of its size that the planner can handle (its digits doubled each round)."""
    from auralith.session import checkpointed

    df = spark.range(50).selectExpr("id", "id AS next")
    for _ in range(12):
        df = checkpointed(df.join(df.selectExpr("id AS next", "next AS other"), "next").selectExpr("id", "other AS next"))
    assert df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().bit_length() < 200
    assert sorted(map(tuple, df.collect())) == [(i, i) for i in range(50)]


@pytest.mark.parametrize("most, text", [(250_000, False), (30, False), (30, True)])
def test_components_link_in_tasks_first(spark, monkeypatch, most, text):
    """Equal to union and find whatever a task holds at once, with repeated pairs and nulls; what the tasks can't link themselves is a small part of the pairs."""
    monkeypatch.setattr(graph, "NODES", most)
    edges, whole = [], graph.connected
    monkeypatch.setattr(graph, "connected", lambda e: edges.append(e.count()) or whole(e))
    named = (lambda k, v: f"{k}{v}") if text else (lambda k, v: v)
    pairs = [(named("c", c), named("s", c // 50 * 10 + (c * c + k) % 7)) for c in range(600) for k in (0, 1, 1, 3, 5)] + [(named("c", 1000), None), (named("c", 3), None), (None, named("s", 1)), (None, named("s", 20)), (None, None)]
    root: dict = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for c, s in pairs:
        if c is not None and s is not None:
            a, b = find(("c", c)), find(("s", s))
            root[max(a, b)] = min(a, b)
    want = {c: find(("c", c))[1] for c, _ in pairs if c is not None} | {None: None}
    rows = spark.createDataFrame(pairs, "clip string, speaker string" if text else "clip long, speaker long").repartition(3)
    got = graph.components(rows).collect()
    assert {r["clip"]: r["root"] for r in got} == want and len(got) == len(want) == 602
    assert most == 30 or edges[0] < 500  # of 2,400 different pairs
