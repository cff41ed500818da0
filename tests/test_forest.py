"""Trees against those of Spark ML, grown on the same weights, and against plain loops."""

import math
import random
from collections import Counter

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from innledger.operators import forest

FEATURES = ["a", "b"]


@pytest.fixture(scope="module")
def rows(spark):
    chance = random.Random(7)
    data = [
        (i, chance.randrange(12), chance.randrange(5), round(chance.uniform(0, 9), 2))
        for i in range(3000)
    ]
    df = spark.createDataFrame(data, "id long, a int, b int, noise double")
    return df.withColumn("label", F.expr("round(10 * a + 7 * b * b + noise, 2)")).cache()


@pytest.fixture(scope="module")
def samples(rows):
    return forest.bootstrap(rows, "id", "label", 5, 1, FEATURES).cache()


def test_weights_are_those_of_draws_with_replacement(rows, samples):
    cuts = [int(c, 16) / 65536 for c in forest.poisson_thresholds()]
    want = [sum(math.exp(-1) / math.factorial(j) for j in range(k + 1)) for k in range(len(cuts))]
    assert cuts == pytest.approx(want, abs=1e-5)
    for r in samples.groupBy("tree").agg(F.sum("weight").alias("n")).collect():
        assert abs(r.n - 3000) < 6 * math.sqrt(3000)


def test_each_tree_has_its_own_weights_whatever_the_number_of_trees(rows, samples):
    more = forest.bootstrap(rows, "id", "label", 40, 1, FEATURES)
    by_tree = {}
    for r in more.collect():
        by_tree.setdefault(r.tree, set()).add(tuple(r)[1:])
    assert len(by_tree) == 40 and len({frozenset(x) for x in by_tree.values()}) == 40
    for r in samples.collect():
        assert tuple(r)[1:] in by_tree[r.tree]


def test_one_tree_is_the_one_of_spark_ml(rows, samples):
    nodes = forest.grown(samples, FEATURES, 4).cache()
    grid = rows.select(*FEATURES).distinct()
    for tree in (0, 3):
        own = samples.filter(f"tree = {tree}")
        weighted = VectorAssembler(inputCols=FEATURES, outputCol="x").transform(
            own.withColumn("y", F.expr("total / weight / 100")).coalesce(1)
        )
        other = DecisionTreeRegressor(
            featuresCol="x", labelCol="y", weightCol="weight", maxDepth=4, maxBins=64
        ).fit(weighted)
        theirs = other.transform(VectorAssembler(inputCols=FEATURES, outputCol="x").transform(grid))
        found = forest.predicted(grid, nodes.filter(f"tree = {tree}"), FEATURES, "p")
        both = found.join(theirs, FEATURES).select("p", "prediction").collect()
        assert len(both) == 60
        for p, prediction in both:
            assert p == pytest.approx(prediction, abs=1e-5)


def test_a_forest_predicts_the_mean_of_its_trees(rows, samples):
    nodes = forest.grown(samples, FEATURES, 3).cache()
    grid = rows.select(*FEATURES).distinct()
    singles = Counter()
    for tree in range(5):
        for r in forest.predicted(grid, nodes.filter(f"tree = {tree}"), FEATURES, "p").collect():
            singles[r.a, r.b] += r.p / 5
    for r in forest.predicted(grid, nodes, FEATURES, "p").collect():
        assert r.p == pytest.approx(singles[r.a, r.b], abs=1e-6)


def test_children_add_up_to_their_parent(samples):
    nodes = {(r.tree, r.node): r for r in forest.grown(samples, FEATURES, 5).collect()}
    assert sum(1 for tree, node in nodes if node == 1) == 5
    for (tree, node), r in nodes.items():
        inside = r.feature is not None
        assert inside == ((tree, 2 * node) in nodes) == ((tree, 2 * node + 1) in nodes)
        if inside:
            assert r.weight == sum(nodes[tree, 2 * node + i].weight for i in (0, 1))


def test_null_features_are_not_scored_and_clashing_names_stay(spark, samples):
    nodes = forest.grown(samples, FEATURES, 2)
    df = spark.createDataFrame(
        [(1, 2, "t", 5), (None, 2, "u", 6)], "a int, b int, tree string, node int"
    )
    got = {r.tree: r for r in forest.predicted(df, nodes, FEATURES, "p").collect()}
    assert got["t"].p is not None and got["u"].p is None and got["t"].node == 5


def test_equal_labels_make_one_leaf(spark):
    df = spark.createDataFrame([(i, i % 3, i % 2, 4.25) for i in range(100)], "id long, a int, b int, label double")
    samples = forest.bootstrap(df, "id", "label", 2, 1, FEATURES)
    nodes = forest.grown(samples, FEATURES, 3).collect()
    assert [(r.node, r.feature, r.millionths) for r in nodes] == [(1, None, 4_250_000)] * 2
