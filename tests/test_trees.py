"""Trees as a table: against the model itself and against a walk in plain Python."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from siltbed.operators.forecast import assemble, train_growth_model
from siltbed.operators.trees import read_trees, score_trees, store_trees, tree_importance

FEATURES = ["a", "b", "c", "constant"]


@pytest.fixture(scope="module")
def data(spark):
    return spark.range(300).select(
        F.col("id").alias("_row"),
        F.sin("id").alias("a"),
        (F.col("id") % 7).alias("b"),
        F.when(F.col("id") % 11 != 0, F.cos(F.col("id") * 3)).alias("c"),
        F.lit(1.0).alias("constant"),
        (F.sin("id") * (F.col("id") % 7) + F.coalesce(F.cos(F.col("id") * 3), F.lit(0))).alias("y"),
    )


@pytest.fixture(scope="module")
def stored(data, tmp_path_factory):
    model = train_growth_model(data, FEATURES, "y", trees=7, depth=4, learning_rate=0.2)
    path = str(tmp_path_factory.mktemp("model") / "y")
    return model, store_trees(model, path), path


def test_scores_equal_the_models(spark, data, stored):
    model, trees, path = stored
    expected = {r["_row"]: r["_prediction"] for r in model.transform(assemble(data, FEATURES)).collect()}
    scored = score_trees(data, read_trees(spark, path), FEATURES, "score")
    assert scored.columns == [*data.columns, "score"]
    got = {r["_row"]: r["score"] for r in scored.collect()}
    assert got == pytest.approx(expected, abs=1e-12)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan.split("Subquery")[0] and "Python" not in plan


def test_scores_equal_a_plain_walk(data, stored):
    nodes = {(r.tree, r.node): r for r in stored[1].collect()}
    rows = data.collect()
    got = {r["_row"]: r["score"] for r in score_trees(data, stored[1], FEATURES, "score").collect()}
    for row in rows:
        values, total = [row[f] or 0.0 for f in FEATURES], 0.0
        for tree in sorted({t for t, _ in nodes}):
            node = nodes[tree, 0]
            while node.left is not None:
                node = nodes[tree, node.left if values[node.feature] <= node.threshold else node.right]
            total += node.weight * node.prediction
        assert got[row["_row"]] == pytest.approx(total, abs=1e-12)


def test_importance_equals_the_models(stored):
    model, trees, _ = stored
    rows = tree_importance(trees, FEATURES, "y").collect()
    got = {r.feature_name: r.importance for r in rows}
    assert got == pytest.approx(dict(zip(FEATURES, model.featureImportances.toArray())), abs=1e-12)
    assert got["constant"] == 0.0 and [r.importance for r in rows] == sorted(got.values(), reverse=True)


def test_edges(spark, frame, stored):
    trees = stored[1]
    odd = frame([(None, float("nan"), 1.0, 1.0), (0.0, 0.0, 1.0, 1.0)], "a double, b double, c double, constant double")
    first, second = (r.score for r in score_trees(odd, trees, FEATURES, "score").collect())
    assert first == second
    assert score_trees(odd.limit(0), trees, FEATURES, "score").count() == 0
    assert {r.a for r in score_trees(odd, trees.limit(0), FEATURES, "a").collect()} == {0.0}
    leaf = frame(
        [(0, 0.5, 0, None, None, None, None, 4.0, None, 9.0)],
        "tree int, weight double, node int, feature int, threshold double, left int, right int, "
        "prediction double, gain double, rows double",
    )
    assert {r.score for r in score_trees(odd, leaf, FEATURES, "score").collect()} == {2.0}
    assert {r.importance for r in tree_importance(leaf, FEATURES, "y").collect()} == {0.0}
    with pytest.raises(ValueError, match="more than 3"):
        score_trees(odd, trees, FEATURES, "score", most_nodes=3)
