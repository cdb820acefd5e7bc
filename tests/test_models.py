"""Searches over model settings on data where the right answer is known."""

import os
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.sql import functions as F

from tamarind.operators import features, linear, models, neighbours, trees
from tamarind.plans import registry

FOLDER = os.environ.get("TAMARIND_TEST_TABLES", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(300):
        label = i % 2
        rows.append((i, [float(x) for x in rng.normal(3 * label, 1, 3)], label))
    return spark.createDataFrame(rows, "id long, vec array<double>, label int")


@pytest.mark.parametrize(
    "tune",
    [
        lambda rows: models.tune_logistic(rows, folds=3),
        lambda rows: models.tune_linear_svm(rows, cs=(0.1, 1.0), folds=3, max_iter=20),
        lambda rows: models.tune_tree(rows, depths=(1, 3), leaves=(1, 4), folds=3),
        lambda rows: models.tune_tree(rows, impurities=("gini",), depths=(3,), leaves=(1,), folds=3, features=("sqrt",)),
    ],
)
def test_searches_find_the_two_clusters(spark, vectors, tune):
    train, test = features.train_test_split(vectors, "id")
    rows = models.as_training_rows(train, "id", "vec", "label", folds=3)
    assert [r.fold for r in rows.select("fold").distinct().orderBy("fold").collect()] == [0, 1, 2]
    fitted = tune(rows)
    report = models.grid_report(spark, fitted).collect()
    assert len(report) == len(fitted.getEstimatorParamMaps()) and report[0].cv_accuracy > 0.9
    held_out = models.predict(fitted.bestModel, models.as_training_rows(test, "id", "vec", "label", folds=3))
    assert models.accuracy(held_out).first().score > 0.9


@pytest.mark.parametrize(
    "name, linear_points, tree_points",
    [("ml_cv_logistic", 3, 0), ("ml_cv_linear_svm", 5, 0), ("ml_cv_tree", 0, 324), ("ml_leaderboard", 8, 324)],
)
def test_registered_searches_cover_the_whole_grids(spark, monkeypatch, name, linear_points, tree_points):
    """All points of the grids, ten folds and one model on all rows, 100 steps."""
    fits, grown, scored = [], [], []

    def fit(blocks, settings, width, max_iter=100):
        fits.append((len(settings), max_iter))
        return np.zeros((len(settings), width + 1))

    def grow(rows, growths, depth, parallelism):
        grown.append((len(growths), len({g.fold for g in growths}), depth))
        return "nowhere"

    def hits(rows, folder, growths, depths, splits):
        scored.append(len({(g.impurity, g.leaf, g.features) for g in growths}) * len(depths) * len(splits))
        found = [SimpleNamespace(tree=i, depth=d, split=s, hits=1, n=1) for i in range(len(growths)) for d in depths for s in splits]
        return SimpleNamespace(collect=lambda: found)

    leaf = trees.Nodes(*(np.array([v]) for v in (-1, -1, 0, 0.0, 9, 1.0)))
    monkeypatch.setattr(linear, "fit", fit)
    monkeypatch.setattr(trees, "grow", grow)
    monkeypatch.setattr(trees, "hits", hits)
    monkeypatch.setattr(trees, "node_tables", lambda *a: {0: leaf})
    monkeypatch.setattr(registry, "_tuned_neighbours", lambda train, test: test.select("label", F.col("label").alias("predicted")))
    folds = registry._binary_rows(registry.Tables(spark, FOLDER))[0].select("fold").distinct().count()
    board = registry.QUERIES[name](spark, FOLDER)
    assert fits == ([(linear_points * (models.FOLDS + 1), 100)] if linear_points else [])
    assert scored == ([tree_points] if tree_points else [])
    assert grown == ([(2 * 3 * 2 * folds, folds, 18), (1, 1, 2)] if tree_points else [])
    if name != "ml_leaderboard":
        assert board.count() == linear_points + tree_points


# --- linear models in common passes -----------------------------------------------------------------------------------
@pytest.fixture(scope="module")
def noisy(spark):
    """Two overlapping clusters, four entries, three folds."""
    rng = np.random.default_rng(7)
    x = rng.normal(0, 1, (240, 4)) + np.arange(240)[:, None] % 2 * [0.8, 0.4, 0, -0.5]
    df = spark.createDataFrame([(i, [float(v) for v in r], i % 2) for i, r in enumerate(x)], "id long, vec array<double>, label int")
    return models.as_training_rows(df, "id", "vec", "label", folds=3).repartition(5).persist()


GRID = [linear.Setting(loss, c, fold) for loss in (linear.LOGISTIC, linear.HINGE) for c in (0.01, 1.0, 30.0) for fold in (-1, 0, 2)]


def test_common_passes_equal_separate_fits(noisy):
    blocks = linear.pack(noisy).persist()
    together = linear.fit(blocks, GRID, 4)
    for i in (0, 4, 9, 14, 17):
        alone = linear.fit(blocks, [GRID[i]], 4)[0]
        assert np.allclose(together[i], alone, rtol=1e-4, atol=1e-4)
        one, all_ = linear.totals(blocks, alone[None], [GRID[i]]), linear.totals(blocks, together[i][None], [GRID[i]])
        assert one["hits"] == all_["hits"] and one["rows"] == all_["rows"]


@pytest.mark.parametrize("c, fold", [(0.01, -1), (1.0, 1)])
def test_linear_models_reach_the_library_optimum(noisy, c, fold):
    noisy = noisy.coalesce(1).persist()
    rows = noisy.filter(F.col("fold") != fold).persist()
    penalty = 1 / (c * rows.count())
    blocks = linear.pack(noisy).persist()
    settings = [linear.Setting(linear.LOGISTIC, c, fold), linear.Setting(linear.HINGE, c, fold)]
    ours = linear.fit(blocks, settings, 4)
    smooth = LogisticRegression(elasticNetParam=0.0, standardization=False, regParam=penalty, tol=1e-8, maxIter=100).fit(rows)
    hinge = LinearSVC(standardization=False, regParam=penalty, maxIter=100, tol=1e-8).fit(rows)
    assert np.allclose(ours[0], [*smooth.coefficients, smooth.intercept], atol=2e-3)
    theirs = np.array([[*smooth.coefficients, smooth.intercept], [*hinge.coefficients, hinge.intercept]])

    def value(weights):
        return linear.totals(blocks, weights, settings)["loss"] * c + (weights[:, :-1] ** 2).sum(axis=1) / 2

    assert (value(ours) <= value(theirs) * (1 + 1e-4)).all()


def test_totals_are_gradients_and_add_up_over_any_number_of_parts(noisy, monkeypatch):
    blocks = linear.pack(noisy).persist()
    rng = np.random.default_rng(0)
    weights = rng.normal(size=(len(GRID), 5))
    base = linear.totals(blocks, weights, GRID, 5)
    smooth = [i for i, s in enumerate(GRID) if s.loss == linear.LOGISTIC]
    for entry in range(5):
        step = np.zeros(5)
        step[entry] = 1e-5
        up, down = (linear.totals(blocks, weights + sign * step, GRID)["loss"] for sign in (1, -1))
        assert np.allclose(((up - down) / 2e-5)[smooth], base["gradient"][smooth, entry], atol=1e-3)
    monkeypatch.setattr(linear, "FAN_IN", 2)
    again = linear.totals(blocks, weights, GRID, 5)
    assert all(np.allclose(base[k], again[k]) for k in base)
    assert linear.partial_totals(blocks, weights, np.zeros(len(GRID)), np.ones(len(GRID), bool), 5).count() <= 2
    assert sorted(set(base["rows"])) == sorted({float(noisy.filter(F.col("fold") != f).count()) for f in (-1, 0, 2)})


def test_odd_rows_of_linear_models(spark, noisy):
    nothing = linear.pack(noisy.filter("id < 0"))
    assert np.allclose(linear.fit(nothing, GRID[:2], 4), 0)
    one_class = linear.fit(linear.pack(noisy.filter("label = 1")), GRID[:4], 4, 20)
    assert np.isfinite(one_class).all() and (one_class[:, -1] > 0).all()
    model = linear.LinearModel((1.0, 0.0, 0.0, 0.0), -0.5)
    rows = [tuple(r) for r in model.transform(noisy).select(linear.vector_to_array("features")[0], "prediction").collect()]
    assert all(p == float(x > 0.5) for x, p in rows)


# --- trees grown once ---------------------------------------------------------------------------------------------------
def leaves_of(nodes, x, depth, split):
    out = []
    for row in x:
        at, d = 0, 0
        while d < depth and nodes.left[at] >= 0 and nodes.rows[at] >= split:
            at, d = (nodes.left if row[nodes.feature[at]] <= nodes.threshold[at] else nodes.right)[at], d + 1
        out.append(nodes.prediction[at])
    return out


@pytest.mark.parametrize("subset", [trees.ALL, trees.SQRT])
@pytest.mark.parametrize("parallelism", [1, 8])
def test_a_cut_tree_equals_a_tree_grown_to_that_depth(spark, noisy, subset, parallelism):
    growths = [trees.Growth(i, leaf, subset, fold) for i in ("gini", "entropy") for leaf in (1, 4) for fold in (0, 2)]
    noisy = noisy.coalesce(1).persist()
    tables = trees.node_tables(spark, trees.grow(noisy, growths, 9, parallelism), growths, range(len(growths)))
    assert sorted(tables) == list(range(len(growths)))
    x = np.array([r[0] for r in noisy.select(linear.vector_to_array("features")).collect()])
    for tree in (0, 6):
        g = growths[tree]
        cut = {(d, s): p for d, s, p in tables[tree].read(x, [1, 2, 5, 9], [2, 12])}
        for depth in (2, 5, 9):
            own = trees._estimator(g, depth).fit(noisy.filter(F.col("fold") != g.fold))
            expected = [r.prediction for r in own.transform(noisy).select("prediction").collect()]
            assert list(cut[depth, 2]) == expected
            assert list(cut[depth, 12]) == leaves_of(tables[tree], x, depth, 12)
    # The split minimum does cut something off.
    assert any(list(tables[t].read(x, [9], [2, 40]))[0][2].tolist() != list(tables[t].read(x, [9], [2, 40]))[1][2].tolist() for t in tables)


def test_tree_search_scores_held_out_rows(spark, noisy):
    found = models.tune_tree(noisy, depths=(1, 4), leaves=(1, 3), splits=(2, 30), folds=3)
    assert len(found.points) == len(found.avgMetrics) == 2 * 2 * 2 * 2 * 2
    at = found.points.index({"impurity": "gini", "maxDepth": 4, "minLeaf": 3, "minSplit": 2, "features": "all"})
    shares = []
    for fold in range(3):
        tree = trees._estimator(trees.Growth("gini", 3), 4).fit(noisy.filter(F.col("fold") != fold))
        shares.append(models.accuracy(tree.transform(noisy.filter(F.col("fold") == fold))).first().score)
    assert found.avgMetrics[at] == pytest.approx(np.mean(shares))
    assert models.accuracy(models.predict(found.bestModel, noisy)).first().score > 0.5


def test_neighbour_search_over_k_and_p(vectors):
    rows = vectors.withColumn("fold", (F.col("id") % 3).cast("int"))
    scores = neighbours.cross_validate(rows, ks=[1, 5]).collect()
    assert {(r.p, r.k) for r in scores} == {(1, 1), (1, 5), (2, 1), (2, 5)}
    assert scores[0].cv_accuracy == max(r.cv_accuracy for r in scores) > 0.9


def test_shares_and_dummies(spark):
    from tamarind.operators.summary import add_share

    groups = spark.createDataFrame([("a", 1), ("b", 1), ("c", 1)], "g string, n long")
    assert abs(sum(r.share_pct for r in add_share(groups, "n").collect()) - 100) < 0.05
    hot = features.one_hot(spark.createDataFrame([("x",), (None,), ("y",), ("x",)], "c string"), ["c"])
    assert all(sum(r) <= 1 for r in hot.collect())
