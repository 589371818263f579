"""Forests: the same trees wherever a node is split, parts of a forest, and small known cases."""

import pickle

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from matchcast.durable import durable
from matchcast.operators import binning, forest, learners, selection, tuning
from matchcast.operators.binning import Sample

NAMES = [f"c{i}" for i in range(6)]


@pytest.fixture(scope="module")
def table(spark):
    draw = np.random.default_rng(4)
    x = np.round(draw.normal(size=(700, 6)), 2)
    x[:, 4] = draw.integers(0, 3, 700)
    y = (x[:, 0] + x[:, 1] * x[:, 2] + draw.normal(size=700) > 0).astype(int)
    rows = [(i, *map(float, r), int(t), int(i // 120) - 1, float(i % 3)) for i, (r, t) in enumerate(zip(x, y))]
    schema = "game_id long, " + ", ".join(f"{c} double" for c in NAMES) + ", label int, fold int, w double"
    return spark.createDataFrame(rows, schema).repartition(5).persist()


@pytest.fixture(scope="module")
def blocks(table):
    return binning.binned_blocks(table, NAMES, "label", F.col("fold"), [F.col("w")])


SHAPES = [
    forest.Shape(trees=3, seed=1, per_split=2, scored=3, sample=Sample(before=3), parts=((None, 2, 3), (2, 2, 3), (None, 30, 2))),
    forest.Shape(trees=2, seed=2, depth=3, leaf=9, sample=Sample(weight=0)),
    forest.Shape(trees=1, bootstrap=False, columns=(1, 2, 4), sample=Sample(but=1), scored=1, parts=((None, 2, 1),)),
]


def told(pool):
    scores = {(r["fit"], r["part"], r["key"]): (r["y"], round(r["p"], 12)) for r in pool.scores().collect()}
    return scores, pool.importances(len(NAMES))


@pytest.mark.parametrize("gather", [0, 60, 300])
def test_shared_levels_grow_the_same_trees(blocks, gather):
    whole, shared = forest.grow_pool(blocks, SHAPES), forest.grow_pool(blocks, SHAPES, gather)
    assert not whole.above and shared.above
    (a, ia), (b, ib) = told(whole), told(shared)
    assert a == b and len(a) == 120 * 3 + 120
    assert np.allclose(ia, ib, atol=1e-12)
    rows = np.random.default_rng(1).integers(0, 32, (500, 6)).astype(np.uint8)
    for i in range(len(SHAPES)):
        for one, other in zip(whole.trees(i), shared.trees(i), strict=True):
            assert len(one.feature) == len(other.feature) and (forest.walk(rows, one) == forest.walk(rows, other)).all()


@pytest.fixture
def written(monkeypatch):
    tables = []

    def kept(df):
        tables.append(durable(df))
        return tables[-1]

    monkeypatch.setattr(forest, "durable", kept)
    return tables


@pytest.mark.parametrize("gather, wave, waves", [(0, 1 << 27, 4), (60, 1 << 27, 1), (60, 1400, 2), (1 << 17, 1 << 27, 1)])
def test_importances_need_neither_rows_nor_nodes_written(blocks, written, monkeypatch, gather, wave, waves):
    shape = forest.Shape(trees=4, per_split=2, columns=(0, 1, 2, 4))
    whole = forest.grow_pool(blocks, [shape]).importances(len(NAMES))
    written.clear()
    monkeypatch.setattr(forest, "WAVE", wave)
    pool = forest.grow_pool(blocks, [shape], gather, gains_only=True)
    assert np.allclose(pool.importances(len(NAMES)), whole, atol=1e-12)
    assert len(written) == waves
    for table in written:
        assert "at" not in table.columns
        assert table.where("child IS NOT NULL OR size(feature) > 4").isEmpty()


def test_elimination_writes_no_nodes(table, written):
    ranks = selection.eliminate_features(table, NAMES, "label", keep=4, params={"n_estimators": 3}).collect()
    assert sorted(r["rank"] for r in ranks) == [1, 1, 1, 1, 2, 3]
    assert len(written) == 2 and all(t.where("child IS NOT NULL").isEmpty() for t in written)


@pytest.mark.parametrize("weight, arrays", [(1.0, 1), (float(1 << 22), 2), (0.3, 2)])
def test_packed_sums_find_the_best_splits(weight, arrays):
    draw = np.random.default_rng(7)
    bins, at, y = draw.integers(0, 8, (400, 3)).astype(np.uint8), draw.integers(0, 5, 400), draw.integers(0, 2, 400).astype(float)
    w = draw.integers(1, 4, 400) * weight
    sums = forest.Sums(w, w * y)
    assert len(sums.held) == arrays
    n, tw, ty = sums.by(at, 5)
    looked = np.tile(np.arange(3), (5, 1))
    found = forest.best_splits(bins.ravel(), np.arange(400) * 3, at, sums, looked, tw, ty, n, 8, 3)
    for node in range(5):
        here, best = at == node, (-np.inf, -1, 0)
        for f in range(3):
            for b in range(7):
                left, right = here & (bins[:, f] <= b), here & (bins[:, f] > b)
                if min(left.sum(), right.sum()) >= 3:
                    gain = sum((w * y)[s].sum() ** 2 / w[s].sum() for s in (left, right))
                    best = max(best, (round(gain, 6), f, b), key=lambda x: x[0])
        assert best == (round(found[0][node], 6), found[1][node], found[2][node])


def test_parts_are_forests_of_their_own(blocks):
    scores, _ = told(forest.grow_pool(blocks, SHAPES[:1]))
    for part, (depth, split, trees) in enumerate(SHAPES[0].parts):
        alone = forest.Shape(trees=trees, seed=1, per_split=2, depth=depth, split=split, scored=3, sample=Sample(before=3), parts=((depth, split, trees),))
        found, _ = told(forest.grow_pool(blocks, [alone]))
        assert {k: v for (_, _, k), v in found.items()} == {k: v for (_, p, k), v in scores.items() if p == part}


def slow_split(bins, y, w):
    best = None
    for f in range(bins.shape[1]):
        for b in range(32):
            left = bins[:, f] <= b
            if (w[left] > 0).any() and (w[~left] > 0).any():
                gain = sum((w[s] @ y[s]) ** 2 / w[s].sum() for s in (left, ~left))
                if best is None or gain > best[0] + 1e-12:
                    best = (gain, f, b)
    return best


def test_root_split_is_the_best_one(table, blocks):
    frame = table.toPandas()
    bins = binning.binned(frame[NAMES].to_numpy(float), blocks.edges)
    for weight in (None, 0):
        shape = forest.Shape(trees=1, depth=1, bootstrap=False, sample=Sample(weight=weight))
        for gather in (0, 10**6):
            tree = forest.grow_pool(blocks, [shape], gather).trees(0)[0]
            w = np.ones(len(frame)) if weight is None else frame["w"].to_numpy()
            assert (tree.feature[0], tree.split[0]) == slow_split(bins, frame["label"].to_numpy(float), w)[1:]
            left = bins[:, tree.feature[0]] <= tree.split[0]
            want = [(w * frame["label"])[s].sum() / w[s].sum() for s in (left, ~left)]
            assert np.allclose(tree.value[tree.child[0] : tree.child[0] + 2], want)


def test_limits_hold(blocks):
    tree = forest.grow_pool(blocks, [forest.Shape(trees=1, leaf=20, split=90, depth=4)]).trees(0)[0]
    inner = tree.feature >= 0
    assert (tree.size[~inner] >= 20).all() and (tree.size[inner] >= 90).all() and inner.sum() <= 15
    whole = forest.grow_pool(blocks, [forest.Shape(trees=1, bootstrap=False)]).trees(0)[0]
    assert whole.size[0] == 700 and set(np.round(whole.value[whole.feature < 0], 6)) >= {0.0, 1.0}


def test_a_forest_as_a_learner(spark, table, tmp_path):
    fitted = learners.fit_classifier(table, NAMES, "label", "random_forest", {"n_estimators": 20})
    scored = fitted.score(table).select("game_id", "label", "p").collect()
    right = np.mean([(r["p"] > 0.5) == (r["label"] == 1) for r in scored])
    assert right > 0.95
    learners.save_classifier(spark, str(tmp_path / "f"), fitted)
    loaded = learners.load_classifier(spark, str(tmp_path / "f")).classifier
    again = {r["game_id"]: r["p"] for r in loaded.score(table).select("game_id", "p").collect()}
    assert again == {r["game_id"]: r["p"] for r in scored}
    repeated = learners.fit_classifier(table.repartition(3), NAMES, "label", "random_forest", {"n_estimators": 20})
    assert [r["p"] for r in repeated.score(table).orderBy("game_id").collect()] == [r["p"] for r in sorted(scored, key=lambda r: r["game_id"])]
    with pytest.raises(ValueError, match="no rows"):
        learners.fit_classifier(table.where("false"), NAMES, "label", "random_forest", {"n_estimators": 2})
    one_class = learners.fit_classifier(table.where("label = 1"), NAMES, "label", "random_forest", {"n_estimators": 2})
    assert {r["p"] for r in one_class.score(table).select("p").collect()} == {1.0}


def test_a_search_of_forests_shares_them(table):
    space = {"n_estimators": [3, 6], "max_depth": [None, 2], "min_samples_split": [2, 20], "min_samples_leaf": [1, 5]}
    found = tuning.grid_search(table, NAMES, space, name="random_forest", folds=3)
    rows = {r["params"]: r["cv_auc"] for r in found.candidates.collect()}
    assert len(rows) == 16 and min(rows.values()) > 0.5
    slow = tuning._fitted_scores(table, NAMES, "label", "random_forest", [tuning.expand_grid(space)[5]], "fold", 3, 42)
    from matchcast.operators.metrics import auc

    mean = auc(slow.withColumn("run", F.lit("s"))).agg(F.avg("auc")).first()[0]
    import json

    # Bins are cut once for all folds in the search, and per fold in a single fit.
    assert rows[json.dumps(tuning.expand_grid(space)[5])] == pytest.approx(mean, abs=0.05)


def test_stability_and_elimination_share_the_bins(table):
    ranks = {r["feature"]: r["rank"] for r in selection.eliminate_features(table, NAMES, "label", 2, params={"n_estimators": 10}).collect()}
    assert sorted(ranks.values()) == [1, 1, 2, 3, 4, 5] and ranks["c4"] > 1
    rows = selection.importance_stability(table, NAMES, "label", params={"n_estimators": 10}, iterations=4).collect()
    assert rows[0]["feature"] in ("c0", "c1", "c2") and sum(r["mean"] for r in rows) == pytest.approx(1)
    assert all(0 < r["std"] < 0.1 for r in rows)


def test_a_forest_is_told_without_classes_of_the_package(spark, monkeypatch):
    """Executors need not have the package, which a broadcast of its classes would ask for."""
    columns = [0, -1, -1], [0, 0, 0], [1, 0, 0], [0.0, 0.25, 0.75], [4, 2, 2], [1.0, 0.0, 0.0]
    tree = forest.Grown(*map(np.array, columns))
    sent, context = [], type(spark.sparkContext)
    monkeypatch.setattr(context, "broadcast", lambda self, value, send=context.broadcast: sent.append(value) or send(self, value))
    rows = spark.createDataFrame([(Vectors.dense([-1.0]),), (Vectors.dense([2.0]),)], ["v"])
    scored = forest.ForestModel([np.array([0.5])], [tree, tree], [1.0]).transform(rows, "v", "probability", "predicted")
    assert sorted((float(r["probability"][1]), r["predicted"]) for r in scored.collect()) == [(0.25, 0.0), (0.75, 1.0)]
    assert len(sent) == 1 and b"matchcast" not in pickle.dumps(sent)


def test_a_forest_beyond_what_is_told_scores_where_it_was_grown(spark, table, tmp_path, monkeypatch):
    fit = lambda: forest.fit_forest(table, NAMES, "label", learners.full_params("random_forest", {"n_estimators": 5}), gather=60)
    vectors = learners._assemble(table, NAMES, None)

    def scored(model):
        rows = model.transform(vectors, learners.FEATURES, "probability", "predicted").collect()
        return {r["game_id"]: (round(float(r["probability"][1]), 9), r["predicted"]) for r in rows}

    told = fit()
    monkeypatch.setattr(forest, "HELD_NODES", 300)
    spread = fit()
    monkeypatch.setattr(forest, "WAVE", 700 * 3)  # three trees at a time
    monkeypatch.setattr(forest, "MET_ROWS", 20)
    assert told.spread is None and spread.trees == [] and spread.importances == told.importances
    assert scored(spread) == scored(told)
    spread.save(str(tmp_path / "f"), spark)
    loaded = forest.ForestModel.load(spark, str(tmp_path / "f"))
    assert loaded.spread is not None and scored(loaded) == scored(told)
