"""Linear problems solved side by side: conditions of the optimum, samples, and votes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchcast.operators import ensembles, learners, linear, sampling, selection, tuning
from matchcast.operators.binning import Sample

NAMES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def table(spark):
    draw = np.random.default_rng(9)
    x = draw.normal(size=(600, 4)) * [1, 50, 0.1, 3] + [5, -300, 0, 1e4]
    y = (x[:, 0] - 5 + (x[:, 1] + 300) / 40 + draw.normal(size=600) * 1.5 > 0).astype(int)
    rows = [(i, *map(float, r), int(t), i // 100 - 1, float(i % 4)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "game_id long, a double, b double, c double, d double, label int, fold int, w double").repartition(4).persist()


@pytest.fixture(scope="module")
def packed(table):
    return linear.pack(table, NAMES, "label", mark=F.col("fold"), weights=[F.col("w")])


def gradient(problem, solution, frame):
    """The gradient of the sum of losses in the problem's own scale, and the coefficients with the intercept first."""
    held = problem.sample.learns(frame["fold"].to_numpy())
    w = (frame["w"].to_numpy() if problem.sample.weight is not None else np.ones(len(frame))) * held
    x = frame[NAMES].to_numpy()
    means, deviations = np.zeros(4), np.ones(4)
    if problem.scaled:
        means = (w @ x) / w.sum()
        deviations = np.sqrt(w @ (x - means) ** 2 / w.sum())
    z = np.column_stack([np.ones(len(x)), (x - means) / deviations])
    b = np.concatenate([[solution.intercept], solution.coefficients])
    y, m = frame["label"].to_numpy(), z @ b
    if problem.kind == linear.LOGISTIC:
        slope = w * (1 / (1 + np.exp(-m)) - y)
    else:
        slope = -2 * w * (2 * y - 1) * np.maximum(1 - (2 * y - 1) * m, 0)
    return problem.strength * (z.T @ slope), b


PROBLEMS = [
    linear.Problem(strength=c, penalty=p, sample=s)
    for c, p, s in ((1.0, "l2", Sample()), (0.001, "l2", Sample(before=2)), (100.0, "l2", Sample(weight=0)), (0.05, "l1", Sample()), (10.0, "l1", Sample(before=3)))
] + [
    linear.Problem(linear.MARGIN), linear.Problem(linear.MARGIN, 10.0, sample=Sample(but=2, weight=0)), linear.Problem(strength=0.01, scaled=False),
    linear.Problem(columns=(0, 2)),
]


def test_solutions_meet_the_conditions_of_an_optimum(table, packed):
    frame = table.toPandas()
    solved = linear.solve(packed, PROBLEMS)
    for problem, solution in zip(PROBLEMS, solved):
        g, b = gradient(problem, solution, frame)
        near = 1e-5 * (1 + problem.strength * 600)
        used = [0, *(i + 1 for i in (problem.columns or range(4)))]
        if problem.kind == linear.MARGIN:
            assert np.abs(g + b).max() < near
        elif problem.penalty == "l2":
            assert abs(g[0]) < near and np.abs(g[1:] + b[1:])[np.array(used[1:]) - 1].max() < near
        else:
            zero = b[1:] == 0
            assert abs(g[0]) < near and (np.abs(g[1:][zero]) <= 1 + near).all()
            assert np.abs(g[1:][~zero] + np.sign(b[1:][~zero])).max(initial=0) < near
        assert solution.rounds < 40
    assert (solved[3].coefficients == 0).any() and (solved[8].coefficients[[1, 3]] == 0).all()


def test_side_by_side_is_one_by_one(packed):
    together = linear.solve(packed, PROBLEMS)
    for k in (0, 4, 6):
        alone = linear.solve(packed, [PROBLEMS[k]])[0]
        assert np.allclose(alone.coefficients, together[k].coefficients, atol=1e-7)
    warm = linear.solve(packed, [PROBLEMS[5]], {0: together[5]})[0]
    assert warm.rounds <= 2 and np.allclose(warm.coefficients, together[5].coefficients, atol=1e-7)


def test_scores_are_those_of_the_models(table, packed):
    problems = [linear.Problem(sample=Sample(before=i), scored=i, strength=c) for i in (1, 4) for c in (0.1, 1.0)]
    solved = linear.solve(packed, problems)
    got = {(r["fit"], r["key"]): (r["y"], r["p"]) for r in linear.scores(packed, problems, solved).collect()}
    assert len(got) == 400
    for k, (problem, solution) in enumerate(zip(problems, solved)):
        model, scaler = linear.as_model(packed, problem, solution)
        fitted = learners.Classifier("logistic_regression", NAMES, model, scaler)
        rows = fitted.score(table.where(F.col("fold") == problem.scored)).select(F.xxhash64("game_id").alias("key"), "label", "p").collect()
        assert all(got[k, r["key"]] == (r["label"], pytest.approx(r["p"], abs=1e-9)) for r in rows)


def test_one_class_and_no_rows(table):
    only = learners.fit_classifier(table.where("label = 1"), NAMES, "label")
    assert min(r["p"] for r in only.score(table).select("p").collect()) > 0.99
    none = learners.fit_classifier(table.where("false"), NAMES, "label", "linear_svm")
    assert none.score(table).count() == 600


def test_a_hundred_bootstrap_fits_vote(table):
    bag = ensembles.fit_bagging(table, NAMES, "label", "logistic_regression", n_estimators=100)
    assert len(bag.members) == 100
    voted = {r["game_id"]: r["prediction"] for r in ensembles.bootstrap_majority(table, bag.members).collect()}
    few = [7, 50]
    for i in few:
        alone = learners.fit_classifier(sampling.bootstrap_weight(table, i), NAMES, "label", weight="weight")
        assert np.allclose(alone.model.weights, bag.members[i].model.weights, atol=1e-6)
    frame = table.toPandas()
    x = frame[NAMES].to_numpy()
    raw = np.array([linear.raw_weights(m.model, m.scaler, NAMES) for m in bag.members])
    want = np.rint((raw[:, 0] + x @ raw[:, 1:].T > 0).mean(axis=1))
    assert [voted[i] for i in frame["game_id"]] == want.astype(int).tolist()
    single = {r["game_id"]: r["prediction"] for r in ensembles.bootstrap_majority(table, bag.members[:1]).collect()}
    classified = {r["game_id"]: r["prediction"] for r in bag.members[0].classify(table).collect()}
    assert single == classified


def test_a_search_solves_its_whole_space(table):
    found = tuning.grid_search(table, NAMES)
    rows = found.candidates.collect()
    assert len(rows) == 12 and rows[0]["cv_auc"] >= rows[-1]["cv_auc"] > 0.4
    slow = tuning._fitted_scores(table, NAMES, "label", "logistic_regression", [{"C": 0.1, "penalty": "l1"}], "fold", 5, 42)
    from matchcast.operators.metrics import auc

    mean = auc(slow.withColumn("run", F.lit("s"))).agg(F.avg("auc")).first()[0]
    got = next(r["cv_auc"] for r in rows if r["params"] == '{"C": 0.1, "penalty": "l1"}')
    assert got == pytest.approx(mean, abs=1e-6)


def test_elimination_by_a_support_vector_machine(table):
    ranks = {r["feature"]: r["rank"] for r in selection.eliminate_features(table, NAMES, "label", 1, "linear_svm").collect()}
    left = list(NAMES)
    for rank in (4, 3, 2):
        fitted = learners.fit_classifier(table, left, "label", "linear_svm")
        worst = left[int(np.argmin(np.abs(fitted.model.weights)))]
        assert ranks[worst] == rank
        left.remove(worst)
