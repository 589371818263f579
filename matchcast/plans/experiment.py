"""Model comparison, training with search and calibration, and the whole experiment."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchcast.durable import durable
from matchcast.operators import backtest, compare, metrics
from matchcast.operators.ensembles import Calibrated, fit_calibrated, save_model
from matchcast.operators.learners import (
    RECOMMENDED,
    Classifier,
    fit_classifier,
    in_parallel,
    learner,
)
from matchcast.operators.selection import eliminate_features, mutual_information, rank_by_score
from matchcast.operators.tuning import N_ITER, grid_search, random_search
from matchcast.plans.ledger import Ledger
from matchcast.plans.prepare import LABEL, Prepared, prepare_train_test
from matchcast.sources.writers import export_csv

RUN_CV, RUN_TEST = "cv", "test"
Models = dict[str, tuple[str, dict[str, Any]]]


def recommended_models(params: dict[str, dict[str, Any]] | None = None) -> Models:
    return {name: (name, (params or {}).get(name, {})) for name in RECOMMENDED}


@dataclass
class Comparison:
    scores: DataFrame
    metrics: DataFrame
    rankings: DataFrame
    statistical_tests: DataFrame
    best_name: str
    improvement_over_baseline: float
    classifiers: dict[str, Classifier] = field(default_factory=dict)


def compare_models(
    prepared: Prepared,
    models: Models,
    folds: int = 5,
    seed: int = 42,
    fold: str = "fold",
    expanding: bool = True,
    ledger: str | None = None,
) -> Comparison:
    """Validate every model on every fold, refit on all training rows, score the test rows.

    All scores go into one long table, so the metrics of every model and fold are one job. With
    ``expanding`` a fold is trained on earlier rows only, otherwise on all other folds. ``ledger`` names a folder in which
    each fit's result stays: a run that was cut off and is started again fits what is left.
    """
    features = prepared.features
    rows = prepared.rows.select("game_id", *features, LABEL, fold, "is_test").persist()
    train = rows.where(~F.col("is_test"))

    def scored(classifier: Classifier, part: DataFrame, run: str, model: str, number: int) -> DataFrame:
        return classifier.score(part).select(
            F.lit(run).alias("run"), F.lit(model).alias("model"), F.lit(number).alias("fold"),
            "game_id", F.col(LABEL).cast("int").alias("y"), "p",
        )

    def fit(model: str, number: int | None) -> tuple[Classifier, DataFrame]:
        name, params = models[model]
        if number is None:
            fitted = fit_classifier(train, features, LABEL, name, params, seed=seed)
            return fitted, scored(fitted, rows.where("is_test"), RUN_TEST, model, 0)
        seen = F.col(fold) < number if expanding else F.col(fold) != number
        fitted = fit_classifier(train.where(seen), features, LABEL, name, params, seed=seed)
        return fitted, scored(fitted, train.where(F.col(fold) == number), RUN_CV, model, number)

    def one(task: tuple[str, int | None]) -> tuple[str, Classifier | None, DataFrame]:
        model, number = task
        if book is None:
            fitted, part = fit(model, number)
        else:
            what = {"model": model, "learner": models[model][0], "params": models[model][1], "fold": number}
            fitted, part = book.result(what, number is None, lambda: fit(model, number))
        return model, fitted if number is None else None, part

    try:
        book = Ledger(ledger, rows, features=features, seed=seed, expanding=expanding) if ledger else None
        tasks = [(m, i) for m in models for i in (*range(folds), None)]
        done = in_parallel(rows.sparkSession, one, tasks)
        scores = durable(reduce(DataFrame.unionByName, (s for _, _, s in done)))
    finally:
        rows.unpersist()
    evaluated = durable(metrics.evaluate(scores))
    cv = evaluated.where(F.col("run") == RUN_CV)
    board = compare.leaderboard(
        compare.fold_summary(cv), evaluated.where(F.col("run") == RUN_TEST)
    )
    best = compare.best_model(board).first()
    return Comparison(
        scores,
        evaluated,
        board,
        compare.paired_ttest(cv),
        best["model"],
        best["improvement_over_baseline"],
        {m: c for m, c, _ in done if c is not None},
    )


@dataclass
class Training:
    name: str
    model: Classifier | Calibrated
    params: dict[str, Any]
    cv_metrics: dict[str, float]
    test_metrics: dict[str, Any]


def train_model(
    prepared: Prepared,
    name: str,
    params: dict[str, Any] | None = None,
    tune: str | None = None,
    space: dict[str, list] | None = None,
    n_iter: int = N_ITER,
    calibrate: bool = False,
    folds: int = 5,
    seed: int = 42,
) -> Training:
    """Train one model, searched (``grid`` or ``random``) and calibrated if asked for."""
    features, train = prepared.features, prepared.train
    chosen = dict(params or {})
    if tune is not None and (space or learner(name).space):
        if tune not in ("grid", "random"):
            raise ValueError(f"tune is grid or random, not {tune!r}")
        options = {"name": name, "folds": folds, "seed": seed}
        found = (
            grid_search(train, features, space, **options)
            if tune == "grid"
            else random_search(train, features, space, n_iter, **options)
        )
        chosen, model = found.best_params, found.best
    else:
        model = fit_classifier(train, features, LABEL, name, chosen, seed=seed)
    if calibrate and learner(name).probabilities:
        model = fit_calibrated(train, features, LABEL, name, chosen, folds=folds, seed=seed)

    def scored(fitted, part: DataFrame, run: str, number: int) -> DataFrame:
        return fitted.score(part).select(
            F.lit(run).alias("run"), F.lit(name).alias("model"), F.lit(number).alias("fold"),
            F.col(LABEL).cast("int").alias("y"), "p",
        )

    calibrated = isinstance(model, Calibrated)

    def validate(number: int) -> DataFrame:
        earlier = train.where(F.col("fold") < number)
        if calibrated:
            # Folds before this one calibrate; the rows before the first fold only train.
            fitted = fit_calibrated(earlier, features, LABEL, name, chosen, folds=number, seed=seed)
        else:
            fitted = fit_classifier(earlier, features, LABEL, name, chosen, seed=seed)
        return scored(fitted, train.where(F.col("fold") == number), RUN_CV, number)

    # The first fold has none before it to calibrate on.
    numbers = list(range(1 if calibrated else 0, folds))
    parts = in_parallel(train.sparkSession, validate, numbers)
    parts.append(scored(model, prepared.test, RUN_TEST, 0))
    evaluated = durable(metrics.evaluate(reduce(DataFrame.unionByName, parts)))
    cv = evaluated.where(F.col("run") == RUN_CV).agg(
        F.avg("accuracy").alias("cv_accuracy"),
        F.avg("auc").alias("cv_auc"),
        F.avg("brier").alias("cv_brier"),
    )
    test = evaluated.where(F.col("run") == RUN_TEST).first().asDict()
    return Training(name, model, chosen, cv.first().asDict(), test)


def train_models(
    prepared: Prepared,
    models: Models,
    tune: str | None = None,
    calibrate: bool = False,
    folds: int = 5,
    seed: int = 42,
    **options: Any,
) -> tuple[DataFrame, Training]:
    """Train each model as ``train_model`` does and keep the best by AUC on the test rows.

    Returns one row per model with its metrics, the best first; a model without AUC comes last.
    """
    done = {
        m: train_model(prepared, name, params, tune, calibrate=calibrate, folds=folds, seed=seed, **options)
        for m, (name, params) in models.items()
    }
    order = sorted(done, key=lambda m: (done[m].test_metrics["auc"] is None, -(done[m].test_metrics["auc"] or 0.0), m))
    kept = ("accuracy", "auc", "brier", "log_loss")
    rows = [
        (i, m, *(done[m].cv_metrics[f"cv_{c}"] for c in kept[:3]), *(done[m].test_metrics[c] for c in kept))
        for i, m in enumerate(order, start=1)
    ]
    cv, test = (", ".join(f"{run}_{c} double" for c in names) for run, names in (("cv", kept[:3]), ("test", kept)))
    table = prepared.rows.sparkSession.createDataFrame(rows, f"rank int, model string, {cv}, {test}")
    return table, done[order[0]]


def production_readiness(
    model: Classifier | Calibrated,
    prepared: Prepared,
    games: DataFrame | None = None,
    name: str = "production_candidate",
    **limits: float,
) -> tuple[DataFrame, DataFrame]:
    """The checks of one model on the test rows, and its metrics there.

    Given the raw ``games``, it is also back-tested on their odds (not the imputed ones), which are
    joined by key.
    """
    by = ["run", "model"]
    scores = durable(
        model.score(prepared.test).select(
            F.lit(RUN_TEST).alias("run"), F.lit(name).alias("model"), "game_id",
            F.col(LABEL).cast("int").alias("y"), "p",
        )
    )
    final = metrics.evaluate(scores, by)
    profit = None
    if games is not None:
        profit = backtest.kelly_backtest(backtest.with_odds(scores, games), by)
    return durable(compare.readiness(final, profit, **limits)), final


def run_experiment(
    games: DataFrame,
    models: Models | None = None,
    output_dir: str | None = None,
    tune: bool = False,
    financial: bool = False,
    folds: int = 5,
    test_size: float = 0.2,
    seed: int = 42,
) -> tuple[Comparison, DataFrame]:
    """Prepare, compare, tune the winner if asked, check readiness, write the results.

    With a folder to write to, every fit is put down there as soon as it is done, for a run that has to be started again.
    """
    prepared = prepare_train_test(games, test_size, folds)
    ledger = f"{output_dir}/ledger" if output_dir else None
    comparison = compare_models(prepared, models or recommended_models(), folds, seed, ledger=ledger)
    winner = comparison.best_name
    name, params = (models or recommended_models())[winner]
    model: Classifier | Calibrated = comparison.classifiers[winner]
    if tune:
        model = train_model(prepared, name, params, "random", folds=folds, seed=seed).model
    verdict, final = production_readiness(
        model, prepared, games if financial else None, winner
    )
    if output_dir is not None:
        export_csv(comparison.rankings.orderBy("rank"), f"{output_dir}/rankings")
        numbers = {
            k: v for k, v in final.first().asDict().items() if isinstance(v, (int, float))
        }
        save_model(
            games.sparkSession, f"{output_dir}/production_model", model, prepared.state, numbers
        )
    return comparison, verdict


def analyse_features(
    prepared: Prepared, keep: int = 10, params: dict[str, Any] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Features ranked by mutual information, and by recursive elimination with a forest."""
    by_information = rank_by_score(mutual_information(prepared.train, prepared.features, LABEL))
    eliminated = eliminate_features(
        prepared.train, prepared.features, LABEL, keep, "random_forest", params
    )
    return by_information, eliminated
