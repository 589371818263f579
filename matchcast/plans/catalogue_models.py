"""Registered queries over fitted models, feature analysis, voting and sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchcast.functions.derive import derive_features
from matchcast.functions.encode import encode_target, numeric_columns
from matchcast.operators import bayes, binning, ensembles, forest, information, isotonic, knn, learners, sampling, selection, tuning
from matchcast.operators.splits import temporal_split
from matchcast.plans import experiment, scoring
from matchcast.plans.catalogue import _first_date, _scores, _scratch, registered, rounded
from matchcast.plans.prepare import LABEL, Prepared, prepare_train_test
from matchcast.sources import readers
from matchcast.sources.games import load_games, read


def _prepared(spark, sf_dir) -> Prepared:
    return prepare_train_test(load_games(spark, sf_dir))


# --- feature analysis ------------------------------------------------------------------------


@registered
def corr_pairs(spark, sf_dir):
    games = derive_features(load_games(spark, sf_dir))
    table = selection.correlations(games, numeric_columns(games, ["game_id"]))
    return table.select("feature_a", "feature_b", *rounded("correlation"))


@registered
def corr_filter(spark, sf_dir):
    prepared = _prepared(spark, sf_dir)
    dropped = set(selection.correlated_columns(prepared.train, prepared.features))
    return spark.createDataFrame(
        [(c, c in dropped) for c in prepared.features], "feature string, dropped boolean"
    )


@registered
def anova_f(spark, sf_dir):
    prepared = _prepared(spark, sf_dir)
    table = selection.anova_f(prepared.train, prepared.features, LABEL)
    return table.select("feature", *rounded("score", digits=4))


@registered
def mutual_info(spark, sf_dir):
    prepared = _prepared(spark, sf_dir)
    table = selection.mutual_information(prepared.train, prepared.features, LABEL)
    return table.select("feature", *rounded("score"))


@registered
def neighbour_info(spark, sf_dir):
    prepared = _prepared(spark, sf_dir)
    table = information.neighbour_information(prepared.train, prepared.features, LABEL)
    return table.select("feature", *rounded("score"))


@registered
def rank_features(spark, sf_dir):
    prepared = _prepared(spark, sf_dir)
    kept, ranked = selection.select_k_best(
        prepared.train, prepared.features, LABEL, 15, "f_classif"
    )
    return ranked.select("feature", "rank", F.col("feature").isin(kept).alias("kept"))


@registered
def rfe(spark, sf_dir):
    prepared = _prepared(spark, sf_dir)
    return selection.eliminate_features(prepared.train, prepared.features, LABEL)


@registered
def rfe_linear(spark, sf_dir):
    prepared = _prepared(spark, sf_dir)
    return selection.eliminate_features(prepared.train, prepared.features, LABEL, name="linear_svm")


@registered
def analyse_features(spark, sf_dir):
    """Features ranked by mutual information and by elimination down to ten."""
    by_information, eliminated = experiment.analyse_features(_prepared(spark, sf_dir))
    ranked = by_information.select(F.lit("mutual_information").alias("method"), "feature", "rank")
    return ranked.unionByName(eliminated.select(F.lit("elimination").alias("method"), "feature", "rank"))


@registered
def feature_importance(spark, sf_dir):
    prepared = _prepared(spark, sf_dir)
    fitted = learners.fit_classifier(prepared.train, prepared.features, LABEL, "random_forest")
    return learners.feature_importance(spark, fitted)


@registered
def stability(spark, sf_dir):
    prepared = _prepared(spark, sf_dir)
    return selection.importance_stability(prepared.train, prepared.features, LABEL)


# --- one model at a time ---------------------------------------------------------------------


def _test_scores(spark, sf_dir, name: str, params: dict) -> DataFrame:
    prepared = _prepared(spark, sf_dir)
    fitted = learners.fit_classifier(prepared.train, prepared.features, LABEL, name, params)
    return fitted.score(prepared.test).select("game_id", LABEL, "p")


@registered
def lr_scores(spark, sf_dir):
    return _test_scores(spark, sf_dir, "logistic_regression", {})


@registered
def rf_scores(spark, sf_dir):
    return _test_scores(spark, sf_dir, "random_forest", {})


@registered
def forest_levels(spark, sf_dir):
    """The splits of the first two levels of a tree over all rows and features, from the shared histograms."""
    prepared = _prepared(spark, sf_dir)
    edges = binning.exact_edges(prepared.train, prepared.features)
    blocks = binning.binned_blocks(prepared.train, prepared.features, LABEL, edges=edges)
    pool = forest.grow_pool(blocks, [forest.Shape(trees=1, depth=2, bootstrap=False)], gather=0)
    blocks.release()
    rows = [(a["node"], prepared.features[a["feature"]], a["split"], a["decrease"]) for a in pool.above if "feature" in a]
    table = spark.createDataFrame(rows, "node long, feature string, bin int, decrease double")
    return table.select("node", "feature", "bin", *rounded("decrease", digits=4))


@registered
def gbt_scores(spark, sf_dir):
    return _test_scores(spark, sf_dir, "gradient_boosting", {})


@registered
def mlp_scores(spark, sf_dir):
    return _test_scores(spark, sf_dir, "mlp", {})


@registered
def nb_scores(spark, sf_dir):
    # Sums of squares in the fit leave about nine digits of a variance, fewer in a probability.
    scores = _test_scores(spark, sf_dir, "naive_bayes", {})
    return scores.select("game_id", LABEL, *rounded("p", digits=4))


@registered
def svc_scores(spark, sf_dir):
    return _test_scores(spark, sf_dir, "linear_svm", {})


# --- neighbours and votes --------------------------------------------------------------------


@registered
def knn_neighbours(spark, sf_dir):
    rows = read(spark, sf_dir, "embeddings")
    near = knn.nearest(rows, rows, 5, "embedding", "vec_id", "label", leave_self_out=True)
    return near.select("vec_id", "neighbour", "label", "place", *rounded("distance"))


@registered
def knn_vote(spark, sf_dir):
    rows = read(spark, sf_dir, "embeddings")
    near = knn.nearest(rows, rows, 5, "embedding", "vec_id", "label", leave_self_out=True)
    return knn.vote(near, "vec_id").select("vec_id", "prediction", *rounded("share"))


@registered
def knn_vote_distance(spark, sf_dir):
    rows = read(spark, sf_dir, "embeddings")
    near = knn.nearest(
        rows, rows, 7, "embedding", "vec_id", "label", "manhattan", leave_self_out=True
    )
    return knn.vote(near, "vec_id", "distance").select("vec_id", "prediction", *rounded("share"))


@registered
def knn_game_scores(spark, sf_dir):
    prepared = _prepared(spark, sf_dir)
    scored = knn.knn_scores(prepared.train, prepared.test, prepared.features, LABEL)
    return scored.select("game_id", LABEL, *rounded("p"))


VOTE_WEIGHTS = {"balanced": 2.0, "form": 1.0, "strength": 1.0}


@registered
def soft_vote(spark, sf_dir):
    voted = ensembles.vote_rows(_scores(spark, sf_dir), VOTE_WEIGHTS)
    return voted.select(*ensembles.GAME, "y", *rounded("p"))


@registered
def hard_vote(spark, sf_dir):
    return ensembles.vote_rows(_scores(spark, sf_dir), voting="hard")


@registered
def voting_ensemble(spark, sf_dir):
    prepared = _prepared(spark, sf_dir)
    models = [("logistic_regression", {}), ("naive_bayes", {})]
    fitted = ensembles.fit_voting(prepared.train, prepared.features, models, LABEL)
    return fitted.score(prepared.test).select("game_id", LABEL, "p")


@registered
def stack(spark, sf_dir):
    prepared = _prepared(spark, sf_dir)
    models = [("naive_bayes", {}), ("random_forest", {})]
    fitted = ensembles.fit_stacking(prepared.train, prepared.features, models, LABEL)
    return fitted.score(prepared.test).select("game_id", LABEL, "p")


@registered
def bag(spark, sf_dir):
    prepared = _prepared(spark, sf_dir)
    fitted = ensembles.fit_bagging(
        prepared.train, prepared.features, LABEL, "naive_bayes", n_estimators=10
    )
    return fitted.score(prepared.test).select("game_id", LABEL, *rounded("p", digits=4))


@registered
def bootstrap_majority(spark, sf_dir):
    prepared = _prepared(spark, sf_dir)
    fitted = ensembles.fit_bagging(
        prepared.train, prepared.features, LABEL, "naive_bayes", n_estimators=10
    )
    voted = ensembles.bootstrap_majority(prepared.test, fitted.members)
    return voted.select("game_id", LABEL, "prediction")


@registered
def bootstrap_logistic(spark, sf_dir):
    """The class that most of 100 logistic regressions give, each fitted on a bootstrap sample."""
    prepared = _prepared(spark, sf_dir)
    fitted = ensembles.fit_bagging(prepared.train, prepared.features, LABEL, "logistic_regression", n_estimators=100)
    return ensembles.bootstrap_majority(prepared.test, fitted.members).select("game_id", LABEL, "prediction")


@registered
def calibrate(spark, sf_dir):
    prepared = _prepared(spark, sf_dir)
    fitted = ensembles.fit_calibrated(prepared.train, prepared.features, LABEL, "naive_bayes")
    return fitted.score(prepared.test).select("game_id", LABEL, "p")


@registered
def isotonic_curve(spark, sf_dir):
    """The calibrated value of each score, to three digits, of the balanced model."""
    rows = _scores(spark, sf_dir).where("model = 'balanced'").withColumn("score", F.round("p", 3))
    weighted = isotonic.points(rows, "score", "y")
    curve = isotonic.fit_curve(weighted)
    return curve.apply(weighted, "score", "calibrated").select("score", *rounded("calibrated"))


@registered
def bayes_out_of_fold(spark, sf_dir):
    """Each training game's probability by naive Bayes over the other folds."""
    prepared = _prepared(spark, sf_dir)
    scored = bayes.out_of_fold(prepared.train, prepared.features, LABEL, "fold")
    return scored.select("game_id", LABEL, "fold", *rounded("p", digits=4))


# --- search, comparison, scoring jobs --------------------------------------------------------


@registered
def grid_search(spark, sf_dir):
    prepared = _prepared(spark, sf_dir)
    found = tuning.grid_search(prepared.train, prepared.features, label=LABEL)
    return found.candidates


@registered
def random_search(spark, sf_dir):
    prepared = _prepared(spark, sf_dir)
    found = tuning.random_search(prepared.train, prepared.features, label=LABEL, name="random_forest")
    return found.candidates


MODELS = experiment.recommended_models() | {name: (name, {}) for name in ("naive_bayes", "knn")}


@registered
def compare_models(spark, sf_dir):
    return experiment.compare_models(_prepared(spark, sf_dir), MODELS).rankings


@registered
def experiment_verdict(spark, sf_dir):
    """The whole workflow: compare, pick, back-test, export, store the winner."""
    path = _scratch(spark, "experiment")
    _, verdict = experiment.run_experiment(
        load_games(spark, sf_dir), MODELS, path, financial=True
    )
    return verdict


def _stored_model(spark, sf_dir) -> tuple[DataFrame, str]:
    games = load_games(spark, sf_dir)
    prepared = prepare_train_test(games)
    fitted = learners.fit_classifier(prepared.train, prepared.features, LABEL, "naive_bayes")
    path = _scratch(spark, "model")
    ensembles.save_model(spark, path, fitted, prepared.state)
    return games, path


V1_FEATURES = [
    f"{side}_{name}"
    for side in ("home", "away")
    for name in (
        "team_rank", "days_rest", "team_avg_pts_scored", "team_avg_pts_scored_opp", "team_win_pct",
        "team_win_pct_last10",
    )
]


@registered
def score_v1(spark, sf_dir):
    games = load_games(spark, sf_dir).fillna(0.0, V1_FEATURES)
    train = encode_target(temporal_split(games)).where(~F.col("is_test"))
    fitted = learners.fit_classifier(train, V1_FEATURES, "outcome", "naive_bayes")
    path = _scratch(spark, "model-v1")
    learners.save_classifier(spark, path, fitted)
    loaded = learners.load_classifier(spark, path).classifier
    keys = ["game_date", "home_team"]
    day = scoring.readers.leading_date(games, keys).first()[0]
    scored = scoring.score_v1(games, loaded, day, keys)
    return scored.select("game_id", scoring.HOME_PROBABILITY, scoring.AWAY_PROBABILITY)


@registered
def score_v2(spark, sf_dir):
    games, path = _stored_model(spark, sf_dir)
    artifacts, day = ensembles.load_model(spark, path), _first_date(spark, sf_dir)
    scored = scoring.score_v2(games, artifacts, day, mark_stale=True)
    return scored.select("game_id", scoring.HOME_PROBABILITY, scoring.AWAY_PROBABILITY, "stale")


@registered
def nightly(spark, sf_dir):
    """Where the nightly job stops with its flag off, without games and with both, and what it stores."""
    games, model = _stored_model(spark, sf_dir)
    day, path = _first_date(spark, sf_dir), _scratch(spark, "nightly")
    flags = read(spark, sf_dir, "nation").where("n_nationkey < 1").select(
        F.col("n_nationkey").alias("id"), F.lit(scoring.SEASON_FLAG).alias("flag"), F.lit(1).alias("is_enabled")
    )
    runs = {
        "flag off": (games, flags.withColumn("is_enabled", F.lit(0))),
        "no games": (games.where(F.lit(False)), flags),
        "all": (games, flags),
    }
    states = [
        (name, scoring.nightly(spark, part, switch, model, path, day, 2)) for name, (part, switch) in runs.items()
    ]
    stored = readers.read_table(spark, path).agg(F.count("*").alias("stored"), F.count("created_at").alias("stamped"))
    return spark.createDataFrame(states, "run string, state string").join(
        F.broadcast(stored), F.col("run") == "all", "left"
    )


@registered
def train_models(spark, sf_dir):
    """Models searched, trained and calibrated by folds, the best on the test rows first.

    Those whose searches share their passes; a search of boosting or the network is a hundred fits of their own.
    """
    models = {name: (name, {}) for name in ("logistic_regression", "random_forest", "naive_bayes")}
    return experiment.train_models(_prepared(spark, sf_dir), models, "random", calibrate=True)[0]


# --- sampling --------------------------------------------------------------------------------


@registered
def bootstrap(spark, sf_dir):
    games = load_games(spark, sf_dir).select("game_id")
    return sampling.bootstrap(games, 3).select("game_id", "iteration", "weight")


@registered
def bootstrap_sizes(spark, sf_dir):
    games = load_games(spark, sf_dir).select("game_id", "home_team_win_pct")
    drawn = sampling.repeat_rows(sampling.bootstrap(games, 10))
    return drawn.groupBy("iteration").agg(
        F.count("*").alias("n"), F.round(F.avg("home_team_win_pct"), 6).alias("mean_win_pct")
    )


@registered
def bootstrap_exact(spark, sf_dir):
    games = load_games(spark, sf_dir).select("game_id")
    return sampling.exact_bootstrap(games, 3).select("game_id", "iteration", "weight")


@registered
def bootstrap_exact_sizes(spark, sf_dir):
    games = load_games(spark, sf_dir).select("game_id", "home_team_win_pct")
    drawn = sampling.repeat_rows(sampling.exact_bootstrap(games, 10))
    return drawn.groupBy("iteration").agg(
        F.count("*").alias("n"), F.round(F.avg("home_team_win_pct"), 6).alias("mean_win_pct")
    )


@registered
def augment_exact(spark, sf_dir):
    """How often each game is copied, of exactly half as many copies as there are games, and what the copies keep."""
    grown = sampling.augment(load_games(spark, sf_dir), exact=True)
    copies = grown.where("is_synthetic").groupBy("game_id", "home_team_rank", "outcome").agg(F.count("*").alias("copies"))
    return copies


@registered
def augment(spark, sf_dir):
    return sampling.augment(load_games(spark, sf_dir))


@registered
def synth_games(spark, sf_dir):
    return sampling.synthetic_games(read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("game_id")))


@registered
def win_probability(spark, sf_dir):
    games = load_games(spark, sf_dir).withColumns(
        {
            "home_pct_vorp_missing": (F.col("game_id") % 40) / 100.0,
            "away_pct_vorp_missing": (F.col("game_id") % 25) / 100.0,
        }
    )
    p = sampling.win_probability(F.col("home_team_win_pct"), F.col("away_team_win_pct"))
    return games.select("game_id", F.round(p, 6).alias("p"))
