"""Registered queries: each operator run over the supplied tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchcast.durable import scratch_folder
from matchcast.functions import encode, odds
from matchcast.functions.derive import derive_features, fatigue_index, log_skewed
from matchcast.operators import backtest, compare, metrics
from matchcast.operators.impute import fit_standardiser, impute_median
from matchcast.operators.order import with_position
from matchcast.operators.splits import (
    expanding_folds,
    random_split,
    stratified_folds,
    temporal_layout,
    temporal_split,
)
from matchcast.plans.closed_form import LINEAR_MODELS, linear_scores, log_odds
from matchcast.plans.prepare import LABEL, prepare_train_test
from matchcast.schema import DERIVED_COLUMNS, V1_EXCLUDE_COLUMNS
from matchcast.sources import readers, writers
from matchcast.sources.games import load_games, read

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def registered(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def rounded(*names: str, digits: int = 6) -> list[Column]:
    return [F.round(F.col(n), digits).alias(n) for n in names]


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{scratch_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linear_scores(prepare_train_test(load_games(spark, sf_dir)))


# --- scalar features and odds ----------------------------------------------------------------


@registered
def derived_features(spark, sf_dir):
    return derive_features(load_games(spark, sf_dir)).select("game_id", *rounded(*DERIVED_COLUMNS))


@registered
def fatigue_without_trip(spark, sf_dir):
    games = load_games(spark, sf_dir).drop("home_is_cross_country_trip")
    index = fatigue_index(
        F.col("home_days_rest"),
        F.col("home_games_last_7_days"),
        F.col("home_travel_miles_last_7_days"),
    )
    return games.select("game_id", F.round(index, 6).alias("home_fatigue_index"))


@registered
def odds_implied(spark, sf_dir):
    games = load_games(spark, sf_dir)
    return games.select(
        "game_id",
        F.round(odds.implied_probability(F.col("home_moneyline")), 6).alias("home_implied"),
        F.round(odds.implied_probability(F.col("away_moneyline")), 6).alias("away_implied"),
    )


@registered
def odds_decimal(spark, sf_dir):
    games = load_games(spark, sf_dir)
    return games.select(
        "game_id",
        F.round(odds.decimal_payout(F.col("home_moneyline")), 6).alias("home_pays"),
        F.round(odds.decimal_payout(F.col("away_moneyline")), 6).alias("away_pays"),
    )


@registered
def odds_from_prob(spark, sf_dir):
    games = load_games(spark, sf_dir)
    return games.select(
        "game_id",
        odds.american_odds(F.col("home_team_win_pct")).alias("home_offer"),
        odds.american_odds(1.0 - F.col("home_team_win_pct")).alias("away_offer"),
    )


@registered
def win_prob_rounded(spark, sf_dir):
    prepared = prepare_train_test(load_games(spark, sf_dir))
    p = odds.sigmoid(log_odds(*LINEAR_MODELS["balanced"]))
    home, away = odds.probability_pair(p)
    return prepared.rows.select("game_id", home.alias("home_p"), away.alias("away_p"))


@registered
def skew_log1p(spark, sf_dir):
    columns = ["home_travel_miles_last_7_days", "away_travel_miles_last_7_days"]
    games = log_skewed(load_games(spark, sf_dir), [*columns, "column_the_table_lacks"])
    return games.select("game_id", *rounded(*columns))


# --- targets and categories ------------------------------------------------------------------


@registered
def encode_target(spark, sf_dir):
    games = load_games(spark, sf_dir).withColumn(
        "outcome", F.when(F.col("game_id") % 5 != 0, F.lower("outcome"))
    )
    return encode.encode_target(games).select("game_id", "outcome")


@registered
def encode_win_loss(spark, sf_dir):
    text = F.when(F.col("game_id") % 5 == 0, (F.col("game_id") % 3).cast("string")).otherwise(
        F.col("outcome")
    )
    return load_games(spark, sf_dir).select("game_id", encode.encode_win_loss(text).alias("outcome"))


@registered
def decode_target(spark, sf_dir):
    return load_games(spark, sf_dir).select(
        "game_id", encode.decode_target(F.col("game_id") % 3).alias("outcome")
    )


@registered
def one_hot(spark, sf_dir):
    games = load_games(spark, sf_dir).select(
        "game_id",
        (F.col("home_star_score") % 3).alias("home_is_top_players"),
        (F.col("away_star_score") % 3).alias("away_is_top_players"),
    )
    return encode.one_hot(games, ["away_is_top_players", "home_is_top_players"])


@registered
def label_index(spark, sf_dir):
    games = load_games(spark, sf_dir).select("game_id", "outcome")
    return encode.label_index(games, "outcome", "outcome_index")


@registered
def parse_dates(spark, sf_dir):
    games = load_games(spark, sf_dir).select("game_id", F.col("game_date").cast("string").alias("d"))
    return games.select("game_id", encode.parse_date(F.col("d")).alias("game_date"))


# --- sources, sinks and gates ----------------------------------------------------------------


@registered
def scan_sorted(spark, sf_dir):
    keys = ["game_date", "home_team", "game_id"]
    games = readers.scan_games(load_games(spark, sf_dir), keys)
    return with_position(games.select("game_id", *rounded("home_team_avg_pts_scored")), "position")


@registered
def csv_round_trip(spark, sf_dir):
    games = load_games(spark, sf_dir).select(
        "game_id", "game_date", "home_team", "home_moneyline", "outcome"
    )
    path = _scratch(spark, "games-csv")
    writers.export_csv(games, path)
    return readers.read_csv(spark, path, games.schema)


def _flags(spark, sf_dir) -> DataFrame:
    """Nations as flags, every other one on."""
    return read(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("id"),
        F.col("n_name").alias("flag"),
        (F.col("n_nationkey") % 2).alias("is_enabled"),
    )


@registered
def flag_gate(spark, sf_dir):
    games, flags = load_games(spark, sf_dir), _flags(spark, sf_dir)
    passed = None
    for flag in ("NATION_1", "NATION_2", "NO_SUCH_FLAG"):
        through = readers.gate_on_flag(games, flags, flag)
        part = through.agg(F.count("*").alias("games")).select(F.lit(flag).alias("flag"), "games")
        passed = part if passed is None else passed.unionByName(part)
    return passed


def _first_date(spark, sf_dir) -> dt.date:
    return readers.leading_date(load_games(spark, sf_dir), ["game_date", "home_team"]).first()[0]


@registered
def freshness_gate(spark, sf_dir):
    games = load_games(spark, sf_dir)
    day = _first_date(spark, sf_dir)
    fresh = readers.gate_on_date(games, day).agg(F.count("*").alias("games"))
    stale = readers.gate_on_date(games, day + dt.timedelta(days=1)).agg(F.count("*").alias("games"))
    return fresh.select(F.lit("same day").alias("as_of"), "games").unionByName(
        stale.select(F.lit("next day").alias("as_of"), "games")
    )


@registered
def freshness_mark(spark, sf_dir):
    games, day = load_games(spark, sf_dir), _first_date(spark, sf_dir)
    same = readers.mark_stale(games, day).select("game_id", F.lit("same day").alias("as_of"), "stale")
    later = readers.mark_stale(games, day + dt.timedelta(days=1))
    return same.unionByName(later.select("game_id", F.lit("next day").alias("as_of"), "stale"))


@registered
def empty_gate(spark, sf_dir):
    """An empty table stays empty through every stage and writes nothing."""
    none = load_games(spark, sf_dir).where(F.col("outcome").isNull())
    derived = readers.scan_games(derive_features(none))
    wrote = writers.upsert(derived.drop("game_id"), _scratch(spark, "empty"))
    return derived.agg(F.count("*").alias("rows")).withColumn("wrote", F.lit(wrote))


@registered
def validated_projection(spark, sf_dir):
    games = load_games(spark, sf_dir)
    dropped = readers.drop_present(readers.drop_strict(games, V1_EXCLUDE_COLUMNS), ["no_such_column"])
    names = encode.numeric_columns(dropped, ["outcome"])
    aligned = readers.align_columns(dropped, [*names, "absent_feature"])
    path = _scratch(spark, "validated")
    writers.write_validated(aligned, path, aligned.schema, "append")
    writers.write_validated(aligned.drop("absent_feature"), path, aligned.schema, "append")
    stored = spark.read.schema(aligned.schema).parquet(path)
    return stored.select(
        "game_id", "absent_feature", *rounded("home_star_score", "away_active_vorp", "home_team_rank")
    )


@registered
def upsert_predictions(spark, sf_dir):
    """A first batch of all games, then the newest fifth again with other probabilities."""
    prepared = prepare_train_test(load_games(spark, sf_dir))

    def predictions(rows: DataFrame, model: str) -> DataFrame:
        home, away = odds.probability_pair(odds.sigmoid(log_odds(*LINEAR_MODELS[model])))
        return rows.select(
            "home_team", "game_date", "away_team", "game_id",
            home.alias("home_team_predicted_win_pct"), away.alias("away_team_predicted_win_pct"),
        )

    path = _scratch(spark, "predictions")
    for batch in (predictions(prepared.rows, "balanced"), predictions(prepared.test, "form")):
        writers.upsert(batch, path, order=["game_id"], grain="month")
    return spark.read.parquet(path).drop(writers.CREATED_AT, "game_date_month")


# --- splits and folds ------------------------------------------------------------------------


@registered
def temporal_split_rows(spark, sf_dir):
    return temporal_split(load_games(spark, sf_dir)).select("game_id", "is_test")


@registered
def expanding_fold_rows(spark, sf_dir):
    return expanding_folds(load_games(spark, sf_dir)).select("game_id", "fold")


@registered
def temporal_layout_rows(spark, sf_dir):
    return temporal_layout(load_games(spark, sf_dir)).select("game_id", "is_test", "fold")


@registered
def stratified_fold_rows(spark, sf_dir):
    return stratified_folds(load_games(spark, sf_dir), "outcome").select("game_id", "outcome", "fold")


@registered
def random_split_rows(spark, sf_dir):
    return random_split(load_games(spark, sf_dir)).select("game_id", "is_test")


@registered
def prepared_rows(spark, sf_dir):
    prepared = prepare_train_test(load_games(spark, sf_dir))
    return prepared.rows.select("game_id", "is_test", "fold", LABEL, *rounded(*prepared.features))


@registered
def median_impute(spark, sf_dir):
    games = derive_features(temporal_split(load_games(spark, sf_dir)))
    columns = [
        "home_days_rest", "home_games_last_7_days", "home_travel_miles_last_7_days",
        "home_team_avg_pts_scored", "home_moneyline", "travel_diff", "net_rating_diff",
    ]
    filled = impute_median(games.where(~F.col("is_test")), games, columns)
    return filled.select("game_id", *rounded(*columns))


@registered
def standardise(spark, sf_dir):
    prepared = prepare_train_test(load_games(spark, sf_dir))
    scaler = fit_standardiser(prepared.train, prepared.features)
    return scaler.transform(prepared.test).select("game_id", *rounded(*prepared.features))


# --- metrics ---------------------------------------------------------------------------------


@registered
def confusion(spark, sf_dir):
    return metrics.confusion(_scores(spark, sf_dir))


@registered
def class_metrics(spark, sf_dir):
    table = metrics.class_metrics(_scores(spark, sf_dir))
    return table.select(*metrics.BY, *rounded("accuracy", "precision", "recall", "f1", "mcc"))


@registered
def class_report(spark, sf_dir):
    table = metrics.class_report(_scores(spark, sf_dir))
    return table.select(*metrics.BY, "label", "support", *rounded("precision", "recall", "f1"))


@registered
def accuracy(spark, sf_dir):
    table = metrics.accuracy(_scores(spark, sf_dir))
    return table.select(*metrics.BY, *rounded("accuracy"))


@registered
def auc(spark, sf_dir):
    return metrics.auc(_scores(spark, sf_dir)).select(*metrics.BY, *rounded("auc"))


@registered
def log_loss(spark, sf_dir):
    return metrics.log_loss(_scores(spark, sf_dir)).select(*metrics.BY, *rounded("log_loss"))


@registered
def brier(spark, sf_dir):
    return metrics.brier(_scores(spark, sf_dir)).select(*metrics.BY, *rounded("brier"))


@registered
def ece(spark, sf_dir):
    return metrics.ece(_scores(spark, sf_dir)).select(*metrics.BY, *rounded("ece"))


METRIC_COLUMNS = [
    "accuracy", "precision", "recall", "f1", "mcc", "auc", "log_loss", "brier", "ece",
]


@registered
def evaluate_scores(spark, sf_dir):
    table = metrics.evaluate(_scores(spark, sf_dir))
    return table.select(*metrics.BY, "tn", "fp", "fn", "tp", *rounded(*METRIC_COLUMNS))


@registered
def kelly_backtest(spark, sf_dir):
    scores = linear_scores(prepare_train_test(backtest.keep_odds(load_games(spark, sf_dir))), backtest.RAW_ODDS)
    table = backtest.kelly_backtest(backtest.raw_odds(scores))
    return table.select(
        *metrics.BY, "bets_placed",
        *rounded("final_bankroll", "total_profit", "roi", "win_rate", digits=4),
    )


# --- comparison ------------------------------------------------------------------------------


def _evaluated(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    table = metrics.evaluate(_scores(spark, sf_dir))
    return table.where(F.col("run") == "cv"), table.where(F.col("run") == "test")


@registered
def fold_summary(spark, sf_dir):
    table = compare.fold_summary(_evaluated(spark, sf_dir)[0])
    names = [c for c in table.columns if c not in ("run", "model")]
    return table.select("run", "model", *rounded(*names))


@registered
def leaderboard(spark, sf_dir):
    cv, test = _evaluated(spark, sf_dir)
    board = compare.leaderboard(compare.fold_summary(cv), test)
    names = [c for c in board.columns if c not in ("run", "model", "rank")]
    return board.select("run", "model", "rank", *rounded(*names))


@registered
def best_model(spark, sf_dir):
    cv, test = _evaluated(spark, sf_dir)
    best = compare.best_model(compare.leaderboard(compare.fold_summary(cv), test))
    return best.select("run", "model", *rounded("improvement_over_baseline"))


@registered
def paired_ttest(spark, sf_dir):
    table = compare.paired_ttest(metrics.auc(_scores(spark, sf_dir)).where(F.col("run") == "cv"))
    return table.select("run", "model_a", "model_b", "significant", *rounded("mean_diff", "p_value"))


@registered
def readiness(spark, sf_dir):
    games = load_games(spark, sf_dir)
    test = linear_scores(prepare_train_test(games)).where(F.col("run") == "test")
    by = ["run", "model"]
    profit = backtest.kelly_backtest(backtest.with_odds(test, games), by)
    table = compare.readiness(metrics.evaluate(test, by), profit)
    checks = [c for c in table.columns if c not in ("auc", "ece", "roi")]
    return table.select(*checks, *rounded("auc", "ece"), *rounded("roi", digits=4))


@registered
def top_n(spark, sf_dir):
    cv, test = _evaluated(spark, sf_dir)
    board = compare.leaderboard(compare.fold_summary(cv), test)
    return compare.top_rows(board, 2, F.col("rank")).select("model", "rank", *rounded("cv_auc_mean"))
