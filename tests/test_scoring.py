import datetime as dt

import pytest
from pyspark.sql import functions as F

from matchcast import schema
from matchcast.operators import impute, learners
from matchcast.plans import scoring
from matchcast.sources import readers

TODAY = dt.date(2024, 1, 15)
V1_FEATURES = [c for c in schema.GAMES_V1.names if c not in schema.V1_EXCLUDE_COLUMNS]


@pytest.fixture(scope="module")
def history(spark):
    """Made-up games whose outcome follows the difference in win percentage."""
    from matchcast.operators.sampling import generate_games

    return generate_games(spark, 400).persist()


@pytest.fixture(scope="module")
def v2(spark, history, tmp_path_factory):
    from matchcast.functions.encode import encode_target

    state = impute.fit_features(history)
    rows = encode_target(impute.apply_features(history, state))
    features = [c for c in state.columns if c not in schema.METADATA_COLUMNS]
    model = learners.fit_classifier(rows, features, "outcome")
    path = str(tmp_path_factory.mktemp("model") / "m")
    learners.save_classifier(spark, path, model, state, {"auc": 0.7})
    return path, model, learners.load_classifier(spark, path)


@pytest.fixture(scope="module")
def tonight(history):
    return history.limit(8).drop("game_id").withColumn("game_date", F.lit(TODAY)).persist()


def v1_games(spark, n=40, day=TODAY):
    numbers = {
        f.name: (F.col("id") * (i + 3) % 17 + 1).cast(f.dataType)
        for i, f in enumerate(schema.GAMES_V1)
        if f.name in V1_FEATURES
    }
    return spark.range(n).select(
        F.concat(F.lit("home"), "id").alias("home_team"),
        F.concat(F.lit("away"), "id").alias("away_team"),
        F.lit(-150.0).alias("home_moneyline"),
        F.lit(130.0).alias("away_moneyline"),
        F.lit(day).alias("game_date"),
        *(c.alias(n) for n, c in numbers.items()),
        (F.col("id") % 2).cast("int").alias("outcome"),
    ).select(*schema.GAMES_V1.names)


def test_score_v1(spark):
    games = v1_games(spark)
    model = learners.fit_classifier(games, V1_FEATURES, "outcome", params={"max_iter": 20})
    two = games.limit(2)
    scored = scoring.score_v1(two, model, TODAY).collect()
    assert len(scored) == 2 and len(scored[0]) == 21
    for r in scored:
        h, a = r[schema.HOME_PROBABILITY], r[schema.AWAY_PROBABILITY]
        assert 0 <= h <= 1 and 0 <= a <= 1 and round(h + a, 3) == 1.0
    assert "outcome" not in scored[0].asDict()
    assert scoring.score_v1(two, model, dt.date(2021, 1, 1)).collect() == []
    with pytest.raises(ValueError):
        scoring.score_v1(two.drop("home_moneyline"), model, TODAY)
    assert scoring.score_v1(two.where("false"), model, TODAY).isEmpty()


def test_score_v2(tonight, v2):
    _, _, artifacts = v2
    scored = scoring.score_v2(tonight, artifacts, TODAY).collect()
    assert len(scored) == 8
    for r in scored:
        assert 0 <= r[schema.HOME_PROBABILITY] <= 1
        assert round(r[schema.HOME_PROBABILITY] + r[schema.AWAY_PROBABILITY], 3) == 1.0
    assert set(scored[0].asDict()) == set(tonight.columns) - {"outcome"} | {
        schema.HOME_PROBABILITY, schema.AWAY_PROBABILITY
    }


def test_score_v2_keeps_stale_games(tonight, v2):
    scored = scoring.score_v2(tonight, v2[2], dt.date(2020, 1, 1), mark_stale=True)
    assert [r["stale"] for r in scored.collect()] == [True] * 8


def test_score_v2_fills_an_absent_column_with_its_median(tonight, v2):
    _, _, artifacts = v2
    lacking = tonight.drop("home_team_rank")
    filled = impute.apply_features(lacking, artifacts.state)
    assert {r[0] for r in filled.select("home_team_rank").collect()} == {artifacts.state.medians["home_team_rank"]}
    assert {r[0] for r in filled.select("rank_diff").collect()} == {artifacts.state.medians["rank_diff"]}
    assert scoring.score_v2(lacking, artifacts, TODAY).count() == 8


def test_score_v2_failure(tonight, v2):
    broken = learners.Artifacts(v2[2].classifier, None, {})
    with pytest.raises(ValueError):
        scoring.score_v2(tonight, broken, TODAY)
    empty = scoring.score_v2(tonight, broken, TODAY, on_error="empty")
    assert empty.isEmpty() and schema.HOME_PROBABILITY in empty.columns


def test_stored_model_scores_alike(spark, tonight, v2):
    path, model, loaded = v2
    rows = impute.apply_features(tonight, loaded.state)
    assert model.score(rows).select("p").collect() == loaded.classifier.score(rows).select("p").collect()
    assert loaded.metrics == {"auc": 0.7}
    with pytest.raises(FileNotFoundError):
        learners.load_classifier(spark, path + "-absent")


def test_nightly(spark, tonight, v2, tmp_path):
    path, _, _ = v2
    target = str(tmp_path / "predictions")
    on = spark.createDataFrame([(1, "season", 1)], "id int, flag string, is_enabled int")
    off = on.withColumn("is_enabled", F.lit(0))
    games = tonight.dropDuplicates(["home_team"])
    assert scoring.nightly(spark, games, off, path, target, TODAY, 2) == "disabled"
    assert scoring.nightly(spark, games.where("false"), on, path, target, TODAY, 2) == "no games"
    assert scoring.nightly(spark, games, on, path, target, TODAY, 2) == "written"
    assert spark.read.parquet(target).count() == games.count()
    assert readers.read_table(spark, target).where("created_at is null").isEmpty()


def test_all_missing_column_is_listed_and_zero(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (3.0, float("nan"))], "a double, b double")
    state = impute.fit_features(df)
    assert state.empty == ["b"] and state.medians == {"a": 2.0, "b": 0.0}
    assert [tuple(r) for r in impute.apply_features(df, state).collect()] == [(1.0, 0.0), (2.0, 0.0), (3.0, 0.0)]
    with pytest.raises(ValueError):
        impute.apply_features(df, None)


def test_standardiser(spark):
    df = spark.createDataFrame([(1.0, 5.0, 1), (3.0, 5.0, 3)], "a double, b double, w int")
    s = impute.fit_standardiser(df, ["a", "b"])
    assert s.means == {"a": 2.0, "b": 5.0} and s.deviations == {"a": 1.0, "b": 1.0}
    weighted = impute.fit_standardiser(df, ["a"], "w")
    assert weighted.means["a"] == pytest.approx(2.5)
    assert weighted.deviations["a"] == pytest.approx(0.75**0.5)
