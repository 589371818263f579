import math
import random

import pytest
from pyspark.sql import functions as F

from matchcast.operators import backtest, compare, metrics


def score_frame(spark, rows):
    return spark.createDataFrame(
        [("r", "m", f, i, y, p) for i, (f, y, p) in enumerate(rows)],
        "run string, model string, fold int, game_id long, y int, p double",
    )


def brute_auc(rows):
    pos = [p for y, p in rows if y == 1]
    neg = [p for y, p in rows if y == 0]
    won = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
    return won / (len(pos) * len(neg))


def test_auc_counts_pairs(spark):
    rng = random.Random(2)
    rows = []
    for fold in range(2):
        for _ in range(1500):
            p = 0.5 if rng.random() < 0.3 else rng.random() * (1e-6 if rng.random() < 0.5 else 1)
            rows.append((fold, int(rng.random() < p), p))
    tallied = metrics.tally_by_score(score_frame(spark, rows), metrics.BY)
    got = {r["fold"]: r["auc"] for r in metrics.auc_of_tally(tallied, metrics.BY).collect()}
    for fold in range(2):
        assert got[fold] == pytest.approx(brute_auc([(y, p) for f, y, p in rows if f == fold]), abs=1e-12)


def test_auc_is_missing_with_one_class(spark):
    df = score_frame(spark, [(0, 1, 0.2), (0, 1, 0.8)])
    assert metrics.auc(df).first()["auc"] is None


def test_metrics_against_plain_python(spark):
    rng = random.Random(3)
    rows = [(0, int(rng.random() < 0.4), rng.random()) for _ in range(700)] + [(0, 1, 0.0), (0, 0, 1.0), (0, 1, 0.5)]
    got = metrics.evaluate(score_frame(spark, rows)).first()
    yp = [(y, p) for _, y, p in rows]
    n = len(yp)
    tp = sum(y == 1 and p > 0.5 for y, p in yp)
    fp = sum(y == 0 and p > 0.5 for y, p in yp)
    fn = sum(y == 1 and p <= 0.5 for y, p in yp)
    tn = sum(y == 0 and p <= 0.5 for y, p in yp)
    assert (got["tn"], got["fp"], got["fn"], got["tp"]) == (tn, fp, fn, tp)
    assert got["accuracy"] == pytest.approx((tp + tn) / n)
    assert got["mcc"] == pytest.approx(
        (tp * tn - fp * fn) / math.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))
    )
    eps = 2.220446049250313e-16
    clipped = [(y, min(max(p, eps), 1 - eps)) for y, p in yp]
    assert got["log_loss"] == pytest.approx(
        -sum(y * math.log(p) + (1 - y) * math.log1p(-p) for y, p in clipped) / n
    )
    assert got["brier"] == pytest.approx(sum((p - y) ** 2 for y, p in yp) / n)
    bins = {}
    for y, p in yp:
        b = min(max(math.ceil(p * 10) - 1, 0), 9)
        bins.setdefault(b, []).append((y, p))
    ece = sum(abs(sum(y for y, _ in v) - sum(p for _, p in v)) for v in bins.values()) / n
    assert got["ece"] == pytest.approx(ece)
    assert got["auc"] == pytest.approx(brute_auc(yp))


def test_zero_denominators(spark):
    row = metrics.class_metrics(score_frame(spark, [(0, 0, 0.1), (0, 0, 0.2)])).first()
    assert (row["precision"], row["recall"], row["f1"], row["mcc"]) == (0.0, 0.0, 0.0, 0.0)


def sequential_bankroll(rows, threshold=0.5, kelly=0.25, bankroll=1000.0):
    bets = wins = 0

    def implied(o):
        return 0.5 if o == 0 else 100 / (o + 100) if o > 0 else -o / (-o + 100)

    for y, p, home, away in rows:
        for odds, chance, won in ((home, p, y == 1), (away, 1 - p, y == 0)):
            if odds is None or odds == 0:
                continue
            pays = odds / 100 if odds > 0 else 100 / -odds
            edge = chance - implied(odds)
            stake = min(max(edge / pays * kelly, 0), 0.05) if edge > 0 and chance >= threshold else 0
            if stake > 0:
                bets += 1
                wins += won
                bankroll += bankroll * stake * (pays if won else -1)
                break
    return bankroll, bets, wins


def test_backtest_equals_the_sequential_loop(spark):
    rng = random.Random(4)
    prices = [None, 0.0, 150.0, -120.0, 240.0, -300.0, 105.0]
    rows = [(int(rng.random() < 0.5), rng.random(), rng.choice(prices), rng.choice(prices)) for _ in range(3000)]
    df = spark.createDataFrame(
        [("r", "m", 0, *r) for r in rows],
        "run string, model string, fold int, y int, p double, home_moneyline double, away_moneyline double",
    )
    bankroll, bets, wins = sequential_bankroll(rows)
    for frame in (df, df.orderBy(F.rand(1)).repartition(7)):
        got = backtest.kelly_backtest(frame).first()
        assert got["final_bankroll"] == pytest.approx(bankroll, rel=1e-9)
        assert got["bets_placed"] == bets
        assert got["win_rate"] == pytest.approx(wins / bets)
        assert got["roi"] == pytest.approx((bankroll - 1000) / 10)


def test_backtest_without_bets(spark):
    df = spark.createDataFrame(
        [("r", "m", 0, 1, 0.5, None, 0.0)],
        "run string, model string, fold int, y int, p double, home_moneyline double, away_moneyline double",
    )
    got = backtest.kelly_backtest(df).first()
    assert (got["final_bankroll"], got["bets_placed"], got["win_rate"]) == (1000.0, 0, 0.0)


def test_odds_join_is_by_key(spark):
    scores = spark.createDataFrame([(i, 1, 0.6) for i in range(5)], "game_id long, y int, p double")
    games = spark.createDataFrame([(i, 100.0 + i, -110.0) for i in reversed(range(5))],
                                  "game_id long, home_moneyline double, away_moneyline double")
    got = backtest.with_odds(scores, games).collect()
    assert {r["game_id"]: r["home_moneyline"] for r in got} == {i: 100.0 + i for i in range(5)}


# Two-sided 5% critical values of Student's t.
CRITICAL = {1: 12.706205, 2: 4.302653, 3: 3.182446, 4: 2.776445, 5: 2.570582, 9: 2.262157, 10: 2.228139, 30: 2.042272}


def test_student_p_values(spark):
    df = spark.createDataFrame([(t, d) for d, t in CRITICAL.items()], "t double, d int")
    for (p,) in df.select(compare.student_p_value(F.col("t"), F.col("d"))).collect():
        assert p == pytest.approx(0.05, abs=1e-6)


def test_paired_test_and_leaderboard(spark):
    rows = [("cv", m, f, auc) for m, base in (("a", 0.7), ("b", 0.6), ("c", 0.7)) for f, auc in
            enumerate([base, base + 0.01, base + 0.02])]
    df = spark.createDataFrame(rows, "run string, model string, fold int, auc double")
    tests = {(r["model_a"], r["model_b"]): r for r in compare.paired_ttest(df).collect()}
    assert set(tests) == {("a", "b"), ("a", "c"), ("b", "c")}
    assert tests["a", "c"]["p_value"] is None and not tests["a", "c"]["significant"]
    assert tests["a", "b"]["mean_diff"] == pytest.approx(0.1)
    assert tests["a", "b"]["significant"]
    summary = df.groupBy("run", "model").agg(F.avg("auc").alias("auc_mean"), F.stddev_pop("auc").alias("auc_std"))
    board = compare.leaderboard(summary.withColumn("accuracy_mean", F.lit(0.5)))
    assert {r["model"]: r["rank"] for r in board.collect()} == {"a": 1, "c": 2, "b": 3}


def test_readiness_needs_every_check(spark):
    m = spark.createDataFrame(
        [("t", "good", 0.6, 0.1), ("t", "weak", 0.52, 0.1), ("t", "none", None, 0.1)],
        "run string, model string, auc double, ece double",
    )
    b = spark.createDataFrame(
        [("t", "good", 5.0, 0.5), ("t", "weak", 5.0, 0.5), ("t", "none", 5.0, 0.5)],
        "run string, model string, total_profit double, roi double",
    )
    got = {r["model"]: r["production_ready"] for r in compare.readiness(m, b).collect()}
    assert got == {"good": True, "weak": False, "none": False}
