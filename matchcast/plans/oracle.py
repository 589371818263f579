"""Oracle SQL of the registered queries, for an independent engine."""

from __future__ import annotations

from matchcast.plans.oracle_base import (
    ALL_NUMERIC,
    AUC,
    BETS,
    CLASS_METRICS,
    CONFUSION,
    DERIVED,
    DERIVED_SQL,
    ECE,
    GAMES,
    LAYOUT,
    LOSSES,
    MODEL_FEATURES,
    TO_METRICS,
    TO_PREPARED,
    TO_SCORES,
    query,
    rounded,
)

ORACLE: dict[str, str] = {}

# --- scalar features and odds ----------------------------------------------------------------

ORACLE["derived_features"] = query(
    [GAMES, DERIVED], f"SELECT game_id, {rounded(list(DERIVED_SQL))} FROM derived"
)
ORACLE["fatigue_without_trip"] = query(
    [GAMES],
    """SELECT game_id, round((3e0 - least(coalesce(home_days_rest, 2e0), 3e0)) * 1.5e0
         + coalesce(home_games_last_7_days, 2e0)
         + 0.5e0 * ln(1e0 + coalesce(home_travel_miles_last_7_days, 500e0)), 6) AS home_fatigue_index
       FROM games""",
)


def _implied(column: str) -> str:
    return (
        f"CASE WHEN {column} = 0 THEN 0.5e0 WHEN {column} > 0 THEN 100e0 / ({column} + 100e0)"
        f" ELSE -{column} / (100e0 - {column}) END"
    )


def _pays(column: str) -> str:
    return f"CASE WHEN {column} > 0 THEN 1e0 + {column} / 100e0 WHEN {column} < 0 THEN 1e0 - 100e0 / {column} END"


def _offer(p: str) -> str:
    q = f"least(greatest({p} + 0.02e0, 0.05e0), 0.95e0)"
    return (
        f"CASE WHEN {q} >= 0.5e0 THEN round_even(-({q} / (1e0 - {q})) * 100e0, 0)"
        f" ELSE round_even(((1e0 - {q}) / {q}) * 100e0, 0) END"
    )


ORACLE["odds_implied"] = query(
    [GAMES],
    f"SELECT game_id, round({_implied('home_moneyline')}, 6) AS home_implied,"
    f" round({_implied('away_moneyline')}, 6) AS away_implied FROM games",
)
ORACLE["odds_decimal"] = query(
    [GAMES],
    f"SELECT game_id, round({_pays('home_moneyline')}, 6) AS home_pays,"
    f" round({_pays('away_moneyline')}, 6) AS away_pays FROM games",
)
ORACLE["odds_from_prob"] = query(
    [GAMES],
    f"SELECT game_id, {_offer('home_team_win_pct')} AS home_offer,"
    f" {_offer('(1e0 - home_team_win_pct)')} AS away_offer FROM games",
)
ORACLE["win_prob_rounded"] = query(
    TO_PREPARED,
    """SELECT game_id, round_even(p, 3) AS home_p, round_even(1e0 - p, 3) AS away_p
       FROM (SELECT game_id, 1e0 / (1e0 + exp(-(0.06e0 + win_pct_diff * 1e0 + star_score_diff * 0.1e0
                                                + fatigue_diff * 0.05e0))) AS p FROM prepared)""",
)
ORACLE["skew_log1p"] = query(
    [GAMES],
    """SELECT game_id, round(ln(1e0 + home_travel_miles_last_7_days), 6) AS home_travel_miles_last_7_days,
              round(ln(1e0 + away_travel_miles_last_7_days), 6) AS away_travel_miles_last_7_days FROM games""",
)

# --- targets and categories ------------------------------------------------------------------

ORACLE["encode_target"] = query(
    [GAMES],
    """SELECT game_id, CASE WHEN game_id % 5 <> 0 AND outcome = 'W' THEN 1 ELSE 0 END AS outcome FROM games""",
)
ORACLE["encode_win_loss"] = query(
    [GAMES],
    """SELECT game_id, CASE WHEN game_id % 5 = 0 THEN CAST(game_id % 3 AS INTEGER)
                            WHEN outcome = 'W' THEN 1 ELSE 0 END AS outcome FROM games""",
)
ORACLE["decode_target"] = query(
    [GAMES],
    "SELECT game_id, CASE game_id % 3 WHEN 1 THEN 'W' WHEN 0 THEN 'L' END AS outcome FROM games",
)
ORACLE["one_hot"] = query(
    [GAMES],
    "SELECT game_id, "
    + ", ".join(
        f"CASE WHEN {side}_star_score % 3 = {v} THEN 1 ELSE 0 END AS \"{side}_is_top_players_{v}.0\""
        for side in ("away", "home")
        for v in (1, 2)
    )
    + " FROM games",
)
ORACLE["label_index"] = query(
    [GAMES],
    """SELECT g.game_id, g.outcome, CAST(i.pos AS INTEGER) AS outcome_index FROM games g
       JOIN (SELECT outcome, row_number() OVER (ORDER BY outcome) - 1 AS pos
             FROM (SELECT DISTINCT outcome FROM games)) i ON i.outcome = g.outcome""",
)
ORACLE["parse_dates"] = query([GAMES], "SELECT game_id, game_date FROM games")

# --- sources, sinks and gates ----------------------------------------------------------------

ORACLE["scan_sorted"] = query(
    [GAMES],
    """SELECT game_id, round(home_team_avg_pts_scored, 6) AS home_team_avg_pts_scored,
              row_number() OVER (ORDER BY home_team_avg_pts_scored NULLS LAST, game_date, home_team, game_id) - 1
                AS position FROM games""",
)
ORACLE["csv_round_trip"] = query(
    [GAMES], "SELECT game_id, game_date, home_team, home_moneyline, outcome FROM games"
)
ORACLE["flag_gate"] = query(
    [GAMES],
    """SELECT f.flag, CASE WHEN coalesce(max(n.n_nationkey % 2), 0) = 1
                           THEN (SELECT count(*) FROM games) ELSE 0 END AS games
       FROM (VALUES ('NATION_1'), ('NATION_2'), ('NO_SUCH_FLAG')) f(flag)
       LEFT JOIN nation n ON n.n_name = f.flag GROUP BY f.flag""",
)
ORACLE["freshness_gate"] = query(
    [GAMES],
    """SELECT 'same day' AS as_of, count(*) AS games FROM games
       UNION ALL SELECT 'next day', 0""",
)
ORACLE["freshness_mark"] = query(
    [GAMES],
    """SELECT game_id, as_of, as_of = 'next day' AS stale
       FROM games, (SELECT unnest(['same day', 'next day']) AS as_of)""",
)
ORACLE["empty_gate"] = query(
    [GAMES], "SELECT count(*) AS rows, FALSE AS wrote FROM games WHERE outcome IS NULL"
)
ORACLE["validated_projection"] = query(
    [GAMES],
    f"SELECT game_id, 0e0 AS absent_feature, {rounded(['home_star_score', 'away_active_vorp', 'home_team_rank'])} FROM games",
)
ORACLE["upsert_predictions"] = query(
    TO_PREPARED,
    """, both_batches AS (
         SELECT *, 1 AS batch, 0.06e0 + win_pct_diff * 1e0 + star_score_diff * 0.1e0 + fatigue_diff * 0.05e0 AS z
         FROM prepared
         UNION ALL
         SELECT *, 2, -0.1e0 + recent_form_diff * 1.5e0 + net_rating_diff * 0.02e0 + rank_diff * 0.01e0
         FROM prepared WHERE is_test
       ),
       latest AS (
         SELECT *, row_number() OVER (PARTITION BY home_team, game_date ORDER BY batch DESC, game_id DESC) AS nth
         FROM both_batches
       )
       SELECT home_team, game_date, away_team, game_id,
              round_even(1e0 / (1e0 + exp(-z)), 3) AS home_team_predicted_win_pct,
              round_even(1e0 - 1e0 / (1e0 + exp(-z)), 3) AS away_team_predicted_win_pct
       FROM latest WHERE nth = 1""".replace("\n", " "),
)

# --- splits and folds ------------------------------------------------------------------------

ORACLE["temporal_split_rows"] = query(
    [GAMES, DERIVED, LAYOUT], "SELECT game_id, is_test FROM laid_out"
)
ORACLE["expanding_fold_rows"] = query(
    [GAMES],
    """SELECT game_id, CAST(CASE WHEN pos < n - 5 * (n // 6) THEN -1
                                 ELSE (pos - (n - 5 * (n // 6))) // (n // 6) END AS INTEGER) AS fold
       FROM (SELECT game_id, count(*) OVER () AS n,
                    row_number() OVER (ORDER BY game_date, home_team, away_team, game_id) - 1 AS pos FROM games)""",
)
ORACLE["temporal_layout_rows"] = query(
    [GAMES, DERIVED, LAYOUT], "SELECT game_id, is_test, CAST(fold AS INTEGER) AS fold FROM laid_out"
)


def mixed_hash(source: str, keep: str, salt: int | str) -> str:
    """The keyed hash of ``game_id`` as column ``h``, step by step, beside the columns kept."""
    m = 2147483647
    steps = [f"game_id % ({m}::BIGINT * {m}) AS key", f"key % {m} AS low", f"key // {m} AS high"]

    def scramble(name: str, start: str, shift: int) -> None:
        s = f"(({salt}) + {shift})"
        steps.append(f"{start} AS {name}_0")
        steps.append(f"(({name}_0 + {s} * 7919 + 1) * 48271) % {m} AS {name}_1")
        steps.append(f"({name}_1 * {name}_1 + {s} * 104729 + 12345) % {m} AS {name}_2")
        steps.append(f"({name}_2 * 69621 + {name}_0) % {m} AS {name}_3")
        steps.append(f"({name}_3 * {name}_3 + {name}_3 * 48271) % {m} AS {name}")

    scramble("one", "low", 0)
    scramble("two", f"(one + high) % {m}", 101)
    scramble("three", f"(two + low) % {m}", 211)
    steps.append(f"two * {m} + three AS h")
    return f"SELECT {keep}, h FROM (SELECT {keep}, {', '.join(steps)} FROM {source})"


UNIFORM = "(h::DOUBLE + 0.5e0) / 4611686014132420609e0"

ORACLE["stratified_fold_rows"] = query(
    [GAMES],
    f"""SELECT game_id, outcome, CAST(CASE WHEN pos < 1 * n // 5 THEN 0 WHEN pos < 2 * n // 5 THEN 1
               WHEN pos < 3 * n // 5 THEN 2 WHEN pos < 4 * n // 5 THEN 3 ELSE 4 END AS INTEGER) AS fold
        FROM (SELECT game_id, outcome, count(*) OVER (PARTITION BY outcome) AS n,
                     row_number() OVER (PARTITION BY outcome ORDER BY h, game_id) - 1 AS pos
              FROM ({mixed_hash('games', 'game_id, outcome', 42)}))""",
)
ORACLE["random_split_rows"] = query(
    [GAMES],
    f"SELECT game_id, {UNIFORM} < 0.2e0 AS is_test FROM ({mixed_hash('games', 'game_id', 42)})",
)
ORACLE["prepared_rows"] = query(
    TO_PREPARED,
    f"SELECT game_id, is_test, CAST(fold AS INTEGER) AS fold, label, {rounded(MODEL_FEATURES)} FROM prepared",
)
ORACLE["median_impute"] = query(
    TO_PREPARED,
    "SELECT game_id, "
    + rounded(
        [
            "home_days_rest", "home_games_last_7_days", "home_travel_miles_last_7_days",
            "home_team_avg_pts_scored", "home_moneyline", "travel_diff", "net_rating_diff",
        ]
    )
    + " FROM prepared",
)
ORACLE["standardise"] = query(
    [
        *TO_PREPARED,
        "moments AS (SELECT "
        + ", ".join(f"avg({c}) AS a_{c}, stddev_pop({c}) AS s_{c}" for c in MODEL_FEATURES)
        + " FROM prepared WHERE NOT is_test)",
    ],
    "SELECT game_id, "
    + ", ".join(f"round(({c} - a_{c}) / s_{c}, 6) AS {c}" for c in MODEL_FEATURES)
    + " FROM prepared, moments WHERE is_test",
)

# --- metrics ---------------------------------------------------------------------------------

TO_CLASSES = [*TO_SCORES, CONFUSION, CLASS_METRICS]
ORACLE["confusion"] = query([*TO_SCORES, CONFUSION], "SELECT * FROM confusion")
ORACLE["class_metrics"] = query(
    TO_CLASSES,
    f"SELECT run, model, fold, {rounded(['accuracy', 'precision', 'recall', 'f1', 'mcc'])} FROM class_metrics",
)
ORACLE["class_report"] = query(
    [
        *TO_CLASSES,
        """per_class AS (
             SELECT run, model, fold, '0' AS label, tn + fp AS support, accuracy, tn + fp + fn + tp AS n,
                    CASE WHEN tn + fn = 0 THEN 0e0 ELSE tn * 1e0 / (tn + fn) END AS precision,
                    CASE WHEN tn + fp = 0 THEN 0e0 ELSE tn * 1e0 / (tn + fp) END AS recall,
                    CASE WHEN 2 * tn + fn + fp = 0 THEN 0e0 ELSE 2e0 * tn / (2 * tn + fn + fp) END AS f1
             FROM class_metrics
             UNION ALL
             SELECT run, model, fold, '1', tp + fn, accuracy, tn + fp + fn + tp, precision, recall, f1
             FROM class_metrics
           ),
           report AS (
             SELECT run, model, fold, label, support, precision, recall, f1 FROM per_class
             UNION ALL
             SELECT run, model, fold, 'accuracy', max(n), max(accuracy), max(accuracy), max(accuracy)
             FROM per_class GROUP BY run, model, fold
             UNION ALL
             SELECT run, model, fold, 'macro avg', max(n), avg(precision), avg(recall), avg(f1)
             FROM per_class GROUP BY run, model, fold
             UNION ALL
             SELECT run, model, fold, 'weighted avg', max(n), sum(precision * support) / sum(support),
                    sum(recall * support) / sum(support), sum(f1 * support) / sum(support)
             FROM per_class GROUP BY run, model, fold
           )""",
    ],
    f"SELECT run, model, fold, label, CAST(support AS BIGINT) AS support, {rounded(['precision', 'recall', 'f1'])} FROM report",
)
ORACLE["accuracy"] = query(
    TO_SCORES,
    """SELECT run, model, fold, round(avg(CASE WHEN (p > 0.5e0) = (y = 1) THEN 1e0 ELSE 0e0 END), 6) AS accuracy
       FROM scores GROUP BY run, model, fold""",
)
ORACLE["auc"] = query([*TO_SCORES, AUC], f"SELECT run, model, fold, {rounded(['auc'])} FROM auc")
ORACLE["log_loss"] = query(
    [*TO_SCORES, LOSSES], f"SELECT run, model, fold, {rounded(['log_loss'])} FROM losses"
)
ORACLE["brier"] = query(
    [*TO_SCORES, LOSSES], f"SELECT run, model, fold, {rounded(['brier'])} FROM losses"
)
ORACLE["ece"] = query([*TO_SCORES, ECE], f"SELECT run, model, fold, {rounded(['ece'])} FROM ece")
METRICS = ["accuracy", "precision", "recall", "f1", "mcc", "auc", "log_loss", "brier", "ece"]
ORACLE["evaluate_scores"] = query(
    TO_METRICS, f"SELECT run, model, fold, tn, fp, fn, tp, {rounded(METRICS)} FROM fold_metrics"
)
ORACLE["kelly_backtest"] = query(
    [*TO_SCORES, BETS],
    """SELECT run, model, fold, bets_placed, round(final_bankroll, 4) AS final_bankroll,
              round(final_bankroll - 1000e0, 4) AS total_profit, round((final_bankroll - 1000e0) / 10e0, 4) AS roi,
              round(CASE WHEN bets_placed = 0 THEN 0e0 ELSE bets_won * 1e0 / bets_placed END, 4) AS win_rate
       FROM backtest""",
)

# --- comparison ------------------------------------------------------------------------------

SUMMARY = """
summary AS (
  SELECT run, model, """ + ", ".join(
    f"avg({m}) AS {m}_mean, stddev_pop({m}) AS {m}_std"
    for m in ("auc", "accuracy", "brier", "f1", "log_loss")
) + """ FROM fold_metrics WHERE run = 'cv' GROUP BY run, model
)"""
BOARD = """
board AS (
  SELECT s.run, s.model, s.auc_mean AS cv_auc_mean, s.auc_std AS cv_auc_std, s.accuracy_mean AS cv_acc_mean,
         t.auc AS test_auc, t.accuracy AS test_acc, t.mcc AS test_mcc, t.brier AS test_brier,
         t.ece AS calibration_ece,
         CAST(row_number() OVER (PARTITION BY s.run ORDER BY s.auc_mean DESC, s.model) AS INTEGER) AS rank
  FROM summary s JOIN fold_metrics t ON t.run = 'test' AND t.model = s.model
)"""
ORACLE["fold_summary"] = query(
    [*TO_METRICS, SUMMARY],
    "SELECT run, model, "
    + rounded([f"{m}_{s}" for m in ("auc", "accuracy", "brier", "f1", "log_loss") for s in ("mean", "std")])
    + " FROM summary",
)
ORACLE["leaderboard"] = query(
    [*TO_METRICS, SUMMARY, BOARD],
    "SELECT run, model, rank, "
    + rounded(
        ["cv_auc_mean", "cv_auc_std", "cv_acc_mean", "test_auc", "test_acc", "test_mcc",
         "test_brier", "calibration_ece"]
    )
    + " FROM board",
)
ORACLE["best_model"] = query(
    [*TO_METRICS, SUMMARY, BOARD],
    "SELECT run, model, round((test_auc - 0.5e0) / 0.5e0 * 100e0, 6) AS improvement_over_baseline FROM board WHERE rank = 1",
)
# With five folds there are four degrees of freedom, for which the tail has a short closed form.
ORACLE["paired_ttest"] = query(
    [
        *TO_SCORES,
        AUC,
        """pairs AS (
             SELECT a.run, a.model AS model_a, b.model AS model_b, avg(a.auc - b.auc) AS mean_diff,
                    avg(a.auc - b.auc) / (stddev_samp(a.auc - b.auc) / sqrt(count(*))) AS t
             FROM auc a JOIN auc b ON a.run = b.run AND a.fold = b.fold AND a.model < b.model
             WHERE a.run = 'cv' GROUP BY a.run, a.model, b.model
           ),
           tested AS (
             SELECT *, 1e0 - sqrt(t * t / (4e0 + t * t)) * (1e0 + 2e0 / (4e0 + t * t)) AS p_value FROM pairs
           )""",
    ],
    """SELECT run, model_a, model_b, round(mean_diff, 6) AS mean_diff, round(p_value, 6) AS p_value,
              p_value < 0.05e0 AS significant FROM tested""",
)
ORACLE["readiness"] = query(
    [*TO_METRICS, BETS],
    """SELECT m.run, m.model, m.auc >= 0.55e0 AS auc_above_minimum, m.ece <= 0.15e0 AS calibration_acceptable,
              m.auc > 0.5e0 AS better_than_coin_flip, b.final_bankroll > 1000e0 AS is_profitable,
              m.auc >= 0.55e0 AND m.ece <= 0.15e0 AND m.auc > 0.5e0 AND b.final_bankroll > 1000e0 AS production_ready,
              round(m.auc, 6) AS auc, round(m.ece, 6) AS ece, round((b.final_bankroll - 1000e0) / 10e0, 4) AS roi
       FROM fold_metrics m JOIN backtest b ON b.run = m.run AND b.model = m.model AND b.fold = m.fold
       WHERE m.run = 'test'""",
)
ORACLE["top_n"] = query(
    [*TO_METRICS, SUMMARY, BOARD],
    "SELECT model, rank, round(cv_auc_mean, 6) AS cv_auc_mean FROM board WHERE rank <= 2",
)

# --- feature analysis ------------------------------------------------------------------------


def _pairs(columns: list[str]) -> str:
    cells = ", ".join(
        f"{{'feature_a': '{a}', 'feature_b': '{b}', 'correlation': corr({a}, {b})}}"
        for i, a in enumerate(columns)
        for b in columns[i + 1 :]
    )
    return f"SELECT unnest([{cells}], recursive := true)"


ORACLE["corr_pairs"] = query(
    [GAMES, DERIVED, f"pairs AS ({_pairs(ALL_NUMERIC)} FROM derived)"],
    "SELECT feature_a, feature_b, round(correlation, 6) AS correlation FROM pairs",
)
ORACLE["corr_filter"] = query(
    [
        *TO_PREPARED,
        f"pairs AS ({_pairs(MODEL_FEATURES)} FROM prepared WHERE NOT is_test)",
        f"features AS (SELECT unnest({MODEL_FEATURES!r}) AS feature)",
    ],
    """SELECT feature, EXISTS (SELECT 1 FROM pairs WHERE feature_b = feature AND abs(correlation) > 0.9e0) AS dropped
       FROM features""",
)
STACKED = (
    "stacked AS (SELECT game_id, label, unnest(["
    + ", ".join(f"{{'feature': '{c}', 'x': {c}}}" for c in MODEL_FEATURES)
    + "], recursive := true) FROM prepared WHERE NOT is_test)"
)
ANOVA = """
classes AS (
  SELECT feature, label, count(*) AS n, avg(x) AS mean, var_pop(x) * count(*) AS within
  FROM stacked GROUP BY feature, label
),
grand AS (SELECT feature, avg(x) AS mean, count(*) AS n FROM stacked GROUP BY feature),
anova AS (
  SELECT c.feature, sum(c.n * (c.mean - g.mean) * (c.mean - g.mean)) / (sum(c.within) / (max(g.n) - 2)) AS score
  FROM classes c JOIN grand g ON g.feature = c.feature GROUP BY c.feature
)"""
ORACLE["anova_f"] = query(
    [*TO_PREPARED, STACKED, ANOVA], "SELECT feature, round(score, 4) AS score FROM anova"
)
ORACLE["rank_features"] = query(
    [*TO_PREPARED, STACKED, ANOVA],
    """SELECT feature, CAST(row_number() OVER (ORDER BY round(score, 6) DESC, feature) AS INTEGER) AS rank,
              row_number() OVER (ORDER BY round(score, 6) DESC, feature) <= 15 AS kept FROM anova""",
)
# Edges are the values at ranks ceil(i n / 32); a value's bin is the number of distinct edges below it.
BINNED = """sorted AS (
             SELECT feature, x, label, row_number() OVER (PARTITION BY feature ORDER BY x) AS pos,
                    count(*) OVER (PARTITION BY feature) AS n
             FROM stacked
           ),
           edges AS (
             SELECT DISTINCT s.feature, s.x AS edge FROM sorted s
             JOIN (SELECT unnest(range(1, 32)) AS i) q ON s.pos = greatest(ceil(q.i / 32e0 * s.n), 1)
           ),
           cells AS (
             SELECT s.feature, s.label, s.game_id, count(e.edge) AS bin
             FROM stacked s LEFT JOIN edges e ON e.feature = s.feature AND e.edge < s.x
             GROUP BY s.feature, s.label, s.game_id
           )"""
ORACLE["mutual_info"] = query(
    [
        *TO_PREPARED,
        STACKED,
        BINNED,
        """counts AS (SELECT feature, bin, label, count(*) * 1e0 AS n FROM cells GROUP BY feature, bin, label),
           shares AS (
             SELECT feature, n, sum(n) OVER (PARTITION BY feature) AS total,
                    sum(n) OVER (PARTITION BY feature, bin) AS in_bin,
                    sum(n) OVER (PARTITION BY feature, label) AS in_class
             FROM counts
           )""",
    ],
    "SELECT feature, round(greatest(sum(n / total * ln(n * total / (in_bin * in_class))), 0e0), 6) AS score"
    " FROM shares GROUP BY feature",
)


def _level(cells: str, name: str) -> str:
    """The best split of each node of ``cells(node, feature, place, bin, label)``: the lowest feature and bin of equal ones."""
    return f"""{name}_sums AS (
      SELECT node, feature, place, bin, sum(count(*)) OVER up AS nl, sum(sum(label)) OVER up AS yl,
             sum(count(*)) OVER (PARTITION BY node, feature) AS n, sum(sum(label)) OVER (PARTITION BY node, feature) AS y
      FROM {cells} GROUP BY node, feature, place, bin
      WINDOW up AS (PARTITION BY node, feature ORDER BY bin ROWS UNBOUNDED PRECEDING)),
    {name} AS (
      SELECT node, feature, bin, CAST(yl * yl AS DOUBLE) / nl + CAST((y - yl) * (y - yl) AS DOUBLE) / (n - nl) - CAST(y * y AS DOUBLE) / n AS decrease
      FROM {name}_sums WHERE nl < n AND y > 0 AND y < n
      QUALIFY row_number() OVER (PARTITION BY node ORDER BY CAST(yl * yl AS DOUBLE) / nl + CAST((y - yl) * (y - yl) AS DOUBLE) / (n - nl) DESC, place, bin) = 1)"""


_PLACES = ", ".join(f"('{c}', {i})" for i, c in enumerate(MODEL_FEATURES))
ORACLE["forest_levels"] = query(
    [
        *TO_PREPARED,
        STACKED,
        BINNED,
        f"places(feature, place) AS (VALUES {_PLACES})",
        "placed AS (SELECT 1 AS node, c.*, p.place FROM cells c JOIN places p ON c.feature = p.feature)",
        _level("placed", "root"),
        "told AS (SELECT c.game_id, CASE WHEN c.bin > r.bin THEN 3 ELSE 2 END AS node FROM cells c JOIN root r ON c.feature = r.feature)",
        "below AS (SELECT t.node, p.feature, p.place, p.bin, p.label FROM placed p JOIN told t ON p.game_id = t.game_id)",
        _level("below", "second"),
        "both_levels AS (SELECT * FROM root UNION ALL SELECT * FROM second)",
    ],
    "SELECT CAST(node AS BIGINT) AS node, feature, CAST(bin AS INTEGER) AS bin, round(decrease, 4) AS decrease FROM both_levels",
)

# --- neighbours and votes --------------------------------------------------------------------


def _near(k: int, distance: str) -> list[str]:
    return [
        "points AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings)",
        f"""near AS (
              SELECT * FROM (
                SELECT a.vec_id, b.vec_id AS neighbour, b.label, {distance} AS distance,
                       row_number() OVER (PARTITION BY a.vec_id ORDER BY {distance}, b.vec_id) AS place
                FROM points a JOIN points b ON a.vec_id <> b.vec_id)
              WHERE place <= {k})""",
    ]


EUCLIDEAN = "list_distance(a.v, b.v)"
MANHATTAN = "list_sum([abs(z[1] - z[2]) for z in list_zip(a.v, b.v)])"
VOTED = """
tallied AS (SELECT vec_id, label, sum(w) AS w FROM weighed GROUP BY vec_id, label),
voted AS (
  SELECT vec_id, label, w, sum(w) OVER (PARTITION BY vec_id) AS total,
         row_number() OVER (PARTITION BY vec_id ORDER BY w DESC, label) AS nth
  FROM tallied
)"""
ORACLE["knn_neighbours"] = query(
    _near(5, EUCLIDEAN),
    "SELECT vec_id, neighbour, label, CAST(place AS INTEGER) AS place, round(distance, 6) AS distance FROM near",
)
ORACLE["knn_vote"] = query(
    [*_near(5, EUCLIDEAN), "weighed AS (SELECT *, 1e0 AS w FROM near)", VOTED],
    "SELECT vec_id, label AS prediction, round(w / total, 6) AS share FROM voted WHERE nth = 1",
)
ORACLE["knn_vote_distance"] = query(
    [
        *_near(7, MANHATTAN),
        """weighed AS (SELECT *, CASE WHEN min(distance) OVER (PARTITION BY vec_id) = 0
                                      THEN CASE WHEN distance = 0 THEN 1e0 ELSE 0e0 END
                                      ELSE 1e0 / distance END AS w FROM near)""",
        VOTED,
    ],
    "SELECT vec_id, label AS prediction, round(w / total, 6) AS share FROM voted WHERE nth = 1",
)
ORACLE["soft_vote"] = query(
    TO_SCORES,
    """SELECT run, fold, game_id, max(y) AS y,
              round(sum(p * CASE WHEN model = 'balanced' THEN 2e0 ELSE 1e0 END) / 4e0, 6) AS p
       FROM scores GROUP BY run, fold, game_id""",
)
ORACLE["hard_vote"] = query(
    TO_SCORES,
    """SELECT run, fold, game_id, max(y) AS y,
              CASE WHEN count(*) FILTER (WHERE p > 0.5e0) >= 2 THEN 1e0 ELSE 0e0 END AS p
       FROM scores GROUP BY run, fold, game_id""",
)

# --- naive Bayes in closed form --------------------------------------------------------------


def bayes(
    asked: str,
    weights: str = "SELECT game_id, 0 AS i, 1 AS weight FROM laid_out",
    features: list[str] = MODEL_FEATURES,
    source: str = "prepared",
) -> list[str]:
    """The model's probabilities ``p(i, game_id, label, p)`` for the games asked for.

    ``weights`` gives each training game a weight in every sample ``i``.
    """
    cells = "unnest([" + ", ".join(f"{{'feature': '{c}', 'x': {c}}}" for c in features) + "], recursive := true)"
    return [
        f"stacked AS (SELECT game_id, label, {cells} FROM {source} WHERE NOT is_test)",
        f"weighed AS (SELECT s.*, w.i, w.weight::DOUBLE AS w FROM stacked s JOIN ({weights}) w ON w.game_id = s.game_id)",
        """centres AS (SELECT i, feature, label, sum(w * x) / sum(w) AS mean, sum(w) AS total
                       FROM weighed GROUP BY i, feature, label),
           middles AS (SELECT i, feature, sum(w * x) / sum(w) AS mean FROM weighed GROUP BY i, feature),
           spread AS (SELECT i, max(v) * 1e-9 AS epsilon FROM (
             SELECT s.i, sum(s.w * (s.x - m.mean) * (s.x - m.mean)) / sum(s.w) AS v
             FROM weighed s JOIN middles m ON m.i = s.i AND m.feature = s.feature GROUP BY s.i, s.feature) GROUP BY i),
           fitted AS (
             SELECT s.i, s.feature, s.label AS class, any_value(c.mean) AS mean, any_value(c.total) AS total,
                    sum(s.w * (s.x - c.mean) * (s.x - c.mean)) / any_value(c.total) + any_value(e.epsilon) AS var
             FROM weighed s JOIN centres c ON c.i = s.i AND c.feature = s.feature AND c.label = s.label
             JOIN spread e ON e.i = s.i GROUP BY s.i, s.feature, s.label),
           priors AS (SELECT i, class, ln(total / sum(total) OVER (PARTITION BY i, feature)) AS prior, feature FROM fitted)""",
        f"asked AS (SELECT game_id, label, {cells} FROM ({asked}))",
        """likelihood AS (
             SELECT f.i, a.game_id, a.label, f.class,
                    max(p.prior) - 0.5e0 * sum(ln(2e0 * pi() * f.var) + (a.x - f.mean) * (a.x - f.mean) / f.var) AS l
             FROM asked a JOIN fitted f ON f.feature = a.feature
             JOIN priors p ON p.class = f.class AND p.i = f.i AND p.feature = f.feature
             GROUP BY f.i, a.game_id, a.label, f.class),
           p AS (SELECT i, game_id, label, 1e0 / (1e0 + exp(sum(CASE WHEN class = 0 THEN l ELSE -l END))) AS p
                 FROM likelihood GROUP BY i, game_id, label)""",
    ]


TEST_GAMES = "SELECT * FROM prepared WHERE is_test"
ORACLE["nb_scores"] = query(
    [*TO_PREPARED, *bayes(TEST_GAMES)], "SELECT game_id, label, round(p, 4) AS p FROM p"
)
_V1 = [
    f"{side}_{name}"
    for side in ("home", "away")
    for name in (
        "team_rank", "days_rest", "team_avg_pts_scored", "team_avg_pts_scored_opp", "team_win_pct",
        "team_win_pct_last10",
    )
]
ORACLE["score_v1"] = query(
    [
        GAMES,
        DERIVED,
        LAYOUT,
        "filled AS (SELECT game_id, label, is_test, "
        + ", ".join(f"coalesce({c}, 0e0) AS {c}" for c in _V1)
        + " FROM laid_out)",
        *bayes("SELECT * FROM filled", features=_V1, source="filled"),
    ],
    """SELECT game_id, round_even(p, 3) AS home_team_predicted_win_pct,
              round_even(1e0 - p, 3) AS away_team_predicted_win_pct FROM p""",
)
ORACLE["score_v2"] = query(
    [*TO_PREPARED, *bayes("SELECT * FROM prepared")],
    """SELECT game_id, round_even(p, 3) AS home_team_predicted_win_pct,
              round_even(1e0 - p, 3) AS away_team_predicted_win_pct, FALSE AS stale FROM p""",
)

ORACLE["nightly"] = query(
    [GAMES],
    """SELECT 'flag off' AS run, 'disabled' AS state, NULL::BIGINT AS stored, NULL::BIGINT AS stamped
       UNION ALL SELECT 'no games', 'no games', NULL, NULL
       UNION ALL SELECT 'all', 'written', count(*), count(*) FROM (SELECT DISTINCT home_team, game_date FROM games)""",
)

# --- sampling --------------------------------------------------------------------------------

# Cumulative Poisson(1) chances.
_LIMITS = [
    "0.36787944117144233e0", "0.7357588823428847e0", "0.9196986029286058e0", "0.9810118431238462e0",
    "0.9963401531726563e0", "0.9994058151824183e0", "0.9999167588507119e0", "0.9999897508033253e0",
    "0.9999988747974020e0", "0.9999998885745217e0", "0.9999999899522336e0",
]


def _draws(iterations: int) -> list[str]:
    count = " ".join(f"WHEN u <= {limit} THEN {k}" for k, limit in enumerate(_LIMITS))
    return [
        f"""uniforms AS (
              SELECT game_id, home_team_win_pct, CAST(i AS INTEGER) AS iteration,
                     {UNIFORM} AS u
              FROM ({mixed_hash(f"games, (SELECT unnest(range({iterations})) AS i)", "game_id, home_team_win_pct, i", "42 + i")})
            ),
            draws AS (SELECT *, CASE {count} ELSE 11 END AS weight FROM uniforms)""",
    ]


ORACLE["bootstrap"] = query(
    [GAMES, *_draws(3)], "SELECT game_id, iteration, weight FROM draws WHERE weight > 0"
)
ORACLE["bootstrap_sizes"] = query(
    [GAMES, *_draws(10)],
    """SELECT iteration, CAST(sum(weight) AS BIGINT) AS n,
              round(sum(weight * home_team_win_pct) / sum(weight), 6) AS mean_win_pct
       FROM draws GROUP BY iteration""",
)
_BAGGED = [
    *TO_PREPARED,
    *_draws(10),
    *bayes(TEST_GAMES, "SELECT game_id, iteration AS i, weight FROM draws WHERE weight > 0"),
]
ORACLE["bag"] = query(_BAGGED, "SELECT game_id, label, round(avg(p), 4) AS p FROM p GROUP BY game_id, label")
ORACLE["bootstrap_majority"] = query(
    _BAGGED,
    """SELECT game_id, label, CAST(avg(CASE WHEN p > 0.5e0 THEN 1e0 ELSE 0e0 END) > 0.5e0 AS INTEGER) AS prediction
       FROM p GROUP BY game_id, label""",
)
ORACLE["win_probability"] = query(
    [GAMES],
    """SELECT game_id, round(1e0 / (1e0 + exp(-(
                (home_team_win_pct - away_team_win_pct) * 4e0 + 0.06e0
                + CASE WHEN home_games_last_7_days > 3 THEN -0.05e0 ELSE 0e0 END
                - CASE WHEN away_games_last_7_days > 3 THEN -0.05e0 ELSE 0e0 END
                + ((game_id % 25) / 100e0 - (game_id % 40) / 100e0) * 0.2e0))), 6) AS p
       FROM games""",
)

# --- calibration and folds -------------------------------------------------------------------

# The least mean of what ends at or behind a score, the greatest of what begins at or before it.
ORACLE["isotonic_curve"] = query(
    [
        *TO_SCORES,
        """points AS (SELECT round(p, 3) AS score, sum(y) AS won, count(*) AS n FROM scores WHERE model = 'balanced' GROUP BY 1),
           sums AS (SELECT score, row_number() OVER o AS k, sum(won) OVER o AS won, sum(n) OVER o AS n FROM points WINDOW o AS (ORDER BY score)),
           means AS (SELECT j.k AS j, k.k, k.score, (k.won - coalesce(b.won, 0)) * 1e0 / (k.n - coalesce(b.n, 0)) AS mean
                     FROM sums j JOIN sums k ON k.k >= j.k LEFT JOIN sums b ON b.k = j.k - 1),
           least AS (SELECT score, k, min(mean) OVER (PARTITION BY j ORDER BY k DESC ROWS UNBOUNDED PRECEDING) AS mean FROM means)""",
    ],
    "SELECT score, round(max(mean), 6) AS calibrated FROM least GROUP BY score",
)


def _bayes_but_a_fold() -> list[str]:
    """Naive Bayes with a sample per fold: all rows that are not in it."""
    others = """SELECT t.game_id, f.fold AS i, 1 AS weight FROM prepared t
                JOIN (SELECT DISTINCT fold FROM prepared WHERE NOT is_test) f ON f.fold IS DISTINCT FROM t.fold WHERE NOT t.is_test"""
    return bayes("SELECT * FROM prepared WHERE NOT is_test", others)


ORACLE["bayes_out_of_fold"] = query(
    [*TO_PREPARED, *_bayes_but_a_fold()],
    """SELECT p.game_id, p.label, p.i AS fold, round(p.p, 4) AS p FROM p JOIN prepared g ON g.game_id = p.game_id AND g.fold = p.i""",
)


def _exact_draws(iterations: int, share: str = "n") -> list[str]:
    draws = mixed_hash(
        f"(SELECT unnest(range((SELECT CAST({share} AS BIGINT) FROM (SELECT count(*) AS n FROM games)))) AS game_id), (SELECT unnest(range({iterations})) AS i)",
        "i", "42 + i",
    )
    return [
        "numbered AS (SELECT *, row_number() OVER (ORDER BY game_id) - 1 AS pos, count(*) OVER () AS n FROM games)",
        f"""drawn AS (SELECT CAST(i AS INTEGER) AS iteration, least(CAST(floor({UNIFORM} * (SELECT count(*) FROM games)) AS BIGINT),
                (SELECT count(*) FROM games) - 1) AS pos, count(*) AS weight FROM ({draws}) GROUP BY 1, 2)""",
    ]


ORACLE["bootstrap_exact"] = query(
    [GAMES, *_exact_draws(3)],
    "SELECT game_id, iteration, CAST(weight AS INTEGER) AS weight FROM drawn JOIN numbered USING (pos)",
)
ORACLE["bootstrap_exact_sizes"] = query(
    [GAMES, *_exact_draws(10)],
    """SELECT iteration, CAST(sum(weight) AS BIGINT) AS n, round(sum(weight * home_team_win_pct) / sum(weight), 6) AS mean_win_pct
       FROM drawn JOIN numbered USING (pos) GROUP BY iteration""",
)
ORACLE["augment_exact"] = query(
    [GAMES, *_exact_draws(1, "floor(n * 0.5)")],
    "SELECT game_id, home_team_rank, outcome, weight AS copies FROM drawn JOIN numbered USING (pos)",
)


def _psi(m: str) -> str:
    """psi of a number of at least 1, as a series six steps up."""
    y = f"(({m}) + 6e0)"
    back = " ".join(f"- 1e0 / (({m}) + {i}e0)" for i in range(6))
    return f"(ln({y}) - 0.5e0 / {y} - 1e0 / (12e0 * {y} ** 2) + 1e0 / (120e0 * {y} ** 4) - 1e0 / (252e0 * {y} ** 6) + 1e0 / (240e0 * {y} ** 8) {back})"


def _windows(k: int) -> str:
    """The least window with ``k`` others of the class, as (reach, lower, upper)."""
    found = []
    for j in range(k + 1):
        low, high = f"l{j}" if j else "x", f"r{k - j}" if k - j else "x"
        reach = f"greatest(x - {low}, {high} - x)"
        found.append(
            f"CASE WHEN {low} IS NOT NULL AND {high} IS NOT NULL THEN {{'reach': {reach}, 'lower': CASE WHEN x - {low} = {reach} THEN {low} ELSE x - {reach} END,"
            f" 'upper': CASE WHEN {high} - x = {reach} THEN {high} ELSE x + {reach} END}} END"
        )
    return f"list_min([w FOR w IN [{', '.join(found)}] IF w IS NOT NULL])"


_SIDES = ", ".join(f"lag(x, {j}) OVER o AS l{j}, lead(x, {j}) OVER o AS r{j}" for j in (1, 2, 3))
ORACLE["neighbour_info"] = query(
    [
        *TO_PREPARED,
        STACKED,
        f"""beside AS (SELECT *, count(*) OVER (PARTITION BY feature, label) AS of_class, {_SIDES}
              FROM stacked WINDOW o AS (PARTITION BY feature, label ORDER BY x, game_id)),
            bounded AS (SELECT feature, x, of_class, {_windows(3)} AS w FROM beside),
            ranks AS (SELECT feature, x, sum(count(*)) OVER (PARTITION BY feature ORDER BY x) AS up_to FROM stacked GROUP BY feature, x),
            uppers AS (SELECT b.*, coalesce(r.up_to, 0) AS below FROM bounded b ASOF LEFT JOIN ranks r ON r.feature = b.feature AND b.w.upper > r.x),
            lowers AS (SELECT u.*, coalesce(r.up_to, 0) AS at_lower FROM uppers u ASOF LEFT JOIN ranks r ON r.feature = u.feature AND u.w.lower >= r.x),
            same AS (SELECT l.*, r.up_to - coalesce(lag_up, 0) AS copies FROM lowers l
                     JOIN (SELECT *, lag(up_to) OVER (PARTITION BY feature ORDER BY x) AS lag_up FROM ranks) r ON r.feature = l.feature AND r.x = l.x),
            counted AS (SELECT feature, of_class, CASE WHEN w.reach = 0 THEN copies ELSE below - at_lower END AS m FROM same)""",
    ],
    f"""SELECT feature, round(greatest(any_value({_psi("total")}) + {_psi("3")} - avg({_psi("of_class")}) - avg({_psi("m")}), 0e0), 6) AS score
        FROM (SELECT *, count(*) OVER (PARTITION BY feature) AS total FROM counted) GROUP BY feature""",
)
