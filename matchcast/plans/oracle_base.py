"""Shared pieces of the oracle SQL: the game table, derived columns, time layout and score table."""

from __future__ import annotations

GAMES = """
games AS (
SELECT o.o_orderkey                                   AS game_id,
       CAST(o.o_orderdate AS DATE)                    AS game_date,
       h.c_name                                       AS home_team,
       a.c_name                                       AS away_team,
       CASE WHEN o.o_orderkey % 101 = 0 THEN NULL
            WHEN o.o_orderkey % 97 = 0 THEN 0e0
            WHEN o.o_orderkey % 2 = 0 THEN -(100e0 + o.o_orderkey % 300)
            ELSE 100e0 + o.o_orderkey % 400 END       AS home_moneyline,
       CASE WHEN o.o_orderkey % 2 = 0 THEN 100e0 + o.o_orderkey % 280
            ELSE -(100e0 + o.o_orderkey % 380) END    AS away_moneyline,
       CAST(1 + h.c_nationkey AS DOUBLE)              AS home_team_rank,
       CAST(1 + a.c_nationkey AS DOUBLE)              AS away_team_rank,
       CASE WHEN o.o_orderkey % 13 = 0 THEN NULL ELSE CAST(o.o_orderkey % 6 AS DOUBLE) END AS home_days_rest,
       CAST((o.o_orderkey + 2) % 5 AS DOUBLE)         AS away_days_rest,
       CASE WHEN o.o_orderkey % 29 = 0 THEN NULL ELSE CAST(1 + o.o_orderkey % 4 AS DOUBLE) END AS home_games_last_7_days,
       CAST(1 + (o.o_orderkey + 1) % 4 AS DOUBLE)     AS away_games_last_7_days,
       CASE WHEN o.o_orderkey % 31 = 0 THEN NULL ELSE o.o_totalprice / 100e0 END AS home_travel_miles_last_7_days,
       CAST((o.o_orderkey * 7) % 4000 AS DOUBLE)      AS away_travel_miles_last_7_days,
       CAST(CASE WHEN o.o_orderkey % 7 = 0 THEN 1 ELSE 0 END AS DOUBLE) AS home_is_cross_country_trip,
       CAST(CASE WHEN o.o_orderkey % 9 = 0 THEN 1 ELSE 0 END AS DOUBLE) AS away_is_cross_country_trip,
       CASE WHEN o.o_orderkey % 23 = 0 THEN NULL ELSE 105e0 + h.c_acctbal / 500e0 END AS home_team_avg_pts_scored,
       105e0 + a.c_acctbal / 500e0                    AS away_team_avg_pts_scored,
       115e0 - h.c_acctbal / 1000e0                   AS home_team_avg_pts_scored_opp,
       115e0 - a.c_acctbal / 1000e0                   AS away_team_avg_pts_scored_opp,
       ((o.o_custkey * 37) % 1000) / 1000e0           AS home_team_win_pct,
       ((a.c_custkey * 37) % 1000) / 1000e0           AS away_team_win_pct,
       (o.o_orderkey % 11) / 10e0                     AS home_team_win_pct_last10,
       ((o.o_orderkey * 3) % 11) / 10e0               AS away_team_win_pct_last10,
       CAST(o.o_orderkey % 6 AS DOUBLE)               AS home_star_score,
       CAST((o.o_orderkey * 5 + 1) % 6 AS DOUBLE)     AS away_star_score,
       h.c_acctbal / 2000e0                           AS home_active_vorp,
       a.c_acctbal / 2000e0                           AS away_active_vorp,
       CASE WHEN o.o_orderstatus = 'F' THEN 'W'
            WHEN o.o_orderstatus = 'O' THEN 'L'
            WHEN o.o_orderkey % 2 = 0 THEN 'W' ELSE 'L' END AS outcome
FROM orders o
JOIN customer h ON h.c_custkey = o.o_custkey
JOIN customer a ON a.c_custkey = (o.o_custkey * 7 + 3) % (SELECT count(*) FROM customer)
)"""

BASE_FEATURES = [
    "home_moneyline", "away_moneyline", "home_team_rank", "away_team_rank", "home_days_rest",
    "away_days_rest", "home_games_last_7_days", "away_games_last_7_days",
    "home_travel_miles_last_7_days", "away_travel_miles_last_7_days",
    "home_is_cross_country_trip", "away_is_cross_country_trip", "home_team_avg_pts_scored",
    "away_team_avg_pts_scored", "home_team_avg_pts_scored_opp", "away_team_avg_pts_scored_opp",
    "home_team_win_pct", "away_team_win_pct", "home_team_win_pct_last10",
    "away_team_win_pct_last10", "home_star_score", "away_star_score", "home_active_vorp",
    "away_active_vorp",
]


def _fatigue(side: str) -> str:
    return (
        f"(3e0 - least(coalesce({side}_days_rest, 2e0), 3e0)) * 1.5e0"
        f" + coalesce({side}_games_last_7_days, 2e0)"
        f" + 0.5e0 * ln(1e0 + coalesce({side}_travel_miles_last_7_days, 500e0))"
        f" + 2e0 * coalesce({side}_is_cross_country_trip, 0e0)"
    )


DERIVED_SQL = {
    "win_pct_diff": "home_team_win_pct - away_team_win_pct",
    "recent_form_diff": "home_team_win_pct_last10 - away_team_win_pct_last10",
    "rank_diff": "away_team_rank - home_team_rank",
    "star_score_diff": "home_star_score - away_star_score",
    "vorp_diff": "home_active_vorp - away_active_vorp",
    "travel_diff": "home_travel_miles_last_7_days - away_travel_miles_last_7_days",
    "home_net_rating": "home_team_avg_pts_scored - home_team_avg_pts_scored_opp",
    "away_net_rating": "away_team_avg_pts_scored - away_team_avg_pts_scored_opp",
    "net_rating_diff": "(home_team_avg_pts_scored - home_team_avg_pts_scored_opp)"
    " - (away_team_avg_pts_scored - away_team_avg_pts_scored_opp)",
    "home_fatigue_index": _fatigue("home"),
    "away_fatigue_index": _fatigue("away"),
    "fatigue_diff": f"({_fatigue('away')}) - ({_fatigue('home')})",
    "home_momentum": "home_team_win_pct_last10 - home_team_win_pct",
    "away_momentum": "away_team_win_pct_last10 - away_team_win_pct",
}
ALL_NUMERIC = BASE_FEATURES + list(DERIVED_SQL)
MODEL_FEATURES = [c for c in ALL_NUMERIC if not c.endswith("_moneyline")]

DERIVED = (
    "derived AS (SELECT *, "
    + ", ".join(f"{sql} AS {name}" for name, sql in DERIVED_SQL.items())
    + " FROM games)"
)

LAYOUT = """
ordered AS (
  SELECT *, row_number() OVER (ORDER BY game_date, home_team, away_team, game_id) - 1 AS pos,
         CAST(floor(count(*) OVER () * (1e0 - 0.2e0)) AS BIGINT) AS n_train
  FROM derived
),
laid_out AS (
  SELECT *, pos >= n_train AS is_test,
         CASE WHEN pos >= n_train THEN 5
              WHEN pos < n_train - 5 * (n_train // 6) THEN -1
              ELSE (pos - (n_train - 5 * (n_train // 6))) // (n_train // 6) END AS fold,
         CASE WHEN upper(outcome) = 'W' THEN 1 ELSE 0 END AS label
  FROM ordered
)"""

MEDIANS = (
    "medians AS (SELECT "
    + ", ".join(f"median({c}) AS m_{c}" for c in ALL_NUMERIC)
    + " FROM laid_out WHERE NOT is_test)"
)
PREPARED = (
    "prepared AS (SELECT game_id, game_date, home_team, away_team, is_test, fold, label, outcome, "
    + ", ".join(f"coalesce({c}, m_{c}) AS {c}" for c in ALL_NUMERIC)
    + " FROM laid_out, medians)"
)

SCORES = """
wide AS (
  SELECT *, CASE WHEN is_test THEN 'test' ELSE 'cv' END AS run,
         CASE WHEN is_test THEN 0 ELSE fold END AS block,
         0.06e0 + win_pct_diff * 1e0 + star_score_diff * 0.1e0 + fatigue_diff * 0.05e0 AS z_balanced,
         -0.1e0 + recent_form_diff * 1.5e0 + net_rating_diff * 0.02e0 + rank_diff * 0.01e0 AS z_form,
         0.2e0 + win_pct_diff * 4e0 + vorp_diff * 0.05e0 + travel_diff * -0.0001e0 AS z_strength
  FROM prepared WHERE fold >= 0
),
scores AS (
  SELECT run, 'balanced' AS model, block AS fold, game_id, label AS y, 1e0 / (1e0 + exp(-z_balanced)) AS p FROM wide
  UNION ALL
  SELECT run, 'form', block, game_id, label, 1e0 / (1e0 + exp(-z_form)) FROM wide
  UNION ALL
  SELECT run, 'strength', block, game_id, label, 1e0 / (1e0 + exp(-z_strength)) FROM wide
)"""

CONFUSION = """
confusion AS (
  SELECT run, model, fold,
         CAST(count(*) FILTER (WHERE p <= 0.5e0 AND y = 0) AS BIGINT) AS tn,
         CAST(count(*) FILTER (WHERE p > 0.5e0 AND y = 0) AS BIGINT) AS fp,
         CAST(count(*) FILTER (WHERE p <= 0.5e0 AND y = 1) AS BIGINT) AS fn,
         CAST(count(*) FILTER (WHERE p > 0.5e0 AND y = 1) AS BIGINT) AS tp
  FROM scores GROUP BY run, model, fold
)"""

CLASS_METRICS = """
class_metrics AS (
  SELECT run, model, fold, tn, fp, fn, tp,
         (tp + tn) * 1e0 / (tp + tn + fp + fn) AS accuracy,
         CASE WHEN tp + fp = 0 THEN 0e0 ELSE tp * 1e0 / (tp + fp) END AS precision,
         CASE WHEN tp + fn = 0 THEN 0e0 ELSE tp * 1e0 / (tp + fn) END AS recall,
         CASE WHEN 2 * tp + fp + fn = 0 THEN 0e0 ELSE 2e0 * tp / (2 * tp + fp + fn) END AS f1,
         CASE WHEN (tp + fp) * (tp + fn) * (tn + fp) * (tn + fn) = 0 THEN 0e0
              ELSE (tp * 1e0 * tn - fp * 1e0 * fn)
                   / sqrt((tp + fp) * 1e0 * (tp + fn) * (tn + fp) * (tn + fn)) END AS mcc
  FROM confusion
)"""

# Pairs of a positive and a negative won by the positive, from mid-ranks of the scores.
AUC = """
ranked AS (
  SELECT run, model, fold, y,
         rank() OVER (PARTITION BY run, model, fold ORDER BY p)
         + (count(*) OVER (PARTITION BY run, model, fold, p) - 1) / 2e0 AS mid_rank
  FROM scores
),
auc AS (
  SELECT run, model, fold,
         (sum(mid_rank) FILTER (WHERE y = 1) - sum(y) * (sum(y) + 1) / 2e0)
         / (sum(y) * 1e0 * sum(1 - y)) AS auc
  FROM ranked GROUP BY run, model, fold
)"""

ECE = """
bins AS (
  SELECT run, model, fold, least(greatest(ceil(p * 10e0) - 1, 0), 9) AS bin,
         count(*) AS n, avg(y * 1e0) AS won, avg(p) AS expected
  FROM scores GROUP BY run, model, fold, bin
),
ece AS (
  SELECT run, model, fold, sum(n * abs(won - expected)) / sum(n) AS ece FROM bins GROUP BY run, model, fold
)"""

LOSSES = """
losses AS (
  SELECT run, model, fold,
         -avg(y * ln(least(greatest(p, 2.220446049250313e-16), 1e0 - 2.220446049250313e-16))
              + (1 - y) * ln(1e0 - least(greatest(p, 2.220446049250313e-16), 1e0 - 2.220446049250313e-16))) AS log_loss,
         avg((p - y) * (p - y)) AS brier
  FROM scores GROUP BY run, model, fold
)"""

BETS = """
priced AS (
  SELECT s.*, g.home_moneyline AS ho, g.away_moneyline AS ao,
         CASE WHEN g.home_moneyline = 0 THEN 0.5e0 WHEN g.home_moneyline > 0 THEN 100e0 / (g.home_moneyline + 100e0)
              ELSE -g.home_moneyline / (100e0 - g.home_moneyline) END AS hi,
         CASE WHEN g.away_moneyline = 0 THEN 0.5e0 WHEN g.away_moneyline > 0 THEN 100e0 / (g.away_moneyline + 100e0)
              ELSE -g.away_moneyline / (100e0 - g.away_moneyline) END AS ai
  FROM scores s JOIN games g ON g.game_id = s.game_id
),
gains AS (
  SELECT *, CASE WHEN ho > 0 THEN ho / 100e0 WHEN ho < 0 THEN 100e0 / -ho END AS hb,
            CASE WHEN ao > 0 THEN ao / 100e0 WHEN ao < 0 THEN 100e0 / -ao END AS ab
  FROM priced
),
stakes AS (
  SELECT *,
         CASE WHEN hb IS NOT NULL AND p - hi > 0 AND p >= 0.5e0
              THEN least((p - hi) / hb * 0.25e0, 0.05e0) ELSE 0e0 END AS hs,
         CASE WHEN ab IS NOT NULL AND (1e0 - p) - ai > 0 AND 1e0 - p >= 0.5e0
              THEN least(((1e0 - p) - ai) / ab * 0.25e0, 0.05e0) ELSE 0e0 END AS aws
  FROM gains
),
backtest AS (
  SELECT run, model, fold,
         1000e0 * product(CASE WHEN hs > 0 THEN CASE WHEN y = 1 THEN 1e0 + hs * hb ELSE 1e0 - hs END
                               WHEN aws > 0 THEN CASE WHEN y = 0 THEN 1e0 + aws * ab ELSE 1e0 - aws END
                               ELSE 1e0 END) AS final_bankroll,
         count(*) FILTER (WHERE hs > 0 OR aws > 0) AS bets_placed,
         count(*) FILTER (WHERE (hs > 0 AND y = 1) OR (hs <= 0 AND aws > 0 AND y = 0)) AS bets_won
  FROM stakes GROUP BY run, model, fold
)"""

FOLD_METRICS = """
fold_metrics AS (
  SELECT c.run, c.model, c.fold, c.tn, c.fp, c.fn, c.tp, c.accuracy, c.precision, c.recall, c.f1, c.mcc,
         a.auc, l.log_loss, l.brier, e.ece
  FROM class_metrics c
  JOIN auc a ON a.run = c.run AND a.model = c.model AND a.fold = c.fold
  JOIN losses l ON l.run = c.run AND l.model = c.model AND l.fold = c.fold
  JOIN ece e ON e.run = c.run AND e.model = c.model AND e.fold = c.fold
)"""

TO_PREPARED = [GAMES, DERIVED, LAYOUT, MEDIANS, PREPARED]
TO_SCORES = [*TO_PREPARED, SCORES]
TO_METRICS = [*TO_SCORES, CONFUSION, CLASS_METRICS, AUC, ECE, LOSSES, FOLD_METRICS]


def query(ctes: list[str], select: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n" + select.strip()


def rounded(columns: list[str], digits: int = 6) -> str:
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in columns)
