"""Plain SQL twins of the operators, written step by step for DuckDB.

Each named step lists the steps it reads. They follow the definitions of the
features directly (user x day scaffolds, full outer joins, self-joins, window
functions over whole groups) and share no rewrite with the Spark side.
"""

from __future__ import annotations

from ebbtide import schema
from ebbtide.config import WindowConfig
from ebbtide.sources.adapter import DATE_SPREAD, TEST_WINDOWS

CFG: WindowConfig = TEST_WINDOWS
P = CFG.period_days
N = CFG.obs_periods


def _in(column: str, window, kind: str = "DATE") -> str:
    return f"{column} >= {kind} '{window[0]}' AND {column} < {kind} '{window[1]}'"


def _week(start, day: str) -> str:
    return f"CAST(floor(date_diff('day', DATE '{start}', {day}) / {P}.0) AS INTEGER) + 1"


_MINUTES = "date_diff('second', start_time, end_time) / 60.0::DOUBLE"
_DAY = f"DATE '2024-01-01' + CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) % {DATE_SPREAD} AS INTEGER)"
_ZERO = [f.name for f in schema.FEATURES if f.section != "payments" and f.when_absent == 0]
_SESSION = schema.names("sessions")


def _cells(names, template: str) -> str:
    return ",\n  ".join(template.format(c=c) for c in names)


# name -> (steps it reads, SQL)
STEPS: dict[str, tuple[tuple[str, ...], str]] = {
    "users": (
        (),
        """
SELECT c_custkey AS user_id,
  DATE '2023-01-01' + CAST(c_custkey % 365 AS INTEGER) AS signup_date,
  ['free', 'priority', 'ultimate'][CAST(c_custkey % 3 AS INTEGER) + 1] AS subscription_tier,
  ['PC', 'Mac', 'Chromebook', 'TV', 'Mobile'][CAST(c_custkey % 5 AS INTEGER) + 1] AS device_type,
  r_name AS region,
  ['organic', 'ad', 'friend_referral', 'bundled'][CAST(n_nationkey % 4 AS INTEGER) + 1] AS referral_source,
  ['18-24', '25-34', '35-44', '45+'][CAST((c_custkey // 3) % 4 AS INTEGER) + 1] AS age_group,
  ['M', 'F', 'other', 'undisclosed'][CAST((c_custkey // 7) % 4 AS INTEGER) + 1] AS gender,
  CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'hardcore' WHEN 'BUILDING' THEN 'regular'
    WHEN 'HOUSEHOLD' THEN 'about_to_churn' ELSE 'casual' END AS persona
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
    ),
    "sessions": (
        (),
        """
SELECT event_id AS session_id, user_id * 10 + event_id % 10 AS user_id, k * 21 AS game_id,
  ts AS start_time, ts + to_microseconds(CAST(round(value * 60000000) AS BIGINT)) AS end_time,
  value AS avg_latency_ms, CAST(k AS DOUBLE) AS avg_fps, event_id % 97 AS total_frame_drops,
  event_id % 4 AS disconnect_count, CAST(100 - k AS DOUBLE) AS avg_bitrate_mbps, value / 2 AS avg_jitter_ms,
  k / 1000.0::DOUBLE AS packet_loss_rate,
  CASE event_type WHEN 'error' THEN 'crash' WHEN 'signup' THEN 'disconnect'
    WHEN 'purchase' THEN 'timeout' ELSE 'normal' END AS exit_type
FROM (SELECT *, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k FROM events)""",
    ),
    "games": (
        (),
        """
SELECT p_partkey AS game_id, p_name AS game_title, p_type AS genre, p_brand AS publisher,
  CASE WHEN p_size <= 3 THEN 'S' WHEN p_size <= 10 THEN 'A' WHEN p_size <= 28 THEN 'B' ELSE 'C' END AS popularity_tier
FROM part""",
    ),
    "payments": (
        (),
        f"""
SELECT o_orderkey AS payment_id, o_custkey AS user_id, {_DAY} AS payment_date, o_totalprice AS amount_usd,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'day_pass' WHEN '2-HIGH' THEN 'in_app' ELSE 'subscription' END
    AS payment_type,
  CASE o_orderstatus WHEN 'F' THEN 'failed' WHEN 'P' THEN 'refunded' ELSE 'success' END AS status
FROM orders""",
    ),
    "sub_events": (
        (),
        f"""
SELECT o_orderkey AS event_id, o_custkey AS user_id, {_DAY} AS event_date,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'downgrade' WHEN '2-HIGH' THEN 'upgrade'
    WHEN '3-MEDIUM' THEN 'renew' ELSE 'cancel' END AS event_type
FROM orders""",
    ),
    "timed": (("sessions",), f"SELECT *, {_MINUTES} AS duration_min FROM sessions"),
    "obs": (
        ("timed",),
        f"""
SELECT *, CAST(start_time AS DATE) AS date, {_week(CFG.obs_start, "CAST(start_time AS DATE)")} AS week_num
FROM timed WHERE {_in("CAST(start_time AS DATE)", CFG.observation)}""",
    ),
    "weeks": ((), f"SELECT CAST(unnest(range(1, {N + 1})) AS INTEGER) AS week_num"),
    "user_week": (("obs", "weeks"), "SELECT user_id, week_num FROM (SELECT DISTINCT user_id FROM obs), weeks"),
    "dates": (
        (),
        f"""
SELECT CAST(d AS DATE) AS date, {_week(CFG.obs_start, "CAST(d AS DATE)")} AS week_num
FROM (SELECT unnest(generate_series(TIMESTAMP '{CFG.obs_start}', TIMESTAMP '{CFG.obs_end}' - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d)""",
    ),
    "user_date": (("obs", "dates"), "SELECT user_id, date, week_num FROM (SELECT DISTINCT user_id FROM obs), dates"),
    # sessions
    "patterns": (
        ("obs",),
        """
SELECT user_id, week_num, count(session_id) AS weekly_session_count, avg(duration_min) AS avg_session_duration_min,
  sum(duration_min) AS total_playtime_min,
  avg(CASE WHEN hour(start_time) BETWEEN 19 AND 23 THEN 1.0::DOUBLE ELSE 0 END) AS peak_hour_ratio,
  avg(CASE WHEN dayofweek(start_time) IN (0, 6) THEN 1.0::DOUBLE ELSE 0 END) AS weekend_ratio
FROM obs GROUP BY ALL""",
    ),
    "gaps": (
        ("obs",),
        """
SELECT user_id, week_num, session_id,
  date_diff('second', lag(end_time) OVER (PARTITION BY user_id, week_num ORDER BY start_time, session_id), start_time)
    / 60.0::DOUBLE AS inter_session_gap_min
FROM obs""",
    ),
    "regularity": (
        ("gaps",),
        """
SELECT user_id, week_num, coalesce(stddev_samp(inter_session_gap_min), 0) AS session_regularity
FROM gaps GROUP BY ALL""",
    ),
    "medians": (
        ("patterns",),
        """
SELECT week_num, quantile_disc(weekly_session_count, 0.5) AS pop_median_session_count,
  quantile_disc(total_playtime_min, 0.5) AS pop_median_playtime_min
FROM patterns GROUP BY week_num""",
    ),
    "session_features": (
        ("patterns", "regularity", "medians"),
        """
SELECT user_id, week_num, weekly_session_count, avg_session_duration_min, total_playtime_min, peak_hour_ratio,
  weekend_ratio, session_regularity,
  weekly_session_count / nullif(pop_median_session_count, 0)::DOUBLE AS weekly_session_count_norm,
  total_playtime_min / nullif(pop_median_playtime_min, 0) AS total_playtime_min_norm
FROM patterns JOIN regularity USING (user_id, week_num) JOIN medians USING (week_num)""",
    ),
    "filled": (
        ("user_week", "session_features"),
        f"""
SELECT user_id, week_num,
  {_cells(_SESSION, "coalesce({c}, 0) AS {c}")}
FROM user_week LEFT JOIN session_features USING (user_id, week_num)""",
    ),
    # engagement
    "wow": (
        ("filled",),
        """
SELECT user_id, week_num, (c - pc) / nullif(pc, 0) AS session_count_wow_change, (p - pp) / nullif(pp, 0) AS playtime_wow_change
FROM (SELECT user_id, week_num, weekly_session_count_norm AS c, total_playtime_min_norm AS p,
  lag(weekly_session_count_norm) OVER w AS pc, lag(total_playtime_min_norm) OVER w AS pp
  FROM filled WINDOW w AS (PARTITION BY user_id ORDER BY week_num))""",
    ),
    "baseline": (
        ("timed",),
        f"""
SELECT user_id, count(session_id) / {CFG.baseline_periods}.0::DOUBLE AS baseline_avg_session_count,
  sum(duration_min) / {CFG.baseline_periods}.0::DOUBLE AS baseline_avg_playtime
FROM timed WHERE {_in("CAST(start_time AS DATE)", CFG.baseline)} GROUP BY user_id""",
    ),
    "ratios": (
        ("filled", "baseline"),
        """
SELECT user_id, week_num, weekly_session_count / nullif(baseline_avg_session_count, 0) AS session_count_vs_baseline,
  total_playtime_min / nullif(baseline_avg_playtime, 0) AS playtime_vs_baseline
FROM filled LEFT JOIN baseline USING (user_id)""",
    ),
    "activity": (
        ("user_date", "obs"),
        """
SELECT user_id, date, week_num, had_session,
  sum(had_session) OVER (PARTITION BY user_id ORDER BY date ROWS UNBOUNDED PRECEDING) AS session_cumsum
FROM (SELECT u.user_id, u.date, u.week_num, CASE WHEN s.user_id IS NULL THEN 0 ELSE 1 END AS had_session
  FROM user_date u LEFT JOIN (SELECT DISTINCT user_id, date FROM obs) s ON u.user_id = s.user_id AND u.date = s.date)""",
    ),
    "streaks": (
        ("activity",),
        """
SELECT *, row_number() OVER (PARTITION BY user_id, session_cumsum ORDER BY date) AS streak_len
FROM activity WHERE had_session = 0""",
    ),
    "longest": (
        ("streaks",),
        "SELECT user_id, week_num, max(streak_len) AS longest_inactive_days FROM streaks GROUP BY ALL",
    ),
    "engagement": (
        ("wow", "ratios", "longest"),
        """
SELECT user_id, week_num, session_count_wow_change, playtime_wow_change, session_count_vs_baseline,
  playtime_vs_baseline, coalesce(longest_inactive_days, 0) AS longest_inactive_days
FROM wow FULL JOIN ratios USING (user_id, week_num) FULL JOIN longest USING (user_id, week_num)""",
    ),
    # quality
    "quality": (
        ("obs",),
        f"""
SELECT user_id, week_num,
  {_cells(schema.QUALITY_MEANS.items(), "avg({c[1]}) AS {c[0]}")},
  avg(CASE WHEN exit_type IN ('crash', 'disconnect', 'timeout') THEN 1.0::DOUBLE ELSE 0 END) AS crash_exit_ratio
FROM obs GROUP BY user_id, week_num""",
    ),
    # diversity
    "game_shares": (
        ("obs",),
        """
SELECT *, game_playtime / nullif(sum(game_playtime) OVER (PARTITION BY user_id, week_num), 0) AS playtime_share
FROM (SELECT user_id, week_num, game_id, sum(duration_min) AS game_playtime FROM obs GROUP BY ALL)""",
    ),
    "game_basic": (
        ("game_shares",),
        """
SELECT user_id, week_num, count(DISTINCT game_id) AS unique_games_played, max(playtime_share) AS top_game_concentration
FROM game_shares GROUP BY ALL""",
    ),
    "genre_counts": (
        ("obs", "games"),
        """
SELECT user_id, week_num, genre, count(session_id) AS genre_sessions
FROM obs LEFT JOIN games USING (game_id) GROUP BY ALL""",
    ),
    "entropy": (
        ("genre_counts",),
        """
SELECT user_id, week_num, sum(-p * log2(p)) AS genre_entropy
FROM (SELECT user_id, week_num, genre_sessions::DOUBLE / sum(genre_sessions) OVER (PARTITION BY user_id, week_num) AS p
  FROM genre_counts) GROUP BY ALL""",
    ),
    "played": (("obs",), "SELECT DISTINCT user_id, week_num, game_id FROM obs"),
    "trial": (
        ("played",),
        """
SELECT a.user_id, a.week_num,
  CASE WHEN any_value(f.first_week) < a.week_num THEN
    count(*) FILTER (NOT EXISTS (SELECT 1 FROM played b
      WHERE b.user_id = a.user_id AND b.game_id = a.game_id AND b.week_num < a.week_num)) / count(*)::DOUBLE END
    AS new_game_trial_rate
FROM played a JOIN (SELECT user_id, min(week_num) AS first_week FROM played GROUP BY user_id) f ON a.user_id = f.user_id
GROUP BY a.user_id, a.week_num""",
    ),
    "diversity": (
        ("game_basic", "entropy", "trial"),
        """
SELECT user_id, week_num, unique_games_played, top_game_concentration, genre_entropy, new_game_trial_rate
FROM game_basic FULL JOIN entropy USING (user_id, week_num) FULL JOIN trial USING (user_id, week_num)""",
    ),
    # volatility
    "daily": (
        ("obs",),
        "SELECT user_id, week_num, date, sum(duration_min) AS daily_playtime_min FROM obs GROUP BY ALL",
    ),
    "daily_dense": (
        ("user_date", "daily"),
        """
SELECT u.user_id, u.week_num, u.date, coalesce(d.daily_playtime_min, 0) AS daily_playtime_min
FROM user_date u LEFT JOIN daily d ON u.user_id = d.user_id AND u.date = d.date""",
    ),
    "duration_std": (
        ("obs",),
        "SELECT user_id, week_num, stddev_samp(duration_min) AS session_duration_std FROM obs GROUP BY ALL",
    ),
    "volatility": (
        ("daily_dense", "duration_std"),
        """
SELECT user_id, week_num, daily_playtime_std, daily_playtime_std / nullif(m, 0) AS daily_playtime_cv, session_duration_std
FROM (SELECT user_id, week_num, stddev_samp(daily_playtime_min) AS daily_playtime_std, avg(daily_playtime_min) AS m
  FROM daily_dense GROUP BY ALL) FULL JOIN duration_std USING (user_id, week_num)""",
    ),
    # payments
    "static": (
        ("users",),
        f"""
SELECT user_id, CASE subscription_tier WHEN 'free' THEN 0 WHEN 'priority' THEN 1 WHEN 'ultimate' THEN 2 END
    AS current_tier_numeric,
  date_diff('day', signup_date, DATE '{CFG.obs_start}') AS days_since_signup
FROM users""",
    ),
    "sub_changes": (
        ("sub_events",),
        f"""
SELECT user_id, count(event_id) AS tier_changes_count, max(CASE WHEN event_type = 'downgrade' THEN 1 ELSE 0 END)
  AS has_downgraded
FROM sub_events WHERE {_in("event_date", CFG.observation)} GROUP BY user_id""",
    ),
    "paid": (
        ("payments",),
        f"""
SELECT user_id, sum(CASE WHEN status = 'success' THEN amount_usd ELSE 0 END) AS total_spend_last_4w,
  count(payment_id) AS payment_count_last_4w,
  sum(CASE WHEN status = 'failed' THEN 1 ELSE 0 END) AS failed_payment_count,
  sum(CASE WHEN status = 'refunded' THEN 1 ELSE 0 END) AS refund_count,
  date_diff('day', max(CASE WHEN status = 'success' THEN payment_date END), DATE '{CFG.obs_end}')
    AS days_since_last_payment
FROM payments WHERE {_in("payment_date", CFG.observation)} GROUP BY user_id""",
    ),
    "frequency": (
        ("payments",),
        f"""
SELECT user_id, (coalesce(o, 0) - coalesce(b, 0)) / nullif(coalesce(b, 0), 0)::DOUBLE AS payment_frequency_change
FROM (SELECT user_id, count(payment_id) AS o FROM payments WHERE {_in("payment_date", CFG.observation)} GROUP BY 1)
FULL JOIN (SELECT user_id, count(payment_id) AS b FROM payments WHERE {_in("payment_date", CFG.baseline)} GROUP BY 1)
  USING (user_id)""",
    ),
    "pay": (
        ("static", "sub_changes", "paid", "frequency"),
        """
SELECT user_id, current_tier_numeric, days_since_signup, coalesce(tier_changes_count, 0) AS tier_changes_count,
  coalesce(has_downgraded, 0) AS has_downgraded, coalesce(total_spend_last_4w, 0) AS total_spend_last_4w,
  coalesce(payment_count_last_4w, 0) AS payment_count_last_4w,
  coalesce(failed_payment_count, 0) AS failed_payment_count, coalesce(refund_count, 0) AS refund_count,
  days_since_last_payment, payment_frequency_change
FROM static LEFT JOIN sub_changes USING (user_id) LEFT JOIN paid USING (user_id) LEFT JOIN frequency USING (user_id)""",
    ),
    # merged
    "weekly": (
        ("filled", "engagement", "quality", "diversity", "volatility", "pay", "weeks"),
        f"""
SELECT user_id, week_num,
  {", ".join(f"coalesce({c}, 0) AS {c}" if c in _ZERO else c for c in schema.names())}
FROM filled FULL JOIN engagement USING (user_id, week_num) FULL JOIN quality USING (user_id, week_num)
  FULL JOIN diversity USING (user_id, week_num) FULL JOIN volatility USING (user_id, week_num)
  FULL JOIN (SELECT * FROM pay, weeks) USING (user_id, week_num)""",
    ),
    "labels": (
        ("users", "sessions"),
        f"""
SELECT user_id, CASE WHEN user_id IN (SELECT user_id FROM sessions
  WHERE {_in("CAST(start_time AS DATE)", CFG.prediction)}) THEN 0 ELSE 1 END AS churn
FROM users""",
    ),
    "flat": (
        ("weekly", "labels"),
        f"""
SELECT m.*, l.* EXCLUDE (user_id), s.* EXCLUDE (user_id), r.playtime_slope, y.churn
FROM (SELECT user_id, {", ".join(f"avg({c}) AS {c}" for c in schema.flat_names("mean"))} FROM weekly GROUP BY user_id) m
JOIN (SELECT user_id, {", ".join(f"{c} AS {c}_last" for c in schema.flat_names("last"))}
  FROM weekly WHERE week_num = {N}) l USING (user_id)
JOIN (SELECT user_id, {", ".join(schema.flat_names("static"))} FROM weekly WHERE week_num = 1) s USING (user_id)
JOIN (SELECT user_id, (count(*) * sum(week_num * total_playtime_min) - sum(week_num) * sum(total_playtime_min))
    / (count(*) * sum(week_num * week_num) - sum(week_num) * sum(week_num))::DOUBLE AS playtime_slope
  FROM weekly GROUP BY user_id) r USING (user_id)
LEFT JOIN labels y USING (user_id)""",
    ),
    "seq_filled": (
        ("weekly",),
        f"""
SELECT user_id, week_num,
  {", ".join(f"coalesce({f.name}, {f.sequence_fill})::DOUBLE AS {f.name}" for f in schema.FEATURES)}
FROM weekly""",
    ),
    "seq_matrix": (
        ("seq_filled", "labels"),
        f"""
SELECT user_id, string_agg(concat_ws(',', {", ".join(
    f"CAST(floor({c} * 1e6::DOUBLE + 0.501::DOUBLE) AS BIGINT)" for c in schema.names())}), ';' ORDER BY week_num) AS X,
  any_value(churn) AS churn
FROM seq_filled JOIN labels USING (user_id) GROUP BY user_id""",
    ),
    "seq_rows": (
        ("seq_filled", "labels"),
        f"""
SELECT user_id, week_num, feature, value, churn
FROM (UNPIVOT seq_filled ON {", ".join(schema.names())} INTO NAME feature VALUE value) JOIN labels USING (user_id)""",
    ),
    "split": (
        ("labels",),
        """
SELECT user_id, churn, CASE WHEN r <= t THEN 'train' WHEN r <= t + v THEN 'val' ELSE 'test' END AS split
FROM (SELECT user_id, churn, row_number() OVER (PARTITION BY churn ORDER BY md5(user_id || '|42'), user_id) AS r,
  floor(count(*) OVER (PARTITION BY churn) * 0.7::DOUBLE) AS t,
  floor(count(*) OVER (PARTITION BY churn) * 0.15::DOUBLE) AS v FROM labels)""",
    ),
    "seg": (("weekly", "users"), "SELECT w.*, persona FROM weekly w JOIN users USING (user_id)"),
}


def with_steps(select: str, *needed: str) -> str:
    """``select`` preceded by the steps it reads, directly or through others."""
    wanted: dict[str, None] = {}

    def visit(name: str) -> None:
        for earlier in STEPS[name][0]:
            visit(earlier)
        wanted.setdefault(name)

    for name in needed:
        visit(name)
    if not wanted:
        return select
    steps = ",\n".join(f"{name} AS ({STEPS[name][1].strip()})" for name in wanted)
    return f"WITH {steps}\n{select}"
