"""Every registered query with its SQL twin."""

from __future__ import annotations

from pyspark.sql import functions as F

from ebbtide import schema
from ebbtide.functions import exprs as X
from ebbtide.operators import (
    checks, diversity, engagement, flat, gaps, norm, payments, profile, scaffold, sequence, sketches, split,
)
from ebbtide.operators import sessions as session_ops
from ebbtide.queries import oracle
from ebbtide.queries.base import Inputs, Query
from ebbtide.sources import sinks

K = "user_id week_num"
CFG = Inputs.cfg


def _spec(names, doubles_only: bool = False) -> str:
    return " ".join(f"{c}:{'i' if c in schema.INTEGRAL and not doubles_only else 'd'}" for c in names)


def _from(step: str) -> str:
    return f"SELECT * FROM {step}"


def _weekly_subset(section: str) -> str:
    return f"{K} {_spec(schema.names(section))}"


# --- sources, filters, derived columns -----------------------------------------------------


def _raw() -> list[Query]:
    first, last = CFG.observation
    return [
        Query(
            "scan_sessions",
            "session_id user_id game_id start_time:s end_time:s avg_latency_ms:d avg_fps:d total_frame_drops "
            "disconnect_count avg_bitrate_mbps:d avg_jitter_ms:d packet_loss_rate:d exit_type",
            lambda q: q.tables.sessions,
            _from("sessions"),
            ("sessions",),
        ),
        Query(
            "scan_pruned",
            "user_id start_time:s",
            lambda q: q.tables.sessions.select("user_id", "start_time"),
            "SELECT user_id, start_time FROM sessions",
            ("sessions",),
        ),
        Query("scan_users", "user_id signup_date:s subscription_tier device_type region referral_source age_group gender persona",
              lambda q: q.tables.users, _from("users"), ("users",)),
        Query("scan_games", "game_id game_title genre publisher popularity_tier",
              lambda q: q.tables.games, _from("games"), ("games",)),
        Query("scan_payments", "payment_id user_id payment_date:s amount_usd:d payment_type status",
              lambda q: q.tables.payments, _from("payments"), ("payments",)),
        Query("scan_sub_events", "event_id user_id event_date:s event_type",
              lambda q: q.tables.sub_events, _from("sub_events"), ("sub_events",)),
        Query(
            "filter_obs_window",
            "session_id user_id start_time:s",
            lambda q: q.tables.sessions.filter(X.ts_within("start_time", CFG.observation)),
            f"SELECT * FROM sessions WHERE CAST(start_time AS DATE) >= DATE '{first}' "
            f"AND CAST(start_time AS DATE) < DATE '{last}'",
            ("sessions",),
        ),
        Query(
            "filter_obs_payments",
            "payment_id user_id payment_date:s amount_usd:d status",
            lambda q: q.tables.payments.filter(X.date_within("payment_date", CFG.observation)),
            f"SELECT * FROM payments WHERE payment_date >= DATE '{first}' AND payment_date < DATE '{last}'",
            ("payments",),
        ),
        Query("obs_sessions", "session_id user_id game_id date:s week_num duration_min:d",
              lambda q: q.obs, _from("obs"), ("obs",)),
        Query(
            "calendar_week_index",
            "session_id week_num:i",
            lambda q: q.tables.sessions.select(
                "session_id",
                X.period_index(CFG.data_start, F.col("start_time").cast("date"), CFG.period_days).alias("week_num"),
            ),
            f"SELECT session_id, {oracle._week(CFG.data_start, 'CAST(start_time AS DATE)')} AS week_num FROM sessions",
            ("sessions",),
        ),
        Query("scaffold_user_week", K, lambda q: scaffold.user_weeks(scaffold.observed_users(q.obs), CFG),
              _from("user_week"), ("user_week",)),
        Query("scaffold_user_date", f"{K} date:s", lambda q: scaffold.user_dates(scaffold.observed_users(q.obs), CFG),
              _from("user_date"), ("user_date",)),
        Query("active_user_dates", "user_id date:s", lambda q: q.obs.select("user_id", "date").distinct(),
              "SELECT DISTINCT user_id, date FROM obs", ("obs",)),
    ]


# --- weekly features ------------------------------------------------------------------------


def _profile(q: Inputs):
    return session_ops.session_profile(q.obs, CFG)


def _session_features(q: Inputs):
    joined = _profile(q).join(gaps.session_regularity(q.obs), list(schema.KEYS), "left")
    return norm.population_norm(joined, norm.population_medians(session_ops.weekly_totals(q.obs)))


def _dense(q: Inputs):
    dense = scaffold.fill_missing_weeks(_session_features(q), CFG)
    return dense.fillna(0, subset=[c for c in schema.names("sessions")])


def _dense_daily(q: Inputs):
    dates = scaffold.user_dates(scaffold.observed_users(q.obs), CFG)
    daily = session_ops.daily_playtime(q.obs).drop("week_num")
    return dates.join(daily, ["user_id", "date"], "left").fillna(0, subset=["daily_playtime_min"])


def _activity(q: Inputs):
    return engagement.daily_activity(scaffold.fill_missing_weeks(_profile(q), CFG), CFG)


def _volatility(q: Inputs):
    dense = scaffold.fill_missing_weeks(_profile(q), CFG)
    return dense.fillna(0, subset=["daily_playtime_std"])


def _features() -> list[Query]:
    patterns = ["weekly_session_count", "avg_session_duration_min", "total_playtime_min", "peak_hour_ratio", "weekend_ratio"]
    return [
        Query("session_patterns", f"{K} {_spec(patterns)}", _profile, _from("patterns"), ("patterns",)),
        Query(
            "inter_session_gap", f"{K} session_id inter_session_gap_min:d",
            lambda q: gaps.inter_session_gaps(q.obs).withColumn("inter_session_gap_min", F.col("gap_s") / F.lit(60.0)),
            _from("gaps"), ("gaps",),
        ),
        Query("session_regularity", f"{K} session_regularity:d", lambda q: gaps.session_regularity(q.obs),
              _from("regularity"), ("regularity",)),
        Query("population_medians", "week_num pop_median_session_count:d pop_median_playtime_min:d",
              lambda q: norm.population_medians(session_ops.weekly_totals(q.obs)), _from("medians"), ("medians",)),
        Query("population_norm", f"{K} weekly_session_count_norm:d total_playtime_min_norm:d", _session_features,
              _from("session_features"), ("session_features",)),
        Query("session_features", _weekly_subset("sessions"), _session_features,
              _from("session_features"), ("session_features",)),
        Query("session_features_filled", _weekly_subset("sessions"), _dense, _from("filled"), ("filled",)),
        Query("wow_change", f"{K} session_count_wow_change:d playtime_wow_change:d",
              lambda q: engagement.wow_change(_dense(q)), _from("wow"), ("wow",)),
        Query("user_baseline", "user_id baseline_avg_session_count:d baseline_avg_playtime:d",
              lambda q: engagement.user_baseline(q.tables.sessions, CFG), _from("baseline"), ("baseline",)),
        Query("baseline_ratios", f"{K} session_count_vs_baseline:d playtime_vs_baseline:d",
              lambda q: engagement.baseline_ratios(_dense(q), engagement.user_baseline(q.tables.sessions, CFG)),
              _from("ratios"), ("ratios",)),
        Query("activity_cumsum", "user_id date:s week_num had_session:i session_cumsum:i", _activity,
              _from("activity"), ("activity",)),
        Query("inactive_streaks", "user_id date:s week_num streak_len:i",
              lambda q: engagement.inactive_streaks(_activity(q)), _from("streaks"), ("streaks",)),
        Query(
            "longest_inactive_days", f"{K} longest_inactive_days:i",
            lambda q: engagement.longest_inactive_days(scaffold.fill_missing_weeks(_profile(q), CFG), CFG),
            "SELECT user_id, week_num, coalesce(longest_inactive_days, 0) AS longest_inactive_days "
            "FROM user_week LEFT JOIN longest USING (user_id, week_num)", ("user_week", "longest"),
        ),
        Query(
            "engagement_features", _weekly_subset("engagement"),
            lambda q: engagement.baseline_ratios(
                engagement.wow_change(engagement.longest_inactive_days(_dense(q), CFG)),
                engagement.user_baseline(q.tables.sessions, CFG),
            ),
            _from("engagement"), ("engagement",),
        ),
        Query("streaming_quality", _weekly_subset("quality"), _profile, _from("quality"), ("quality",)),
        Query("crash_exit_ratio", f"{K} crash_exit_ratio:d", _profile, _from("quality"), ("quality",)),
        Query("game_share", f"{K} game_id game_playtime:d playtime_share:d",
              lambda q: diversity.game_share(q.played), _from("game_shares"), ("game_shares",)),
        Query("unique_games", f"{K} unique_games_played:i", lambda q: diversity.game_profile(q.obs, q.tables.games, CFG),
              _from("game_basic"), ("game_basic",)),
        Query("top_game_concentration", f"{K} top_game_concentration:d",
              lambda q: diversity.game_profile(q.obs, q.tables.games, CFG), _from("game_basic"), ("game_basic",)),
        Query("genre_counts", f"{K} genre genre_sessions:i", lambda q: diversity.genre_weeks(q.played, q.tables.games),
              _from("genre_counts"), ("genre_counts",)),
        Query("genre_entropy", f"{K} genre_entropy:d", lambda q: diversity.game_profile(q.obs, q.tables.games, CFG),
              _from("entropy"), ("entropy",)),
        Query("user_week_games", f"{K} game_id", lambda q: q.played, _from("played"), ("played",)),
        Query(
            "prior_games", f"{K} n_prior_games:i n_new_games:i", lambda q: diversity.prior_game_counts(q.played),
            """SELECT w.user_id, w.week_num,
  (SELECT count(DISTINCT game_id) FROM played b WHERE b.user_id = w.user_id AND b.week_num < w.week_num) AS n_prior_games,
  (SELECT count(*) FROM played c WHERE c.user_id = w.user_id AND c.week_num = w.week_num AND NOT EXISTS (
    SELECT 1 FROM played d WHERE d.user_id = c.user_id AND d.game_id = c.game_id AND d.week_num < c.week_num)) AS n_new_games
FROM (SELECT DISTINCT user_id, week_num FROM played) w""", ("played",),
        ),
        Query("new_game_trial_rate", f"{K} new_game_trial_rate:d",
              lambda q: diversity.game_features(q.obs, q.tables.games, CFG), _from("trial"), ("trial",)),
        Query("game_features", _weekly_subset("diversity"),
              lambda q: diversity.game_features(q.obs, q.tables.games, CFG), _from("diversity"), ("diversity",)),
        Query("daily_playtime", f"{K} date:s daily_playtime_min:d", lambda q: session_ops.daily_playtime(q.obs),
              _from("daily"), ("daily",)),
        Query("daily_playtime_dense", f"{K} date:s daily_playtime_min:d", _dense_daily, _from("daily_dense"), ("daily_dense",)),
        Query("session_duration_std", f"{K} session_duration_std:d", _profile, _from("duration_std"), ("duration_std",)),
        Query("volatility_features", _weekly_subset("volatility"), _volatility, _from("volatility"), ("volatility",)),
        Query("user_static", "user_id current_tier_numeric:i days_since_signup:i",
              lambda q: payments.user_static(q.tables.users, CFG), _from("static"), ("static",)),
        Query("subscription_events_agg", "user_id tier_changes_count:i has_downgraded:i",
              lambda q: payments.subscription_changes(q.tables.sub_events, CFG), _from("sub_changes"), ("sub_changes",)),
        Query(
            "payment_agg",
            "user_id total_spend_last_4w:d payment_count_last_4w:i failed_payment_count:i refund_count:i "
            "days_since_last_payment:i",
            lambda q: payments.payment_summary(q.tables.payments, CFG).filter("n_now > 0"),
            _from("paid"), ("paid",),
        ),
        Query("payment_frequency_change", "user_id payment_frequency_change:d",
              lambda q: payments.payment_summary(q.tables.payments, CFG), _from("frequency"), ("frequency",)),
        Query(
            "payment_features", f"user_id {_spec(schema.names('payments'))}",
            lambda q: payments.payment_features(q.tables.users, q.tables.sub_events, q.tables.payments, CFG),
            _from("pay"), ("pay",),
        ),
        Query("weekly_features", f"{K} {_spec(schema.names())}", lambda q: q.weekly, _from("weekly"), ("weekly",)),
    ]


# --- datasets ---------------------------------------------------------------------------------


def _flat_columns() -> list[str]:
    last = [c.split(":")[0] for c in _last_spec().split()]
    return [*schema.flat_names("mean"), *last, *schema.flat_names("static"), "playtime_slope"]


def _last_spec() -> str:
    return " ".join(
        f"{c}_last:{'i' if c in schema.INTEGRAL else 'd'}" for c in schema.flat_names("last")
    )


def _flat_spec() -> str:
    return (
        f"user_id {_spec(schema.flat_names('mean'), doubles_only=True)} {_last_spec()} "
        f"{_spec(schema.flat_names('static'))} playtime_slope:d churn:i"
    )


def _datasets() -> list[Query]:
    by_user = lambda q, *cells: q.weekly.groupBy("user_id").agg(*cells)
    return [
        Query("churn_labels", "user_id churn:i", lambda q: q.labels, _from("labels"), ("labels",)),
        Query("flat_means", f"user_id {_spec(schema.flat_names('mean'), doubles_only=True)}",
              lambda q: by_user(q, *flat.mean_columns()), _from("flat"), ("flat",)),
        Query("flat_last_week", f"user_id {_last_spec()}",
              lambda q: by_user(q, *flat.last_columns(CFG)), _from("flat"), ("flat",)),
        Query("flat_static", f"user_id {_spec(schema.flat_names('static'))}",
              lambda q: by_user(q, *flat.static_columns()), _from("flat"), ("flat",)),
        Query("playtime_slope", "user_id playtime_slope:d",
              lambda q: by_user(q, flat.slope_column()), _from("flat"), ("flat",)),
        Query("flat_dataset", _flat_spec(), lambda q: q.flat, _from("flat"), ("flat",)),
        Query("sequence_filled", f"{K} {_spec(schema.names(), doubles_only=True)}",
              lambda q: sequence.sequence_filled(q.weekly), _from("seq_filled"), ("seq_filled",)),
        Query("sequence_dataset", f"{K} feature value:d churn:i",
              lambda q: sequence.sequence_rows(q.sequence), _from("seq_rows"), ("seq_rows",)),
        # The nested form as text: millionths of the cells, weeks apart by semicolons.
        Query("sequence_matrix", "user_id X churn:i", lambda q: sequence.matrix_text(q.sequence),
              _from("seq_matrix"), ("seq_matrix",)),
        Query("stratified_split", "user_id churn:i split", lambda q: q.split, _from("split"), ("split",)),
        Query(
            "split_report", "split users:i churned:i churn_rate:d", lambda q: split.split_report(q.split),
            "SELECT coalesce(split, 'all') AS split, count(*) AS users, sum(churn) AS churned, avg(churn) AS churn_rate "
            "FROM split GROUP BY ROLLUP (split)", ("split",),
        ),
        Query("flat_train", _flat_spec(), lambda q: split.members(q.flat, q.split, "train"),
              "SELECT * FROM flat WHERE user_id IN (SELECT user_id FROM split WHERE split = 'train')", ("flat", "split")),
        Query("split_union", f"split {_flat_spec()}", lambda q: split.tagged(q.flat, q.split),
              "SELECT s.split, f.* FROM flat f JOIN split s USING (user_id)", ("flat", "split")),
    ]


# --- checks -----------------------------------------------------------------------------------

VERDICT = "check_name n_checked:i n_violations:i passed"


def _verdict(name: str, checked: str, violations: str, source: str) -> str:
    return (
        f"SELECT check_name, n_checked, n_violations, n_violations = 0 AS passed FROM (\n"
        f"SELECT '{name}' AS check_name, coalesce({checked}, 0) AS n_checked, "
        f"coalesce(CAST({violations} AS BIGINT), 0) AS n_violations {source})"
    )


def _count_where(names, condition: str) -> str:
    return " + ".join(f"count(*) FILTER ({condition.format(c=c)})" for c in names)


def _split_schema(q: Inputs):
    """The footers of both forms as they are written, one folder per split."""
    columns = []
    with sinks.Staging(q.spark, sinks.ensure_checkpoint_dir(q.spark)) as stage:
        for form, df in (("flat", q.flat), ("sequence", q.sequence)):
            path = f"{stage.path}/{form}"
            sinks.write_table(split.tagged(df, q.split), path, "split")
            columns += checks.schema_rows(q.spark, form, path)
    return checks.split_schema(q.spark.createDataFrame(columns, checks.SCHEMA_ROW))


def _checks() -> list[Query]:
    n = CFG.obs_periods
    users = lambda q: q.tables.users
    null_rows = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_nulls FROM weekly"
        for c in ("user_id", "week_num", *schema.names())
    )
    flat_null_rows = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_nulls FROM train"
        for c in ("user_id", *_flat_columns(), "churn")
    )
    ranges = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, min({c})::DOUBLE AS min_value, max({c})::DOUBLE AS max_value FROM weekly"
        for c in schema.names()
    )
    order = " UNION ALL ".join(
        _order_sql(e, "seg") for e in checks.GROUP_ORDER
    )
    decay = " UNION ALL ".join(
        [_order_sql(e, "seg") for e in checks.DECAY]
        + [
            f"SELECT 'playtime_vs_baseline: week {n} < 1' AS expectation, avg(playtime_vs_baseline) AS left_mean, "
            f"1.0::DOUBLE AS right_mean, coalesce(avg(playtime_vs_baseline) < 1, false) AS passed "
            f"FROM seg WHERE persona = 'about_to_churn' AND week_num = {n}"
        ]
    )
    quantile_rows = " UNION ALL ".join(
        f"SELECT '{c}' AS metric, {p}::DOUBLE AS p, quantile_disc({c}, {p})::DOUBLE AS value FROM weekly"
        for c in ("weekly_session_count", "avg_session_duration_min", "session_count_wow_change", "avg_latency", "avg_fps")
        for p in ("0.01", "0.5", "0.99")
    )
    flat_by_split = "(SELECT s.split, f.* FROM flat f JOIN split s USING (user_id))"
    seq_by_split = "(SELECT DISTINCT s.split, r.user_id FROM seq_rows r JOIN split s USING (user_id))"
    return [
        Query(
            "dq_row_count", VERDICT, lambda q: checks.row_count(q.weekly, users(q), CFG),
            _verdict("row_count", "(SELECT count(*) FROM weekly)", f"count(*) FILTER (coalesce(w, 0) <> coalesce(u, 0) * {n})",
                     "FROM (SELECT user_id, count(*) AS w FROM weekly GROUP BY 1) FULL JOIN "
                     "(SELECT user_id, count(*) AS u FROM users GROUP BY 1) USING (user_id)"),
            ("weekly", "users"),
        ),
        Query(
            "dq_unique_key", VERDICT, lambda q: checks.unique_key(q.weekly),
            _verdict("unique_key", "sum(c)", "count(*) FILTER (c > 1)",
                     "FROM (SELECT count(*) AS c FROM weekly GROUP BY user_id, week_num)"), ("weekly",),
        ),
        Query(
            "dq_uniform_weeks", VERDICT, lambda q: checks.uniform_weeks(q.weekly, CFG),
            _verdict("uniform_weeks", "count(*)", f"abs(count(*) - {n}) + max(c) - min(c)",
                     "FROM (SELECT count(*) AS c FROM weekly GROUP BY week_num)"), ("weekly",),
        ),
        Query("null_inventory", "column_name n_rows:i n_nulls:i", lambda q: checks.null_inventory(q.weekly),
              null_rows, ("weekly",)),
        Query(
            "dq_never_null", VERDICT, lambda q: checks.weekly_rows(q.weekly, "never_null"),
            _verdict("never_null", f"count(*) * {len(schema.NEVER_NULL)}", _count_where(schema.NEVER_NULL, "{c} IS NULL"), "FROM weekly"),
            ("weekly",),
        ),
        Query(
            "dq_wow_first_week", VERDICT, lambda q: checks.weekly_rows(q.weekly, "wow_first_week"),
            _verdict("wow_first_week", "count(*)",
                     "count(*) FILTER (session_count_wow_change IS NOT NULL OR playtime_wow_change IS NOT NULL)",
                     "FROM weekly WHERE week_num = 1"), ("weekly",),
        ),
        Query(
            "dq_nulls_match_zero_weeks", VERDICT, lambda q: checks.weekly_rows(q.weekly, "nulls_match_zero_weeks"),
            _verdict("nulls_match_zero_weeks", "count(*) FILTER (weekly_session_count = 0)",
                     _count_where(schema.NULL_IN_ZERO_WEEKS, "({c} IS NULL) <> (weekly_session_count = 0)"), "FROM weekly"),
            ("weekly",),
        ),
        Query("value_ranges", "column_name min_value:d max_value:d", lambda q: checks.value_ranges(q.weekly), ranges, ("weekly",)),
        Query(
            "dq_bounded", VERDICT, lambda q: checks.weekly_rows(q.weekly, "bounded"),
            _verdict("bounded", " + ".join(f"count({c})" for c in schema.UNIT_INTERVAL),
                     _count_where(schema.UNIT_INTERVAL, "{c} < 0 OR {c} > 1"), "FROM weekly"), ("weekly",),
        ),
        Query(
            "dq_nonnegative", VERDICT, lambda q: checks.weekly_rows(q.weekly, "non_negative"),
            _verdict("non_negative", " + ".join(f"count({c})" for c in schema.NON_NEGATIVE),
                     _count_where(schema.NON_NEGATIVE, "{c} < 0"), "FROM weekly"), ("weekly",),
        ),
        Query(
            "dq_norm_median", VERDICT, lambda q: checks.norm_median(q.weekly),
            _verdict("norm_median", "count(*)", "count(*) FILTER (m < 0.9 OR m > 1.1)",
                     "FROM (SELECT quantile_disc(weekly_session_count_norm, 0.5) AS m FROM weekly "
                     "WHERE weekly_session_count > 0 GROUP BY week_num UNION ALL "
                     "SELECT quantile_disc(total_playtime_min_norm, 0.5) FROM weekly "
                     "WHERE weekly_session_count > 0 GROUP BY week_num)"), ("weekly",),
        ),
        Query("feature_percentiles", "metric p:d value:d", lambda q: profile.feature_percentiles(q.weekly), quantile_rows, ("weekly",)),
        Query("dq_group_order", "expectation left_mean:d right_mean:d passed",
              lambda q: checks.group_order(q.weekly, users(q)), order, ("seg",)),
        Query("dq_segment_decay", "expectation left_mean:d right_mean:d passed",
              lambda q: checks.segment_decay(q.weekly, users(q), CFG), decay, ("seg",)),
        Query(
            "segment_weekly_trend", f"persona week_num {_spec(profile.TREND_COLUMNS, doubles_only=True)}",
            lambda q: profile.segment_weekly_trend(checks.with_persona(q.weekly, users(q)), "about_to_churn", "hardcore"),
            f"SELECT persona, week_num, {', '.join(f'avg({c}) AS {c}' for c in profile.TREND_COLUMNS)} "
            "FROM seg WHERE persona IN ('about_to_churn', 'hardcore') GROUP BY ALL", ("seg",),
        ),
        Query(
            "segment_stability", "persona raw_change:d norm_change:d passed",
            lambda q: checks.segment_stability(q.weekly, users(q), CFG),
            f"""SELECT 'hardcore' AS persona, abs(rl - rf) / rf AS raw_change, abs(nl - nf) / nf AS norm_change,
  coalesce(abs(nl - nf) / nf < 0.3, false) AS passed
FROM (SELECT avg(weekly_session_count) FILTER (week_num = 1) AS rf, avg(weekly_session_count) FILTER (week_num = {n}) AS rl,
  avg(weekly_session_count_norm) FILTER (week_num = 1) AS nf, avg(weekly_session_count_norm) FILTER (week_num = {n}) AS nl
  FROM seg WHERE persona = 'hardcore')""", ("seg",),
        ),
        Query(
            "dq_split_disjoint", VERDICT, lambda q: checks.split_disjoint(split.tagged(q.flat, q.split)),
            _verdict("split_disjoint", "count(*)", "count(*) FILTER (k > 1)",
                     f"FROM (SELECT count(DISTINCT split) AS k FROM {flat_by_split} GROUP BY user_id)"), ("flat", "split"),
        ),
        Query(
            "dq_split_exhaustive", VERDICT, lambda q: checks.split_exhaustive(q.split, users(q)),
            _verdict("split_exhaustive", "count(s.user_id)", "count(*) FILTER (s.user_id IS NULL OR u.user_id IS NULL)",
                     "FROM split s FULL JOIN users u ON s.user_id = u.user_id"), ("split", "users"),
        ),
        Query(
            "dq_cross_format", VERDICT,
            lambda q: checks.cross_format(split.tagged(q.flat, q.split), split.tagged(q.sequence, q.split)),
            _verdict("cross_format", "count(a.user_id)", "count(*) FILTER (a.user_id IS NULL OR b.user_id IS NULL)",
                     f"FROM {flat_by_split} a FULL JOIN {seq_by_split} b ON a.user_id = b.user_id AND a.split = b.split"),
            ("flat", "seq_rows", "split"),
        ),
        Query(
            "dq_sequence_shape", VERDICT, lambda q: checks.sequence_cells(q.sequence, CFG, "sequence_shape"),
            _verdict("sequence_shape", "count(*)", f"count(*) FILTER (weeks <> {n} OR cells <> {n * len(schema.names())})",
                     "FROM (SELECT count(DISTINCT week_num) AS weeks, count(*) AS cells FROM seq_rows GROUP BY user_id)"),
            ("seq_rows",),
        ),
        Query(
            "dq_sequence_no_null", VERDICT, lambda q: checks.sequence_cells(q.sequence, CFG, "sequence_no_null"),
            _verdict("sequence_no_null", "count(*)", "count(*) FILTER (holes > 0)",
                     "FROM (SELECT count(*) FILTER (value IS NULL OR isnan(value)) AS holes FROM seq_rows GROUP BY user_id)"),
            ("seq_rows",),
        ),
        Query(
            "dq_split_schema", VERDICT, _split_schema,
            _verdict("split_schema", f"count(DISTINCT split) * {len(_flat_columns()) + 2 + 3}", "0", "FROM split"), ("split",),
        ),
        Query(
            "dq_stratification", VERDICT, lambda q: checks.stratification(q.split),
            _verdict("stratification", "count(*)", "CASE WHEN max(r) - min(r) >= 0.005 THEN 1 ELSE 0 END",
                     "FROM (SELECT avg(churn) AS r FROM split GROUP BY split)"), ("split",),
        ),
        Query(
            "dq_label_match", VERDICT, lambda q: checks.label_match(q.flat, q.sequence),
            _verdict("label_match", "count(*)", "count(*) FILTER (a.churn IS DISTINCT FROM b.churn)",
                     "FROM flat a FULL JOIN (SELECT DISTINCT user_id, churn FROM seq_rows) b ON a.user_id = b.user_id"),
            ("flat", "seq_rows"),
        ),
        Query("dq_leakage", VERDICT, lambda q: checks.leakage(q.flat, sequence.feature_names(q.spark)),
              _verdict("leakage", "count(*)", "0", "FROM flat"), ("flat",)),
        Query(
            "dq_flat_rows", VERDICT, lambda q: checks.flat_rows(q.flat, users(q)),
            _verdict("flat_rows", "count(f.user_id)", "count(*) FILTER (f.user_id IS NULL OR u.user_id IS NULL)",
                     "FROM flat f FULL JOIN users u ON f.user_id = u.user_id"), ("flat", "users"),
        ),
        Query("dq_label_domain", VERDICT, lambda q: checks.label_domain(q.labels),
              _verdict("label_domain", "count(*)", "count(*) FILTER (churn IS NULL OR churn NOT IN (0, 1))", "FROM labels"), ("labels",)),
        Query(
            "churn_rate_by_persona", "persona churned:i users:i churn_rate:d",
            lambda q: checks.churn_rate_by_persona(q.labels, users(q)),
            "SELECT persona, sum(churn) AS churned, count(*) AS users, avg(churn) AS churn_rate "
            "FROM labels JOIN users USING (user_id) GROUP BY persona", ("labels", "users"),
        ),
        Query(
            "dq_churn_rate_limits", VERDICT, lambda q: checks.churn_rate_limits(q.labels, users(q)),
            _verdict("churn_rate_limits", "count(*)",
                     "count(*) FILTER ((persona = 'about_to_churn' AND r <= 0.5) OR (persona = 'hardcore' AND r >= 0.01) "
                     "OR (persona = 'regular' AND r >= 0.05))",
                     "FROM (SELECT persona, avg(churn) AS r FROM labels JOIN users USING (user_id) "
                     "WHERE persona <> 'casual' GROUP BY persona)"), ("labels", "users"),
        ),
        Query("flat_null_inventory", "column_name n_rows:i n_nulls:i",
              lambda q: checks.null_inventory(split.members(q.flat, q.split, "train")),
              f"WITH train AS (SELECT * FROM flat WHERE user_id IN (SELECT user_id FROM split WHERE split = 'train')) {flat_null_rows}",
              ("flat", "split")),
        Query(
            "label_signal", f"churn:i {_spec(checks.SIGNAL_COLUMNS, doubles_only=True)}",
            lambda q: checks.label_signal(split.members(q.flat, q.split, "train")),
            f"SELECT churn, {', '.join(f'avg({c}) AS {c}' for c in checks.SIGNAL_COLUMNS)} FROM flat "
            "WHERE user_id IN (SELECT user_id FROM split WHERE split = 'train') GROUP BY churn", ("flat", "split"),
        ),
        Query(
            "dq_label_signal", VERDICT, lambda q: checks.label_signal_check(split.members(q.flat, q.split, "train")),
            _verdict("label_signal", "count(*)",
                     "CASE WHEN avg(weekly_session_count_last) FILTER (churn = 1) "
                     "< avg(weekly_session_count_last) FILTER (churn = 0) * 0.5 THEN 0 ELSE 1 END",
                     "FROM flat WHERE user_id IN (SELECT user_id FROM split WHERE split = 'train')"), ("flat", "split"),
        ),
        Query(
            "persona_feature_means", f"persona {_spec(profile.SEGMENT_COLUMNS, doubles_only=True)}",
            lambda q: profile.means_by(checks.with_persona(q.weekly, users(q)), ["persona"], profile.SEGMENT_COLUMNS),
            f"SELECT persona, {', '.join(f'avg({c}) AS {c}' for c in profile.SEGMENT_COLUMNS)} FROM seg GROUP BY persona",
            ("seg",),
        ),
    ]


def _order_sql(e: checks.Expectation, source: str) -> str:
    left, right = (f"avg({side.column}) FILTER ({side.rows})" for side in (e.left, e.right))
    return (
        f"SELECT '{e.name}' AS expectation, {left} AS left_mean, {right} AS right_mean, "
        f"coalesce({left} {e.op} {right}, false) AS passed FROM {source}"
    )


# --- profiles ---------------------------------------------------------------------------------


def _counts(table: str, column: str, name: str | None = None) -> Query:
    return Query(
        f"value_counts_{name or column}", f"{column} n:i",
        lambda q: profile.value_counts(getattr(q.tables, table), column),
        f"SELECT {column}, count(*) AS n FROM {table} GROUP BY {column}", (table,),
    )


def _pivot_sql(by: str, column: str, values: list[str], source: str) -> str:
    cells = ", ".join(f"nullif(count(*) FILTER ({column} = '{v}'), 0) AS {v}" for v in values)
    return f"SELECT {by}, {cells} FROM {source} GROUP BY {by}"


def _pivot_spec(by: str, values: list[str]) -> str:
    return f"{by} " + " ".join(f"{v}:i" for v in values)


def _persona_pivot(name: str, table: str, column: str, values: list[str], id_column: str) -> Query:
    return Query(
        name, _pivot_spec("persona", values),
        lambda q: profile.pivot_by_persona(getattr(q.tables, table), q.tables.users, column, values, id_column),
        _pivot_sql("persona", column, values, f"{table} JOIN users USING (user_id)"), (table, "users"),
    )


def _share_sql(table: str, by: str, column: str) -> str:
    return (
        f"SELECT {by}, {column}, n, n::DOUBLE / sum(n) OVER (PARTITION BY {by}) AS share FROM "
        f"(SELECT {by}, {column}, count(*) AS n FROM {table} GROUP BY ALL)"
    )


def _extent_sql(table: str, time: str, *keys: str) -> str:
    counts = "".join(f", count(DISTINCT {k}) AS n_{k}" for k in keys)
    return f"SELECT min({time}) AS first_time, max({time}) AS last_time, count(*) AS n_rows{counts} FROM {table}"


# First calendar period of the late part of the data.
LATE_PERIOD = 8


# Columns of the tables, in order.
TABLE_COLUMNS = {
    "users": "user_id signup_date subscription_tier device_type region referral_source age_group gender persona",
    "sessions": "session_id user_id game_id start_time end_time avg_latency_ms avg_fps total_frame_drops "
    "disconnect_count avg_bitrate_mbps avg_jitter_ms packet_loss_rate exit_type",
    "games": "game_id game_title genre publisher popularity_tier",
    "sub_events": "event_id user_id event_date event_type",
    "payments": "payment_id user_id payment_date amount_usd payment_type status",
}


def _schema_sql() -> str:
    """Columns with the names that Spark has for their types."""
    names = {"BIGINT": "bigint", "VARCHAR": "string", "DOUBLE": "double", "DATE": "date", "TIMESTAMP": "timestamp_ntz"}
    kind = " ".join(f"WHEN '{sql}' THEN '{name}'" for sql, name in names.items())
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, {i} AS position, '{c}' AS column_name, "
        f"CASE typeof(any_value({c})) {kind} ELSE typeof(any_value({c})) END AS data_type, count({c}) AS n_values FROM {table}"
        for table, columns in TABLE_COLUMNS.items()
        for i, c in enumerate(columns.split(), 1)
    )


def _median_sketches(q: Inputs):
    """Weekly medians from summaries of four parts of the users."""
    totals, by, columns = session_ops.weekly_totals(q.obs), ["week_num"], list(norm.MEDIANS.values())
    parts = totals.withColumn("part", F.pmod(F.xxhash64("user_id"), F.lit(4)))
    merged = sketches.merged_values(sketches.value_summaries(parts, [*by, "part"], columns), by, columns)
    return sketches.rank_errors(totals, sketches.summarised_quantiles(merged, by, columns, [0.5]), by, columns)


DURATION_PROBS = [0.01, 0.5, 0.95, 0.99]


def _duration_sketches(q: Inputs):
    """Percentiles of the session length of each week from summaries of its days."""
    by, columns = ["week_num"], ["duration_min"]
    days = sketches.value_summaries(q.obs, [*by, "date"], columns)
    found = sketches.summarised_quantiles(sketches.merged_values(days, by, columns), by, columns, DURATION_PROBS)
    return sketches.rank_errors(q.obs, found, by, columns)


def _distinct_sketches(q: Inputs):
    """Users and games of each week from summaries of its days."""
    by, keys = ["week_num"], ["user_id", "game_id"]
    found = sketches.distinct_counts(sketches.key_summaries(q.obs, [*by, "date"], keys), by, keys)
    return sketches.count_errors(q.obs, found, by, keys)


def _sketches() -> list[Query]:
    medians = " UNION ALL ".join(
        f"SELECT week_num, '{c}' AS metric, 0.5::DOUBLE AS p, count({c}) AS n, true AS within FROM patterns GROUP BY week_num"
        for c in norm.MEDIANS.values()
    )
    durations = " UNION ALL ".join(
        f"SELECT week_num, 'duration_min' AS metric, {p}::DOUBLE AS p, count(duration_min) AS n, true AS within FROM obs GROUP BY week_num"
        for p in DURATION_PROBS
    )
    distinct = " UNION ALL ".join(
        f"SELECT week_num, '{c}' AS key, count(DISTINCT {c}) AS n_distinct, true AS within FROM obs GROUP BY week_num"
        for c in ("user_id", "game_id")
    )
    return [
        Query("median_sketch_error", "week_num metric p:d n:i within", _median_sketches, medians, ("patterns",)),
        Query("duration_sketch_error", "week_num metric p:d n:i within", _duration_sketches, durations, ("obs",)),
        Query("distinct_sketch_error", "week_num key n_distinct:i within", _distinct_sketches, distinct, ("obs",)),
    ]


def _profiles() -> list[Query]:
    late = f"(SELECT *, {oracle._week(CFG.data_start, 'CAST(start_time AS DATE)')} AS w FROM sessions)"
    return [
        Query(
            "profile_tables", "table_name n_rows:i n_columns:i", lambda q: profile.table_sizes(q.tables),
            " UNION ALL ".join(
                f"SELECT '{t}' AS table_name, (SELECT count(*) FROM {t}) AS n_rows, {width} AS n_columns"
                for t, width in (("users", 9), ("sessions", 13), ("games", 5), ("sub_events", 4), ("payments", 6))
            ),
            ("users", "sessions", "games", "sub_events", "payments"),
        ),
        Query("profile_schemas", "table_name position:i column_name data_type n_values:i",
              lambda q: profile.table_schemas(q.tables), _schema_sql(), tuple(TABLE_COLUMNS)),
        _counts("users", "persona"),
        _counts("users", "subscription_tier", "tier"),
        _counts("users", "region"),
        _counts("sessions", "exit_type"),
        _counts("games", "genre"),
        _counts("games", "popularity_tier"),
        _counts("sub_events", "event_type"),
        _counts("payments", "status"),
        Query(
            "value_counts_demographics", "column_name value n:i",
            lambda q: profile.value_counts_many(q.tables.users, profile.DEMOGRAPHICS),
            " UNION ALL ".join(
                f"SELECT '{c}' AS column_name, {c} AS value, count(*) AS n FROM users GROUP BY {c}"
                for c in profile.DEMOGRAPHICS
            ),
            ("users",),
        ),
        Query("top_regions", "region n:i", lambda q: profile.top_values(q.tables.users, "region", 3),
              "SELECT region, count(*) AS n FROM users GROUP BY region ORDER BY n DESC, region LIMIT 3", ("users",)),
        Query("top_games", "game_id n:i", lambda q: profile.top_values(q.tables.sessions, "game_id", 10),
              "SELECT game_id, count(*) AS n FROM sessions GROUP BY game_id ORDER BY n DESC, game_id LIMIT 10", ("sessions",)),
        Query("pivot_tier_by_persona", _pivot_spec("persona", profile.TIERS),
              lambda q: profile.pivot_counts(q.tables.users, "persona", "subscription_tier", profile.TIERS),
              _pivot_sql("persona", "subscription_tier", profile.TIERS, "users"), ("users",)),
        _persona_pivot("pivot_exit_by_persona", "sessions", "exit_type", profile.EXITS, "session_id"),
        Query(
            "pivot_late_exit_by_persona", _pivot_spec("persona", profile.EXITS),
            lambda q: profile.pivot_by_persona(
                profile.from_period(q.tables.sessions, CFG, LATE_PERIOD), q.tables.users, "exit_type", profile.EXITS, "session_id"
            ),
            _pivot_sql("persona", "exit_type", profile.EXITS,
                       f"(SELECT * FROM {late} WHERE w >= {LATE_PERIOD}) JOIN users USING (user_id)"), ("sessions", "users"),
        ),
        _persona_pivot("pivot_event_by_persona", "sub_events", "event_type", profile.EVENTS, "event_id"),
        _persona_pivot("pivot_status_by_persona", "payments", "status", profile.STATUSES, "payment_id"),
        Query("crosstab_normalized", "persona subscription_tier n:i share:d",
              lambda q: profile.shares_within(q.tables.users, "persona", "subscription_tier"),
              _share_sql("users", "persona", "subscription_tier"), ("users",)),
        Query("payment_status_share", "payment_type status n:i share:d",
              lambda q: profile.shares_within(q.tables.payments, "payment_type", "status"),
              _share_sql("payments", "payment_type", "status"), ("payments",)),
        Query(
            "status_share_by_persona", "persona status n:i share:d",
            lambda q: profile.persona_shares(q.tables.payments, q.tables.users, "status"),
            _share_sql("(SELECT persona, status FROM payments JOIN users USING (user_id))", "persona", "status"),
            ("payments", "users"),
        ),
        Query("exit_type_share", "exit_type n:i share:d", lambda q: profile.shares(q.tables.sessions, "exit_type"),
              "SELECT exit_type, n, n::DOUBLE / sum(n) OVER () AS share FROM "
              "(SELECT exit_type, count(*) AS n FROM sessions GROUP BY 1)", ("sessions",)),
        Query("signups_by_month", "signup_month:i n:i", lambda q: profile.signups_by_month(q.tables.users),
              "SELECT month(signup_date) AS signup_month, count(*) AS n FROM users GROUP BY 1", ("users",)),
        Query(
            "session_totals", "first_time:s last_time:s n_rows:i n_user_id:i n_game_id:i",
            lambda q: profile.extent(q.tables.sessions, "start_time", "user_id", "game_id"),
            _extent_sql("sessions", "start_time", "user_id", "game_id"), ("sessions",),
        ),
        Query(
            "payment_totals", "first_time:s last_time:s n_rows:i n_user_id:i n_payment_type:i",
            lambda q: profile.extent(q.tables.payments, "payment_date", "user_id", "payment_type"),
            _extent_sql("payments", "payment_date", "user_id", "payment_type"), ("payments",),
        ),
        Query(
            "sub_event_totals", "first_time:s last_time:s n_rows:i n_user_id:i n_event_type:i",
            lambda q: profile.extent(q.tables.sub_events, "event_date", "user_id", "event_type"),
            _extent_sql("sub_events", "event_date", "user_id", "event_type"), ("sub_events",),
        ),
        Query(
            "duration_percentiles", "mean:d std:d p50:d p95:d p99:d max:d",
            lambda q: profile.duration_percentiles(q.tables.sessions),
            "SELECT avg(duration_min) AS mean, stddev_samp(duration_min) AS std, quantile_disc(duration_min, 0.5) AS p50, "
            "quantile_disc(duration_min, 0.95) AS p95, quantile_disc(duration_min, 0.99) AS p99, max(duration_min) AS max FROM timed",
            ("timed",),
        ),
        Query(
            "persona_session_stats", "persona total_sessions:i avg_duration:d avg_latency:d avg_fps:d avg_disconnects:d",
            lambda q: profile.persona_session_stats(q.tables.sessions, q.tables.users),
            "SELECT persona, count(session_id) AS total_sessions, avg(duration_min) AS avg_duration, "
            "avg(avg_latency_ms) AS avg_latency, avg(avg_fps) AS avg_fps, avg(disconnect_count) AS avg_disconnects "
            "FROM timed JOIN users USING (user_id) GROUP BY persona", ("timed", "users"),
        ),
        Query(
            "persona_weekly_activity", "persona week_num:i active_users:i sessions:i sessions_per_user:d",
            lambda q: profile.persona_weekly_activity(q.tables.sessions, q.tables.users, CFG),
            f"SELECT persona, w AS week_num, count(DISTINCT user_id) AS active_users, count(session_id) AS sessions, "
            f"count(session_id)::DOUBLE / count(DISTINCT user_id) AS sessions_per_user FROM {late} "
            "JOIN users USING (user_id) GROUP BY persona, w", ("sessions", "users"),
        ),
        Query("sessions_per_persona", "persona sessions:i",
              lambda q: profile.sessions_per_persona(q.tables.sessions, q.tables.users),
              "SELECT persona, count(*) AS sessions FROM sessions JOIN users USING (user_id) GROUP BY persona",
              ("sessions", "users")),
        Query("free_tier_max_duration", "max_duration_min:d",
              lambda q: profile.tier_max_duration(q.tables.sessions, q.tables.users, "free"),
              "SELECT max(duration_min) AS max_duration_min FROM timed JOIN users USING (user_id) "
              "WHERE subscription_tier = 'free'", ("timed", "users")),
        Query("sessions_by_popularity", "popularity_tier n:i",
              lambda q: profile.sessions_by_popularity(q.tables.sessions, q.tables.games),
              "SELECT popularity_tier, count(*) AS n FROM sessions JOIN games USING (game_id) GROUP BY 1", ("sessions", "games")),
        Query("event_day_stats", "event_type avg_day:d min_day:i max_day:i",
              lambda q: profile.numeric_summary(
                  q.tables.sub_events, "event_type", "event_id", X.days_from(CFG.data_start, "event_date"), "day"),
              f"SELECT event_type, avg(d) AS avg_day, min(d) AS min_day, max(d) AS max_day FROM "
              f"(SELECT event_type, date_diff('day', DATE '{CFG.data_start}', event_date) AS d FROM sub_events) GROUP BY 1",
              ("sub_events",)),
        Query("payment_type_stats", "payment_type n:i avg_amount:d total_amount:m",
              lambda q: profile.numeric_summary(q.tables.payments, "payment_type", "payment_id", F.col("amount_usd"), "amount"),
              "SELECT payment_type, count(payment_id) AS n, avg(amount_usd) AS avg_amount, sum(amount_usd) AS total_amount "
              "FROM payments GROUP BY 1", ("payments",)),
        Query(
            "spend_per_user_by_persona", "persona users:i total_spend:m spend_per_user:d",
            lambda q: profile.spend_per_user_by_persona(q.tables.payments, q.tables.users),
            "SELECT persona, u AS users, coalesce(s, 0) AS total_spend, coalesce(s, 0) / u AS spend_per_user FROM "
            "(SELECT persona, count(*) AS u FROM users GROUP BY 1) LEFT JOIN "
            "(SELECT persona, sum(amount_usd) AS s FROM payments JOIN users USING (user_id) WHERE status = 'success' GROUP BY 1) "
            "USING (persona)", ("payments", "users"),
        ),
    ]


QUERIES: dict[str, Query] = {
    q.name: q for q in (*_raw(), *_features(), *_datasets(), *_checks(), *_profiles(), *_sketches())
}
