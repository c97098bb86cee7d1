"""Record contracts and table rules as named column predicates.

A rule holds when its predicate is not false: an unknown value never violates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perptide import schemas as S

FAST_PAYLOAD = list(S.FAST_PAYLOAD)
SLOW_PAYLOAD = ["oi_base", "oi_usd", "vol24h_usd", "chg24h_pct"]


def _any_set(names: list[str]) -> Column:
    found = F.lit(False)
    for name in names:
        found = found | F.col(name).isNotNull()
    return found


def _venue() -> Column:
    return F.col("venue").isin(*S.VENUES)


def _tag(name: str) -> Column:
    return F.col(name).rlike(S.TAG_PATTERN)


def _symbol() -> Column:
    return F.col("symbol").rlike(S.SYMBOL_PATTERN)


def _not_negative(name: str) -> Column:
    return F.col(name) >= 0


def _fraction(name: str) -> Column:
    return F.col(name).between(0, 1)


def _interval(start: str, end: str) -> Column:
    return F.col(end) > F.col(start)


def _minute(name: str = "ts") -> Column:
    return F.col(name) == F.date_trunc("minute", F.col(name))


def _hours() -> Column:
    return (F.col("funding_interval_h") > 0) & (F.col("funding_interval_h") <= 168)


# The names of the rules in ``market_record_rules`` and ``table_rules``.
def market_record_rules() -> dict[str, Column]:
    """What a normalized market record must satisfy before it is staged."""
    return {
        "fast_payload_needs_obs_ts_fast": ~_any_set(FAST_PAYLOAD)
        | F.col("obs_ts_fast_ms").isNotNull(),
        "slow_payload_needs_obs_ts_slow": ~_any_set(SLOW_PAYLOAD)
        | F.col("obs_ts_slow_ms").isNotNull(),
        "at_least_one_lane": F.col("obs_ts_fast_ms").isNotNull()
        | F.col("obs_ts_slow_ms").isNotNull(),
        "single_venue": _venue(),
        "symbol_is_unified": _symbol(),
        "source_is_a_tag": _tag("source"),
        "semantic_is_closed": F.col("semantic").isin(*S.SEMANTICS),
        "mark_is_not_negative": _not_negative("mark"),
        "oi_base_is_not_negative": _not_negative("oi_base"),
        "oi_usd_is_not_negative": _not_negative("oi_usd"),
        "vol24h_is_not_negative": _not_negative("vol24h_usd"),
        "funding_interval_is_positive": _hours(),
        "grid_is_positive": F.col("grid_s") > 0,
        "mandatory_attributes": F.col("venue").isNotNull()
        & F.col("symbol").isNotNull()
        & F.col("ts_ms").isNotNull()
        & F.col("ingest_ts_ms").isNotNull()
        & F.col("source").isNotNull()
        & F.col("semantic").isNotNull(),
    }


def table_rules() -> dict[str, dict[str, Column]]:
    """Row rules of the stored tables, by table."""
    return {
        "instruments": {
            "venue_is_an_exchange": _venue(),
            "symbol_is_unified": _symbol(),
            "source_is_a_tag": _tag("source"),
            "status_is_closed": F.col("status").isin(*S.STATUSES),
            "mult_is_positive": F.col("mult") > 0,
            "funding_interval_is_positive": _hours(),
            "tick_is_not_negative": _not_negative("tick"),
            "version_is_an_interval": _interval("valid_from", "valid_to"),
        },
        "coin_universe": {
            "symbol_is_unified": _symbol(),
            "source_is_a_tag": _tag("source"),
            "reason_is_a_tag": _tag("reason"),
            "segment_is_an_interval": _interval("in_from", "in_to"),
        },
        "market_1m": {
            "ts_is_a_minute_bucket": _minute(),
            "venue_is_an_exchange": _venue(),
            "symbol_is_unified": _symbol(),
            "source_is_a_tag": _tag("source"),
            "semantic_is_closed": F.col("semantic").isin(*S.SEMANTICS),
            "premium_is_hyperliquid_only": F.col("premium").isNull()
            | (F.col("venue") == "hyperliquid"),
            "mark_is_not_negative": _not_negative("mark"),
            "oi_base_is_not_negative": _not_negative("oi_base"),
            "oi_usd_is_not_negative": _not_negative("oi_usd"),
            "vol24h_is_not_negative": _not_negative("vol24h_usd"),
            "funding_interval_is_positive": _hours(),
            "grid_is_positive": F.col("grid_s") > 0,
        },
        "ls_ratio": {
            "venue_is_an_exchange": _venue(),
            "symbol_is_unified": _symbol(),
            "source_is_a_tag": _tag("source"),
            "kind_is_closed": F.col("kind").isin(*S.LS_KINDS),
            "long_share_is_a_fraction": _fraction("long_share"),
            "period_is_positive": F.col("period") > 0,
        },
        "liquidations": {
            "venue_is_an_exchange": _venue(),
            "symbol_is_unified": _symbol(),
            "source_is_a_tag": _tag("source"),
            "event_id_is_not_empty": F.col("event_id") != "",
            "side_is_closed": F.col("side").isin("long", "short"),
            "completeness_is_a_lower_bound": F.col("completeness").isin(*S.COMPLETENESS),
            "ingest_path_is_closed": F.col("ingest_path").isin(*S.INGEST_PATHS),
            "price_is_not_negative": _not_negative("price"),
            "size_is_not_negative": _not_negative("size"),
            "notional_is_not_negative": _not_negative("notional_usd"),
        },
        "divergence_1m": {
            "ts_is_a_minute_bucket": _minute(),
            "symbol_is_unified": _symbol(),
            "source_is_a_tag": _tag("source"),
            "n_venues_is_plausible": F.col("n_venues").between(0, 2),
            "oi_share_is_a_fraction": _fraction("oi_share_bn"),
            "vol_share_is_a_fraction": _fraction("vol_share_bn"),
        },
        "metric_pctl": {
            "scope_is_two_segment": F.col("scope").rlike(S.SCOPE_PATTERN),
            "metric_is_a_tag": _tag("metric"),
            "source_is_a_tag": _tag("source"),
            "pctl_is_a_fraction": _fraction("pctl"),
            "n_is_not_negative": _not_negative("n"),
            "grid_is_positive": F.col("grid_s") > 0,
            "window_is_an_interval": _interval("window_from", "window_to"),
            "percentile_needs_thirty_observations": F.col("pctl").isNull()
            | F.coalesce(F.col("n") >= 30, F.lit(False)),
        },
        "metric_coverage": {
            "scope_is_two_segment": F.col("scope").rlike(S.SCOPE_PATTERN),
            "metric_is_a_tag": _tag("metric"),
            "source_is_a_tag": _tag("source"),
            "days_is_not_negative": _not_negative("days_available"),
            "grid_is_positive": F.col("grid_s_min") > 0,
        },
        "source_health": {
            "venue_is_an_exchange": _venue(),
            "capability_is_a_tag": _tag("capability"),
            "transport_is_closed": F.col("transport").isin("rest", "ws"),
            "source_is_a_tag": _tag("source"),
            "latency_is_not_negative": _not_negative("latency_ms"),
            "consecutive_fail_is_not_negative": _not_negative("consecutive_fail"),
        },
        "ingest_gap": {
            "venue_is_an_exchange": _venue(),
            "metric_is_a_tag": _tag("metric"),
            "source_is_a_tag": _tag("source"),
            "cause_is_closed": F.col("cause").isin(*S.GAP_CAUSES),
            "gap_is_an_interval": _interval("from_ts", "to_ts"),
            "minutes_is_not_negative": _not_negative("minutes"),
            "expected_is_not_negative": _not_negative("symbols_expected"),
            "present_is_within_expected": _not_negative("symbols_present")
            & (
                F.col("symbols_expected").isNull()
                | (F.col("symbols_present") <= F.col("symbols_expected"))
            ),
        },
        "collector_run": {
            "lane_is_a_tag": _tag("lane"),
            "source_is_a_tag": _tag("source"),
            "status_is_closed": F.col("status").isin("running", "ok", "failed"),
            "rows_are_not_negative": _not_negative("rows_written"),
            "errors_are_not_negative": _not_negative("errors"),
            "duration_is_not_negative": _not_negative("duration_ms"),
        },
        "backfill_cursor": {
            "job_is_a_tag": _tag("job"),
            "venue_is_an_exchange": _venue(),
            "symbol_is_unified": _symbol(),
            "metric_is_a_tag": _tag("metric"),
            "source_is_a_tag": _tag("source"),
        },
        "notify_log": {
            "kind_is_a_tag": _tag("kind"),
            "dedupe_key_is_not_empty": F.col("dedupe_key") != "",
            "target_is_a_tag": _tag("target"),
            "source_is_a_tag": _tag("source"),
            "resolved_rows_have_a_time": F.col("ok").isNull() == F.col("sent_at").isNull(),
        },
        "ops_event": {
            "kind_is_a_tag": _tag("kind"),
            "source_is_a_tag": _tag("source"),
            "detail_is_an_object": F.col("detail").isNull()
            | F.ltrim(F.col("detail")).startswith("{"),
        },
    }


TABLE_KEYS = {
    "instruments": ["venue", "venue_symbol", "valid_from"],
    "coin_universe": ["symbol", "in_from"],
    "market_1m": ["venue", "symbol", "ts"],
    "ls_ratio": ["venue", "symbol", "kind", "ts"],
    "liquidations": ["venue", "symbol", "ts", "event_id"],
    "divergence_1m": ["symbol", "ts"],
    "metric_pctl": ["scope", "metric"],
    "metric_coverage": ["scope", "metric"],
    "source_health": ["venue", "capability", "transport"],
    "ingest_gap": ["venue", "metric", "from_ts"],
    "collector_run": ["lane", "started_at"],
    "backfill_cursor": ["job", "venue", "symbol", "metric"],
    "notify_log": ["kind", "dedupe_key"],
    "ops_event": ["kind", "ts"],
}


def violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Add ``violations``: the names of the rules a row breaks, in rule order."""
    broken = F.array(
        *[F.when(~F.coalesce(rule, F.lit(True)), F.lit(name)) for name, rule in rules.items()]
    )
    return df.withColumn("violations", F.array_compact(broken))


def split_valid(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(rows that hold every rule, rows that do not with their reasons)."""
    checked = violations(df, rules)
    return (
        checked.filter(F.size("violations") == 0).drop("violations"),
        checked.filter(F.size("violations") > 0),
    )


def violation_counts(df: DataFrame, table: str) -> DataFrame:
    """Broken rows per rule of one table, over the whole table in one scan."""
    return (
        violations(df, table_rules()[table])
        .select(F.explode("violations").alias("rule"))
        .groupBy("rule")
        .agg(F.count("*").alias("rows"))
        .select(F.lit(table).alias("table_name"), "rule", "rows")
    )


def duplicate_keys(df: DataFrame, table: str) -> DataFrame:
    key = TABLE_KEYS[table]
    return df.groupBy(*key).agg(F.count("*").alias("rows")).filter(F.col("rows") > 1)


def open_version_conflicts(instruments: DataFrame) -> DataFrame:
    """Contracts with more than one open version."""
    return (
        instruments.filter(F.col("valid_to").isNull())
        .groupBy("venue", "venue_symbol")
        .agg(F.count("*").alias("rows"))
        .filter(F.col("rows") > 1)
    )


def open_spell_conflicts(universe: DataFrame) -> DataFrame:
    return (
        universe.filter(F.col("in_to").isNull())
        .groupBy("symbol")
        .agg(F.count("*").alias("rows"))
        .filter(F.col("rows") > 1)
    )
