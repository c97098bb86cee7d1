"""Closed schemas of the raw, staged and stored relations.

Nothing here is inferred. Unknown is NULL in every nullable column; no column
has a default of zero.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PX = "decimal(20,10)"
QTY = "decimal(24,10)"
RATE = "decimal(20,12)"
MULT = "decimal(12,0)"
SHARE = "decimal(20,12)"
USD = "decimal(38,13)"

RAW_PAYLOAD = (
    "venue string, endpoint string, request_symbol string, interval string, "
    "observed_ms bigint, ingest_ms bigint, payload string"
)

FAST_PAYLOAD = {
    "mark": PX,
    "index_px": PX,
    "premium": RATE,
    "funding_rate": RATE,
    "funding_interval_h": "int",
    "next_funding_ts_ms": "bigint",
}
SLOW_PAYLOAD = {"oi_base": QTY, "vol24h_usd": QTY, "chg24h_pct": RATE}

STAGE = {
    "venue": "string",
    "symbol": "string",
    "ts_ms": "bigint",
    "ingest_ts_ms": "bigint",
    "source": "string",
    "semantic": "string",
    **FAST_PAYLOAD,
    "oi_base": QTY,
    "oi_usd": USD,
    "vol24h_usd": QTY,
    "chg24h_pct": RATE,
    "obs_ts_fast_ms": "bigint",
    "obs_ts_slow_ms": "bigint",
    "grid_s": "int",
    "backfilled": "boolean",
}

MARKET_1M = {
    "venue": "string",
    "symbol": "string",
    "ts": "timestamp",
    "obs_ts_fast": "timestamp",
    "obs_ts_slow": "timestamp",
    "next_funding_ts": "timestamp",
    "ingest_ts": "timestamp",
    "funding_interval_h": "int",
    "grid_s": "int",
    "backfilled": "boolean",
    "semantic": "string",
    "source": "string",
    "mark": PX,
    "index_px": PX,
    "premium": RATE,
    "funding_rate": RATE,
    "oi_base": QTY,
    "oi_usd": USD,
    "vol24h_usd": QTY,
    "chg24h_pct": RATE,
}

INSTRUMENT = {
    "venue": "string",
    "symbol": "string",
    "ts_ms": "bigint",
    "ingest_ts_ms": "bigint",
    "source": "string",
    "venue_symbol": "string",
    "mult": MULT,
    "funding_interval_h": "int",
    "tick": PX,
    "status": "string",
}

LS_RATIO = {
    "venue": "string",
    "symbol": "string",
    "kind": "string",
    "ts_ms": "bigint",
    "ingest_ts_ms": "bigint",
    "source": "string",
    "period": "int",
    "long_share": SHARE,
}

LIQUIDATION = {
    "venue": "string",
    "symbol": "string",
    "ts_ms": "bigint",
    "event_id": "string",
    "ingest_ts_ms": "bigint",
    "side": "string",
    "price": PX,
    "size": QTY,
    "notional_usd": USD,
    "throttled_source": "boolean",
    "completeness": "string",
    "ingest_path": "string",
    "source": "string",
}


def ddl(columns: dict[str, str]) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in columns.items())


def conform(df: DataFrame, columns: dict[str, str], **values: Column) -> DataFrame:
    """Project ``df`` onto a closed schema.

    ``values`` overrides or supplies columns; a column that neither ``df`` nor
    ``values`` has becomes a typed NULL.
    """
    present = set(df.columns)

    def pick(name: str, kind: str) -> Column:
        if name in values:
            source = values[name]
        elif name in present:
            source = F.col(name)
        else:
            source = F.lit(None)
        return source.cast(kind).alias(name)

    return df.select(*[pick(name, kind) for name, kind in columns.items()])


# Venue names, status names, closed vocabularies and patterns.
VENUES = ("binance", "hyperliquid")
SEMANTICS = ("mark_price", "candle_close")
STATUSES = ("trading", "suspended", "delisted")
LS_KINDS = ("global_long_short_account", "top_long_short_position", "taker_long_short")
COMPLETENESS = ("lower_bound", "partial_history")
INGEST_PATHS = ("binance_ws", "hl_wallet_derived")
GAP_CAUSES = (
    "venue_error",
    "rate_limit",
    "ip_ban",
    "backpressure",
    "ws_reconnect",
    "power_loss",
    "host_restart",
    "egress_down",
    "egress_change",
    "unknown",
)
AVAILABILITY_A_EXCLUDED = ("power_loss", "host_restart", "egress_down", "egress_change")
SYMBOL_PATTERN = r"^[A-Z0-9]{1,15}$"
TAG_PATTERN = r"^[a-z0-9][a-z0-9_.:-]{0,63}$"
SCOPE_PATTERN = r"^(binance|hyperliquid|x):([A-Z0-9]{1,15}|\*)$"
VENUE_SYMBOL_PATTERN = r"^\S{1,40}$"
