"""Column-level rules shared by every job. All of them stay inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from perptide import schemas as S


def decimal_text(value: Column, kind: str) -> Column:
    """Parse a venue's own digits. NULL or blank is unknown; other text is an error."""
    return F.nullif(F.trim(value), F.lit("")).cast(kind)


def required(value: Column, field: str) -> Column:
    return F.when(value.isNotNull(), value).otherwise(
        F.raise_error(F.lit(f"the payload gives no {field}"))
    )


def epoch_ms(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def to_ms(ts: Column) -> Column:
    return F.unix_millis(ts)


def minute(ts: Column) -> Column:
    return F.date_trunc("minute", ts)


def floor_ms(ms: Column, step_ms: int) -> Column:
    """Largest multiple of ``step_ms`` not above ``ms`` (exact for any sign)."""
    return ms - F.pmod(ms, F.lit(step_ms))


def month_of(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMM")


def binance_symbol(base: Column) -> Column:
    """Unified coin name of a base asset: a documented 1000-family prefix is dropped."""
    return F.when(
        base.rlike(r"^10{2,}(?=[A-Z])"), F.regexp_replace(base, r"^10{2,}(?=[A-Z])", "")
    ).otherwise(base)


def binance_mult(base: Column) -> Column:
    """Base units per contract unit; a visible but undocumented prefix is unknown."""
    prefix = F.regexp_extract(base, r"^(10{2,})(?=[A-Z])", 1)
    return (
        F.when(prefix != "", F.nullif(prefix, F.lit("")).cast(S.MULT))
        .when(base.rlike(r"^[0-9]+[KM](?=[A-Z])"), F.lit(None).cast(S.MULT))
        .otherwise(F.lit(1).cast(S.MULT))
    )


def hyperliquid_symbol(coin: Column) -> Column:
    return F.regexp_replace(coin, r"^k(?=[A-Z0-9])", "")


def hyperliquid_mult(coin: Column) -> Column:
    return (
        F.when(coin.rlike(r"^k(?=[A-Z0-9])"), F.lit(1000).cast(S.MULT))
        .when(coin.rlike(r"^[a-z](?=[A-Z0-9])"), F.lit(None).cast(S.MULT))
        .otherwise(F.lit(1).cast(S.MULT))
    )


def to_base_units(quantity: Column, mult: Column) -> Column:
    return (quantity * mult).cast(S.QTY)


def taker_share(buy: Column, sell: Column) -> Column:
    """Buy volume over both sides; unknown when a side is unknown or nothing traded."""
    total = buy + sell
    return (
        F.when(buy.isNull() | sell.isNull() | (total <= 0), F.lit(None).cast(S.SHARE))
        .when((buy < 0) | (sell < 0), F.raise_error(F.lit("a traded volume cannot be negative")))
        .otherwise((buy / total).cast(S.SHARE))
    )


# How the venue's contract states map onto the three stored ones.
STATUS_MAP = {
    "TRADING": "trading",
    "PENDING_TRADING": "suspended",
    "SETTLING": "suspended",
    "PRE_SETTLE": "suspended",
    "DELIVERING": "suspended",
    "PRE_DELIVERING": "suspended",
    "CLOSE": "delisted",
}


def contract_status(raw: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in STATUS_MAP.items() for x in pair])
    return F.try_element_at(table, raw)


def price_tick(filters: Column) -> Column:
    """Tick size of the first PRICE_FILTER entry, NULL when there is none."""
    hit = F.filter(filters, lambda f: f["filterType"] == "PRICE_FILTER")
    return decimal_text(F.get(hit, F.lit(0))["tickSize"], S.PX)


def funding_8h(rate: Column, interval_h: Column) -> Column:
    return (rate * F.lit(8).cast("decimal(2,0)") / interval_h.cast("decimal(4,0)")).cast(
        "decimal(28,16)"
    )


def oi_usd(oi_base: Column, mark: Column, mult: Column) -> Column:
    """USD open interest. ``oi_base`` already carries the multiplier, so divide by it."""
    return (oi_base * mark / mult).cast(S.USD)


def excluded_from_availability_a(cause: Column) -> Column:
    return cause.isin(*S.AVAILABILITY_A_EXCLUDED)


def limit_body_class(body: Column) -> Column:
    """Which limiter answered: a JSON null is the weight limiter, HTML the connection one."""
    text = F.regexp_replace(body, r"^\s+|\s+$", "")
    return (
        F.when(F.lower(text) == "null", F.lit("weight"))
        .when(text.startswith("<"), F.lit("connection"))
        .otherwise(F.lit("unrecognized"))
    )


def retry_after_seconds(header: Column) -> Column:
    """Numeric seconds only; an HTTP date is not a number of seconds."""
    return F.when(
        F.trim(header).rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"),
        F.trim(header).cast("double"),
    )


def scope(venue: Column, symbol: Column) -> Column:
    """Two-part scope text; a NULL symbol stands for the whole venue."""
    return F.concat_ws(":", venue, F.coalesce(symbol, F.lit("*")))


def scope_is_valid(text: Column) -> Column:
    return text.rlike(S.SCOPE_PATTERN)


def scope_venue(text: Column) -> Column:
    return F.split_part(text, F.lit(":"), F.lit(1))


def scope_symbol(text: Column) -> Column:
    part = F.split_part(text, F.lit(":"), F.lit(2))
    return F.when(part != "*", part)


# Evidence strength and verdict severity orders.
TAG_STRENGTH = {"unverified": 1, "measured": 2, "official": 3}
SEVERITY = {"green": 0, "yellow": 1, "unknown": 2, "red": 3}


def _rank(value: Column, order: dict[str, int]) -> Column:
    table = F.create_map(*[F.lit(x) for pair in order.items() for x in pair])
    return F.try_element_at(table, value)


def _name(rank: Column, order: dict[str, int]) -> Column:
    table = F.create_map(*[F.lit(x) for name, r in order.items() for x in (r, name)])
    return F.try_element_at(table, rank)


def tag_strength(tag: Column) -> Column:
    return _rank(tag, TAG_STRENGTH)


def tag_of_strength(strength: Column) -> Column:
    return _name(strength, TAG_STRENGTH)


def severity(status: Column) -> Column:
    return _rank(status, SEVERITY)


def status_of_severity(rank: Column) -> Column:
    return _name(rank, SEVERITY)


def worst_status(status: Column) -> Column:
    """Aggregate: the worst verdict of a group; an empty group is unknown."""
    return F.coalesce(status_of_severity(F.max(severity(status))), F.lit("unknown"))
