"""Scalar expressions.  Each takes and returns a ``Column``; nothing leaves the JVM.

Denominators are always guarded with ``nullif``: ANSI mode raises on a zero
denominator, and a missing ratio is the wanted answer.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def _col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_divide(numerator: ColumnLike, denominator: ColumnLike) -> Column:
    """``numerator / denominator``, null where the denominator is zero."""
    return _col(numerator) / F.nullif(_col(denominator), F.lit(0))


def metric_name(*parts: ColumnLike) -> Column:
    """Joins name parts with ``_`` and skips missing ones."""
    return F.concat_ws("_", *[_col(p) for p in parts])


def normalised_key(c: ColumnLike) -> Column:
    return F.upper(_col(c))


def horizon_label(pred_col: ColumnLike) -> Column:
    """The last three characters, e.g. ``12m``."""
    return F.right(_col(pred_col), F.lit(3))


def horizon_months(pred_col: ColumnLike) -> Column:
    """The number in front of an ``m``; null when there is none."""
    return F.nullif(F.regexp_extract(_col(pred_col), r"(\d+)m", 1), F.lit("")).cast("bigint")


def forecast_date(trained: ColumnLike, months: ColumnLike) -> Column:
    """Horizon end, counting a month as thirty days."""
    return F.date_add(_col(trained), (_col(months) * 30).cast("int"))


def release_date(fiscal: ColumnLike, days: int = 45) -> Column:
    """First day on which a statement is surely public."""
    return F.date_add(_col(fiscal), days)


def quote_link(key: ColumnLike, prefix: str = "https://finance.yahoo.com/quote/") -> Column:
    return F.concat(F.lit(prefix), _col(key).cast("string"))


def excess_return(stock: ColumnLike, index: ColumnLike) -> Column:
    """Log of the stock's return over the index's, when both are positive."""
    stock, index = _col(stock), _col(index)
    return F.when((index > 0) & (stock > 0), F.ln(F.nullif(stock / index, F.lit(0))))


def back_transform(log_value: ColumnLike) -> Column:
    """From log return to return; null stays null."""
    return F.exp(_col(log_value))


def predicted_std(
    log_mean: ColumnLike, variance: ColumnLike, formula: str = "delta",
) -> Column:
    """Standard deviation on the return scale.

    ``delta`` is the delta method, ``sqrt(exp(2m) * var)``; ``stored`` is the
    variant kept in the predictions table, ``sqrt(exp(m) * 2 * var)``.
    """
    log_mean, variance = _col(log_mean), _col(variance)
    if formula == "delta":
        return F.sqrt(F.exp(2 * log_mean) * variance)
    if formula == "stored":
        return F.sqrt(F.exp(log_mean) * 2 * variance)
    raise ValueError(f"unknown std formula: {formula!r}")


def sigma_band(value: ColumnLike, std: ColumnLike, k: float = 2.0) -> tuple[Column, Column, Column]:
    """``(k*std, value - k*std, value + k*std)``."""
    value, std = _col(value), _col(std)
    return k * std, value - k * std, value + k * std


def hash_unit(*columns: ColumnLike, seed: int = 0) -> Column:
    """A uniform number in [0, 1) that depends on the row only, not on its partition."""
    text = F.concat_ws("|", *[_col(c).cast("string") for c in columns], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 7), 16, 10).cast("bigint") / F.lit(16 ** 7)


def hash_bucket(*columns: ColumnLike, seed: int = 0, buckets: int = 1000) -> Column:
    """A stable bucket number in ``0 .. buckets - 1``."""
    text = F.concat_ws("|", *[_col(c).cast("string") for c in columns], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 7), 16, 10).cast("bigint") % buckets


def jittered(day: ColumnLike, *identity: ColumnLike, days: int = 20, seed: int = 0) -> Column:
    """Moves a date by up to ``days`` either way, by an amount fixed per row identity."""
    span = 2 * days * 86400
    seconds = F.floor(hash_unit(*identity, seed=seed) * span) - days * 86400
    return _col(day).cast("timestamp_ntz") + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def text_to_bool(c: ColumnLike) -> Column:
    return _col(c).try_cast("boolean")


def text_to_date(c: ColumnLike) -> Column:
    """Accepts a plain date or a timestamp text; anything else becomes null."""
    return _col(c).try_cast("timestamp_ntz").cast("date")


def text_to_decimal(c: ColumnLike, kind: str = "decimal(18,3)") -> Column:
    return _col(c).try_cast(kind)


# Duration units in seconds.
_DURATION_UNITS = {
    "ns": 1e-9, "us": 1e-6, "µs": 1e-6, "ms": 1e-3, "s": 1.0, "m": 60.0, "h": 3600.0,
}
_DURATION_PART = re.compile(r"(\d+\.?\d*|\.\d+)(ns|us|µs|ms|s|m|h)")


def duration_seconds(text: str) -> float:
    """Seconds of a duration such as ``168h`` or ``1h30m10s``."""
    sign = -1.0 if text.startswith("-") else 1.0
    body = text.lstrip("+-")
    if body == "0":
        return 0.0
    parts = _DURATION_PART.findall(body)
    if not parts or "".join(n + u for n, u in parts) != body:
        raise ValueError(f"{text!r} is no duration")
    return sign * sum(float(n) * _DURATION_UNITS[u] for n, u in parts)


def relative_date(text: str, now: Column | None = None) -> Column:
    """``today`` or ``today-<duration>`` as a date; ``now`` can be injected."""
    now = F.localtimestamp() if now is None else now
    if text == "today":
        return now.cast("date")
    parts = text.split("-")
    if len(parts) != 2:
        raise ValueError(f"{text!r} is neither today nor today-<duration>")
    if parts[0] != "today":
        raise ValueError(f"{text!r} does not begin with today")
    seconds = F.lit(duration_seconds(parts[1])).cast("decimal(18,6)")
    return (now - F.make_dt_interval(secs=seconds)).cast("date")


def company_ratios() -> dict[str, Column]:
    """Row-wise metrics of a wide statement row (margin stability needs a window)."""
    revenue = F.col("incomeStatement_revenue")
    rnd = F.col("incomeStatement_rnd")
    value = F.nullif(F.col("enterpriseVal"), F.lit(0))
    tied_up = (
        F.col("balanceSheet_inventory") + F.col("balanceSheet_acctRec")
        - F.col("balanceSheet_acctPay")
    )
    fixed = F.col("balanceSheet_ppeq") + F.col("balanceSheet_intangibles")
    return {
        "operating_efficiency": F.when(
            revenue > 0, (F.col("incomeStatement_sga") + rnd) / revenue,
        ),
        "growth_investment_intensity": F.when(
            revenue > 0, (F.col("cashFlow_capex") + rnd) / revenue,
        ),
        "asset_productivity": safe_divide(revenue, fixed),
        "working_capital_days": safe_divide(tied_up, revenue) * 365,
        "ev_to_ebitda": safe_divide(value, "incomeStatement_ebitda"),
        "ev_to_fcf": safe_divide(value, "cashFlow_freeCashFlow"),
        "ev_to_sales": safe_divide(value, revenue),
        "financial_health_score": safe_divide("overview_currentRatio", "overview_debtEquity"),
    }
