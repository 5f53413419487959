"""Windowed operators over keyed series.

Ordered frames go through ``framed``: keys of ordinary size use one plain
window; keys above ``max_group_rows`` are cut into blocks of consecutive rows,
each with the few neighbouring rows its frame reaches, so no task ever orders
more than a block.  Pass ``max_group_rows=None`` only where the number of rows
per key is bounded by the data model, e.g. one row per key and calendar day.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quantloom.functions.scalars import safe_divide
from quantloom.operators.skew import (
    MAX_GROUP_ROWS,
    find_hot_keys,
    join_on_keys,
    split_hot,
    with_exact_row_number,
    with_slices,
)

# (frame, partition columns, order columns) -> frame; ``_rn`` is the row number in the key.
FrameStep = Callable[[DataFrame, list[str], list[Column]], DataFrame]


def framed(
    df: DataFrame,
    key: str,
    time: str,
    step: FrameStep,
    before: int = 0,
    after: int = 0,
    tie_break: Sequence[str] = (),
    max_group_rows: int | None = MAX_GROUP_ROWS,
) -> DataFrame:
    """Runs ``step`` on rows of each key in time order.

    ``step`` may look ``before`` rows back and ``after`` rows ahead.  Cutting a
    hot key reads the input several times, so the input must be repeatable
    (state a ``tie_break`` where times repeat), and worth writing first where
    it is expensive.
    """
    order = [F.col(c).asc() for c in (time, *tie_break)]

    def plain(rows: DataFrame) -> DataFrame:
        numbered = rows.withColumn(
            "_rn", F.row_number().over(W.partitionBy(key).orderBy(*order)),
        )
        return step(numbered, [key], order).drop("_rn")

    hot = find_hot_keys(df, [key], max_group_rows) if max_group_rows else None
    if hot is None:
        return plain(df)

    ordinary, hot_rows = split_hot(df, hot)
    numbered = with_exact_row_number(with_slices(hot_rows, hot, [time, *tie_break]), hot, order)
    size = max(hot.limit, before, after, 1)
    own = F.floor((F.col("_rn") - 1) / size)
    place = (F.col("_rn") - 1) % size
    copies = F.array_compact(F.array(
        own,
        F.when(place >= size - before, own + 1),
        F.when((place < after) & (own > 0), own - 1),
    ))
    blocks = (
        numbered.drop("_slice", "_spread").withColumn("_own", own)
        .select("*", F.explode(copies).alias("_block"))
    )
    done = step(blocks, [key, "_block"], [F.col("_rn").asc()])
    kept = done.where(F.col("_own") == F.col("_block")).drop("_rn", "_own", "_block")
    return plain(ordinary).unionByName(kept)


@dataclass(frozen=True)
class Rolling:
    """One frame length: ``{output: value column}`` for means and sample deviations."""

    periods: int
    means: Mapping[str, str] = field(default_factory=dict)
    deviations: Mapping[str, str] = field(default_factory=dict)

    def values(self) -> list[str]:
        return sorted({*self.means.values(), *self.deviations.values()})


def _frame_moments(frame: DataFrame, frames: Sequence[Rolling], part: list[str]) -> DataFrame:
    """Rolling moments of a table that carries ``_rn``, at constant cost per row.

    Spark evaluates a sliding frame anew for every row.  Here the rows of a key
    are cut into runs as long as the frame, so that every frame is the end of
    one run and the beginning of the next.  Running aggregates along a run give
    the beginnings, those against it the ends, and two parts are added; nothing
    is ever taken away, so a NaN or an outlier is gone once it has left the frame.
    """
    names = list(frame.columns)
    out = frame
    results: dict[str, Column] = {}
    for f, rolling in enumerate(frames):
        length = rolling.periods + 1
        squares = set(rolling.deviations.values())
        run = f"_run{f}"
        out = out.withColumn(run, F.floor((F.col("_rn") - 1) / length))
        same_run = W.partitionBy(*part, run)
        spans = {
            "h": same_run.orderBy(F.col("_rn").asc()).rowsBetween(W.unboundedPreceding, 0),
            "t": same_run.orderBy(F.col("_rn").desc()).rowsBetween(W.unboundedPreceding, 0),
        }
        index = {v: i for i, v in enumerate(rolling.values())}
        for tag, spec in spans.items():
            running = {}
            for v, i in index.items():
                number = F.col(v).cast("double")
                running[f"_{tag}n{f}_{i}"] = F.count(number).over(spec)
                running[f"_{tag}m{f}_{i}"] = F.coalesce(F.avg(number).over(spec), F.lit(0.0))
                if v in squares:
                    running[f"_{tag}v{f}_{i}"] = F.coalesce(F.var_pop(number).over(spec), F.lit(0.0))
            out = out.withColumns(running)
        # The end of the run before, from the frame's first row on; none where the frame is one whole run.
        along = W.partitionBy(*part).orderBy("_rn")
        crosses = F.col("_rn") % length != 0
        ends = [f"_t{k}{f}_{i}" for v, i in index.items() for k in ("nmv" if v in squares else "nm")]
        out = out.withColumns({c: F.coalesce(F.when(crosses, F.lag(c, rolling.periods).over(along)), F.lit(0)) for c in ends})
        totals = {f"_n{f}_{i}": F.col(f"_hn{f}_{i}") + F.col(f"_tn{f}_{i}") for i in index.values()}
        out = out.withColumns(totals)
        warm = F.col("_rn") > rolling.periods
        for name, v in rolling.means.items():
            n1, m1, n2, m2, n = _parts(f, index[v])
            results[name] = F.when(warm, _weighted(n1, m1, n2, m2) / F.nullif(n, F.lit(0)))
        for name, v in rolling.deviations.items():
            n1, m1, n2, m2, n = _parts(f, index[v])
            q1, q2 = n1 * F.col(f"_hv{f}_{index[v]}"), n2 * F.col(f"_tv{f}_{index[v]}")
            apart = F.when((n1 == 0) | (n2 == 0), 0.0).otherwise((m1 - m2) * (m1 - m2) * n1 * n2 / n)
            results[name] = F.when(warm, F.sqrt((q1 + q2 + apart) / F.nullif(F.greatest(n - 1, F.lit(0)), F.lit(0))))
    return out.select(*names, *[c.alias(n) for n, c in results.items()])


def _parts(f: int, i: int) -> list[Column]:
    """Number and mean of a frame's beginning in its last run and of its end in the run before, and the number of both."""
    return [F.col(c.format(f"{f}_{i}")) for c in ("_hn{}", "_hm{}", "_tn{}", "_tm{}", "_n{}")]


def _weighted(n1: Column, m1: Column, n2: Column, m2: Column) -> Column:
    """Sum of two parts; an empty part adds nothing."""
    return F.when(n1 == 0, m2 * n2).when(n2 == 0, m1 * n1).otherwise(m1 * n1 + m2 * n2)


def rolling_moments(
    df: DataFrame,
    key: str,
    time: str,
    frames: Sequence[Rolling],
    tie_break: Sequence[str] = (),
    max_group_rows: int | None = MAX_GROUP_ROWS,
) -> DataFrame:
    """Adds rolling means and deviations, null during warm-up, for several frame lengths at once."""

    def step(frame: DataFrame, part: list[str], order: list[Column]) -> DataFrame:
        return _frame_moments(frame, frames, part)

    before = max(r.periods for r in frames) + 1
    return framed(
        df, key, time, step, before=before, tie_break=tie_break, max_group_rows=max_group_rows,
    )


def with_sma(
    df: DataFrame, value: str, key: str, time: str, periods: int, name: str, **options,
) -> DataFrame:
    return rolling_moments(df, key, time, [Rolling(periods, means={name: value})], **options)


def with_index_volatility(
    df: DataFrame, price: str, index_price: str, key: str, time: str, periods: int, name: str,
    **options,
) -> DataFrame:
    """Rolling deviation of the price measured in units of an index."""
    ratio = df.withColumn("_ratio", safe_divide(price, index_price))
    frame = Rolling(periods, deviations={name: "_ratio"})
    return rolling_moments(ratio, key, time, [frame], **options).drop("_ratio")


def with_volume_volatility(
    df: DataFrame, volume: str, key: str, time: str, periods: int, mean: str, name: str, **options,
) -> DataFrame:
    """Rolling mean of the volume, and its deviation relative to that mean."""
    frame = Rolling(periods, means={mean: volume}, deviations={"_dev": volume})
    out = rolling_moments(df, key, time, [frame], **options)
    return out.withColumn(name, safe_divide("_dev", mean)).drop("_dev")


def with_short_deviation(
    df: DataFrame, value: str, key: str, time: str, periods: int, name: str, **options,
) -> DataFrame:
    """Sample deviation over a short frame without warm-up (one row gives null)."""

    def step(frame: DataFrame, part: list[str], order: list[Column]) -> DataFrame:
        spec = W.partitionBy(*part).orderBy(*order).rowsBetween(-periods, 0)
        return frame.withColumn(name, F.stddev_samp(value).over(spec))

    return framed(df, key, time, step, before=periods, **options)


def with_future_returns(
    df: DataFrame, key: str, time: str, returns: Mapping[str, tuple[str, int]], **options,
) -> DataFrame:
    """Values some rows ahead over the current ones: ``{output: (value column, rows ahead)}``."""

    def step(frame: DataFrame, part: list[str], order: list[Column]) -> DataFrame:
        spec = W.partitionBy(*part).orderBy(*order)
        return frame.withColumns({
            name: safe_divide(F.lead(value, n).over(spec), value)
            for name, (value, n) in returns.items()
        })

    reach = max(n for _, n in returns.values())
    return framed(df, key, time, step, after=reach, **options)


def with_future_return(
    df: DataFrame, price: str, key: str, time: str, periods: int, name: str, **options,
) -> DataFrame:
    """Value ``periods`` rows ahead over the current value."""
    return with_future_returns(df, key, time, {name: (price, periods)}, **options)


def with_relative_developments(
    df: DataFrame, key: str, time: str, pairs: Mapping[str, tuple[str, str]],
    index_lag: str = "key", **options,
) -> DataFrame:
    """Growth of a value since the key's last row over that of an index: ``{output: (value, index)}``.

    ``index_lag="key"`` compares with the index at the key's own last row.
    ``"global"`` takes the index one row back in (time, key) order over the
    whole table: only the first key of a date sees the previous date.  That
    order is never materialised; one row per date carries it.
    """
    if index_lag not in ("key", "global"):
        raise ValueError(f"unknown index_lag: {index_lag!r}")
    indices = sorted({index for _, index in pairs.values()})

    def step(frame: DataFrame, part: list[str], order: list[Column]) -> DataFrame:
        spec = W.partitionBy(*part).orderBy(*order)
        lagged = {f"_last_{v}": F.lag(v, 1).over(spec) for v, _ in pairs.values()}
        if index_lag == "key":
            lagged |= {f"_last_{i}": F.lag(i, 1).over(spec) for i in indices}
        return frame.withColumns(lagged)

    out = framed(df, key, time, step, before=1, **options)
    if index_lag == "global":
        # One row per date, so its order fits one task and it may be broadcast.
        if not isinstance(df.schema[time].dataType, T.DateType):
            raise ValueError(f"{time} must be a DATE for a lag over the whole table")
        days = df.groupBy(time).agg(
            F.min(key).alias("_first_key"), *[F.max_by(i, key).alias(f"_day_{i}") for i in indices],
        )
        days = days.select(time, "_first_key", *[
            F.lag(f"_day_{i}", 1).over(W.orderBy(time)).alias(f"_previous_{i}") for i in indices
        ])
        out = join_on_keys(out, days, [time], small=True)
        first = F.col(key) == F.col("_first_key")
        out = out.withColumns({
            f"_last_{i}": F.when(first, F.col(f"_previous_{i}")).otherwise(F.col(i)) for i in indices
        })

    def growth(value: str) -> Column:
        return safe_divide(value, f"_last_{value}")

    return out.select(*df.columns, *[
        F.nullif(safe_divide(growth(value), growth(index)), F.lit(0)).alias(name)
        for name, (value, index) in pairs.items()
    ])


def with_relative_development(
    df: DataFrame, stock: str, index: str, key: str, time: str, name: str,
    index_lag: str = "key", **options,
) -> DataFrame:
    return with_relative_developments(df, key, time, {name: (stock, index)}, index_lag, **options)


def dedupe_latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each key group in ``order`` (state a total order).

    Catalyst keeps one row per key on the map side, so hot keys shuffle little.
    """
    spec = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(spec)).where("_rank = 1").drop("_rank")


def latest_per_key(
    df: DataFrame, key: str, time: str, tie_break: Sequence[Column] = (),
) -> DataFrame:
    return dedupe_latest(df, [key], [F.col(time).desc(), *tie_break])


def first_in_period(
    df: DataFrame, key: str, time: str, tie_break: Sequence[Column] = (),
) -> DataFrame:
    """First row of each key, year and quarter."""
    spec = W.partitionBy(key, F.year(time), F.quarter(time)).orderBy(F.col(time).asc(), *tie_break)
    return df.withColumn("_rank", F.row_number().over(spec)).where("_rank = 1").drop("_rank")


def relative_to_first(
    df: DataFrame, value: str, key: str, time: str, name: str = "relative",
) -> DataFrame:
    """Value over the key's first value: a combined aggregate joined back, no ordered group."""
    first = df.groupBy(key).agg(F.min_by(value, time).alias("_first"))
    out = join_on_keys(df, first, [key], small=False)
    return out.withColumn(name, safe_divide(value, "_first")).drop("_first")
