"""Daily work: refresh prices, restate histories, load fundamentals and metadata.

Tables are Parquet folders.  The steps compute new content lazily; the jobs
upsert it into sliced tables, of which only slices with updates are written.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quantloom import schemas
from quantloom.operators.filters import corporate_actions
from quantloom.operators.windows import dedupe_latest
from quantloom.plans.universe import (
    select_keys,
    selected_fundamentals,
    selected_last_trading_day,
    selected_us_tickers,
)
from quantloom.session import checkpointed, stored
from quantloom.sources.archive import read_zipped_csv
from quantloom.sources.csv import (
    FILE_KEY,
    bound_files,
    cast_to,
    dedupe_rows,
    key_from_file,
    read_cells,
    read_csv_by_name,
    read_csv_strings,
)
from quantloom.sources.payloads import ingest_report
from quantloom.sources.tables import full_refresh, upsert, upsert_partitions
from quantloom.streaming import landing


@dataclass(frozen=True)
class DailyRefresh:
    universe: DataFrame
    snapshot: DataFrame
    prices: DataFrame
    restate: DataFrame


def daily_refresh(
    tickers: DataFrame, snapshot: DataFrame, prices: DataFrame,
    tie_break: Sequence[Column] = (),
) -> DailyRefresh:
    """Upserts the latest prices and lists the tickers whose history changed."""
    universe = selected_us_tickers(tickers)
    selected = selected_last_trading_day(snapshot, universe, tie_break)
    merged = upsert(prices, selected.select(prices.columns), schemas.DAILY_ADJUSTED_KEY)
    return DailyRefresh(universe, selected, merged, corporate_actions(selected).select("ticker"))


def restate_history(
    prices: DataFrame, keys: DataFrame, history: DataFrame, order: Sequence[Column] = (),
) -> tuple[DataFrame, DataFrame]:
    """``(restated prices, keys without a history)``.

    Rows of the listed keys are replaced by their history where both have the
    date; a key whose history is missing is reported and the others continue.
    """
    rows, failed = history_of(keys, history, order)
    return upsert(prices, rows, schemas.DAILY_ADJUSTED_KEY), failed


def history_of(
    keys: DataFrame, history: DataFrame, order: Sequence[Column] = (),
) -> tuple[DataFrame, DataFrame]:
    """``(one row per listed key and date, listed keys without any)``."""
    wanted = keys.select(F.upper("ticker").alias("ticker")).distinct()
    rows = history.withColumn("ticker", F.upper("ticker")).join(wanted, "ticker", "left_semi")
    rows = dedupe_latest(rows, schemas.DAILY_ADJUSTED_KEY, list(order) or [F.col("adjClose").desc()])
    failed = wanted.join(rows.select("ticker").distinct(), "ticker", "left_anti")
    return rows, failed


def read_landed(
    spark: SparkSession, path: str, ddl: str, wanted: DataFrame | None = None,
    key_pattern: str = FILE_KEY,
) -> tuple[DataFrame, DataFrame]:
    """``(rows of good files with their key, one row per file or wanted key and its class)``.

    The landing is listed and read once: lines are kept as cells with their file, every
    file is bound by the header that it shows itself, and a file with a ragged
    line, a bad value, another header or no data fails alone.  A wanted key
    without a file is failed as well.
    """
    names = T.StructType.fromDDL(ddl).fieldNames()
    lines = landed = read_cells(spark, path, names)
    key = key_from_file("path", key_pattern)
    if wanted is not None:
        wanted = wanted.select(F.upper("ticker").alias("ticker")).distinct()
        lines = lines.withColumn("ticker", key).join(wanted, "ticker", "left_semi").drop("ticker")
    typed, files = bound_files(stored(lines, "landed"), ddl)
    classified = files.withColumn("ticker", key)
    rows = typed.withColumn("_key", key).select(*[c for c in names if c != "ticker"], F.col("_key").alias("ticker"))
    if wanted is not None:
        found = wanted.join(classified, "ticker", "left")
    else:  # files without a line have only a name
        listed = spark.createDataFrame([(n,) for n in landed.inputFiles() if n.endswith((".csv", ".csv.gz"))], "path string")
        # The same file may be spelled file:/x or file:///x: compare what follows the scheme.
        bare = F.regexp_replace("path", "^[a-z0-9]+:/+", "/").alias("_bare")
        blank = listed.select("path", bare).join(classified.select(bare), "_bare", "left_anti")
        found = classified.select("path", "ticker", "n_lines", "class").unionByName(
            blank.select("path", key.alias("ticker"), F.lit(None).cast("bigint").alias("n_lines"), F.lit("failed").alias("class")),
        )
    return rows, found.select("path", "ticker", F.coalesce("n_lines", F.lit(0)).cast("bigint").alias("n_lines"), F.coalesce("class", F.lit("failed")).alias("class"))


def load_fundamentals(
    spark: SparkSession, path: str, table: DataFrame, keys: Sequence[str], ddl: str,
    wanted: DataFrame | None = None, key_pattern: str = FILE_KEY,
) -> tuple[DataFrame, DataFrame]:
    """``(upserted table, classified files)`` for daily ratios or statements."""
    rows, classified = read_landed(spark, path, ddl, wanted, key_pattern)
    updates = dedupe_rows(rows).select(*table.columns)
    order = [F.col(c).desc() for c in table.columns if c not in keys]
    return upsert(table, updates, keys, order), classified


def update_metadata(
    spark: SparkSession, path: str, meta: DataFrame, tie_break: Sequence[Column] = (),
) -> tuple[DataFrame, DataFrame]:
    """``(upserted metadata, the rows that were applied)``; extra feed columns are ignored."""
    rows = cast_to(read_csv_strings(spark, path), schemas.FUNDAMENTALS_META_DDL)
    order = [F.col("statementLastUpdated").desc(), F.col("ticker").asc(), *tie_break]
    rows = dedupe_latest(rows, schemas.FUNDAMENTALS_META_KEY, order)
    return upsert(meta, rows, schemas.FUNDAMENTALS_META_KEY), rows


@dataclass(frozen=True)
class DailyReport:
    n_restated: int
    failed: DataFrame


def run_daily(
    spark: SparkSession, archives: str, snapshot: str, histories: str, prices_path: str, root: str,
) -> DailyReport:
    """The daily job from landed files into the price table.

    Universe and snapshot replace their tables; selected prices are upserted;
    tickers with a split or dividend are restated from their history files.
    Only slices that receive rows are written, and a repeated run gives the
    same table.
    """
    tickers, rejects = read_zipped_csv(spark, archives, schemas.SUPPORTED_TICKERS_DDL)
    problem = rejects.first()
    if problem is not None:
        raise ValueError(f"{problem['path']}: {problem['problem']}")
    full_refresh(tickers, f"{root}/supported_tickers")
    full_refresh(
        read_csv_by_name(spark, snapshot, schemas.LAST_TRADING_DAY_DDL), f"{root}/last_trading_day",
    )
    universe = selected_us_tickers(spark.read.parquet(f"{root}/supported_tickers"))
    selected = checkpointed(selected_last_trading_day(spark.read.parquet(f"{root}/last_trading_day"), universe))
    columns = landing.read_table(spark, prices_path).columns

    def into_table(rows: DataFrame) -> None:
        upsert_partitions(
            spark, prices_path, landing.with_partition(rows.select(*columns)), schemas.DAILY_ADJUSTED_KEY, landing.PARTITION,
        )

    into_table(selected)
    restate = corporate_actions(selected).select("ticker")
    history, _ = read_landed(spark, histories, schemas.PRICE_HISTORY_DDL, wanted=restate)
    rows, failed = history_of(restate, history)
    into_table(rows)
    return DailyReport(restate.count() - failed.count(), failed)


def run_fundamentals(
    spark: SparkSession, folder: str, table_path: str, keys: Sequence[str], ddl: str,
    time: str = "date", wanted: DataFrame | None = None,
) -> DataFrame:
    """Upserts landed files into a sliced table; the report counts keys per batch."""
    rows, classified = read_landed(spark, folder, ddl, wanted)
    columns = landing.read_table(spark, table_path).columns
    updates = dedupe_rows(rows).select(*columns)
    order = [F.col(c).desc() for c in columns if c not in keys]
    upsert_partitions(
        spark, table_path, landing.with_partition(updates, time), keys, landing.PARTITION, order,
    )
    if wanted is not None and "batch" in wanted.columns:
        batches = wanted.select(F.upper("ticker").alias("ticker"), "batch").distinct()
        classified = classified.join(batches, "ticker")
    else:
        classified = classified.withColumn("batch", F.lit(0).cast("bigint"))
    return ingest_report(classified)


def update_fundamentals(
    spark: SparkSession, meta: DataFrame, universe: DataFrame, folder: str, table_path: str,
    keys: Sequence[str], ddl: str, time: str = "date", **selection,
) -> DataFrame:
    """The fundamentals job from key selection to report; ``selection`` goes to ``select_keys``."""
    companies = selected_fundamentals(meta, universe)
    wanted = checkpointed(select_keys(companies, **selection))
    return run_fundamentals(spark, folder, table_path, keys, ddl, time, wanted)
