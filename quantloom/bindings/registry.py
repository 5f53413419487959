"""Registry of bound queries: a Spark function, and SQL where SQL can say the same."""

from __future__ import annotations

import re
import string
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Bound:
    name: str
    covers: tuple[str, ...]
    run: Query
    sql: str | None


REGISTRY: dict[str, Bound] = {}
STANDINS: dict[str, str] = {}
SPARK_STANDINS: dict[str, str] = {}
_OPENED: dict[tuple, DataFrame] = {}


def standin(name: str, text: str, spark_text: str | None = None) -> None:
    """An input table derived from the driver's tables; ``{name}`` refers to a table.

    The text is plain SQL that both engines read alike, unless Spark has a
    better way to say the same in ``spark_text``.
    """
    STANDINS[name] = text
    SPARK_STANDINS[name] = spark_text or text


def _parents(text: str) -> list[str]:
    return sorted({field for _, field, _, _ in string.Formatter().parse(text) if field})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table or a stand-in as a DataFrame."""
    if name in TABLES:
        path = f"{sf_dir.rstrip('/')}/{name}.parquet"
        key = (spark.sparkContext.applicationId, id(spark), path)
        if key not in _OPENED:  # opening a file costs a job that reads its schema
            _OPENED[key] = spark.read.parquet(path)
        return _OPENED[key]
    text = SPARK_STANDINS[name]
    return spark.sql(text, **{p: table(spark, sf_dir, p) for p in _parents(text)})


def _needed(body: str) -> list[str]:
    """Stand-ins a query refers to, parents first."""
    found: list[str] = []

    def visit(name: str) -> None:
        if name in STANDINS and name not in found:
            for parent in _parents(STANDINS[name]):
                visit(parent)
            found.append(name)

    for word in re.findall(r"[a-z_]\w*", body):
        visit(word)
    return found


def full_sql(body: str) -> str:
    """The query with its stand-ins in front."""
    needed = _needed(body)
    if not needed:
        return body
    parts = []
    for name in needed:
        text = STANDINS[name]
        parts.append(f"{name} as ({text.format(**{p: p for p in _parents(text)})})")
    body = body.strip()
    if body.lower().startswith("with "):
        return f"with {', '.join(parts)}, {body[5:]}"
    return f"with {', '.join(parts)} {body}"


def bind(name: str, covers: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under ``name``; ``covers`` lists inventory ids."""

    def register(run: Query) -> Query:
        if name in REGISTRY:
            raise ValueError(f"{name} is registered twice")
        REGISTRY[name] = Bound(name, tuple(covers.split()), run, full_sql(sql) if sql else None)
        return run

    return register


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})
