"""Set operations on rows, keys and columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def union_checked(frames: Sequence[DataFrame]) -> DataFrame:
    """Union of parts whose columns agree in number, name and position."""
    frames = [f for f in frames if f is not None and f.columns]
    if not frames:
        raise ValueError("nothing to join: no part has a column")
    first = frames[0].columns
    for i, frame in enumerate(frames[1:], start=2):
        if len(frame.columns) != len(first):
            raise ValueError(
                f"part {i} has {len(frame.columns)} columns, not {len(first)}",
            )
        for j, (want, got) in enumerate(zip(first, frame.columns), start=1):
            if want != got:
                raise ValueError(
                    f"part {i}: column {j} is '{got}', not '{want}'",
                )
    return union_all(frames)


def shared_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.select(key).intersect(right.select(key))


def missing_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.select(key).subtract(right.select(key))


def other_columns(df: DataFrame, excluded: Sequence[str]) -> list[str]:
    """Column names outside a set, in table order."""
    gone = set(excluded)
    return [c for c in df.columns if c not in gone]
