"""Zipped CSV feeds."""

from __future__ import annotations

import csv
import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quantloom.session import checkpointed
from quantloom.sources.csv import try_typed

_CHUNK = 10_000
_ROWS = "path string, row bigint, fields array<string>, problem string"


def _rows_of(content: bytes, names: list[str]) -> Iterator[tuple[int, list[str] | None, str | None]]:
    """Records of the archive's only file; where the header is another one, only that problem."""
    try:
        archive = zipfile.ZipFile(io.BytesIO(content))
    except zipfile.BadZipFile:
        yield 0, None, "not a zip archive"
        return
    members = archive.namelist()
    if len(members) != 1:
        yield 0, None, f"the archive holds {len(members)} files instead of 1"
        return
    with archive.open(members[0]) as member:
        text = io.TextIOWrapper(member, encoding="utf-8", newline="")
        for i, record in enumerate(csv.reader(text)):
            if i == 0 and record != names:
                yield 0, None, "unexpected header"
                return
            if i:
                yield i, record, None if len(record) == len(names) else "wrong number of fields"


def _unzip(names: list[str]):
    """Records in chunks of one size, whether archives hold one record each or millions."""
    columns = ["path", "row", "fields", "problem"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows: list[tuple] = []
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                for number, fields, problem in _rows_of(content, names):
                    rows.append((path, number, fields, problem))
                    if len(rows) == _CHUNK:
                        yield pd.DataFrame(rows, columns=columns)
                        rows = []
        if rows:
            yield pd.DataFrame(rows, columns=columns)

    return run


def read_zipped_csv(spark: SparkSession, path: str, ddl: str) -> tuple[DataFrame, DataFrame]:
    """``(rows, rejects)`` of a folder of archives that hold one CSV each."""
    return unpack_archives(spark.read.format("binaryFile").load(path), ddl)


def unpack_archives(archives: DataFrame, ddl: str) -> tuple[DataFrame, DataFrame]:
    """``(rows, rejects)`` of archives given as ``path`` and ``content``.

    Archives are unpacked once, in parallel, and emit records in chunks.  An
    archive without exactly one file, or whose header is another one, is
    reported with its path and yields no rows; so is every record of another
    width, and every record with a value that its column can't hold.
    """
    schema = T.StructType.fromDDL(ddl)
    names = [f.name for f in schema.fields]
    records = checkpointed(archives.select("path", "content").mapInPandas(_unzip(names), _ROWS))
    texts = [F.nullif(F.get("fields", F.lit(i)), F.lit("")) for i in range(len(names))]
    values = [try_typed(t, f.dataType) for t, f in zip(texts, schema.fields)]
    bad = [F.when(t.isNotNull() & v.isNull(), F.lit(f"{f.name} is no {f.dataType.simpleString()}")) for t, v, f in zip(texts, values, schema.fields)]
    checked = records.withColumn("problem", F.coalesce("problem", *bad))
    rejects = checked.where("problem is not null").select("path", "row", "problem")
    typed = [v.alias(n) for v, n in zip(values, names)]
    return checked.where("problem is null").select(*typed), rejects
