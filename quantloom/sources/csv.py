"""CSV feeds: typed or textual, one file or many, bound by column name."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quantloom.session import checkpointed

# Comma separated, double quote as quote and escape.
_FORMAT = {"header": "true", "sep": ",", "quote": '"', "escape": '"'}


def read_csv_typed(
    spark: SparkSession, path: str | Sequence[str], ddl: str, multi_line: bool = False,
) -> DataFrame:
    """CSV with a fixed layout.  A bad value, a ragged row or another header fails the read."""
    return (
        spark.read.options(**_FORMAT).option("mode", "FAILFAST").option("enforceSchema", "false")
        .option("multiLine", multi_line).schema(ddl).csv(path)
    )


def read_csv_strings(
    spark: SparkSession, path: str | Sequence[str], multi_line: bool = False,
) -> DataFrame:
    """CSV with every column as text, named by the header."""
    return (
        spark.read.options(**_FORMAT).option("mode", "FAILFAST").option("inferSchema", "false")
        .option("multiLine", multi_line).csv(path)
    )


def cast_to(df: DataFrame, ddl: str, strict: bool = True) -> DataFrame:
    """Projects by name and casts; extra columns go, missing ones are an error.

    Timestamp texts are accepted for dates.  With ``strict`` a bad text raises,
    otherwise it becomes null.
    """
    schema = T.StructType.fromDDL(ddl)
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns are missing: {missing}")
    out: list[Column] = []
    for f in schema.fields:
        c = F.col(f"`{f.name}`")
        steps = [T.TimestampNTZType(), f.dataType] if isinstance(f.dataType, T.DateType) else [f.dataType]
        for kind in steps:
            c = c.cast(kind) if strict else c.try_cast(kind)
        out.append(c.alias(f.name))
    return df.select(*out)


def read_cells(spark: SparkSession, path: str | Sequence[str], names: Sequence[str], stream: bool = False) -> DataFrame:
    """Lines of a feed as text: file, cells, whether the line is ragged, and whether it is the header.

    The header is any line whose cells are the column names, in whatever order.
    With ``stream`` new files come as batches, each file whole in one of them.
    """
    cells = [f"c{i}" for i in range(len(names))]
    reader = spark.readStream if stream else spark.read
    lines = (
        reader.options(**{**_FORMAT, "header": "false"}).option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_bad").option("recursiveFileLookup", "true")
        .schema(", ".join([*(f"{c} string" for c in cells), "_bad string"])).csv(path)
        .select(F.col("_metadata.file_path").alias("path"), F.array(*cells).alias("cells"), F.col("_bad").isNotNull().alias("ragged"))
    )
    sorted_names = F.array(*[F.lit(n) for n in sorted(names)])
    # Most lines are told by their first cell, without sorting all of them.
    is_header = F.trim(F.col("cells")[0]).isin(*names) & (F.array_sort(F.transform("cells", lambda c: F.trim(c))) == sorted_names)
    return lines.withColumn("is_header", F.coalesce(is_header, F.lit(False)))


def named_cell(name: str) -> Column:
    """The cell of a column, by the ``header`` array that the row carries."""
    return F.element_at("cells", F.array_position("header", name).cast("int"))


def headers(lines: DataFrame) -> DataFrame:
    """(path, header) of every file that shows one."""
    return lines.where("is_header").groupBy("path").agg(F.first(F.transform("cells", lambda c: F.trim(c))).alias("header"))


# Fixed value: the body that means "no data for this key"; any other single line is a failure.
EMPTY_BODIES = ("None",)


def try_typed(text: Column, kind: T.DataType) -> Column:
    """The value of a cell, timestamps accepted for dates; null where it has none."""
    return (text.try_cast(T.TimestampNTZType()) if isinstance(kind, T.DateType) else text).try_cast(kind)


# Files that are broadcast at most.
FEW_FILES = 20_000


def _few(files: DataFrame) -> DataFrame:
    """Files to be met by their path, broadcast where they are counted to be few."""
    return F.broadcast(files) if files.count() <= FEW_FILES else files


def bound_files(lines: DataFrame, ddl: str) -> tuple[DataFrame, DataFrame]:
    """``(path and typed columns of the rows of good files, path, n_lines and class of every file)``.

    ``lines`` are materialised ``read_cells``.  Every file is bound by the
    header that it shows itself; a file with a ragged line, a bad value, another
    header or no data is ``failed``, one that says there is none is ``empty``,
    all others are ``ok``.
    """
    layout = T.StructType.fromDDL(ddl)
    names = layout.fieldNames()
    files = lines.groupBy("path").agg(
        F.max(F.when(F.col("is_header"), F.transform("cells", lambda c: F.trim(c)))).alias("header"), F.count(F.lit(1)).alias("n_lines"),
        F.bool_or(F.col("ragged")).alias("ragged"), F.min(F.trim(F.col("cells")[0])).alias("body"),
    )
    files = checkpointed(files)
    # Most files share a header: only the others, and files that fail, are looked up, so that lines stay where they are.
    found = files.where("header is not null").groupBy("header").count().orderBy(F.desc("count"), "header").first()
    usual = F.array(*[F.lit(n) for n in (found["header"] if found else names)])
    odd = files.where(~F.col("header").eqNullSafe(usual)).select("path", F.col("header").alias("_own"), F.lit(True).alias("_odd"))
    data = (
        lines.where("not is_header").join(_few(odd), "path", "left").where("_odd is null or _own is not null")
        .withColumn("header", F.coalesce("_own", usual)).drop("_own", "_odd")
    )
    texts = {f.name: named_cell(f.name) for f in layout}
    values = {f.name: try_typed(texts[f.name], f.dataType) for f in layout}
    unread = reduce(lambda x, y: x | y, [texts[n].isNotNull() & values[n].isNull() for n in names])
    typed = data.select("path", *[values[n].alias(n) for n in names], unread.alias("_unread"))
    broken = typed.where("_unread").select("path", F.lit(True).alias("broken")).distinct()
    single = F.col("n_lines") == 1
    kind = (
        F.when(single & F.col("body").isin(*EMPTY_BODIES), "empty")
        .when(single | F.col("header").isNull() | F.col("ragged") | F.col("broken"), "failed").otherwise("ok")
    )
    classified = checkpointed(files.join(broken, "path", "left").select("path", "n_lines", kind.alias("class")))
    return typed.join(_few(classified.where("class <> 'ok'").select("path")), "path", "left_anti").drop("_unread"), classified


def first_header(spark: SparkSession, path: str | Sequence[str]) -> str:
    """Header line of one file; stops at the first line found."""
    line = spark.read.text(path).where(F.col("_metadata.file_block_start") == 0).first()
    if line is None:
        raise ValueError("no file in the landing has a line")
    return line["value"]


def _layout(header: str, ddl: str) -> T.StructType:
    wanted = {f.name: f for f in T.StructType.fromDDL(ddl).fields}
    names = [n.strip().strip('"') for n in header.split(",")]
    if sorted(names) != sorted(wanted):
        raise ValueError(f"header {names} does not have the columns {list(wanted)}")
    return T.StructType([wanted[n] for n in names])


def read_csv_by_name(
    spark: SparkSession, path: str | Sequence[str], ddl: str, mixed: bool = False,
    with_file: bool = False,
) -> DataFrame:
    """A feed of many files whose columns may come in any order, bound by name.

    One header is read ahead and every file is checked against it while it is
    read.  ``mixed`` allows another order in every file: headers travel as rows,
    one for each file, and meet the lines of their file in a join.  A bad value,
    a ragged line and a file without the header fail the read.
    """
    if not mixed:
        layout = _layout(first_header(spark, path), ddl)
        part = (
            spark.read.options(**_FORMAT).option("mode", "FAILFAST")
            .option("enforceSchema", "false").schema(layout).csv(path)
        )
        columns = [F.col(f"`{n}`") for n in T.StructType.fromDDL(ddl).fieldNames()]
        return part.select(*columns, *[F.col("_metadata.file_path").alias("_file")] * with_file)
    layout = T.StructType.fromDDL(ddl)
    lines = read_cells(spark, path, layout.fieldNames())
    data = lines.where("not is_header").join(headers(lines), "path", "left")
    problem = (
        F.when(F.col("header").isNull(), "no header in ").when(F.col("ragged"), "ragged line in ")
    )
    checked = data.withColumn("cells", F.when(problem.isNull(), F.col("cells")).otherwise(
        F.raise_error(F.concat(problem, F.col("path"))).cast("array<string>"),
    ))
    typed = checked.select(*[named_cell(n).alias(n) for n in layout.fieldNames()], F.col("path").alias("_file"))
    out = cast_to(typed, ddl)
    if not with_file:
        return out
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in layout]
    return typed.select(*columns, "_file")


def with_key_column(df: DataFrame, key: str, name: str = "ticker") -> DataFrame:
    """Appends a constant key as the last column."""
    return df.withColumn(name, F.lit(key))


# A file name without the start date and the extension, such as ``BRK.A_1995-01-01.csv``.
FILE_KEY = r"([^/]+?)(?:_\d{4}-\d{2}-\d{2})?(?:\.(?:csv|txt|json))?(?:\.gz)?$"


def key_from_file(path: Column | str, pattern: str = FILE_KEY) -> Column:
    """The key in a file's name or path, upper-cased."""
    c = F.col(path) if isinstance(path, str) else path
    return F.upper(F.regexp_extract(c, pattern, 1))


def dedupe_rows(df: DataFrame, order: Sequence[Column | str] = ()) -> DataFrame:
    """Drops repeated rows; texts that differ only in runs of blanks are equal.

    The first row by ``order`` is kept, or the smallest row when no order is given.
    """
    keys = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            c = F.regexp_replace(c, " +", " ")
        keys.append(c)
    named = {f"_key{i}": c for i, c in enumerate(keys)}
    rank = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order], *df.columns)
    picked = (
        df.select(*[c.alias(n) for n, c in named.items()], F.struct(*df.columns).alias("_row"),
                  rank.alias("_rank"))
        .groupBy(*named).agg(F.min_by("_row", "_rank").alias("_row"))
    )
    return picked.select("_row.*")


def query_landed_file(
    spark: SparkSession, sql: str, files: Mapping[str, DataFrame], params: Mapping[str, object] | None = None,
) -> DataFrame:
    """Runs a parametrised query over landed data.

    ``{name}`` stands for a DataFrame, ``:name`` for a value; a missing one fails.
    """
    return spark.sql(sql, args=dict(params or {}), **files)
