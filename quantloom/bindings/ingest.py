"""Bound queries: landing, checking and writing tables."""

from __future__ import annotations

import io
import uuid
import zipfile

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quantloom.bindings.registry import bind, table
from quantloom.operators.setops import union_checked
from quantloom.session import scratch_path
from quantloom.sources import archive, csv, payloads, tables

CUSTOMER_DDL = (
    "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
)


def _landed_csv(spark, df, name):
    path = scratch_path(spark, name)
    df.write.option("header", True).option("escape", '"').csv(path)
    return path


@bind("read_csv_typed", "A1", "select * from customer")
def _(spark, d):
    return csv.read_csv_typed(spark, _landed_csv(spark, table(spark, d, "customer"), "typed"), CUSTOMER_DDL)


@bind("read_csv_strings_cast", "A2 H13", """
    select ticker, exchange, assetType, priceCurrency, startDate, endDate from supported""")
def _(spark, d):
    from quantloom import schemas

    path = _landed_csv(spark, table(spark, d, "supported"), "strings")
    return csv.cast_to(csv.read_csv_strings(spark, path), schemas.SUPPORTED_TICKERS_DDL)


@bind("read_csv_glob_by_name", "A3", "select o_orderkey, o_custkey, o_orderstatus from orders")
def _(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    root = scratch_path(spark, "glob")
    orders.where("o_orderstatus = 'F'").write.option("header", True).csv(f"{root}/a")
    turned = orders.select("o_orderstatus", "o_custkey", "o_orderkey")
    turned.where("o_orderstatus <> 'F'").write.option("header", True).csv(f"{root}/b")
    return csv.read_csv_by_name(
        spark, f"{root}/*/*.csv", "o_orderkey bigint, o_custkey bigint, o_orderstatus string",
        mixed=True,
    )


@F.pandas_udf(T.BinaryType())
def _zipped(text: pd.Series) -> pd.Series:
    def pack(body: str) -> bytes:
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("data.csv", body)
        return buffer.getvalue()

    return text.map(pack)


@bind("read_zipped_csv", "A4", "select c_custkey, c_name, c_acctbal from customer")
def _(spark, d):
    c = table(spark, d, "customer")
    # A small file is one task, but every row of it becomes an archive.
    c = c.repartition(4 * spark.sparkContext.defaultParallelism, "c_custkey")
    body = F.concat(
        F.lit("c_custkey,c_name,c_acctbal\n"),
        F.concat_ws(",", F.col("c_custkey").cast("string"), F.concat(F.lit('"'), "c_name", F.lit('"')),
                    F.col("c_acctbal").cast("string")),
        F.lit("\n"),
    )
    archives = c.select(F.col("c_custkey").cast("string").alias("path"), _zipped(body).alias("content"))
    rows, _ = archive.unpack_archives(archives, "c_custkey bigint, c_name string, c_acctbal double")
    return rows


@bind("with_key_column", "A5", "select r_regionkey, r_name, 'AAPL' as ticker from region")
def _(spark, d):
    return csv.with_key_column(table(spark, d, "region"), "AAPL")


@bind("key_from_file", "A5", "select c_custkey, c_mktsegment as ticker from customer")
def _(spark, d):
    path = scratch_path(spark, "keyed")
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    c.write.option("header", True).partitionBy("c_mktsegment").csv(path)
    rows = spark.read.option("header", True).option("recursiveFileLookup", True).schema(
        "c_custkey bigint",
    ).csv(path)
    key = csv.key_from_file(F.col("_metadata.file_path"), "c_mktsegment=([^/]+)")
    return rows.select("c_custkey", key.alias("ticker"))


@bind("union_checked", "A6 G1", "select l_orderkey, l_returnflag, l_quantity from lineitem")
def _(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_returnflag", "l_quantity")
    a = F.col("l_returnflag") == "A"
    return union_checked([li.where(a), li.where(~a)])


@bind("dedupe_rows", "A7", "select distinct o_custkey, o_orderpriority from orders")
def _(spark, d):
    o = table(spark, d, "orders").select("o_custkey", "o_orderpriority")
    spaced = o.withColumn("o_orderpriority", F.regexp_replace("o_orderpriority", " ", "   "))
    return csv.dedupe_rows(o.unionByName(spaced), [F.length("o_orderpriority")])


@bind("full_refresh", "A8", "select * from supplier")
def _(spark, d):
    path = scratch_path(spark, "refresh")
    s = table(spark, d, "supplier")
    tables.full_refresh(s.where("s_acctbal > 0"), path)
    tables.full_refresh(s, path, "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double")
    return spark.read.parquet(path)


_UPSERT_SQL = """
    select s_suppkey as key, s_name as name, s_acctbal as balance from supplier
    union all
    select c_custkey, c_name, c_acctbal from customer
    where c_custkey not in (select s_suppkey from supplier)"""


def _upsert_sides(spark, d):
    old = table(spark, d, "customer").selectExpr("c_custkey key", "c_name name", "c_acctbal balance")
    new = table(spark, d, "supplier").selectExpr("s_suppkey key", "s_name name", "s_acctbal balance")
    return old, new


@bind("upsert", "A9 C10", _UPSERT_SQL)
def _(spark, d):
    old, new = _upsert_sides(spark, d)
    return tables.upsert(old, new.unionByName(new), ["key"], [F.col("name").asc()])


@bind("upsert_partitions", "A9", """
    select cast(o_orderkey as bigint) as o_orderkey, cast(year(o_orderdate) as int) as year,
      case when year(o_orderdate) >= 2000 then o_totalprice + 1 else o_totalprice end as o_totalprice
    from orders""")
def _(spark, d):
    path = scratch_path(spark, "parts")
    o = table(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"), "o_totalprice")
    o.write.partitionBy("year").parquet(path)
    late = o.where("year >= 2000").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    tables.upsert_partitions(spark, path, late, ["o_orderkey"], "year")
    return spark.read.parquet(path)


@bind("duplicate_keys", "A10", """
    select l_orderkey, l_linenumber, count(*) as n_rows from lineitem
    group by l_orderkey, l_linenumber having count(*) > 1""")
def _(spark, d):
    return tables.duplicate_keys(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@bind("replace_table", "A11", "select p_partkey, p_brand, p_retailprice from part")
def _(spark, d):
    name = f"replaced_{uuid.uuid4().hex}"
    part = table(spark, d, "part").select("p_partkey", "p_brand", "p_retailprice")
    return tables.replace_table(part, name, scratch_path(spark, name))


@bind("classify_payloads", "A12", """
    select cast(c_nationkey as varchar) as ticker,
      case when max(c_acctbal) > 9950 then 1 else count(*) + 1 end as n_lines,
      case when max(c_acctbal) > 9950 then 'empty' else 'ok' end as class
    from customer group by c_nationkey""")
def _(spark, d):
    c = table(spark, d, "customer")
    rich = c.groupBy("c_nationkey").agg((F.max("c_acctbal") > 9950).alias("silent"))
    data = c.join(rich, "c_nationkey").where("not silent").select(
        "c_nationkey", F.lit(1).alias("at"), F.col("c_custkey").cast("string").alias("value"),
    )
    heads = rich.select(
        "c_nationkey", F.lit(0).alias("at"), F.expr("if(silent, 'None', 'key')").alias("value"),
    )
    path = scratch_path(spark, "payloads")
    (
        data.unionByName(heads).repartition("c_nationkey").sortWithinPartitions("c_nationkey", "at")
        .select("c_nationkey", "value").write.partitionBy("c_nationkey").text(path)
    )
    found = payloads.classify_payloads(spark, path, "*.txt", r"c_nationkey=(\d+)")
    return found.select("ticker", "n_lines", "class")


_CLASSIFIED = """select cast(o_custkey as string) as ticker, o_orderpriority as batch,
    case o_orderstatus when 'F' then 'failed' when 'P' then 'empty' else 'ok' end as class
    from {orders}"""


def _classified(spark, d):
    return spark.sql(_CLASSIFIED, orders=table(spark, d, "orders"))


@bind("dead_letters", "A13", """
    select cast(o_custkey as varchar) as ticker, date '2024-01-01' as date
    from orders where o_orderstatus = 'F'""")
def _(spark, d):
    path = scratch_path(spark, "dead")
    letters = payloads.dead_letters(_classified(spark, d), F.lit("2024-01-01").cast("date"))
    letters.write.mode("append").parquet(path)
    return spark.read.parquet(path)


@bind("ingest_report", "A14", """
    select o_orderpriority as batch, count(*) filter (o_orderstatus = 'O') as processed,
      count(*) filter (o_orderstatus = 'P') as empty_responses,
      count(*) filter (o_orderstatus = 'F') as failed
    from orders group by rollup (o_orderpriority)""")
def _(spark, d):
    return payloads.ingest_report(_classified(spark, d))


@bind("clustered_write", "A15", "select ticker, date, adjClose from stock_prices")
def _(spark, d):
    path = scratch_path(spark, "clustered")
    prices = table(spark, d, "stock_prices").select("ticker", "date", "adjClose")
    tables.clustered_write(prices, path, "ticker", ["date"])
    return spark.read.parquet(path)


@bind("add_load_timestamp", "A16", """
    select n_nationkey, n_name, timestamp '2024-05-01 12:00:00' as _etl_loaded_at from nation""")
def _(spark, d):
    at = F.lit("2024-05-01 12:00:00").cast("timestamp_ntz")
    return tables.add_load_timestamp(table(spark, d, "nation"), at).drop("n_regionkey")


@bind("query_landed_file", "A17", """
    select c_mktsegment as segment, count(*) as n from customer where c_acctbal > 100.5
    group by c_mktsegment""")
def _(spark, d):
    path = _landed_csv(spark, table(spark, d, "customer"), "template")
    return csv.query_landed_file(
        spark,
        "select c_mktsegment as segment, count(*) as n from {landed} "
        "where cast(c_acctbal as double) > :floor group by c_mktsegment",
        {"landed": csv.read_csv_strings(spark, path)}, {"floor": 100.5},
    )
