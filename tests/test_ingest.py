from __future__ import annotations

import datetime as dt
import io
import zipfile
from decimal import Decimal
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from quantloom import schemas
from quantloom.operators.setops import union_checked
from quantloom.plans import refresh
from quantloom.sources import archive, csv, payloads, tables
from quantloom.streaming import landing

HISTORY = "date,close,adjClose,adjVolume\n2018-05-05,12.75,6.375,410\n2017-03-01,9.5,4.75,275\n"


def test_typed_csv_reads_and_rejects(spark, scratch):
    good = scratch.put("good.csv", 'id,name\n1,"Smith, ""John"""\n2,Bob\n')
    assert rows(csv.read_csv_typed(spark, good, "id int, name string")) == [
        (1, 'Smith, "John"'), (2, "Bob"),
    ]
    for name, text in {
        "ragged.csv": "id,name\n1,Alice\n2,Bob,extra\n",
        "header.csv": "id,email\n1,a@example.com\n",
        "value.csv": "id,name\nx,Alice\n",
    }.items():
        path = scratch.put(name, text)
        with pytest.raises(Exception):
            csv.read_csv_typed(spark, path, "id int, name string").collect()


def test_columns_bind_by_name_in_any_order(spark, scratch):
    scratch.put("a.csv", "date,value,ticker\n2024-01-01,1,A\n")
    scratch.put("b.csv", "ticker,date,value\nB,2024-01-02,2\n")
    ddl = "ticker string, date date, value int"
    got = csv.read_csv_by_name(spark, scratch.path, ddl, mixed=True)
    assert rows(got) == [("A", dt.date(2024, 1, 1), 1), ("B", dt.date(2024, 1, 2), 2)]
    with pytest.raises(Exception):
        csv.read_csv_by_name(spark, scratch.path, ddl).collect()


def test_cast_drops_extra_columns_and_fails_on_missing(spark):
    df = spark.createDataFrame([("1", "2024-11-02 01:01:16", "x")], "id string, day string, extra string")
    assert rows(csv.cast_to(df, "day date, id int")) == [(dt.date(2024, 11, 2), 1)]
    with pytest.raises(ValueError, match="missing"):
        csv.cast_to(df, "other int")
    bad = spark.createDataFrame([("",)], "day string")
    assert rows(csv.cast_to(bad, "day date", strict=False)) == [(None,)]
    with pytest.raises(Exception):
        csv.cast_to(bad, "day date").collect()


def test_union_checks_layout(spark):
    a = spark.createDataFrame([(1, "Alice")], "id int, name string")
    b = spark.createDataFrame([(2, "Bob")], "id int, name string")
    assert rows(union_checked([a])) == [(1, "Alice")]
    assert rows(union_checked([a, None, b])) == [(1, "Alice"), (2, "Bob")]
    with pytest.raises(ValueError, match="column 2 is 'email', not 'name'"):
        union_checked([a, b.withColumnRenamed("name", "email")])
    with pytest.raises(ValueError, match="part 2 has 3 columns, not 2"):
        union_checked([a, b.withColumn("email", F.lit("x"))])
    with pytest.raises(ValueError, match="nothing to join"):
        union_checked([])


def test_dedupe_rows(spark):
    df = spark.createDataFrame(
        [("2023-03-31", "Smith, John"), ("2023-03-31", "Smith, John"), ("2023-03-31", "Smith,  John"),
         ("2023-06-30", None), ("2023-06-30", None)], "date string, name string",
    )
    assert rows(csv.dedupe_rows(df, [F.length("name")])) == [
        ("2023-03-31", "Smith, John"), ("2023-06-30", None),
    ]
    assert csv.dedupe_rows(df.limit(0)).count() == 0


def _zip(**files: str) -> bytes:
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        for name, text in files.items():
            z.writestr(f"{name}.csv", text)
    return buffer.getvalue()


def test_archives_hold_exactly_one_csv(spark, scratch):
    scratch.put("ok.zip", _zip(a='id,name\n1,"Alice, A"\n2,"two\nlines"\n'))
    scratch.put("none.zip", _zip())
    scratch.put("two.zip", _zip(a="id,name\n3,C\n", b="id,name\n4,D\n"))
    scratch.put("bad.zip", b"not a zip")
    scratch.put("header.zip", _zip(a="name,id\nE,5\n"))
    good, rejects = archive.read_zipped_csv(spark, scratch.path, "id int, name string")
    assert rows(good) == [(1, "Alice, A"), (2, "two\nlines")]
    found = {r["path"].rsplit("/", 1)[1]: r["problem"] for r in rejects.collect()}
    assert found == {
        "none.zip": "the archive holds 0 files instead of 1",
        "two.zip": "the archive holds 2 files instead of 1",
        "bad.zip": "not a zip archive", "header.zip": "unexpected header",
    }


def test_small_archives_share_a_chunk():
    import pandas as pd

    batches = [pd.DataFrame([(f"{k}-{i}", _zip(a=f"id,name\n{i},x\n")) for i in range(300)], columns=["path", "content"]) for k in range(2)]
    chunks = list(archive._unzip(["id", "name"])(iter(batches)))
    assert [len(c) for c in chunks] == [600]  # not one frame an archive
    assert list(chunks[0]["path"])[299:301] == ["0-299", "1-0"] and list(chunks[0]["fields"])[5] == ["5", "x"]
    long = pd.DataFrame([("p", _zip(a="id,name\n" + "1,x\n" * 25_000))], columns=["path", "content"])
    assert [len(c) for c in archive._unzip(["id", "name"])(iter([long]))] == [10_000, 10_000, 5_000]


def test_a_value_that_its_column_cannot_hold_is_a_reject(spark, scratch):
    scratch.put("a.zip", _zip(a="id,day\n1,2024-01-01\nx,2024-01-02\n3,\n4,soon\n5,2024-01-05T00:00:00\n6\n"))
    good, rejects = archive.read_zipped_csv(spark, scratch.path, "id int, day date")
    assert rows(good.selectExpr("id", "cast(day as string)")) == [(1, "2024-01-01"), (3, None), (5, "2024-01-05")]
    assert rows(rejects, "row", "problem") == [(2, "id is no int"), (4, "day is no date"), (6, "wrong number of fields")]


def test_payload_classes_and_report(spark, scratch):
    scratch.put("QLM_2011-02-03.csv", HISTORY)
    scratch.put("nodata.csv", "None")
    scratch.put("ERR.csv", "None%")
    scratch.put("LIST.csv", "[]")
    scratch.put("BLANK.csv", "")
    scratch.put("HEAD.csv", "date,close\n")
    found = payloads.classify_payloads(spark, scratch.path)
    assert rows(found, "ticker", "class") == [
        ("BLANK", "failed"), ("ERR", "failed"), ("HEAD", "failed"), ("LIST", "failed"),
        ("NODATA", "empty"), ("QLM", "ok"),
    ]
    day = F.lit("2024-01-01").cast("date")
    assert payloads.dead_letters(found, day).count() == 4
    report = payloads.ingest_report(found.withColumn("batch", F.lit(0)))
    assert rows(report) == [(0, 1, 1, 4), (None, 1, 1, 4)]


def _daily(base: str) -> str:
    return (
        "date,marketCap,enterpriseVal,peRatio,pbRatio,trailingPEG1Y\n"
        f"2019-07-01,{base},{base},11.0,2.25,0.8\n2019-07-02,{base},{base},11.5,2.5,0.9\n"
    )


DAILY_FILE = schemas.FUNDAMENTALS_DAILY_DDL.rsplit(",", 1)[0]


def test_load_fundamentals_skips_empty_and_is_idempotent(spark, scratch):
    scratch.put("qlm.csv", _daily("125000.0"))
    scratch.put("SPLT.csv", _daily("64000.0"))
    scratch.put("SILENT.csv", "None")
    table = spark.createDataFrame([], schemas.FUNDAMENTALS_DAILY_DDL)
    once, seen = refresh.load_fundamentals(
        spark, scratch.path, table, schemas.FUNDAMENTALS_DAILY_KEY, DAILY_FILE,
    )
    assert rows(once.select("ticker").distinct()) == [("QLM",), ("SPLT",)]
    assert once.count() == 4
    assert rows(payloads.ingest_report(seen.withColumn("batch", F.lit(1))).where("batch = 1")) == [(1, 2, 1, 0)]
    again, _ = refresh.load_fundamentals(
        spark, scratch.path, once, schemas.FUNDAMENTALS_DAILY_KEY, DAILY_FILE,
    )
    assert rows(again) == rows(once)


def test_files_without_a_line_fail_once(spark, scratch):
    """Files of no bytes or of blank lines are in the report, and every file once."""
    scratch.put("A B+C.csv", _daily("125000.0"))
    scratch.put("BLANK.csv", "\n\n")
    scratch.put("NOTHING.csv", "")
    table = spark.createDataFrame([], schemas.FUNDAMENTALS_DAILY_DDL)
    loaded, seen = refresh.load_fundamentals(spark, scratch.path, table, schemas.FUNDAMENTALS_DAILY_KEY, DAILY_FILE)
    assert rows(seen.where("class = 'failed'"), "ticker", "n_lines") == [("BLANK", 0), ("NOTHING", 0)]
    assert rows(seen.where("class = 'ok'"), "n_lines") == [(3,)] and seen.count() == 3 and loaded.count() == 2


def test_all_payloads_empty(spark, scratch):
    scratch.put("SILENT.csv", "None")
    scratch.put("MUTE.csv", "None")
    table = spark.createDataFrame([], schemas.FUNDAMENTALS_DAILY_DDL)
    loaded, seen = refresh.load_fundamentals(
        spark, scratch.path, table, schemas.FUNDAMENTALS_DAILY_KEY, DAILY_FILE,
    )
    assert loaded.count() == 0 and seen.where("class = 'ok'").count() == 0


META = """permaTicker,ticker,name,isActive,isADR,sector,industry,sicCode,sicSector,sicIndustry,reportingCurrency,location,companyWebsite,secFilingWebsite,statementLastUpdated,dailyLastUpdated,surplus
P7,qlm,Quill Loom,True,False,Materials,Textiles,2200,Mills,Weaving,usd,"Lowell, USA",web,filing,2019-06-30 08:15:00,2019-07-02 21:00:01,x
P8,vlt,Vault Lines,True,False,Utilities,Power,4911,Grid,Lines,usd,"Reno, USA",web,filing,2019-05-31 10:00:00,2019-07-02 21:00:02,y
P9,zzq,Zig Zag,False,True,Energy,Wind,4900,Grid,Farms,dkk,"Aarhus, Denmark",web,filing,2019-04-30 12:30:00,,z
"""


def test_update_metadata(spark, scratch):
    path = scratch.put("meta.csv", META)
    old = spark.createDataFrame([], schemas.FUNDAMENTALS_META_DDL)
    merged, applied = refresh.update_metadata(spark, path, old)
    assert applied.count() == 3
    quill = merged.where("ticker = 'qlm'").first()
    assert quill["location"] == "Lowell, USA" and quill["isActive"] is True
    assert quill["statementLastUpdated"] == dt.date(2019, 6, 30)
    assert merged.where("dailyLastUpdated is null").count() == 1
    again, _ = refresh.update_metadata(spark, path, merged)
    assert rows(again) == rows(merged)


def test_constraint_upsert_and_refresh(spark, scratch):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    new = spark.createDataFrame([(2, "x"), (2, "y"), (3, "c")], "id int, v string")
    assert rows(tables.upsert(old, new, ["id"], [F.col("v").desc()])) == [(1, "a"), (2, "y"), (3, "c")]
    with pytest.raises(ValueError, match="duplicate key"):
        tables.assert_unique(new, ["id"])
    assert tables.assert_unique(old, ["id"]) is old
    target = f"{scratch.path}/t"
    tables.full_refresh(old, target)
    tables.full_refresh(new, target, "v string, id bigint")
    assert rows(spark.read.parquet(target)) == [("c", 3), ("x", 2), ("y", 2)]


def test_partition_upsert_leaves_other_partitions(spark, scratch):
    path = f"{scratch.path}/p"
    old = spark.createDataFrame([(1, 2020, 1.0), (2, 2020, 2.0), (3, 2021, 3.0)], "id int, year int, v double")
    old.write.partitionBy("year").parquet(path)
    kept = sorted(f.name for f in __import__("pathlib").Path(path, "year=2021").glob("*.parquet"))
    new = spark.createDataFrame([(2, 2020, 9.0), (4, 2022, 4.0)], "id int, year int, v double")
    tables.upsert_partitions(spark, path, new, ["id", "year"], "year")
    assert rows(spark.read.parquet(path), "id", "v") == [(1, 1.0), (2, 9.0), (3, 3.0), (4, 4.0)]
    assert sorted(f.name for f in __import__("pathlib").Path(path, "year=2021").glob("*.parquet")) == kept


def test_query_parameters_must_be_given(spark):
    df = spark.createDataFrame([(1,), (5,)], "id int")
    sql = "select id from {t} where id > :low"
    assert rows(csv.query_landed_file(spark, sql, {"t": df}, {"low": 2})) == [(5,)]
    with pytest.raises(Exception):
        csv.query_landed_file(spark, sql, {"t": df}).collect()


def test_key_columns(spark):
    df = spark.createDataFrame([(1,)], "id int")
    assert csv.with_key_column(df, "QLM").columns == ["id", "ticker"]
    paths = spark.createDataFrame([("file:/x_1/qlm_2011-02-03.csv",), ("SPLT.csv",), ("a/DVD.B_2003-03-31.csv.gz",), ("x.y/brk_a.csv",)], "p string")
    assert rows(paths.select(csv.key_from_file("p"))) == [("BRK_A",), ("DVD.B",), ("QLM",), ("SPLT",)]


def test_resting_decimals_round_to_three_places(spark, scratch):
    path = scratch.put("s.csv", "date,year,quarter,statementType,dataCode,value,ticker\n2019-03-30,2019,1,overview,roa,0.270226599,QLM\n")
    got = csv.read_csv_typed(spark, path, schemas.FUNDAMENTALS_STATEMENTS_DDL).first()
    assert got["value"] == Decimal("0.270")


SNAPSHOT = """ticker,date,close,high,low,open,volume,adjClose,adjHigh,adjLow,adjOpen,adjVolume,divCash,splitFactor
qlm,2019-07-03,41.25,42,40,41,900,41.25,42,40,41,900,0.0,1.0
splt,2019-07-03,7.5,8,7,7.25,300,7.5,8,7,7.25,300,0.0,0.5
DVD.B,2019-07-03,88.0,89,87,88.5,50,88.0,89,87,88.5,50,0.35,1.0
FRGN,2019-07-03,3.0,3,3,3,10,3.0,3,3,3,10,0.0,1.0
"""
UNIVERSE = """ticker,exchange,assetType,priceCurrency,startDate,endDate
qlm,NYSE,Stock,USD,2011-02-03,2019-07-03
SPLT,NASDAQ,Stock,USD,2015-09-17,2019-07-03
DVD.B,AMEX,Stock,USD,2003-03-31,2019-07-03
FRGN,LSE,Stock,GBP,2001-12-12,2019-07-03
"""


def _price_table(spark, path):
    tables_ = spark.createDataFrame([], schemas.DAILY_ADJUSTED_DDL)
    landing.create_table(tables_.unionByName(spark.createDataFrame(
        [(dt.date(2019, 7, 2), Decimal("40.000"), Decimal("40.000"), 800, "QLM")], schemas.DAILY_ADJUSTED_DDL,
    )), path)
    return path


def test_daily_job_from_files(spark, scratch):
    scratch.put("zip/supported.zip", _zip(supported=UNIVERSE))
    scratch.put("snapshot.csv", SNAPSHOT)
    scratch.put("history/SPLT_2015-09-17.csv", HISTORY)
    scratch.put("history/DVD.B.csv", "date,close,adjClose,adjVolume\n2018-05-05,1.0,1.0\n")
    scratch.put("history/QLM.csv", HISTORY)
    table = _price_table(spark, f"{scratch.path}/prices")
    files = lambda: {p.name for p in Path(table).rglob("*.parquet")}
    args = (f"{scratch.path}/zip", f"{scratch.path}/snapshot.csv", f"{scratch.path}/history", table, scratch.path)
    report = refresh.run_daily(spark, *args)
    expected = [
        ("DVD.B", "2019-07-03"), ("QLM", "2019-07-02"), ("QLM", "2019-07-03"), ("SPLT", "2017-03-01"), ("SPLT", "2018-05-05"), ("SPLT", "2019-07-03"),
    ]
    assert rows(landing.read_table(spark, table), "ticker", F.col("date").cast("string")) == expected
    assert report.n_restated == 1 and rows(report.failed) == [("DVD.B",)]  # its history is ragged
    assert spark.read.parquet(f"{scratch.path}/last_trading_day").count() == 4
    before = files()
    spark.read.parquet(table)
    assert refresh.run_daily(spark, *args).n_restated == 1
    assert rows(landing.read_table(spark, table), "ticker", F.col("date").cast("string")) == expected
    assert before != files()
    scratch.put("zip/second.zip", _zip())
    with pytest.raises(ValueError, match="holds 0 files"):
        refresh.run_daily(spark, *args)


def test_restating_a_key_keeps_the_files_of_other_slices(spark, scratch):
    path = f"{scratch.path}/t"
    many = spark.range(200).select(
        F.expr("date_add(date '2018-01-01', cast(id * 5 as int))").alias("date"), F.lit(1.0).cast("decimal(18,3)").alias("close"),
        F.lit(1.0).cast("decimal(18,3)").alias("adjClose"), F.lit(1).cast("bigint").alias("adjVolume"), F.concat(F.lit("K"), F.col("id") % 40).alias("ticker"),
    )
    landing.create_table(many, path)
    files = lambda: {(p.parent.name, p.name) for p in Path(path).rglob("*.parquet")}
    before = files()
    one = landing.with_partition(many.where("ticker = 'K7'").withColumn("close", F.lit(2.0).cast("decimal(18,3)")))
    slices = {r[0] for r in one.select(landing.PARTITION).distinct().collect()}
    tables.upsert_partitions(spark, path, one, schemas.DAILY_ADJUSTED_KEY, landing.PARTITION)
    assert {f for f in before if f[0].split("=")[1] not in slices} <= files()
    assert landing.read_table(spark, path).where("close = 2").count() == 5 and landing.read_table(spark, path).count() == 200


def test_upsert_into_a_null_partition_loses_nothing(spark, scratch):
    path = f"{scratch.path}/n"
    spark.createDataFrame([(1, None, 1.0), (2, None, 2.0), (3, 2021, 3.0)], "id int, year int, v double").write.partitionBy("year").parquet(path)
    new = spark.createDataFrame([(1, None, 9.0)], "id int, year int, v double")
    tables.upsert_partitions(spark, path, new, ["id"], "year")
    assert rows(spark.read.parquet(path), "id", "v") == [(1, 9.0), (2, 2.0), (3, 3.0)]
    other = spark.createDataFrame([(3, 2021, 4.0)], "id int, year int, v double")
    tables.upsert_partitions(spark, path, other, ["id"], "year")
    assert rows(spark.read.parquet(path), "id", "v") == [(1, 9.0), (2, 2.0), (3, 4.0)]


def test_landing_reports_every_file_by_itself(spark, scratch):
    head = "date,close,adjClose,adjVolume\n"
    scratch.put("GOOD.csv", HISTORY)
    scratch.put("TURNED.csv", "adjVolume,close,date,adjClose\n5,1.5,2018-05-05,1.25\n")
    scratch.put("RAGGED.csv", HISTORY + "2018-05-06,1.0\n")
    scratch.put("VALUE.csv", head + "2018-05-06,high,1.0,1\n")
    scratch.put("OTHER.csv", "date,price\n2018-05-06,1.0\n")
    scratch.put("EMPTY.csv", "None")
    scratch.put("BRK.A_2001-01-01.csv", head + "2018-05-05,2.0,2.0,2\n")
    scratch.put("brk_a.csv", head + "2018-05-05,3.0,3.0,3\n")
    scratch.put("ZERO.csv", "")
    data, seen = refresh.read_landed(spark, scratch.path, schemas.PRICE_HISTORY_DDL)
    want = {"GOOD": "ok", "TURNED": "ok", "BRK.A": "ok", "BRK_A": "ok", "EMPTY": "empty", "RAGGED": "failed", "VALUE": "failed", "OTHER": "failed", "ZERO": "failed"}
    assert dict(rows(seen, "ticker", "class")) == want
    assert rows(data.where("ticker not in ('GOOD')"), "ticker", F.col("close").cast("double"), F.col("adjVolume").cast("int")) == [("BRK.A", 2.0, 2), ("BRK_A", 3.0, 3), ("TURNED", 1.5, 5)]
    wanted = spark.createDataFrame([("good",), ("ABSENT",)], "ticker string")
    data, seen = refresh.read_landed(spark, scratch.path, schemas.PRICE_HISTORY_DDL, wanted)
    assert dict(rows(seen, "ticker", "class")) == {"GOOD": "ok", "ABSENT": "failed"} and data.count() == 2


def test_fundamentals_job_reports_batches(spark, scratch):
    scratch.put("in/QLM.csv", _daily("1.0"))
    scratch.put("in/SPLT.csv", _daily("2.0"))
    scratch.put("in/SILENT.csv", "None")
    path = f"{scratch.path}/ratios"
    landing.create_table(spark.createDataFrame([], schemas.FUNDAMENTALS_DAILY_DDL), path)
    wanted = spark.createDataFrame([("QLM", 0), ("SILENT", 0), ("SPLT", 1), ("NOFILE", 1)], "ticker string, batch bigint")
    job = lambda: refresh.run_fundamentals(spark, f"{scratch.path}/in", path, schemas.FUNDAMENTALS_DAILY_KEY, DAILY_FILE, wanted=wanted)
    assert rows(job()) == [(0, 1, 1, 0), (1, 1, 0, 1), (None, 2, 1, 1)]
    assert landing.read_table(spark, path).count() == 4
    job()
    assert landing.read_table(spark, path).count() == 4


def test_fundamentals_job_selects_its_keys(spark, scratch):
    scratch.put("in/QLM.csv", _daily("1.0"))
    scratch.put("in/NEWCO.csv", _daily("2.0"))
    path = f"{scratch.path}/ratios"
    landing.create_table(spark.createDataFrame([], schemas.FUNDAMENTALS_DAILY_DDL), path)
    meta, _ = refresh.update_metadata(spark, scratch.put("meta.csv", META), spark.createDataFrame([], schemas.FUNDAMENTALS_META_DDL))
    universe = spark.createDataFrame([("QLM",), ("VLT",)], "ticker string")
    job = lambda **selection: refresh.update_fundamentals(spark, meta, universe, f"{scratch.path}/in", path, schemas.FUNDAMENTALS_DAILY_KEY, DAILY_FILE, **selection)
    assert rows(job(batch_size=1)) == [(0, 1, 0, 0), (1, 0, 0, 1), (None, 1, 0, 1)]
    assert rows(job(tickers=["newco"])) == [(0, 1, 0, 0), (None, 1, 0, 0)]
    assert rows(landing.read_table(spark, path).select("ticker").distinct()) == [("NEWCO",), ("QLM",)]


def test_clustered_and_bucketed_layouts(spark, scratch):
    df = spark.range(1000).select((F.col("id") % 7).cast("string").alias("k"), F.col("id").alias("t"))
    path = f"{scratch.path}/c"
    tables.clustered_write(df, path, "k", ["t"], partitions=5)
    assert rows(spark.read.parquet(path)) == rows(df)
    assert len(list(__import__("pathlib").Path(path).glob("*.parquet"))) == 5
    tables.bucketed_table(df, "bucketed_left", "k", ["t"], 4)
    tables.bucketed_table(df, "bucketed_right", "k", ["t"], 4)
    joined = spark.table("bucketed_left").hint("merge").join(spark.table("bucketed_right"), "k")
    assert "Exchange hashpartitioning" not in joined._jdf.queryExecution().executedPlan().toString()


def test_lines_are_bound_without_a_shuffle(spark, scratch):
    """Lines meet only the files that differ from most, whatever their number; those still go by their own header."""
    for k in range(5):
        scratch.put(f"t{k}.csv", f"date,x\n2020-01-0{k + 1},{k}.5\n")
    scratch.put("other.csv", "x,date\n7.5,2020-01-07\n")
    scratch.put("bad.csv", "date,x\n2020-01-08,nine\n")
    scratch.put("headless.csv", "2020-01-09,1.0\n2020-01-09,2.0\n")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with very many files
    try:
        typed, files = csv.bound_files(csv.read_cells(spark, scratch.path, ["date", "x"]), "date date, x double")
        plan = typed._jdf.queryExecution().executedPlan().toString()
        got = sorted(r["x"] for r in typed.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan, plan
    assert got == [0.5, 1.5, 2.5, 3.5, 4.5, 7.5]
    assert sorted(r["class"] for r in files.collect()) == ["failed"] * 2 + ["ok"] * 6
