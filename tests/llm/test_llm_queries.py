"""The registered queries on the smallest tables, and the pipeline stage by stage."""

from __future__ import annotations

import re
from collections import defaultdict

import duckdb
import pytest
from llm import brute
from oracle import compare, connect
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from quantloom.llm import secrets
from quantloom.llm.queries import ORACLE_SQL, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    connection = connect(SF_DIR)
    yield connection
    connection.close()


@pytest.fixture(scope="module")
def texts(con):
    return con.execute("select doc_id, text from documents order by doc_id").fetchall()


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_queries_equal_their_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SF_DIR), con, ORACLE_SQL[name]) is None


def test_every_operator_is_registered():
    queries = __spark_entry__.queries()
    assert [n for n in range(1, 14) if not any(q.startswith(f"op{n}_") for q in queries)] == [] and "pipeline" in queries
    assert set(ORACLE_SQL) <= set(__spark_entry__.oracle_sql())


def test_base_scores(spark, texts):
    rows = {r["doc_id"]: r for r in QUERIES["op1_lm_scoring"](spark, SF_DIR).collect()}
    for d, held, n, known, total, base in brute.base_scores(texts):
        r = rows[d]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held, n, known, total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
    unseen = [r for r in rows.values() if r["held_out"]]
    assert sum(r["score"] for r in unseen) > sum(r["base_score"] for r in unseen)


def test_near_duplicates(spark, texts):
    got = {r["doc_id"]: r["class_id"] for r in QUERIES["op7_minhash_dedup"](spark, SF_DIR).collect()}
    assert got == brute.near_classes(texts)


def test_passages(spark, texts):
    got = defaultdict(set)
    for r in QUERIES["op10_suffix_dedup"](spark, SF_DIR).collect():
        got[r["doc_id"]].update(range(r["first_word"], r["last_word"]))
    assert got == {d: c for (d, _), c in zip(texts, brute.covered(texts)) if c}


def test_neighbours(spark, con):
    got = {(r["query_id"], r["vec_id"]) for r in QUERIES["op8_vector_search"](spark, SF_DIR).collect()}
    want = con.execute("""
        select q.vec_id, e.vec_id from embeddings q join embeddings e on q.vec_id <> e.vec_id and q.vec_id % 50 = 0
        qualify row_number() over (partition by q.vec_id order by list_cosine_similarity(q.embedding::double[], e.embedding::double[]) desc, e.vec_id) <= 5""").fetchall()
    assert len(got & set(want)) >= 0.9 * len(want) and len(got) == len(want)


def test_licenses(spark, texts):
    phrases = [(re.compile(rf"(?:^|(?<= )){p}(?= |$)"), label) for p, label in (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))]
    rows = {r["doc_id"]: r for r in QUERIES["op9_license_scan"](spark, SF_DIR).collect()}
    for d, t in texts:
        joined = " ".join(brute.words(t))
        places = sorted((joined[: m.start()].count(" "), label) for p, label in phrases for m in p.finditer(joined))
        r = rows[d]
        assert (r["n_words"], r["n_base"], r["base_labels"]) == (len(brute.words(t)), len(places), ",".join(sorted({x for _, x in places})))
        assert set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1


ROWS = [
    (None, "null id und kein Ende der Worte hier", "de", None, None), (1, None, "en", "s", 0), (2, "", "en", "s", 0), (3, "***", "en", "s", 3), (4, "", None, None, None),
]


def test_pipeline_stages_one_by_one(spark, con):
    """Each stage against what it should keep of the stage before."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").withColumn("node", F.lit(1))
    extra = spark.createDataFrame([(*r, 1) for r in ROWS], docs.schema)
    docs = docs.unionByName(extra).unionByName(docs.limit(3))
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "near_dedup", "decontamination", "secrets", "packing"]
    known = stages["language_id"](spark, docs, SF_DIR)
    assert known.columns == list(corpus_pipeline.COLUMNS)
    kept = [tuple(r) for r in known.collect()]
    assert {r[0] for r in kept} >= {r[0] for r in con.execute("select doc_id from documents where length(text) > 200").fetchall()}
    assert not {1, 2, 3, 4} & {r[0] for r in kept if not r[1] or r[1] == "***"}

    single = [tuple(r) for r in stages["near_dedup"](spark, known, SF_DIR).collect()]
    by_id = {r[0]: r[1] for r in kept if r[0] is not None}
    classes = brute.near_classes(sorted(by_id.items()))
    assert sorted(r[0] for r in single if r[0] is not None) == sorted({c for d, c in classes.items() if brute.words(by_id[d])})
    assert len({r[0] for r in single}) == len(single)

    frame = spark.createDataFrame(single, known.schema)
    clean = [tuple(r) for r in stages["decontamination"](spark, frame, SF_DIR).collect()]
    items = con.execute("select item_id, text from benchmark").fetchall()
    dirty = {d for d, _, hit, *_ in brute.contamination([r[:2] for r in single], items) if hit}
    assert sorted((r[0] for r in clean), key=str) == sorted((r[0] for r in single if r[0] not in dirty), key=str)

    frame = spark.createDataFrame([*clean, (9001, "say password=hunter22 now", "en", "s", 25)], known.schema)
    hidden = {r[0]: tuple(r) for r in stages["secrets"](spark, frame, SF_DIR).collect()}
    assert hidden[9001] == (9001, "say [secret] now", "en", "s", 16) and len(hidden) == len(clean) + 1
    for d, text_, *rest in clean:
        if not brute.base_spans(text_):
            assert hidden[d] == (d, text_, *rest)
    assert secrets.scan(spark.createDataFrame(list(hidden.values()), known.schema)).where("size(spans) > 0").count() == 0

    frame = spark.createDataFrame(list(hidden.values()), known.schema)
    packed = stages["packing"](spark, frame, SF_DIR)
    sums = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end")).collect()
    assert all(r["n"] == r["end"] <= 2048 for r in sums)
    assert {r["doc_id"] for r in packed.collect()} == set(hidden)


def test_pipeline_of_no_documents(spark, tmp_path):
    source = duckdb.connect()
    for name in ("documents", "benchmark"):
        source.execute(f"copy (select * from '{SF_DIR}/{name}.parquet' limit 0) to '{tmp_path}/{name}.parquet' (format parquet)")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
