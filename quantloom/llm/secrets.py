"""Secret scans over an incremental ledger of content-addressed blobs.

Every text is a version of a path.  Versions are addressed by the SHA-256 of
their content, and the ledger keeps which (blob, rule, rule version) has been
scanned and what was found.  A scan reads only pairs that the ledger lacks,
whatever the number of paths that hold a blob, and joins the findings back to
all paths.  Everything here is DataFrame functions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from quantloom.llm.store import written
from quantloom.session import scratch_path


@dataclass(frozen=True)
class Rule:
    """``group`` is the part whose length must reach ``least``; ``gate`` a literal without which no match exists.

    ``shape`` must be found in a match, else it is dropped.  Patterns take whole
    runs of characters, so that none of them reads a run more than once.
    """

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 0
    gate: str = ""
    shape: str = ""

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


#: The kinds in their order, base kinds first.
RULES = (
    Rule("assign", 1, r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 20, "AKIA"),
    Rule("hex", 1, r"[0-9a-f]{24,}", 0, 24),
    Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0, "PRIVATE KEY-----"),
    Rule("forge", 1, r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 0, "gh"),
    Rule("jwt", 2, r"eyJ[A-Za-z0-9_.-]*[A-Za-z0-9_-]", 0, 0, "eyJ", r"(^|\.)eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
BASE_KINDS = 3

FINDINGS = "blob string, rule string, start int, end int"
SCANS = "blob string, rules array<string>"


def blob_of(text: str) -> Column:
    return F.sha2(F.coalesce(F.col(text), F.lit("")), 256)


def _by_rule(rules: tuple[Rule, ...], value) -> Column:
    """``value(rule)`` for the rule that the row's ``hit`` belongs to."""
    out = F.when(F.col("hit.rule") == rules[0].key, value(rules[0]))
    for rule in rules[1:]:
        out = out.when(F.col("hit.rule") == rule.key, value(rule))
    return out


def find(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, rule, start, end) of the rules pending for each blob; offsets in code points, end exclusive.

    Matches of one rule are leftmost and do not overlap; those too short for
    the rule, or without its shape, are dropped afterwards.  A match starts behind all pieces and
    matches before it, so offsets are running sums of lengths.
    """
    def matches(rule: Rule) -> Column:
        wanted = F.array_contains("pending", rule.key)
        if rule.gate:
            wanted = wanted & F.contains(F.col("text"), F.lit(rule.gate))
        return F.struct(F.lit(rule.key).alias("rule"), F.when(wanted, F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(0))).alias("found"))

    some = F.filter(F.array(*map(matches, rules)), lambda m: F.size(F.coalesce(m["found"], F.array().cast("array<string>"))) > 0)
    hits = blobs.select("blob", "text", F.explode(some).alias("hit"))
    pieces = _by_rule(rules, lambda rule: F.split("text", rule.pattern, -1))
    gaps = F.transform(pieces, lambda p: F.char_length(p))
    placed = hits.select("blob", "hit", F.arrays_zip(F.slice(gaps, 1, F.size("hit.found")).alias("gap"), F.col("hit.found").alias("found")).alias("each"))
    rows = placed.select("blob", "hit.rule", F.posexplode("each").alias("nth", "one")).select("blob", "rule", "nth", "one.gap", F.col("one.found").alias("match"))
    order = W.partitionBy("blob", "rule").orderBy("nth")
    end = F.sum(F.col("gap") + F.char_length("match")).over(order.rowsBetween(W.unboundedPreceding, 0))
    spans = rows.withColumn("end", end.cast("int")).withColumn("start", F.col("end") - F.char_length("match"))
    kept = F.lit(False)
    for rule in rules:
        part = F.regexp_extract("match", rule.pattern, rule.group) if rule.group else F.col("match")
        fits = F.char_length(part) >= rule.least
        if rule.shape:
            fits = fits & F.col("match").rlike(rule.shape)
        kept = F.when(F.col("rule") == rule.key, fits).otherwise(kept)
    return spans.where(kept).select("blob", "rule", "start", "end")


def update_ledger(spark: SparkSession, versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, text: str = "text") -> None:
    """Scans the (blob, rule version) pairs that the ledger lacks and adds them to it.

    Findings are written before the scan marks: a run that dies in between is
    repeated, and repeated findings collapse when they are read.
    """
    keys = F.array(*(F.lit(r.key) for r in rules))
    blobs = versions.select(blob_of(text).alias("blob"), F.coalesce(F.col(text), F.lit("")).alias("text")).groupBy("blob").agg(F.first("text").alias("text"))
    marks = versions.select(blob_of(text).alias("blob")).distinct()
    if _exists(spark, f"{ledger}/scans"):
        seen = spark.read.schema(SCANS).parquet(f"{ledger}/scans").groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("seen"))
        pending = lambda df: df.join(seen, "blob", "left").withColumn("pending", F.array_except(keys, F.coalesce("seen", F.array().cast("array<string>")))).where(F.size("pending") > 0).drop("seen")
        marks = written(pending(marks), "pending")
        blobs = blobs.join(marks, "blob")
    else:
        marks, blobs = marks.withColumn("pending", keys), blobs.withColumn("pending", keys)
    find(blobs, rules).write.mode("append").parquet(f"{ledger}/findings")
    marks.select("blob", F.col("pending").alias("rules")).write.mode("append").parquet(f"{ledger}/scans")


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def findings(spark: SparkSession, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, spans) for the current rule versions; spans are (start, kind number, end) in order."""
    number = F.lit(None).cast("int")
    for i, rule in enumerate(rules):
        number = F.when(F.col("rule") == rule.key, F.lit(i)).otherwise(number)
    found = spark.read.schema(FINDINGS).parquet(f"{ledger}/findings").withColumn("kind", number).where(F.col("kind").isNotNull()).distinct()
    return found.groupBy("blob").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("spans"))


def scan(docs: DataFrame, ledger: str | None = None, rules: tuple[Rule, ...] = RULES, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns of every row with ``blob`` and ``spans``.

    A null text counts as empty.  Rows without findings get an empty list,
    repeated rows repeated results.  Without ``ledger`` a new one is begun in
    the shared folder.
    """
    spark = docs.sparkSession
    ledger = ledger or scratch_path(spark, "ledger")
    update_ledger(spark, docs, ledger, rules, text)
    paths = docs.select(F.struct(*(F.col(c) for c in keep)).alias("_kept"), blob_of(text).alias("blob"))
    found = paths.join(findings(spark, ledger, rules), "blob", "left")
    return found.select("_kept.*", "blob", F.coalesce("spans", F.array().cast("array<struct<start:int,kind:int,end:int>>")).alias("spans"))


def joined_spans(spans: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    names = F.array(*(F.lit(r.kind) for r in rules))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def redact(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with every span, overlapping ones together, replaced by ``mark``."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(acc: Column, s: Column) -> Column:
        fresh = F.concat(acc["parts"], F.array(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark)))
        return F.when(s["end"] <= acc["at"], acc).otherwise(F.struct(
            s["end"].alias("at"), F.when(s["start"] >= acc["at"], fresh).otherwise(acc["parts"]).alias("parts"),
        ))

    return F.aggregate(spans, start, step, lambda acc: F.concat(F.array_join(acc["parts"], ""), F.substring(text, acc["at"] + 1, F.char_length(text))))


#: The same for DuckDB.
ORACLE = r"""
with rules(kind, k, pattern, part, least) as (values
    ('assign', 0, '(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2, 6),
    ('access', 1, 'AKIA[A-Z0-9]+', 0, 20),
    ('hex', 2, '[0-9a-f]+', 0, 24),
    ('pem', 3, '-----BEGIN [A-Z ]*PRIVATE KEY-----', 0, 0),
    ('forge', 4, 'gh[pousr]_[A-Za-z0-9]{36,}', 0, 0),
    ('jwt', 5, 'eyJ[A-Za-z0-9_.-]*[A-Za-z0-9_-]', 0, 0)),
texts as (select row_number() over () as rid, doc_id, coalesce("text", '') as t from documents),
cut as (
    select rid, kind, k, least, part, regexp_extract_all(t, pattern) as found, string_split_regex(t, pattern) as pieces,
        case when part = 2 then regexp_extract_all(t, pattern, 2) else regexp_extract_all(t, pattern) end as parts
    from texts, rules),
each_match as (
    select rid, kind, k, least, unnest(range(1, len(found) + 1)) as i, found, pieces, parts from cut where len(found) > 0),
spans as (
    select rid, kind, k,
        list_sum(list_transform(pieces[1:i], lambda x: length(x)))::bigint + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0)::bigint as s,
        length(found[i]) as n
    from each_match where length(parts[i]) >= least
        and (kind <> 'jwt' or regexp_matches(found[i], '(^|\.)eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}'))),
named as (select rid, k, kind, s, concat(kind, ':', s, ':', s + n) as span from spans),
per_row as (
    select rid, count(*) filter (where k = 0) as n_assign, count(*) filter (where k = 1) as n_access, count(*) filter (where k = 2) as n_hex,
        coalesce(string_agg(span, ',' order by s, k) filter (where k < 3), '') as base, string_agg(span, ',' order by s, k) as spans
    from named group by rid)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
    sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from texts left join per_row using (rid)
"""
