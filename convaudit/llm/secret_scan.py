"""Secret scans (operator 6): an incremental ledger of blobs.

Built-in functions only. Every version of a text is a blob named by its SHA-256.
A ledger row names a blob, the (rule, version) pairs it was scanned under and the
matches found. A run scans a blob only under the pairs that the ledger lacks for
it, appends those rows, and joins findings back to every path that has the blob:
copies are scanned once, an unchanged corpus not at all, and a new version of a
rule rescans that rule alone.

A span's place comes from the strings between matches: splitting a text at a
pattern and extracting the pattern's matches give strings that alternate, so a
running sum of their lengths in code points gives every start. The sum is a
window over one blob and rule, in rows of two small numbers, and only blobs with
a match get there.

Null and empty texts are the blob of the empty text and have no finding. Repeated
rows stay repeated. Only the named columns are read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


@dataclass(frozen=True)
class Rule:
    """``group`` of a match must have ``least`` characters and the match ``whole``; a text without any of
    ``needs`` has no match.

    A pattern must be linear: where it reads an endless run it has to match and use up the run, whether or not the
    match then passes, or else bound it. One that fails at the end of a run is tried again from every place in it.
    """

    name: str
    pattern: str
    least: int
    needs: tuple[str, ...] = ()
    group: int = 0
    version: int = 1
    whole: int = 1


# The kinds asked for, in their listed order, then those that the method adds.
RULES = [
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, (":", "="), 2),
    Rule("access", r"AKIA[A-Z0-9]+", 20, ("AKIA",)),
    Rule("hex", r"[0-9a-f]{24,}", 24),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 1, ("PRIVATE KEY-----",)),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 40, ("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    # also matches, and so uses up, a run that lacks the two dots: group 1, the third part, is then empty
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+(?:\.[A-Za-z0-9_-]+(\.[A-Za-z0-9_-]+)?)?", 2, ("eyJ",), 1, 2, 36),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 15, ("xox",)),
    # a span begins at most 16 letters before the colon
    Rule("url_login", r"[a-z]{1,16}://[^\x09-\x0D\x20/:@]+:[^\x09-\x0D\x20/:@]+@", 1, ("://",), version=2),
]
BASE = ("assign", "access", "hex")
MASK = "[secret]"

LEDGER = ("blob binary, scanned array<struct<rule:string,version:int>>, "
          "matches array<struct<rule:string,version:int,gap:int,size:int,ok:boolean>>")


def may_match(body: Column, rule: Rule) -> Column:
    if not rule.needs:
        return F.rlike(body, F.lit(rule.pattern))
    test = F.contains(body, F.lit(rule.needs[0]))
    for part in rule.needs[1:]:
        test = test | F.contains(body, F.lit(part))
    return test


def matches_of(body: Column, rule: Rule) -> Column:
    """Per match: the code points since the last one, its own, and whether it is long enough."""
    found = [F.split(body, rule.pattern).alias("gap"), F.regexp_extract_all(body, F.lit(rule.pattern), F.lit(0)).alias("match")]
    if rule.group:
        found.append(F.regexp_extract_all(body, F.lit(rule.pattern), F.lit(rule.group)).alias("part"))
    alternating = F.filter(F.arrays_zip(*found), lambda x: x.match.isNotNull())
    return F.transform(alternating, lambda x: F.struct(
        F.lit(rule.name).alias("rule"), F.lit(rule.version).alias("version"), F.char_length(x.gap).alias("gap"),
        F.char_length(x.match).alias("size"),
        ((F.char_length(x.part if rule.group else x.match) >= rule.least) & (F.char_length(x.match) >= rule.whole)).alias("ok")))


def pair_of(rule: Rule) -> Column:
    return F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.version).alias("version"))


def blob_of(text: str) -> Column:
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256))


def unseen(versions: DataFrame, ledger: DataFrame | None, rules: list[Rule], text: str) -> DataFrame:
    """``blob``, ``body`` and ``todo`` of the blobs that lack a rule; each blob once."""
    every = F.array(*[pair_of(r) for r in rules])
    blobs = (versions.select(blob_of(text).alias("blob"), F.coalesce(F.col(text), F.lit("")).alias("body"))
             .groupBy("blob").agg(F.first("body").alias("body")))
    if ledger is None:
        return blobs.withColumn("todo", every)
    seen = ledger.select("blob", F.explode("scanned").alias("pair")).groupBy("blob").agg(F.collect_set("pair").alias("seen"))
    todo = F.array_except(every, F.coalesce("seen", F.array().cast("array<struct<rule:string,version:int>>")))
    return blobs.join(seen, "blob", "left").withColumn("todo", todo).where(F.size("todo") > 0).select("blob", "body", "todo")


def scan(blobs: DataFrame, rules: list[Rule]) -> DataFrame:
    """Ledger rows of ``unseen`` blobs."""
    body, nothing = F.col("body"), F.array().cast("array<struct<rule:string,version:int,gap:int,size:int,ok:boolean>>")
    found = [F.when(F.array_contains("todo", pair_of(r)) & may_match(body, r), matches_of(body, r)).otherwise(nothing) for r in rules]
    return blobs.select("blob", F.col("todo").alias("scanned"), F.concat(*found).alias("matches"))


def read_ledger(spark: SparkSession, path: str) -> DataFrame | None:
    """The ledger's rows, or none where there is no ledger yet."""
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def findings(ledger: DataFrame, rules: list[Rule]) -> DataFrame:
    """``blob`` and ``spans`` (start, order, end, rule; sorted) of blobs with a match that passes."""
    current = F.array(*[pair_of(r) for r in rules])
    own = Window.partitionBy("blob", "rule").orderBy("at")
    rows = ledger.where(F.size("matches") > 0).select("blob", F.posexplode("matches").alias("at", "m"))
    rows = rows.where(F.array_contains(current, F.struct("m.rule", "m.version"))).select("blob", "at", "m.*")
    placed = rows.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(own)).where("ok")
    order = F.array_position(F.array(*[F.lit(r.name) for r in rules]), F.col("rule"))
    span = F.struct((F.col("end") - F.col("size")).alias("start"), order.alias("order"), "end", "rule")
    return placed.groupBy("blob").agg(F.sort_array(F.collect_list(span)).alias("spans"))


def scan_versions(versions: DataFrame, ledger_path: str, rules: list[Rule] = RULES, text: str = "text") -> DataFrame:
    """Scan what the ledger lacks, append it there, and return ``blob`` and ``spans`` of all blobs known."""
    spark = versions.sparkSession
    ledger = read_ledger(spark, ledger_path)
    scan(unseen(versions, ledger, rules, text), rules).write.mode("append").parquet(ledger_path)
    return findings(read_ledger(spark, ledger_path), rules)


def with_spans(versions: DataFrame, found: DataFrame, text: str = "text", out: str = "spans") -> DataFrame:
    """``versions`` with the spans of each row's blob (none: an empty array)."""
    if out in versions.columns or "__blob" in versions.columns:
        raise ValueError(f"columns to rename first: {out}, __blob")
    keyed = versions.withColumn("__blob", blob_of(text))
    spans = found.select(F.col("blob").alias("__blob"), F.col("spans").alias(out))
    empty = F.array().cast(spans.schema[out].dataType)
    return keyed.join(spans, "__blob", "left").withColumn(out, F.coalesce(out, empty)).drop("__blob")


def spans_text(spans: Column) -> Column:
    """rule:start:end, comma-joined; code points, end exclusive."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.rule, s.start, s.end)), ",")


def masked(text: str, spans: str) -> Column:
    """The text with each stretch that spans cover or touch replaced by a mask; n log n in spans, linear in the text."""
    # with starts and ends sorted apart, a stretch closes where the i-th end lies before the start after the i-th
    order = F.struct(F.split(F.col(text), "").alias("chars"), F.sort_array(F.transform(spans, lambda s: s.start)).alias("starts"),
                     F.sort_array(F.transform(spans, lambda s: s.end)).alias("ends"))

    def rebuilt(x: Column) -> Column:
        opens = F.filter(x.starts, lambda s, i: (i == 0) | (F.get(x.ends, i - 1) < s))
        closes = F.filter(x.ends, lambda e, i: (i == F.size(x.ends) - 1) | (e < F.get(x.starts, i + 1)))
        ends = F.concat(F.array(F.lit(0).cast("long")), closes)
        starts = F.concat(opens, F.array(F.size(x.chars).cast("long")))
        return F.array_join(F.zip_with(ends, starts, lambda b, a: F.array_join(
            F.slice(x.chars, (b + 1).cast("int"), (a - b).cast("int")), "")), MASK)

    return F.when(F.size(spans) == 0, F.col(text)).otherwise(F.element_at(F.transform(F.array(order), rebuilt), 1))
