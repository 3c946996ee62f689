"""Lexicon sources and the join forms of the sensitive-word test.

A lexicon is a table of entries. When its row count is within a bound it is
fetched once and compiled into the predicate (see ``functions.lexicon``). Beyond that, in substring
mode, it is fetched while its characters are within a second bound, and an automaton runs over the sentences (see
``functions.automaton``). A lexicon larger still stays distributed and is joined:

* token mode: explode the tokens and semi-join them to the entries (J1);
* substring mode: deal the texts into groups, join the entries to the groups that
  hold their prefix and run an automaton per group. Exact and fully
  distributed, and neither the driver nor a task holds the lexicon.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convaudit.functions import automaton
from convaudit.operators.util import bounded_broadcast
from convaudit.session import ensure_checkpoint_dir


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """A word-list file, one entry per line, as a one-column table ``entry``.

    Only line-break characters are stripped from each line's ends; other
    white space is kept, and an empty line is an (empty) entry.
    """
    return spark.read.text(path).select(
        F.regexp_replace("value", r"^[\r\n]+|[\r\n]+$", "").alias("entry"))


def lines_of(text_col: str = "text") -> F.Column:
    """Split a text into lines the way a text-mode line reader does: ``\\r\\n``,
    ``\\r`` and ``\\n`` end a line, and a final line break adds no empty line."""
    parts = F.split(F.col(text_col), r"\r\n|\r|\n")
    n = F.size(parts)
    return F.when(F.col(text_col).rlike(r"(\r|\n)$"), F.slice(parts, 1, n - 1)).otherwise(parts)


def inline_entries(lexicon, max_entries: int) -> list[str] | None:
    """The entries as a Python list when the lexicon is small enough to inline.

    Lists are returned as they are; a DataFrame is counted first (at most
    ``max_entries + 1`` rows are read) and fetched only within the bound.
    """
    if not isinstance(lexicon, DataFrame):
        return [e for e in lexicon if e is not None]
    col = lexicon.columns[0]
    small = lexicon.select(F.col(col).alias("entry")).where(F.col("entry").isNotNull()).distinct()
    rows = small.limit(max_entries + 1).collect()  # at most max_entries + 1 rows reach the driver
    if len(rows) > max_entries:
        return None
    return [r.entry for r in rows]


def bounded_entries(lexicon, max_chars: int) -> list[str] | None:
    """The entries as a Python list when they have at most ``max_chars`` characters in all (measured first)."""
    if not isinstance(lexicon, DataFrame):
        return [e for e in lexicon if e is not None]
    each = lexicon.select(F.col(lexicon.columns[0]).alias("entry")).where(F.col("entry").isNotNull()).distinct()
    if (each.agg(F.sum(F.length("entry") + 1)).first()[0] or 0) > max_chars:
        return None
    return [r.entry for r in each.collect()]


def _entries(lexicon: DataFrame) -> DataFrame:
    """The entries to join with: no distinct, since a semi join needs none and a plain
    exchange lets a frequent value be split; broadcast when their bytes allow."""
    return bounded_broadcast(lexicon.select(F.col(lexicon.columns[0]).alias("_e")).where(F.col("_e").isNotNull()))


def semi_join_lexicon(df: DataFrame, lexicon: DataFrame, mode: str = "substring", tokens: str = "tokens") -> DataFrame:
    """Rows of ``df`` whose tokens hit a large lexicon.

    Whether a sentence is hit depends on its tokens alone, so equal token lists are
    looked up once and joined back on two hashes of the list: no record key takes
    part, hence null or shared keys can't mix records up.
    """
    rows = df.withColumns({"_t1": F.xxhash64(tokens), "_t2": F.xxhash64(F.lit("tokens"), tokens)})
    if mode == "token":
        each = rows.select("_t1", "_t2", F.col(tokens).alias("_tokens")).dropDuplicates(["_t1", "_t2"])
        probe = each.select("_t1", "_t2", F.explode(F.array_distinct("_tokens")).alias("_e"))
        hits = probe.join(_entries(lexicon), "_e", "left_semi").select("_t1", "_t2").distinct()
    elif mode == "substring":
        each = rows.select("_t1", "_t2", F.concat_ws("", tokens).alias("text")).where(F.length("text") > 0)
        hits = _substring_hits(each.dropDuplicates(["_t1", "_t2"]), lexicon)
        if hits is None:
            return df
    else:
        raise ValueError(f"unknown sensitive mode {mode!r}")
    return rows.join(hits, ["_t1", "_t2"], "left_semi").drop("_t1", "_t2")


#: Characters of the texts that one automaton is run over, on average.
GROUP_CHARS = 1 << 21
#: Bits of the filter of prefixes that is broadcast, at most.
MOST_BITS = 1 << 28


def _substring_hits(each: DataFrame, lexicon: DataFrame) -> DataFrame | None:
    """``_t1``, ``_t2`` of the texts that contain an entry; none if the lexicon has the empty entry, which all contain.

    Texts and entries are stored, the texts dealt into groups of bounded size. An entry is joined to the groups
    that hold its prefix (``automaton.PREFIX`` characters), and each group runs an automaton of its own
    entries. Texts emit only prefixes that a bitmap of all entries' prefixes knows.
    """
    spark = each.sparkSession
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/lexicons/{uuid.uuid4().hex}"

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = automaton.prefix_keys(batch.column(0).to_pylist()).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys)], ["entry", "key"])

    entries = lexicon.select(F.col(lexicon.columns[0]).alias("entry")).where(F.col("entry").isNotNull())
    entries.distinct().mapInArrow(keyed, "entry string, key long").write.parquet(f"{folder}/entries")
    entries = spark.read.schema("entry string, key long").parquet(f"{folder}/entries")
    sizes = {r.size: r.n for r in entries.groupBy(F.least(F.length("entry"), F.lit(automaton.PREFIX)).alias("size")).agg(
        F.count(F.lit(1)).alias("n")).collect()}  # a row per size
    if 0 in sizes:
        return None
    each.write.parquet(f"{folder}/texts")
    texts = spark.read.schema("_t1 long, _t2 long, text string").parquet(f"{folder}/texts")
    groups = 1 + (texts.agg(F.sum(F.length("text"))).first()[0] or 0) // GROUP_CHARS
    texts = texts.withColumn("group", F.pmod("_t1", F.lit(groups)))
    bits = max(64, min(MOST_BITS, 1 << (16 * sum(sizes.values())).bit_length()))
    low, high = F.col("key").bitwiseAND(F.lit((1 << 32) - 1)), F.shiftrightunsigned("key", 32)
    places = entries.select(F.explode(F.array(*[(low + i * high).bitwiseAND(F.lit(bits - 1)) for i in range(automaton.PROBES)])).alias("place"))
    # at most MOST_BITS / 64 rows
    words = places.groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("bits")).toArrow()
    bitmap = np.zeros(bits // 64, np.int64)
    bitmap[words["word"].to_numpy()] = words["bits"].to_numpy()
    known = spark.sparkContext.broadcast(bitmap)

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group, values = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            for a, b in automaton.chunks(values):
                for text, key in automaton.gram_keys(values[a:b], sizes):
                    for i in range(automaton.PROBES):
                        at = ((key & np.uint64((1 << 32) - 1)) + np.uint64(i) * (key >> np.uint64(32)) & np.uint64(bits - 1)).astype(np.int64)
                        seen = (known.value[at >> 6] >> (at & 63) & 1) > 0
                        text, key = text[seen], key[seen]
                    pairs = np.unique(np.stack((group[a:b][text], key.view(np.int64))), axis=1)
                    yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["group", "key"])

    def run(key: tuple, texts: pa.Table, found: pa.Table) -> pa.Table:
        values, hit = texts["text"].to_pylist(), np.zeros(texts.num_rows, bool)
        for part in automaton.shards(found["entry"].to_pylist(), automaton.SHARD_CHARS):
            one = automaton.Automaton(part)
            for a, b in automaton.chunks(values):
                left = a + np.flatnonzero(~hit[a:b])
                hit[left] = one.contained([values[i] for i in left])
        return texts.select(["_t1", "_t2"]).filter(pa.array(hit))

    pairs = texts.select("group", "text").mapInArrow(grams, "group long, key long").distinct()
    wanted = pairs.join(entries, "key").select("group", "entry")
    return texts.groupBy("group").cogroup(wanted.groupBy("group")).applyInArrow(run, "_t1 long, _t2 long")


def token_hits(df: DataFrame, lexicon: DataFrame, keys: Sequence[str], tokens: str = "tokens") -> DataFrame:
    """Keys of rows with a token equal to an entry (explode + semi join)."""
    probe = df.select(*keys, F.explode(F.array_distinct(tokens)).alias("_e"))
    return probe.join(_entries(lexicon), "_e", "left_semi").select(*keys).distinct()
