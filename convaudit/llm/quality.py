"""Quality rules (operator 5): a threshold table compiled into one Spark projection.

Built-in functions only. Projections follow each other: the words and lines of a
text, the words' hashes, the measures, the verdict. A measure that is used more than
once is bound as the element of a one-entry array, so that it is computed once.

Repeated words: the hashes of the 8-word windows come from three rounds of
pairing neighbours (1, 2, 4, then 8 words). If all differ, nothing repeats, and
that is the end of it for most texts. Otherwise (hash, position) pairs are
sorted, positions with an equal neighbour kept, and the lengths of the covered
stretches summed: O(n log n) within the row, no shuffle.

Null and empty texts have no words, so they fail the base rule. Rows keep their
multiplicity, and other columns of the input pass through; a clash with a column
made here is an error that names it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8

# Frequent function words of the four languages.
STOP_WORDS = ("a an and are as at be by for from in is it of on that the this to was with "
              "au avec ce dans de des du elle en est et il la le les pas pour que qui sur un une "
              "al como con del el es esta lo los no para por se su una y "
              "das dem den der die ein eine er für im ist mit nicht sich sie und von zu auf").split()

#: name, measure over a text, lowest and highest value that passes (None: no bound), and the ratio's base.
#: 100 * measure is compared with bound * base, all in whole numbers.
THRESHOLDS = [
    ("n_words", "n_words", 20, None, None),
    ("repeated words", "n_repeat_words", None, 30, "n_words"),
    ("symbols", "n_symbols", None, 6, "word_chars"),
    ("duplicate lines", "n_dup_lines", None, 40, "n_lines"),
    ("words equal to the one before", "n_stutters", None, 30, "n_words"),
    ("mean word length", "word_chars", 200, 1500, "n_words"),
    ("stop words", "n_stop_words", 2, None, "n_words"),
    ("shouted words", "n_shouted", None, 30, "n_words"),
]
BASE = ("n_words", "repeated words")

WORKING = ["__words", "__lines", "__hashes"]
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words", "n_shouted",
            "n_stutters"]


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def neighbours(hashes: Column, step: int) -> Column:
    """The hash of each element with the one ``step`` places on."""
    n = F.size(hashes) - step
    return F.when(n > 0, F.zip_with(F.slice(hashes, F.lit(1), F.greatest(n, F.lit(0))),
                                    F.slice(hashes, F.lit(step + 1), F.greatest(n, F.lit(0))), lambda a, b: F.xxhash64(a, b))
                  ).otherwise(F.expr("array()").cast("array<bigint>"))


def covered(hashes: Column) -> Column:
    """Words in windows whose hash is found twice or more."""
    def repeated(pairs: Column) -> Column:
        n = F.size(pairs)
        same = F.zip_with(F.slice(pairs, F.lit(1), n - 1), F.slice(pairs, F.lit(2), n - 1), lambda a, b: a.h == b.h)
        return let(same, lambda eq: F.array_sort(F.transform(
            F.filter(F.zip_with(pairs, F.arrays_zip(
                F.concat(F.array(F.lit(False)), eq).alias("l"), F.concat(eq, F.array(F.lit(False))).alias("r")),
                lambda p, e: F.struct(p.p.alias("p"), (e["l"] | e["r"]).alias("e"))), lambda x: x.e), lambda x: x.p)))

    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
    stretches = let(let(pairs, repeated), lambda at: F.zip_with(
        at, F.slice(at, F.lit(2), F.size(at) - 1), lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW))))
    return F.aggregate(stretches, F.lit(0).cast("long"), lambda acc, x: acc + x)


def repeat_words(hashes: Column) -> Column:
    eight = let(let(neighbours(hashes, 1), lambda a: neighbours(a, 2)), lambda a: neighbours(a, 4))
    return let(eight, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(covered(h)))


def compile_rules(thresholds, names=None) -> Column:
    """True where a rule of the table fails."""
    fails = F.lit(False)
    for name, measure, low, high, base in thresholds:
        if names is None or name in names:
            value, scale = (F.col(measure) * 100, F.col(base)) if base else (F.col(measure), F.lit(1))
            if low is not None:
                fails = fails | (value < low * scale)
            if high is not None:
                fails = fails | (value > high * scale)
    return fails


def apply_rules(df: DataFrame, text: str = "text", thresholds=THRESHOLDS, stop_words=STOP_WORDS) -> DataFrame:
    """``df`` with the measures, ``base_failed`` and ``kept``."""
    clash = {*WORKING, *MEASURES, "base_failed", "kept"} & set(df.columns)
    if clash:
        raise ValueError(f"columns to rename first: {sorted(clash)}")
    body = F.coalesce(F.col(text), F.lit(""))
    words = F.array_remove(F.split(body, SPACE), "")
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(NOT_SPACE))
    parts = (df.withColumns({"__words": words, "__lines": lines})
             .withColumn("__hashes", F.transform("__words", lambda w: F.xxhash64(w))))
    w, hashes = F.col("__words"), F.col("__hashes")
    stops = sorted({*stop_words, *(s[:1].upper() + s[1:] for s in stop_words)})
    measures = {
        "n_words": F.size(w), "word_chars": F.char_length(F.array_join(w, "")),
        "n_symbols": F.char_length(F.regexp_replace(body, r"[^#*$%&|<>]+", "")),
        "n_dup_lines": F.size("__lines") - F.size(F.array_distinct("__lines")), "n_repeat_words": repeat_words(hashes),
        "n_lines": F.size("__lines"), "n_stop_words": F.size(F.filter(w, lambda x: x.isin(*stops))),
        "n_stutters": F.size(F.filter(F.zip_with(hashes, F.slice(hashes, F.lit(2), F.size(hashes)), lambda a, b: a == b), lambda e: e)),
        "n_shouted": F.regexp_count(body, F.lit(r"\p{Lu}{2,}")),
    }
    measured = parts.withColumns({k: v.cast("long") for k, v in measures.items()}).drop(*WORKING)
    return measured.withColumns({"base_failed": compile_rules(thresholds, BASE), "kept": ~compile_rules(thresholds)})
