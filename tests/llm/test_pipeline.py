"""The corpus pipeline against a plain version of its stages, and the registered queries against SQL."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from conftest import SF001
from convaudit.llm import packing, simhash
from convaudit.llm.oracle import SQL
from convaudit.llm.queries import QUERIES, TOXIC, toxicity_model
from convaudit.testing import compare
from test_dedup import plain_lines, smallest_reachable


def test_every_operator_is_registered():
    assert sorted(int(re.match(r"op(\d+)_", k)[1]) for k in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(SQL) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck01, name):
    r = compare(spark, name, "/root/testdata/sf0.01", duck01)
    assert r["cols_match"] and r["match"] and not r["type_diffs"], r


def plain_pipeline(spark, rows, sf_dir):
    """rows: (doc_id, text). The pieces' (doc_id, start, length, ids)."""
    import test_rules_secrets as secrets

    model = toxicity_model(spark, sf_dir)
    rows = [(k, t) for (k, t), s in zip(rows, model.scores([t or "" for _, t in rows])) if s < TOXIC]
    fps = {k: simhash.fingerprint(t or "") & (1 << 64) - 1 for k, t in rows}
    keys = sorted(fps)
    root = smallest_reachable(keys, [(a, b) for a in keys for b in keys if a < b and bin(fps[a] ^ fps[b]).count("1") <= 3])
    rows = sorted((k, t) for k, t in rows if root[k] == k)
    rows = [(k, t or "") for k, t in rows]
    left = [(k, new) for (k, new), (_, old) in zip(plain_lines(rows), rows) if new == old or new.strip(" ")]
    out, encoder = set(), packing.Encoder(open(corpus_pipeline.public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read())
    from convaudit.llm.secret_scan import MASK

    for k, t in left:
        cuts = []
        for a, b in sorted((int(x.split(":")[1]), int(x.split(":")[2])) for x in secrets.plain_base(t).split(",") if x):
            if cuts and a <= cuts[-1][1]:
                cuts[-1][1] = max(b, cuts[-1][1])
            else:
                cuts.append([a, b])
        for a, b in reversed(cuts):
            t = t[:a] + MASK + t[b:]
        raw, at = encoder.encode(t) + b"\1\0\0\0", 0
        for n in packing.lengths(len(raw) // 4, 2048):
            out.add((k, at, n, raw[4 * at:4 * (at + n)]))
            at += n
    return out


def test_pipeline_equals_the_plain_version(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(SF001 + "/documents.parquet").collect()]
    got = corpus_pipeline.run(spark, SF001).collect()
    assert {(r.doc_id, r.start, r.length, bytes(r.ids)) for r in got} == plain_pipeline(spark, rows, SF001)
    assert len({r.sequence_id for r in got}) == len(got)


def test_one_row_of_each_group_stays(spark):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(60)) for x in "abcd")
    rows = [(1, a), (1, a), (2, a), (3, b), (3, c), (4, c), (None, a), (None, d), (None, d), (None, d.upper()), (None, None), (None, ""), (5, "x y z")]
    got = corpus_pipeline.simhash_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF001).collect()
    kept = [(r.doc_id, r.text) for r in got]
    assert {(1, a), (3, b), (3, c), (5, "x y z")} <= set(kept) and len(kept) == 6
    assert sorted((t or "").lower() for k, t in kept if k is None) == ["", d]


def test_stages_keep_the_columns_and_take_odd_tables(spark):
    docs = spark.read.parquet(SF001 + "/documents.parquet")
    odd = docs.limit(3).union(docs.limit(1).withColumns({c: F.lit(None).cast(docs.schema[c].dataType) for c in docs.columns}))
    odd = odd.union(docs.limit(1).withColumn("text", F.lit(""))).union(docs.limit(1)).withColumn("extra", F.lit(1))
    for name, stage in corpus_pipeline.STAGES:
        for frame in (odd, odd.where("false")):
            out = stage(spark, frame, SF001)
            if name != "packing":
                assert out.columns == odd.columns
            assert out.count() <= (np.inf if name == "packing" else frame.count())
