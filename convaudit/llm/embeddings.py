"""Embedding near-dedup (operator 8): cross-polytope hashing with multiprobe.

Vectors are rotated by rounds of random signs and a fast Hadamard transform.
A hash is the signed axis that the rotated vector lies nearest to; a code joins
``parts`` hashes. Every vector is filed in each table under its code and under the
next best codes (probes), those whose axes lose least. Two vectors meet where the
code of one is among the codes of the other, and are verified there by cosine in
double precision.

Equal vectors are one class from the start, weighted by its size. A bucket isn't
turned into pairs: its task multiplies blocks of vectors, keeps pairs at the
least cosine or above, and counts a pair only in the first table (and there in
the lower bucket) where it meets, so the sums per vector are exact for all pairs
that meet. It returns a row per vector: its number of links and the smallest
vector that it reaches in the bucket. A bucket of more than ``block`` rows is cut
into blocks, and each two blocks are compared by a task of their own.

Null vectors, zero vectors and those with null or non-finite components link with
nothing. Vectors of different lengths are never compared. Rows that repeat an id
with the same vector are one; ids that carry several vectors share their links. A row
with a null id links with nothing. Ids are longs (the row's key is cast by the caller); other
columns of the input are not used, and an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convaudit.llm.common import drop_stored, map_slices, stored
from convaudit.llm.components import components

SEED = 20240229


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows, orthonormal; the width is a power of two."""
    n, width = x.shape
    step = 1
    while step < width:
        x = x.reshape(n, -1, 2, step)
        x = np.stack((x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]), axis=2).reshape(n, width)
        step *= 2
    return x / np.sqrt(width)


def codes_of(unit: np.ndarray, tables: int, parts: int, probes: int) -> np.ndarray:
    """Codes (row, table, probe) of unit vectors; probe 0 is the vector's own code."""
    n, dim = unit.shape
    width = 1 << (dim - 1).bit_length()
    padded = np.zeros((n, width))
    padded[:, :dim] = unit
    signs = np.random.default_rng([SEED, width]).choice([-1.0, 1.0], (tables, parts, 3, width))
    out = np.zeros((n, tables, probes), np.int64)
    each = min(probes, width)
    for t in range(tables):
        code, loss = np.zeros((n, 1), np.int64), np.zeros((n, 1))
        for p in range(parts):
            y = padded
            for s in signs[t, p]:
                y = hadamard(y * s)
            axis = np.argsort(-np.abs(y), axis=1, kind="stable")[:, :each]
            value = np.take_along_axis(y, axis, 1)
            size = np.abs(value)
            less = (size[:, :1] - size) ** 2
            code = (code[:, :, None] * (2 * width) + (2 * axis + (value < 0))[:, None, :]).reshape(n, -1)
            loss = (loss[:, :, None] + less[:, None, :]).reshape(n, -1)
            best = np.argsort(loss, axis=1, kind="stable")[:, :probes]
            code, loss = np.take_along_axis(code, best, 1), np.take_along_axis(loss, best, 1)
        out[:, t, :code.shape[1]], out[:, t, code.shape[1]:] = code, code[:, :1]
    return out


def unit_rows(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of length one, and which rows have a direction."""
    with np.errstate(all="ignore"):
        ok = np.isfinite(x).all(axis=1) & (x != 0).any(axis=1)
        x = np.where(ok[:, None], x, 1.0)
        x = x / np.abs(x).max(axis=1, keepdims=True)
        return x / np.linalg.norm(x, axis=1, keepdims=True), ok


def raw_vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    """``id`` and ``raw`` (the components as little-endian doubles; null if they link with nothing)."""
    rows = df.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw = []
        for v in batch.column(1):
            x = v.values.to_numpy(zero_copy_only=False) if v.is_valid else np.zeros(0)
            raw.append((x + 0.0).astype("<f8").tobytes() if len(x) and np.isfinite(x).all() and x.any() else None)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], ["id", "raw"])

    return map_slices(rows, run, f"id {rows.schema['id'].dataType.simpleString()}, raw binary")


def filed(classes: DataFrame, tables: int, parts: int, probes: int) -> DataFrame:
    """``classes`` with ``dim`` and all ``codes``, table by table."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw = batch.column(2).to_pylist()
        dims = np.array([len(r) // 8 for r in raw])
        codes = [None] * len(raw)
        for dim in np.unique(dims):
            at = np.flatnonzero(dims == dim)
            unit, _ = unit_rows(np.frombuffer(b"".join([raw[i] for i in at]), "<f8").reshape(-1, dim))
            for i, c in zip(at, codes_of(unit, tables, parts, probes).reshape(len(at), -1)):
                codes[i] = c
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(dims, pa.int32()), pa.array(codes, pa.list_(pa.int64()))],
                                          ["id", "weight", "raw", "dim", "codes"])

    return map_slices(classes, run, "id long, weight long, raw binary, dim int, codes array<long>")


def verify(group: pa.Table, table: int, code: int, probes: int, least: float) -> pa.Table:
    """Links of one bucket, or of two of its blocks: ``id``, ``n`` (weighted, counted once), ``root``."""
    ids, weight, own = (group.column(c).to_numpy() for c in ("id", "weight", "own"))
    n = len(ids)
    raw = np.frombuffer(b"".join(group.column("raw").to_pylist()), "<f8").reshape(n, -1)
    unit, _ = unit_rows(raw)
    codes = np.stack(group.column("codes").to_numpy()).reshape(n, -1, probes)
    base = codes[:, :, 0]
    count, root = np.zeros(n, np.int64), np.arange(n)
    two_blocks = own.min() != own.max()
    found = []
    for at in range(0, n, 1024):
        i, j = np.nonzero(unit[at:at + 1024] @ unit[at:].T >= least)
        i, j = i + at, j + at
        keep = (i < j) & (ids[i] != ids[j])
        if two_blocks:  # pairs within a block have a task of their own
            keep &= own[i] != own[j]
        found.append((i[keep], j[keep]))
    i, j = (np.concatenate(x) for x in zip(*found))

    def meets(t: int) -> tuple[np.ndarray, np.ndarray]:
        return (codes[j, t] == base[i, t, None]).any(1), (codes[i, t] == base[j, t, None]).any(1)

    at_i, at_j = meets(table)  # in the bucket of i's code, of j's code
    here = np.where(at_i & at_j, np.minimum(base[i, table], base[j, table]), np.where(at_i, base[i, table], base[j, table])) == code
    here &= at_i | at_j
    i, j = i[here], j[here]
    first = np.ones(len(i), bool)
    for t in range(table):
        a, b = meets(t)
        first &= ~(a | b)
    np.add.at(count, i[first], weight[j[first]])
    np.add.at(count, j[first], weight[i[first]])
    order = np.argsort(ids, kind="stable")  # positions by id, so that roots are smallest ids
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    a, b = place[i[first]], place[j[first]]
    while True:
        before = root.copy()
        np.minimum.at(root, a, root[b])
        np.minimum.at(root, b, root[a])
        root = root[root]
        if (root == before).all():
            break
    some = np.flatnonzero(count)
    return pa.table({"id": ids[some], "n": count[some], "root": ids[order[root[place[some]]]]})


def near_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding", least: float = 0.95, tables: int = 6,
                 parts: int = 2, probes: int = 2, block: int = 2048) -> DataFrame:
    """``key``, ``n_links``, ``component_id`` and ``kept`` of every row. ``key`` is a long."""
    rows = stored(raw_vectors(df, key, vector), "vectors")
    classes = rows.where("raw is not null and id is not null").distinct().groupBy("raw").agg(
        F.min("id").alias("id"), F.count(F.lit(1)).alias("weight"))
    index = stored(filed(classes.select("id", "weight", "raw"), tables, parts, probes), "codes")
    # a code is filed once per vector and table, under its first probe
    code = F.explode(F.transform(F.sequence(F.lit(0), F.lit(tables - 1)), lambda t: F.struct(
        t.alias("table"), F.array_distinct(F.slice("codes", t * probes + 1, F.lit(probes))).alias("own"))))
    places = index.select("*", code.alias("x")).select("id", "weight", "raw", "dim", "codes", "x.table", F.explode("x.own").alias("code"))
    sizes = places.select("dim", "table", "code").groupBy("dim", "table", "code").agg(F.count(F.lit(1)).alias("n"))
    large = stored(sizes.where(F.col("n") > block).select("dim", "table", "code", F.ceil(F.col("n") / block).cast("int").alias("blocks")), "large")
    blocks = F.coalesce("blocks", F.lit(1))
    own = F.pmod(F.xxhash64("raw"), blocks.cast("long")).cast("int")
    cells = places.join(large, ["dim", "table", "code"], "left").withColumn("own", own).withColumn("cell", F.explode(F.transform(
        F.sequence(F.lit(0), blocks - 1), lambda o: F.least(o, F.col("own")) * 65536 + F.greatest(o, F.col("own"))))).drop("blocks")

    def walk(key: tuple, group: pa.Table) -> pa.Table:
        _, number, value, cell = (k.as_py() for k in key)
        if group.num_rows < 2:
            return pa.table({c: pa.array([], pa.int64()) for c in ("id", "n", "root")})
        if cell >> 16 != cell & 65535 and len(set(group.column("own").to_pylist())) < 2:  # one of the two blocks is empty
            return pa.table({c: pa.array([], pa.int64()) for c in ("id", "n", "root")})
        return verify(group, number, value, probes, least)

    found = stored(cells.groupBy("dim", "table", "code", "cell").applyInArrow(walk, "id long, n long, root long"), "links")
    counts = found.groupBy("id").agg(F.sum("n").alias("n"))
    named = index.select("id", "weight", "raw").join(counts, "id", "left").join(
        components(found.select("id", "root")).withColumnRenamed("node", "id"), "id", "left")
    named = stored(named.select("raw", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).cast("long").alias("n_links"),
                                F.coalesce("component", "id").alias("component_id")), "named-vectors")
    for done in (found, large, index):
        drop_stored(done)
    out = rows.join(named, "raw", "left").select(F.col("id").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                                                 F.coalesce("component_id", "id").alias("component_id"))
    return out.withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))
