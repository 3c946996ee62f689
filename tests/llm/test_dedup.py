"""Operators 4, 8 and 9 against brute force."""

import random

import numpy as np
import pytest
import xxhash

from conftest import SF001
from convaudit.llm import embeddings, lines, simhash
from convaudit.llm.components import components
from convaudit.llm.queries import QUERIES


def smallest_reachable(nodes, links):
    root = {n: n for n in nodes}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def test_components_of_random_graphs_and_a_long_path(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5)]
    nodes = {n for l in links for n in l}
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "x long, y long")).collect()}
    expected = smallest_reachable(nodes, links)
    assert {n: got.get(n, n) for n in nodes} == expected
    assert components(spark.createDataFrame([], "x long, y long")).count() == 0


def plain_fingerprint(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints():
    for t in ["", " \n", "One", "one TWO", "a b c", "Ä É a b c d " * 40, "x " * 3000, "a\x1cb c\td\x0be f"]:
        assert simhash.fingerprint(t) & (1 << 64) - 1 == plain_fingerprint(t)


@pytest.mark.parametrize("block", [4096, 16])
def test_links_lose_no_pair(spark, block):
    """Dense clusters, chains and strangers; small blocks cut the buckets."""
    rng = random.Random(5)
    fps = {0, 1, (1 << 64) - 1}
    for _ in range(6):
        centre = rng.getrandbits(64)
        fps |= {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(0, 4))) for _ in range(60)}
    x = rng.getrandbits(64)
    for _ in range(30):  # a chain of steps of three bits
        fps.add(x)
        x ^= sum(1 << b for b in rng.sample(range(64), 3))
    fps |= {rng.getrandbits(64) for _ in range(200)}
    signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
    every = np.array(signed, np.int64).view(np.uint64)
    i, j = np.nonzero(np.bitwise_count(every[:, None] ^ every[None]) <= 3)
    expected = smallest_reachable(signed, [(signed[a], signed[b]) for a, b in zip(i, j)])
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    links = simhash.links(df, 3, block)
    pairs = [(r.a, r.b) for r in links.collect()]
    assert all(bin((a ^ b) & (1 << 64) - 1).count("1") <= 3 for a, b in pairs)
    assert smallest_reachable(signed, pairs) == expected


def test_near_duplicates_of_odd_rows(spark):
    base = " ".join(f"w{i}" for i in range(400))
    rows = [(5, base, 1), (3, base + " end", 1), (9, base, 1), (9, base, 1), (8, None, 1), (2, "", 1), (7, " \n", 1), (6, "alone here now", 1), (None, base, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    got = simhash.near_duplicates(df).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r.component_id for r in got}
    near = bin((simhash.fingerprint(base) ^ simhash.fingerprint(base + " end")) & (1 << 64) - 1).count("1") <= 3
    assert by[8] == by[2] == by[7] == 2 and by[6] == 6
    assert by[9] == by[5] == by[None] == (3 if near else 5)
    assert simhash.near_duplicates(df.where("false")).count() == 0


def test_simhash_query(spark):
    docs = {r.doc_id: plain_fingerprint(r.text or "") for r in spark.read.parquet(SF001 + "/documents.parquet").collect()}
    keys = sorted(docs)
    links = [(a, b) for a in keys for b in keys if a < b and bin(docs[a] ^ docs[b]).count("1") <= 3]
    expected = smallest_reachable(keys, links)
    got = QUERIES["op4_simhash"](spark, SF001).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {k: (f"{docs[k]:016x}", expected[k]) for k in keys}


# ---------------------------------------------------------------- embeddings

def test_fast_transform_is_orthonormal():
    x = np.random.default_rng(0).normal(size=(5, 16))
    assert np.allclose(embeddings.hadamard(embeddings.hadamard(x)), x)
    assert np.allclose(np.linalg.norm(embeddings.hadamard(x), axis=1), np.linalg.norm(x, axis=1))


def test_recall_at_the_threshold():
    """Pairs at exactly 0.95, the hardest that count."""
    rng = np.random.default_rng(0)
    x, _ = embeddings.unit_rows(rng.normal(size=(3000, 64)))
    e = rng.normal(size=x.shape)
    e, _ = embeddings.unit_rows(e - (e * x).sum(1, keepdims=True) * x)
    a, b = (embeddings.codes_of(v, 6, 2, 2) for v in (x, 0.95 * x + np.sqrt(1 - 0.95 ** 2) * e))
    assert ((a == b[:, :, :1]) | (b == a[:, :, :1])).any(2).any(1).mean() >= 0.98


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, n_links int")


@pytest.mark.parametrize("block", [2048, 8])
def test_near_vectors_equal_brute_force(spark, block):
    rng = np.random.default_rng(2)
    rows = []
    for c in range(6):
        centre = rng.normal(size=16)
        rows += [centre + rng.normal(size=16) * 0.03 for _ in range(20)]
    rows += list(rng.normal(size=(40, 16)))
    rows += [rows[0] * 2.5, rows[0], rows[7], np.zeros(16)]
    ids = rng.permutation(len(rows)).tolist()
    df = vectors(spark, [(i, x.tolist(), 0) for i, x in zip(ids, rows)])
    unit, ok = embeddings.unit_rows(np.array(rows))
    sim = (unit @ unit.T >= 0.95) & ok[:, None] & ok[None]
    np.fill_diagonal(sim, False)
    root = smallest_reachable(ids, [(ids[a], ids[b]) for a, b in zip(*np.nonzero(sim))])
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.near_vectors(df, block=block).collect()}
    assert got == {i: (int(n), root[i], root[i] == i) for i, n in zip(ids, sim.sum(1))}


def test_vectors_without_direction_link_with_nothing(spark):
    nan, inf = float("nan"), float("inf")
    bad = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [1.0, 0.0]), (8, [1.0, 0.0, 0.0]), (9, [2.0, 0.0])]
    got = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_vectors(vectors(spark, [(i, v, 0) for i, v in bad])).collect()}
    assert got == {**{i: (0, i) for i in (1, 2, 3, 4, 5, 6, 8)}, 7: (1, 7), 9: (1, 7)}
    again = embeddings.near_vectors(vectors(spark, [(1, [1.0, 2.0], 0)] * 3 + [(None, [1.0, 2.0], 0)])).collect()
    assert sorted((str(r.vec_id), r.n_links) for r in again) == [("1", 0)] * 3 + [("None", 0)]
    assert embeddings.near_vectors(vectors(spark, [])).count() == 0


def brute_classes(ids, vectors):
    """id -> links, smallest id reachable, kept."""
    unit, _ = embeddings.unit_rows(np.array(vectors, float))
    sim = unit @ unit.T >= 0.95
    root, changed = dict(zip(ids, ids)), True
    while changed:
        changed = False
        for i, k in enumerate(ids):
            least = min(root[ids[j]] for j in np.flatnonzero(sim[i]))
            changed, root[k] = changed or least < root[k], min(least, root[k])
    return {k: (int(n) - 1, root[k], root[k] == k) for k, n in zip(ids, sim.sum(1))}


def classes_of(df):
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in df.collect()}


def test_embedding_query_equals_brute_force(spark):
    rows = spark.read.parquet(SF001 + "/embeddings.parquet").collect()
    assert classes_of(QUERIES["op8_embedding_dedup"](spark, SF001)) == brute_classes([r.vec_id for r in rows], [r.embedding for r in rows])


def test_planted_groups_of_vectors(spark):
    """Copies and close neighbours of the table's vectors, under ids on both sides of theirs."""
    rng = np.random.default_rng(5)
    rows = spark.read.parquet(SF001 + "/embeddings.parquet").limit(150).collect()
    ids, found = [r.vec_id for r in rows], [list(r.embedding) for r in rows]
    for i in range(0, 150, 3):
        for k in range(1 + i % 4):
            ids.append((-1 if k % 2 else 1) * (10_000 + 10 * i + k))
            found.append((np.array(rows[i].embedding) + rng.normal(0, 1e-3 * (k % 3), len(rows[i].embedding))).tolist())
    got = classes_of(near(spark, ids, found))
    assert got == brute_classes(ids, found)
    assert sum(not kept for *_, kept in got.values()) > 50


def near(spark, ids, found):
    return embeddings.near_vectors(vectors(spark, [(i, v, 0) for i, v in zip(ids, found)]))


# ---------------------------------------------------------------- lines

LONG = "this line is long enough to go"


def test_lines_of_odd_rows(spark):
    rows = [(2, f"{LONG}\nshort one\n  This LINE is\tlong enough  to go ", "a"), (1, f"first\n{LONG}\n{LONG}", "b"), (3, None, "c"), (4, "", "d"),
            (5, "short one\nshort one", "e"), (6, LONG, "f"), (6, LONG, "f"), (7, f"é{LONG}\n{LONG}\n", "g"), (None, f"x\n{LONG}", "h")]
    df = spark.createDataFrame(rows, "doc_id long, text string, raw string")
    got = {}
    for r in lines.dedup_units(df).collect():
        got.setdefault(r.doc_id, []).append((r.text, r.n_units, r.n_removed, [(s.start, s.end) for s in r.removed], r.raw))
    n = len(LONG)
    # a null key comes first in the order, so its line is the one that stays
    assert got[None] == [(f"x\n{LONG}", 2, 0, [], "h")]
    assert got[1] == [("first", 3, 2, [(6, 6 + n), (7 + n, 7 + 2 * n)], "b")]
    assert got[2] == [("short one", 3, 2, [(0, n), (n + 11, len(rows[0][1]))], "a")]
    assert got[3] == [(None, 0, 0, [], "c")] and got[4] == [("", 0, 0, [], "d")]
    assert got[5] == [("short one\nshort one", 2, 0, [], "e")]
    assert got[6] == [("", 1, 1, [(0, n)], "f")] * 2
    assert got[7] == [(f"é{LONG}\n", 2, 1, [(n + 2, 2 * n + 2)], "g")]
    assert lines.dedup_units(df.where("false")).count() == 0
    with pytest.raises(ValueError, match="n_units"):
        lines.dedup_units(df.withColumnRenamed("raw", "n_units"))


def test_paragraph_units(spark):
    df = spark.createDataFrame([(1, f"{LONG}\nx\n\ny"), (2, f"z\n\n{LONG}\nx")], "doc_id long, text string")
    got = {r.doc_id: r.text for r in lines.dedup_units(df, separator="\n\n").collect()}
    assert got == {1: f"{LONG}\nx\n\ny", 2: "z"}


def test_passage_in_the_middle_of_lines(spark):
    one, two = "Here is a passage that several documents quote.", "It goes on for a second sentence of some length!"
    rows = [(1, f"Some start of its own {one} {two} And an end."), (2, f"Another start {one}  {two} Short end."), (3, f"{one} {two}"),
            (4, f"Begin. {two} {two}"), (5, f"x\n{two}\n{one} {two} ")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.text, [rows[r.doc_id - 1][1][s.start:s.end] for s in r.removed]) for r in lines.dedup_units(df).collect()}
    assert got[1] == (rows[0][1], [])
    assert got[2] == (f"Another start {one}  Short end.", [two])
    assert got[3] == (one, [two])
    assert got[4] == ("Begin.", [two, two])
    assert got[5] == ("x", [two, f"{one} {two} "])
    plain = {r.doc_id: r.text for r in lines.dedup_units(df, least_sentence=0).collect()}
    assert plain == {**dict(rows), 5: f"x\n{two}"}  # its last line equals that of 3


def test_passage_cut_off_inside_sentences(spark):
    rng = random.Random(11)
    words = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n))
    passage = words(80)
    ends = [(words(9), words(9)) for _ in range(3)]
    df = spark.createDataFrame([(k, f"{a}  {passage} {b}") for k, (a, b) in enumerate(ends)], "doc_id long, text string")
    texts = {r.doc_id: r.text for r in df.collect()}
    assert {r.doc_id: r.text for r in lines.dedup_units(df).collect()} == texts  # no sentence ends: all of it stays
    got = {r.doc_id: r for r in lines.dedup_units(df, window=5).collect()}
    assert got[0].text == texts[0]
    for k in (1, 2):
        a, b = ends[k]
        assert got[k].text.startswith(a) and got[k].text.endswith(b) and len(got[k].text.split()) <= 18 + 40
        gone = [texts[k][s.start:s.end] for s in got[k].removed]
        assert gone and all(x in passage for x in gone)
        assert len(got[k].text.split()) + sum(len(x.split()) for x in gone) == 98
    assert lines.starts_of([b"a"] * 50, 5) == [0, 1]


def plain_lines(rows, least=5, sentence=8):
    """rows: (key, text), in order. Kept texts, unit by unit."""
    import re

    seen, out = set(), []
    norm = lambda x: re.sub(r"[\x20\x09-\x0D]+", " ", x.lower()).strip(" ")
    for k, t in rows:
        kept = []
        for line in t.split("\n"):
            body, parts, gone = norm(line), re.split(r"(?<=[.!?])([\x20\x09-\x0D]+)", line), []
            whole = body != "" and len(body.split(" ")) >= least
            lost = whole and body in seen
            if whole:
                seen.add(body)
            for i in range(0, len(parts), 2) if len(parts) > 1 else []:
                own = norm(parts[i])
                if own and len(own.split(" ")) >= sentence:
                    gone += [i] if own in seen else []
                    seen.add(own)
            if lost:
                continue
            if not gone:
                kept.append(line)
                continue
            rest = "".join(parts[i] + (parts[i + 1] if i + 1 < len(parts) else "") for i in range(0, len(parts), 2) if i not in gone)
            rest = rest.rstrip(lines.SPACES) if len(parts) - 1 in gone else rest
            kept += [rest] if rest.strip(lines.SPACES) else []
        out.append((k, "\n".join(kept)))
    return out


def test_line_query_equals_the_plain_version(spark):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(SF001 + "/documents.parquet").collect())
    assert sorted((r.doc_id, r.text) for r in QUERIES["op9_line_dedup"](spark, SF001).collect()) == plain_lines(rows)
