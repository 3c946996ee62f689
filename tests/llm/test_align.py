"""Operator 13 against a plain version made from the tokenizers library."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from conftest import SF001
from convaudit.llm import align
from convaudit.llm.common import slices
from convaudit.llm.queries import QUERIES

A_FILE, B_FILE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["a", "the cat sat", "the cat sat", "the cat sat", "  two  spaces ", "über straße ñandú", "一二三 x", "😀👍🏽 ok", "<|endoftext|> and <s> </s> <0x41>", "x▁y", "",
         None, "the dog sat", "tab\tand\nline\r\n", "ﬁ ① ½", "\x00\x01", " " * 25_000 + "end", "näive", "the the the the", "word " * 2000, "a" * 5000]


def byte_value():
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(rest)}}


class Plain:
    """Everything by loops, from the library's own vocabularies."""

    def __init__(self):
        self.a = Tokenizer.from_file(A_FILE)
        self.a.no_truncation()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B_FILE)
        self.value = byte_value()

    def tokens(self, text):
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        b = self.b.encode(text)
        a_bytes = [bytes(self.value[c] for c in self.a.id_to_token(i)) for i in a]
        b_bytes = []
        for i in b:
            p = self.b.id_to_piece(i)
            b_bytes.append(bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode())
        return a, a_bytes, b, b_bytes

    def one(self, text):
        """n_a, n_b, groups, links of a text."""
        if not text:
            return 0, 0, [], []
        a, a_bytes, b, b_bytes = self.tokens(text)
        raw = (" " + text).encode()
        if b"".join(a_bytes) != raw or b"".join(b_bytes) != raw:
            return 0, 0, [], []
        links, groups, i, j, x, y, left, right = [], [], 0, 0, 0, 0, [], []
        while i < len(a) and j < len(b):
            links.append((a[i], b[j]))
            ea, eb = x + len(a_bytes[i]), y + len(b_bytes[j])
            if ea <= eb:
                left.append(a[i])
                i, x = i + 1, ea
            if eb <= ea:
                right.append(b[j])
                j, y = j + 1, eb
            if ea == eb:
                groups.append((left, right))
                left, right = [], []
        return len(a), len(b), groups, links


def plain_rows(texts):
    plain = Plain()
    done = {t: plain.one(t) for t in set(texts)}
    count = Counter(pair for t in texts for pair in set(done[t][3]))
    most = defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    out = []
    for t in texts:
        n_a, n_b, groups, links = done[t]
        written = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((n_a, n_b, len(groups), len(links), sum(count[p] == most[p[0]] for p in links), sum(count[p] for p in links), written))
    return out


FIELDS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]


@pytest.mark.parametrize("bound", [1 << 26, 0])  # looked up, joined
def test_rows_equal_the_plain_version(spark, bound):
    docs = spark.createDataFrame([(i, t, "x", i) for i, t in enumerate(TEXTS)], "doc_id long, text string, digest string, n_a long").repartition(3)
    got = {r.doc_id: tuple(r[f] for f in FIELDS) for r in align.cross_align(docs, A_FILE, B_FILE, broadcast_bytes=bound).collect()}
    assert got == dict(enumerate(plain_rows(TEXTS)))
    assert got[9] == (0, 0, 0, 0, 0, 0, "") and got[8][0] > 0  # U+2581 in the text; special tokens' strings are plain text


def test_repeated_rows_null_ids_and_an_empty_table(spark):
    docs = spark.createDataFrame([(1, "same"), (1, "same"), (None, "same"), (2, None)], "doc_id long, text string")
    out = align.cross_align(docs, A_FILE, B_FILE)
    rows = out.collect()
    assert sorted((r.doc_id is None, r.doc_id, r.n_a > 0) for r in rows if r.doc_id is not None) == [(False, 1, True)] * 2 + [(False, 2, False)]
    assert len(rows) == 4 and {r.count_sum for r in rows if r.n_a} == {3 * rows[0].n_links or 3}
    assert align.cross_align(docs.where("false"), A_FILE, B_FILE).count() == 0
    assert align.cross_align(docs.where("doc_id = 2"), A_FILE, B_FILE).first().groups == ""


def test_the_query_over_the_whole_table(spark):
    docs = pq.read_table(f"{SF001}/documents.parquet", columns=["doc_id", "text"])
    ids, texts = (docs.column(i).to_pylist() for i in (0, 1))
    expected = {i: (*r[:6], hashlib.sha256(r[6].encode()).hexdigest() if r[6] else "") for i, r in zip(ids, plain_rows(texts))}
    out = QUERIES["op13_cross_align"](spark, SF001)
    assert out.columns == ["doc_id", *FIELDS[:6], "groups_sha256"]
    assert {r.doc_id: tuple(r)[1:] for r in out.collect()} == expected


def test_each_distinct_text_is_aligned_once(spark):
    docs = spark.createDataFrame([(i, TEXTS[i % 3]) for i in range(300)], "doc_id long, text string")
    rows = align.align_texts(docs, A_FILE, B_FILE).collect()
    assert sorted(r.copies for r in rows) == [100, 200]


@pytest.fixture(scope="module")
def both():
    with open(A_FILE, encoding="utf-8") as f, open(B_FILE, "rb") as g:
        return align.Aligner(f.read(), g.read()), Plain()


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("abtheTHE '.,!12éÉß\n\t  一😀<|>▁ﬁ")), max_size=80))
def test_alignment_equals_the_plain_one(both, text):
    aligner, plain = both
    n, links, times, written = aligner.align(text)
    n_a, n_b, groups, pairs = plain.one(text)
    assert n == [n_a, n_b, len(groups), len(pairs)]
    assert {(int(k) >> 32, int(k) & 0xFFFFFFFF): int(v) for k, v in zip(links, times)} == Counter(pairs)
    assert written == ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)


def test_slices_are_bounded_in_bytes():
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * 1000] * 100 + ["y" * 50_000] + ["z"] * 3)], ["t"])
    parts = list(slices(batch, rows=64, size=20_000))
    assert sum(p.num_rows for p in parts) == 104 and all(p.num_rows == 1 or p.nbytes <= 20_000 for p in parts)
    assert pa.Table.from_batches(parts)["t"].to_pylist() == batch.column(0).to_pylist()
