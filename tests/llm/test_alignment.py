import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from helpers import awkward, docs
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from conftest import SF_SMALL
from dockhand.llm import alignment, queries
from dockhand.llm.alignment import FIRST, SECOND, Aligner, galloping_intersection, overlap_ranges
from dockhand.llm.tokenizers_io import byte_alphabet

PARTS = [" ", "  ", "\n", "\t", "a", "the", " the", "é", "中", "文字", "▁", "<|endoftext|>", "<s>", "<0x0A>", "'s", "1", "23", "😀",
         "\x00", "ﬁ", "ß", "İ", "‍", "...", " \n ", "tokenizer", "Überraschung"]


class Plain:
    """Both tokenizers by their own libraries, and the contract's columns by plain loops."""

    def __init__(self):
        self.first = Tokenizer.from_file(FIRST)
        self.first.encode_special_tokens = True
        self.second = sentencepiece.SentencePieceProcessor(model_file=SECOND)
        alphabet = byte_alphabet()
        self.a_bytes = {i: bytes(alphabet[c] for c in t) for t, i in self.first.get_vocab().items() if t != "<|endoftext|>"}

    def b_bytes(self, i):
        p = self.second.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if self.second.is_byte(i) else p.replace("▁", " ").encode()

    def groups(self, text):
        if not text:
            return [], [], []
        a, b = self.first.encode(" " + text, add_special_tokens=False).ids, self.second.encode(text)
        parts = [self.a_bytes[i] for i in a], [self.b_bytes(i) for i in b]
        if any(b"".join(p) != (" " + text).encode() for p in parts):
            return [], [], []
        ends = [np.cumsum([len(x) for x in p]).tolist() for p in parts]
        out, i, j = [], 0, 0
        for e in sorted(set(ends[0]) & set(ends[1])):
            k, m = ends[0].index(e) + 1, ends[1].index(e) + 1
            out.append((a[i:k], b[j:m]))
            i, j = k, m
        return a, b, out

    def corpus(self, texts):
        found = [self.groups(t) for t in texts]
        counts = Counter((a[-1], b[-1]) for _, _, g in found for a, b in g)
        top = Counter()
        for (_, b), n in counts.items():
            top[b] = max(top[b], n)
        rows = []
        for a, b, g in found:
            links = [(x[-1], y[-1]) for x, y in g]
            shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)
            rows.append((len(a), len(b), len(g), len(links), sum(counts[p] == top[p[1]] for p in links), sum(counts[p] for p in links),
                         hashlib.sha256(shown.encode()).hexdigest() if g else ""))
        return rows


@pytest.fixture(scope="module")
def plain():
    return Plain()


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def fuzz(n, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choices(PARTS, k=rng.randint(0, 12))) for _ in range(n)]


@settings(max_examples=100, deadline=None)
@given(st.sets(st.integers(0, 60)), st.sets(st.integers(0, 60)), st.integers(1, 5))
def test_galloping_intersection(short, long, block):
    before, alignment.BLOCK = alignment.BLOCK, block
    try:
        short, long = sorted(short), sorted(long)
        i, j = galloping_intersection(np.array(short, np.int64), np.array(long, np.int64))
    finally:
        alignment.BLOCK = before
    shared = sorted(set(short) & set(long))
    assert [short[k] for k in i] == shared and [long[k] for k in j] == shared


def test_overlap_ranges():
    ends, other = np.array([2, 3, 7]), np.array([1, 5, 7])
    first, last = overlap_ranges(ends, other)
    # bytes 0-1 meet tokens 0 and 1, byte 2 token 1, bytes 3-6 tokens 1 and 2
    assert first.tolist() == [0, 1, 1] and last.tolist() == [1, 1, 2]


def test_ids_equal_the_libraries_own(plain):
    aligner = Aligner(*((p, open(p, "rb").read()) for p in (FIRST, SECOND)))
    texts = fuzz(3000)
    for text, (a, b, _, _) in zip(texts, aligner.tokens(texts), strict=True):
        wanted_a, wanted_b, _ = plain.groups(text)
        assert a.tolist() == list(wanted_a) and b.tolist() == list(wanted_b)


def test_corpus_equals_brute_force(spark, plain, monkeypatch):
    texts = fuzz(300) + ["the tokenizer of the text"] * 40 + [None, ""]
    wanted = plain.corpus(texts)
    for hot, size in ((1 << 18, 1 << 16), (20, 3)):  # all pairs broadcast; most pairs joined, long rows in slices
        monkeypatch.setattr(alignment, "HOT", hot)
        monkeypatch.setattr(alignment, "SLICE", size)
        got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in alignment.align_corpus(docs(spark, texts)).collect()}
        assert [got[i] for i in range(len(texts))] == wanted


def test_query_over_the_fixture(spark, plain):
    got = queries.op11_token_alignment(spark, SF_SMALL)
    table = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    wanted = dict(zip((r["doc_id"] for r in table), plain.corpus([r["text"] for r in table]), strict=True))
    assert got.columns == ["doc_id", *COLUMNS]
    assert {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in got.collect()} == wanted


def test_alignment_columns(spark, plain):
    text = "Überraschung 中文"
    row = alignment.align_tokens(docs(spark, [text])).first()
    a, b, groups = plain.groups(text)
    assert row["a_ids"] == a and row["b_ids"] == b
    assert [row["a_ids"][i] for i in row["a_group_ends"]] == [x[-1] for x, _ in groups]
    assert len(row["b_first"]) == len(a) and all(f <= t for f, t in zip(row["b_first"], row["b_last"], strict=True))


def test_awkward_rows(spark):
    table = awkward(spark).selectExpr("*", "'x' as n_a", "1 as pairs", "2 as row_id")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    got = alignment.align_corpus(table).collect()
    assert len(got) == 9
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before
    for r in got:
        if r["doc_id"] in (1, 2):
            assert tuple(r[c] for c in COLUMNS) == (0, 0, 0, 0, 0, 0, "")
        else:
            assert r["n_links"] == r["n_groups"] > 0 and len(r["groups_sha256"]) == 64
    assert alignment.align_corpus(table.where("false")).count() == 0
