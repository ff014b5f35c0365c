import math
import random
import zlib
from collections import Counter

import pytest
import sentencepiece
from helpers import awkward, docs, words

from conftest import SF_MID
from dockhand.llm import lattice, queries
from dockhand.llm.lattice import Lattice, lattice_scores, piece_bytes, weigh


def all_paths(body, weights):
    """Probabilities of all ways to cut ``body`` into pieces."""
    if not body:
        return [0.0]
    return [weights[body[:k]] + x for k in range(1, len(body) + 1) if body[:k] in weights for x in all_paths(body[k:], weights)]


def test_forward_recursion_sums_all_segmentations():
    rng = random.Random(1)
    pieces = [b" ", b"a", b"b", b"ab", b" a", b"aba", b"bb", b" ab", b"ba"]
    field = Lattice({p: math.log(rng.random()) for p in pieces}, -1.0)
    for _ in range(60):
        word = bytes(rng.choices(b"ab", k=rng.randint(1, 9)))
        plain = sum(math.exp(x) for x in all_paths(b" " + word, field.weights))
        assert field.log_probability(word) == pytest.approx(math.log(plain), abs=1e-9)


def test_weights_are_a_distribution():
    pieces = {0: b"a", 1: b"b", 2: b"a", 3: b" "}
    field = weigh(pieces, {0: 5, 2: 1, 99: 7}, 4)
    assert sum(math.exp(x) for x in field.weights.values()) + math.exp(field.end) == pytest.approx(1)
    assert field.weights[b"a"] == pytest.approx(math.log(7 / 12.5))


def plain_scores(table):
    """The contract's columns, with the model fitted over the whole list in one process."""
    held = {i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1 for i, _ in table}
    counts, ends = Counter(), 0
    for i, text in table:
        if not held[i]:
            counts.update(words(text))
            ends += 1
    total, kinds = sum(counts.values()) + ends, len(counts) + (ends > 0)
    model = sentencepiece.SentencePieceProcessor(model_file=lattice.VOCABULARY)
    pieces = Counter()
    for w, c in counts.items():
        for p in model.encode(w):
            pieces[p] += c
    field = weigh(piece_bytes(model), pieces, ends)
    out = []
    for i, text in table:
        ws = words(text)
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in ws) + math.log10((ends + 0.5) / (total + 0.5 * (kinds + 1)))
        score = (sum(field.log_probability(w.encode()) for w in ws) + field.end) / math.log(10)
        out.append((i, held[i], len(ws) + 1, sum(counts[w] > 0 for w in ws) + (ends > 0), total, base, score))
    return out


def same(got, wanted):
    key = lambda r: (r[0] is None, r[0], r[2], r[5])
    got, wanted = sorted((tuple(r) for r in got), key=key), sorted(wanted, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in wanted]
    for g, w in zip(got, wanted, strict=True):
        assert g[5:] == pytest.approx(w[5:], rel=1e-9)


def test_scores_equal_brute_force(spark, monkeypatch):
    rng = random.Random(2)
    texts = [" ".join(rng.choices(["the", "The", "of", "naïve", "中文字", "x1\x1cy", "token", " ", "A"], k=rng.randint(0, 30))) + f" unique{i}"
             for i in range(120)] + [None, "", " \t\n "]
    wanted = plain_scores(list(enumerate(texts)))
    for hot, flush in ((1 << 18, 1 << 17), (6, 4)):  # every word broadcast; most words joined, counts handed on early
        monkeypatch.setattr(lattice, "HOT", hot)
        monkeypatch.setattr(lattice, "FLUSH", flush)
        got = lattice_scores(docs(spark, texts))
        assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
        same(got.collect(), wanted)


def test_query_over_the_fixture(spark):
    got = [tuple(r) for r in queries.op13_subword_lattice(spark, SF_MID).collect()]
    table = spark.read.parquet(f"{SF_MID}/documents.parquet").collect()
    same(got, plain_scores([(r["doc_id"], r["text"]) for r in table]))


def test_random_letters_are_less_likely(spark):
    table = spark.read.parquet(f"{SF_MID}/documents.parquet")
    words = lattice.count_words(table.selectExpr("text", "false as held_out"))
    field = lattice.fit_lattice(words, table.count(), open(lattice.VOCABULARY, "rb").read())
    rng = random.Random(4)
    for word in (b"the", b"thtioner", b"reanst", b"with"):
        drawn = [field.log_probability(bytes(rng.choices(range(97, 123), k=len(word)))) for _ in range(50)]
        assert field.log_probability(word) > sorted(drawn)[45]


def test_awkward_rows(spark):
    table = awkward(spark).selectExpr("* except(score)", "'x' as held_out", "3.0 as score", "1 as word", "2 as n_tokens")
    got = lattice_scores(table).collect()
    assert len(got) == 9 and len(got[0]) == 7
    rows = [(r["doc_id"], r["text"]) for r in table.select("doc_id", "text").collect()]
    same(got, plain_scores(rows))
    assert lattice_scores(table.where("false")).count() == 0


def test_without_training_rows(spark):
    held = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5 == 1]
    table = spark.createDataFrame([(i, "two words") for i in held], "doc_id long, text string")
    for r in lattice_scores(table).collect():
        assert (r["n_known"], r["train_tokens"], r["n_tokens"]) == (0, 0, 3) and r["base_score"] == pytest.approx(0.0)
        assert r["score"] < 0
