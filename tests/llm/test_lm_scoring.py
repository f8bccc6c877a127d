import random

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.llm import lm_scoring as M
from tessera.llm.language_id import held_out


def texts(seed, n):
    rnd = random.Random(seed)
    words = ["the", "The", "a", "cat", "sat", "é", "on", "mat.", "漢", "x" * 30]
    return [" ".join(rnd.choice(words[: rnd.randint(2, 10)]) for _ in range(rnd.randint(0, 30)))
            for _ in range(n)]


@pytest.mark.parametrize("order, block_bytes", [(2, 100), (5, 1 << 20)])
def test_same_as_brute_force(docs, order, block_bytes):
    rows = [*enumerate(texts(order, 40)), (100, None), (101, ""), (102, " \n\t"),
            (None, "a cat"), (3, "the mat"), (103, "new words! " * 200)]
    model = brute.ByteModel([t for i, t in rows if not brute.in_fold(i, 5, 1)], order)
    scored = M.score_texts(
        docs(rows), ~held_out(F.col("doc_id"), 5, 1), order=order, block_bytes=block_bytes
    ).collect()
    assert len(scored) == len(rows)
    want = sorted(
        ((i, not brute.in_fold(i, 5, 1), *model.base(t), model.score(t)) for i, t in rows),
        key=repr,
    )
    got = sorted(
        ((r["doc_id"], r["learned"], r["n_tokens"], r["n_known"], r["base_score"], r["score"])
         for r in scored), key=repr)
    for a, b in zip(got, want, strict=True):
        assert a[:4] == b[:4]
        assert a[4:] == pytest.approx(b[4:], rel=1e-6)
    assert {r["train_tokens"] for r in scored} == {model.tokens}


def test_probabilities_add_up_to_one():
    """Over all symbols, in contexts that were seen at several lengths or not at all."""
    order = 3
    grams, counts = np.unique(
        M.grams_of([t.encode() for t in texts(1, 30)], order)[0], return_counts=True)
    pairs = np.zeros((M.SYMBOLS, M.SYMBOLS), np.int64)
    np.add.at(pairs, (grams >> M.BITS & M.MASK, grams & M.MASK), counts)
    contexts = [int(g) >> M.BITS << M.BITS for g in grams[:: len(grams) // 9]] + [
        int.from_bytes(b"zz") << 2 * M.BITS]
    for context in contexts:
        asked = context + np.arange(M.SYMBOLS)
        keys, sums = M.merged([grams, asked], [counts, np.zeros_like(asked)])
        lengths = M.code_lengths(keys, sums, pairs, order)
        total = (10.0 ** lengths[np.searchsorted(keys, asked)]).sum()
        assert total == pytest.approx(1, abs=1e-9)


def test_nothing_to_learn_from(docs):
    rows = M.score_texts(docs([(1, "ab"), (2, None)]), F.lit(False)).collect()
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[1]["score"] == pytest.approx(-3 * np.log10(257))
    assert (by_id[2]["n_tokens"], by_id[2]["n_known"], by_id[2]["train_tokens"]) == (1, 0, 0)
    assert by_id[2]["base_score"] == pytest.approx(0)
    assert M.score_texts(docs([]), F.lit(True)).collect() == []


def test_words_and_grams_as_plain_loops_find_them():
    cases = [["", " ", "a", "\x0b\x0cé x\t", "x  a", "\x1c\x85\xa0"], [""], ["\n"], texts(2, 30)]
    for own in ([t.encode() for t in case] for case in cases):
        places, words, numbers = M.words_in(own)
        assert [words[i] for i in places] == [w for t in own for w in t.split()]
        assert len(set(words)) == len(words)
        assert numbers.tolist() == [len(t.split()) for t in own]
        want = []
        for text in own:
            symbols = [M.EDGE] * 5 + list(text) + [M.EDGE]
            want += [sum(symbols[i - b] << M.BITS * b for b in range(6))
                     for i in range(5, len(symbols))]
        assert M.grams_in(own, 5).tolist() == want


def test_scores_sort_and_search_distinct_grams_only(monkeypatch):
    """A block's symbols are looked up in one table; what is sorted or searched are its distinct
    grams and words, however often they occur."""
    own = texts(3, 20) * 50
    table = pa.table({
        "block": pa.array([0] * len(own), pa.int32()), "doc_id": list(range(len(own))),
        "text": own, "learn": [True] * len(own),
    })
    features = M._features(5, 3)(table).to_pylist()
    values = M._packed(M.VALUES, [
        (0, r["part"], M.pack(M.unpack(r["word_counts"], np.int64), np.int64),
         M.pack(-np.ones(len(M.unpack(r["grams"], np.int64))), np.float32), 0, 0)
        for r in features
    ])
    sizes = []

    def watched(name, of):
        plain = getattr(np, name)

        def run(*args, **kwargs):
            sizes.append(len(args[of]))
            return plain(*args, **kwargs)

        monkeypatch.setattr(np, name, run)

    watched("argsort", 0)
    watched("searchsorted", 1)
    scores = M._scores(5, 3, 1000, 100)(table, values)
    symbols = sum(len(t.encode()) + 1 for t in own)
    distinct = sum(len(M.unpack(r["grams"], np.int64)) for r in features)
    assert scores.column("score").to_pylist() == [-(len(t.encode()) + 1.0) for t in own]
    assert symbols > 10 * distinct
    assert max(sizes) <= max(distinct, len(own))
