import math

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import language_id as L
from tessera.llm.common import read_table
from tessera.llm.queries import op7_language_id

SF = "/root/testdata/sf0.01"


def test_gradients():
    rng = np.random.default_rng(0)
    hidden = 3

    def direction():
        return L.Direction(rng.standard_normal((256, 3 * hidden)),
                           rng.standard_normal((hidden, 3 * hidden)))

    network = L.Network(["a", "b"], direction(), direction(),
                        rng.standard_normal((2 * hidden, 2)), rng.standard_normal(2))
    data = rng.integers(0, 256, (4, 5)).astype(np.uint8)
    labels = np.array([0, 1, 1, 0])

    def loss():
        return -np.log(network.label(data)[:, np.arange(4), labels]).mean()

    for weight, slope in zip(network._weights(), network.gradients(data, labels), strict=True):
        for _ in range(6):
            at = np.unravel_index(rng.choice(np.flatnonzero(slope)), slope.shape)
            before, step = weight[at], 1e-3
            weight[at] = before + step
            more = loss()
            weight[at] = before - step
            less = loss()
            weight[at] = before
            assert (more - less) / (2 * step) == pytest.approx(slope[at], rel=1e-3, abs=1e-6)


def test_words_are_judged_as_when_read_alone():
    samples = [("x", b"abc abd aab "), ("y", b"xyz xzz yyx ")] * 5
    network = L.train(samples, steps=40)
    labeller = L.Labeller(network)
    texts = ["abc  xyz\nabd", "zzz " + "q" * 100, "123", "", None, "1 a"]
    got = labeller.judge(texts)
    for text, (language, score) in zip(texts, got, strict=True):
        if not L.has_letter(text):
            assert (language, score) == ("und", 0.0)
            continue
        total = sum(
            network.label(L._matrix([p])).sum(axis=(0, 1)) for p in L.pieces(text.encode())
        )
        assert language == network.languages[int(total.argmax())]
        assert score == pytest.approx(total.max() / total.sum(), rel=1e-5)
    assert b"".join(L.pieces(b"q" * 100)) == b"q" * 100
    assert labeller.judge(texts) == got


def sigmoid(x):
    return 1 / (1 + math.exp(-x))


def plain_states(layer, data):
    """The states after every byte, by one loop per unit."""
    units = len(layer.recurrent)
    state, found = [0.0] * units, []
    for byte in data:
        given = [float(x) for x in layer.inputs[byte]]
        own = [
            sum(state[k] * float(layer.recurrent[k, c]) for k in range(units))
            for c in range(3 * units)
        ]
        after = []
        for u in range(units):
            update = sigmoid(given[u] + own[u])
            reset = sigmoid(given[units + u] + own[units + u])
            fresh = math.tanh(given[2 * units + u] + reset * own[2 * units + u])
            after.append(update * state[u] + (1 - update) * fresh)
        state = after
        found.append(state)
    return found


def plain_label(network, text):
    """Mean probabilities of the languages over all bytes of all words."""
    total = [0.0] * len(network.languages)
    for word in text.encode().split():
        data = b" " + word
        ahead = plain_states(network.forward, data)
        back = plain_states(network.backward, data[::-1])[::-1]
        for one, other in zip(ahead, back, strict=True):
            both = [*one, *other]
            raw = [
                math.exp(float(network.bias[k])
                         + sum(v * float(network.output[i, k]) for i, v in enumerate(both)))
                for k in range(len(total))
            ]
            total = [t + r / sum(raw) for t, r in zip(total, raw, strict=True)]
    return [t / sum(total) for t in total]


def test_query_is_a_plain_loop_over_the_network(spark):
    docs = read_table(spark, SF, "documents")
    learn = ~L.held_out(F.col("doc_id"), 4, 2)
    network = L.train(L.sample_of(docs, learn, "doc_id", "text", "lang", L.SAMPLE_ROWS))
    short = [
        r for r in docs.filter("length(text) < 400").orderBy("doc_id").collect()
        if L.has_letter(r["text"]) and max(map(len, r["text"].encode().split())) <= L.PIECE
    ][:12]
    got = {r["doc_id"]: r for r in op7_language_id(spark, SF).collect()}
    assert len(short) == 12
    for row in short:
        wanted = plain_label(network, row["text"])
        found = got[row["doc_id"]]
        assert found["lang_pred"] == network.languages[wanted.index(max(wanted))]
        assert found["score"] == pytest.approx(max(wanted), rel=1e-3)


def test_pieces_keep_characters_whole():
    text = "語" * 100 + " " + "é" * 41 + " " + "a" * 70 + " x"
    cut = L.pieces(text.encode())
    assert b"".join(cut) == text.replace(" ", "").encode()
    assert all(0 < len(piece) <= L.PIECE and piece.decode() for piece in cut)
    assert L.pieces(b"\x80" * 70) and b"".join(L.pieces(b"\x80" * 70)) == b"\x80" * 70


def test_the_network_grows_without_a_step():
    sizes = [L.network_size(n) for n in range(1, 400)]
    assert sizes[3] == (8, 300) and L.network_size(250) == (20, 1195)
    assert all(0 <= b[0] - a[0] <= 2 for a, b in zip(sizes[1:], sizes[2:], strict=False))


def test_held_out_accuracy(spark):
    docs = read_table(spark, SF, "documents")
    held_out = L.held_out(F.col("doc_id"), 4, 2)
    judged = L.identify_languages(docs, ~held_out, carry=("lang",)).withColumn("out", held_out)
    rows = judged.collect()
    assert len(rows) == docs.count()
    assert all(r["out"] == brute.in_fold(r["doc_id"], 4, 2) for r in rows)
    out = [r for r in rows if r["out"]]
    assert len(out) > 100
    assert sum(r["lang_pred"] == r["lang"] for r in out) >= 0.97 * len(out)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_the_sample_draws_on_id_and_text(docs):
    rows = [(None, f"word{i} abc", "de") for i in range(300)] + [(7, "same text", "en")] * 300
    drawn = L.sample_of(docs(rows), F.lit(True), "doc_id", "text", "lang", 20)
    assert 5 <= sum(language == "de" for language, _ in drawn) <= 40
    assert sum(language == "en" for language, _ in drawn) == 1


def test_every_language_is_learned(docs, rows_of):
    rows = [(i, f"{chr(0x4E00 + i % 230)} " * 3, f"l{i % 230:03d}") for i in range(460)]
    rows += [(1000 + i, "abc abc", "common") for i in range(40)]
    table = docs(rows)
    drawn = L.sample_of(table, F.lit(True), "doc_id", "text", "lang", 10)
    assert {language for language, _ in drawn} == {r[2] for r in rows}
    network = L.train(drawn, steps=5)
    assert network.languages == sorted({r[2] for r in rows})
    small = L.drawn_words("a bb ccc " * 100, 7, -5)
    assert len(small.split()) == 7 and small == L.drawn_words("a bb ccc " * 100, 7, -5)


def test_only_drawn_words_come_to_the_driver(docs):
    rows = [(1, "wort " * 50_000, "de"), (2, "x" * 500_000, "en")]
    drawn = dict(L.sample_of(docs(rows), F.lit(True), "doc_id", "text", "lang", 20))
    assert drawn["de"].split() == [b"wort"] * L.WORDS_PER_ROW
    assert len(drawn["en"]) < L.WORDS_PER_ROW * (L.PIECE + 1)


def test_edges(docs, rows_of):
    rows = [(1, "guten tag", "de"), (2, "good day", "en"), (3, None, "en"), (4, "12 !", "en"),
            (5, "", None), (None, "good", None), (2, "good day", "en"), (6, "x" * 50_000, None)]
    got = rows_of(L.identify_languages(docs(rows), F.lit(True)))
    assert len(got) == len(rows)
    by_id = {r[0]: r for r in got}
    assert all(by_id[i][1:] == ("und", 0.0) for i in (3, 4, 5))
    assert {by_id[i][1] for i in (1, 2, 6, None)} <= {"de", "en"}
    nothing = L.identify_languages(docs([(1, "abc", None)]), F.lit(True)).collect()
    assert [tuple(r) for r in nothing] == [(1, "und", 0.0)]
    assert L.identify_languages(docs([]), F.lit(True)).collect() == []
