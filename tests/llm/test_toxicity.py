import math
import os
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import queries, toxicity
from tessera.llm.hashing import Hasher

MARKS = "doc_id long, quality int, toxic int"


def plain_features(text):
    """The features by name."""
    import re

    words = re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").encode().lower())
    found = [("word", w) for w in words] + [("stem", w[: toxicity.STEM]) for w in words]
    for gap in (1, 2, 3):
        found += [(gap, a, b) for a, b in zip(words, words[gap:], strict=False)]
    return found


def test_features_are_those_by_name():
    rnd = random.Random(3)
    hasher, known = Hasher(), {}
    texts = [" ".join(rnd.choice(["Ab", "cdefgh", "é", "1x"]) for _ in range(rnd.randint(0, 9)))
             for _ in range(60)] + [None, "", "!?", "a", "a-b", "longer longest long"]
    for text in texts:
        numbers = toxicity.features(text, hasher)
        names = plain_features(text)
        assert len(numbers) == len(names)
        for name, number in zip(names, numbers.tolist(), strict=True):
            assert known.setdefault(name, number) == number
    assert len(set(known.values())) == len(known)


def test_learner_is_the_plain_rule(monkeypatch):
    monkeypatch.setattr(toxicity, "BUCKETS", 20)
    rnd = random.Random(4)
    learner = toxicity.Learner(alpha=0.5, beta=1.0, l1=0.3, l2=0.7)
    z, n = [0.0] * 21, [0.0] * 21

    def weight(i):
        least = 0 if i == 20 else 0.3
        if abs(z[i]) <= least:
            return 0.0
        return -(z[i] - math.copysign(least, z[i])) / ((1 + math.sqrt(n[i])) / 0.5 + 0.7)

    for _ in range(300):
        found = [*sorted(rnd.sample(range(20), 5)), 20]
        toxic = int(3 in found)
        learner.learn(np.array(found), toxic)
        g = 1 / (1 + math.exp(-sum(map(weight, found)))) - toxic
        for i, w in [(i, weight(i)) for i in found]:
            z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / 0.5 * w
            n[i] += g * g
    model = learner.model()
    assert model.places.tolist() == [i for i in range(20) if abs(z[i]) > 0.3]
    assert np.allclose(model.weights, [weight(i) for i in model.places])
    assert model.bias == pytest.approx(weight(20)) and 0 < len(model.places)


def corpus(n=400):
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    rows, marks = [], []
    for i in range(n):
        text = [rnd.choice(words) for _ in range(rnd.randint(5, 60))]
        toxic = i % 7 == 0
        for _ in range(3 if toxic else 0):
            text[rnd.randrange(len(text))] = rnd.choice(["vile", "foul"])
        rows.append((i, " ".join(text)))
        marks.append((i, 1, int(toxic)))
    return rows, marks


def test_learns_from_allowed_labels_only(spark, docs):
    rows, marks = corpus()
    learn = F.col("doc_id") % 4 != 2
    held = [(i, q, t) if i % 4 != 2 else (i, q, 1 - t) for i, q, t in marks]  # must not matter
    first = toxicity.toxicity(docs(rows), spark.createDataFrame(marks, MARKS), learn)
    again = toxicity.toxicity(docs(rows, parts=5), spark.createDataFrame(held, MARKS), learn)
    assert sorted(first.collect()) == sorted(again.collect())
    good = {r["doc_id"]: r["predicted"] for r in first.collect()}
    assert all(good[i] == t for i, _, t in marks if i % 4 == 2)
    small = toxicity.toxicity(docs(rows), spark.createDataFrame(marks, MARKS), learn,
                              sample_rows=30)
    hits = [r["predicted"] == marks[r["doc_id"]][2] for r in small.collect()]
    assert sum(hits) > 0.9 * len(hits)


def test_awkward_rows(spark, docs):
    rows, marks = corpus(80)
    rows += [(900, None), (901, ""), (902, "!!"), (None, "vile foul"), (3, rows[3][1]),
             (903, "vile " * 50_000)]
    marks += [(None, 1, 1), (5, 1, None), (900, 1, 0), (0, 0, 0), (0, 1, 1), (7777, 1, 1)]
    labels = spark.createDataFrame(marks, MARKS).selectExpr("*", "'own' as draw", "'x' as label_id")
    found = toxicity.toxicity(docs(rows), labels, F.lit(True)).collect()
    assert len(found) == len(rows) and all(0 <= r["score"] <= 1 for r in found)
    scores = {r["doc_id"]: r["score"] for r in found}
    assert scores[900] == scores[901] == scores[902] < 0.3 < scores[None]
    assert scores[903] > 0.3
    nothing = toxicity.toxicity(docs(rows), labels, F.lit(False)).collect()
    assert {(r["score"], r["predicted"]) for r in nothing} == {(0.0, 0)}
    assert toxicity.toxicity(docs([]), labels, F.lit(True)).collect() == []
    one = spark.createDataFrame([(i, 1, 0) for i in range(40)], MARKS)
    assert {r["predicted"] for r in toxicity.toxicity(docs(rows), one, F.lit(True)).collect()} == {0}


SF = "/root/testdata/sf0.1"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_held_out_accuracy(spark):
    found = {r["doc_id"]: r for r in queries.queries()["op12_toxicity"](spark, SF).collect()}
    marks = duckdb.sql(f"SELECT doc_id, toxic FROM '{SF}/labels.parquet' JOIN "
                       f"'{SF}/documents.parquet' USING (doc_id) WHERE lang = 'en'").fetchall()
    held = [(found[i]["predicted"], t) for i, t in marks if found[i]["held_out"]]
    caught = [p for p, t in held if t == 1]
    clean = [p for p, t in held if t == 0]
    assert len(caught) > 50 and sum(caught) > 0.88 * len(caught)
    assert sum(clean) < 0.02 * len(clean)
