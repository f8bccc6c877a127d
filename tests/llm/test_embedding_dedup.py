import math

import brute
import numpy as np
import pytest

from tessera.llm import embedding_dedup as E

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute_force(rows, cosine):
    usable = {}
    for i, (_, vector, label) in enumerate(rows):
        if label is None or not vector or any(x is None or not math.isfinite(x) for x in vector):
            continue
        array = np.array(vector, np.float32).astype(float)
        if array.any():
            usable[i] = (label, array / np.sqrt((array / abs(array).max()) ** 2 @ np.ones(
                len(array))) / abs(array).max())
    links = [
        (a, b) for a in usable for b in usable
        if a != b and usable[a][0] == usable[b][0] and len(usable[a][1]) == len(usable[b][1])
        and usable[a][1] @ usable[b][1] >= cosine
    ]
    found = brute.groups(range(len(rows)), links)
    out = []
    for i, row in enumerate(rows):
        ids = [r[0] for j, r in enumerate(rows) if found[j] == found[i] and r[0] is not None]
        least = min(ids) if ids else None
        out.append((row[0], sum(a == i for a, _ in links), least, row[0] == least))
    return sorted(out, key=repr)


def vectors(seed, n, size, noise):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((n // 6, size))
    rows = []
    for i in range(n):
        centre = centres[rng.integers(len(centres))]
        vector = centre + noise * rng.standard_normal(size) * rng.random()
        rows.append((i, (vector * rng.choice([0.1, 1, 50])).tolist(), int(rng.integers(3))))
    return rows


@pytest.mark.parametrize("size, cell_rows", [(64, 2), (8, 8), (1, 4), (3, 1)])
def test_same_as_brute_force(spark, rows_of, size, cell_rows):
    rows = vectors(size, 240, size, 0.25)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as node", "2 as links")
    got = rows_of(E.similar_vectors(df, cell_rows=cell_rows))
    assert got == brute_force(rows, 0.98)


def test_blocks(spark, rows_of, monkeypatch):
    monkeypatch.setattr(E, "INDEX_BLOCK", 5)
    monkeypatch.setattr(E, "QUERY_BLOCK", 3)
    rows = vectors(9, 150, 16, 0.15)
    got = rows_of(E.similar_vectors(spark.createDataFrame(rows, SCHEMA)))
    assert got == brute_force(rows, 0.98)


def test_nulls_ties_and_repeated_rows(spark, rows_of):
    nan = float("nan")
    rows = [(5, [1.0, 2.0], 1), (3, [1.0, 2.0], 1), (3, [1.0, 2.0], 1), (4, [2.0, 4.0], 1),
            (1, [1.0, 2.0], 2), (2, [1.0, 2.0], None), (6, None, 1), (7, [0.0, -0.0], 1),
            (8, [nan, 1.0], 1), (9, [None, 1.0], 1), (10, [float("inf"), 1.0], 1), (11, [], 1),
            (None, [1.0, 2.0], 1), (12, [1.0, 2.0, 0.0], 1), (13, [1e38, 2e38], 1),
            (14, [0.0, 1.0], 1), (15, [-0.0, 1.0], 1)]
    got = rows_of(E.similar_vectors(spark.createDataFrame(rows, SCHEMA)))
    want = brute_force(rows, 0.98)
    plain = [r for r in want if r[0] is not None]
    assert [r for r in got if r[0] is not None] == plain
    assert [r for r in got if r[0] is None] == [(None, 5, 3, False)]
    assert E.similar_vectors(spark.createDataFrame([], SCHEMA)).collect() == []


def test_traversal_visits_the_nearest_cells_first():
    rng = np.random.default_rng(0)
    one, two = rng.random(9), rng.random(7)
    radius = 0.8
    cells = list(E.visit(one, two, radius))
    bounds = [one[a] ** 2 + two[b] ** 2 for a, b in cells]
    assert bounds == sorted(bounds)
    every = {(a, b) for a in range(9) for b in range(7) if one[a] ** 2 + two[b] ** 2 <= radius**2}
    assert set(cells) == every and len(cells) == len(every)


def test_recall_of_a_smaller_radius(spark):
    rows = vectors(3, 400, 32, 0.1)
    df = spark.createDataFrame(rows, SCHEMA)
    want = sum(r[1] for r in brute_force(rows, 0.98))
    got = sum(r["n_links"] for r in E.similar_vectors(df, target_recall=0.9).collect())
    assert 0.9 * want <= got <= want
