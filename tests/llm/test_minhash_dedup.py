import random

import brute
import numpy as np
import pytest

from tessera.llm import minhash_dedup as M
from tessera.llm.components import connected


def near_copies(seed, groups, size):
    rnd = random.Random(seed)
    rows, at = [], 0
    for _ in range(groups):
        words = [f"w{rnd.randint(0, 4000)}" for _ in range(rnd.randint(3, 60))]
        for _ in range(rnd.randint(1, size)):
            copy = list(words)
            for _ in range(rnd.choice([0, 0, 1, 1, 2])):
                copy[rnd.randrange(len(copy))] = f"v{rnd.randint(0, 9999)}"
            rows.append((at, "  ".join(copy) if rnd.random() < 0.5 else "\n".join(copy).upper()))
            at += 1
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("members", [2, 1024])
def test_same_as_brute_force(docs, rows_of, members):
    rows = near_copies(members, 25, 12)
    got = rows_of(M.near_duplicates(docs(rows), block_members=members))
    assert got == sorted(brute.near_duplicates(rows), key=repr)


def test_a_hot_bucket_whose_first_class_links_with_few(docs, rows_of):
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(40)]
    rows = []
    for i in range(120):  # copies of one text at a similarity about the threshold
        copy = list(words)
        copy[rnd.randrange(40)] = f"x{i}"
        rows.append((i, " ".join(copy)))
    got = rows_of(M.near_duplicates(docs(rows), block_members=16))
    assert got == sorted(brute.near_duplicates(rows), key=repr)


def family(n, seed=9):
    """Texts of one family, any two about as similar as the threshold, most just below."""
    rnd = random.Random(seed)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(n):
        copy = list(base)
        for place in rnd.sample(range(120), 2):
            copy[place] = f"x{i}-{place}"
        rows.append((i, " ".join(copy)))
    return rows


def test_links_of_a_block_grow_no_faster_than_its_texts(docs, monkeypatch):
    out = {}
    whole = M.stored

    def spy(df):
        written = whole(df)
        if written.columns == ["a", "b"]:
            out.setdefault(size, []).append(written.count())
        return written

    monkeypatch.setattr(M, "stored", spy)
    for size in (100, 200, 400):
        M.near_duplicates(docs(family(size))).count()
    # The star's pairs, its links, and the links of blocks: each a few per text and band.
    assert all(count <= M.BANDS * size for size, counts in out.items() for count in counts)
    assert sum(out[400]) <= 3 * sum(out[200]) <= 9 * sum(out[100])


@pytest.mark.parametrize("shingles", [300, 1 << 21])
def test_families_about_the_threshold(docs, rows_of, shingles):
    rows = family(150)
    got = rows_of(M.near_duplicates(docs(rows), block_members=40, block_shingles=shingles))
    assert got == sorted(brute.near_duplicates(rows), key=repr)


def test_intersections_by_bits(monkeypatch):
    monkeypatch.setattr(M, "SHARED_AT_ONCE", 64)
    random_ = np.random.default_rng(1)
    sets = [np.unique(random_.integers(0, 900, random_.integers(1, 400), dtype=np.uint64))
            for _ in range(30)]
    x, y = (a.ravel() for a in np.meshgrid(np.arange(30), np.arange(30)))
    want = [len(np.intersect1d(sets[i], sets[j])) for i, j in zip(x, y, strict=True)]
    different = x != y  # an element of one set alone is not shared
    assert (M.shared_counts(sets)(x, y)[different] == np.array(want)[different]).all()


def test_one_text_per_class(docs):
    rows = [(None, "one two three four five six")] * 30 + [(1, "one two three four five six seven")]
    table = docs(rows).selectExpr("doc_id", "text", "coalesce(doc_id, 99) as order_id",
                                  "xxhash64(text) as key").withColumnRenamed("key", "text_key")
    holder = table.selectExpr("xxhash64(text) as node", "order_id", "text_key").distinct()
    plain = table.select("doc_id", "text", "order_id", "text_key")
    assert M._texts_of(holder, plain, 5).count() == 2


def test_nulls_ties_and_repeated_rows(docs, rows_of):
    text = "one two three four five six"
    rows = [(7, text), (3, text.upper()), (3, text.upper()), (None, text), (1, None), (2, ""),
            (4, " \t\n"), (5, "one two"), (6, "ONE\ttwo"), (8, text + " " + "seven " * 200)]
    got = rows_of(M.near_duplicates(docs(rows)))
    assert got == sorted([
        (7, 2, 3, False), (3, 2, 3, True), (3, 2, 3, True), (None, 2, 3, False),
        (1, 0, 1, True), (2, 0, 2, True), (4, 0, 4, True), (5, 1, 5, True), (6, 1, 5, False),
        (8, len(brute.shingles(rows[-1][1])), 8, True),
    ], key=repr)
    assert rows_of(M.near_duplicates(docs([(None, text), (None, text)]))) == [
        (None, 2, None, True)] * 2


def test_empty_table(docs):
    assert M.near_duplicates(docs([])).collect() == []


def test_components_of_random_graphs(spark):
    rnd = random.Random(2)
    for nodes, edges in ((30, 15), (200, 150), (50, 400)):
        links = [(rnd.randrange(nodes), rnd.randrange(nodes)) for _ in range(edges)]
        links += [(i, i + 1) for i in range(1000, 1040)]  # a chain
        touched = {n for a, b in links if a != b for n in (a, b)}
        want = brute.groups(touched, [link for link in links if link[0] != link[1]])
        got = connected(spark.createDataFrame(links, "a long, b long"))
        assert {r["node"]: r["component"] for r in got.collect()} == want
    assert connected(spark.createDataFrame([], "a long, b long")).collect() == []


def test_one_row_of_each_group_stays(docs):
    text = "one two three four five six seven eight nine ten"
    own = "a text that is quite unlike the other one here"
    rows = [(5, text, "en"), (5, text, "en"), (5, text, "de"), (None, text), (None, text),
            (7, text + " eleven"), (5, own), (None, own + " b"), (None, own + " b"),
            (8, None), (8, None), (9, " "), (9, " "), (None, "alone and null")]
    got = M.one_of_each_group(docs(rows))
    assert got.columns == docs(rows).columns
    found = sorted(((r["doc_id"], r["text"], r["lang"]) for r in got.collect()), key=repr)
    want = [(5, text, "de"), (5, own, None), (8, None, None), (8, None, None),
            (9, " ", None), (9, " ", None), (None, "alone and null", None)]
    assert found == sorted(want, key=repr)
    assert M.one_of_each_group(docs([])).collect() == []
