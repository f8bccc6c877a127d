import random

import brute
import pytest

from tessera.llm import prefix_trie as P

TURNS = "conv_id long, turn long, role string, text string"


def conversations(seed, n=250):
    rnd = random.Random(seed)
    rows = []
    for c in range(-40, n):
        for turn in range(rnd.randint(1, rnd.choice([3, 9, 30]))):
            rows.append((c, rnd.choice([turn, turn, turn, None]), rnd.choice(["u", "a", None]),
                         rnd.choice(["x", "yy", None, "zé"])))
    return rows


@pytest.fixture
def table(spark):
    def build(rows):
        df = spark.createDataFrame(rows, TURNS).repartition(3)
        for name in ("base", "node", "depth", "chain", "first", "low", "convs"):
            df = df.selectExpr("*", f"'own' as {name}")
        return df

    return build


@pytest.mark.parametrize(("first", "growth"), [(4096, 32), (10, 6)])
def test_same_as_brute_force(table, rows_of, monkeypatch, first, growth):
    """In one batch, and in several that meet a trie that is there."""
    monkeypatch.setattr(P, "FIRST_BATCH", first)
    monkeypatch.setattr(P, "GROWTH", growth)
    rows = conversations(first)
    assert rows_of(P.prefix_trie(table(rows), (100, 6))) == brute.trie(rows)


def test_a_stretch_is_split_where_strings_leave_it_or_end(table, rows_of, monkeypatch):
    monkeypatch.setattr(P, "FIRST_BATCH", 1)
    monkeypatch.setattr(P, "GROWTH", 3)
    rows = [(c, t, "u", f"t{t}") for c in range(24) for t in range(c + 1)]  # each begins the next
    rows += [(30 + c, t, "u", "other" if t == c else f"t{t}") for c in range(24) for t in range(24)]
    got = rows_of(P.prefix_trie(table(rows)))
    assert got == brute.trie(rows, limit=1)


def test_copies_long_conversations_and_none(table, rows_of):
    rows = [(c, t, "u", "hello") for c in range(200, 260) for t in range(2)]
    rows += [(1, t, "u", str(t)) for t in range(150)] + [(None, 1, "u", "lost")]
    rows += [(103, 1, "a", "b")] * 3 + [(105, 1, "a", "b")]
    assert rows_of(P.prefix_trie(table(rows), (100, 6))) == brute.trie(rows)
    assert P.prefix_trie(table([])).collect() == []
    assert P.prefix_trie(table([(None, 1, "u", "x")])).collect() == []
    alone = [(103, 1, "a", "b")]  # its first four turns are those of an absent conversation
    assert rows_of(P.prefix_trie(table(alone), (100, 6))) == brute.trie(alone)


def test_groups_stay_small_under_a_shared_beginning(spark, table, monkeypatch):
    """However many strings share a first turn, a batch's strings meet in small groups."""
    monkeypatch.setattr(P, "FIRST_BATCH", 16)
    monkeypatch.setattr(P, "GROWTH", 4)
    rnd = random.Random(8)
    rows = [(c, t, "u", "hot" if t == 0 else str(rnd.random())) for c in range(1500)
            for t in range(3)]
    strings = P.chains(table(rows)).select("node", "depth", "chain")
    batch, trie = strings.limit(300), strings.subtract(strings.limit(300))
    placed = P._located(batch, P.build_trie(trie), 3).groupBy("low").count().collect()
    assert {r["low"] for r in placed} == {1}  # below the node of the hot turn, each by its own


def test_two_fattest():
    for low in range(40):
        for high in range(low + 1, 41):
            want = max(range(low + 1, high + 1), key=lambda n: (n & -n, n))
            assert P.two_fattest(low, high) == want
