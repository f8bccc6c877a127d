import random
from itertools import permutations

import brute
import pytest

from tessera.llm import filter_audit as A

MARKS = "doc_id long, quality int, toxic int"


def test_ranks_are_lexicographic():
    for n in (1, 2, 5):
        orders = list(permutations(range(n)))
        assert [A.lehmer_rank(order, n) for order in orders] == list(range(len(orders)))
        for step, start, end, item, before in A.intervals(n):
            inside = [r for r, order in enumerate(orders) if order[step] == item
                      and sum(1 << i for i in order[:step]) == before]
            assert set(range(start, end)) <= set(inside)
        whole = [(s, r) for s, a, b, _, _ in A.intervals(n) for r in range(a, b)]
        assert len(whole) == len(set(whole)) == n * len(orders)


def rows(seed, n=150):
    rnd = random.Random(seed)
    words = ["Ab", "cd", "EFG", "h#", "ij", "é", "k|"]
    texts = [None, "", " \t", "A" * 5000, "x " * 300]
    texts += [" ".join(rnd.choice(words) + str(rnd.randint(0, 300)) * rnd.randint(0, 1)
                       for _ in range(rnd.randint(1, 400))) for _ in range(n)]
    docs = [(rnd.choice([i, i, None, 7]), rnd.choice(texts), rnd.choice(["en", "de", None, ""]))
            for i in range(2 * n)]
    labels = [(rnd.randint(0, 2 * n), rnd.choice([0, 1, None]), rnd.choice([0, 1, None]))
              for _ in range(n)] + [(None, 1, 1), (7, 1, 0), (7, 0, 1)]
    return docs, labels


@pytest.mark.parametrize("seed", [1, 2])
def test_same_as_every_order_by_hand(spark, docs, rows_of, seed):
    texts, marks = rows(seed)
    labels = spark.createDataFrame(marks, MARKS).selectExpr("*", "'own' as docs", "1 as mask")
    got = A.audit_filters(docs(texts).selectExpr("*", "'own' as digest"), labels)
    assert rows_of(got) == brute.audit(texts, marks)


def test_few_filters_and_wrong_names(spark, rows_of):
    cells = spark.createDataFrame([("p", 3, 5, 2, 1), ("p", 2, 1, 0, 0), ("p", 0, 4, 4, 0)],
                                  "part string, mask int, docs long, good long, toxic long")
    assert rows_of(A.audit_orders(cells, "XY")) == [
        ("p", "XY", 1, 5, 5, 0, 0, 2, 1, 5), ("p", "XY", 2, 4, 1, 5, 1, 0, 0, 7),
        ("p", "YX", 1, 4, 6, 0, 1, 2, 1, 7), ("p", "YX", 2, 4, 0, 5, 0, 0, 0, 5),
    ]
    for wrong in ("", "XX", "ABCDEFG"):
        with pytest.raises(ValueError):
            A.audit_orders(cells, wrong)


def test_empty_tables(spark, docs):
    labels = spark.createDataFrame([], MARKS)
    assert A.audit_filters(docs([]), labels).collect() == []
    found = A.audit_filters(docs([(1, None)]), labels).collect()
    assert len(found) == 600 and {r["part"] for r in found} == {""}
    assert sum(r["removed"] for r in found) == 120  # an empty text fails A alone
