"""The registered queries against their SQL, and the pipeline's stages against brute force."""

import os

import brute
import duckdb
import pytest

import corpus_pipeline
from tessera.llm import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{name}'")
    return con


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_is_its_sql(spark, duck, rows_of, name):
    found = queries.queries()[name](spark, SF)
    answer = duck.execute(queries.oracle_sql()[name])
    names = [c[0] for c in answer.description]
    assert sorted(names) == sorted(found.columns)
    expected = sorted(answer.fetchall(), key=repr)
    assert expected and rows_of(found.select(*names)) == expected


def test_one_query_for_each_operator():
    names = sorted(queries.queries(), key=lambda n: int(n[2:].split("_")[0]))
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14))


def test_op9_digests(spark, rows_of):
    import hashlib

    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY 1").fetchall()
    want = []
    for doc_id, data, gone in brute.repeats(rows, 100):
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = hashlib.sha256(brute.kept_bytes(data, gone)).hexdigest()
        want.append((doc_id, len(data), sum(gone), spans, kept))
    assert rows_of(queries.queries()["op9_suffix_dedup"](spark, SF)) == sorted(want, key=repr)


def test_op4_groups(spark, rows_of):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    got = rows_of(queries.queries()["op4_minhash_dedup"](spark, SF))
    assert got == sorted(brute.near_duplicates(rows), key=repr)


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)

    def after(name, before):
        found = stages[name](spark, before, SF)
        assert found.columns == list(corpus_pipeline.COLUMNS)
        rows = [tuple(r) for r in found.collect()]
        return rows, spark.createDataFrame(rows, docs.schema)

    first, one = after("language_id", docs)
    plain = [tuple(r) for r in docs.collect()]
    assert sorted(first) == sorted(r for r in plain if any(map(str.isalpha, r[1] or "")))
    second, two = after("minhash_dedup", one)
    kept = {r[0] for r in brute.near_duplicates([(r[0], r[1]) for r in first]) if r[3]}
    assert sorted(second) == sorted(r for r in first if r[0] in kept)
    third, three = after("suffix_dedup", two)
    others = {r[0]: r[2:4] for r in second}
    cleaned = []
    for doc_id, data, gone in brute.repeats(sorted((r[0], r[1]) for r in second), 100):
        text = brute.kept_bytes(data, gone).decode("utf-8", "ignore")
        if text:
            cleaned.append((doc_id, text, *others[doc_id], len(text)))
    assert sorted(third) == sorted(cleaned)
    fourth, four = after("decontamination", three)
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    known = {tuple(w[i : i + 10]) for _, t in items for w in [brute.words(t)]
             for i in range(len(w) - 9)}
    clean = []
    for r in third:
        own = brute.words(r[1])
        if not any(tuple(own[i : i + 10]) in known for i in range(len(own) - 9)):
            clean.append(r)
    assert sorted(fourth) == sorted(clean) and len(clean) < len(third)
    last = stages["mix_sources"](spark, four, SF).collect()
    copies = {}
    for r in last:
        copies.setdefault(r["doc_id"], []).append(r["copy"])
        assert tuple(r)[:5] in set(fourth)
    assert all(sorted(c) == list(range(1, len(c) + 1)) and len(c) <= 3 for c in copies.values())
    words = sum(len(r["text"].split()) for r in last)
    assert abs(words / sum(len(r[1].split()) for r in fourth) - 1) < 0.1


def test_pipeline_on_awkward_rows(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(1, "one two three four five", "en", "a", 1), (None, "some words", None, None, None),
            (2, None, "en", "a", None), (3, "", "en", None, 0), (4, "12", "de", "b", 2),
            (5, "one two three four five", None, "b", 1)]
    spark.createDataFrame(rows, docs.schema).write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in got} <= {1, None}
    docs.limit(0).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_language_stage_keeps_what_has_a_letter(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    texts = ["guten tag", "12 !", None, "", "good day", "é"]
    unlabelled = spark.createDataFrame([(i, t, None, "a", 1) for i, t in enumerate(texts)], schema)
    got = corpus_pipeline.identify_languages(spark, unlabelled, SF).collect()
    assert sorted((r["doc_id"], r["lang"]) for r in got) == [(0, "und"), (4, "und"), (5, "und")]
    labelled = spark.createDataFrame([(i, t, "und", "a", 1) for i, t in enumerate(texts)], schema)
    got = corpus_pipeline.identify_languages(spark, labelled, SF).collect()
    assert sorted(r["doc_id"] for r in got) == [0, 4, 5]


def test_pipeline_without_labels(spark, tmp_path):
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(i, f"text number {'abcdefgh'[i]} of its own", None, "a", 1) for i in range(8)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in got} == set(range(8)) and {r["lang"] for r in got} == {"und"}
