"""URL filters, token counts, decontamination and mixing."""

import random
import tracemalloc

import brute
import duckdb
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm import decontamination, mixing, sql, token_counts, url_filters
from tessera.llm.queries import URL_RULES

PATH = public_tokenizers.path("byte_bpe_50k.json")
URLS = [
    (1, "http://a.example.com/en/x"), (2, "HTTPS://WWW.Example.COM/en/?q=casino"),
    (3, "http://casino.org/x"), (4, "http://casinos.org/bet/poker"), (5, "http://x.net/es/a"),
    (6, "http://alphabet.org/poker-bet-alphabet"), (7, None), (8, "no scheme casino"),
    (9, "http://x.com?porn"), (10, "http://x.com/porn#a"), (11, "://h"), (12, "a://b://c/d"),
    (13, ""), (14, "http://é.org/é-xxx-é"), (15, "http://x.org/bet/bet/bet"), (15, "http://e.org"),
    (None, "http://b.net/fr/" + "a" * 50_000 + "/sex/dating"), (16, "http://b.org/a\nb/xxx"),
]


def test_url_filter(spark):
    pages = spark.createDataFrame(URLS, "page_id long, url string").selectExpr(
        "*", "'own' as host", "'own' as verdict", "'own' as weight"
    )
    found = url_filters.url_filter(pages, URL_RULES)
    got = {r["page_id"]: r for r in found.collect()}
    assert found.count() == len(URLS)
    verdicts = {i: got[i]["verdict"] for i in got}
    assert verdicts[1] == "block" and got[1]["rule"] == "example.com/en/"
    assert verdicts[2] == "allow" and got[2]["rule"] == "www.example.com/en/"
    assert verdicts[3] == "block" and got[3]["strict_hits"] == 1
    assert verdicts[4] == "block" and got[4]["soft_terms"] == 2  # casinos is another word
    assert verdicts[5] == "block" and got[5]["rule"] == "net/es/"
    assert verdicts[6] == "block" and got[6]["soft_terms"] == 2
    assert verdicts[7] == "allow" and (got[7]["host"], got[7]["path"]) == ("", "")
    assert (got[8]["host"], verdicts[8]) == ("", "block")
    assert verdicts[9] == "block" and got[9]["rule"] is None  # no path, so com/ does not fit
    assert verdicts[10] == "allow" and got[10]["rule"] == "com/"
    assert got[11]["host"] == "h" and got[12]["host"] == "b:" and got[12]["path"] == "//c/d"
    assert verdicts[14] == "block" and verdicts[15] == "allow"
    assert verdicts[None] == "block" and got[None]["path"].startswith("/fr/a")
    con = duckdb.connect()
    con.execute("create table pages(page_id bigint, url varchar)")
    con.executemany("insert into pages values (?, ?)", URLS)
    answer = con.execute(sql.url_filter())
    names = [c[0] for c in answer.description]
    assert sorted(answer.fetchall(), key=repr) == sorted(
        map(tuple, found.select(*names).collect()), key=repr
    )
    assert url_filters.url_filter(pages.limit(0)).collect() == []


ODD = ["", "a  b", "don't we'll 're", "x\n\n  y \t z", "!!<|endoftext|>b", "a  <|endoftext|>",
       "é漢字 　 z\x1c\x1d\x85 b", "aaaaaaaa    aaaa", "🙂🙂 's'S", " <|endoftext|><|endoftext|> q",
       "'ve'", "١٢٣ ½ ⅷ", " \n\n\n a", "a\t \xa0b", "\ufeff\u200b x"]


def test_counts_at_every_prefix_are_the_librarys():
    library = Tokenizer.from_file(PATH)
    counter = token_counts.counter(PATH)
    rnd = random.Random(1)
    alphabet = "ab é'srel \n\t<|>endoftxt!1漢\xa0 "
    random_texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 40)))
                    for _ in range(300)]
    for text in ODD + random_texts:
        want = [len(library.encode(text[:i], add_special_tokens=False).ids)
                for i in range(len(text) + 1)]
        assert counter.prefixes(text).tolist() == want, text
        assert counter.count(text) == want[-1]
    long = "x" * 40_000 + " " * 1000 + "ab" * 10_000
    assert counter.count(long) == len(library.encode(long, add_special_tokens=False).ids)


def test_token_tables(docs, rows_of):
    rows = [(1, "Hello world, hello"), (2, None), (3, ""), (1, "Hello world, hello"),
            (None, "é" * 600)]
    got = rows_of(token_counts.token_counts(docs(rows), PATH, limit=3))
    library = Tokenizer.from_file(PATH)
    n = [len(library.encode(t or "").ids) for _, t in rows]
    assert got == sorted(
        [(i, len((t or "").encode()), k, k > 3) for (i, t), k in zip(rows, n, strict=True)],
        key=repr,
    )
    cut = {r[0]: r for r in rows_of(token_counts.truncated(docs(rows), PATH, budget=2))}
    assert cut[1][1] == "Hello world" and cut[1][2] == 2
    prefixes = {r[0]: r[1] for r in rows_of(token_counts.token_prefixes(docs(rows), PATH))}
    assert len(prefixes[1]) == len("Hello world, hello") + 1 and prefixes[2] == [0]
    assert token_counts.token_counts(docs([]), PATH).collect() == []


ITEMS = [(1, "a b c d e f g h i j k l"), (2, "B C d"), (10, "x"), (3, None), (4, "!!"),
         (2, "q r s"), (None, "m n"), (5, "É É é É é é")]


@pytest.mark.parametrize("block_bytes", [1, 1 << 20])
def test_decontamination_is_brute_force(spark, docs, block_bytes):
    rnd = random.Random(4)
    letters = list("abcdefghijklmnqrsé")
    texts = [" ".join(rnd.choice(letters) for _ in range(rnd.randint(0, 40))) for _ in range(40)]
    texts += ["Z A-b c.d e f g h i j k l!", None, "", "É é é", "m\n\nN", "a " * 5000 + "x",
              "a b c d e f g h i j a b c d e f g h i j k"]
    items = spark.createDataFrame(ITEMS, "item_id long, text string").selectExpr(
        "*", "'own' as doc_id", "'own' as hit")
    rows = [*enumerate(texts), (0, texts[0]), (None, "x")]
    found = decontamination.find_contamination(
        docs(rows), items, block_bytes=block_bytes, carry=("node",))
    got = sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in found.collect()),
                 key=repr)
    want = [(i, *brute.contamination(t, ITEMS)) for i, t in rows]
    assert got == sorted(want, key=repr)
    assert {r["node"] for r in found.collect()} == {"own"}
    spans = found.filter("n_hit > 0").first()
    total = sum(e - b for b, e in zip(spans["begins"], spans["ends"], strict=True))
    assert total == spans["n_hit"]
    assert decontamination.find_contamination(docs([]), items).collect() == []
    nothing = decontamination.find_contamination(docs([(1, "a b")]), items.limit(0)).first()
    assert (nothing["n_words"], nothing["n_hit"], nothing["items"]) == (2, 0, [])


def test_decontamination_writes_only_hits(spark, docs, monkeypatch):
    items = spark.createDataFrame([(i, f"a{i} b c") for i in range(3)], "item_id long, text string")
    written = []
    monkeypatch.setattr(decontamination, "stored", lambda df: written.append(df) or df)
    rows = [(i, f"clean text {i}") for i in range(50)] + [(50, "x a2 b c y a0 b c")] * 3
    found = decontamination.find_contamination(docs(rows), items, block_bytes=1)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert len(written) == 2 and plan.count("MapInArrow") == 3  # written are the first two
    assert [w.count() for w in written] == [1, 0]
    assert all("text" not in w.columns for w in written)
    hit = [r for r in found.collect() if r["n_hit"]]
    assert [(r["n_words"], r["n_hit"], r["items"]) for r in hit] == [(8, 6, ["0", "2"])] * 3


def test_memory_of_a_benchmark_block():
    rnd = random.Random(9)
    text = b"".join(b"%x " % rnd.getrandbits(22) for _ in range(300_000))
    tracemalloc.start()
    known = decontamination.Benchmark([("1", text)], 10)
    held, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert known.searches and held < 8 * len(text) and peak < 25 * len(text)


def mix_rows(n=400):
    rnd = random.Random(6)
    sources = [*["hot"] * 5, "b", "ü", "z", None]
    return [(i, " ".join("w" for _ in range(int(rnd.expovariate(1 / 80)))), None,
             rnd.choice(sources)) for i in range(n)] + [(None, None, None, "empty")]


def test_mix_meets_its_targets(docs):
    rows = mix_rows()
    got = mixing.mix_sources(docs(rows)).collect()
    total = sum(r["size"] for r in got)
    by_source = {}
    for r in got:
        by_source.setdefault(r["source"], []).append(r)
        assert 0 <= r["copies"] <= 3 and r["taken"] == r["copies"] * r["size"]
    assert len(got) == len(rows)
    targets = {s: own[0]["target"] for s, own in by_source.items()}
    assert sum(targets.values()) == pytest.approx(total)
    assert targets["empty"] == 0 and by_source["empty"][0]["taken"] == 0
    order = [*sorted(s for s in targets if s is not None), None]
    weight = dict(zip(order, [5, 2, 1] * 3, strict=False))
    sizes = {s: own[0]["source_size"] for s, own in by_source.items()}
    free = [s for s in order if 0 < targets[s] < 3 * sizes[s] - 1e-6]
    assert len({round(targets[s] / weight[s], 6) for s in free}) <= 1
    for s in order:
        assert targets[s] <= 3 * sizes[s] + 1e-6
        most = max(r["size"] for r in by_source[s])
        assert abs(sum(r["taken"] for r in by_source[s]) - targets[s]) <= 2 * most
        expected = targets[s] / sizes[s] * len(by_source[s]) if sizes[s] else 0
        assert abs(sum(r["copies"] for r in by_source[s]) - expected) <= 1


def test_mix_is_its_sql_and_native(docs, rows_of):
    rows = mix_rows()
    con = duckdb.connect()
    con.execute("create table documents(doc_id bigint, text varchar, source varchar)")
    con.executemany("insert into documents values (?, ?, ?)", [(r[0], r[1], r[3]) for r in rows])
    answer = con.execute(sql.mix_sources())
    names = [c[0] for c in answer.description]
    found = mixing.mix_sources(docs(rows))
    assert rows_of(found.select(*names)) == sorted(answer.fetchall(), key=repr)
    plan = found._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
    again = mixing.mix_sources(docs(rows, parts=7))
    assert rows_of(again) == rows_of(found)


def test_mix_splits_a_source_of_one_size_without_ids(docs, rows_of):
    rows = [(None, f"a b c{i % 1500}", None, "hot") for i in range(2000)]
    rows += [(i, "x y", None, "b") for i in range(90)]
    options = {"cell_rows": 40}
    columns = {"id_col": "doc_id", "text_col": "text", "source_col": "source"}
    placed = mixing.in_cells(docs(rows), "mix", mixing.BUCKETS, 40, **columns)
    cells = placed.groupBy("source_key", "class", "bucket").count().collect()
    hot = [c["count"] for c in cells if c["source_key"] == "shot"]
    assert len(hot) == mixing.BUCKETS + 2000 // 40 and sum(hot) == 2000 and max(hot) <= 60
    con = duckdb.connect()
    con.execute("create table documents(doc_id bigint, text varchar, source varchar)")
    con.executemany("insert into documents values (?, ?, ?)", [(r[0], r[1], r[3]) for r in rows])
    answer = con.execute(sql.mix_sources(**options))
    names = [c[0] for c in answer.description]
    found = mixing.mix_sources(docs(rows), **options)
    assert rows_of(found.select(*names)) == sorted(answer.fetchall(), key=repr)
    target = found.filter("source = 'hot'").first()["target"]
    assert abs(found.filter("source = 'hot'").agg(F.sum("taken")).first()[0] - target) <= 6


def test_mixed_documents_and_edges(docs, rows_of):
    rows = mix_rows(60)
    taken = {r["doc_id"]: r["copies"] for r in mixing.mix_sources(docs(rows)).collect()}
    mix = mixing.mixed(docs(rows))
    assert mix.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
    got = {r["doc_id"]: r["count"] for r in mix.groupBy("doc_id").count().collect()}
    assert got == {i: n for i, n in taken.items() if n}
    assert mix.filter(F.col("node") != "own").count() == 0
    assert mixing.mix_sources(docs([])).collect() == []
    same = [(1, "a b", None, "s")] * 5 + [(2, None, None, None)]
    rows = mixing.mix_sources(docs(same)).collect()
    assert sum(r["taken"] for r in rows) == 10
