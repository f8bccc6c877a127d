"""Language-model scores of documents: prediction by partial matching over bytes.

The model is a trie of byte contexts up to ``ORDER`` bytes long, with the counts of the bytes
that follow them in the training documents, A-Z lower-cased, and of the end of the text. A symbol
is predicted in the longest context that was seen; if it did not follow there, an escape is
coded and the next shorter context is asked. A context with n symbols, d of them different,
escapes with d / 2n and codes one that followed c times with (2c - 1) / 2n. Symbols of longer
contexts are excluded from shorter ones. Below the empty context all remaining symbols are
equally likely. The score is the base-10 logarithm of the
probability of the whole text and its end.

The base is a word model: words at ASCII white space, one end per text, counts plus one half.

The trie is spread over the cluster. Blocks of documents send their distinct words and grams
(context and symbol) to hash parts, each once with its count, where they are added up. The
distinct grams of all go to the part of the last two bytes of their context, which has the
whole trie under it: contexts of one byte and of none are a table of at most 257 x 257 counts
that every task has. Each distinct gram is coded once, and its code length goes back to the
blocks that have it, in 32 bits, which add up their documents in 64. Blocks that only count
sort their grams; blocks that score look every symbol's gram up once, in one hash table.

Null texts are empty: one token, the end. Rows that may not be learned from are scored like the
others. Without training documents all symbols are equally likely and no token is known.
Repeated rows count, and are scored, each for itself. Words are told apart by 64-bit
fingerprints, grams exactly.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import block_count, dealt, pack, shuffle_partitions, stored, unpack
from tessera.llm.hashing import mix

ORDER = 5
EDGE = 256  # the end as a symbol, the time before the text as a context
SYMBOLS = 257
BITS = 9
MASK = (1 << BITS) - 1
END_OF_TEXT = b"\n"  # no word holds white space
BLOCK_BYTES = 8 << 20
CHUNK_BYTES = 1 << 20
NOWHERE = np.empty(0, np.int64)


def lowered(text: str | None) -> bytes:
    return (text or "").encode("utf-8").lower()  # bytes change A-Z only


def grams_of(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """The gram that ends at every symbol of every text, and where each text's begin."""
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    starts = np.cumsum(sizes) - sizes
    symbols = np.frombuffer(END_OF_TEXT.join([*texts, b""]), np.uint8).astype(np.int64)
    symbols[starts + sizes - 1] = EDGE
    grams = symbols.copy()
    for back in range(1, order + 1):
        grams[back:] |= symbols[:-back] << (BITS * back)
    for place in range(order):  # contexts that reach back before their text
        at = starts[sizes > place] + place
        first = symbols[at]
        for back in range(1, order + 1):
            first |= (symbols[at - back] if back <= place else EDGE) << (BITS * back)
        grams[at] = first
    return grams, starts


def _chunks(texts: list[bytes]) -> Iterator[list[bytes]]:
    chunk, size = [], 0
    for text in texts:
        chunk.append(text)
        size += len(text)
        if size >= CHUNK_BYTES:
            yield chunk
            chunk, size = [], 0
    if chunk:
        yield chunk


def grams_in(texts: list[bytes], order: int) -> np.ndarray:
    """The grams of all texts one after the other, made chunk by chunk."""
    grams, done = np.empty(sum(map(len, texts)) + len(texts), np.int64), 0
    for chunk in _chunks(texts):
        found, _ = grams_of(chunk, order)
        grams[done:done + len(found)] = found
        done += len(found)
    return grams


def words_in(texts: list[bytes]) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Every word's place among the distinct words of the texts, these, and each text's number
    of words. A word is looked up once, where it is found, in the bytes of all texts."""
    ended = np.frombuffer(END_OF_TEXT.join([*texts, b""]), np.uint8)
    solid = (ended != 32) & ((ended < 9) | (ended > 13))
    edges = np.flatnonzero(np.diff(solid, prepend=False))  # an end follows every text
    first, after = edges[::2], edges[1::2]
    ends = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)
    numbers = np.diff(np.searchsorted(first, ends), prepend=0)
    offsets = np.append(0, np.cumsum(after - first))
    coded = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(ended[solid])]
    ).dictionary_encode()
    _, bounds, letters = coded.dictionary.buffers()
    if not len(coded.dictionary):
        return NOWHERE, [], numbers
    cuts = np.frombuffer(bounds, np.int64)[:len(coded.dictionary) + 1].tolist()
    letters = letters.to_pybytes()
    words = [letters[a:b] for a, b in itertools.pairwise(cuts)]
    return coded.indices.to_numpy(), words, numbers


def counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and how often each occurs; the keys given are sorted in place."""
    keys.sort()
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else NOWHERE
    return keys[starts], np.diff(np.append(starts, len(keys)))


def merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their counts."""
    if not keys:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    starts = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else []
    return key[starts], np.add.reduceat(count, starts) if len(key) else count


def _word_keys(words) -> list[int]:
    return [xxhash.xxh3_64_intdigest(w) for w in words]


class Block:
    """A block's texts in order and its distinct words, the end of a text among them."""

    def __init__(self, table: pa.Table):
        ids, learn = table.column("doc_id").to_pylist(), table.column("learn").to_pylist()
        texts = list(map(lowered, table.column("text").to_pylist()))
        rows = sorted(
            range(len(ids)),
            key=lambda i: (ids[i] is None, ids[i] or 0, bool(learn[i]), texts[i]),
        )
        self.ids = [ids[i] for i in rows]
        self.texts = [texts[i] for i in rows]
        self.learn = [bool(learn[i]) for i in rows]
        found, words, numbers = words_in(self.texts)
        words.append(END_OF_TEXT)
        keys = np.array(_word_keys(words), np.uint64)
        sorting = np.argsort(keys)
        self.words = keys[sorting]
        places = np.empty(len(keys), np.int64)
        places[sorting] = np.arange(len(keys))
        # The place of every text's words and of its end among the distinct ones.
        self.sizes = numbers + 1
        ends = np.cumsum(self.sizes) - 1
        self.tokens = np.full(int(self.sizes.sum()), places[-1])
        inside = np.ones(len(self.tokens), bool)
        inside[ends] = False
        self.tokens[inside] = places[found]

    def word_counts(self) -> np.ndarray:
        """The distinct words' counts in the training texts."""
        return np.bincount(
            self.tokens[np.repeat(self.learn, self.sizes)], minlength=len(self.words)
        )

    def gram_counts(self, order: int) -> tuple[np.ndarray, np.ndarray]:
        """The distinct grams in order and their counts in the training texts."""
        found = []
        for learn in (True, False):
            texts = [t for t, own in zip(self.texts, self.learn, strict=True) if own == learn]
            grams, counts = counted(grams_in(texts, order))
            found.append((grams, counts if learn else np.zeros_like(counts)))
        return merged([g for g, _ in found], [c for _, c in found])

    def gram_places(self, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The distinct grams in order, the same in the order found, and every symbol's place
        in the latter: one hash table over the block, nothing is sorted per symbol."""
        coded = pa.array(grams_in(self.texts, order)).dictionary_encode()
        found = coded.dictionary.to_numpy()
        sorting = np.argsort(found)
        return found[sorting], sorting, coded.indices.to_numpy()


def _words_dealt(keys: np.ndarray, parts: int) -> dict[int, np.ndarray]:
    """The places of the words that go to each part."""
    return dict(dealt((keys >> np.uint64(13)) % np.uint64(parts)))


def _grams_dealt(grams: np.ndarray, parts: int) -> dict[int, np.ndarray]:
    """The places of the grams that go to each part."""
    return dict(dealt(mix(grams.astype(np.uint64)) % np.uint64(parts)))


def _trie_part(grams: np.ndarray, parts: int) -> np.ndarray:
    """By the last two bytes of the context."""
    return mix((grams >> BITS & (1 << 2 * BITS) - 1).astype(np.uint64)) % np.uint64(parts)


def _features(order: int, parts: int):
    def run(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        own = Block(table)
        word_counts = own.word_counts()
        own_grams, gram_counts = own.gram_counts(order)
        words, grams = _words_dealt(own.words, parts), _grams_dealt(own_grams, parts)
        rows = []
        for part in sorted(words.keys() | grams.keys()):
            w, g = words.get(part, NOWHERE), grams.get(part, NOWHERE)
            rows.append((
                part, block, pack(own.words[w], np.uint64, rising=True),
                pack(word_counts[w], np.int64),
                pack(own_grams[g], np.int64, rising=True), pack(gram_counts[g], np.int64),
            ))
        return _packed(FEATURES, rows)

    return run


FEATURES = ("part", "block", "words", "word_counts", "grams", "gram_counts")
TOTALS = ("part", "origin", "grams", "gram_counts")
LENGTHS = ("part", "grams", "lengths")
VALUES = ("block", "part", "word_totals", "lengths", "tokens", "distinct")
LONGS = {"tokens": "long", "distinct": "long", "part": "int", "block": "int", "origin": "int"}
ARROW = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}


def _ddl(names: tuple[str, ...]) -> str:
    return ", ".join(f"{n} {LONGS.get(n, 'binary')}" for n in names)


def _packed(names: tuple[str, ...], rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    arrays = [pa.array(c, ARROW[LONGS.get(n, "binary")]) for n, c in zip(names, columns, strict=True)]
    return pa.Table.from_arrays(arrays, names=list(names))


def _arrays(table: pa.Table, name: str, kind=np.int64) -> list[np.ndarray]:
    """Words and grams are sorted in every row."""
    rising = name in ("words", "grams")
    return [unpack(b, kind, rising) for b in table.column(name).to_pylist()]


def _totals(parts: int):
    """The distinct grams of a hash part with their counts, dealt to the parts of the trie."""

    def run(table: pa.Table) -> pa.Table:
        origin = table.column("part")[0].as_py()
        grams, counts = merged(_arrays(table, "grams"), _arrays(table, "gram_counts"))
        return _packed(TOTALS, [
            (part, origin, pack(grams[at], np.int64, rising=True), pack(counts[at], np.int64))
            for part, at in dealt(_trie_part(grams, parts))
        ])

    return run


class Level:
    """The contexts of one length: their counts, and what they exclude one level below."""

    def __init__(self, entries: np.ndarray, counts: np.ndarray):
        self.entries, self.counts = entries, counts
        context = entries >> BITS
        self.starts = np.flatnonzero(np.append(True, context[1:] != context[:-1])) if len(
            context) else np.empty(0, np.int64)
        self.contexts = context[self.starts]
        self.totals = np.add.reduceat(counts, self.starts) if len(counts) else counts
        self.kinds = np.diff(np.append(self.starts, len(entries)))

    def place(self, keys: np.ndarray, wanted: np.ndarray):
        """(found, place) of wanted values among sorted keys."""
        if not len(keys):
            return np.zeros(len(wanted), bool), np.zeros(len(wanted), np.int64)
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return keys[at] == wanted, at

    def count(self, wanted: np.ndarray) -> np.ndarray:
        found, at = self.place(self.entries, wanted)
        return np.where(found, self.counts[at], 0) if len(self.counts) else np.zeros(len(wanted))

    def below(self, mass: np.ndarray) -> np.ndarray:
        """Per context the sum of its entries' counts in the shorter context."""
        return np.add.reduceat(mass, self.starts) if len(self.starts) else mass


def code_lengths(
    grams: np.ndarray, counts: np.ndarray, pairs: np.ndarray, order: int
) -> np.ndarray:
    """The base-10 logarithm of every gram's probability in its context.

    ``grams`` are sorted and hold the whole trie under their last two context bytes; ``pairs``
    has the counts (symbol before, symbol) of the whole training text.
    """
    levels: dict[int, Level] = {}
    for length in range(order, 1, -1):
        entries = grams & (1 << BITS * (length + 1)) - 1
        learned = counts > 0
        levels[length] = Level(*merged([entries[learned]], [counts[learned]]))
    singles = pairs.sum(axis=0)
    # (context seen, its total, its kinds, the symbol's count, excluded mass one level below)
    asked = []
    for length in range(order, 1, -1):
        level, shorter = levels[length], levels.get(length - 1)
        wanted = grams & (1 << BITS * (length + 1)) - 1
        under = level.entries & (1 << BITS * length) - 1
        mass = shorter.count(under) if shorter else pairs[under >> BITS, under & MASK]
        seen, at = level.place(level.contexts, wanted >> BITS)
        empty = not len(level.contexts)
        pick = (lambda a, seen=seen, at=at, empty=empty:
                np.zeros(len(seen)) if empty else np.where(seen, a[at], 0).astype(float))
        asked.append((seen, pick(level.totals), pick(level.kinds), level.count(wanted),
                      pick(level.below(mass))))
    symbol, before = grams & MASK, grams >> BITS & MASK
    totals, kinds = pairs.sum(axis=1), (pairs > 0).sum(axis=1)
    asked.append((totals[before] > 0, totals[before], kinds[before], pairs[before, symbol],
                  ((pairs > 0) @ singles)[before]))
    everything = np.full(len(grams), singles.sum())
    asked.append((everything > 0, everything, np.full(len(grams), (singles > 0).sum()),
                  singles[symbol], np.zeros(len(grams))))
    length = np.zeros(len(grams))
    open_ = np.ones(len(grams), bool)
    excluded_mass, excluded_kinds = np.zeros(len(grams)), np.zeros(len(grams))
    for seen, total, kind, count, mass in asked:
        left, fresh = total - excluded_mass, kind - excluded_kinds
        ask = open_ & seen
        coded, escaped = ask & (count > 0), ask & (count <= 0) & (fresh > 0)
        room = np.log10(2 * left, out=np.zeros(len(grams)), where=left > 0)
        length[coded] += np.log10(2 * count[coded] - 1) - room[coded]
        length[escaped] += np.log10(fresh[escaped]) - room[escaped]
        open_ &= ~coded
        excluded_mass, excluded_kinds = np.where(seen, mass, 0), np.where(seen, kind, 0)
    length[open_] -= np.log10(SYMBOLS - (singles > 0).sum())
    return length


def _coded(pairs: np.ndarray, order: int):
    """Code lengths of a part of the trie, sent back to the parts the grams came from."""

    def run(table: pa.Table) -> pa.Table:
        origins = table.column("origin").to_pylist()
        own = _arrays(table, "grams")
        grams, counts = merged(own, _arrays(table, "gram_counts"))
        lengths = code_lengths(grams, counts, pairs, order)
        return _packed(LENGTHS, [
            (origin, pack(g, np.int64, rising=True),
             pack(lengths[np.searchsorted(grams, g)], np.float32))
            for origin, g in zip(origins, own, strict=True)
        ])

    return run


def _values(features: pa.Table, lengths: pa.Table) -> pa.Table:
    """For every block of a part: its words' training counts, its grams' code lengths."""
    if not features.num_rows:
        return _packed(VALUES, [])
    part = features.column("part")[0].as_py()
    words = _arrays(features, "words", np.uint64)
    keys, totals = merged(words, _arrays(features, "word_counts"))
    grams = np.concatenate([np.empty(0, np.int64), *_arrays(lengths, "grams")])
    values = np.concatenate([np.empty(0, np.float32), *_arrays(lengths, "lengths", np.float32)])
    sorting = np.argsort(grams)
    grams, values = grams[sorting], values[sorting]
    rows = []
    for i, (block, w, g) in enumerate(zip(
        features.column("block").to_pylist(), words, _arrays(features, "grams"), strict=True
    )):
        rows.append((
            block, part, pack(totals[np.searchsorted(keys, w)], np.int64),
            pack(values[np.searchsorted(grams, g)], np.float32),
            0 if i else int(totals.sum()), 0 if i else int((totals > 0).sum()),
        ))
    return _packed(VALUES, rows)


SCORES = pa.schema([
    ("doc_id", pa.int64()), ("learned", pa.bool_()), ("n_tokens", pa.int64()),
    ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()),
    ("score", pa.float64()),
])
SCORES_DDL = (
    "doc_id long, learned boolean, n_tokens long, n_known long, train_tokens long, "
    "base_score double, score double"
)


def _scores(order: int, parts: int, train_tokens: int, distinct: int):
    room = np.log10(train_tokens + 0.5 * (distinct + 1))

    def run(docs: pa.Table, values: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return SCORES.empty_table()
        block = Block(docs)
        grams, sorting, places = block.gram_places(order)
        totals = np.zeros(len(block.words), np.int64)
        lengths = np.zeros(len(grams))
        words_to, grams_to = _words_dealt(block.words, parts), _grams_dealt(grams, parts)
        for row in values.to_pylist():
            at = words_to.get(row["part"], NOWHERE)
            totals[at] = unpack(row["word_totals"], np.int64)
            at = sorting[grams_to.get(row["part"], NOWHERE)]
            lengths[at] = unpack(row["lengths"], np.float32)
        # Logarithms are taken once per count, so that equal counts give equal terms.
        starts = np.cumsum(block.sizes) - block.sizes
        terms, seen = np.log10(totals + 0.5), (totals > 0).astype(np.int64)
        tokens = block.sizes
        known = np.add.reduceat(seen[block.tokens], starts)
        base = np.add.reduceat(terms[block.tokens], starts) - tokens * room
        scores: list[float] = []
        done = 0
        for chunk in _chunks(block.texts):
            sizes = np.array([len(t) + 1 for t in chunk], np.int64)
            each = lengths[places[done:done + int(sizes.sum())]]
            scores.extend(np.add.reduceat(each, np.cumsum(sizes) - sizes).tolist())
            done += len(each)
        columns = (block.ids, block.learn, tokens, known, [train_tokens] * len(tokens), base, scores)
        return pa.Table.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, SCORES, strict=True)], schema=SCORES
        )

    return run


def _pair_counts(texts: DataFrame) -> np.ndarray:
    """How often each symbol follows each, over the training texts: 257 x 257 at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS * SYMBOLS, np.int64)
        for batch in batches:
            for chunk in _chunks([lowered(t.as_py()) for t in batch.column(0)]):
                grams, _ = grams_of(chunk, 1)
                pair = (grams >> BITS) * SYMBOLS + (grams & MASK)
                total += np.bincount(pair, minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at.astype(np.int32)), pa.array(total[at])], names=["pair", "n"]
        )

    table = np.zeros(SYMBOLS * SYMBOLS, np.int64)
    counted = texts.filter("learn").select("text").mapInArrow(run, "pair int, n long")
    for pair, n in counted.groupBy("pair").agg(F.sum("n")).collect():
        table[pair] = n
    return table.reshape(SYMBOLS, SYMBOLS)


def score_texts(
    df: DataFrame,
    learn: Column,
    order: int = ORDER,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(doc_id, learned, n_tokens, n_known, train_tokens, base_score, score) for every row.
    ``learn`` says which rows the model learns from."""
    if not 2 <= order <= 6:
        raise ValueError("2 <= order <= 6")
    rows = df.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
        F.coalesce(learn, F.lit(False)).alias("learn"),
    )
    blocks = block_count(rows, block_bytes)
    parts = shuffle_partitions(df.sparkSession)
    parts = max(parts, blocks // 4)
    pairs = _pair_counts(rows)
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int")
    docs = rows.select(block.alias("block"), "*")
    features = docs.groupBy("block").applyInArrow(_features(order, parts), _ddl(FEATURES))
    totals = features.groupBy("part").applyInArrow(_totals(parts), _ddl(TOTALS))
    lengths = totals.groupBy("part").applyInArrow(_coded(pairs, order), _ddl(LENGTHS))
    values = stored(
        features.groupBy("part").cogroup(lengths.groupBy("part")).applyInArrow(
            _values, _ddl(VALUES)
        )
    )
    tokens, distinct = values.agg(F.sum("tokens"), F.sum("distinct")).first()
    return docs.groupBy("block").cogroup(values.groupBy("block")).applyInArrow(
        _scores(order, parts, tokens or 0, distinct or 0), SCORES_DDL
    )
