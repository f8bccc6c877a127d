"""Benchmark decontamination: which words of a document lie in passages of benchmark items.

Texts are lower-cased (A-Z) and cut into words of ASCII letters, digits and characters beyond
ASCII. An item is known by its windows of ``window`` consecutive words; a shorter item is one
window. Windows are searched with the Wu-Manber algorithm over words, one search for each
length of window: a table gives, for the block of two words under the end of the search
window, how far the window can move without passing a benchmark window; only blocks that end
one cannot move, and those select the windows that are compared word by word.

Null texts have no words and no hits. Null item texts have no windows; an item with a null id is
searched, and listed nowhere. Repeated items are one item by id. Repeated documents are judged
each for itself. Columns are taken by name, so others in the tables do not matter.

A block of two words is known by its hash; the windows that end in it form its bucket, in which
those with the document's hash of the whole window are compared byte for byte.

The benchmark is the query set. It is read in blocks of about ``block_bytes`` of text (an item is
never split), and a block is broadcast as text. A task holds one block at a time, as arrays of 5 to
7 times its text (15 to 20 while they are built). With several blocks the documents are searched
once for each, and only the spans of documents with hits are written; these come together at the
search for the last block.
Very long texts are searched whole, a batch of documents at a time. An empty table of documents
gives no rows; an empty benchmark gives documents without hits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import stored
from tessera.llm.hashing import CHUNK_BYTES, Hasher, mix

WINDOW = 10
BLOCK_BYTES = 16 << 20
BATCH_ROWS, BATCH_BYTES = 500, 4 << 20
KNOWN_WINDOWS = 10_000  # windows whose owners a task remembers before it starts afresh
PAIR = np.uint64(0x9E3779B97F4A7C15)
IN_WORD = np.ones(256, bool)
IN_WORD[:0x80] = False
IN_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B)]] = True


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of lower-cased text start and end."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = IN_WORD[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1]).astype(np.int32)
    return edges[::2], edges[1::2]


def word_hashes(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hasher: Hasher
) -> np.ndarray:
    """A fingerprint for each word, some text at a time."""
    out, at = np.empty(len(starts), np.uint64), 0
    while at < len(starts):
        low = int(starts[at])
        to = max(at + 1, int(np.searchsorted(ends, low + CHUNK_BYTES, "right")))
        sums = hasher.sums(data[low : int(ends[to - 1])])
        out[at:to] = hasher.of(sums, starts[at:to] - low, ends[at:to] - low)
        at = to
    return out


def lowered(text: str | None) -> bytes:
    """bytes.lower changes A-Z only."""
    return (text or "").encode("utf-8").lower()


class WindowSearch:
    """Finds the windows of one length. ``words`` are the fingerprints of a block's words,
    ``place`` the numbers of those that the search is for, ``position`` their positions in items."""

    def __init__(self, words: np.ndarray, place: np.ndarray, position: np.ndarray, length: int):
        self.length, self.block = length, min(2, length)
        self.bits = np.uint64(max(10, len(place).bit_length() + 1))
        self.shift = np.full(1 << int(self.bits), length - self.block + 1, np.uint16)
        keys = self._keys(words)[place]
        whole = position >= self.block - 1
        np.minimum.at(
            self.shift, keys[whole], np.maximum(0, length - 1 - position[whole]).astype(np.uint16)
        )
        last = position >= length - 1
        ends = place[last].astype(np.int32)
        names = self._names(words, ends, keys[last])
        order = np.argsort(names)
        self.names, self.ends = names[order], ends[order]

    def _keys(self, words: np.ndarray) -> np.ndarray:
        """Of the block of words that ends at each place."""
        if self.block == 1:
            return (words >> (np.uint64(64) - self.bits)).astype(np.uint32)
        pairs = words * PAIR
        pairs[1:] += words[:-1]
        return (mix(pairs) >> (np.uint64(64) - self.bits)).astype(np.uint32)

    def _names(self, words: np.ndarray, ends: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """The bucket of a window in the upper bits, a hash of the whole window below."""
        total = np.zeros(len(ends), np.uint64)
        for i in range(self.length):
            total *= PAIR
            total += words[ends - i]
        return keys.astype(np.uint64) << (np.uint64(64) - self.bits) | mix(total) >> self.bits

    def candidates(self, words: np.ndarray, document: np.ndarray):
        """(start, first, past): windows of documents, and the entries of equal name."""
        keys = self._keys(words)
        moves = self.shift[keys].tolist()
        ends, end, n = [], self.length - 1, len(moves)
        while end < n:
            move = moves[end]
            if move:
                end += move
            else:
                ends.append(end)
                end += 1
        ends = np.array(ends, np.int64)
        ends = ends[document[ends - self.length + 1] == document[ends]]
        names = self._names(words, ends, keys[ends])
        first, past = (np.searchsorted(self.names, names, side) for side in ("left", "right"))
        found = past > first
        starts = ends[found] - self.length + 1
        yield from zip(starts.tolist(), first[found].tolist(), past[found].tolist(), strict=True)


class Benchmark:
    """The searches for one block of items: (id, words with a blank after each)."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int):
        self.ids = [item_id for item_id, _ in items]
        self.text = b"".join(text for _, text in items)
        self.hasher = Hasher()
        data = np.frombuffer(self.text, np.uint8)
        self.starts, self.ends = word_spans(data)
        words = word_hashes(data, self.starts, self.ends, self.hasher)
        lengths = np.cumsum([0, *(len(text) for _, text in items)])
        self.first = np.searchsorted(self.starts, lengths)  # each item's first word
        counts = np.diff(self.first)
        position = np.arange(len(words), dtype=np.int32)
        position -= np.repeat(self.first[:-1], counts).astype(np.int32)
        size = np.minimum(counts, window)
        of_word = np.repeat(size, counts)
        self.searches = []
        for length in np.unique(size[size > 0]).tolist():
            place = np.flatnonzero(of_word == length)
            self.searches.append(WindowSearch(words, place, position[place], length))
        self.owners: dict[tuple[int, int], dict[bytes, set[str]]] = {}

    def _owners(self, number: int, first: int, past: int) -> dict[bytes, set[str]]:
        """The ids of the items that hold each of the windows with one name, by their bytes."""
        found = self.owners.get((number, first))
        if found is None:
            if len(self.owners) >= KNOWN_WINDOWS:
                self.owners.clear()
            found = self.owners[number, first] = {}
            search = self.searches[number]
            for end in search.ends[first:past].tolist():
                window = self.text[self.starts[end - search.length + 1] : self.ends[end]]
                item = self.ids[np.searchsorted(self.first, end, "right") - 1]
                found.setdefault(window, set()).update(() if item is None else (item,))
        return found

    def judge(self, texts: list[str | None], before: list[tuple[list, list, list]]):
        """For each text (words, hit words, begins, ends, items), added to the spans and items
        that other blocks have found."""
        encoded = [lowered(text) for text in texts]
        text = b"\n".join(encoded)
        data = np.frombuffer(text, np.uint8)
        starts, ends = word_spans(data)
        words = word_hashes(data, starts, ends, self.hasher)
        offsets = np.cumsum([0, *(len(t) + 1 for t in encoded)])
        document = np.searchsorted(offsets, starts, "right") - 1
        first = np.searchsorted(document, np.arange(len(texts) + 1)).tolist()
        spans = [list(zip(b, e, strict=True)) for b, e, _ in before]
        items = [set(known) for _, _, known in before]
        for number, search in enumerate(self.searches):
            for start, low, past in search.candidates(words, document):
                past_word = start + search.length
                own = b" ".join(
                    text[s:e] for s, e in zip(
                        starts[start:past_word].tolist(), ends[start:past_word].tolist(),
                        strict=True,
                    )
                )
                owners = self._owners(number, low, past).get(own)
                if owners is not None:
                    row = int(document[start])
                    spans[row].append((start - first[row], past_word - first[row]))
                    items[row] |= owners
        for row, (found, known) in enumerate(zip(spans, items, strict=True)):
            begins, ends = _merged(found)
            yield (
                first[row + 1] - first[row], sum(ends) - sum(begins), begins, ends, sorted(known)
            )


def _merged(spans: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    begins, ends = [], []
    for begin, end in sorted(spans):
        if ends and begin <= ends[-1]:
            ends[-1] = max(end, ends[-1])
        else:
            begins.append(begin)
            ends.append(end)
    return begins, ends


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Of bounded rows and text, but for a row whose text alone is longer."""
    sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
    at, room = 0, 0
    for i, size in enumerate(sizes):
        if i > at and (i - at >= BATCH_ROWS or room + size > BATCH_BYTES):
            yield batch.slice(at, i - at)
            at, room = i, 0
        room += size
    if at < len(sizes):
        yield batch.slice(at)


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int):
    """(block, whether it is the last), of which there is always one."""
    rows = benchmark.select(
        F.col(id_col).cast("string").alias("item_id"), F.col(text_col).cast("string").alias("text")
    )
    block, size = [], 0
    for row in rows.toLocalIterator():
        if size >= block_bytes:
            yield block, False
            block, size = [], 0
        text = lowered(row["text"])
        starts, ends = word_spans(np.frombuffer(text, np.uint8))
        words = zip(starts.tolist(), ends.tolist(), strict=True)
        block.append((row["item_id"], b"".join(text[s:e] + b" " for s, e in words)))
        size += len(text)
    yield block, True


FOUND = "begins array<long>, ends array<long>, items array<string>"


def _searched(rows: DataFrame, held: Broadcast, window: int, hits_only: bool) -> DataFrame:
    """Rows (key, text, begins, ends, items, ...) with what a block adds; ``n_words`` and ``n_hit``
    come first among what is new. Or only the rows with hits, without their text."""
    longs, strings = pa.list_(pa.int64()), pa.list_(pa.string())

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Benchmark(held.value, window)
        for batch in batches:
            for part in _slices(batch):
                before = (part.column(i).to_pylist() for i in (2, 3, 4))
                before = [tuple(v or [] for v in row) for row in zip(*before, strict=True)]
                found = list(known.judge(part.column(1).to_pylist(), before))
                if hits_only:
                    hit = [i for i, row in enumerate(found) if row[1]]
                    part, found = part.take(pa.array(hit, pa.int64())), [found[i] for i in hit]
                if not found:
                    continue
                n_words, n_hit, begins, ends, items = zip(*found, strict=True)
                judged = [
                    pa.array(begins, longs), pa.array(ends, longs), pa.array(items, strings)
                ]
                if hits_only:
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0), *judged], names=["key", "begins", "ends", "items"]
                    )
                else:
                    counts = [pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64())]
                    yield pa.RecordBatch.from_arrays(
                        [*counts, *judged, *part.columns[5:]],
                        names=["n_words", "n_hit", *part.schema.names[2:]],
                    )

    if hits_only:
        key = rows.schema["key"].dataType.simpleString()
        return rows.select("key", "text", "begins", "ends", "items").mapInArrow(
            search, f"key {key}, {FOUND}"
        )
    rest = rows.schema.fields[5:]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rest)
    return rows.mapInArrow(search, f"n_words long, n_hit long, {FOUND}, {schema}")


def find_contamination(
    df: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """(doc_id, n_words, n_hit, begins, ends, items) and the columns of ``carry``: the spans of
    hit words, and the sorted ids of the items found in each document."""
    carried = [F.col(c).alias(f"carried_{i}") for i, c in enumerate(carry)]
    # Equal texts have equal spans; the key is 128 bits of the text.
    text = F.col(text_col).cast("string")
    key = F.struct(F.xxhash64(text).alias("a"), F.xxhash64(text, F.lit(1)).alias("b"))
    none = (F.lit(None).cast(t).alias(c) for c, t in (
        ("begins", "array<long>"), ("ends", "array<long>"), ("items", "array<string>")
    ))
    rows = df.select(
        key.alias("key"), text.alias("text"), *none,
        F.col(id_col).cast("long").alias("doc_id"), *carried,
    )
    earlier = []
    for block, last in _blocks(benchmark, item_col, item_text_col, block_bytes):
        held = df.sparkSession.sparkContext.broadcast(block)  # about block_bytes
        if not last:
            # Copies of a text are one before they are written.
            hits = _searched(rows, held, window, hits_only=True).dropDuplicates(["key"])
            earlier.append(stored(hits))
            held.unpersist()
    if earlier:
        known = reduce(DataFrame.unionByName, earlier).groupBy("key").agg(*(
            F.flatten(F.collect_list(c)).alias(c) for c in ("begins", "ends", "items")
        ))
        order = rows.columns
        rows = rows.drop("begins", "ends", "items").join(known, "key", "left").select(*order)
    found = _searched(rows, held, window, hits_only=False)
    return found.select(
        "doc_id", "n_words", "n_hit", "begins", "ends", "items",
        *(F.col(f"carried_{i}").alias(c) for i, c in enumerate(carry)),
    )
