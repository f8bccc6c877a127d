"""Exact token counts of a byte-level BPE vocabulary at every prefix of a text.

A sequence of tokens is the encoding of its text exactly if no merge crosses the border of any
two neighbours, and every prefix has exactly one such sequence. So one pass over the prefixes
finds each prefix's last token from earlier prefixes, and its count is that prefix's count
plus one. Counts are kept per distinct pre-token; a text's are running sums of them.

Null text counts as empty. The special strings of the vocabulary are one token each wherever
they stand, as the library has it. Repeated rows are counted each for itself. A vocabulary file
is read once per Python worker; its path must exist on the executors.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: how byte-level BPE splits a text before it merges.
PRE_TOKENS = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
CONTRACTIONS = {"'re", "'ve", "'ll"}  # fixed values: those with a prefix that splits anew
BLANK = regex.compile(r"\p{White_Space}+")
CACHE_WORDS = 1_000_000  # distinct pre-tokens a worker remembers before it starts afresh
CACHE_PAIRS = 1_000_000  # the same of pairs of tokens
PAIR = 1 << 20  # packs two token numbers into one
UNMERGED = -1  # the rank of a single byte
LAST = 1 << 60


def _byte_alphabet() -> str:
    """The character that stands for each byte: itself if printable, else one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return "".join(chr(b) if b in printable else chr(next(others)) for b in range(256))


class _Totals(dict):
    """The token count of each distinct pre-token, worked out when first asked for."""

    def __init__(self, prefixes):
        super().__init__()
        self.prefixes = prefixes

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        total = self[word] = self.prefixes(word)[-1]
        return total


class PrefixCounter:
    """Token counts of one vocabulary file (the JSON of the ``tokenizers`` library)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        model = described["model"]
        special = [t["content"] for t in described.get("added_tokens", []) if t["special"]]
        self.special = regex.compile("|".join(map(regex.escape, special)) or r"(?!)")
        alphabet = _byte_alphabet()
        self.alphabet = dict(enumerate(alphabet))
        ids = {char: i for i, char in enumerate(alphabet)}
        self.rank, self.parents, self.pair_rank = [UNMERGED] * 256, [None] * 256, {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            pair = ids[left], ids[right]
            ids[left + right] = len(self.rank)
            self.rank.append(rank)
            self.parents.append(pair)
            self.pair_rank[pair[0] * PAIR + pair[1]] = rank
        self.tokens = ahocorasick.Automaton()
        for token, i in ids.items():
            self.tokens.add_word(token, (i, len(token)))
        self.tokens.make_automaton()
        self.apart: dict[int, bool] = {}
        self.totals = _Totals(self.word_prefixes)

    def _separate(self, left: int, right: int) -> bool:
        """Whether the two tokens stay two when their bytes are encoded together.

        Merges are undone from the latest to the earliest on both sides of the border. While
        two pieces face each other, a merge of theirs that comes before either piece was
        used up would have crossed the border. Of equal ranks the left one comes first.
        """
        rank, left_until, right_until = self.rank, LAST, LAST
        while True:
            crossing = self.pair_rank.get(left * PAIR + right)
            if crossing is not None and crossing < left_until and crossing <= right_until:
                return False
            left_made, right_made = rank[left], rank[right]
            if left_made == right_made == UNMERGED:
                return True
            if left_made > right_made:
                left, left_until = self.parents[left][1], left_made
            else:
                right, right_until = self.parents[right][0], right_made

    def word_prefixes(self, word: str) -> list[int]:
        """The count of every prefix of one pre-token's bytes, the empty one included."""
        chars = word.encode("utf-8").decode("latin-1").translate(self.alphabet)
        counts, last, apart = [0] * (len(chars) + 1), [0] * (len(chars) + 1), self.apart
        done = 0  # prefixes up to here have their last token
        for at, (token, size) in self.tokens.iter(chars):  # longest first at each place
            if at < done:
                continue
            start = at + 1 - size
            if start:
                key = last[start] * PAIR + token
                fits = apart.get(key)
                if fits is None:
                    if len(apart) >= CACHE_PAIRS:
                        apart.clear()
                    fits = apart[key] = self._separate(last[start], token)
                if not fits:
                    continue
            done = at + 1
            counts[done] = counts[start] + 1
            last[done] = token
        return counts

    def count(self, text: str) -> int:
        """The number of tokens of a whole text."""
        pieces = self.special.split(text)
        tokens = self.totals.__getitem__
        found = sum(sum(map(tokens, PRE_TOKENS.findall(piece))) for piece in pieces)
        return found + len(pieces) - 1

    def prefixes(self, text: str) -> np.ndarray:
        """The number of tokens of ``text[:i]`` for every ``i`` from 0 to its length."""
        counts = np.zeros(len(text) + 1, np.int32)
        total, begin = 0, 0
        for special in [*self.special.finditer(text), None]:
            end = len(text) if special is None else special.start()
            last = (begin, total)  # where the last pre-token starts, and the count before it
            blank = None  # the same of a run of white space that goes on in the next pre-token
            for match in PRE_TOKENS.finditer(text, begin, end):
                word, at = match.group(), match.start()
                inner = self.word_prefixes(word)
                self._fill(counts, word, at, total, inner)
                if word in CONTRACTIONS:  # cut inside, its two characters part
                    counts[at + 2] = total + 2
                if blank and BLANK.match(word):  # cut there, the run is one pre-token
                    run = text[blank[0] : at + 1]
                    counts[at + 1] = blank[1] + self.totals[run]
                blank = (at, total) if BLANK.fullmatch(word) else None
                last = (at, total)
                total += inner[-1]
            if special is not None:
                for cut in range(special.start() + 1, special.end()):
                    again = PRE_TOKENS.findall(text[last[0] : cut])
                    counts[cut] = last[1] + sum(map(self.totals.__getitem__, again))
                total += 1
                begin = special.end()
                counts[begin] = total
        return counts

    def _fill(self, counts, word: str, at: int, total: int, inner: list[int]) -> None:
        if len(inner) == len(word) + 1:
            counts[at + 1 : at + len(word) + 1] = [total + c for c in inner[1:]]
        else:
            ends = accumulate(len(char.encode("utf-8")) for char in word)
            for i, byte in enumerate(ends, at + 1):
                counts[i] = total + inner[byte]


def longest_prefix(counts: np.ndarray, budget: int) -> int:
    """The longest cut within the budget; shorter ones may need more tokens. 0 if none fits."""
    fits = np.flatnonzero(counts <= budget)
    return int(fits[-1]) if len(fits) else 0


@lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def _mapped(df: DataFrame, path: str, id_col: str, text_col: str, schema: str, answer) -> DataFrame:
    """``answer(counter, text)`` gives a row's columns but the id."""
    names = [part.split()[0] for part in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = counter(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                rows = [answer(found, text or "") for text in part.column(1).to_pylist()]
                columns = [part.column(0), *map(list, zip(*rows, strict=True))]
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, pa.Array) else pa.array(c) for c in columns],
                    names=names,
                )

    rows = df.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    return rows.mapInArrow(run, schema)


def _as_long(n: int) -> np.int64:
    return np.int64(n)


def token_counts(
    df: DataFrame, path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit): the whole text's size in bytes and tokens."""

    def answer(found: PrefixCounter, text: str):
        n = found.count(text)
        return _as_long(len(text.encode("utf-8"))), _as_long(n), n > limit

    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    return _mapped(df, path, id_col, text_col, schema, answer)


def token_prefixes(
    df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, counts): the token count of every prefix, by its number of characters."""
    return _mapped(
        df, path, id_col, text_col, "doc_id long, counts array<int>",
        lambda found, text: (found.prefixes(text),),
    )


def truncated(
    df: DataFrame, path: str, budget: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, text, n_tokens): each text cut to the longest prefix within the budget."""

    def answer(found: PrefixCounter, text: str):
        counts = found.prefixes(text)
        cut = longest_prefix(counts, budget)
        return text[:cut], counts[cut]

    return _mapped(df, path, id_col, text_col, "doc_id long, text string, n_tokens int", answer)
