"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads a text's bytes forwards and backwards and labels every byte with
probabilities of the languages; a document's probabilities are the mean over its bytes. Its
states start anew at white space, so a byte's label depends on its word alone and a word that
occurs again need not be read again: tasks label distinct words and add up by occurrence. Words
longer than ``PIECE`` bytes are read in pieces of at most that length, cut between characters.

The network is trained in numpy by backpropagation through time, on the driver, from a bounded
sample of every language: about ``sample_rows`` labelled rows of each, chosen by a hash of id and
text among distinct rows, and of each row at most ``WORDS_PER_ROW`` words drawn from its whole
text, in the tasks, so that only those words come to the driver. The languages share about ``SAMPLE_WORDS`` words, but none has a share of less than
``LEAST_WORDS``: of many languages, rows give fewer words, and then fewer rows are drawn.
States and steps of training grow with the logarithm of the number of languages (`network_size`).
Prediction reads the whole text of every row and nothing but the text.

Null texts, and texts without a letter, are ``und`` with score 0, as is everything when there
is nothing to learn from. Ties go to the first language by name. Repeated rows are judged each
for itself. Very long texts are read whole, one at a time; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import stored

UNDETERMINED = "und"
PIECE = 32
STATES_PER_BIT = 2  # states and steps for each doubling of the languages
STEPS_PER_BIT = 150
BATCH = 256
RATE = 0.02
SAMPLE_ROWS = 400
WORDS_PER_ROW = 300
SAMPLE_WORDS = 1_000_000
LEAST_WORDS = 200
CACHED_WORDS = 800_000  # words whose labels a task remembers before it starts afresh
CACHED_LABELS = 1 << 25  # and at most so many labels, for many languages
LABEL_BATCH = 4096
LABELS_AT_ONCE = 1 << 24  # positions times languages
ASCII_LETTER = re.compile("[A-Za-z]")


def _sigmoid(x):
    return 1 / (1 + np.exp(np.clip(-x, -60, 60)))


def _tanh(x):
    return 2 * _sigmoid(2 * x) - 1  # numpy has a fast exponential of 32-bit floats


@dataclass
class Direction:
    """One gated recurrent layer. ``inputs`` has, per byte, what it adds to the update gate,
    the reset gate and the candidate; ``recurrent`` is the same for the state before."""

    inputs: np.ndarray
    recurrent: np.ndarray

    def run(self, data: np.ndarray, keep: bool = False):
        """States (length, batch, hidden) of equally long byte sequences (batch, length)."""
        hidden = self.recurrent.shape[0]
        state = np.zeros((len(data), hidden), np.float32)
        states, steps = [], []
        for at in range(data.shape[1]):
            given = self.inputs[data[:, at]]
            own = state @ self.recurrent
            gates = _sigmoid(given[:, : 2 * hidden] + own[:, : 2 * hidden])
            update, reset = gates[:, :hidden], gates[:, hidden:]
            pulled = own[:, 2 * hidden :]
            candidate = _tanh(given[:, 2 * hidden :] + reset * pulled)
            after = candidate + update * (state - candidate)
            if keep:
                steps.append((state, update, reset, pulled, candidate))
            state = after
            states.append(state)
        return np.stack(states), steps

    def gradients(self, data: np.ndarray, steps: list, wanted: np.ndarray):
        """Of the inputs and the recurrent weights, by going back through the steps."""
        hidden = self.recurrent.shape[0]
        of_inputs, of_recurrent = np.zeros_like(self.inputs), np.zeros_like(self.recurrent)
        later = np.zeros((len(data), hidden), np.float32)
        for at in range(data.shape[1] - 1, -1, -1):
            before, update, reset, pulled, candidate = steps[at]
            total = wanted[at] + later
            to_update = total * (before - candidate) * update * (1 - update)
            to_candidate = total * (1 - update) * (1 - candidate**2)
            to_reset = to_candidate * pulled * reset * (1 - reset)
            to_inputs = np.concatenate([to_update, to_reset, to_candidate], axis=1)
            to_own = np.concatenate([to_update, to_reset, to_candidate * reset], axis=1)
            later = total * update + to_own @ self.recurrent.T
            of_recurrent += before.T @ to_own
            chosen = np.zeros((256, len(data)), np.float32)
            chosen[data[:, at], np.arange(len(data))] = 1
            of_inputs += chosen @ to_inputs
        return of_inputs, of_recurrent


@dataclass
class Network:
    languages: list[str]
    forward: Direction
    backward: Direction
    output: np.ndarray  # (2 * hidden, languages)
    bias: np.ndarray

    def _weights(self) -> list[np.ndarray]:
        return [self.forward.inputs, self.forward.recurrent, self.backward.inputs,
                self.backward.recurrent, self.output, self.bias]

    def label(self, data: np.ndarray) -> np.ndarray:
        """Probabilities (length, batch, languages) of every position."""
        there, _ = self.forward.run(data)
        back, _ = self.backward.run(data[:, ::-1])
        return self._probabilities(there, back[::-1])

    def _probabilities(self, there, back):
        hidden = there.shape[2]
        scores = there @ self.output[:hidden] + back @ self.output[hidden:] + self.bias
        scores = np.exp(scores - scores.max(axis=2, keepdims=True))
        return scores / scores.sum(axis=2, keepdims=True)

    def gradients(self, data: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
        """Of the mean cross-entropy over all positions."""
        there, forward_steps = self.forward.run(data, keep=True)
        back, backward_steps = self.backward.run(data[:, ::-1], keep=True)
        back = back[::-1]
        error = self._probabilities(there, back)
        error[:, np.arange(len(data)), labels] -= 1
        error /= data.size
        hidden = there.shape[2]
        both = np.concatenate([there, back], axis=2)
        of_output = np.tensordot(both, error, axes=([0, 1], [0, 1]))
        wanted = error @ self.output.T
        return [
            *self.forward.gradients(data, forward_steps, wanted[:, :, :hidden]),
            *self.backward.gradients(
                data[:, ::-1], backward_steps, wanted[::-1, :, hidden:]
            ),
            of_output, error.sum(axis=(0, 1)),
        ]


def pieces(text: bytes) -> list[bytes]:
    """The words, cut to pieces of whole characters, each with one blank before it."""
    found = []
    for word in text.split():
        at = 0
        while len(word) - at > PIECE:
            end = at + PIECE
            while end > at + PIECE - 4 and word[end] & 0xC0 == 0x80:  # inside a character
                end -= 1
            found.append(word[at:end])
            at = end
        found.append(word[at:])
    return found


def _matrix(words: list[bytes]) -> np.ndarray:
    """Equally long words as bytes (batch, 1 + length)."""
    return np.frombuffer(b"".join(b" " + w for w in words), np.uint8).reshape(len(words), -1)


def network_size(languages: int) -> tuple[int, int]:
    """The states of a direction and the steps of training for so many languages."""
    bits = math.log2(max(2, languages))
    return 4 + round(STATES_PER_BIT * bits), round(STEPS_PER_BIT * bits)


def train(
    samples: list[tuple[str, bytes]], hidden: int | None = None, steps: int | None = None,
    seed: int = 7,
) -> Network | None:
    """A network from (language, text) samples; the same for the same samples. States and steps
    are those of `network_size` unless given."""
    languages = sorted({language for language, _ in samples})
    if not languages:
        return None
    numbers = {language: i for i, language in enumerate(languages)}
    by_rule = network_size(len(languages))
    hidden, steps = hidden or by_rule[0], steps or by_rule[1]
    batch = min(BATCH, max(1, LABELS_AT_ONCE // ((PIECE + 1) * len(languages))))
    random = np.random.default_rng(seed)
    by_length: dict[int, tuple[list[bytes], list[int]]] = {}
    drawn: list[list[bytes]] = [[] for _ in languages]
    for language, text in sorted(samples):
        words = pieces(text)
        if len(words) > WORDS_PER_ROW:
            words = [words[i] for i in random.choice(len(words), WORDS_PER_ROW, replace=False)]
        drawn[numbers[language]].extend(words)
    most = max(map(len, drawn))
    for number, words in enumerate(drawn):  # every language as often as the most frequent
        again = random.choice(len(words), most - len(words)) if words else []
        for word in [*words, *(words[i] for i in again)]:
            own = by_length.setdefault(len(word), ([], []))
            own[0].append(word)
            own[1].append(number)
    if not by_length:
        return None

    def weights(*shape):
        return (random.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

    def direction():
        inputs = 0.3 * random.standard_normal((256, 3 * hidden))
        return Direction(inputs.astype(np.float32), weights(hidden, 3 * hidden))

    network = Network(languages, direction(), direction(),
                      weights(2 * hidden, len(languages)), np.zeros(len(languages), np.float32))
    lengths = sorted(by_length)
    # Longer words have more positions; each position should count alike.
    share = np.array([len(by_length[n][0]) * (n + 1) for n in lengths], float)
    data = {n: (_matrix(by_length[n][0]), np.array(by_length[n][1])) for n in lengths}
    means = [np.zeros_like(w) for w in network._weights()]
    squares = [np.zeros_like(w) for w in network._weights()]
    for step in range(1, steps + 1):
        inputs, labels = data[lengths[random.choice(len(lengths), p=share / share.sum())]]
        rows = random.integers(0, len(labels), batch)
        found = network.gradients(inputs[rows], labels[rows])
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for weight, slope, mean, square in zip(
            network._weights(), found, means, squares, strict=True
        ):
            mean += 0.1 * (slope - mean)
            square += 0.005 * (slope**2 - square)
            scaled = np.sqrt(square / (1 - 0.995**step)) + 1e-8
            weight -= (rate * mean / (1 - 0.9**step) / scaled).astype(np.float32)
    return network


class Labeller:
    """Sums of the labels over the positions of words, remembered by word."""

    def __init__(self, network: Network):
        self.network = network
        many = len(network.languages)
        self.batch = min(LABEL_BATCH, max(1, LABELS_AT_ONCE // ((PIECE + 1) * many)))
        self.cached = min(CACHED_WORDS, CACHED_LABELS // many)
        self.places: dict[bytes, int] = {}
        self.sums = np.zeros((0, len(network.languages)), np.float32)

    def learn(self, words: set[bytes]) -> None:
        fresh = sorted((w for w in words if w not in self.places), key=lambda w: (len(w), w))
        if not fresh:
            return
        rows, at = [], 0
        while at < len(fresh):
            end = at
            while end < len(fresh) and end - at < self.batch and len(fresh[end]) == len(fresh[at]):
                end += 1
            rows.append(self.network.label(_matrix(fresh[at:end])).sum(axis=0))
            at = end
        self.places.update(zip(fresh, range(len(self.places), len(self.places) + len(fresh)),
                               strict=True))
        self.sums = np.concatenate([self.sums, *rows])

    def judge(self, texts: list[str | None]) -> list[tuple[str, float]]:
        words = [pieces(t.encode("utf-8")) if has_letter(t) else [] for t in texts]
        if len(self.places) > self.cached:
            self.places.clear()
            self.sums = self.sums[:0]
        self.learn(set().union(*words))
        found = []
        for own in words:
            if not own:
                found.append((UNDETERMINED, 0.0))
                continue
            places = np.fromiter(map(self.places.__getitem__, own), np.int64, len(own))
            total = self.sums[places].sum(axis=0, dtype=np.float64)
            total /= total.sum()
            best = int(total.argmax())
            found.append((self.network.languages[best], min(1.0, float(total[best]))))
        return found


def has_letter(text: str | None) -> bool:
    return bool(text) and (
        ASCII_LETTER.search(text) is not None or any(map(str.isalpha, text))
    )


def drawn_words(text: str, most: int, seed: int) -> bytes:
    """At most so many words of the whole text."""
    words = pieces(text.encode("utf-8"))
    if len(words) > most:
        random = np.random.default_rng(seed % (1 << 64))
        words = [words[i] for i in random.choice(len(words), most, replace=False)]
    return b" ".join(words)


def sample_of(
    df: DataFrame, learn: Column, id_col: str, text_col: str, lang_col: str, rows: int
) -> list[tuple[str, bytes]]:
    """About ``rows`` distinct rows of each language, at least one and at most twice as many,
    by a hash of id and text."""
    named = df.filter(learn).select(
        F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"),
        F.col(lang_col).cast("string").alias("lang"),
    ).filter("lang is not null and text is not null").withColumn("key", F.xxhash64("id", "text"))
    draw = F.pmod("key", F.lit(1 << 30)) / float(1 << 30)
    # Written, so that its size is known and texts are not shuffled to meet a few languages.
    counts = stored(named.groupBy("lang").agg(
        F.approx_count_distinct("key").alias("count"), F.min(draw).alias("least")
    ))
    languages = counts.count()
    if not languages:
        return []
    share = max(LEAST_WORDS, SAMPLE_WORDS // languages)
    rows = max(1, min(rows, share))
    fraction = F.greatest("least", F.lit(float(rows)) / F.greatest("count", F.lit(1)))
    each = min(WORDS_PER_ROW, max(1, share // rows))

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [  # one text as a Python string at a time
                drawn_words(text.as_py(), each, key.as_py())
                for text, key in zip(batch.column(2), batch.column(1), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(found, pa.binary())], names=["lang", "key", "words"]
            )

    chosen = named.join(counts.select("lang", fraction.alias("fraction")), "lang").filter(
        draw <= F.col("fraction")
    ).select("lang", "key", "text").mapInArrow(
        words, "lang string, key long, words binary"
    ).dropDuplicates(["lang", "key"]).withColumn(
        "place", F.row_number().over(Window.partitionBy("lang").orderBy(draw, "key"))
    ).filter(F.col("place") <= 2 * rows)
    return [(r["lang"], bytes(r["words"])) for r in chosen.toLocalIterator()]


def identify_languages(
    df: DataFrame,
    learn: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample_rows: int = SAMPLE_ROWS,
    carry: tuple[str, ...] = (),
    letter_col: str | None = None,
) -> DataFrame:
    """(doc_id, lang_pred, score) for every row, with the columns of ``carry`` behind them and,
    if ``letter_col`` names it, whether the text has a letter. ``learn`` says which rows may be
    learned from."""
    network = train(sample_of(df, learn, id_col, text_col, lang_col, sample_rows))
    rows = df.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
        *(F.col(c).alias(f"carried_{i}") for i, c in enumerate(carry)),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(network) if network else None
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                texts = part.column(1).to_pylist()
                judged = labeller.judge(texts) if labeller else [(UNDETERMINED, 0.0)] * len(texts)
                languages, scores = zip(*judged, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(languages, pa.string()),
                     pa.array(scores, pa.float64()), pa.array(map(has_letter, texts), pa.bool_()),
                     *part.columns[2:]],
                    names=["doc_id", "lang_pred", "score", "letter", *part.schema.names[2:]],
                )

    carried = "".join(
        f", carried_{i} {rows.schema[f'carried_{i}'].dataType.simpleString()}"
        for i in range(len(carry))
    )
    judged = rows.mapInArrow(
        run, "doc_id long, lang_pred string, score double, letter boolean" + carried
    )
    return judged.select(
        "doc_id", "lang_pred", "score",
        *(F.col(f"carried_{i}").alias(c) for i, c in enumerate(carry)),
        *([F.col("letter").alias(letter_col)] if letter_col else []),
    )


def held_out(id_column: Column, folds: int, fold: int) -> Column:
    """Whether the CRC-32 of the id as text falls into the fold; a null id does not."""
    code = F.crc32(id_column.cast("string").cast("binary"))
    return F.coalesce(F.pmod(code, F.lit(folds)) == fold, F.lit(False))
