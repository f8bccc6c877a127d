"""URL filters: rules by host and path, and a weighted vocabulary of URL terms.

Terms are found by an Aho-Corasick automaton in one pass over the lower-cased URL. A term
counts only between boundaries: neither neighbour is an ASCII letter or digit. Each distinct
term counts once with its weight; a URL is blocked when the weights reach ``BLOCK_WEIGHT``,
that is by one strict or by several distinct soft terms.

A rule names a host and the start of a path, and fits the host and its subdomains. The longest
rule that fits decides before the vocabulary does. A null URL, or one without ``://``, has an
empty host and path; null has no terms and is allowed. Repeated rows are judged each for itself.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import UPPER, ascii_lower

# Strict terms reject alone, soft terms only together.
STRICT_TERMS = (
    "porn", "porno", "pornography", "xxx", "hentai", "milf", "camgirls", "escorts",
    "warez", "keygen", "cracked", "torrent", "viagra", "cialis", "casino",
)
SOFT_TERMS = (
    "adult", "sex", "sexy", "nude", "naked", "webcam", "dating", "hookup", "bet", "betting",
    "poker", "slots", "jackpot", "gambling", "pills", "pharmacy", "loan", "payday", "forex",
    "crack", "serial", "free-download", "cheap", "replica",
)
BLOCK_WEIGHT = 2.0
VOCABULARY = {**dict.fromkeys(STRICT_TERMS, BLOCK_WEIGHT), **dict.fromkeys(SOFT_TERMS, 1.0)}

ALNUM = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")
LOWER = str.maketrans(UPPER, UPPER.lower())


class Rule(NamedTuple):
    """``text`` is a host and the start of a path, such as ``example.com/en/``."""

    text: str
    verdict: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return self.text[len(self.host) :]


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, lower-cased."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    return F.coalesce(ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.coalesce(path, F.lit(""))


def _rule_column(rules: Sequence[Rule], value) -> Column:
    """A CASE over the rules, the longest first: the first that fits is the longest."""
    column = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        host = (F.col("host") == rule.host) | F.col("host").endswith("." + rule.host)
        column = F.when(host & F.col("path").startswith(rule.path), value(rule)).otherwise(column)
    return column


def _automaton(vocabulary: dict[str, float]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for number, (term, weight) in enumerate(sorted(vocabulary.items())):
        found.add_word(term.translate(LOWER), (number, len(term), weight))
    found.make_automaton()
    return found


def term_weights(url: str | None, automaton: ahocorasick.Automaton, block: float):
    """(strict hits, distinct strict terms, distinct soft terms, weight) of one URL."""
    text = (url or "").translate(LOWER)
    hits, strict, soft = 0, set(), {}
    for end, (number, size, weight) in automaton.iter(text):
        start = end + 1 - size
        if start and text[start - 1] in ALNUM or text[end + 1 : end + 2] in ALNUM:
            continue
        if weight >= block:
            hits += 1
            strict.add(number)
        else:
            soft[number] = weight
    return hits, len(strict), len(soft), len(strict) * block + sum(soft.values())


def url_filter(
    df: DataFrame,
    rules: Sequence[Rule] = (),
    vocabulary: dict[str, float] = VOCABULARY,
    block_weight: float = BLOCK_WEIGHT,
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """(page_id, url, host, path, rule, strict_hits, strict_terms, soft_terms, weight, verdict)
    for every row. The vocabulary is a parameter of the job and travels with the tasks."""
    terms = dict(vocabulary)
    if any(not term for term in terms):
        raise ValueError("an empty term would be everywhere")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(terms)
        for batch in batches:
            found = [term_weights(u, automaton, block_weight) for u in batch.column(1).to_pylist()]
            hits, strict, soft, weight = ([row[i] for row in found] for i in range(4))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(hits, pa.int64()),
                 pa.array(strict, pa.int64()), pa.array(soft, pa.int64()),
                 pa.array(weight, pa.float64())],
                names=["page_id", "url", "strict_hits", "strict_terms", "soft_terms", "weight"],
            )

    counted = df.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url")
    ).mapInArrow(
        run,
        "page_id long, url string, strict_hits long, strict_terms long, soft_terms long, "
        "weight double",
    )
    method = F.when(F.col("weight") >= block_weight, "block").otherwise("allow")
    placed = counted.select("*", url_host(F.col("url")).alias("host"),
                            url_path(F.col("url")).alias("path"))
    ruled = placed.withColumn("rule", _rule_column(rules, lambda r: F.lit(r.text)))
    decided = _rule_column(rules, lambda r: F.lit(r.verdict))
    return ruled.withColumn("verdict", F.coalesce(decided, method)).select(
        "page_id", "url", "host", "path", "rule", "strict_hits", "strict_terms", "soft_terms",
        "weight", "verdict",
    )
