"""How like words a run of key characters is, by the letter pairs of the corpus.

Texts are chains of symbols: letters (case aside), digit, and a break for all
else, also between a small and a capital letter of one run, as identifiers are
written.  The corpus's pairs of symbols, over a prior of vowels, consonants and
digits, give each pair's probability.  A run of words has about the corpus's
mean log-probability; random characters lose bits at every pair.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of

DIGIT, BREAK, N = 26, 27, 28
# Symbol of each byte, and which bytes can be part of a run.
SYMBOL = np.full(256, BREAK, np.uint8)
SYMBOL[48:58] = DIGIT
SYMBOL[65:91] = SYMBOL[97:123] = np.arange(26)
KEY = np.zeros(256, bool)
KEY[[*range(48, 58), *range(65, 91), *range(97, 123), *b"+/_-"]] = True
LONG = 20  # runs that may be secrets: the corpus's words are counted outside them
# Prior: from vowel, consonant, digit, break to vowel, consonant, digit, break; it weighs as much as so many pairs.
PRIOR = ((0.15, 0.6, 0.002, 0.248), (0.45, 0.3, 0.002, 0.248), (0.005, 0.005, 0.5, 0.49), (0.25, 0.7, 0.03, 0.02))
WEIGHT = 5000
# However large the corpus, its words may be few: the prior keeps this share.
SHARE = 0.1
# Words of a language that the corpus lacks lose what the corpus says more than the prior (times FOREIGN), in bits a
# pair, at most so many.
FOREIGN, MOST = 1.0, 2.5


def pair_counts(texts: pa.Array) -> np.ndarray:
    """Counts (28 x 28) of neighbouring symbols in each text of an Arrow string array without nulls, breaks around it."""
    if not len(texts) or texts.buffers()[2] is None:
        return np.zeros((N, N), np.int64)
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    at = np.frombuffer(texts.buffers()[1], kind)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    total, step = np.zeros(N * N, np.int64), 1 << 22
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(at, at[first] + step, "right")) - 1)
        data = np.frombuffer(texts.buffers()[2], np.uint8)[at[first]:at[last]]
        starts = np.unique(at[first:last] - at[first])
        starts = starts[starts < len(data)]
        if len(data):
            s = SYMBOL[data]
            key = KEY[data]
            cut = np.ones(len(s) + 1, bool)  # where a run begins or ends
            cut[1:-1] = key[1:] != key[:-1]
            cut[starts] = True
            cuts = np.flatnonzero(cut)
            long = np.flatnonzero(key[cuts[:-1]] & (np.diff(cuts) >= LONG))
            for a, b in zip(cuts[long], cuts[long + 1]):
                s[a:b] = BREAK
            inner = np.ones(len(s) - 1, bool)
            inner[starts[starts > 0] - 1] = False
            pairs = s[:-1].astype(np.uint16) * np.uint16(N) + s[1:]
            pairs[~inner] = BREAK * N + BREAK
            total += np.bincount(pairs, minlength=N * N)
            ends = np.concatenate((starts[1:], [len(s)])) - 1
            total += np.bincount(BREAK * N + s[starts].astype(np.int64), minlength=N * N)
            total += np.bincount(s[ends].astype(np.int64) * N + BREAK, minlength=N * N)
        first = last
    total[BREAK * N + BREAK] = 0
    return total.reshape(N, N)


def corpus_pairs(docs: DataFrame, text_col: str) -> np.ndarray:
    """The pairs of all rows: a table of fixed size from each task, summed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((N, N), np.int64)
        for b in batches:
            total += pair_counts(b.column("text"))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel()[at])], ["pair", "n"])

    rows = docs.select(text_of(text_col).alias("text")).mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n"))
    out = np.zeros(N * N, np.int64)
    for pair, n in rows.collect():  # at most 784 rows
        out[pair] = n
    return out.reshape(N, N)


def _steady(prob: np.ndarray) -> np.ndarray:
    share = np.full(N, 1 / N)
    for _ in range(200):
        share = share @ prob
    return share / share.sum()


@dataclass
class WordModel:
    """Bits of each pair of symbols; mean and variance of a pair within words; what foreign words lose besides."""

    bits: np.ndarray
    mean: float
    var: float
    slack: float

    @classmethod
    def of(cls, counts: np.ndarray) -> WordModel:
        kind = np.array([*(0 if c in b"aeiouy" else 1 for c in range(97, 123)), 2, 3])
        size = np.bincount(kind)[kind]
        prior = np.array(PRIOR)[kind][:, kind] / size
        prior /= prior.sum(axis=1, keepdims=True)
        prob = counts + WEIGHT * prior * _steady(prior)[:, None]
        prob = (1 - SHARE) * prob / prob.sum(axis=1, keepdims=True) + SHARE * prior
        bits = np.log2(prob)
        share = _steady(prob)[:, None] * prob
        mean = float((share * bits).sum())
        gain = mean - float((share * np.log2(prior)).sum())  # what the corpus says more than the prior, in bits a pair
        return cls(bits, mean, float((share * (bits - mean) ** 2).sum()), min(MOST, FOREIGN * max(0.0, gain)))

    def p_words(self, run: str) -> float:
        """p-value of "these are words": how seldom words, foreign ones too, have so few bits."""
        data = np.frombuffer(run.encode(), np.uint8)
        s = SYMBOL[data].astype(np.int64)
        turn = np.flatnonzero((data[:-1] >= 97) & (data[:-1] <= 122) & (data[1:] >= 65) & (data[1:] <= 90)) + 1
        s = np.concatenate(([BREAK], np.insert(s, turn, BREAK), [BREAK]))
        v = self.bits[s[:-1], s[1:]]
        z = (float(v.sum()) - len(v) * (self.mean - self.slack)) / math.sqrt(len(v) * self.var)
        return 0.5 * math.erfc(-z / math.sqrt(2))
