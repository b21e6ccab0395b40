"""Periodic runs of words in whole texts, and texts without their repetitions.

A run is a stretch of consecutive words with smallest period q (words q apart are
identical) and at least max(least, times * q) words that no neighbouring word
extends.  Found by seeds and extension along diagonals, the word pairs (i, i + lag):

1. On its diagonal a run of period q matches over max(least - q, (times - 1) * q)
   words at least.  So a k-gram at its start occurs again q words later, for every k
   up to that.  Lags up to the smallest such overlap (16 words for 24 and 3) are
   sought with one k-gram length; each doubling of the lags doubles k.
2. Always q <= k, so the first occurrence after the run's start is the one q later:
   an earlier one would turn the root of the run into itself.  Hence the pairs to
   look at are the neighbours among a gram's occurrences in the document, at most
   one pair per word and k, however often a gram occurs.
3. Of the pairs on a diagonal the first is extended to both sides, word by word,
   until words differ; the table of the furthest place covered per lag keeps the
   others from being extended again.

Grams of the first length are compared by hash and then word by word; longer ones
by the names of their halves, which is exact.  Many texts are worked on together
in one array, words of different texts never match.

Defined results: NULL text is empty; texts without words have no runs and are empty
when collapsed; repeated rows and NULL ids are treated like any other row; an empty
table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from cumulus.llm.common import for_python, from_python, text_of

LEAST, TIMES = 24, 3
#: Words of the texts that are worked on together; a longer text goes alone.
WORDS_AT_ONCE = 400_000

RUN = "struct<start long, length long, period long>"


def overlap(least: int, times: int) -> int:
    """Words over which any run matches on its diagonal, at least."""
    return min(max(least - q, (times - 1) * q) for q in range(1, least + 1))


def mixed(a: np.ndarray, b: np.ndarray, seed: int) -> np.ndarray:
    """Hashes of pairs of 64-bit numbers."""
    x = a * np.uint64(0x9E3779B97F4A7C15 ^ (seed << 1)) + b * np.uint64(0xC2B2AE3D27D4EB4F)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def next_same(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbours with equal keys: positions (i, j), i < j, and a number for each key."""
    order = np.argsort(keys, kind="stable")
    equal = keys[order[1:]] == keys[order[:-1]]
    names = np.empty(len(keys), dtype=np.int64)
    names[order] = np.concatenate(([0], np.cumsum(~equal))) if len(keys) else 0
    return order[:-1][equal], order[1:][equal], names


def first_grams(codes: np.ndarray, k: int) -> np.ndarray:
    """A number per k-gram, equal if and only if the words are; k is a power of two."""
    for seed in range(64):
        h, size = mixed(codes.astype(np.uint64), np.uint64(1) + codes.astype(np.uint64), seed), 1
        while size < k:
            h, size = mixed(h[:-size], h[size:], seed), size * 2
        i, j, names = next_same(h)
        # equal neighbours in words as well: so are all of that hash
        if all(np.array_equal(codes[i + n], codes[j + n]) for n in range(k)):
            return names
    raise RuntimeError("no seed tells the grams apart")


def seeds(codes: np.ndarray, doc: np.ndarray, least: int, times: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, lags) of the pairs to extend, for each k."""
    k = 1 << (overlap(least, times).bit_length() - 1)
    low = 0
    if len(codes) < k:
        return
    at = np.arange(len(codes) - k + 1)
    i, j, names = next_same(first_grams(codes, k))
    while True:
        i, j = at[i], at[j]
        own = doc[i] == doc[j]
        i, j = i[own], j[own]
        lag = j - i
        wanted = (lag > low) & (lag <= k)
        yield i[wanted], lag[wanted]
        # a gram twice as long occurs again only where both of its halves do
        name = np.full(len(codes), -1, dtype=np.int64)
        again = np.union1d(i, j)
        name[again] = names[np.searchsorted(at, again)]
        again = again[again + k < len(codes)]
        again = again[name[again + k] >= 0]
        if not len(again):
            return
        keys = name[again] * np.int64(len(codes) + 1) + name[again + k]
        at, low, k = again, k, k * 2
        i, j, names = next_same(keys)


def matching(a: np.ndarray, b: np.ndarray) -> int:
    """Number of equal elements before the first difference; looks in growing steps."""
    n, step, end = 0, 64, min(len(a), len(b))
    a, b = a[:end], b[:end]
    while n < end:
        differ = np.flatnonzero(a[n:n + step] != b[n:n + step])
        if len(differ):
            return n + int(differ[0])
        n, step = n + step, step * 2
    return end


def find(codes: np.ndarray, doc: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start, then period.  Documents stand
    one after another, each followed by a code that occurs once."""
    if times < 3:
        raise ValueError("a run repeats its period three times at least")
    found = []
    for at, lag in seeds(codes, doc, least, times):
        order = np.lexsort((at, lag))
        at, lag = at[order], lag[order]
        # on one diagonal, only the first of adjoining pairs can be uncovered
        first = np.ones(len(at), dtype=bool)
        first[1:] = (lag[1:] != lag[:-1]) | (at[1:] != at[:-1] + 1)
        covered: dict[int, int] = {}
        for i, d in zip(at[first].tolist(), lag[first].tolist()):
            if covered.get(d, -1) > i:
                continue
            end = i + matching(codes[i:], codes[i + d:])
            start = i - matching(codes[:i][::-1], codes[:i + d][::-1])
            covered[d] = end
            length = end + d - start
            if length >= max(least, times * d):
                found.append((start, length, d))
    return sorted(found, key=lambda r: (r[0], r[2]))


class Lot:
    """Some texts' words in one array."""

    def __init__(self):
        self.ids, self.words, self.codes, self.known = [], [], [], {}
        self.size = 0

    def add(self, doc_id, text: str) -> None:
        words = text.encode("utf-8", "replace").split()
        know = self.known.setdefault
        self.codes.append(np.fromiter((know(w, len(self.known)) for w in words), dtype=np.int64, count=len(words)))
        self.ids.append(doc_id)
        self.words.append(words)
        self.size += len(words)

    def result(self, least: int, times: int) -> pd.DataFrame:
        sizes = np.array([len(w) for w in self.words], dtype=np.int64)
        begin = np.concatenate(([0], np.cumsum(sizes + 1)))
        codes = np.empty(begin[-1], dtype=np.int64)
        for n, own in enumerate(self.codes):
            codes[begin[n]:begin[n] + len(own)] = own
        # the code after each document occurs once
        codes[begin[1:] - 1] = len(self.known) + np.arange(len(sizes))
        doc = np.repeat(np.arange(len(sizes)), sizes + 1)
        runs: list[list[dict]] = [[] for _ in self.ids]
        dropped: dict[int, np.ndarray] = {}
        for start, length, period in find(codes, doc, least, times):
            n = int(doc[start])
            first = start - int(begin[n])
            runs[n].append({"start": first, "length": length, "period": period})
            out = dropped.setdefault(n, np.zeros(int(sizes[n]) + 1, dtype=np.int64))
            out[first + period] += 1
            out[first + length] -= 1
        kept = []
        for n, words in enumerate(self.words):
            if n in dropped:
                inside = np.cumsum(dropped[n])[:-1]
                words = [words[w] for w in np.flatnonzero(inside == 0)]
            kept.append(b" ".join(words).decode("utf-8"))
        return pd.DataFrame({"doc_id": self.ids, "runs": runs, "collapsed": kept})


def find_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """doc_id; runs, an array of (start, length, period) by start, then period, in
    words; collapsed, the text's words without those after the first period of any
    run that contains them, joined by single blanks."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lot = Lot()
        for b in batches:
            for doc_id, text in zip(b["doc_id"], b["text"]):
                lot.add(doc_id, text_of(text))
                if lot.size >= WORDS_AT_ONCE or len(lot.ids) >= 4096:
                    yield lot.result(least, times)
                    lot = Lot()
        if lot.ids:
            yield lot.result(least, times)

    return from_python(for_python(docs, id_col, text_col).mapInPandas(
        run, f"doc_id string, runs array<{RUN}>, collapsed string"))


def greatest(runs: Column) -> Column:
    """The run with the greatest length / period; of equals the first one; NULL if none."""
    none = F.lit(None).cast(RUN)
    return F.aggregate(runs, none, lambda best, r: F.when(
        best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best))
