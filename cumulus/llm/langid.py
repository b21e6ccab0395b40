"""Language identification, word first.

Known words are scored by their log frequency in each language.  An unseen word
backs off to the longest character n-grams of it that are known: the mean over
its known 4-grams, else 3-grams, 2-grams, characters.

The model is fitted on a bounded sample of labelled documents (FIT_PER_LANG per
language, drawn by hash) and holds every word and n-gram of the sample with its
counts in all languages; the sample alone keeps its size from following the
corpus.  Every document is scored, over its whole text.

Defined results: NULL text and texts without a letter are 'und' with score 0, as
is everything if nothing was learned; a text of which nothing is known gets the
most frequent language with that language's share as score; ties go to the
language first in code-point order; NULL ids are never learned from and not held
out; every row gives one row; other columns are not looked at.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from cumulus.llm.common import checked_broadcast, cut, for_python, from_python, text_of

FIT_PER_LANG = 4000
LONGEST = 4
SMOOTH = 0.5
#: Words that the evidence behind a score counts as, at most.
EVIDENCE = 8
#: Unseen words whose vectors a worker keeps.
UNSEEN_KEPT = 200_000

WORD = re.compile(r"[^\W\d_]+")


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def grams(word: str, n: int) -> list[str]:
    marked = f"^{word}$" if n > 1 else word
    return [marked[i:i + n] for i in range(len(marked) - n + 1)]


def words_of(text: str) -> Counter:
    return Counter(WORD.findall(text.lower()))


def count_grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(lang, text) -> (lang, size, gram, n); size 0: words."""
    for b in batches:
        total: dict[str, list[Counter]] = {}
        for lang, text in zip(b["lang"], b["text"]):
            per = total.setdefault(lang, [Counter() for _ in range(LONGEST + 1)])
            for w, c in words_of(text_of(text)).items():
                per[0][w] += c
                for n in range(1, LONGEST + 1):
                    for g in grams(w, n):
                        per[n][g] += c
        rows = [(lang, n, g, c) for lang, per in total.items() for n in range(LONGEST + 1)
                for g, c in per[n].items()]
        yield pd.DataFrame(rows, columns=["lang", "size", "gram", "n"])


@dataclass
class Model:
    """The counts as columns, which stay small in the driver and on the way; each
    worker makes its index and matrices from them once."""
    langs: list[str]
    prior: np.ndarray
    #: by size (0: words): grams, their languages (places in langs) and counts
    counts: list[tuple[pa.ChunkedArray, np.ndarray, np.ndarray]]
    #: by size: languages x (all counts, kinds)
    whole: list[np.ndarray]

    @cached_property
    def tables(self) -> list[tuple[dict[str, int], np.ndarray]]:
        out = []
        for (names, lang, times), whole in zip(self.counts, self.whole):
            index: dict[str, int] = {}
            rows = np.fromiter((index.setdefault(g, len(index)) for part in names.chunks for g in part.to_pylist()),
                               np.int64, len(names))
            n = np.zeros((len(index), len(self.langs)))
            n[rows, lang] = times
            out.append((index, np.log((n + SMOOTH) / (whole[:, 0] + SMOOTH * (whole[:, 1] + 1)))))
        return out

    @property
    def index(self) -> list[dict[str, int]]:
        """By size: gram -> row of its matrix."""
        return [index for index, _ in self.tables]

    @property
    def logs(self) -> list[np.ndarray]:
        """By size: log frequencies by language."""
        return [logs for _, logs in self.tables]


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        per_lang: int = FIT_PER_LANG) -> Model:
    """docs: the documents to learn from, without the held-out ones."""
    labelled = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                           F.col(lang_col).alias("lang")).where("lang is not null and text is not null")
    sizes = cut(labelled.groupBy("lang").agg(F.count("*").alias("docs")))
    draw = F.pmod(F.xxhash64(F.lit("langid"), "id"), F.lit(1 << 32)) / F.lit(float(1 << 32))
    sample = labelled.join(checked_broadcast(sizes), "lang").where(draw < F.lit(float(per_lang)) / F.col("docs"))
    counts = (sample.select("lang", "text").mapInPandas(count_grams, "lang string, size int, gram string, n long")
              .groupBy("lang", "size", "gram").agg(F.sum("n").alias("n")))
    counts = cut(counts)

    totals = {(r.lang, r.size): (r.n, r.kinds) for r in counts.groupBy("lang", "size").agg(
        F.sum("n").alias("n"), F.count("*").alias("kinds")).collect()}
    share = {r.lang: r.docs for r in sizes.collect()}
    langs = sorted({lang for lang, _ in totals})
    prior = np.array([share[x] for x in langs], dtype=float)
    model = Model(langs, prior / max(1.0, prior.sum()), [], [])
    for size in range(LONGEST + 1):
        own = counts.where(F.col("size") == size).select("gram", "lang", "n").toArrow()
        at = pc.index_in(own["lang"], pa.array(langs, own["lang"].type))
        model.counts.append((own["gram"], at.to_numpy(), own["n"].to_numpy()))
        model.whole.append(np.array([totals.get((x, size), (0, 0)) for x in langs], dtype=float).reshape(-1, 2))
    return model


class Scorer:
    def __init__(self, model: Model):
        self.m, self.unseen = model, {}
        self.index, self.logs = model.index, model.logs

    def backoff(self, word: str) -> np.ndarray:
        got = self.unseen.get(word)
        if got is None:
            got = np.zeros(len(self.m.langs))
            for n in range(LONGEST, 0, -1):
                rows = [r for g in grams(word, n) if (r := self.index[n].get(g)) is not None]
                if rows:
                    got = self.logs[n][rows].mean(axis=0)
                    break
            if len(self.unseen) >= UNSEEN_KEPT:
                self.unseen.clear()
            self.unseen[word] = got
        return got

    def __call__(self, text: str) -> tuple[str, float]:
        words = words_of(text)
        if not self.m.langs or not any(c.isalpha() for w in words for c in w):
            return "und", 0.0
        known, times, total, n = [], [], np.zeros(len(self.m.langs)), 0
        index = self.index[0]
        for w, c in words.items():
            n += c
            r = index.get(w)
            if r is None:
                total += c * self.backoff(w)
            else:
                known.append(r)
                times.append(c)
        if known:
            total += np.asarray(times, dtype=float) @ self.logs[0][known]
        if not total.any():
            best = int(np.argmax(self.m.prior))
            return self.m.langs[best], float(self.m.prior[best])
        e = total * (min(n, EVIDENCE) / n)
        p = np.exp(e - e.max())
        best = int(np.argmax(total))
        return self.m.langs[best], float(p[best] / p.sum())


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score.  Only the text is looked at."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(shared.value)
        for b in batches:
            got = [scorer(text_of(t)) for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "lang_pred": [x[0] for x in got],
                                "score": [x[1] for x in got]})

    return from_python(for_python(docs, id_col, text_col).mapInPandas(
        run, "doc_id string, lang_pred string, score double"))
