"""Quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or nothing on each document.
Expectation-maximisation estimates, without any label, how often each labeller
gives each vote to good and to bad documents (its accuracies) and how many
documents are good; it runs on the counts of vote patterns over all documents, of
which there are at most 3^labellers.  Most labellers know one kind of bad document
only, so they don't agree on bad ones; so bad documents are a mixture of one kind
per labeller, and Dirichlet priors say what a kind is: its labeller mostly votes bad
on it, and a bad vote is rarely wrong on good documents.  The priors count as a share
of the corpus and bound nothing: rounds move every pattern and every accuracy.  Each
pattern's posterior then labels documents softly, and a logistic model over hashed words and word shapes is trained on them, from a
sample of at most FIT_ROWS documents drawn by hash.  Every document is scored,
over its whole text.

Defined results: NULL and empty texts get the vote 'bad' of the length labeller,
no features, and the score that the model's intercept gives; an empty table
gives an empty result; repeated rows and NULL ids are scored like any other row;
other columns are not looked at.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from cumulus.llm.common import for_python, from_python, stored, text_of
from cumulus.llm.quality_rules import NAMES, measure

BITS = 16
FIT_ROWS = 12_000
ROUNDS = 200
KEEP = 0.5
#: Where EM starts: belief in documents that no labeller votes against, and in others.
UNDOUBTED, DOUBTED = 0.95, 0.1
#: Means of the priors: bad votes on good documents, of a kind's own labeller on it.
WRONG, RIGHT = 0.002, 0.9
#: Weights of these priors, as shares of the corpus.
GOOD_WEIGHT, KIND_WEIGHT = 0.1, 0.05
#: A bin counts as much as that many equal words.
BIN_WEIGHT = 200
#: Length of every feature vector.
LENGTH = 8.0

#: labeller -> (value, bad beyond, good within); (low bad, low good, high good, high bad)
LABELLERS: dict[str, tuple[str, tuple[float, float, float, float]]] = {
    "length": ("n_words", (2, 50, 50_000, 10_000_000)),
    "word_length": ("word_chars / n_words", (2.0, 3.0, 10.0, 15.0)),
    "symbols": ("n_symbols / n_words", (-1, 0, 0.02, 0.2)),
    "capitals": ("n_upper / n_letters", (-1, 0, 0.15, 0.5)),
    "marks": ("n_marks / n_words", (-1, 0, 0.1, 0.4)),
    "repeated_words": ("n_repeat_words / n_words", (-1, 0, 0.2, 0.6)),
    "repeated_lines": ("n_dup_lines / n_lines", (-1, 0, 0.1, 0.75)),
    "digits": ("n_digits / word_chars", (-1, 0, 0.1, 0.4)),
}
BAD, NONE, GOOD = 0, 1, 2


def votes(m: dict[str, int]) -> list[int]:
    out = []
    for ratio, (low_bad, low_good, high_good, high_bad) in LABELLERS.values():
        a, _, b = ratio.partition(" / ")
        if b and not m[b]:
            out.append(NONE)
            continue
        v = m[a] / m[b] if b else m[a]
        out.append(BAD if v <= low_bad or v >= high_bad else GOOD if low_good <= v <= high_good else NONE)
    return out


def measured(text: str) -> dict[str, int]:
    return dict(zip(NAMES, measure(text)))


def pattern_of(m: dict[str, int]) -> int:
    """The votes on a measured text as one number."""
    code = 0
    for v in votes(m):
        code = code * 3 + v
    return code


def unpack(codes: np.ndarray) -> np.ndarray:
    """One row of votes per pattern."""
    n = len(LABELLERS)
    return (codes[:, None] // 3 ** np.arange(n - 1, -1, -1)) % 3


@dataclass
class WeakLabels:
    prior: float
    #: labeller x class (bad, good) x vote: P(vote | class)
    accuracy: np.ndarray
    posterior: dict[int, float]     # pattern -> P(good)


def estimate(counts: dict[int, int], rounds: int = ROUNDS) -> WeakLabels:
    """EM over vote patterns with the classes good and one kind of bad per labeller;
    starts from doubt where any labeller votes bad."""
    codes = np.array(sorted(counts), dtype=np.int64)
    n = np.array([counts[c] for c in codes], dtype=float)
    v = unpack(codes)
    k = len(LABELLERS)
    one_hot = (v[:, :, None] == np.arange(3)).astype(float)
    if not len(codes):
        return WeakLabels(0.9, np.full((k, 2, 3), 1 / 3), {})
    base = (np.einsum("i,ijk->jk", n, one_hot) + 1) / (n.sum() + 3)
    others = base[:, NONE:] / base[:, NONE:].sum(axis=1, keepdims=True)

    def votes_with(bad: float) -> np.ndarray:
        return np.hstack([np.full((k, 1), bad), (1 - bad) * others])

    # class x labeller x vote; one imaginary document says how other labellers vote on a kind
    imagined = np.concatenate([GOOD_WEIGHT * n.sum() * votes_with(WRONG)[None], np.repeat(base[None], k, axis=0)])
    own = np.arange(k)
    imagined[own + 1, own] = KIND_WEIGHT * n.sum() * votes_with(RIGHT)
    bad = v == BAD
    doubt = bad.any(axis=1, keepdims=True)
    p = np.where(doubt, DOUBTED, UNDOUBTED)
    kinds = np.where(doubt, bad / np.maximum(bad.sum(axis=1, keepdims=True), 1), 1 / k)
    p = np.hstack([p, (1 - p) * kinds])
    for _ in range(rounds):
        w = n[:, None] * p
        share = (w.sum(axis=0) + 1 / (k + 1)) / (n.sum() + 1)
        accuracy = np.einsum("iz,ijk->zjk", w, one_hot) + imagined
        accuracy /= accuracy.sum(axis=2, keepdims=True)
        like = np.einsum("ijk,zjk->iz", one_hot, np.log(accuracy)) + np.log(share)
        p = np.exp(like - like.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
    of_bad = np.einsum("z,zjk->jk", share[1:] / share[1:].sum(), accuracy[1:])
    return WeakLabels(float(np.clip(share[0], 0.01, 0.99)), np.stack([of_bad, accuracy[0]], axis=1),
                      dict(zip(codes.tolist(), p[:, 0].tolist())))


SHAPES = [(re.compile(rb"[A-Z]+"), b"A"), (re.compile(rb"[a-z\x80-\xff]+"), b"a"), (re.compile(rb"[0-9]+"), b"0")]


def shape(word: bytes) -> bytes:
    for pattern, mark in SHAPES:
        word = pattern.sub(mark, word)
    return word[:8]


def bins(m: dict[str, int]) -> Iterator[bytes]:
    """The labellers' ratios of a measured text, in coarse steps, as features."""
    for name, (ratio, _) in LABELLERS.items():
        a, _, b = ratio.partition(" / ")
        v = (m[a] / m[b] if m[b] else -1.0) if b else float(np.log2(1 + m[a]))
        yield f"{name} {int(min(v, 30.0) * (1 if b == 'n_words' and a == 'word_chars' or not b else 10))}".encode()


class Slots(dict):
    """word -> its slot, and that of its shape, as one number."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        mask = (1 << BITS) - 1
        self[word] = got = (zlib.crc32(word.lower()) & mask) << BITS | zlib.crc32(b"shape " + shape(word)) & mask
        return got


class Features:
    """Hashed words, word shapes and bins: logarithmic counts, scaled to one length."""

    def __init__(self):
        self.slots = Slots()

    def __call__(self, text: str, m: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
        """Of a text and its measures."""
        words = Counter(text.encode("utf-8", "replace").split())
        both = np.fromiter(map(self.slots.__getitem__, words.keys()), dtype=np.int64, count=len(words))
        times = np.fromiter(words.values(), dtype=np.int64, count=len(words))
        of_bins = np.array([zlib.crc32(name) & ((1 << BITS) - 1) for name in bins(m)], dtype=np.int64)
        index, where = np.unique(np.concatenate([both >> BITS, both & ((1 << BITS) - 1), of_bins]), return_inverse=True)
        count = np.bincount(where, weights=np.concatenate([times, times, np.full(len(of_bins), BIN_WEIGHT)]),
                            minlength=len(index))
        value = np.log1p(count)
        return index, value * (LENGTH / max(1e-9, np.sqrt((value ** 2).sum())))


@dataclass
class Linear:
    weights: np.ndarray
    bias: float

    def __call__(self, index: np.ndarray, value: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.weights[index] @ value + self.bias, -700, 700))))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        fit_rows: int = FIT_ROWS) -> tuple[WeakLabels, Linear]:
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.linalg import Vectors, VectorUDT

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def patterns(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            count = Counter(pattern_of(measured(text_of(t))) for t in b["text"])
            yield pd.DataFrame({"pattern": list(count.keys()), "n": list(count.values())})

    # at most 3^labellers rows, whatever the corpus
    counts = {r.pattern: r.n for r in rows.select("text").mapInPandas(patterns, "pattern int, n long")
              .groupBy("pattern").agg(F.sum("n").alias("n")).collect()}
    weak = estimate(counts)
    total = sum(counts.values())
    if not total:
        return weak, Linear(np.zeros(1 << BITS), 0.0)
    draw = F.pmod(F.xxhash64(F.lit("quality"), "doc_id", F.length("text")), F.lit(1 << 32)) / F.lit(float(1 << 32))

    def sampled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        features = Features()
        for b in batches:
            out = []
            for t in map(text_of, b["text"]):
                m = measured(t)
                i, v = features(t, m)
                p = weak.posterior.get(pattern_of(m), weak.prior)
                out += [(i, v, 1.0, p), (i, v, 0.0, 1 - p)]
            yield pd.DataFrame(out, columns=["index", "value", "label", "weight"])

    sample = stored(rows.where(draw < fit_rows / total).mapInPandas(
        sampled, "index array<long>, value array<double>, label double, weight double"), "quality-sample")
    sample = sample.where("weight > 0.001")
    if sample.select("label").distinct().count() < 2:
        return weak, Linear(np.zeros(1 << BITS), float(np.log(weak.prior / (1 - weak.prior))))
    vector = F.udf(lambda i, v: Vectors.sparse(1 << BITS, i, v), VectorUDT())
    train = sample.select(vector("index", "value").alias("features"), "label", "weight")
    model = LogisticRegression(weightCol="weight", maxIter=60, regParam=1e-5, standardization=False,
                               tol=1e-5).fit(train)
    return weak, Linear(model.coefficients.toArray(), float(model.intercept))


def score(docs: DataFrame, weak: WeakLabels, model: Linear, id_col: str = "doc_id",
          text_col: str = "text", keep: float = KEEP) -> DataFrame:
    """doc_id, posterior (of the votes), score (of the model), kept (score >= keep)."""
    shared = docs.sparkSession.sparkContext.broadcast((weak, model))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weak, model = shared.value
        features = Features()
        for b in batches:
            belief, got = [], []
            for t in map(text_of, b["text"]):
                m = measured(t)
                belief.append(weak.posterior.get(pattern_of(m), weak.prior))
                got.append(model(*features(t, m)))
            yield pd.DataFrame({"doc_id": b["doc_id"], "posterior": belief, "score": got,
                                "kept": [g >= keep for g in got]})

    return from_python(for_python(docs, id_col, text_col).mapInPandas(
        run, "doc_id string, posterior double, score double, kept boolean"))
