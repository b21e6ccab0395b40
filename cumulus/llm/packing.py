"""Best-fit packing of tokenised documents into fixed-size sequences.

1. Each document becomes token ids plus an end id; only documents longer than a
   sequence are cut, into pieces of one sequence and a last, shorter one.  The
   pieces are written to the shared folder with a name that the writing task
   gives them: (part, nth piece of that length in the part).
2. How many pieces there are of each length is at most max_tokens numbers, for
   any corpus.  The plan is made on these: a bin is filled greedily, largest
   first; then its smallest piece gives way to two others that fill the gap it
   leaves more tightly, if there are such.  The bin is repeated as often as the
   counts allow, so the number of distinct bins follows the number of lengths.
3. Prefix sums over (part, length) turn the names into ranks within the length,
   and a rank's place in the plan is arithmetic.  Only ids, lengths and ranks
   are shuffled; tokens are not.

Ids are those of the tokenizer file with add_special_tokens=False (see bpe.py).

Defined results: NULL and empty text is one piece with the end id alone; repeated
rows and NULL ids are packed like any other row; an empty table gives an empty
result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from cumulus.llm import bpe
from cumulus.llm.common import for_python, from_python, stored, text_of

END_ID = 1
MAX_TOKENS = 4096
#: Documents whose pieces are handed on together: bounds a worker's memory.
ROWS_AT_ONCE = 512
#: Bytes of a token id.
WIDTH = 4

PIECE = "doc_id string, piece int, start long, length long, ids binary, part long, nth long"


def tokenize(docs: DataFrame, tokenizer_path: str, max_tokens: int = MAX_TOKENS,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents; ids are little-endian unsigned 32-bit numbers."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec, part = bpe.codec(tokenizer_path), TaskContext.get().partitionId()
        end = END_ID.to_bytes(WIDTH, "little")
        seen = np.zeros(max_tokens + 1, dtype=np.int64)
        for b in (b[at:at + ROWS_AT_ONCE] for b in batches for at in range(0, len(b), ROWS_AT_ONCE)):
            out = []
            for doc_id, ids in zip(b["doc_id"], codec.whole([text_of(t) for t in b["text"]])):
                ids += end
                for piece, start in enumerate(range(0, len(ids) // WIDTH, max_tokens)):
                    own = ids[start * WIDTH:(start + max_tokens) * WIDTH]
                    n = len(own) // WIDTH
                    out.append((doc_id, piece, start, n, own, part, seen[n]))
                    seen[n] += 1
            yield pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids", "part", "nth"])

    return from_python(for_python(docs, id_col, text_col).mapInPandas(run, PIECE))


@dataclass
class Plan:
    """For each run of ranks of a length: where its pieces go."""
    key: np.ndarray      # length << SHIFT | first rank, ascending
    base: np.ndarray     # number of the first sequence
    times: np.ndarray    # pieces of this length in each sequence
    offset: np.ndarray   # place of the first of them

    SHIFT = 48

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = (length << self.SHIFT) | rank
        i = np.searchsorted(self.key, key, side="right") - 1
        over = key - self.key[i]
        return (self.base[i] + over // self.times[i],
                self.offset[i] + length * (over % self.times[i]))


def fill_bin(count: np.ndarray, size: int) -> list[int]:
    """One bin from the pieces there are (count[length]): greedy, then the smallest
    piece replaced by the best two."""
    left = count.copy()
    have = np.flatnonzero(left)
    bin_, gap, hi = [], size, len(have)
    while True:
        hi = np.searchsorted(have[:hi], gap, side="right")
        while hi and not left[have[hi - 1]]:
            hi -= 1
        if not hi:
            break
        n = int(have[hi - 1])
        times = int(min(left[n], gap // n))
        bin_ += [n] * times
        left[n] -= times
        gap -= n * times
    if len(bin_) > 1 and gap:
        small = bin_[-1]
        room = gap + small
        have = np.flatnonzero(left[:room])
        if len(have):
            # for each first piece the largest second one that still fits
            j = np.searchsorted(have, room - have, side="right") - 1
            ok = (j >= 0) & (have[j] <= have)
            own = ok & (have[j] == have) & (left[have] < 2)  # the same piece can't go in twice
            j = np.where(own, j - 1, j)
            total = np.where(ok & (j >= 0), have + have[np.maximum(j, 0)], 0)
            best = int(np.argmax(total))
            if total[best] > small:
                bin_[-1:] = [int(have[best]), int(have[j[best]])]
    return bin_


def make_plan(counts: dict[int, int], size: int = MAX_TOKENS) -> Plan:
    """counts: pieces by length, at most `size` entries."""
    count = np.zeros(size + 1, dtype=np.int64)
    for n, c in counts.items():
        count[n] = c
    used = np.zeros(size + 1, dtype=np.int64)
    rows, sequence = [], 0
    while count.any():
        bin_ = fill_bin(count, size)
        lengths, times = np.unique(bin_, return_counts=True)
        repeat = int((count[lengths] // times).min())
        offset = 0
        for n, t in zip(lengths[::-1].tolist(), times[::-1].tolist()):
            rows.append(((n << Plan.SHIFT) | int(used[n]), sequence, t, offset))
            offset += n * t
            used[n] += repeat * t
            count[n] -= repeat * t
        sequence += repeat
    rows.sort()
    cols = np.array(rows, dtype=np.int64).reshape(-1, 4).T
    return Plan(*cols)


def pack(docs: DataFrame, tokenizer_path: str, max_tokens: int = MAX_TOKENS,
         id_col: str = "doc_id", text_col: str = "text",
         ) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """(pieces, place): pieces has doc_id, piece, start, length, ids and the names
    part, nth; place(df) adds sequence_id and offset to columns of pieces that
    have part, length and nth.  Columns that aren't asked for there aren't shuffled."""
    spark = docs.sparkSession
    pieces = stored(tokenize(docs, tokenizer_path, max_tokens, id_col, text_col), "pieces")
    by_part = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    counts = {r.length: r.n for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = spark.sparkContext.broadcast(make_plan(counts, max_tokens))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = by_part.select("part", "length",
                            F.coalesce(F.sum("n").over(earlier), F.lit(0).cast("long")).alias("first"))

    @F.pandas_udf("sequence_id long, offset long")
    def at(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        s, o = plan.value.place(length.to_numpy(), rank.to_numpy())
        return pd.DataFrame({"sequence_id": s, "offset": o})

    def place(named: DataFrame) -> DataFrame:
        ranked = named.join(firsts, ["part", "length"])
        return ranked.withColumn("at", at("length", F.col("first") + F.col("nth"))).select(
            *named.columns, "at.sequence_id", "at.offset")

    return pieces, place


def packed_pieces(docs: DataFrame, tokenizer_path: str, **options) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids, sequence_id, offset."""
    pieces, place = pack(docs, tokenizer_path, **options)
    return place(pieces).drop("part", "nth")


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves: sequence_id, length, ids (pieces in their places)."""
    piece = F.struct("offset", "ids")
    return packed.groupBy("sequence_id").agg(
        F.sum("length").alias("length"), F.sort_array(F.collect_list(piece)).alias("p")).select(
        "sequence_id", "length",
        F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"))
