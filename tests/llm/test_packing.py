import random
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings, strategies as st

from cumulus.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def placed(counts, size):
    plan = packing.make_plan(counts, size)
    bins = defaultdict(list)
    for n, c in counts.items():
        if c:
            s, o = plan.place(np.full(c, n, dtype=np.int64), np.arange(c, dtype=np.int64))
            for a, b in zip(s.tolist(), o.tolist()):
                bins[a].append((b, n))
    return bins


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(0, 40), max_size=30))
def test_plan_is_gapless_and_whole(counts):
    bins = placed(counts, 64)
    assert sum(len(b) for b in bins.values()) == sum(counts.values())
    for b in bins.values():
        at = 0
        for offset, n in sorted(b):
            assert offset == at
            at += n
        assert at <= 64
    assert sorted(bins) == list(range(len(bins)))


def test_two_for_the_smallest():
    # greedy takes 50 and 10; 8 + 6 fill the gap of 14 that 10 leaves
    assert sorted(packing.fill_bin(np.bincount([50, 10, 8, 6], minlength=65), 64)) == [6, 8, 50]
    assert sorted(packing.fill_bin(np.bincount([50, 10, 4, 4], minlength=65), 64)) == [4, 10, 50]
    # one piece can't go in twice
    assert sorted(packing.fill_bin(np.bincount([50, 10, 7], minlength=65), 64)) == [10, 50]


def test_close_to_the_bound():
    rnd = np.random.default_rng(3)
    sizes = np.minimum(4096, np.exp(rnd.normal(6, 1, 20000)).astype(int) + 1)
    counts = {int(n): int(c) for n, c in zip(*np.unique(sizes, return_counts=True))}
    assert len(placed(counts, 4096)) <= np.ceil(sizes.sum() / 4096) * 1.005 + 1


def test_packed_documents(spark):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(PATH)
    rnd = random.Random(1)
    words = ["the", "Then,", "éa", "Éa.", "x9", "don't", "a.b.", "...", "日本", "<|endoftext|>", "İ", "ß,", "1.", "²."]
    rows = [(i, " ".join(rnd.choices(words, k=rnd.randint(0, 60)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "word " * 9000), (None, "the"), (5, "again"), (5, "again"), (103, "a" * 20000)]
    df = spark.createDataFrame([(*r, 1, "c") for r in rows], "doc_id long, text string, length int, sequence_id string")
    packed = packing.packed_pieces(df, PATH, max_tokens=512)
    docs, bins = defaultdict(list), defaultdict(list)
    for r in packed.collect():
        ids = np.frombuffer(bytes(r.ids), dtype="<u4")
        assert len(ids) == r.length <= 512 and r.start == r.piece * 512
        docs[r.doc_id].append((r.piece, ids))
        bins[r.sequence_id].append((r.offset, r.length))
    want = defaultdict(list)
    for i, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        want[i] += [(k // 512, ids[k:k + 512]) for k in range(0, len(ids), 512)]
    assert {i: sorted((k, list(x)) for k, x in v) for i, v in docs.items()} == {i: sorted(v) for i, v in want.items()}
    for b in bins.values():
        at = 0
        for offset, n in sorted(b):
            assert offset == at
            at += n
        assert at <= 512
    whole = packing.sequences(packed).collect()
    assert len(whole) == len(bins) and all(len(r.ids) == 4 * r.length for r in whole)
    assert packing.packed_pieces(df.limit(0), PATH).count() == 0
