import hashlib
import zlib
from fractions import Fraction

import pytest
from hypothesis import given, settings, strategies as st

from cumulus.llm import queries, runs


def brute(words, least, times):
    """All runs by trying every period over the whole text."""
    n, found = len(words), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, times * q):
                start, length = i, j + q - i
                # the smallest period of the stretch
                if not any(all(words[x] == words[x + p] for x in range(start, start + length - p)) for p in range(1, q)):
                    found[(start, q)] = length
            i = j + 1
    return sorted((s, n, q) for (s, q), n in found.items())


def kept(words, found):
    out = {w for s, n, q in found for w in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in out]


def of_lot(texts, least, times):
    lot = runs.Lot()
    for n, t in enumerate(texts):
        lot.add(n, t)
    out = lot.result(least, times)
    return [([(r["start"], r["length"], r["period"]) for r in own], c) for own, c in zip(out["runs"], out["collapsed"])]


words = st.lists(st.sampled_from("ab"), max_size=70) | st.lists(st.sampled_from("abc"), max_size=60)
repeated = st.tuples(words, st.lists(st.sampled_from("abc"), min_size=1, max_size=20), st.integers(1, 9), words).map(
    lambda t: t[0] + t[1] * t[2] + t[3])


@settings(max_examples=400, deadline=None)
@given(st.lists(words | repeated, min_size=1, max_size=5), st.sampled_from([(6, 3), (24, 3), (3, 3), (10, 4), (9, 3)]))
def test_all_runs(texts, how):
    got = of_lot([" ".join(t) for t in texts], *how)
    for t, (found, collapsed) in zip(texts, got):
        want = brute(t, *how)
        assert found == want
        assert collapsed == " ".join(kept(t, want))


def test_root_whose_grams_all_occur_twice():
    """A period in which every 16 words occur at two places."""
    block = {n: [f"{n}-{k}" for k in range(20)] for n in "123"}
    root = [w for n in "12121313" for w in block[n]]
    text = root * 3
    assert of_lot([" ".join(text)], 24, 3) == [([(0, 480, 160)], " ".join(root))]


def test_long_texts():
    one = of_lot(["a " * 200_000], 24, 3)
    assert one == [([(0, 200_000, 1)], "a")]
    root = [f"w{k}" for k in range(30_000)]
    assert of_lot([" ".join(["x", *root * 4, "y"])], 24, 3) == [([(1, 120_000, 30_000)], " ".join(["x", *root, "y"]))]


def test_equal_texts_do_not_match_each_other():
    text = " ".join(f"w{k}" for k in range(100))
    assert of_lot([text] * 30, 24, 3) == [([], text)] * 30


def test_smallest_overlap():
    assert runs.overlap(24, 3) == 16
    assert runs.overlap(6, 3) == 4
    with pytest.raises(ValueError):
        of_lot(["a a a"], 2, 2)


def test_null_empty_repeated_and_other_columns(spark):
    line = "a b " * 12
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, line), (4, line), (None, line), (5, "x y")]
    docs = spark.createDataFrame([(*r, 1, "z") for r in rows], "doc_id long, text string, runs int, collapsed string")
    got = sorted(((r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in runs.find_runs(docs).collect()), key=str)
    hit = [(0, 24, 2)]
    assert got == sorted([(1, [], ""), (2, [], ""), (3, [], ""), (4, hit, "a b"), (4, hit, "a b"), (None, hit, "a b"),
                          (5, [], "x y")], key=str)
    assert runs.find_runs(docs.limit(0)).collect() == []


def test_query(spark):
    import pyarrow.parquet as pq
    t = pq.read_table("/root/testdata/sf0.001/documents.parquet").to_pydict()

    def sha(s):
        return hashlib.sha256(s.encode()).hexdigest()

    want = {}
    for i, text in zip(t["doc_id"], t["text"]):
        own = [w.decode() for w in (text or "").encode().split()]
        n, h = len(own), zlib.crc32(str(i).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            own = own[:a] + [own[a + (k - a) % p] for k in range(a, n)]
        found = brute(own, 24, 3) if n < 4000 else of_lot([" ".join(own)], 24, 3)[0][0]
        best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
        want[i] = (len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
                   sha("".join(f"{s},{m},{q}\n" for s, m, q in found)), sha(" ".join(kept(own, found))))
    got = {r.doc_id: (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256)
           for r in queries.op12_periodic_runs(spark, "/root/testdata/sf0.001").collect()}
    assert got == want
    assert sum(v[0] > 0 for v in want.values()) > 5
