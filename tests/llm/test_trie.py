import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cumulus.llm import queries, trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(convs):
    """Nodes from conversations {id: [(role, text), ...]}."""
    members, enders, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            if d:
                children[tuple(turns[:d - 1])].add(tuple(turns[:d]))
        enders[tuple(turns)].append(c)
    saved, leaves, out = {}, {}, []
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * len(node[-1][1].encode().split()) if node else 0
        saved[node] = own + sum(saved[k] for k in children[node])
        leaves[node] = sum(leaves[k] for k in children[node]) if children[node] else 1
        ends = ",".join(map(str, sorted(enders[node])))
        out.append((min(members[node]), len(node), min(members[node[:-1]]) if node else None, len(members[node]),
                    len(children[node]), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def table(spark, convs):
    rows = [(c, t, *turn, "x", 5) for c, turns in convs.items() for t, turn in enumerate(turns)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, turns string, depth int")


def forest(seed):
    rnd = random.Random(seed)
    said = [("user", "a b c"), ("assistant", "x"), ("user", ""), ("system", "two words"), ("user", "é ü"), ("tool", "p q r s")]
    convs = {}
    for c in rnd.sample(range(-50, 2000), 150):
        convs[c] = [rnd.choice(said[:rnd.randint(1, 6)]) for _ in range(rnd.randint(1, 9))]
    for c in range(5000, 5040):  # a hot conversation, and a hot start
        convs[c] = [said[0]] * 30
        convs[c + 100] = [said[0]] * rnd.randint(1, 40) + [said[1]] * rnd.randint(0, 2)
    return convs


@pytest.mark.parametrize("most", [1, 20, 200, 10 ** 6])
def test_nodes(spark, most):
    convs = forest(most)
    assert rows_of(trie.prefix_trie(trie.turn_lists(table(spark, convs)), most)) == brute(convs)


def test_salted_join_gives_the_same(spark, monkeypatch):
    monkeypatch.setattr(trie, "BROADCAST_BYTES", 0)
    convs = forest(9)
    assert rows_of(trie.prefix_trie(trie.turn_lists(table(spark, convs)), 50)) == brute(convs)


def test_order_nulls_and_turnless(spark):
    rows = [(1, 2, "user", "b"), (1, None, "user", "first"), (1, 1, None, None), (None, 1, "user", "lost"),
            (2, 1, "", ""), (2, 1, "", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = {1: [("user", "first"), ("", ""), ("user", "b")], 2: [("", ""), ("", "")]}
    assert rows_of(trie.prefix_trie(trie.turn_lists(df))) == brute(want)
    lists = trie.turn_lists(df).withColumn("turns", F.when(F.col("conv_id") == 2, F.array().cast("array<string>"))
                                           .otherwise(F.col("turns")))
    for most in (1, 100):
        assert rows_of(trie.prefix_trie(lists, most)) == brute({**want, 2: []})
    assert trie.prefix_trie(trie.turn_lists(df.limit(0))).collect() == []


def test_turn_ids_tell_roles_from_texts(spark):
    df = spark.createDataFrame([(1, 1, "a", "bc"), (2, 1, "ab", "c")], "conv_id long, turn long, role string, text string")
    assert len({r.turns[0] for r in trie.turn_lists(df).collect()}) == 2


@pytest.mark.parametrize("most", [trie.MOST, 64])
def test_query(spark, monkeypatch, most):
    import pyarrow.parquet as pq
    monkeypatch.setattr(trie.prefix_trie, "__defaults__", (most,))
    t = pq.read_table("/root/testdata/sf0.001/conversations.parquet").to_pydict()
    own = defaultdict(list)
    for c, n, role, text in sorted(zip(t["conv_id"], t["turn"], t["role"], t["text"])):
        own[c].append((role or "", text or ""))
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = own.get(c - c % 20, [])[:h] + own[c][h:]
    assert rows_of(queries.op13_prefix_trie(spark, "/root/testdata/sf0.001")) == brute(built)
