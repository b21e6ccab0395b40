"""Prefix trie of conversations by burst tries.

A conversation is the list of its turn ids; equal conversations are one entry with
a count and the smallest id.  All entries start as suffixes in one container under
the trie's root.

1. Burst.  A container of more than `most` turns is burst along the path of one of
   its entries, drawn by hash: the path's nodes become trie heads, and every other
   entry goes by the next turn id with which it leaves the path, to the container
   under that head.  A container holds about half of the entries that the burst one
   held, whatever the turns look like, so the rounds are about as many as the
   logarithm of the entries.  Container sizes are partial sums; no container is
   ever gathered.
2. Sort and sweep.  The containers that remain are dealt out to the tasks by head
   and sorted there; one pass with a stack of open nodes emits the nodes.  A task
   holds one path and the finished children of its nodes, at most one container.
3. Back up.  Bursts are finished in reverse order: what hangs on a path is summed by
   the place where it hangs (partial sums), and running sums from the path's
   end to its head give the heads' figures.

Result, one row per node, see `prefix_trie`.

Defined results: rows without a conversation id belong to no conversation and are
left out; a conversation without turns ends at the root; turns of one number (and
those without a number, which come first) go by role, then by turn id; NULL role or
text is empty; repeated rows are turns like any other; an empty table has no nodes;
other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import LongType

from cumulus.llm.common import stored, word_count

#: Turns in a container that is swept; larger ones are burst.
MOST = 1024
#: Characters of a turn in a path: its id (MD5) and its number of words.
ID, WORDS = 32, 8
TURN = ID + WORDS
#: Conversations whose ids are joined to one string before they are hashed.
BLOCK = 256
#: Tables of heads up to this size are broadcast.
BROADCAST_BYTES = 8 << 20
#: Parts of a hot head's rows in other joins.
SALTS = 16
NO_ENDS = hashlib.sha256(b"").hexdigest()


def turn_id(role: Column, text: Column) -> Column:
    """A turn in a path: equal for equal (role, text), with the text's number of words."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    told = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return F.concat(F.md5(told.cast("binary")), F.lpad(F.hex(word_count(text)), WORDS, "0"))


def turn_lists(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn",
               role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id and turns: the turn ids of each conversation, in order."""
    rows = conversations.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv_id"),
        F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                 turn_id(F.col(role_col), F.col(text_col)).alias("id")).alias("t"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t")).select(
        "conv_id", F.transform("t", lambda t: t["id"]).alias("turns"))


def shared(path: str, other: str) -> int:
    """Turns that two paths have in common at their start."""
    lo, hi = 0, min(len(path), len(other)) // TURN
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if path[lo * TURN:mid * TURN] == other[lo * TURN:mid * TURN]:
            lo = mid
        else:
            hi = mid - 1
    return lo


@F.pandas_udf(LongType())
def shared_turns(path: pd.Series, other: pd.Series) -> pd.Series:
    return pd.Series([shared(a, b) for a, b in zip(path, other)], dtype="int64")


def turns_in(path: Column) -> Column:
    return (F.length(path) / F.lit(TURN)).cast("long")


def salted_join(rows: DataFrame, keyed: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """rows joined with keyed (a written table, one row per key): broadcast while its
    text is small as measured, else shuffled with each key in SALTS parts, as a head may
    have many rows."""
    text = reduce(Column.__add__, [F.octet_length(f.name) if f.dataType.typeName() == "string" else F.lit(8)
                                   for f in keyed.schema])
    size = keyed.agg(F.sum(text).alias("bytes")).first()["bytes"]
    if (size or 0) <= BROADCAST_BYTES:
        return rows.join(F.broadcast(keyed), on, how)
    parts = keyed.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    own = F.pmod(F.xxhash64(*[F.col(c) for c in rows.columns]), F.lit(SALTS)).cast("int")
    return rows.withColumn("__salt", own).join(parts, [*on, "__salt"], how).drop("__salt")


def entries(lists: DataFrame) -> DataFrame:
    """Equal conversations as one: seq (its key), path, n, low."""
    return (lists.select("conv_id", F.array_join("turns", "").alias("path"))
            .groupBy("path").agg(F.count("*").alias("n"), F.min("conv_id").alias("low"))
            .withColumn("seq", F.md5("path")))


def ends(lists: DataFrame) -> DataFrame:
    """seq, ends_sha256: digest of the ids of the conversations that are this sequence,
    ascending, joined by commas.  Ids are joined in blocks first; the digest reads a
    sequence's blocks as a stream."""
    blocks = (lists.select(F.md5(F.array_join("turns", "")).alias("seq"), "conv_id",
                           F.floor(F.col("conv_id") / BLOCK).alias("block"))
              .groupBy("seq", "block").agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
              .select("seq", "block", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids")))

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, sha = None, None
        for b in batches:
            done = []
            for seq, ids in zip(b["seq"], b["ids"]):
                if seq != at:
                    if at is not None:
                        done.append((at, sha.hexdigest()))
                    at, sha = seq, hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
            yield pd.DataFrame(done, columns=["seq", "ends_sha256"])
        if at is not None:
            yield pd.DataFrame([(at, sha.hexdigest())], columns=["seq", "ends_sha256"])

    return (blocks.repartition("seq").sortWithinPartitions("seq", "block")
            .mapInPandas(digest, "seq string, ends_sha256 string"))


def head_of(path: Column, depth: Column) -> Column:
    return F.md5(F.substring(path, F.lit(1), (depth * TURN).cast("int")))


CONTAINED = ["seq", "path", "n", "low", "hd", "head", "up", "round"]


def burst(found: DataFrame, most: int) -> tuple[DataFrame, DataFrame | None, list[DataFrame]]:
    """(contained, ended, chains).  contained: the entries with the container's head,
    the head's depth hd, and the burst container `up` and its round in which they came
    there.  ended: entries that end on a burst path.  chains: by round, the containers
    burst then, with the path they were burst along."""
    work = stored(found.select("seq", "path", "n", "low", F.lit(0).cast("long").alias("hd"),
                               F.md5(F.lit("")).alias("head"), F.lit(None).cast("string").alias("up"),
                               F.lit(-1).alias("round")), "entries")
    settled, ended, chains = [], [], []
    while True:
        drawn = F.min_by("path", F.xxhash64(F.col("seq"), F.lit(len(chains))))
        sizes = work.groupBy("head", "hd", "up", "round").agg(
            F.sum(turns_in(F.col("path")) - F.col("hd") + 1).alias("size"), F.count("*").alias("entries"),
            drawn.alias("pivot"))
        big = stored(sizes.where((F.col("size") > most) & (F.col("entries") > 1)).drop("size", "entries"), "burst")
        if big.isEmpty():
            settled.append(work)
            break
        chains.append(big)
        marked = salted_join(work, big.select("head", "pivot"), ["head"], "left")
        settled.append(marked.where(F.col("pivot").isNull()).select(*CONTAINED))
        moved = (marked.where(F.col("pivot").isNotNull())
                 .withColumn("hd", shared_turns("path", "pivot") + 1)
                 .withColumn("up", F.col("head")).withColumn("round", F.lit(len(chains) - 1))
                 .withColumn("head", head_of(F.col("path"), F.col("hd"))))
        moved = stored(moved.select(*CONTAINED), "moved")
        over = F.col("hd") > turns_in(F.col("path"))
        ended.append(moved.where(over))
        work = moved.where(~over)
    return reduce(DataFrame.unionByName, settled), reduce(DataFrame.unionByName, ended) if ended else None, chains


NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
        "saved_tokens long, seq string, head string, up string, round int, top boolean")
NODE_COLUMNS = [f.split()[0] for f in NODE.split(", ")]


class Open:
    """A node of the current path: what is known of its subtree so far."""

    __slots__ = ("words", "n", "low", "seq", "leaves", "saved", "children")

    def __init__(self, words: int):
        self.words, self.n, self.low, self.seq = words, 0, None, None
        self.leaves, self.saved, self.children = 0, 0, []

    def take(self, n: int, low: int) -> None:
        self.n += n
        self.low = low if self.low is None else min(self.low, low)


def sweep(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Nodes of sorted containers; rows: (head, path, seq, n, low, hd, up, round).

    A node is handed on when its parent is complete, as it names its parent's
    smallest member."""

    def close(stack: list[Open], depth: int) -> tuple:
        node = stack.pop()
        saved = node.saved + (node.n - 1) * node.words
        leaves = node.leaves if node.children else 1
        own = (node.low, depth, node.n, len(node.children), leaves, saved, node.seq)
        if stack:
            up = stack[-1]
            up.take(node.n, node.low)
            up.saved += saved
            up.leaves += leaves
            up.children.append(own)
        return own, [(c[0], c[1], node.low, *c[2:]) for c in node.children]

    head, before, stack, at = None, "", [], None
    for h, path, seq, n, low, hd, up, rnd in rows:
        size = len(path) // TURN
        keep = 0
        if h == head:
            keep = shared(before, path) - hd + 1
        while len(stack) > keep:
            own, children = close(stack, at[0] + len(stack) - 1)
            for c in children:
                yield *c, head, None, None, False
            if not stack:
                yield own[0], own[1], None, *own[2:], head, at[1], at[2], True
        head, before, at = h, path, (hd, up, rnd)
        for depth in range(hd + len(stack), size + 1):
            end = depth * TURN
            stack.append(Open(int(path[end - WORDS:end], 16) if depth else 0))
        stack[-1].take(n, low)
        stack[-1].seq = seq
    while stack:
        own, children = close(stack, at[0] + len(stack) - 1)
        for c in children:
            yield *c, head, None, None, False
        if not stack:
            yield own[0], own[1], None, *own[2:], head, at[1], at[2], True


def swept(contained: DataFrame) -> DataFrame:
    """Nodes of all containers; top: the container's own head."""
    columns = ["head", "path", "seq", "n", "low", "hd", "up", "round"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = (r for b in batches for r in zip(*[b[c].tolist() for c in columns]))
        lot: list[tuple] = []
        for node in sweep(rows):
            lot.append(node)
            if len(lot) >= 10_000:
                yield frame(lot)
                lot = []
        yield frame(lot)

    def frame(lot: list[tuple]) -> pd.DataFrame:
        b = pd.DataFrame(lot, columns=NODE_COLUMNS)
        return b.astype({"parent_conv_id": "Int64", "round": "Int32"})

    return (contained.select(*columns).repartition("head").sortWithinPartitions("head", "path")
            .mapInPandas(run, NODE))


def chain_nodes(big: DataFrame, hanging: DataFrame) -> DataFrame:
    """The heads on the paths of one round's bursts.  hanging: what hangs on these paths
    (up, depth, n_convs, low, n_children, n_leaves, saved_tokens, seq)."""
    sums = hanging.groupBy(F.col("up").alias("head"), "depth").agg(
        F.sum("n_convs").alias("n"), F.min("low").alias("low"), F.sum("n_children").alias("hung"),
        F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"), F.max("seq").alias("seq"))
    turns = F.array_remove(F.split(F.regexp_replace("pivot", rf"(.{{{TURN}}})", "$1,"), ","), "")
    path = big.select("head", "hd", "up", "round", F.posexplode(F.concat(F.array(F.lit("")), turns)).alias(
        "depth", "turn")).where(F.col("depth") >= F.col("hd"))
    words = F.when(F.col("depth") == 0, 0).otherwise(
        F.conv(F.substring("turn", ID + 1, WORDS), 16, 10)).cast("long")
    path = path.select("head", "hd", "up", "round", F.col("depth").cast("long"), words.alias("words"))
    rows = path.join(sums, ["head", "depth"], "left")
    # a path is no longer than a conversation
    below = Window.partitionBy("head").orderBy(F.desc("depth"))
    to_here = below.rowsBetween(Window.unboundedPreceding, 0)
    zero = F.lit(0).cast("long")
    last = F.lag("depth").over(below).isNull()
    hung = F.coalesce("hung", zero)
    rows = rows.select("*", F.sum(F.coalesce("n", zero)).over(to_here).alias("n_convs"),
                       F.min("low").over(to_here).alias("conv_id"),
                       (hung + F.when(last, 0).otherwise(1)).alias("n_children"))
    leaf = F.when(F.col("n_children") == 0, 1).otherwise(F.coalesce("leaves", zero))
    rows = rows.select("*", F.sum(leaf).over(to_here).alias("n_leaves"),
                       F.sum((F.col("n_convs") - 1) * F.col("words") + F.coalesce("saved", zero))
                       .over(to_here).alias("saved_tokens"),
                       F.lead("conv_id").over(below).alias("parent_conv_id"))
    top = F.col("depth") == F.col("hd")
    return rows.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                       "seq", "head", F.when(top, F.col("up")).alias("up"),
                       F.when(top, F.col("round")).alias("round"), top.alias("top"))


def prefix_trie(lists: DataFrame, most: int = MOST) -> DataFrame:
    """The trie of all turn lists (conv_id, turns), one row per node: conv_id, the
    smallest member; depth; parent_conv_id, the parent's smallest member; n_convs,
    members; n_children; n_leaves, childless nodes in its subtree; saved_tokens,
    the subtree's sum of (members - 1) x words of the node's turn; ends_sha256,
    digest of the ids of the conversations that end here."""
    lists = stored(lists, "turn-lists")
    contained, ended, chains = burst(entries(lists), most)
    nodes = [stored(swept(contained), "nodes")]
    for number in range(len(chains) - 1, -1, -1):
        hangs = [n.where(F.col("top") & (F.col("round") == number)).select(
            "up", (F.col("depth") - 1).alias("depth"), "n_convs", F.col("conv_id").alias("low"),
            F.lit(1).cast("long").alias("n_children"), "n_leaves", "saved_tokens",
            F.lit(None).cast("string").alias("seq")) for n in nodes]
        zero = F.lit(0).cast("long")
        hangs.append(ended.where(F.col("round") == number).select(
            "up", (F.col("hd") - 1).alias("depth"), F.col("n").alias("n_convs"), "low", zero.alias("n_children"),
            zero.alias("n_leaves"), zero.alias("saved_tokens"), "seq"))
        nodes.append(stored(chain_nodes(chains[number], reduce(DataFrame.unionByName, hangs)), "heads"))
    every = reduce(DataFrame.unionByName, nodes)
    columns = ["conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "seq"]
    inner = every.where(~(F.col("top") & F.col("up").isNotNull())).select(*columns, "parent_conv_id")
    complete = inner
    if chains:
        # the top node of what hung on a burst path has a head of that path as parent
        heads = reduce(DataFrame.unionByName, nodes[1:]).select(
            F.col("head").alias("up"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("parent_conv_id"))
        tops = every.where(F.col("top") & F.col("up").isNotNull()).select(*columns, "up")
        complete = inner.unionByName(salted_join(tops, heads, ["up", "depth"]).select(*columns, "parent_conv_id"))
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    with_ends = complete.where(F.col("seq").isNotNull()).join(ends(lists), "seq").select(*out, "ends_sha256")
    return with_ends.unionByName(complete.where(F.col("seq").isNull()).select(
        *out, F.lit(NO_ENDS).alias("ends_sha256")))
