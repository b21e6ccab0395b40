"""Byte-pair encoding and decoding of whole texts by a tokenizer file.

Most texts are encoded in the task that reads them; where the rules let white space
part a text, word by word, and words that come again are looked up.  What the rules do
not split (a base64 block, a genome, a page without white space) is one piece
for the merges, however long.  Such a piece is encoded by tree concatenation:

1. it is halved until the halves are short, and the halves are encoded in parallel,
   each a row of a table of its own;
2. neighbours are joined, pair by pair up the tree.  The text around a join, from
   a token's start on the left to a token's end on the right, is encoded again;
   the window grows until it holds a token of the left side's encoding and one of
   the right side's, each at the same place.  Left tokens up to the first, window
   tokens between, right tokens from the second on are then the encoding of both.

Why that is exact: merges run in the order of their ranks, every token has one
merge that makes it, and its parts have smaller ranks.  Then tokens are the encoding
of their joint text exactly if each two neighbours are the encoding of theirs: the
first merge that crossed a token's end would cross it in the two neighbours' own
encoding as well.  Each two neighbours of the result stand together in one of the
three encodings.  A file whose merges are not of this kind, or whose model has other
rules, is recognised on opening, and its pieces are encoded whole.

Defined results: NULL text is encoded as empty text, which has no ids; repeated rows
and NULL ids are encoded like any other row; an empty table gives an empty result;
other columns are not looked at.  Truncation and padding of the file are not used.
Strings of special tokens in a text become those tokens, as the library does it.
"""

from __future__ import annotations

import itertools
import json
import os
import re
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from cumulus.llm.common import for_python, from_python, stored, text_of

#: Pieces of more characters than this are halved, until halves have at most this many.
LONG = 1024
#: Tokens on either side of a join that its first window takes.
FIRST_WINDOW = 8
#: Words kept with their ids in a worker, twice (two generations).
WORDS_KEPT = 300_000
#: Words of so many bytes are kept when they are met first.
SHORT = 8
#: Marks for longer words seen once, in a worker; a word is kept when it is met again.
MARKS = 1 << 22
#: Texts that are handed on together: bounds a worker's memory.
ROWS_AT_ONCE = 512

IDS = np.dtype("<u4")
if sys.byteorder != "little" or array("I").itemsize != 4:
    raise ImportError("ids are packed as little-endian 32-bit numbers")

# The split rule and its companions with which words can be encoded apart.
WORD_RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
#: Lower-case Latin-1 letters, and words of them in UTF-8.
LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")
#: Characters other than Latin letters and common punctuation.  Without them lower-casing
#: ASCII letters before composing gives the same text; else a small letter could take a
#: mark that its capital can't (w and a ring).
COMPOSING = re.compile("[^\0-\u02ff\u2010-\u2027]")
#: Punctuation that often closes a word.
CLOSING = (b".", b",")


def merges_in_order(model: dict) -> bool:
    """Whether tokens of this model can be joined by comparing neighbours."""
    if (model.get("type") != "BPE" or model.get("dropout") or model.get("ignore_merges")
            or model.get("unk_token") or model.get("continuing_subword_prefix")):
        return False
    made: dict[str, int] = {}
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    for rank, (left, right) in enumerate(merges):
        if left + right in made:
            return False
        made[left + right] = rank
    return all(made.get(part, -1) < rank for rank, m in enumerate(merges) for part in m)


def parts_at_white_space(rules: dict) -> bool:
    """Whether a text's ids are its words' ids in order, words being what stands between
    ASCII white space.  So it is for rules that compose characters, lower-case, and
    split off runs of letters, single digits and runs of anything else but white space:
    none of it looks across white space."""
    norm, pre = rules.get("normalizer") or {}, rules.get("pre_tokenizer") or {}
    norms, pres = norm.get("normalizers", []), pre.get("pretokenizers", [])
    return ([n["type"] for n in norms] == NORMALIZERS
            and norms[1]["pattern"] == {"Regex": r"\s+"} and norms[1]["content"] == " "
            and [p["type"] for p in pres] == ["Split", "ByteLevel"]
            and pres[0]["pattern"] == {"Regex": WORD_RULE} and pres[0]["behavior"] == "Removed" and pres[0]["invert"]
            and not pres[1]["add_prefix_space"] and not pres[1]["use_regex"]
            and not any(t["content"].split() != [t["content"]] for t in rules.get("added_tokens") or []))


class Words(dict):
    """Ids (as bytes) of words in UTF-8.  A long word is kept when it is met the
    second time; two generations bound the memory, and words in use stay."""

    def __init__(self, tok, model):
        from tokenizers.pre_tokenizers import ByteLevel
        spell = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.tok, self.model = tok, model
        self.spelled = {ord(c): spell(c)[0][0] for c in LETTERS}
        self.old: dict[bytes, bytes] = {}
        self.marks, self.marked = bytearray(MARKS), 0

    def __missing__(self, word: bytes) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            if word.isalpha() and word.islower():
                # one piece for the merges: straight to the model
                ids = array("I", [t.id for t in self.model.tokenize(word.decode())]).tobytes()
            else:
                ids = self.encode(word)
            slot = hash(word) & MARKS - 1
            if len(word) > SHORT and not self.marks[slot]:
                self.marks[slot] = 1
                self.marked += 1
                if self.marked > MARKS // 2:
                    self.marks, self.marked = bytearray(MARKS), 0
                return ids
        if len(self) >= WORDS_KEPT:
            self.old = dict(self)
            self.clear()
        self[word] = ids
        return ids

    def encode(self, word: bytes) -> bytes:
        if word[-1:] in CLOSING and word[-2:-1].isalnum():
            # letters and digits end before punctuation, whatever it is
            return self[word[:-1]] + self[word[-1:]]
        if PLAIN.fullmatch(word):
            ids = [t.id for t in self.model.tokenize(word.decode().translate(self.spelled))]
        else:
            ids = self.tok.encode_batch_fast([word.decode()], add_special_tokens=False)[0].ids
        return array("I", ids).tobytes()


class Node:
    """The encoding of the piece's characters from `lo` on: ids and where tokens end."""

    def __init__(self, lo: int, ids: np.ndarray, ends: np.ndarray):
        self.lo, self.ids, self.ends = lo, ids, ends

    def starts(self, first: int, last: int) -> np.ndarray:
        """Where the tokens first .. last - 1 start."""
        before = self.ends[first - 1] if first else self.lo
        return np.concatenate(([before], self.ends[first:last - 1])) if last > first else self.ends[:0]


def alike(a: Node, a_from: int, a_to: int, b: Node) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of a[a_from:a_to] that b has at the same place: positions in a, and in b."""
    _, i, j = np.intersect1d(a.ends[a_from:a_to], b.ends, assume_unique=True, return_indices=True)
    same = ((a.ids[a_from:a_to][i] == b.ids[j])
            & (a.starts(a_from, a_to)[i] == b.starts(0, len(b.ids))[j]))
    return i[same] + a_from, j[same]


class Codec:
    """A tokenizer file opened in a worker."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        rules = json.loads(self.tok.to_str())
        model = rules["model"]
        self.model = self.tok.model
        added = rules.get("added_tokens") or []
        plain = not any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added)
        self.joinable = plain and self.tok.pre_tokenizer is not None and merges_in_order(model)
        self.special = {t["content"]: t["id"] for t in added}
        names = sorted(map(re.escape, self.special), key=len, reverse=True)
        self.specials = re.compile(f"({'|'.join(names)})") if names else None
        self.low_specials = [s.lower().encode() for s in self.special]
        self.words = Words(self.tok, self.model) if plain and parts_at_white_space(rules) else None
        self.suffix = len(model.get("end_of_word_suffix") or "")
        size = self.tok.get_vocab_size()
        self.chars = np.array([len(self.tok.id_to_token(i) or "") for i in range(size)], dtype=np.int64)

    def whole(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit numbers."""
        out: list[bytes] = [b""] * len(texts)
        rest = range(len(texts))
        if self.words is not None:
            rest, ids_of = [], self.words.__getitem__
            for n, text in enumerate(texts):
                raw = text.encode("utf-8", "replace")
                low = raw.lower()
                if any(s in low for s in self.low_specials):
                    rest.append(n)
                else:
                    words = raw if COMPOSING.search(text) else low
                    out[n] = b"".join(map(ids_of, words.split()))
        for n, e in zip(rest, self.tok.encode_batch_fast([texts[n] for n in rest], add_special_tokens=False)):
            out[n] = array("I", e.ids).tobytes()
        return out

    def merged(self, piece: str) -> np.ndarray:
        """Ids of one piece by the merges alone."""
        return np.array([t.id for t in self.model.tokenize(piece)], dtype=IDS)

    def pieces(self, text: str) -> Iterator[np.ndarray | str]:
        """The text as ids of what is special, and pieces as the rules split them."""
        parts = self.specials.split(text) if self.specials else [text]
        for part in parts:
            if part in self.special:
                yield np.array([self.special[part]], dtype=IDS)
                continue
            norm = self.tok.normalizer.normalize_str(part) if self.tok.normalizer else part
            yield from (p for p, _ in self.tok.pre_tokenizer.pre_tokenize_str(norm))

    def node(self, piece: str, lo: int, hi: int) -> Node:
        """Encoding of piece[lo:hi] as if it were a piece of its own."""
        ids = self.merged(piece[lo:hi])
        size = self.chars[ids]
        size[-1:] -= self.suffix
        return Node(lo, ids, lo + np.cumsum(size))

    def join(self, piece: str, a: Node, b: Node) -> Node:
        """Encoding of the text of a and b, which stand next to each other."""
        if not len(a.ids) or not len(b.ids):
            return a if len(a.ids) else b
        width, cut = FIRST_WINDOW, b.lo
        while True:
            i, j = max(0, len(a.ids) - width), min(len(b.ids), width)
            lo, hi = int(a.ends[i - 1]) if i else a.lo, int(b.ends[j - 1])
            window = self.node(piece, lo, hi)
            left, in_left = alike(a, i, len(a.ids), window)
            right, in_right = alike(b, 0, j, window)
            left_ok = window.ends[in_left] <= cut
            if (i == 0 or left_ok.any()) and (j == len(b.ids) or len(right)):
                a_to, w_from = (0, 0) if i == 0 else (left[left_ok][0], in_left[left_ok][0])
                b_from, w_to = ((len(b.ids), len(window.ids)) if j == len(b.ids)
                                else (right[-1], in_right[-1]))
                return Node(a.lo, np.concatenate((a.ids[:a_to], window.ids[w_from:w_to], b.ids[b_from:])),
                            np.concatenate((a.ends[:a_to], window.ends[w_from:w_to], b.ends[b_from:])))
            width *= 2

    def tree(self, piece: str, nodes: list[Node]) -> np.ndarray:
        """Ids of the piece from its leaves, joined pair by pair."""
        while len(nodes) > 1:
            nodes = [self.join(piece, *nodes[n:n + 2]) if n + 1 < len(nodes) else nodes[n]
                     for n in range(0, len(nodes), 2)]
        return nodes[0].ids

    def decode(self, ids: list[list[int]], skip_special_tokens: bool) -> list[str]:
        return self.tok.decode_batch(ids, skip_special_tokens=skip_special_tokens)


def halves(length: int, most: int) -> list[int]:
    """Places where a piece is cut: halved until no part has more than `most` characters."""
    parts = 1
    while length > parts * most:
        parts *= 2
    return [length * n // parts for n in range(parts + 1)]


#: One codec per file and worker process.
_OPEN: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    if path not in _OPEN:
        _OPEN[path] = Codec(path)
    return _OPEN[path]


def has_long_piece(text: Column, long: int = LONG) -> Column:
    """Whether white space leaves that many characters of the text unsplit."""
    return F.coalesce(text, F.lit("")).rlike(rf"\S{{{long},}}+")


def _lots(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        for at in range(0, len(b), ROWS_AT_ONCE):
            yield b[at:at + ROWS_AT_ONCE]


def _encode_whole(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids of texts that are encoded in one go."""

    def run(batches):
        c = codec(path)
        for b in _lots(batches):
            yield pd.DataFrame({"doc_id": b["doc_id"], "ids": c.whole([text_of(t) for t in b["text"]])})

    return docs.mapInPandas(run, "doc_id string, ids binary")


PART = "row long, doc_id string, place long, leaf long, lo long, hi long, piece string, ids binary"


def _split(docs: DataFrame, path: str, long: int) -> DataFrame:
    """Texts with long pieces, taken apart: ids of what stands between long pieces,
    and one row per leaf of a long piece."""

    def parts(c: Codec, row: int, doc_id, text: str) -> Iterator[tuple]:
        if not c.joinable:
            yield row, doc_id, 0, 0, 0, 0, None, c.whole([text])[0]
            return
        place, done = 0, []
        for p in c.pieces(text):
            if isinstance(p, str) and len(p) > long:
                yield row, doc_id, place, 0, 0, 0, None, b"".join(done)
                at = halves(len(p), long)
                for n, (lo, hi) in enumerate(itertools.pairwise(at)):
                    yield row, doc_id, place + 1, n, lo, hi, p[lo:hi], None
                place, done = place + 2, []
            else:
                done.append((c.merged(p) if isinstance(p, str) else p).tobytes())
        yield row, doc_id, place, 0, 0, 0, None, b"".join(done)

    def run(batches):
        c = codec(path)
        columns = [f.split()[0] for f in PART.split(", ")]
        for b in batches:
            for row, doc_id, text in zip(b["row"], b["doc_id"], b["text"]):
                rows = parts(c, row, doc_id, text_of(text))
                while lot := list(itertools.islice(rows, ROWS_AT_ONCE)):
                    yield pd.DataFrame(lot, columns=columns)

    return docs.withColumn("row", F.monotonically_increasing_id()).mapInPandas(run, PART)


def _encode_long(docs: DataFrame, path: str, long: int) -> DataFrame:
    """doc_id, ids of texts with long pieces, by tree concatenation."""
    parts = stored(_split(docs, path, long), "bpe-parts")

    def leaves(batches):
        c = codec(path)
        for b in batches:
            yield b.assign(ids=[c.merged(p).tobytes() for p in b["piece"]])

    def join(group: pd.DataFrame) -> pd.DataFrame:
        c = codec(path)
        group = group.sort_values("leaf")
        nodes = []
        for lo, raw in zip(group["lo"], group["ids"]):
            ids = np.frombuffer(raw, dtype=IDS)
            size = c.chars[ids]
            size[-1:] -= c.suffix
            nodes.append(Node(int(lo), ids, int(lo) + np.cumsum(size)))
        ids = c.tree("".join(group["piece"]), nodes)
        return group[["row", "doc_id", "place"]].head(1).assign(ids=[ids.tobytes()])

    def together(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("place")
        return group[["doc_id"]].head(1).assign(ids=[b"".join(group["ids"])])

    # every leaf is a row of its own, so the leaves of one text go to many tasks
    encoded = parts.where(F.col("piece").isNotNull()).repartition("row", "place", "leaf").mapInPandas(leaves, PART)
    joined = encoded.groupBy("row", "place").applyInPandas(join, "row long, doc_id string, place long, ids binary")
    rest = parts.where(F.col("piece").isNull()).select("row", "doc_id", "place", "ids")
    return rest.unionByName(joined).groupBy("row").applyInPandas(together, "doc_id string, ids binary")


def encode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
           long: int = LONG) -> DataFrame:
    """doc_id and ids (little-endian unsigned 32-bit numbers) of every row's whole text."""
    rows = for_python(docs, id_col, text_col)
    is_long = has_long_piece(F.col("text"), long)
    return from_python(_encode_whole(rows.where(~is_long), tokenizer_path).unionByName(
        _encode_long(rows.where(is_long), tokenizer_path, long)))


def decode(encoded: DataFrame, tokenizer_path: str, skip_special_tokens: bool = False) -> DataFrame:
    """doc_id, ids and decoded, the text of the ids; NULL ids have the empty text."""

    def run(batches):
        c = codec(tokenizer_path)
        for b in _lots(batches):
            ids = [np.frombuffer(raw or b"", dtype=IDS).tolist() for raw in b["ids"]]
            yield b.assign(decoded=c.decode(ids, skip_special_tokens))

    rows = encoded.select(F.col("doc_id").cast("string"), "ids")
    return from_python(rows.mapInPandas(run, "doc_id string, ids binary, decoded string"))
