import hashlib
import json
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st

from cumulus.llm import bpe, queries

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")


def library(path):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


def nodes(codec, piece, cuts):
    at = [0, *cuts, len(piece)]
    return [codec.node(piece, a, b) for a, b in zip(at, at[1:]) if b > a]


@pytest.mark.parametrize("path", [WORD, BYTE])
@settings(max_examples=150, deadline=None)
@given(data=st.data())
def test_joined_halves_are_the_whole(path, data):
    codec = bpe.codec(path)
    assert codec.joinable
    letters = data.draw(st.sampled_from(["ab", "theinaronder", "aaab", "abcdefghijklmnopqrstuvwxyz", "01", "an"]))
    piece = data.draw(st.text(letters, min_size=2, max_size=400))
    cuts = sorted(data.draw(st.sets(st.integers(1, len(piece) - 1), max_size=12)))
    assert codec.tree(piece, nodes(codec, piece, cuts)).tolist() == codec.merged(piece).tolist()


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_long_pieces_of_one_letter(path):
    codec = bpe.codec(path)
    for piece in ["a" * 9000, "ab" * 5000, "the" * 4000, "x" * 1025, "=" * 7001, "aab" * 3000 + "a" * 99]:
        cuts = bpe.halves(len(piece), 256)[1:-1]
        assert codec.tree(piece, nodes(codec, piece, cuts)).tolist() == codec.merged(piece).tolist()


def test_halves():
    assert bpe.halves(10, 10) == [0, 10]
    assert bpe.halves(11, 10) == [0, 5, 11]
    assert bpe.halves(41, 10) == [0, 5, 10, 15, 20, 25, 30, 35, 41]


def test_merges_out_of_order_are_noticed():
    model = json.loads(library(WORD).to_str())["model"]
    assert bpe.merges_in_order(model)
    assert not bpe.merges_in_order({**model, "merges": model["merges"][::-1]})
    assert not bpe.merges_in_order({**model, "dropout": 0.1})
    assert not bpe.merges_in_order({**model, "merges": [["a", "bc"], ["ab", "c"]]})


def texts():
    rnd = random.Random(4)
    some = ["", None, " \n\t", "Hello,  World!!'s it's", "<|endoftext|>", "a<|startoftext|>B <|ENDOFTEXT|> c",
            "é é İstanbul ß ǅ", "日本語のテキスト" * 40, "한국어", "😀😀 👩‍👩‍👧", "x" * 100_000,
            "".join(rnd.choices("abcdefgh", k=60_000)), "A" * 3000 + "<|endoftext|>" + "b" * 3000 + " c",
            "é" * 2000, "-" * 5000 + "'s" * 2000, "日本語" * 3000, "a1" * 4000, " " * 3000, "the\x00end"]
    return some + [" ".join("".join(rnd.choices("aeinrst", k=rnd.randint(1, 200))) for _ in range(rnd.randint(0, 40)))
                   for _ in range(30)]


@pytest.mark.parametrize("path", [WORD, BYTE])
@pytest.mark.parametrize("long", [64, bpe.LONG])
def test_same_ids_and_text_as_the_library(spark, path, long):
    rows = [(n, t, "x", 7) for n, t in enumerate(texts())] + [(None, "no id", "x", 7), (3, "again", "x", 7), (3, "again", "x", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, decoded int").repartition(3)
    got = bpe.decode(bpe.encode(docs, path, long=long), path).collect()
    tok = library(path)
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    want = [(i, tuple(tok.encode(t or "", add_special_tokens=False).ids)) for i, t, *_ in rows]
    want = [(i, ids, tok.decode(list(ids), skip_special_tokens=False)) for i, ids in want]
    have = [(r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist()), r.decoded) for r in got]
    assert sorted(have, key=key) == sorted(want, key=key)


def test_words_alone_are_the_text():
    """Lower-casing ASCII letters before composing, and words apart, change no id."""
    codec, tok = bpe.codec(WORD), library(WORD)
    marks = [chr(c) for c in [*range(0x300, 0x370), 0x1AB0, 0x20D0, 0x3099, 0xFE20]]
    text = " ".join(f"x{c}{m}y.  {c.lower()}{m}\u0323," for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" for m in marks)
    odd = "\x1c \x85 \xa0 \u2028 \u1680 a\xa0b\x0bc \x0c\x1d it's. IT'S, 'LL 9. \u0130. \u212a \u0301. \u0301a"
    some = [text, odd, "a <|ENDOFTEXT|> b", "<|endoftext|><|startoftext|>", "".join(map(chr, range(1, 0x2FFF)))]
    for _ in range(3):  # unseen, seen once, kept
        assert [np.frombuffer(i, "<u4").tolist() for i in codec.whole(some)] == [
            tok.encode(t, add_special_tokens=False).ids for t in some]


def test_few_words_are_kept(monkeypatch):
    monkeypatch.setattr(bpe, "WORDS_KEPT", 5)
    codec, tok = bpe.Codec(WORD), library(WORD)
    some = [" ".join(f"w{n * k % 17}." for k in range(40)) for n in range(30)]
    assert [np.frombuffer(i, "<u4").tolist() for i in codec.whole(some)] == [
        tok.encode(t, add_special_tokens=False).ids for t in some]
    assert len(codec.words) + len(codec.words.old) <= 10


def test_random_characters():
    codec, tok = bpe.Codec(WORD), library(WORD)
    rnd = random.Random(2)
    some = ["".join(rnd.choices(["a", "B", "W", "é", "É", ".", ",", " ", "\n", "'s", "1", "\x1c", "\u0301", "\u030a", "٣"],
                                k=12)) for _ in range(2000)]
    assert [np.frombuffer(i, "<u4").tolist() for i in codec.whole(some)] == [
        tok.encode(x, add_special_tokens=False).ids for x in some]


def test_other_rules_are_not_taken_apart():
    rules = json.loads(library(WORD).to_str())
    assert bpe.parts_at_white_space(rules)
    assert not bpe.parts_at_white_space(json.loads(library(BYTE).to_str()))
    assert not bpe.parts_at_white_space({**rules, "normalizer": None})


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.decode(bpe.encode(docs, WORD), WORD).collect() == []


def test_query(spark):
    import pyarrow.parquet as pq
    t = pq.read_table("/root/testdata/sf0.001/documents.parquet").to_pydict()
    tok = library(WORD)
    want = {}
    for i, text in zip(t["doc_id"], t["text"]):
        ids = tok.encode(text or "", add_special_tokens=False).ids
        want[i] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                   hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256)
           for r in queries.op11_bpe(spark, "/root/testdata/sf0.001").collect()}
    assert got == want
