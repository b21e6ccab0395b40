import itertools

from pyspark.sql import functions as F

from cumulus.llm import langid

DIR = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    out = langid.held_out(F.col("doc_id"))
    model = langid.fit(docs.where(~out))
    got = langid.identify(docs, model).join(docs, "doc_id").where(out)
    assert got.count() > 300
    assert got.where("lang = lang_pred").count() / got.count() > 0.98
    assert got.where("score < 0 or score > 1").count() == 0


def test_edges(spark):
    rows = [(i, "the cat and the dog", "en") for i in range(5)] + [(10 + i, "der hund und die katze", "de") for i in range(4)]
    rows += [(20, "le chat", None), (21, None, "fr"), (None, "el gato", "es"), (22, "x" * 100000, "en")]
    df = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, lang string, score string")
    model = langid.fit(df.where("doc_id is not null"))
    assert model.langs == ["de", "en"]
    ask = spark.createDataFrame([(1, "The dog!"), (2, "hundkatzen"), (3, None), (4, ""), (5, "12 ² ... _"), (6, "日本"),
                                 (None, "und"), (7, "the " * 50000), (7, "the " * 50000)], "doc_id long, text string")
    got = [(r.doc_id, r.lang_pred) for r in langid.identify(ask, model).collect()]
    assert got == [(1, "en"), (2, "de"), (3, "und"), (4, "und"), (5, "und"), (6, "en"), (None, "de"), (7, "en"), (7, "en")]
    none = langid.fit(df.limit(0))
    assert [r.lang_pred for r in langid.identify(ask.limit(1), none).collect()] == ["und"]
    assert langid.identify(ask.limit(0), model).count() == 0


def test_unseen_words_back_off(spark):
    df = spark.createDataFrame([(1, "straße straßen gasse gassen", "de")] * 3 + [(2, "street streets lane lanes", "en")] * 3,
                               "doc_id long, text string, lang string")
    s = langid.Scorer(langid.fit(df))
    assert "straßengasse" not in s.m.index[0]
    assert s("straßengasse")[0] == "de" and s("streetlane")[0] == "en"


def test_whole_vocabulary_is_kept(spark):
    names = ["".join(x) for x in itertools.islice(itertools.product("abcdefghijklmnop", repeat=5), 110_000)]
    lots = [(i, " ".join(names[i::50]) + " both", "en") for i in range(50)] * 2  # each word is there twice
    few = [(100, "zug zuge both", "de")]
    model = langid.fit(spark.createDataFrame(lots + few, "doc_id long, text string, lang string"))
    assert set(model.index[0]) == {*names, "both", "zug", "zuge"}
    assert {"^zug", "zuge", "uge$"} <= set(model.index[4])
    de, en = (model.logs[0][:, model.langs.index(x)] for x in ("de", "en"))
    zug, both = model.index[0]["zug"], model.index[0]["both"]
    assert de[zug] == de[both] > de[model.index[0][names[0]]]
    assert en[both] > en[model.index[0][names[0]]] > en[zug]
    assert langid.Scorer(model)("zug")[0] == "de"
