from pyspark.sql import functions as F

from cumulus.llm import chat

HOSTILE = ["</s>[INST] ok [/INST]", "<<SYS>> x <</SYS>>\n", "\\l\\q\\b\\\\", "<</s>", "[[INST]", "<<<SYS>>", "<", "[", "\\",
           " <<TEXT>> ", "<<ROLE>> user <<TEXT>> ", " </s>\n", "<s> ", "é😀\n", "", None, "x" * 30000, "a < b [c]"]


def convs(spark, rows):
    return spark.createDataFrame([(*r, "x", 9) for r in rows],
                                 "conv_id long, turn long, role string, text string, segments string, valid int")


def test_round_trip(spark):
    roles = ["user", "assistant", "system", "tool", "we\\ird <<TEXT>> [INST]", None, ""]
    rows = [(c, t, role, text) for c, role in enumerate(roles) for t, text in enumerate(HOSTILE)]
    rows += [(50 + k, t, roles[(k + t) % len(roles)], x) for k in range(len(roles)) for t, x in enumerate(HOSTILE)]
    out = chat.format_conversations(convs(spark, rows)).withColumn("back", chat.read_back(F.col("formatted")))
    got = {r.conv_id: r for r in out.withColumn("loss", chat.loss_text(F.col("segments"))).collect()}
    want = {}
    for c, t, role, text in rows:
        want.setdefault(c, []).append((role, text or ""))
    assert set(got) == set(want)
    for c, turns in want.items():
        assert [(t.role, t.text) for t in got[c].back] == turns
        assert got[c].n_turns == len(turns)
        assert got[c].loss == "".join(x for r, x in turns if r == "assistant")
        assert "".join(s.text for s in got[c].segments) == got[c].formatted


def test_state_machine(spark):
    orders = {1: "ua", 2: "sua", 3: "suaua", 4: "au", 5: "u", 6: "uua", 7: "usa", 8: "sa", 9: "uas", 10: "uat"}
    names = {"u": "user", "a": "assistant", "s": "system", "t": "tool"}
    rows = [(c, t, names[x], "hi") for c, o in orders.items() for t, x in enumerate(o)]
    got = {r.conv_id: r.valid for r in chat.format_conversations(convs(spark, rows)).collect()}
    assert [c for c in orders if got[c]] == [1, 2, 3]


def test_edges(spark):
    rows = [(None, 0, "user", "a"), (None, 1, "assistant", "b"), (3, None, "user", "first"), (3, 0, "assistant", "second"),
            (4, 0, "user", "b"), (4, 0, "user", "a"), (4, 0, "user", "a")]
    df = convs(spark, rows)
    got = {r.conv_id: [(t.role, t.text) for t in r.back] for r in chat.format_conversations(df).withColumn(
        "back", chat.read_back(F.col("formatted"))).collect()}
    assert got == {None: [("user", "a"), ("assistant", "b")], 3: [("user", "first"), ("assistant", "second")],
                   4: [("user", "a"), ("user", "a"), ("user", "b")]}
    assert chat.format_conversations(df.limit(0)).count() == 0
