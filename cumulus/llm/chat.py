"""Chat formatting: a declarative template, a state machine over the roles, and
text segments with loss flags.

The template gives each role its opening and closing marker and says whether its
text counts for the loss.  Texts are escaped so that none of the template's
control strings can stand in them, which makes the output readable again:
read_back() returns the turns from it, exactly.

One conversation becomes one row; its turns are gathered there (a conversation is
one output row by definition), after which everything is an expression on that
row.

Defined results: NULL text counts as empty; NULL role and roles that the
template doesn't name get generic markers that carry the role (NULL stays NULL)
and never count for the loss; NULL conv_id is a conversation of its own; turns
are ordered by turn (NULL first), ties by role and text; repeated rows are
repeated turns; invalid orders are formatted too and flagged valid = false; an
empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Template:
    #: role -> (opening marker, closing marker, loss flag)
    roles: dict[str, tuple[str, str, bool]] = field(default_factory=lambda: {
        "system": ("<<SYS>> ", " <</SYS>>\n", False),
        "user": ("[INST] ", " [/INST]\n", False),
        "assistant": ("<s> ", " </s>\n", True),
    })
    #: markers of other roles: before the role, between role and text, after the text
    other: tuple[str, str, str] = ("<<ROLE>> ", " <<TEXT>> ", " <</ROLE>>\n")
    #: markers of a NULL role
    unknown: tuple[str, str] = ("<<NULL>> ", " <</NULL>>\n")
    #: state -> roles that may come next; a state is the role of the turn before
    moves: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "start": ("system", "user"), "system": ("user",),
        "user": ("assistant",), "assistant": ("user",)})
    #: states in which a conversation may end
    ends: tuple[str, ...] = ("assistant",)


TEMPLATE = Template()
#: The control strings start with '<' or '['; group 2 is what follows that character.
CONTROL = r"(<)(/?s>|<(?:SYS|/SYS|ROLE|/ROLE|TEXT|NULL|/NULL)>>)"
CONTROL_Q = r"(\[)(/?INST\])"


def escape(text: Column) -> Column:
    r"""Backslash becomes \b, and the first character of each control string \l or \q."""
    t = F.replace(text, F.lit("\\"), F.lit("\\b"))
    t = F.regexp_replace(t, CONTROL, "\\\\l$2")
    return F.regexp_replace(t, CONTROL_Q, "\\\\q$2")


def unescape(text: Column) -> Column:
    t = F.replace(text, F.lit("\\l"), F.lit("<"))
    t = F.replace(t, F.lit("\\q"), F.lit("["))
    return F.replace(t, F.lit("\\b"), F.lit("\\"))


def _by_role(role: Column, named: dict[str, Column], other: Column, unknown: Column) -> Column:
    case = reduce(lambda c, kv: c.when(role == kv[0], kv[1]), named.items(),
                  F.when(role.isNull(), unknown))
    return case.otherwise(other)


def format_conversations(turns: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """conv_id, n_turns, valid, segments (array of text and loss, in order) and
    formatted (the segments' texts in one string)."""
    one = F.struct(F.col("turn"), F.col("role"), F.coalesce("text", F.lit("")).alias("text"))
    convs = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(one)).alias("turns"))
    steps = F.create_map(*[F.lit(x) for s, nexts in template.moves.items()
                           for r in nexts for x in (f"{s}>{r}", r)])
    state = F.aggregate("turns", F.lit("start"), lambda s, t: F.coalesce(
        F.try_element_at(steps, F.concat(s, F.lit(">"), t["role"])), F.lit("error")))

    def segments(t: Column) -> Column:
        role, lit = t["role"], F.lit
        opening = _by_role(role, {r: lit(v[0]) for r, v in template.roles.items()},
                           F.concat(lit(template.other[0]), escape(role), lit(template.other[1])),
                           lit(template.unknown[0]))
        closing = _by_role(role, {r: lit(v[1]) for r, v in template.roles.items()},
                           lit(template.other[2]), lit(template.unknown[1]))
        loss = _by_role(role, {r: lit(v[2]) for r, v in template.roles.items()}, lit(False), lit(False))
        return F.array(F.struct(opening.alias("text"), lit(False).alias("loss")),
                       F.struct(escape(t["text"]).alias("text"), loss.alias("loss")),
                       F.struct(closing.alias("text"), lit(False).alias("loss")))

    out = convs.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        state.isin(*template.ends).alias("valid"),
        F.flatten(F.transform("turns", segments)).alias("segments"))
    return out.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def _quoted(s: str) -> str:
    return "".join("\\" + c if c in "\\[](){}.*+?^$|/" else c for c in s)


def read_back(formatted: Column, template: Template = TEMPLATE) -> Column:
    """The turns (role, text, loss) that a formatted string holds."""
    frames = [(r, o, c, loss) for r, (o, c, loss) in template.roles.items()]
    frames += [(None, *template.unknown, False)]
    pattern = "|".join(f"{_quoted(o)}.*?{_quoted(c)}" for _, o, c, _ in
                       [*frames, ("", template.other[0], template.other[2], False)])
    found = F.regexp_extract_all(formatted, F.lit(f"(?s)(?:{pattern})"), F.lit(0))

    def inner(s: Column, opening: str, closing: str) -> Column:
        return F.substring(s, F.lit(len(opening) + 1), F.length(s) - len(opening) - len(closing))

    def turn(s: Column) -> Column:
        body = inner(s, template.other[0], template.other[2])
        at = F.instr(body, F.lit(template.other[1]))
        between = len(template.other[1])
        case = None
        for r, o, c, loss in frames:
            value = F.struct(F.lit(r).cast("string").alias("role"),
                             unescape(inner(s, o, c)).alias("text"), F.lit(loss).alias("loss"))
            cond = s.startswith(o)
            case = F.when(cond, value) if case is None else case.when(cond, value)
        return case.otherwise(F.struct(
            unescape(F.substring(body, F.lit(1), at - 1)).alias("role"),
            unescape(F.substring(body, at + between, F.length(body))).alias("text"),
            F.lit(False).alias("loss")))

    return F.transform(found, turn)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    marked = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(marked, lambda s: unescape(s["text"])), "")
