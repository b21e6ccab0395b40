"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds the anchors: at-signs, plus signs, URL
schemes, identifier cues (words such as 'iban' or 'account') and digits.  At each
anchor a deterministic parser expands to both sides, validates, and gives a span.

email, ip, card and phone come out exactly as a leftmost, non-overlapping search
for their patterns would give them.  Added kinds: 'iban' (cue or not, ISO 7064
check digits), 'account' (6 to 18 digits after an account cue) and 'login' (user
and password inside a URL).

Defined results: NULL and empty texts have no spans; every row gives one row
(repeated rows and NULL ids too); texts of any length are read whole; other
columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from cumulus.llm.common import Taken, for_python, from_python, text_of

KINDS = ("email", "ip", "card", "phone", "iban", "account", "login")

DIGITS = frozenset("0123456789")
ALNUM = DIGITS | frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
LOCAL = ALNUM | frozenset("._%+-")
HOST = ALNUM | frozenset("-")
PHONE = DIGITS | frozenset(" ().-")
SCHEMES = ("http://", "https://", "ftp://", "sftp://", "ssh://")
CUES = ("account", "acct", "iban", "konto", "compte", "cuenta")
#: Characters between a cue and its number at most, and what may stand there.
CUE_GAP = re.compile(r"[ \t]*(?:number|no|nr|num|n°|#)?[ \t.:#=]{0,4}", re.I)

Span = tuple[int, int]


def automaton():
    import ahocorasick
    a = ahocorasick.Automaton()
    for d in DIGITS:
        a.add_word(d, "digit")
    a.add_word("@", "at")
    a.add_word("+", "plus")
    for s in SCHEMES:
        a.add_word(s, "scheme")
    for c in CUES:
        for form in (c, c.upper(), c.capitalize()):
            a.add_word(form, "cue")
    a.make_automaton()
    return a


def run_end(t: str, i: int, of: frozenset) -> int:
    """End of the run of characters `of` that begins at i."""
    n = len(t)
    while i < n and t[i] in of:
        i += 1
    return i


def email_at(t: str, at: int, floor: int) -> Span | None:
    """The address around the at-sign at `at`, not reaching before floor."""
    start = at
    while start > floor and t[start - 1] in LOCAL:
        start -= 1
    end = run_end(t, at + 1, HOST)
    if start == at or end == at + 1:
        return None
    labels = 0
    while end < len(t) and t[end] == "." and (e := run_end(t, end + 1, HOST)) > end + 1:
        end, labels = e, labels + 1
    return (start, end) if labels else None


def ip_spans(t: str, start: int) -> tuple[list[Span], int]:
    """Quadruples in the chain of dotted digit runs that begins at start; its end."""
    parts, i = [], start
    while True:
        e = run_end(t, i, DIGITS)
        parts.append((i, e))
        if e + 1 < len(t) and t[e] == "." and t[e + 1] in DIGITS:
            i = e + 1
        else:
            break
    found = []
    for k in range(0, len(parts) - 3, 4):
        four = parts[k:k + 4]
        if all(small(t[a:b]) for a, b in four):
            found.append((four[0][0], four[3][1]))
    return found, e


def small(digits: str) -> bool:
    """At most 255, however many zeros lead."""
    d = digits.lstrip("0")
    return len(d) <= 3 and (not d or int(d) <= 255)


def card_at(t: str, start: int) -> tuple[Span | None, int]:
    """The chain of digits with single blanks or hyphens between; its end."""
    digits, i, n = [], start, len(t)
    while i < n and t[i] in DIGITS:
        digits.append(t[i])
        end = i + 1
        i = end + 1 if end < n and t[end] in " -" else end
    ok = 13 <= len(digits) <= 19 and luhn(digits)
    return ((start, end) if ok else None), end


def luhn(digits: list[str]) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def phone_at(t: str, plus: int) -> tuple[Span | None, int]:
    """The number after the plus sign; where the search goes on."""
    if plus + 1 >= len(t) or t[plus + 1] not in DIGITS:
        return None, plus + 1
    end = run_end(t, plus + 2, PHONE)
    while end > plus + 2 and t[end - 1] not in DIGITS:
        end -= 1
    if end < plus + 4:
        return None, plus + 1
    n = sum(c in DIGITS for c in t[plus:end])
    return ((plus, end) if 9 <= n <= 15 else None), end


def iban_at(t: str, digit: int) -> Span | None:
    """Two capitals, two check digits (the first at `digit`), 11 to 30 more characters."""
    start = digit - 2
    if start < 0 or not (t[start:digit].isascii() and t[start:digit].isalpha() and t[start:digit].isupper()):
        return None
    if start and t[start - 1] in ALNUM:
        return None
    got, i = [], start
    while i < len(t) and len(got) < 35:
        if t[i] in ALNUM and not t[i].islower():
            got.append(t[i])
            i += 1
        elif t[i] == " " and i + 1 < len(t) and t[i + 1] in ALNUM and not t[i + 1].islower() and len(got) % 4 == 0:
            i += 1
        else:
            break
    if not 15 <= len(got) <= 34 or got[3] not in DIGITS:
        return None
    turned = "".join(str(int(c, 36)) for c in got[4:] + got[:4])
    return (start, i) if int(turned) % 97 == 1 else None


def account_after(t: str, end: int) -> Span | None:
    start = CUE_GAP.match(t, end).end()
    stop = run_end(t, start, DIGITS)
    free = stop == len(t) or t[stop] not in ALNUM
    return (start, stop) if start > end and free and 6 <= stop - start <= 18 else None


def login_after(t: str, start: int) -> Span | None:
    """user:password before the at-sign of a URL's host."""
    stop = start
    while stop < len(t) and not t[stop].isspace() and t[stop] not in "/?#@\"'<>":
        stop += 1
    if stop < len(t) and t[stop] == "@" and 0 < t.find(":", start, stop) - start < stop - start - 1:
        return start, stop
    return None


class Finder:
    def __init__(self):
        self.anchors = automaton()

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        """All spans (kind, start, end), by kind as listed, then start."""
        found: dict[str, list[Span]] = {k: [] for k in KINDS}
        past = dict.fromkeys((*KINDS, "chain"), 0)  # where the search of each kind goes on

        def add(kind: str, span: Span | None) -> None:
            if span:
                found[kind].append(span)
                past[kind] = span[1]

        for last, what in self.anchors.iter(text):
            if what == "digit":
                if last >= past["ip"]:
                    spans, past["ip"] = ip_spans(text, last)
                    found["ip"] += spans
                if last >= past["card"]:
                    span, end = card_at(text, last)
                    add("card", span)
                    past["card"] = end
                if last >= past["iban"]:
                    add("iban", iban_at(text, last))
            elif what == "at":
                add("email", email_at(text, last, past["email"]))
            elif what == "plus":
                if last >= past["phone"]:
                    span, past["phone"] = phone_at(text, last)
                    found["phone"] += [span] if span else []
            elif what == "cue":
                add("account", account_after(text, last + 1))
            else:
                add("login", login_after(text, last + 1))
        # an added span inside one of the base kinds says nothing new
        base = Taken([s for k in KINDS[:4] for s in found[k]])
        for k in KINDS[4:]:
            found[k] = [s for s in found[k] if not base.meets(*s)]
        return [(k, a, b) for k in KINDS for a, b in found[k]]


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and spans: array of (kind, start, end), by kind, then start; code points."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        finder = Finder()
        for b in batches:
            spans = [[{"kind": k, "start": a, "end": e} for k, a, e in finder.spans(text_of(t))]
                     for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "spans": spans})

    return from_python(for_python(docs, id_col, text_col).mapInPandas(
        run, "doc_id string, spans array<struct<kind string, start long, end long>>"))
