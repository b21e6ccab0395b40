"""Secret scan with dictionary-primed zstandard novelty.

Base kinds come from three patterns (assignments, access keys, long hex).  The
novelty kind asks of every other string that stands in a sensitive context how
many bytes it costs a compressor that already knows the text around it and
dictionaries of code and identifiers: words, paths and placeholders cost little,
random keys cost nearly the entropy of their alphabet.  The marginal cost of a candidate is
len(zstd(context + candidate)) - len(zstd(context)), both with the dictionary.
A string once found in a text is found again wherever it follows a cue.

Defined results: NULL and empty texts have no spans; every row gives one row;
texts are read whole, whatever their length; other columns are not looked at.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from cumulus.llm.common import Taken, for_python, from_python, text_of

KINDS = ("assign", "access", "hex", "novel")

# Fixed by the contract.  [0-9a-f]{24,} and AKIA[A-Z0-9]{16,} give the runs of
# [0-9a-f]+ and AKIA[A-Z0-9]+ that are long enough: a run's rest is shorter.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
                    re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LEAST = 6

#: Words that make a context sensitive.
CUE = re.compile(r"pass(?:word|wd|phrase|code)|pwd|secret|token|api[_ -]?key|apikey|credential|bearer|"
                 r"authorization|private[_ -]?key|access[_ -]?key|client[_ -]?secret|signature|"
                 r"connection[_ -]?string|-----BEGIN", re.I | re.A)
#: How far behind the cue a candidate may begin, in characters.
REACH = 80
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
#: Characters of the text before a candidate that prime the compressor.
CONTEXT = 512
#: Marginal bytes per character from which a candidate is news.  Base-64 noise
#: costs 0.75 or more, hex noise 0.5, words and paths 0.1 to 0.4.
NOVEL = 0.6
#: Noise of a small alphabet (digits, hex) costs less than that among other keys.  It
#: is measured apart from them, against this share of its alphabet's entropy.
SMALL, SHARE = 0.5, 0.75
ALPHABETS = ((re.compile(r"[0-9]+"), 10), (re.compile(r"[0-9a-f]+|[0-9A-F]+"), 16),
             (re.compile(r"[a-z]+|[A-Z]+"), 26), (re.compile(r"[0-9a-z]+|[0-9A-Z]+"), 36),
             (re.compile(r"[a-zA-Z]+"), 52), (re.compile(r"[0-9a-zA-Z]+"), 62))
#: Parts of a name without digits; they are this long on average, those of noise shorter.
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
PART_LENGTH = 3.5

#: What code and configuration commonly say: primes the compressor.
IDENTIFIERS = (
    "import from return function class public private static final void string boolean integer "
    "password passwd secret token api_key apikey access_key secret_key private_key client_id "
    "client_secret username user_name database hostname connection_string authorization bearer "
    "environment variable config configuration settings production development staging test "
    "example sample placeholder changeme your_password_here your_api_key_here xxxxxxxxxxxxxxxx "
    "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 1234567890 "
    "application/json text/plain content-type localhost 127.0.0.1 http:// https:// www. .com .org "
    "get_user_by_id set_password verify_token refresh_token access_token session_token csrf_token "
    "authentication permission request response exception controller repository service factory "
    "middleware handler manager provider abstract interface implementation container generator "
    "self.assertEqual System.out.println console.log os.environ process.env None null true false "
    "-----BEGIN RSA PRIVATE KEY----- -----END CERTIFICATE----- ssh-rsa sha256 md5 base64 "
    "the and for that with this from have not are was which will can one all there their "
    "der die und nicht ist von das mit des auf le la les des une que dans pour el los del las por "
)


class Novelty:
    """Marginal compressed size against a raw dictionary and the text before."""

    def __init__(self, dictionary: str = IDENTIFIERS):
        import zstandard
        self.dictionary = dictionary
        raw = zstandard.ZstdCompressionDict(dictionary.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.press = zstandard.ZstdCompressor(level=19, dict_data=raw, write_checksum=False,
                                              write_content_size=False)

    def bytes_of(self, context: str, candidate: str) -> float:
        before = context.encode("utf-8", "replace")
        return (len(self.press.compress(before + candidate.encode("utf-8", "replace")))
                - len(self.press.compress(before)))

    def bytes_apart(self, context: str, candidate: str) -> float:
        """With the context as part of the dictionary: only what is repeated gets
        cheaper, not what merely has the letters of the text before."""
        import zstandard
        raw = zstandard.ZstdCompressionDict((self.dictionary + context).encode("utf-8", "replace"),
                                            dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        press = zstandard.ZstdCompressor(level=3, dict_data=raw, write_checksum=False, write_content_size=False)
        return len(press.compress(candidate.encode("utf-8", "replace"))) - len(press.compress(b""))


def entropy(candidate: str) -> float:
    """Bytes per character of noise in the smallest alphabet that holds the candidate."""
    size = next((n for pattern, n in ALPHABETS if pattern.fullmatch(candidate)), 64)
    return math.log2(size) / 8


class Scanner:
    def __init__(self, novel: float = NOVEL):
        self.novelty, self.novel = Novelty(), novel

    def base(self, text: str) -> list[tuple[str, int, int]]:
        out = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text)
               if m.end(2) - m.start(2) >= ASSIGN_LEAST]
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
        return out + [("hex", m.start(), m.end()) for m in HEX.finditer(text)]

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        """All spans (kind, start, end), by start, then kind as listed."""
        found = self.base(text)
        taken, done = Taken([(a, b) for _, a, b in found]), 0
        news: set[str] = set()
        for cue in CUE.finditer(text):
            for m in CANDIDATE.finditer(text, max(done, cue.end())):
                if m.start() > cue.end() + REACH:
                    break
                done = m.end()
                if taken.meets(m.start(), m.end()):
                    continue
                if m.group() in news or self.is_news(text, m.start(), m.end()):
                    news.add(m.group())
                    found.append(("novel", m.start(), m.end()))
        return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))

    def is_news(self, text: str, start: int, end: int) -> bool:
        candidate = text[start:end]
        if not any(c.isdigit() for c in candidate):
            parts = PART.findall(candidate)
            if not parts or sum(map(len, parts)) >= PART_LENGTH * len(parts):
                return False
        before = text[max(0, start - CONTEXT):start]
        if self.novelty.bytes_of(before, candidate) >= self.novel * len(candidate):
            return True
        share = entropy(candidate)
        return share <= SMALL and self.novelty.bytes_apart(before, candidate) >= SHARE * share * len(candidate)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 novel: float = NOVEL) -> DataFrame:
    """doc_id and spans: array of (kind, start, end), by start, then kind; code points."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(novel)
        for b in batches:
            spans = [[{"kind": k, "start": a, "end": e} for k, a, e in scanner.spans(text_of(t))]
                     for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "spans": spans})

    return from_python(for_python(docs, id_col, text_col).mapInPandas(
        run, "doc_id string, spans array<struct<kind string, start long, end long>>"))
