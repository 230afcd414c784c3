"""Personal data with disguises undone, in offsets of the source text.

Plain identifiers (email, ip, card, phone) are found in the text as it stands.  Then
transducers rewrite look-alike characters, spelled digits and at/dot disguises; each
rewritten character keeps the source range it came from.  Identifiers of the rewritten
text that touch a rewritten place are mapped back and added; plain ones stay.

A null or empty text has no identifiers.  Offsets are code points, the end exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField

from graphtide.llm.common import annotate

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

# --- plain identifiers ------------------------------------------------------------------
# Each pattern starts only where the run it begins with starts, so that a search is linear.

_ADDRESS = r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
_EMAIL_HERE = re.compile(_ADDRESS)
_EMAIL = re.compile(r"(?<![A-Za-z0-9._%+-])" + _ADDRESS)
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def _emails(text: str) -> Iterator[Span]:
    at = 0
    # A match may begin right behind another one, in the middle of a run.
    while m := (at and _EMAIL_HERE.match(text, at)) or _EMAIL.search(text, at):
        yield "email", m.start(), m.end()
        at = m.end()


def _luhn(digits: str) -> bool:
    doubled = [int(d) * 2 for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def plain(text: str) -> list[Span]:
    """Identifiers of the text as it stands, by kind and then by start."""
    out = list(_emails(text)) if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text) if "." in text else ():
            parts = [p.lstrip("0") for p in m.groups()]
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
                out.append(("ip", m.start(), m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 16:
                digits = m[0].replace(" ", "").replace("-", "")
                if 16 <= len(digits) <= 19 and _luhn(digits):
                    out.append(("card", m.start(), m.end()))
        for m in _PHONE.finditer(text) if "+" in text else ():
            if 8 <= len(_DIGIT.findall(m[0])) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


# --- transducers ------------------------------------------------------------------------

# Letters of other scripts that look like Latin ones.
_LOOKALIKES = dict(zip("аеорсухіјѕһԁԛԝАВЕКМНОРСТУХІЈЅαοινρκΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "aeopcyxijshdqwABEKMHOPCTYXIJSaoivpkABEZHIKMNOPTYX"))
# Signs that stand for the ones of an identifier, and signs without width.
_SIGNS = {"﹫": "@", "․": ".", "。": ".", "｡": ".", "﹒": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "−": "-", "﹢": "+", " ": " ", " ": " ", " ": " ", " ": " "}
_HIDDEN = "​‌‍⁠﻿­"
_CHARACTERS: dict[str, str] = {
    **_LOOKALIKES, **_SIGNS, **dict.fromkeys(_HIDDEN, ""),
    **{chr(c): chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)},
    **{chr(base + d): str(d) for base in (0x0660, 0x06F0, 0x0966) for d in range(10)},
    **{chr(base + d): str(d) for base in range(0x1D7CE, 0x1D800, 10) for d in range(10)},
}
_CHARACTER = re.compile("[" + "".join(map(re.escape, _CHARACTERS)) + "]")

_B, _E = r"[ \t]{0,3}[\[({<][ \t]{0,3}", r"[ \t]{0,3}[\])}>][ \t]{0,3}"
_DOTS = "dot|punkt|point|punto"
_BRACKETED = re.compile(rf"{_B}(?:(at|arroba|@)|({_DOTS}|\.)){_E}", re.I)
_BARE = re.compile(
    rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?P<at>[ \t]{{1,3}}(?:at|arroba)[ \t]{{1,3}}|[ \t]{{0,3}}@[ \t]{{0,3}})[A-Za-z0-9-]++"
    rf"(?P<rest>(?:[ \t]{{1,3}}(?:{_DOTS})[ \t]{{1,3}}[A-Za-z0-9-]++|\.[A-Za-z0-9-]++)+)", re.I)
# A spelled dot behind a part of a name, and the most characters that it has.
_DOT_BEHIND = re.compile(rf"[ \t]{{1,3}}(?:{_DOTS})[ \t]{{1,3}}\Z", re.I)
_DOT_LENGTH = 6 + max(map(len, _DOTS.split("|")))
_NAME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_SPELLED_DOT = re.compile(rf"[ \t]{{1,3}}(?:{_DOTS})[ \t]{{1,3}}", re.I)

# Digits in words (English, German, French, Spanish).
_SPELLED = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
_WORDS = "|".join(sorted(_SPELLED, key=len, reverse=True))
_NUMERAL = f"(?:{_WORDS}|[0-9]++)(?![^\\W_])"
_GAP = rf"(?:[ \t]{{0,2}}[-,.][ \t]{{0,2}}|[ \t]{{1,3}}(?:(?:{_DOTS})[ \t]{{1,3}})?)"
_NUMBER = re.compile(rf"(?<![^\W_])(?:plus[ \t-]{{1,3}}|\+[ \t]{{0,2}})?{_NUMERAL}(?:{_GAP}{_NUMERAL})+", re.I)
_SINGLES = re.compile(_NUMBER.pattern.replace("[0-9]++", "[0-9]")[:-1] + "{3,}", re.I)  # single digits only
_TOKEN = re.compile(rf"plus|\+|{_DOTS}|\.|" + _NUMERAL, re.I)
_THOUSANDS = re.compile(r"plus[ \t-]{1,3}[0-9]{1,3}(?:[ .,][0-9]{3})+", re.I)
_SAID = re.compile(f"{_WORDS}|plus|{_DOTS}", re.I)
_ANY_SPELLED = re.compile("|".join(sorted(_SPELLED, key=len, reverse=True)), re.I)
LEAST_SPELLED = 4  # words of a number that must be spelled for it to be rewritten without being an identifier

Edit = tuple[int, int, str]


def _characters(text: str) -> Iterator[Edit]:
    for m in _CHARACTER.finditer(text):
        yield m.start(), m.end(), _CHARACTERS[m[0]]


def _number(text: str, start: int, end: int, apart: bool) -> Iterator[Edit]:
    """Digits for the words of a number; the gap before a token goes with it.

    The gap between two numerals stays if both are written in digits and one has several,
    or (``apart``) if one has several.
    """
    at, before = start, ""
    for t in _TOKEN.finditer(text, start, end):
        word = t[0].lower()
        new = _SPELLED.get(word) or (word if word.isdigit() else "+" if word in ("plus", "+") else ".")
        both = before.isdigit() and word.isdigit()
        several = (before.isdigit() and len(before) > 1) or (word.isdigit() and len(word) > 1)
        numerals = before not in ("", "+", ".") and new not in ("+", ".")
        if numerals and several and (both or apart):
            at = t.start()
        if (at, t.end(), new) != (t.start(), t.end(), t[0]):
            yield at, t.end(), new
        at, before = t.end(), word if word.isdigit() or word in _SPELLED else new


def _put(text: str, start: int, end: int, edits: list[Edit]) -> str:
    out, at = [], start
    for a, b, new in edits:
        out += [text[at:a], new]
        at = b
    return "".join(out) + text[at:end]


def _numbers(text: str) -> Iterator[Edit]:
    for m in _NUMBER.finditer(text):
        if not _SAID.search(m[0]) or _THOUSANDS.fullmatch(m[0]):
            continue
        for apart in (False, True):
            edits = list(_number(text, *m.span(), apart))
            if plain(_put(text, *m.span(), edits)):
                yield from edits
                break
        else:
            for part in _SINGLES.finditer(text, *m.span()):
                if len(_ANY_SPELLED.findall(part[0])) >= LEAST_SPELLED:
                    yield from _number(text, *part.span(), False)


def _brackets(text: str) -> Iterator[Edit]:
    for m in _BRACKETED.finditer(text):
        yield m.start(), m.end(), "@" if m[1] else "."


def _bare(text: str) -> Iterator[Edit]:
    after = 0
    for m in _BARE.finditer(text):
        dots = list(_SPELLED_DOT.finditer(text, *m.span("rest")))
        name, begin = [], m.start()
        while dot := _DOT_BEHIND.search(text, max(after, begin - _DOT_LENGTH), begin):
            start = dot.start()
            while start > after and text[start - 1] in _NAME:
                start -= 1
            if start == dot.start():
                break
            name.append((dot.start(), begin, "."))
            begin = start
        # "at" before a plain domain is prose unless the name looks like a login.
        if "@" not in m["at"] and not dots and not name and not re.search(r"[0-9._%+]", text[m.start() : m.start("at")]):
            continue
        yield from reversed(name)
        if m["at"] != "@":
            yield *m.span("at"), "@"
        for d in dots:
            yield d.start(), d.end(), "."
        after = m.end()


_TRANSDUCERS: list[tuple[Callable[[str], bool], Callable[[str], Iterator[Edit]]]] = [
    (lambda t: not t.isascii(), _characters),
    (lambda t: True, _numbers),
    (lambda t: any(c in t for c in "[({<"), _brackets),
    (lambda t: True, _bare),
]


class Rewritten:
    """A rewritten text; for each character its source range and whether it was rewritten."""

    def __init__(self, text: str) -> None:
        self.text, self.begin, self.end, self.new = text, None, None, None

    def apply(self, edits: list[Edit]) -> None:
        if self.begin is None:
            self.begin = np.arange(len(self.text))
            self.end, self.new = self.begin + 1, np.zeros(len(self.text), bool)
        text, begin, end, new, at = [], [], [], [], 0
        for a, b, put in [*edits, (len(self.text), len(self.text), "")]:
            text += [self.text[at:a], put]
            begin += [self.begin[at:a], np.full(len(put), self.begin[a] if a < len(self.begin) else 0)]
            end += [self.end[at:a], np.full(len(put), self.end[b - 1] if b else 0)]
            new += [self.new[at:a], np.ones(len(put), bool)]
            at = b
            if not put and a < b and a < len(self.begin):  # what is dropped counts as rewritten with its neighbour
                self.new[b : b + 1] = True
        self.text, self.begin, self.end, self.new = "".join(text), np.concatenate(begin), np.concatenate(end), np.concatenate(new)


def _overlaps(a: Span, spans: list[Span]) -> bool:
    return any(a[0] == s[0] and a[1] < s[2] and s[1] < a[2] for s in spans)


def _extends(a: Span, spans: list[Span]) -> bool:
    """Whether all spans of its kind that it overlaps lie within it, none as long as itself."""
    met = [s for s in spans if a[0] == s[0] and a[1] < s[2] and s[1] < a[2]]
    return all(a[1] <= s[1] and s[2] <= a[2] and s[1:] != a[1:] for s in met)


def disguised(text: str, known: list[Span]) -> list[Span]:
    """Identifiers that show only after rewriting, in source offsets.

    One that holds a known one and more (``ann dot b@exa.org``) is among them; one that
    overlaps a known one otherwise is not.
    """
    state = Rewritten(text)
    for wanted, edits in _TRANSDUCERS:
        if wanted(state.text) and (found := list(edits(state.text))):
            state.apply(found)
    if state.begin is None:
        return []
    out: list[Span] = []
    for kind, a, b in plain(state.text):
        span = (kind, int(state.begin[a]), int(state.end[b - 1]))
        if state.new[a:b].any() and _extends(span, known) and not _overlaps(span, out):
            out.append(span)
    return out


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1])))


def masked(text: str, spans: list[Span]) -> str:
    """The text with each identifier replaced by its kind, like ``[EMAIL]``; overlapping ones by the first."""
    out, at, open_end = [], 0, -1
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= open_end:
            out += [text[at:a] if a > at else "", f"[{kind.upper()}]"]
        open_end = at = max(open_end, b)
    return "".join(out) + text[at:]


FIELDS = [*(StructField(f"n_{k}", LongType()) for k in KINDS), StructField("base_sha256", StringType()), StructField("spans", StringType()), StructField("n_added", LongType())]


def _find() -> Callable[[pa.Array], list]:
    def columns(texts: pa.Array) -> list[pa.Array]:
        counts, digests, spans, more = [], [], [], []
        for text in texts.to_pylist():
            base = plain(text) if text else []
            added = disguised(text, base) if text else []
            counts.append([sum(s[0] == k for s in base) for k in KINDS])
            digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
            spans.append(joined(base + added))
            more.append(len(added))
        return [*(pa.array([c[k] for c in counts], pa.int64()) for k in range(len(KINDS))), pa.array(digests), pa.array(spans), pa.array(more, pa.int64())]

    return columns


def find_pii(docs: DataFrame, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Counts and digest of the plain identifiers, all spans with the disguised ones, and how many these are."""
    return annotate(docs, text, FIELDS, _find, keep)


def _mask(name: str) -> Callable[[pa.Array], list]:
    def columns(texts: pa.Array) -> list[pa.Array]:
        out = []
        for text in texts.to_pylist():
            spans = (base := plain(text)) + disguised(text, base) if text else []
            out.append(masked(text, spans) if spans else text)
        return [pa.array(out, pa.string())]

    return columns


def mask_pii(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """Documents whose text has its identifiers replaced; a null text stays null.  The text column comes last."""
    return annotate(docs, text, [StructField(text, StringType())], partial(_mask, text))
