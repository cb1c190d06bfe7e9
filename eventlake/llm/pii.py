"""Personal data in plain and disguised form, with spans in the source text.

A transducer rewrites homoglyphs, spelled digits and at/dot disguises to plain characters and keeps,
for every character it writes, the source span it stands for. The identifiers are detected in the
plain text and in the rewritten text; spans of the latter are mapped back to source code points.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.llm._common import in_arrow, pieces, utf8

KINDS = ("email", "ip", "card", "phone")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Code points that look like another character and have no compatibility mapping to it.
HOMOGLYPHS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h", "ԛ": "q", "ԝ": "w",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X", "І": "I", "Ј": "J", "Ѕ": "S",
    "α": "a", "ο": "o", "ρ": "p", "ν": "v", "ι": "i", "κ": "k", "τ": "t", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Χ": "X",
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "−": "-", "。": ".", "․": ".", "‧": ".", "∙": ".", "⋅": ".", " ": " ", " ": " ", " ": " ",
}
#: Code points without width, which the transducer deletes.
UNSEEN = "­​‌‍⁠﻿"
#: Spelled digits in English, German, French and Spanish, and the plus sign.
SPELLED = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
    "plus": "+", "más": "+",
}

_WORD = "|".join(sorted(SPELLED, key=len, reverse=True))
_AT, _DOT = "at|arroba|chez|@", r"dot|punto|punkt|point|\."
_NAME = r"[A-Za-z0-9-]+"
_DOTTED = rf"(?:\s*[\[({{<]\s*(?:{_DOT})\s*[\])}}>]\s*|\s+(?:dot|punto|punkt|point)\s+|\.)"
_DISGUISES = re.compile(
    rf"(?P<at>[\[({{<]\s*(?:{_AT})\s*[\])}}>]\s*|(?<=[A-Za-z0-9])\s+(?:at|arroba)\s+(?={_NAME}{_DOTTED}{_NAME})|(?<=[A-Za-z0-9])\s+@\s*(?={_NAME}\.)|(?<=[A-Za-z0-9])@\s+(?={_NAME}\.))"
    rf"|(?P<dot>[\[({{<]\s*(?:{_DOT})\s*[\])}}>]\s*|(?<=[A-Za-z0-9])\s+(?:dot|punto|punkt|point)\s+(?=[A-Za-z0-9]))"
    rf"|(?P<digits>\b(?:{_WORD})(?:(?:\s+(?:dot|punto|punkt|point)\s+|[\s,.-]+)(?:{_WORD}))+\b)",
    re.IGNORECASE,
)
_SPELLED = re.compile(rf"\b(?:{_WORD}|dot|punto|punkt|point)\b", re.IGNORECASE)
#: What a text must hold for a disguise rule to apply at all: found wherever _DISGUISES is.
_HINT = re.compile(rf"[\[({{<]\s*(?:{_AT}|{_DOT})\s*[\])}}>]|\b(?:dot|punto|punkt|point|arroba)\b|\sat\s+{_NAME}\.[A-Za-z0-9-]|\s@|@\s|\b(?:{_WORD})[\s,.-]+(?:{_WORD})\b", re.IGNORECASE)


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (2 if k % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def identifiers(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of plain identifiers: per kind leftmost first, without overlaps."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            last = domain.end()
            out.append((0, start, last))
        at = text.find("@", max(at + 1, last))
    out += [(1, *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and _luhn(digits):
            out.append((2, *m.span()))
    out += [(3, *m.span()) for m in _PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


@cache
def _plain(char: str) -> str:
    """The ASCII that a non-ASCII character stands for; itself where it stands for none."""
    if char in UNSEEN:
        return ""
    if char in HOMOGLYPHS:
        return HOMOGLYPHS[char]
    if unicodedata.category(char) == "Nd":
        return str(unicodedata.digit(char))
    wide = unicodedata.normalize("NFKC", char)
    return wide if wide.isascii() else char


@cache
def _mapped() -> np.ndarray:
    """Of each code point of two bytes in UTF-8 whether it stands for something else."""
    return np.array([c >= 0x80 and _plain(chr(c)) != chr(c) for c in range(0x800)])


def _foreign(body: np.ndarray) -> np.ndarray:
    """The bytes that begin a character which the transducer may rewrite."""
    after = np.append(body[1:], np.uint8(0)) & 0x3F
    pair = (body >= 0xC2) & (body < 0xE0)
    return (body >= 0xE0) | (pair & _mapped()[((body & 0x1F).astype(np.int64) << 6) | after])


def rewritten(text: str) -> tuple[str, list[int], list[int]]:
    """The normalised text and, of each of its characters, the source span [start, end) behind it."""
    chars, start, end = [], [], []
    for k, c in enumerate(text):
        for x in c if c.isascii() else _plain(c):
            chars.append(x)
            start.append(k)
            end.append(k + 1)
    text = "".join(chars)
    out, begin, stop, done = [], [], [], 0

    def keep(to: int) -> None:
        out.append(text[done:to])
        begin.extend(start[done:to])
        stop.extend(end[done:to])

    for m in _DISGUISES.finditer(text):
        first = m.start()
        while not m["digits"] and first > done and text[first - 1].isspace():  # in the pattern, this would take each run of spaces time and again
            first -= 1
        keep(first)
        if m["digits"]:
            for w in _SPELLED.finditer(text, *m.span()):
                out.append(SPELLED.get(w[0].lower(), "."))
                begin.append(start[w.start()])
                stop.append(end[w.end() - 1])
        else:
            out.append("@" if m["at"] else ".")
            begin.append(start[first])
            stop.append(end[m.end() - 1])
        done = m.end()
    keep(len(text))
    return "".join(out), begin, stop


def personal_data(text: str, disguised: bool = True) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(base spans, added spans) of a text, each sorted by kind and start."""
    base = sorted(identifiers(text))
    if not disguised:
        return base, []
    plain, start, end = rewritten(text)
    added, taken = [], np.zeros(len(text) + 1, dtype=bool)
    for _, a, b in base:
        taken[a:b] = True
    if plain != text:
        for kind, a, b in sorted(identifiers(plain)):
            span = (kind, start[a], end[b - 1])
            if not taken[span[1] : span[2]].all():
                added.append(span)
    return base, added


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    digit_or_at = np.zeros(256, dtype=bool)
    digit_or_at[[*range(0x30, 0x3A), 0x40]] = True
    for batch in batches:
        for part in pieces(batch, "text"):
            column = part.column("text")
            body, offsets = utf8(column)
            plain = np.add.reduceat(np.append(digit_or_at[body], False), offsets[:-1]) * (np.diff(offsets) > 0)
            odd = np.add.reduceat(np.append(_foreign(body), False), offsets[:-1]) * (np.diff(offsets) > 0)
            found = []
            for k in range(part.num_rows):
                base = added = ()
                text = column[k].as_py() or ""
                hint = bool(odd[k]) or bool(_HINT.search(text))
                if hint or plain[k]:
                    base, added = personal_data(text, hint)
                found.append([{"kind": KINDS[s[0]], "start": s[1], "end": s[2], "disguised": d} for d, spans in ((False, base), (True, added)) for s in spans])
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("disguised", pa.bool_())]))
            yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(found, kind)], names=["row", "spans"])


def personal_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs -> (row: all columns of docs, spans: kind, start, end, disguised).

    Offsets are code points of the source text, end exclusive. Plain identifiers are always kept; a
    disguised one is added where it is not within plain ones. Null and empty texts have no spans;
    repeated rows and columns of any name pass through unchanged.
    """
    held = docs.select(F.struct("*").alias("row"), F.col(text).cast("string").alias("text"))
    spans = T._parse_datatype_string("array<struct<kind:string,start:bigint,end:bigint,disguised:boolean>>")
    schema = T.StructType([held.schema["row"], T.StructField("spans", spans)]).simpleString()
    return in_arrow(held, _find, schema[len("struct<") : -1])


def span_list(spans: str | F.Column) -> F.Column:
    """kind:start:end of spans, by kind as listed and then start, joined by commas."""
    rank = lambda s: F.array_position(F.array(*[F.lit(k) for k in KINDS]), s["kind"])
    order = F.array_sort(F.transform(spans, lambda s: F.struct(rank(s).alias("k"), s["start"].alias("a"), s["end"].alias("b"), s["kind"].alias("kind"))))
    return F.array_join(F.transform(order, lambda s: F.concat_ws(":", s["kind"], s["a"].cast("string"), s["b"].cast("string"))), ",")
