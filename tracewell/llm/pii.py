"""Personal data in texts, disguised or not: offset-preserving deobfuscation.

Transducers rewrite a text step by step (look-alike characters, at and dot in words or brackets, spelled
digits) and keep, for each run of output, the source characters it stands for. Identifiers are found in the
text as it is and in the rewritten one, and what was found there is mapped back to source characters.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_texts, map_rows, row_udf

KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9][0-9.]*")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile("[0-9]")
NO_DIGITS = re.compile("[^0-9]")

# Characters that look like ASCII letters.
LOOKALIKES = dict(
    zip(
        "аеорсухіјѕһԁԛԝкмтвнАВЕКМНОРСТУХІЈЅαονικρυτΑΒΕΖΗΙΚΜΝΟΡΤΥΧıɡɑ",
        "aeopcyxijshdqwkmtbhABEKMHOPCTYXIJSaovikputABEZHIKMNOPTYXiga",
        strict=True,
    )
)
LOOKALIKES |= dict.fromkeys("‐‑‒–—−﹣", "-") | dict.fromkeys("․。｡﹒", ".") | dict.fromkeys("\xa0       　", " ") | {"﹢": "+", "﹫": "@"}
#: Invisible characters that are put inside identifiers.
INVISIBLE = "\xad​‌‍⁠﻿"
# Names of digits in English, German, French and Spanish.
SPELLED = (
    ("zero", "oh", "null", "zéro", "cero"),
    ("one", "eins", "un", "uno"),
    ("two", "zwei", "deux", "dos"),
    ("three", "drei", "trois", "tres"),
    ("four", "vier", "quatre", "cuatro"),
    ("five", "fünf", "cinq", "cinco"),
    ("six", "sechs", "seis"),
    ("seven", "sieben", "sept", "siete"),
    ("eight", "acht", "huit", "ocho"),
    ("nine", "neun", "neuf", "nueve"),
)
DIGIT_OF = {name: str(d) for d, names in enumerate(SPELLED) for name in names}
REPEAT = {"double": 2, "triple": 3}
_NAME = "(?:(?:double|triple)[ ])?(?:" + "|".join(sorted(DIGIT_OF, key=len, reverse=True)) + ")"
SPELLED_RUN = re.compile(rf"(?<!\w)(?:plus[ ])?{_NAME}(?:[\s,-]{{1,3}}{_NAME}){{2,}}(?!\w)", re.IGNORECASE)
SPELLED_HINT = re.compile(rf"(?<!\w)(?:{'|'.join(sorted(DIGIT_OF, key=len, reverse=True))})[\s,-]")
SPELLED_TOKEN = re.compile(r"\w+")
PLUS_WORD = re.compile(r"(?<!\w)plus\s?(?=[0-9])", re.IGNORECASE)
LETTER_DIGIT = re.compile(r"(?<=[0-9])[OoIl](?=[0-9])")
#: at and dot, in brackets or as words of their own.
DISGUISE = re.compile(r"[\[({<]\s?(?:(at|@|arroba)|(dot|\.|punkt|punto|point))\s?[\])}>]|(?<!\w)(?:(at|arroba)|(dot|punkt|punto))(?!\w)", re.IGNORECASE)
DOMAIN_AHEAD = re.compile(r"[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,8}(?:\s?[\[({<]\s?(?:dot|\.|punkt|punto|point)\s?[\])}>]\s?|\s(?:dot|punkt|punto)\s)[A-Za-z0-9-]", re.IGNORECASE)
HINTS = ("dot", "punkt", "punto", "point", "(at", "[at", "{at", "<at", "( at", "[ at", "{ at", "< at", "(@", "[@", "{@", "<@", "( @", "[ @", "(.", "[.", "arroba")

Span = tuple[int, int]
Edit = tuple[int, int, str]


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) << (k & 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def emails(text: str) -> Iterator[Span]:
    """The address pattern, leftmost and non-overlapping, found from its @ signs."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at)):
            yield start, m.end()
            done = m.end()
        at = text.find("@", at + 1)


def ips(text: str) -> Iterator[Span]:
    for run in DOTTED.finditer(text):
        if run.end() - run.start() >= 7:
            for m in IP.finditer(text, run.start(), run.end()):
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                    yield m.span()


def cards(text: str) -> Iterator[Span]:
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12 and 12 <= len(d := NO_DIGITS.sub("", m[0])) <= 19 and luhn(d):
            yield m.span()


def phones(text: str) -> Iterator[Span]:
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(NO_DIGITS.sub("", m[0])) <= 15:
                yield m.span()


FINDERS: tuple[Callable[[str], Iterator[Span]], ...] = (emails, ips, cards, phones)


def identifiers(text: str) -> set[tuple[int, int, int]]:
    """(start, kind's place in KINDS, end) of all identifiers in plain view."""
    found = {(s, 0, e) for s, e in emails(text)}
    if DIGIT.search(text):
        found |= {(s, k, e) for k in (1, 2, 3) for s, e in FINDERS[k](text)}
    return found


class Rewritten:
    """A text after edits (start, end, output), in order, with the way back."""

    def __init__(self, text: str, edits: list[Edit]):
        parts, self.starts, self.runs, at, size = [], [], [], 0, 0
        for start, end, output in edits:
            for piece, source in ((text[at:start], None), (output, (start, end))):
                if piece or source:  # what was taken out is a run without characters
                    self.starts.append(size)
                    self.runs.append((at, source))
                    parts.append(piece)
                    size += len(piece)
            at = end
        if at < len(text):
            self.starts.append(size)
            self.runs.append((at, None))
            parts.append(text[at:])
        self.text = "".join(parts)

    def back(self, start: int, end: int) -> tuple[int, int, bool]:
        """Source characters of [start, end) of the output, and whether an edit made any of them."""
        first, last = bisect_right(self.starts, start) - 1, bisect_right(self.starts, end - 1) - 1
        at, source = self.runs[first]
        begin = source[0] if source else at + start - self.starts[first]
        at, source = self.runs[last]
        finish = source[1] if source else at + end - self.starts[last]
        return begin, finish, any(self.runs[k][1] for k in range(first, last + 1))


def plain_character(c: str) -> str | None:
    """The ASCII character that c stands for, an empty text if it is invisible, None if it stays."""
    if c in LOOKALIKES:
        return LOOKALIKES[c]
    if c in INVISIBLE:
        return ""
    if (d := unicodedata.decimal(c, None)) is not None:
        return str(d)
    if "！" <= c <= "～" or "\U0001d400" <= c <= "\U0001d7ff":  # full width and mathematical letters
        n = unicodedata.normalize("NFKC", c)
        return n if n.isascii() else LOOKALIKES.get(n)
    return None


#: What may have to be rewritten; plain_character decides.
ODD = re.compile("[" + "".join(map(re.escape, LOOKALIKES)) + INVISIBLE + r"！-～\U0001d400-\U0001d7ff]|(?![0-9])\d")


def character_edits(text: str) -> list[Edit]:
    if text.isascii():
        return []
    return [(m.start(), m.end(), plain) for m in ODD.finditer(text) if (plain := plain_character(m[0])) is not None]


def disguise_edits(text: str) -> list[Edit]:
    low = text.lower()
    if not any(h in low for h in HINTS):
        return []
    edits: list[Edit] = []
    for m in DISGUISE.finditer(text):
        start, end, done = m.start(), m.end(), edits[-1][1] if edits else 0
        while start > done and text[start - 1].isspace():
            start -= 1
        while end < len(text) and text[end].isspace():
            end += 1
        if start == done or end == len(text) or not (text[start - 1].isascii() and text[start - 1].isalnum() and text[end].isascii() and text[end].isalnum()):
            continue
        if m[3] or m[4]:  # a word: it must stand alone, and "at" needs a domain with a disguised dot behind it
            if start == m.start() or end == m.end() or (m[3] and not DOMAIN_AHEAD.match(text, end)):
                continue
        edits.append((start, end, "@" if m[1] or m[3] else "."))
    return edits


def digit_edits(text: str) -> list[Edit]:
    edits: list[Edit] = []
    if SPELLED_HINT.search(text.lower()):
        for run in SPELLED_RUN.finditer(text):
            times, begin = 1, run.start()
            for m in SPELLED_TOKEN.finditer(text, run.start(), run.end()):
                name = m[0].lower()
                if name == "plus":
                    output = "+"
                elif name in REPEAT:
                    times = REPEAT[name]
                    continue
                else:
                    output, times = DIGIT_OF[name] * times, 1
                edits.append((begin, m.end(), output))  # separators go with the name behind them
                begin = m.end()
    edits += [(m.start(), m.end(), "+") for m in PLUS_WORD.finditer(text)]
    edits += [(m.start(), m.end(), "0" if m[0] in "Oo" else "1") for m in LETTER_DIGIT.finditer(text)]
    return sorted(edits)


def spans_in(text: str) -> tuple[set[tuple[int, int, int]], set[tuple[int, int, int]]]:
    """Spans in plain view, and those that only the rewritten text shows.

    An added span has a rewritten character in it, stands apart from letters and digits around it, and
    touches no plain span of its kind unless it contains more than that.
    """
    base, steps, now = identifiers(text), [], text
    for edits_of in (character_edits, disguise_edits, digit_edits):
        if edits := edits_of(now):
            steps.append(Rewritten(now, edits))
            now = steps[-1].text
    added: set[tuple[int, int, int]] = set()
    if steps:
        for start, kind, end in identifiers(now):
            if start and now[start - 1].isalnum() or end < len(now) and now[end].isalnum():
                continue
            edited = False
            for step in reversed(steps):
                start, end, touched = step.back(start, end)
                edited |= touched
            if edited and all(e <= start or end <= s or (start <= s and e <= end and (start, end) != (s, e)) for s, k, e in base if k == kind):
                added.add((start, kind, end))
    return base, added


def written(spans: set[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


def find(docs: DataFrame) -> DataFrame:
    """Per document: doc_id and spans, an array of (kind, start, end, base); code points, end exclusive; base: in plain view.

    A map over the documents, without a shuffle. A null or empty text has no spans; rows that repeat a
    doc_id, or have none, are documents of their own; other columns are ignored. Texts of any length are
    read whole, in time that grows with their length.
    """

    def rows(rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, text in rows:
            base, added = spans_in(text or "")
            yield doc_id, [{"kind": KINDS[k], "start": s, "end": e, "base": (s, k, e) in base} for s, k, e in sorted(base | added)]

    return map_rows(doc_texts(docs), rows, "doc_id long, spans array<struct<kind: string, start: int, end: int, base: boolean>>")


def masked(docs: DataFrame) -> DataFrame:
    """docs with every identifier in text replaced by its kind in brackets, and n_chars (if there) counted again.

    Overlapping spans become one, named after the first. Other columns stay as they are.
    """

    def mask(text: str | None) -> str | None:
        if not text:
            return text
        base, added = spans_in(text)
        parts, done, open_kind, open_at = [], 0, -1, 0
        reach = -1
        for s, k, e in sorted(base | added):
            if s >= reach:
                if open_kind >= 0:
                    parts += [text[done:open_at], f"[{KINDS[open_kind].upper()}]"]
                    done = reach
                open_kind, open_at, reach = k, s, e
            else:
                reach = max(reach, e)
        if open_kind >= 0:
            parts += [text[done:open_at], f"[{KINDS[open_kind].upper()}]"]
            done = reach
        return "".join([*parts, text[done:]])

    out = docs.withColumn("text", row_udf(mask, "string")(F.col("text").cast("string")))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def digest(docs: DataFrame) -> DataFrame:
    """Per document: numbers of plain spans by kind, the SHA-256 of these written out, all spans written out, and how many were added."""

    def rows(rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, text in rows:
            base, added = spans_in(text or "")
            counts = [sum(k == kind for _, k, _ in base) for kind in range(4)]
            yield doc_id, *counts, hashlib.sha256(written(base).encode()).hexdigest(), written(base | added), len(added)

    return map_rows(doc_texts(docs), rows, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")
