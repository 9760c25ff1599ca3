"""Operator 12: personal data by offset-preserving deobfuscation.

Base spans are found on the text itself. Then transducers rewrite what disguises identifiers, each keeping for
every character it writes the range of source characters it stands for:

- characters: zero-width characters vanish; full-width and other compatibility forms, look-alikes of Latin
  letters and digits of any script become ASCII;
- numbers: spelled digits in a row ("four five nine", "double seven"; English, French, German, Spanish), "plus"
  before digits, letters that pose as digits ("4O5", "l92"), "dot" between digits;
- addresses: "[at]", "(dot)", " at ... dot com" and the like become "@" and ".".

Identifiers are detected on what the transducers wrote, and their spans mapped back to source characters. A
span is added if something in it was rewritten and no base span of its kind holds it.

Scale: documents are independent, so the operator is one narrow stage. Every detector is linear in the text:
candidates are found by their fixed parts ("@", "+", runs of digits) and runs are consumed whole.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import pairwise

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geomedallion.llm.common import in_arrow

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int]

# --- detectors: spans of a text, leftmost and without overlaps within a kind ---

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_HOST = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_PARTS = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def emails(text: str) -> list[Span]:
    """``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``, sought from each "@" to both sides."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        if at >= done and (host := _HOST.match(text, at + 1)):
            start = at
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                done = host.end()
                out.append((start, done))
        at = text.find("@", at + 1)
    return out


def addresses(text: str) -> list[Span]:
    """Four dotted numbers of at most 255, taken four by four from each dotted run."""
    out = []
    for run in _PARTS.finditer(text):
        parts = run.group().split(".")
        at = run.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in four):
                out.append((at, end))
            at = end + 1
    return out


def _luhn(digits: str) -> bool:
    values = [ord(d) - 48 for d in reversed(digits)]
    return (sum(values[::2]) + sum(2 * v - 9 * (v > 4) for v in values[1::2])) % 10 == 0


def cards(text: str) -> list[Span]:
    """Runs of digits, single blanks or hyphens between them, that have 16 to 19 digits and the check digit."""
    out = []
    for run in _DIGITS.finditer(text):
        if run.end() - run.start() <= 37:  # 19 digits and 18 separators
            digits = run.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and _luhn(digits):
                out.append(run.span())
    return out


def phones(text: str) -> list[Span]:
    """``\\+[0-9][\\x20().0-9-]+[0-9]`` with 8 to 15 digits."""
    return [m.span() for m in _PHONE.finditer(text) if 8 <= sum(c.isdigit() for c in m.group()) <= 15] if "+" in text else []


DETECTORS: dict[str, Callable[[str], list[Span]]] = {"email": emails, "ip": addresses, "card": cards, "phone": phones}


# --- transducers ---


class Tape:
    """A text with the source range of every stretch of it. Stretches are either copied or rewritten."""

    def __init__(self, text: str):
        self.text, self.at, self.source, self.changed = text, [0], [(0, len(text))], [False]

    def copy(self) -> Tape:
        out = Tape("")
        out.text, out.at, out.source, out.changed = self.text, self.at, self.source, self.changed  # replaced, never altered
        return out

    def rewrite(self, pattern: re.Pattern, output: Callable[[re.Match], str | list[tuple[Span, str]] | None]) -> None:
        """Replace each match by ``output(match)``, or parts of it one by one; None leaves it as it is."""
        pieces, at, source, changed, last, size = [], [], [], [], 0, 0

        def emit(piece: str, span: Span, new: bool) -> None:
            nonlocal size
            at.append(size), source.append(span), changed.append(new)
            pieces.append(piece)
            size += len(piece)

        def copy(start: int, end: int) -> None:
            while start < end:  # stretches of this tape, cut to start..end
                k = bisect_right(self.at, start) - 1
                stop = min(end, self.at[k + 1] if k + 1 < len(self.at) else len(self.text))
                if self.changed[k]:
                    emit(self.text[start:stop], self.source[k], True)
                else:
                    s = self.source[k][0] + start - self.at[k]
                    emit(self.text[start:stop], (s, s + stop - start), False)
                start = stop

        for m in pattern.finditer(self.text):
            new = output(m)
            for (start, end), piece in [(m.span(), new)] if isinstance(new, str) else new or []:
                if piece != self.text[start:end]:
                    copy(last, start)
                    if piece:  # what vanishes belongs to no stretch
                        emit(piece, self.span(start, end)[0], True)
                    last = end
        if last:
            copy(last, len(self.text))
            self.text = "".join(pieces)
            self.at, self.source, self.changed = at or [0], source or [(0, 0)], changed or [False]

    def span(self, start: int, end: int) -> tuple[Span, bool]:
        """Source range of ``start`` to ``end`` (not empty), and whether anything in it was rewritten."""
        first, last = bisect_right(self.at, start) - 1, bisect_right(self.at, end - 1) - 1
        s, e = self.source[first][0], self.source[last][1]
        if not self.changed[first]:
            s += start - self.at[first]
        if not self.changed[last]:
            e = self.source[last][0] + end - self.at[last]
        # a gap between two stretches is something that vanished
        gaps = any(self.source[k][1] != self.source[k + 1][0] for k in range(first, last))
        return (s, e), gaps or any(self.changed[first : last + 1])


# Letters of other scripts that look like the Latin letter above them.
LOOK_ALIKES = {
    "Cyrillic": ("aceiopxyjshdqwABCEHIJKMOPSTXY", "асеіорхујѕһԁԛԝАВСЕНІЈКМОРЅТХУ"),
    "Greek": ("aiknoptuvxABEZHIKMNOPTYX", "αικηορτυνχΑΒΕΖΗΙΚΜΝΟΡΤΥΧ"),
    "other": ("gil.", "ɡıӏ․"),
}
VANISH = "­​‌‍⁠﻿"
DASHES = "‐‑‒–—―−"
# The digits 0 to 9 in four languages.
SPELLED = {
    "en": "zero one two three four five six seven eight nine",
    "fr": "zéro un deux trois quatre cinq six sept huit neuf",
    "de": "null eins zwei drei vier fünf sechs sieben acht neun",
    "es": "cero uno dos tres cuatro cinco seis siete ocho nueve",
}
AT_WORDS, DOT_WORDS = ("at", "arroba", "arobase"), ("dot", "punto", "point", "punkt")
TIMES = {"double": 2, "triple": 3}
# Last labels that an address in plain words ("ann at mail dot com") must end in; two letters are a country.
LAST_LABELS = frozenset("com org net edu gov mil int info biz name app dev example test local mail".split())
ARTICLES = frozenset("the a an this that le la les el los der die das".split())


@lru_cache(maxsize=1)
def _characters() -> dict[str, str]:
    """Characters to rewrite, by rule: compatibility forms of ASCII, digits of any script, look-alikes."""
    out = dict.fromkeys(VANISH, "")
    for code in range(0x80, 0x20000):
        c = chr(code)
        plain = unicodedata.normalize("NFKC", c)
        if len(plain) == 1 and "!" <= plain <= "~":
            out[c] = plain
        elif (digit := unicodedata.digit(c, None)) is not None:
            out[c] = str(digit)
        elif plain == " ":
            out[c] = " "
    for latin, other in LOOK_ALIKES.values():
        out.update(zip(other, latin))
    return out


_DIGIT_OF = {word: str(d) for words in SPELLED.values() for d, word in enumerate(words.split())}
_FIRST = {w[0]: "|".join(v[1:] for v in sorted(_DIGIT_OF, reverse=True) if v[0] == w[0]) for w in sorted(_DIGIT_OF)}
_ONE = rf"[0-9]++|(?:(?:{'|'.join(TIMES)}) )?(?:{'|'.join(f'{c}(?:{rest})' for c, rest in _FIRST.items())})"
_DOT = rf"\s?[\[({{<]?\s?(?:{'|'.join(DOT_WORDS)})\s?[\])}}>]?\s?"
_SPELLED = re.compile(rf"\b(?:{_ONE})(?:(?:[ ,-]{{1,2}}|\.|{_DOT})(?:{_ONE}))+\b", re.IGNORECASE)
_SPELLED_PART = re.compile(rf"(\.|{'|'.join(DOT_WORDS)})|(?:({'|'.join(TIMES)}) )?([^\W_]+)", re.IGNORECASE)
_DASH = re.compile(f"[{DASHES}]")
_DIGIT = re.compile("[0-9]")
_PLUS = re.compile(r"\bplus[ -]?(?=\(?[0-9])", re.IGNORECASE)
_NUMBER_DOT = re.compile(rf"(?<=[0-9])(?:{_DOT}|\s?[\[({{<]\s?\.\s?[\])}}>]\s?)(?=[0-9])", re.IGNORECASE)
_POSING = re.compile(  # in a word of such letters and digits, or alone in a dotted or international number
    r"\b[0-9OoIlSB|]{2,24}+(?![^\W_])|[OoIl|](?<=[0-9]\..)(?![^\W_])|\b[OoIl](?=\.[0-9])|[Il|](?<=\+.)(?=[ (-]{0,2}[0-9])"
)
_POSE = str.maketrans("OoIl|SB", "0011158")
_OPEN, _CLOSE = r"\s{0,3}[\[({<]\s{0,3}", r"\s{0,3}[\])}>]\s{0,3}"
_AT_MARK = re.compile(rf"{_OPEN}(?:{'|'.join(AT_WORDS)}|@){_CLOSE}", re.IGNORECASE)
_DOT_MARK = re.compile(rf"{_OPEN}(?:{'|'.join(DOT_WORDS)}|\.){_CLOSE}", re.IGNORECASE)
_DOT_WORD = re.compile(rf"(?<=[A-Za-z0-9])[ _]{{1,2}}(?:{'|'.join(DOT_WORDS)})[ _]{{1,2}}(?=[A-Za-z0-9])", re.IGNORECASE)
_AT_WORD = re.compile(rf"(?<=[A-Za-z0-9])[ _]{{1,2}}(?:{'|'.join(AT_WORDS)})[ _]{{1,2}}(?=[A-Za-z0-9-]{{1,63}}(?:\.[A-Za-z0-9-]{{1,63}}){{1,8}})", re.IGNORECASE)
_SPACED_AT = re.compile(r"(?<=[A-Za-z0-9])\s{0,2}@\s{0,2}(?=[A-Za-z0-9])")
_AT_HINT = re.compile(rf"@|\b(?:{'|'.join(AT_WORDS)})\b", re.IGNORECASE)


def _spelled_digits(m: re.Match) -> list[tuple[Span, str]] | None:
    """Each word becomes digits; nothing is left between single digits or around dots, longer numbers stay apart."""
    tokens = []
    for part in _SPELLED_PART.finditer(m.string, m.start(), m.end()):
        dot, times, word = part.groups()
        new = "." if dot else _DIGIT_OF.get(word.lower(), word) * TIMES.get((times or "").lower(), 1)
        tokens.append((part.span(), new, "dot" if dot else "digit" if word.lower() in _DIGIT_OF else "figure" if len(word) == 1 else "number"))
    kinds = {kind for _, _, kind in tokens}
    if "digit" not in kinds:
        return None
    parts = [(span, new) for span, new, _ in tokens]
    for (one, _, kind), (two, _, after) in pairwise(tokens):
        if "dot" in (kind, after) or "number" not in (kind, after):
            parts.append(((one[1], two[0]), ""))
    return sorted(parts)


def _characters_of(tape: Tape) -> None:
    if not tape.text.isascii():
        table = _characters()
        if found := "".join(sorted(set(tape.text) & table.keys())):  # few of the many
            tape.rewrite(re.compile(f"[{re.escape(found)}]"), lambda m: table[m.group()])


def _numbers_of(tape: Tape) -> None:
    tape.rewrite(_SPELLED, _spelled_digits)
    if _DIGIT.search(tape.text):
        tape.rewrite(_DASH, lambda m: "-")
        tape.rewrite(_POSING, lambda m: m.group().translate(_POSE) if len(m.group()) == 1 or _DIGIT.search(m.group()) else None)
        tape.rewrite(_NUMBER_DOT, lambda m: ".")
        tape.rewrite(_PLUS, lambda m: "+")


def hidden_numbers(tape: Tape, kind: str) -> list[Span]:
    """Numbers of a kind that were rewritten; a phone that begins with "plus" as a word has ten digits at least."""
    out = []
    for s, e in DETECTORS[kind](tape.text):
        span, new = tape.span(s, e)
        if new and not (kind == "phone" and tape.span(s, s + 1)[1] and sum(map(str.isdigit, tape.text[s:e])) < 10):
            out.append(span)
    return out


def hidden_emails(tape: Tape) -> list[Span]:
    """Addresses of a tape once "at" and "dot" are undone. Plain words count only before a known last label."""
    if not _AT_HINT.search(tape.text):
        return []

    def seen(known_label: bool) -> list[Span]:
        out, text = [], tape.text
        for s, e in emails(text):
            last = text[s:e].rpartition(".")[2].lower()
            apart = not (s and text[s - 1].isalpha()) and not (e < len(text) and text[e].isalpha())
            if apart and (not known_label or last in LAST_LABELS or (len(last) == 2 and last.isalpha())):
                span, new = tape.span(s, e)
                if new:
                    out.append(span)
        return out

    tape.rewrite(_DOT_MARK, lambda m: ".")
    tape.rewrite(_AT_MARK, lambda m: "@")
    marked = seen(known_label=False)
    tape.rewrite(_DOT_WORD, lambda m: ".")
    tape.rewrite(_SPACED_AT, lambda m: "@")
    tape.rewrite(_AT_WORD, lambda m: "@" if _has_dot_word(tape, m.end()) else None)
    worded = seen(known_label=True)
    return worded + [(s, e) for s, e in marked if not any(a < e and s < b for a, b in worded)]


def _has_dot_word(tape: Tape, start: int) -> bool:
    """Whether a dot of the host that starts here was rewritten: "look at example.com" and "at the dot" are no addresses."""
    host = _HOST.match(tape.text, start)
    return bool(host) and host.group().split(".")[0].lower() not in ARTICLES and any(tape.span(start + k, start + k + 1)[1] for k, c in enumerate(host.group()) if c == ".")


def find_spans(text: str | None) -> tuple[dict[str, list[Span]], dict[str, list[Span]]]:
    """Base spans and added spans of a text, by kind, in code points with exclusive ends."""
    text = text or ""
    base = {kind: find(text) for kind, find in DETECTORS.items()}
    added: dict[str, list[Span]] = {kind: [] for kind in KINDS}
    letters = Tape(text)
    _characters_of(letters)
    numbers = letters.copy()
    _numbers_of(numbers)
    for kind in ("ip", "card", "phone"):
        if letters.text is not text:
            added[kind] = hidden_numbers(letters, kind)
        if numbers.text is not letters.text:  # spelled digits next to a number that shows are not part of it
            shown = base[kind] + added[kind]
            added[kind] += [(s, e) for s, e in hidden_numbers(numbers, kind) if not any(a < e and s < b for a, b in shown)]
    added["email"] = hidden_emails(letters)
    for kind in KINDS:
        held = base[kind]
        fresh = {(s, e) for s, e in added[kind] if not any(a <= s and e <= b for a, b in held)}
        added[kind] = sorted(fresh)
    return base, added


def _written(spans: dict[str, list[Span]]) -> str:
    return ",".join(f"{kind}:{s}:{e}" for kind in KINDS for s, e in spans[kind])


def find_personal_data(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``base_spans`` and ``spans`` (``kind:start:end``, by kind, then start, joined by commas).

    ``spans`` also has what only shows once disguises are undone. Positions are code points of the whole text,
    ends exclusive. Null and empty texts have no spans. Rows and columns stay, repeated rows too; existing columns
    of the two names are replaced; an empty table gives no rows. Overlaps of different kinds are all reported.
    """
    kept = [c for c in docs.columns if c not in ("base_spans", "spans")]
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in kept)).alias("row"))  # no column name can clash
    schema = T.StructType([rows.schema["row"], T.StructField("base_spans", T.StringType()), T.StructField("spans", T.StringType())])
    at = kept.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, every = [], []
            for body in batch.column(0).field(at):
                base, added = find_spans(body.as_py())
                first.append(_written(base))
                every.append(_written({k: sorted(base[k] + added[k]) for k in KINDS}))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(first, pa.string()), pa.array(every, pa.string())], names=schema.names)

    return in_arrow(rows, run, schema).select(*(F.col("row").getField(c).alias(c) for c in kept), "base_spans", "spans")
