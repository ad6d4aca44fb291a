"""Personal data in texts, also where it is disguised, with spans in the source's characters.

Plain identifiers are found in the text as it stands.  Then transducers rewrite it, keeping for every
character of the result the span of the source it stands for:

    homoglyphs    letters and digits of other scripts and widths that look like Latin ones
    digits        spelled digits in a row become digits
    at and dot    ``(at)``, ``[dot]``, `` at `` ... `` dot `` become ``@`` and ``.``

Identifiers found in the rewritten text are mapped back and added beside the plain ones, which stay
as they are; one that lies within a plain one of its kind tells nothing new and is left out.

All scans take time in proportion to the text, whatever runs of characters stand in it: addresses are looked for
from their ``@`` on, and what cannot begin a match is not begun at each of its characters.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
_LOCAL_PART = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
#: The same matches as without the look back: what fails from the first digit of a run fails from the others.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_DOTTED = re.compile(r"[0-9]\.[0-9]")
_LONG = re.compile(r"[0-9](?:[\x20-]?[0-9]){15}")

# Characters that look like Latin letters, and the names of the digits.
GLYPHS = dict(
    zip(
        "АВЕЅІЈКМНОРСТХУаеѕіјорсхуԁԛԝһΑΒΕΖΗΙΚΜΝΟΡΤΥΧοıɡ＠．＋－（）％＿　",
        "ABESIJKMHOPCTXYaesijopcxydqwhABEZHIKMNOPTYXoig@.+-()%_ ",
        strict=True,
    )
)
DIGIT_NAMES = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6",
    "seven": "7", "eight": "8", "nine": "9", "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4",
    "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9", "zéro": "0", "deux": "2", "trois": "3",
    "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9", "cero": "0", "uno": "1", "dos": "2",
    "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}

_GLYPH_TABLE = str.maketrans(
    GLYPHS
    | {chr(0xFF10 + k): str(k) for k in range(10)}
    | {chr(0xFF21 + k): chr(65 + k) for k in range(26)}
    | {chr(0xFF41 + k): chr(97 + k) for k in range(26)}
)
_GLYPH = re.compile("[" + "".join(map(re.escape, map(chr, _GLYPH_TABLE))) + "]")
_NAME = "|".join(sorted(DIGIT_NAMES, key=len, reverse=True))
_NUMBER = rf"(?:{_NAME}|[0-9]+)"
_SPELLED = re.compile(rf"(?<!\w)(?:plus[\x20-])?{_NUMBER}(?:[\x20,.-]{{1,2}}{_NUMBER}){{3,}}(?!\w)", re.I)
_SPELLED_PART = re.compile(rf"(?:{_NAME}|plus)(?!\w)", re.I)
_OPEN, _SHUT = r"\x20?[\[({<]\x20?", r"\x20?[\])}>]\x20?"
_AT = rf"(?:{_OPEN}(?:at|@){_SHUT}|\x20@\x20)"
_DOT = rf"(?:{_OPEN}(?:dot|\.){_SHUT}|\x20dot\x20)"
_LABEL = r"[A-Za-z0-9-]+"
_LOCAL = re.compile(rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?:{_DOT}(?P<last>[A-Za-z0-9_%+-]+))*", re.I)
#: The word ``at`` counts only before the word ``dot`` or a bracketed one.
_REST = re.compile(
    rf"(?:{_AT}|@){_LABEL}(?:(?:{_DOT}|\.){_LABEL})+|\x20at\x20{_LABEL}(?:{_DOT}{_LABEL})+", re.I
)
_DISGUISE = re.compile(rf"(?P<at>{_AT}|\x20at\x20)|(?P<dot>{_DOT})", re.I)
_BRACKETED = re.compile(rf"[\[({{<]\x20?(?:at|@|dot|\.)\x20?[\])}}>]", re.I)
_NAMES = frozenset(DIGIT_NAMES)


def _may_spell(lowered: str) -> bool:
    return not _NAMES.isdisjoint(lowered.replace("-", " ").replace(",", " ").replace(".", " ").split(" "))


def _may_hide_mail(lowered: str) -> bool:
    return " @ " in lowered or (" dot " in lowered and (" at " in lowered or "@" in lowered)) or _BRACKETED.search(lowered) is not None


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(found: str) -> str:
    return "".join(c for c in found if "0" <= c <= "9")


def _valid(kind: str, found: str) -> bool:
    if kind == "email":
        return True
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in found.split("."))
    digits = _digits(found)
    return 16 <= len(digits) <= 19 and _luhn(digits) if kind == "card" else 8 <= len(digits) <= 15


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, not overlapping, of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = len(text[done:at].rstrip(_LOCAL_PART)) + done
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
        done = domain.end() if domain else at + 1
        at = text.find("@", done)


def _matches(pattern: re.Pattern[str], text: str) -> Iterator[tuple[int, int]]:
    return (m.span() for m in pattern.finditer(text))


def plain(text: str) -> Iterator[tuple[str, int, int]]:
    """``(kind, start, end)`` of identifiers as written, by kind and place; failing matches are dropped."""
    has_digit = _DIGIT.search(text) is not None
    for kind, found, may in (
        ("email", _emails(text), "@" in text),
        ("ip", _matches(IP, text), has_digit and _DOTTED.search(text)),
        ("card", _matches(CARD, text), has_digit and _LONG.search(text)),
        ("phone", _matches(PHONE, text), has_digit and "+" in text),
    ):
        if may:
            yield from ((kind, a, b) for a, b in found if _valid(kind, text[a:b]))


class Rewritten:
    """A text and, for every character of it, where in the source it begins and ends."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.starts: list[int] | range = range(len(text))
        self.ends: list[int] | range = range(1, len(text) + 1)

    def replace(self, pieces: list[tuple[int, int, str]]) -> None:
        """Put other text for ``(start, end, new)`` pieces; each new character stands for the whole piece."""
        text, starts, ends, at = [], [], [], 0
        for a, b, new in pieces:
            text += [self.text[at:a], new]
            starts += [*self.starts[at:a], *[self.starts[a]] * len(new)]
            ends += [*self.ends[at:a], *[self.ends[b - 1]] * len(new)]
            at = b
        text.append(self.text[at:])
        starts += self.starts[at:]
        ends += self.ends[at:]
        self.text, self.starts, self.ends = "".join(text), starts, ends


def _spelled(text: str) -> list[tuple[int, int, str]]:
    """Digit names in rows of four numbers or more, and the separators around them."""
    pieces = []
    for row in _SPELLED.finditer(text):
        names = list(_SPELLED_PART.finditer(text, row.start(), row.end()))
        for k, m in enumerate(names):
            new = "+" if m[0].lower() == "plus" else DIGIT_NAMES[m[0].lower()]
            end = m.end()
            if k + 1 < len(names) and not _DIGIT.search(text, end, names[k + 1].start()) and "." not in text[end : names[k + 1].start()]:
                end = names[k + 1].start()  # nothing but a separator stands between two names
            pieces.append((m.start(), end, new))
    return pieces


def _mails(text: str) -> Iterator[tuple[int, int]]:
    """Addresses with disguises.  A chain of words and dots without an ``at`` after it is not tried again from its
    middle, but from its last word, which may go on with a plain dot."""
    at = 0
    while m := _LOCAL.search(text, at):
        if rest := _REST.match(text, m.end()):
            yield m.start(), rest.end()
            at = rest.end()
        else:
            at = m.end() if m["last"] is None else m.start("last")


def _joined_mail(text: str) -> list[tuple[int, int, str]]:
    return [
        (d.start(), d.end(), "@" if d["at"] else ".") for a, b in _mails(text) for d in _DISGUISE.finditer(text, a, b)
    ]


def disguised(text: str) -> Iterator[tuple[str, int, int]]:
    """``(kind, start, end)``, in the source, of identifiers that only the rewritten text shows."""
    new = Rewritten(text)
    if not text.isascii() and _GLYPH.search(text):
        new.text = text.translate(_GLYPH_TABLE)
    changed = new.text != text
    for rewrite, may in ((_spelled, _may_spell), (_joined_mail, _may_hide_mail)):
        pieces = rewrite(new.text) if may(new.text.lower()) else []
        if pieces:
            new.replace(pieces)
            changed = True
    if changed:
        for kind, a, b in plain(new.text):
            start, end = new.starts[a], new.ends[b - 1]
            while end > start and text[end - 1] in " ,-":
                end -= 1
            yield kind, start, end


def find(text: str | None) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """(plain spans, all spans), each by kind in the order of ``KINDS``, then by start."""
    base = list(plain(text or ""))
    spans = set(base)
    starts = {kind: [a for k, a, _ in base if k == kind] for kind in KINDS}
    ends = {kind: [b for k, _, b in base if k == kind] for kind in KINDS}
    for kind, a, b in disguised(text or ""):
        # Plain spans of a kind do not overlap: only the last one that begins by then can hold this one.
        k = bisect.bisect_right(starts[kind], a) - 1
        if k < 0 or ends[kind][k] < b:
            spans.add((kind, a, b))
    return base, sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
_SPAN_TYPE = "array<struct<kind:string,start:int,end:int>>"


def personal_data(documents: DataFrame) -> DataFrame:
    """``documents`` with ``plain_spans`` and ``all_spans``, arrays of (kind, start, end) in code points.

    ``end`` is exclusive.  Null text is an empty one, and has none.  Rows are kept as they are, repeated
    ones too; columns of the two names are replaced.
    """
    taken = [c for c in documents.columns if c not in ("plain_spans", "all_spans")]

    def run(batches):
        for batch in batches:
            found = [find(text) for text in batch.column("text").to_pylist()]
            columns = [
                pa.array([[dict(zip(("kind", "start", "end"), s)) for s in pair[k]] for pair in found], _SPANS) for k in (0, 1)
            ]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in taken], *columns], [*taken, "plain_spans", "all_spans"]
            )

    rows = documents.select(*taken)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{schema}, plain_spans {_SPAN_TYPE}, all_spans {_SPAN_TYPE}")


def masked(documents: DataFrame) -> DataFrame:
    """``documents`` with every span of ``text`` replaced by its kind in brackets; other columns unchanged.

    Of overlapping spans the earlier, then the longer one gives the name, and the whole stretch goes.
    """

    def run(batches):
        for batch in batches:
            texts = [hidden(text) for text in batch.column("text").to_pylist()]
            at = batch.schema.get_field_index("text")
            yield batch.set_column(at, "text", pa.array(texts, batch.schema.field(at).type))

    return documents.mapInArrow(run, documents.schema)


def hidden(text: str | None) -> str | None:
    if not text:
        return text
    parts, at = [], 0
    for kind, a, b in sorted(find(text)[1], key=lambda s: (s[1], -s[2])):
        if a >= at:
            parts += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*parts, text[at:]])



def span_digest(found: DataFrame) -> DataFrame:
    """Counts of plain spans by kind, the hash of their list, and the list of all spans."""
    line = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("plain_spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(line("plain_spans"), 256).alias("base_sha256"),
        line("all_spans").alias("spans"),
    )
