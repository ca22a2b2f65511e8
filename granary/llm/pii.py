"""Personal data: plain patterns, and the same patterns behind common disguises.

A transducer rewrites look-alike letters and digits, spelled digits and "at" and
"dot" spellings into plain ones and remembers which source characters each
rewritten stretch came from. The plain patterns then run over the rewritten
text, and what they find there is mapped back to source offsets.

Each text is searched by itself in ``mapInArrow`` tasks: no shuffle, and memory
bounded by one Arrow batch. Patterns are anchored so that their cost is linear
in the text's length, one unbroken run of letters or digits included.

Defined cases: a null text counts as empty (and stays null when redacted); a
text without personal data has counts of 0, no spans and the hash of the empty
string; repeated rows get the same result each; an empty table gives no rows;
columns other than id and text are not read, and ``redact`` leaves them as they
are.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, int]  # start, place of the kind in KINDS, end

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGIT = re.compile("[0-9]")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Look-alikes from Cyrillic and Greek, and the letters they look like.
LOOK_ALIKE = dict(
    zip("аеорсухіјѕһԁԛԝАВЕКМНОРСТХІЈЅοανερτιΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "aeopcyxijshdqwABEKMHOPCTXIJSoaveptiABEZHIKMNOPTYX", strict=True)
)
#: Full-width forms, and the digits of other scripts, by their code points.
WIDE = {chr(0xFF01 + i): chr(0x21 + i) for i in range(94)}
DIGITS = {chr(base + i): str(i) for base in (0x0660, 0x06F0, 0x0966, 0x09E6) for i in range(10)}
#: Spelled digits.
SPELLED = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6",
    "seven": "7", "eight": "8", "nine": "9",
}

_ONE_FOR_ONE = LOOK_ALIKE | WIDE | DIGITS
_ODD = re.compile("[" + "".join(map(re.escape, _ONE_FOR_ONE)) + "]")
_WORD = "(?:" + "|".join(SPELLED) + ")"
_RUN = rf"(?<![A-Za-z])(?:plus[\s-]+)?{_WORD}(?:[\s,-]+{_WORD}){{6,}}(?![A-Za-z])"
#: The top-level names that a bare "x at y dot z" must end in.
_TOP = "(?:com|org|net|edu|gov|info|biz|io|co|uk|us|eu|de|fr|es|it|nl|ch|at|be|ca|au)"
_LABELS = r"[A-Za-z0-9-]+(?:\s+dot\s+[A-Za-z0-9-]+){0,3}?"
_AT = (
    r"(?<!\s)\s*+[(\[{<]\s*(?:at|@)\s*[)\]}>]\s*"
    rf"|(?<=[A-Za-z0-9])\s+at\s+(?={_LABELS}\s+dot\s+{_TOP}(?![A-Za-z0-9]))"
)
_DOT = r"(?<!\s)\s*+[(\[{<]\s*(?:dot|\.)\s*[)\]}>]\s*|(?<=[A-Za-z0-9])\s+dot\s+(?=[A-Za-z0-9])"
_REWRITE = re.compile(f"(?P<at>{_AT})|(?P<dot>{_DOT})|(?P<run>{_RUN})", re.IGNORECASE)
#: What every match of _REWRITE has, besides "dot" and as many spelled digits as a run: the way in for texts worth the search.
_BRACKET = re.compile(r"[(\[{<]\s*(?:at|@|dot|\.)\s*[)\]}>]", re.IGNORECASE)
#: Letters that a pattern takes for others where case is ignored.
_SAME_CASE = str.maketrans("ſıİ", "sii")


def _luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def plain_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each kind, sorted by start, then kind."""
    out: list[Span] = []
    at, end = text.find("@"), 0
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((start, 0, end := m.end()))
        at = text.find("@", max(at + 1, end))
    if _DIGIT.search(text):
        if "." in text:
            small = lambda p: len(p.lstrip("0")) <= 3 and int(p) <= 255
            out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(map(small, m.groups()))]
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and _luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            n_digits = lambda m: sum(c in "0123456789" for c in m[0])
            out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= n_digits(m) <= 15]
    return sorted(out)


def rewrite(text: str) -> tuple[str, list[tuple[int, int, int, int]]]:
    """The plain form of text, and (start, end, source start, source end) of each rewritten stretch."""
    stretches: list[tuple[int, int, int, int]] = []
    out: list[str] = []
    done = at = 0

    def put(plain: str, start: int, end: int) -> None:
        nonlocal done, at
        out.append(text[done:start])
        at += start - done
        stretches.append((at, at + len(plain), start, end))
        out.append(plain)
        at, done = at + len(plain), end

    source = text
    if not text.isascii() and _ODD.search(text):
        source = _ODD.sub(lambda m: _ONE_FOR_ONE[m[0]], text)  # one for one: offsets stay
    odd = [i for i, (a, b) in enumerate(zip(text, source, strict=True)) if a != b] if source is not text else []
    text, place = source, 0
    lower = (text if text.isascii() else text.translate(_SAME_CASE)).lower()
    need = "dot" in lower or _BRACKET.search(text) or sum(map(lower.count, SPELLED)) >= 7
    for m in _REWRITE.finditer(text) if need else ():
        while place < len(odd) and odd[place] < m.start():
            put(text[odd[place]], odd[place], odd[place] + 1)
            place += 1
        while place < len(odd) and odd[place] < m.end():
            place += 1
        if m.lastgroup == "run":
            words = re.findall("[a-z]+", m[0].translate(_SAME_CASE).lower())
            put("".join("+" if w == "plus" else SPELLED[w] for w in words), m.start(), m.end())
        else:
            put("@" if m.lastgroup == "at" else ".", m.start(), m.end())
    for i in odd[place:]:
        put(text[i], i, i + 1)
    out.append(text[done:])
    return "".join(out), stretches


def disguised_spans(text: str, base: list[Span]) -> list[Span]:
    """Spans, in source offsets, of what only the rewritten text shows: those that reach beyond each plain one."""
    plain, stretches = rewrite(text)
    if not stretches:
        return []
    starts, ends = [s[0] for s in stretches], [s[1] for s in stretches]

    def source(i: int, to_end: bool) -> int:
        k = bisect_right(starts, i - to_end) - 1
        if k < 0:
            return i
        start, end, first, last = stretches[k]
        if i - to_end < end:  # inside a rewritten stretch: all of it
            return last if to_end else first
        return last + i - end

    out = []
    for start, kind, end in plain_spans(plain):
        if bisect_right(ends, start) == bisect_right(starts, end - 1):
            continue  # nothing in it was rewritten
        span = (source(start, False), kind, source(end, True))
        if not any(a <= span[0] and span[2] <= b for a, _, b in base):
            out.append(span)
    return out


def find_spans(text: str | None) -> tuple[list[Span], list[Span]]:
    """Plain spans, and those that only the rewritten text shows."""
    base = plain_spans(text := text or "")
    return base, disguised_spans(text, base)


def _listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def scan_pii(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row for each row of docs: n_email, n_ip, n_card, n_phone, base_sha256, spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [find_spans(t.as_py()) for t in batch.column(1)]
            counts = [[sum(s[1] == k for s in base) for base, _ in found] for k in range(4)]
            hashes = [hashlib.sha256(_listed(base).encode()).hexdigest() for base, _ in found]
            spans = [_listed(base + more) for base, more in found]
            texts = [pa.array(hashes, pa.string()), pa.array(spans, pa.string())]
            arrays = [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), *texts]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    source = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return source.mapInArrow(run, f"doc_id {kind}, {counts}, base_sha256 string, spans string")


def redacted(text: str | None) -> str | None:
    """text with every span replaced by its kind in brackets; spans that overlap are replaced as one."""
    base, more = find_spans(text)
    out, done, last = [], 0, -1
    for start, kind, end in sorted(base + more):
        if start >= last:
            out += [text[done:start], f"[{KINDS[kind].upper()}]"]
        done = last = max(last, end)
    return "".join(out) + text[done:] if out else text


def redact(docs: DataFrame, *, text_column: str = "text") -> DataFrame:
    """docs with the personal data in its texts replaced; a column n_chars follows the new text."""
    names = docs.columns
    place = names.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean = [redacted(t.as_py()) for t in batch.column(place)]
            columns = [pa.array(clean, pa.string()) if i == place else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, names)

    out = docs.mapInArrow(run, docs.schema)
    return out.withColumn("n_chars", F.char_length(text_column).cast("long")) if "n_chars" in names else out
