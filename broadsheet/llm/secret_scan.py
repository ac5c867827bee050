"""Secret scans: fixed patterns, and sliding-window Shannon entropy per character class over candidate strings."""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from broadsheet.llm.common import over_text

#: Fixed patterns; the order of kinds is the order of spans that begin together.
ASSIGN = re.compile(
    r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN_VALUE = 12
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
#: Runs that can hold an access or hex match or a window of any class.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")


@dataclass(frozen=True)
class CharClass:
    """Windows of `width` characters of a class are random if their entropy is at least `bits` a character.

    `shorter` has further windows (width, bits); a span that only they find is dropped if its text fits PLAIN.
    """

    kind: str
    run: re.Pattern
    width: int
    bits: float
    shorter: tuple[tuple[int, float], ...] = ()


#: The shorter windows find at least 99.7 % of random base64 strings of their width or more.
CLASSES = (
    CharClass("entropy_hex", re.compile(r"[0-9A-Fa-f]{24,}"), 24, 3.0),
    CharClass("entropy_base64", re.compile(r"[A-Za-z0-9+/_=-]{16,}"), 32, 4.1, ((16, 3.2), (20, 3.5), (24, 3.75))),
)
#: Cut out of runs before windows slide over what is left: UUIDs, digits and the alphabet in order.
CUT = re.compile(
    r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}|0123456789|(?i:abcdefghijklm(?:n(?:o(?:p(?:q(?:r(?:s(?:t(?:u(?:v(?:w(?:x(?:yz?)?)?)?)?)?)?)?)?)?)?)?)?)"
)
#: Words joined by - or _ or / or = or +, of which a window may cut the outer two, with some numbers of up to four digits
#: among them, as in dates and names of pages. No repeat can match a text in two ways, so matching is linear in the span.
_WORD = r"(?:[A-Z]?[a-z]{1,20}+[0-9]{0,2}+|[0-9]{1,4}+|[A-Z]{1,6}+)"
_JOINED = re.compile(rf"[A-Z]?[a-z]{{0,20}}+[0-9]{{0,4}}+(?:[-_/=+]++{_WORD}?+)++")


class JoinedWords:
    """Spans that are words joined by separators; most parts are words, and numbers are few beside them."""

    def fullmatch(self, text: str, begin: int, end: int) -> bool:
        if not _JOINED.fullmatch(text, begin, end):
            return False
        parts = _SEPARATORS.split(text[begin:end])
        numbers = sum(p.isdigit() for p in parts)
        letters = sum(c.isalpha() for p in parts for c in p)
        return letters >= 0.45 * (end - begin) and numbers <= max(3, len(parts) // 3) and all(_spoken(p) for p in parts[1:-1])


_SEPARATORS = re.compile(r"[-_/=+]+")


def _spoken(part: str) -> bool:
    """Whether a part is short, or a number, or has a vowel among its letters, as words have."""
    return len(part) < 4 or part.isdigit() or any(c in "aeiouyAEIOUY" for c in part)


#: Spans whose text fits one of these are not reported.
ALLOW = (JoinedWords(),)
#: What short windows of ordinary text look like: lower-case hex (a kind of its own), and joined words, capitals and numbers.
_PART = r"(?:[A-Z]++(?![a-z])|[a-z]*+(?:[A-Z][a-z]++)*+[A-Z]?+)[0-9]*+"
PLAIN = re.compile(rf"[0-9a-f]++|{_PART}(?:[-_/=+]++{_PART})*+")


def pieces(text: str, cut: re.Pattern) -> Iterator[tuple[int, str]]:
    """(start, text) of what is left of a run without the matches of `cut`."""
    at = 0
    for m in cut.finditer(text):
        yield at, text[at : m.start()]
        at = m.end()
    yield at, text[at:]


def random_spans(text: str, kind: CharClass, cut: re.Pattern, allow: tuple[re.Pattern, ...]) -> list[tuple[int, int]]:
    """Merged spans of a run that windows of any width find."""
    found = []
    for at, part in pieces(text, cut):
        spans = [(a, b, False) for a, b in windows(part, kind.width, kind.bits)]
        spans += [(a, b, True) for width, bits in kind.shorter for a, b in windows(part, width, bits)]
        for a, b, short in spans:
            if not any(p.fullmatch(part, a, b) for p in allow) and not (short and PLAIN.fullmatch(part, a, b)):
                found.append((at + a, at + b))
    out: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def windows(text: str, width: int, bits: float) -> Iterator[tuple[int, int]]:
    """Spans (start, end) of merged windows whose entropy is at least `bits`.

    Entropy is log2(width) minus the mean of log2 of counts; one character leaves and one enters at each step, so only two
    counts change.
    """
    n = len(text)
    if n < width:
        return
    term = [0.0, *(c * math.log2(c) for c in range(1, width + 1))]
    counts: dict[str, int] = {}
    total = 0.0
    limit = (math.log2(width) - bits) * width + 1e-9
    start = end = -1
    for i, c in enumerate(text):
        k = counts.get(c, 0)
        total += term[k + 1] - term[k]
        counts[c] = k + 1
        if i >= width:
            gone = text[i - width]
            k = counts[gone]
            total += term[k - 1] - term[k]
            counts[gone] = k - 1
        if i >= width - 1 and total <= limit:
            at = i - width + 1
            if at > end and end >= 0:
                yield start, end
                start = at
            elif end < 0:
                start = at
            end = i + 1
    if end >= 0:
        yield start, end


def scan(text: str, classes: tuple[CharClass, ...] = CLASSES, allow: tuple[re.Pattern, ...] = ALLOW, cut: re.Pattern = CUT) -> list[tuple[int, int, int, str]]:
    """(start, order of kind, end, kind) of every span, sorted; orders 0 to 2 are assign, access and hex."""
    spans = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        spans += [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_VALUE]
    for c in CANDIDATE.finditer(text):
        at, s = c.start(), c[0]
        spans += [(at + m.start(), 1, at + m.end(), "access") for m in ACCESS.finditer(s)]
        spans += [(at + m.start(), 2, at + m.end(), "hex") for m in HEX.finditer(s)]
        for k, kind in enumerate(classes):
            for m in kind.run.finditer(s):
                spans += [(at + m.start() + a, 3 + k, at + m.start() + b, kind.kind) for a, b in random_spans(m[0], kind, cut, allow)]
    return sorted(spans)


def joined(spans) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in spans)


OUT = "n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", classes: tuple[CharClass, ...] = CLASSES, allow: tuple[re.Pattern, ...] = ALLOW, cut: re.Pattern = CUT) -> DataFrame:
    """One row per row of docs: id, counts of the base kinds, digest of the base spans, and all spans.

    Spans are whole matches in code points, end exclusive, sorted by start, then kind. Whole texts are scanned; null is
    empty, which has no spans. Entropy kinds are added to the base kinds and never replace them. Nothing is shuffled. An
    empty table gives no rows. Other columns of docs are not read.
    """

    def rows_of(batch):
        found = [scan(t, classes, allow, cut) for t in batch]
        base = [[s for s in spans if s[1] < 3] for spans in found]
        return {
            **{n: pa.array([sum(s[1] == k for s in spans) for spans in base], pa.int64()) for k, n in enumerate(("n_assign", "n_access", "n_hex"))},
            "base_sha256": pa.array([hashlib.sha256(joined(s).encode()).hexdigest() for s in base], pa.string()),
            "spans": pa.array([joined(s) for s in found], pa.string()),
        }

    return over_text(docs, [id_col], text_col, OUT, rows_of)
