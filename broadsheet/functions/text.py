"""Texts: cleaning, joining, tokens with offsets, stems, snippets."""

from __future__ import annotations

import html
import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: White space that cleaning collapses (a no-break space stays), and lengths of texts for each use.
WHITE_SPACE = "[ \\t\\r\\n]+"
BODY_CHARS = {"sentiment": 800, "clustering": 1800, "embedding": 1800, "ner": 3000}
MIN_CHARS = 10
SNIPPET_CHARS = 320

#: Turkish endings in the order in which they are tried, and what must be left.
TURKISH_ENDINGS = (
    "lerimizden", "larımızdan", "lerinizden", "larınızdan",
    "lerinden", "larından", "leriyle", "larıyla",
    "lerine", "larına", "lerini", "larını",
    "leriniz", "larınız", "lerimiz", "larımız",
    "lerin", "ların", "lerde", "larda",
    "leri", "ları", "lere", "lara",
    "ler", "lar",
    "den", "dan", "ten", "tan",
    "nin", "nın", "nun", "nün",
    "yle", "yla",
    "de", "da", "te", "ta",
    "ye", "ya", "ne", "na",
)
TURKISH_STEM = 3


def clean(text: Column) -> Column:
    """White space collapsed and cut at both ends; null is empty."""
    return F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), WHITE_SPACE, " "), "^ | $", "")


class _Text(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []

    def handle_data(self, data):
        self.parts.append(data)


def plain_text(markup: str | None) -> str:
    """Text nodes joined by a space; without a `<`, the text as it is."""
    if not markup or "<" not in markup:
        return markup or ""
    parser = _Text()
    parser.feed(markup)
    parser.close()
    return " ".join(parser.parts)


@F.pandas_udf(T.StringType())
def strip_markup(markup: pd.Series) -> pd.Series:
    return markup.map(lambda x: re.sub(WHITE_SPACE, " ", plain_text(x)).strip(" \t\r\n"))


@F.pandas_udf(T.StringType())
def unescaped(text: pd.Series) -> pd.Series:
    return text.map(lambda x: html.unescape(x) if x is not None else None)


def analysis_text(title: Column, summary: Column, body: Column, chars: int) -> Column:
    """title. summary. start of the body; empty parts are left out."""
    part = lambda c: F.nullif(F.trim(F.coalesce(c, F.lit(""))), F.lit(""))
    return F.concat_ws(". ", part(title), part(summary), part(F.left(F.trim(F.coalesce(body, F.lit(""))), F.lit(chars))))


def pieces(text: Column) -> Column:
    """A text as an array of word and gap pieces whose concatenation is the text."""
    return F.regexp_extract_all(text, F.lit(r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_]+"), F.lit(0))


def turkish_stem(word: Column) -> Column:
    """Lower-case word without the first of the endings that fits and leaves TURKISH_STEM letters."""
    low = F.lower(word)
    out = low
    for ending in reversed(TURKISH_ENDINGS):
        n = len(ending)
        out = F.when(low.endswith(ending) & (F.length(low) - n >= TURKISH_STEM), F.substring(low, F.lit(1), F.length(low) - n)).otherwise(out)
    return out


def snippet(text: Column, focus: Column, chars: int = SNIPPET_CHARS) -> Column:
    """The whole of a short text, else a window around the first place of `focus`, cut at spaces and marked by an ellipsis."""
    half = chars // 2
    at = F.when(F.coalesce(focus, F.lit("")) == "", 0).otherwise(F.instr(F.lower(text), F.lower(focus)))
    cut_tail = lambda c: F.when(F.instr(c, " ") > 0, F.regexp_replace(c, " [^ ]*$", "")).otherwise(c)
    head = F.concat(cut_tail(F.left(text, F.lit(chars))), F.lit("…"))
    begin = F.greatest(F.lit(0), at - 1 - half)
    end = F.least(F.length(text), at - 1 + half)
    window = F.substring(text, begin + 1, end - begin)
    window = F.when(begin > 0, F.concat(F.lit("…"), F.when(F.instr(window, " ") > 0, F.regexp_replace(window, "^[^ ]* ", "")).otherwise(window))).otherwise(window)
    window = F.when(end < F.length(text), F.concat(cut_tail(window), F.lit("…"))).otherwise(window)
    return F.when(F.length(text) <= chars, text).when(at < 1, head).otherwise(F.trim(window))


def has_cue(text: Column, cues: list[str]) -> Column:
    """Whether a text holds a cue at the start of a word, with any ending; a cue with = in front must be a whole word."""
    word = r"[\p{L}\p{N}_]"
    whole = [re.escape(c[1:]) for c in cues if c.startswith("=")]
    stems = [re.escape(c) for c in cues if not c.startswith("=")]
    parts = [*([f"(?:{'|'.join(stems)})"] if stems else []), *([f"(?:{'|'.join(whole)})(?!{word})"] if whole else [])]
    return text.rlike(f"(?<!{word})(?:{'|'.join(parts)})") if parts else F.lit(False)
