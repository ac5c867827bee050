"""Language identification by compression: the smallest output under per-language Zstandard raw-content dictionaries."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.common import over_text, small_batches
from broadsheet.llm.features import longest, sampled

UNKNOWN = "und"
#: What each language's dictionary is built from: at most so many documents of the labelled rows, of at most so many bytes
#: together, which fill a dictionary of so many bytes; and how many languages the driver and the workers can hold.
DOCS_PER_LANGUAGE, SAMPLE_BYTES, DICTIONARY_BYTES, MAX_LANGUAGES = 200, 4 << 20, 48 << 10, 500
#: A document that does not fit whole gives so many pieces, or fewer of at least so many bytes.
PIECES, LEAST_PIECE = 4, 60
#: Characters that are compressed as one frame, so that the dictionary counts along the whole text.
FRAME_CHARS = 1024
#: Of pieces of 20 characters level 12 tells 0.97 rightly, levels 3, 6 and 9 at most 0.91; of whole texts 0.998 against 0.997.
LEVEL = 12
#: A text is rejected if the best language saves less than this share of the second's size.
MARGIN = 0.002
#: Weight of a byte of difference in the score.
BYTE_WEIGHT = 0.5

_GAPS = re.compile(r"[\W\d_]+")


def letters(text: str | None) -> str:
    """Lower-case words with single spaces; without letters, the empty text."""
    out = _GAPS.sub(" ", (text or "").lower()).strip()
    return out if any(c.isalpha() for c in out[:64]) or any(c.isalpha() for c in out) else ""


@dataclass
class LanguageModel:
    """One raw-content dictionary a language."""

    dictionaries: dict[str, bytes]
    prior: dict[str, int] | None = None
    level: int = LEVEL
    frame_chars: int = FRAME_CHARS
    margin: float = MARGIN

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_coders"}

    def coders(self):
        if not hasattr(self, "_coders"):
            self._coders = []
            for _, data in sorted(self.dictionaries.items()):
                d = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                d.precompute_compress(level=self.level)
                self._coders.append(zstandard.ZstdCompressor(dict_data=d, level=self.level, write_content_size=False, write_dict_id=False))
        return self._coders

    def sizes(self, text: str) -> np.ndarray:
        """Compressed bytes of the whole text under each language, frame by frame."""
        out = np.zeros(len(self.dictionaries), np.int64)
        # The end of a frame meets the dictionary like its start: a leading space marks a word's begin.
        parts = [f" {text[i : i + self.frame_chars]} ".encode("utf-8", "replace") for i in range(0, len(text), self.frame_chars)]
        for k, coder in enumerate(self.coders()):
            out[k] = sum(len(coder.compress(p)) for p in parts)
        return out

    def predict(self, text: str | None) -> tuple[str, float, float, bool]:
        """(language, score, margin, accepted); ties go to the language with most training rows, then to the first by name."""
        plain = letters(text)
        if not plain or not self.dictionaries:
            return UNKNOWN, 0.0, 0.0, False
        names, seen = sorted(self.dictionaries), self.prior or {}
        if len(names) == 1:
            return names[0], 1.0, 1.0, True
        s = self.sizes(plain)
        best, second = np.lexsort((np.arange(len(s)), [-seen.get(n, 0) for n in names], s))[:2]
        margin = float(s[second] - s[best]) / float(s[second])
        score = float(1.0 / np.exp(-BYTE_WEIGHT * np.minimum(s - s[best], 1000)).sum())
        return names[best], score, margin, margin >= self.margin


def train(docs: DataFrame, rows: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", docs_per_language: int = DOCS_PER_LANGUAGE, dictionary_bytes: int = DICTIONARY_BYTES, sample_bytes: int = SAMPLE_BYTES) -> LanguageModel:
    """Dictionaries from the labelled rows that `rows` selects: for each language the documents with the lowest hashed ids.

    The sample is bounded by docs_per_language documents and sample_bytes bytes for each of at most MAX_LANGUAGES languages
    (more are an error); of equal ids or texts one counts, documents that the bytes have no room for are passed over, and
    rows with null ids, texts or languages are not learned from. Sampled documents come whole to the driver; the dictionary
    takes the same number of bytes of each, from evenly spaced places, or all that it has, so that all fit.
    """
    lang = docs[lang_col].cast("string")
    labelled = docs.filter(rows & docs[id_col].isNotNull() & lang.isNotNull() & docs[text_col].isNotNull())
    keys = longest(labelled, id_col, text_col, lang.alias("_y"))
    counted = labelled.groupBy(lang.alias("lang")).count().orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    if len(counted) > MAX_LANGUAGES:
        raise ValueError(f"over {MAX_LANGUAGES} languages")
    prior = {r.lang: r["count"] for r in counted}
    if not prior:
        return LanguageModel({})
    by: dict[str, list[str]] = {}
    for name, text in sampled(keys, labelled, dict.fromkeys(sorted(prior), docs_per_language), sample_bytes, id_col, text_col):
        by.setdefault(name, []).append(letters(text))
    by = {lang: found for lang, texts in by.items() if (found := list(dict.fromkeys(t for t in texts if t)))}
    # about equal sizes, so that no language gains by a longer dictionary
    size = min((sum(len(t.encode("utf-8", "replace")) + 1 for t in texts) for texts in by.values()), default=0)
    size = min(dictionary_bytes, max(size, dictionary_bytes // 4))
    return LanguageModel({lang: dictionary(texts, size) for lang, texts in by.items()}, prior)


def excerpt(text: str, size: int) -> bytes:
    """At most `size` bytes of a text: all of it, or pieces from evenly spaced places."""
    data = text.encode("utf-8", "replace")
    if len(data) <= size:
        return data
    n = max(1, min(PIECES, size // LEAST_PIECE))
    part = max(1, size // n - 1)
    starts = [round((len(data) - part) * (k + 0.5) / n) if n == 1 else round((len(data) - part) * k / (n - 1)) for k in range(n)]
    return b" ".join(data[s : s + part].decode("utf-8", "ignore").encode() for s in starts)


def dictionary(texts: list[str], size: int) -> bytes:
    """At most `size` bytes in which every text has a part: short texts whole, the others as many bytes each as are left."""
    left, share = size, 0
    lengths = sorted(len(t.encode("utf-8", "replace")) + 1 for t in texts)
    for i, n in enumerate(lengths):
        share = left // (len(lengths) - i)
        if n > share:
            break
        left -= n
    else:
        share = lengths[-1]
    return b" ".join(excerpt(t, max(1, share - 1)) for t in texts)[-size:]


OUT = "lang_pred string, score double, margin double, accepted boolean"


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text", also: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of docs: id, lang_pred, score, margin, accepted, from the whole text.

    Null texts and texts without letters are `und` with score 0 and not accepted; a narrow margin is not accepted either.
    Columns in `also` go through. Nothing is shuffled. An empty table gives no rows. Other columns are not read.
    """

    def rows_of(batch):
        got = [model.predict(t) for t in batch]
        kinds = (pa.string(), pa.float64(), pa.float64(), pa.bool_())
        return {n: pa.array([g[i] for g in got], k) for i, (n, k) in enumerate(zip((x.split()[0] for x in OUT.split(", ")), kinds, strict=True))}

    return over_text(docs, [id_col, *also], text_col, OUT, rows_of)


def accepted_rows(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """The rows of docs whose language is accepted, with all their columns; null and empty texts go. Each row of repeated
    ids is judged by its own text. An empty table gives no rows."""
    small_batches(docs.sparkSession)
    spare = "_accepted"
    while spare in docs.columns:
        spare += "_"

    @F.pandas_udf("boolean")
    def accepted(column: pd.Series) -> pd.Series:
        return column.map(lambda t: model.predict(t)[3]).astype(bool)

    return docs.withColumn(spare, accepted(F.col(text_col).cast("string"))).filter(spare).drop(spare)
