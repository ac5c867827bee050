"""Entity names: normal form, display form, candidate scores."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Titles that are cut from the front of a name, the longest first.
TITLES = (
    "cumhurbaskani", "baskan", "bakan", "basbakan", "prof", "dr", "sayin",
    "bundeskanzler", "bundeskanzlerin", "kanzler", "kanzlerin", "prasident",
    "president", "prime minister", "minister", "chancellor", "senator", "mr", "mrs", "ms",
)
#: Descriptions of pages that stand for a name and not for an entity.
NAME_PAGES = (
    "apellido", "cognome", "surname", "family name", "nazwisko", "nachname", "nom de famille",
    "page d homonymie", "pagina di disambiguazione", "disambiguation", "disambiguacion", "begriffsklarung",
)
#: Weights of a candidate's score, added in this order.
NAME_WEIGHT, PART_WEIGHT, TYPE_WEIGHT, COUNTRY_WEIGHT, ID_WEIGHT = 0.55, 0.35, 0.15, 0.10, 0.05

_TITLE = re.compile("(?:" + "|".join(sorted(TITLES, key=len, reverse=True)) + ")(?: +|$)")


def normal_name(text: str | None) -> str:
    """Without accents, case, punctuation and titles in front; a name that is only titles is empty."""
    folded = "".join(c for c in unicodedata.normalize("NFKD", text or "") if not unicodedata.combining(c))
    folded = folded.casefold().replace("ı", "i")
    out = re.sub(r"\s+", " ", re.sub(r"[^\w\s]", " ", folded)).strip()
    while m := _TITLE.match(out):
        out = out[m.end() :].strip()
    return out


@F.pandas_udf(T.StringType())
def normal_names(text: pd.Series) -> pd.Series:
    return text.map(normal_name)


def display_name(text: Column) -> Column:
    """Words of at most three ASCII letters in upper case, other words capitalized."""
    words = F.filter(F.split(F.trim(F.coalesce(text, F.lit(""))), "\\s+"), lambda w: w != "")
    shown = F.transform(words, lambda w: F.when(w.rlike("^[\\x00-\\x7F]{1,3}$"), F.upper(w)).otherwise(F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, F.lit(2), F.length(w))))))
    return F.array_join(shown, " ")


def candidate_score(text: Column, label: Column, aliases: Column, description: Column, type_words: Column, country_terms: Column, qid: Column) -> Column:
    """Score of a knowledge-base candidate; all names are in normal form, nulls are empty."""
    text, label, description = (F.coalesce(c, F.lit("")) for c in (text, label, description))
    inside = lambda words: F.exists(F.coalesce(words, F.array().cast("array<string>")), lambda w: (w != "") & description.contains(w))
    page = F.lit(False)
    for stem in NAME_PAGES:
        page = page | description.contains(stem)
    name = (
        F.when(label == text, NAME_WEIGHT)
        .when(F.array_contains(F.coalesce(aliases, F.array().cast("array<string>")), text), NAME_WEIGHT)
        .when((label != "") & (text.contains(label) | label.contains(text)), PART_WEIGHT)
        .otherwise(0.0)
    )
    score = name + F.when(inside(type_words), TYPE_WEIGHT).otherwise(0.0) + F.when(inside(country_terms), COUNTRY_WEIGHT).otherwise(0.0) + F.when(F.coalesce(qid, F.lit("")) != "", ID_WEIGHT).otherwise(0.0)
    return F.when(page, 0.0).otherwise(F.least(F.lit(1.0), score))
