"""What requests to the interface and steps of the job may ask for, and how their answers are shaped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.functions.urls import CATEGORIES, GENERAL, TOPICAL

WINDOWS = (7, 30)
MOST_RATIONALE = 12


def checked_window(days: int) -> int:
    if days not in WINDOWS:
        raise ValueError(f"window must be one of {WINDOWS}")
    return days


def checked_countries(asked: str, known: set[str]) -> list[str]:
    """Country codes of a comma-separated list, in upper case and each once; an unknown one is an error."""
    out = list(dict.fromkeys(c.strip().upper() for c in asked.split(",") if c.strip()))
    if not out or not set(out) <= known:
        raise ValueError(f"unknown countries: {', '.join(c for c in out if c not in known) or 'none given'}")
    return out


def checked_mode(only_missing: bool = False, only_stale: bool = False, only_with_body: bool = False, limit: int | None = None) -> None:
    """Modes of scoring exclude one another, and a limit is positive."""
    if only_missing + only_stale + only_with_body > 1:
        raise ValueError("modes exclude one another")
    if limit is not None and limit < 1:
        raise ValueError("limit must be positive")


def valid_vocabulary(category: Column, role: Column) -> Column:
    return category.isin(*CATEGORIES) & role.isin(GENERAL, TOPICAL)


def enabled(configs: DataFrame, section: str) -> DataFrame:
    """Countries whose section is enabled; a section that is there without the flag is on, an absent one off.

    configs: country_code, sections, a map from a section to whether it is enabled.
    """
    flag = F.try_element_at("sections", F.lit(section))
    return configs.filter(F.coalesce(F.array_contains(F.map_keys("sections"), section), F.lit(False)) & F.coalesce(flag, F.lit(True))).select("country_code")


def annotations(answers: DataFrame, asked: DataFrame, labels: tuple[str, ...]) -> DataFrame:
    """One row an answer: batch, whether it is usable, and its labels by id.

    answers: batch, answer, a text with an array of {id, label, rationale} somewhere in it. asked: batch, id. An answer is
    usable if its labels are known and its ids are those that were asked, each once; rationales are cut to a few words.
    """
    array = F.regexp_extract("answer", r"(?s)(\[.*\])", 1)
    items = F.from_json(array, "array<struct<id:string,label:string,rationale:string>>")
    rows = answers.select("batch", F.transform(items, lambda i: F.struct(i["id"].alias("id"), i["label"].alias("label"), F.array_join(F.slice(F.split(F.trim(F.coalesce(i["rationale"], F.lit(""))), r"\s+"), 1, MOST_RATIONALE), " ").alias("rationale"))).alias("items"))
    want = asked.groupBy("batch").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    got = F.array_sort(F.col("items.id"))
    known = F.forall("items", lambda i: F.coalesce(i["label"].isin(*labels), F.lit(False)))
    return rows.join(want, "batch").select("batch", F.coalesce((got == F.col("ids")) & known, F.lit(False)).alias("usable"), "items")


def still_to_do(asked: DataFrame, done: DataFrame, key: str = "id") -> DataFrame:
    """What a run that is taken up again has left: rows without a stored answer."""
    return asked.join(done.select(key), key, "left_anti")


def served(profiles: DataFrame) -> DataFrame:
    """Profiles as they are sent: days as text, absent arrays empty."""
    shape = {"date": lambda c: F.date_format(c, "yyyy-MM-dd"), "array": lambda c: F.coalesce(c, F.array())}
    return profiles.select(*[shape.get(f.dataType.typeName(), lambda c: c)(F.col(f.name)).alias(f.name) for f in profiles.schema.fields])
