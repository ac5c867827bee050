"""Windows for many end dates against the windows of each end date."""

import re
from datetime import date, timedelta

import numpy as np
import pytest

from broadsheet.operators import collocations, rolling


@pytest.fixture(scope="module")
def counts(spark):
    r = np.random.default_rng(8)
    rows = {(str(r.choice(["DE", "UK"])), date(2024, 1, 1) + timedelta(days=int(r.choice([0, 1, 2, 5, 6, 20, 21, 22]))), f"E{int(r.integers(0, 4))}", f"w{int(r.integers(0, 6))}"): int(r.integers(2, 9)) for _ in range(160)}
    frame = spark.createDataFrame([(*k, v) for k, v in rows.items()], "country_code string, collected_date date, canonical string, lemma string, c11 long")
    return frame.cache()


def test_equals_the_windows_of_each_date(counts):
    first, last = date(2023, 12, 30), date(2024, 2, 3)
    keys = ["country_code", "window_days", "canonical"]
    got = {}
    for x in rolling.profiles(counts, first, last, (1, 7, 10), k=3).collect():
        got[(x.end_date, *[x[k] for k in keys])] = x
    seen = 0
    for end in (first, date(2024, 1, 1), date(2024, 1, 4), date(2024, 1, 11), date(2024, 1, 16), last):
        want = collocations.profiles(counts, end.isoformat(), (1, 7, 10), k=3).collect()
        assert sorted(k[1:] for k in got if k[0] == end) == sorted(tuple(x[k] for k in keys) for x in want)
        for x in want:
            y = got[(end, *[x[k] for k in keys])]
            assert (y.coverage_days, y.total_cooccurrences, y.window_total) == (x.coverage_days, x.total_cooccurrences, x.window_total)
            assert y.avg_pmi == pytest.approx(x.avg_pmi) and y.avg_llr == pytest.approx(x.avg_llr)
            assert [(t.rank, t.lemma, t.c11) for t in y.top_collocates] == [(t.rank, t.lemma, t.c11) for t in x.top_collocates]
            seen += 1
    assert seen > 20 and not any(k[0] < date(2024, 1, 1) for k in got)


def test_edges(spark, counts):
    first, last = date(2024, 1, 1), date(2024, 1, 3)
    odd = counts.union(spark.createDataFrame([(None, first, "E", "w", 5), ("DE", None, "E", "w", 5), ("DE", first, None, "w", 5)], counts.schema)).selectExpr("*", "7 AS end_date", "8 AS window_days", "9 AS steps")
    plain = lambda df: sorted(map(str, df.collect()))
    assert plain(rolling.association(odd, first, last)) == plain(rolling.association(counts, first, last))
    assert rolling.association(counts.limit(0), first, last).collect() == []
    assert rolling.association(counts, date(2030, 1, 1), date(2030, 1, 2)).collect() == []
    with pytest.raises(ValueError, match="before first"):
        rolling.association(counts, last, first)


def test_end_dates_are_laid_out_after_the_last_shuffle(spark, counts):
    """Two steps a daily count and window are shuffled, and no row of an end date is."""
    held = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = rolling.profiles(counts, date(2024, 1, 1), date(2024, 2, 29))._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    above = plan[: plan.index("Generate explode(filter(")]
    assert "Exchange" not in above and len(re.findall("Window ", above)) >= 1


def test_sums_are_made_before_they_meet_the_pairs(spark, counts):
    """Above the joins a pair's own sum alone is made, and rows of an end date are sorted by a long integer first."""
    held = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = rolling.profiles(counts, date(2024, 1, 1), date(2024, 1, 2))._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    laid = plan.index("Generate explode(filter(")
    assert plan[laid : plan.index("SortMergeJoin")].count("aggregate(") == 1
    assert re.search(r"Sort \[_group#\d+L ASC", plan[:laid])
