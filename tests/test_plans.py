import pytest

from broadsheet.plans import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["agg13_daily_association", "agg14_window_profile", "agg15_frame_intensity", "agg23_frame_audit", "win07_top_collocates", "top02_directory"])
def test_texts_are_scanned_once(spark, name):
    """The counts are stored from one scan; what is left of the query reads only them."""
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "documents.parquet" not in plan and "collocat" in plan


def test_explained_profiles_are_made_once(spark):
    """Mentions, snippets and claims are joined with stored rows; none of them makes the profiles again."""
    from broadsheet.plans import QUERIES

    files = QUERIES["ml12_explanations"](spark, "/root/testdata/sf0.001").inputFiles()
    assert any("explained-profiles" in f for f in files) and not any("collocation-counts" in f for f in files)


def test_all_entities_are_explained(spark):
    """Every profile of the country, each with all texts that name it as candidates, against plain Python."""
    import re
    from collections import defaultdict

    from broadsheet.operators import collocations
    from broadsheet.sources import tables

    larger = "/root/testdata/sf0.01"
    a = tables.articles(spark, larger).filter("country_code = 'UK'")
    profiles = collocations.profiles(collocations.daily_counts(collocations.token_windows(a)), "2024-01-30", (30,)).collect()
    texts = sorted((r.collected_date, r.id, r.text or "") for r in a.collect())  # oldest first, as ties are ranked
    naming = defaultdict(list)
    for _, _, t in texts:
        for w in {w for w in re.findall(r"\w+", t) if len(w) >= 4 and w[0].isupper() and w[1:].isalpha() and w[1:].islower()}:
            naming[w].append(t.lower())
    want = set()
    for p in profiles:
        lemmas = [c["lemma"] for c in p.top_collocates]
        chosen = sorted(([x for x in lemmas[:15] if x in t] for t in naming[p.canonical]), key=lambda m: -len(m))[:8]
        for i, x in enumerate(lemmas[:3]):
            if cited := [f"S{k}" for k, m in enumerate(chosen, 1) if x in m]:
                want.add((p.canonical, i, x, ",".join(cited)))
    got = QUERIES["ml12_explanations"](spark, larger).select("canonical", "position", "lemma", "citations").collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    assert len({r.canonical for r in got}) > 10 and max(map(len, naming.values())) > 40


def test_counts_are_added_up_over_small_splits(spark):
    """A task that adds up pairs reads at most 16 MB of files, or less where the session asks for less."""
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    try:
        for given, want in (("128m", 16 << 20), ("4m", 4 << 20)):
            spark.conf.set(key, given)
            QUERIES["agg12_collocation_counts"](spark, SF)
            now = spark.conf.get(key)
            assert (int(now) if now.isdigit() else int(now[:-1]) << 20) == want
    finally:
        spark.conf.set(key, before)
