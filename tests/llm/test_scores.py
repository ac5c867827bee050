import pytest

from broadsheet.llm import quality, toxicity

SF = "/root/testdata/sf0.001"
ODD = [(1, None), (1, ""), (2, "same text"), (2, "same text"), (3, "x" * 300_000), (None, "no id"), (4, "日本語 \x00 \t")]


@pytest.mark.parametrize("module", [toxicity, quality])
def test_every_row_is_scored_by_its_own_text(spark, module):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = module.train(docs, labels, lambda c: c >= 0)
    odd = spark.createDataFrame([(i, t, "s", 7) for i, t in ODD], "doc_id long, text string, score string, predicted int")
    got = module.score(odd, model).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in ODD)
    assert all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2)}) <= 2  # equal texts, equal scores
    assert module.score(odd.limit(0), model).count() == 0
    nothing = module.train(docs.limit(0), labels, lambda c: c >= 0)
    assert module.score(odd, nothing).count() == len(ODD)
