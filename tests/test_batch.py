import json

from pyspark.sql import functions as F

from broadsheet.operators import news
from broadsheet.plans.batch import DailyJob
from broadsheet.sources import reviews
from broadsheet.sources.store import SliceStore


def items(spark, *rows):
    return spark.createDataFrame([(i, t, s, "src", "2024-01-05T08:00:00Z", link, None) for i, t, s, link in rows], "id long, title string, summary string, source_name string, published_date string, link string, category string")


def test_a_day_runs_and_a_repeat_changes_nothing(spark, tmp_path):
    job = DailyJob(spark, str(tmp_path), "UK", "en")
    day1 = items(spark, (1, "Angela said the war is bad. Angela said so.", "and Angela said the war again", "http://a/1"), (2, "short", "", "http://a/2"), (3, "The great win of the record team", "", None), (4, "The same link", "again and again", "http://a/1"))
    for _ in range(2):
        assert set(job.run(day1, "2024-01-05", "2024-01-05 12:00:00").values()) == {"ok"}
        assert sorted(r.id for r in job.rows("news_raw").collect()) == [1, 2, 3]
        assert {r.id: r.sentiment_label for r in job.rows("news_scored", "2024-01-05").collect()} == {1: "negative", 3: "positive"}
        assert job.rows("mentions").filter("canonical = 'Angela'").count() == 3
        assert job.rows("collocations").filter("canonical = 'Angela' and lemma = 'said'").first().c11 >= 2
        assert job.rows("drift").first().status == "insufficient_data"
    job.run(items(spark, (9, "Another story of the day", "with text", "http://a/1"), (10, "A new story of the day", "with text", "http://a/9")), "2024-01-06", "2024-01-06 12:00:00")
    assert sorted(r.id for r in job.rows("news_raw", "2024-01-06").collect()) == [10]
    assert job.backfill(lambda d: items(spark, (20, "Backfilled story of the day", "x", None)), ["2024-01-05", "2024-01-07"], "2024-01-07 12:00:00") == {"2024-01-07": "ok"}


def test_bodies_and_types_reach_the_later_steps(spark, tmp_path):
    body = "<p>" + "Berlin said that the great win of the record team made Berlin proud again. " * 5 + "</p>"
    landed = spark.createDataFrame([(1, "http://a/1#top", f"<html><body><article>{body}</article></body></html>")], "page_id long, url string, html string")
    aliases = spark.createDataFrame([("UK", "LOC", "Berlin", "Berlin", "Q64", 0)], "country_code string, entity_type string, alias string, canonical string, wikidata_qid string, ordinal long")
    job = DailyJob(spark, str(tmp_path), "UK", "en", aliases=aliases, pages=landed)
    assert set(job.run(items(spark, (1, "A story of the day", "and more", "http://a/1?utm_source=x"), (2, "Another story here", "", "http://a/2")), "2024-01-05", "2024-01-05 12:00:00").values()) == {"ok"}
    assert {r.id: r.parse_status for r in job.rows("news_articles").collect()} == {1: "parsed", 2: "fetch_error"}
    assert job.rows("news_scored").filter("id = 1").first().sentiment_label == "positive"
    assert {(r.entity_type, r.wikidata_qid) for r in job.rows("mentions").filter("canonical = 'Berlin'").collect()} == {("LOC", "Q64")}
    assert job.rows("collocations").filter("canonical = 'Berlin' and lemma = 'said'").count() == 1


def test_a_day_that_failed_on_its_way_is_done_again(spark, tmp_path):
    job = DailyJob(spark, str(tmp_path), "UK", "en")
    one = items(spark, (1, "A story of the day", "and more", None))
    job._collect(one, "2024-01-05")  # and then the driver was lost
    assert job.backfill(lambda d: one, ["2024-01-05"], "2024-01-06 12:00:00") == {"2024-01-05": "ok"}
    assert job.rows("news_scored").count() == 1


def test_a_soft_step_that_failed_is_repaired(spark, tmp_path, monkeypatch):
    job = DailyJob(spark, str(tmp_path), "UK", "en")
    one = items(spark, (1, "Angela said the war is bad. Angela said so.", "and Angela said the war again", None))

    def broken(day):
        raise RuntimeError("no tagger")

    with monkeypatch.context() as m:
        m.setattr(job, "_mentions", broken)
        assert job.backfill(lambda d: one, ["2024-01-05"], "2024-01-06 12:00:00") == {"2024-01-05": "mentions: RuntimeError: no tagger"}
    assert job.rows("mentions").count() == 0 and job.rows("drift").count() == 1
    assert job.backfill(lambda d: one, ["2024-01-05"], "2024-01-06 12:00:00") == {"2024-01-05": "ok"}
    assert job.rows("mentions").filter("canonical = 'Angela'").count() == 3
    assert job.backfill(lambda d: one, ["2024-01-05"], "2024-01-06 12:00:00") == {}


def test_a_slice_left_aside_is_put_back(spark, tmp_path):
    held = SliceStore(spark, str(tmp_path / "t"))
    rows = spark.createDataFrame([(1, "DE", "2024-01-05"), (2, "FR", "2024-01-05")], "id long, country_code string, collected_date string").withColumn("collected_date", F.to_date("collected_date"))
    held.replace(rows, [{"country_code": c, "collected_date": "2024-01-05"} for c in ("DE", "FR")])
    (tmp_path / "t/_aside/country_code=DE").mkdir(parents=True)
    (tmp_path / "t/country_code=DE/collected_date=2024-01-05").rename(tmp_path / "t/_aside/country_code=DE/collected_date=2024-01-05")
    kind = "id long, country_code string, collected_date date"
    assert sorted(r.id for r in held.rows(kind).collect()) == [1, 2]
    held.replace(rows.limit(0), [{"country_code": "DE", "collected_date": "2024-01-05"}])
    assert [r.id for r in held.rows(kind).collect()] == [2]


def test_reviews(spark, tmp_path):
    sample = spark.createDataFrame([(1, "positive", "negative", 'a "quoted", text'), (2, "positive", "", "x"), (3, "neutral", "neutral", "y")], "id int, predicted string, reviewed string, title string")
    reviews.write_reviews(sample, str(tmp_path / "csv"), ["id", "predicted", "reviewed", "title"])
    got = reviews.reviewed_rows(spark, str(tmp_path / "csv"), "predicted", "reviewed").collect()
    assert {r.id for r in got} == {"1", "3"} and got[0].title == 'a "quoted", text'
    (tmp_path / "gold.jsonl").write_text('{"text": "a", "label": 2}\n{"text": " ", "label": 1}\n{"text": "b", "label": 9}\n')
    assert reviews.gold_rows(spark, str(tmp_path / "gold.jsonl")).count() == 1
    (tmp_path / "eval.json").write_text(json.dumps({"items": [{"id": "1", "human_label": "positive"}, {"id": "2", "human_label": "?"}]}))
    assert reviews.human_evaluation(spark, str(tmp_path / "eval.json"), sample.select(F.col("id").cast("string").alias("id"), "title")).count() == 1
    for name in ("source_health_1.json", "source_health_2.json"):
        (tmp_path / name).write_text(json.dumps({"n": int(name[14])}))
    assert reviews.latest(spark, str(tmp_path)).first().n == 2
    assert [tuple(r) for r in reviews.metrics("score", sample, rows=F.count(F.lit(1))).collect()] == [("score", "rows", 3.0)]


def test_drift_markdown(spark):
    rows = spark.createDataFrame([("DE", f"2024-01-{d:02d}", "positive" if k % 3 else "negative") for d in range(1, 10) for k in range(60)], "country_code string, collected_date string, sentiment_label string").withColumn("collected_date", F.to_date("collected_date"))
    got = {str(r.collected_date): r for r in news.drift(rows).collect()}
    assert "too few" in reviews.drift_markdown(got["2024-01-02"]) and "PSI 0.0000 (stable)" in reviews.drift_markdown(got["2024-01-09"])
