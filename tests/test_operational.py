import datetime as dt

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import operational as op
from corpusloom.operators import stats
from corpusloom.sources import sinks


def at(minute, second=0):
    return dt.datetime(2024, 1, 1, 0, minute, second)


def test_stage_metrics(spark):
    rows = [("a", at(1), 1, 2.0, "success", None), ("a", at(3), 2, 1.0, "failed", "boom"), ("b", at(2), 3, 5.0, "success", None)]
    runs = spark.createDataFrame(rows, "stage string, ts timestamp, run_id long, duration double, status string, error string")
    found = {r["stage"]: r for r in op.stage_metrics(runs).collect()}
    assert (found["a"]["status"], found["a"]["error"], found["a"]["total_duration"]) == ("failed", "boom", 3.0)
    assert (found["b"]["status"], found["b"]["failures"]) == ("success", 0)


def test_requests_and_limits(spark):
    rows = [(at(0, s), 1, s == 0) for s in range(5)] + [(at(1), 1, False), (at(10), 2, True)]
    requests = spark.createDataFrame(rows, "ts timestamp, user_id long, is_error boolean")
    row = op.request_metrics(requests).first()
    assert (row["total_requests"], row["total_errors"], row["uptime_seconds"]) == (7, 2, 600.0)
    assert row["requests_per_second"] == pytest.approx(7 / 600)
    empty = op.request_metrics(requests.limit(0)).first()
    assert (empty["total_requests"], empty["error_rate"], empty["requests_per_second"]) == (0, 0.0, 0.0)
    breaches = op.rate_limit_breaches(requests, 4).collect()
    assert [(r["user_id"], r["requests"]) for r in breaches] == [(1, 5)]


def test_registry(spark):
    rows = [("p1", "latest", at(1)), ("p2", "latest", at(2)), ("p3", "v1", at(0))]
    frame = spark.createDataFrame(rows, "path string, tag string, at timestamp")
    entry = op.registry_entry(F.col("path"), F.col("tag"), F.lit(None).cast("map<string,string>"), F.col("at"))
    registry = frame.select(entry.alias("e")).select("e.*")
    found = {r["version_tag"]: (r["version_id"], r["versions"]) for r in op.registry_latest(registry).collect()}
    assert found == {"latest": ("latest_1704067320", 2), "v1": ("v1_1704067200", 1)}


def test_checkpoints(spark, tmp_path):
    root = str(tmp_path)
    data = spark.range(3)
    for stage in ("b_stage", "a_stage", "b_stage"):
        sinks.save_checkpoint(data, root, "run", stage, {"k": stage})
    sinks.save_checkpoint(spark.range(1), root, "other", "x")
    manifest = sinks.load_manifest(spark, root)
    listed = op.checkpoint_list(manifest, "run").collect()
    assert [(r["stage"], r["saves"]) for r in listed] == [("a_stage", 1), ("b_stage", 2)]
    meta = {r["run_id"]: r for r in op.run_metadata(manifest).collect()}["run"]
    assert (meta["stages_completed"], meta["current_stage"]) == (["b_stage", "a_stage"], "b_stage")
    summary = {r["run_id"]: r["checkpoints_saved"] for r in op.execution_summary(manifest).collect()}
    assert summary == {"run": 2, "other": 1}
    assert sinks.load_checkpoint(spark, root, "run", "a_stage").count() == 3


def collected(spark):
    rows = [
        ("web", "http://a/1", None, "x" * 120, "en", None),
        ("web", "http://b/1", None, "x" * 20000, None, None),
        ("pdf", None, "f.pdf", "y" * 600, None, 4),
        ("pdf", None, "g.pdf", "z", None, 1),
    ]
    return spark.createDataFrame(
        rows, "source_type string, url string, source_path string, content string, language string, page_count long"
    )


def test_collection_statistics(spark, tmp_path):
    docs = collected(spark)
    web = {r["source_type"]: r for r in stats.content_quality(docs).collect()}["web"]
    assert (web["valid_items"], web["short_items"], web["long_items"], web["success_rate"]) == (2, 1, 1, 1.0)
    langs = {r["language"]: r["items"] for r in stats.language_distribution(docs).collect()}
    assert langs == {"en": 1, "unknown": 3}
    summary = stats.collection_summary(docs).first()
    assert (summary["unique_domains"], summary["languages_detected"], summary["total_pages"]) == (2, ["en"], 5)
    distinct = stats.diversity(docs).first()
    assert tuple(distinct) == (3, 4)
    sinks.save_raw(docs, str(tmp_path / "raw"))
    rows, saved = sinks.load_raw(spark, str(tmp_path / "raw"))
    assert rows.count() == 4 and saved.first()["total_sources"] == 4
    report = stats.collection_report(docs).first()
    assert report["validation"]["valid_items"] == 3
    assert report["configuration"]["max_pages_per_source"] == 100


def test_validation_rules(spark):
    good = stats.validation_report(collected(spark)).first()
    assert good["is_valid"] and not good["errors"] and not good["warnings"]
    assert good["recommendations"] == ["Review and optimize data collection configuration"]
    poor = stats.validation_report(collected(spark).filter("source_path = 'g.pdf'")).first()
    assert not poor["is_valid"] and poor["errors"] == ["No valid content items found"]
    assert poor["warnings"] == ["Very low total content volume"]
    rows = collected(spark).filter("url = 'http://a/1'")
    mixed = rows.unionAll(rows.withColumn("content", F.lit("s"))).unionAll(rows.withColumn("content", F.lit("t")))
    assert stats.validation_report(mixed).first()["warnings"][0] == "Low success rate: 1/3 items valid"
    empty = stats.validation_report(rows.limit(0)).first()
    assert (empty["success_rate"], empty["is_valid"]) == (0.0, False)


def test_processed_and_dataset_round_trips(spark, tmp_path):
    chunks = spark.createDataFrame([("web", "a"), ("pdf", "b")], "source_type string, content string")
    sinks.save_processed(chunks, str(tmp_path / "chunks"))
    back = sinks.load_processed(spark, str(tmp_path / "chunks"))
    assert {(r["source_type"], r["content"]) for r in back.collect()} == {("web", "a"), ("pdf", "b")}
    sinks.save_dataset(spark.createDataFrame([(1,)], "a int"), str(tmp_path / "one"))
    sinks.save_dataset(spark.createDataFrame([("x",)], "b string"), str(tmp_path / "two"))
    with open(tmp_path / "two" / "bad.json", "w") as out:
        out.write("{broken\n")
    rows = sinks.load_dataset(spark, str(tmp_path / "one"), str(tmp_path / "two"), schema="a int, b string")
    assert {tuple(r) for r in rows.collect()} == {(1, None), (None, "x")}
    sinks.save_evaluation(chunks, chunks.limit(1), str(tmp_path / "ev"))
    assert sinks.load_evaluation(spark, str(tmp_path / "ev"))[0].count() == 2


def test_summary_parts_merge_without_documents(spark, tmp_path):
    schema = "source_type string, language string, url string, content string, page_count int"
    web = [("web", f"l{i % 7}", f"https://h{i % 300}.example/{i}", "x" * (i % 50), None) for i in range(2000)]
    rows = web + [("pdf", "en", None, "text", 3), ("pdf", None, None, None, None), ("web", "", "", None, 9), ("json", "zz", None, "y", 1)]
    docs = spark.createDataFrame(rows, schema).withColumn("source_path", F.lit(None).cast("string"))
    exact = stats.collection_summary(docs).first()
    assert exact["languages_detected"] == [f"l{i}" for i in range(7)] and exact["unique_domains"] == 300
    assert (exact["total_pages"], exact["pdf_sources_count"], exact["total_sources"]) == (3, 2, 2003)
    for i, batch in enumerate(docs.randomSplit([1.0, 2.0, 1.0], 4)):
        stats.summary_parts(batch).write.parquet(f"{tmp_path}/parts/batch={i}")
    parts = spark.read.parquet(f"{tmp_path}/parts")
    for merged in (parts, stats.merge_parts(parts)):
        got = stats.summary_of_parts(merged).first().asDict()
        assert abs(got.pop("unique_domains") - 300) <= 6
        assert got == {k: v for k, v in exact.asDict().items() if k != "unique_domains"}
    for empty in (docs.limit(0),):
        assert stats.collection_summary(empty).first().asDict() == stats.summary_of_parts(stats.summary_parts(empty)).first().asDict()


def failing(frame):
    """The same rows, the last of which cannot be computed."""
    return frame.unionAll(frame.limit(1).withColumn("content", F.raise_error(F.lit("lost")).cast("string")))


def test_a_write_killed_midway_is_invisible(spark, tmp_path):
    docs, raw, marks, scores = collected(spark), str(tmp_path / "raw"), str(tmp_path / "marks"), str(tmp_path / "ev")
    sinks.save_raw(docs, raw)
    sinks.save_checkpoint(docs, marks, "run", "stage")
    sinks.save_evaluation(docs, docs.limit(1), scores)
    for write in (
        lambda: sinks.save_raw(failing(docs), raw),
        lambda: sinks.save_checkpoint(failing(docs), marks, "run", "stage"),
        lambda: sinks.save_evaluation(docs.limit(2), failing(docs), scores),
    ):
        with pytest.raises(Exception, match="lost"):
            write()
    rows, summary = sinks.load_raw(spark, raw)
    assert rows.count() == 4 and summary.first()["total_sources"] == 4
    assert sinks.load_checkpoint(spark, marks, "run", "stage").count() == 4
    assert [t.count() for t in sinks.load_evaluation(spark, scores)] == [4, 1]
    sinks.save_raw(docs.limit(3), raw)
    assert sinks.load_raw(spark, raw)[0].count() == 3
    with pytest.raises(FileNotFoundError):
        sinks.load_checkpoint(spark, marks, "run", "other")


def test_the_input_of_a_raw_collection_runs_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def watched(text):
        seen.add(1)
        return text

    sinks.save_raw(collected(spark).withColumn("content", watched("content")), str(tmp_path / "raw"))
    assert seen.value == 4
