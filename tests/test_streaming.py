import datetime as dt

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from corpusloom.config import Cleaning, CorpusConfig
from corpusloom.streaming import expiring, ingest, requests


def drain(spark, rows, base, name):
    out, state = f"{base}/{name}", f"{base}/{name}-state"
    ingest.write_stream(rows, out, state).awaitTermination()
    return spark.read.parquet(out)


def test_duplicates_across_batches(spark, tmp_path):
    base = str(tmp_path)
    config = CorpusConfig(cleaning=Cleaning(min_text_length=1))

    def arrive(rows):
        frame = spark.createDataFrame(rows, "doc_id long, content string, source_type string")
        frame.write.mode("append").parquet(f"{base}/docs.parquet")

    def run():
        stream = ingest.table_stream(spark, base, "docs")
        return drain(spark, ingest.fresh_documents(stream, "doc_id", config), base, "out")

    arrive([(i, "same  text", "web") for i in range(50)] + [(99, "b", "web")])
    assert sorted(r["content"] for r in run().collect()) == ["b", "same text"]
    arrive([(200, "same text", "web"), (201, "new", "web"), (202, "b ", "web")])
    assert sorted(r["content"] for r in run().collect()) == ["b", "new", "same text"]


def test_stream_equals_batch(spark, folder, tmp_path):
    from corpusloom.plans.corpus import process
    from corpusloom.plans.corpus_queries import EXACT
    from corpusloom.sources.tables import documents

    stream = ingest.table_stream(spark, folder, "documents").select(
        "doc_id", F.col("text").alias("content"), F.lit("web").alias("source_type")
    )
    rows = drain(spark, ingest.fresh_chunks(stream, "doc_id"), str(tmp_path), "chunks")
    batch = process(documents(spark, folder), EXACT)
    ids = {r["chunk_id"] for r in rows.select("chunk_id").collect()}
    assert ids == {r["chunk_id"] for r in batch.select("chunk_id").collect()}


def test_watermarked_dedup(spark, tmp_path):
    start = dt.datetime(2024, 1, 1)
    rows = [(i, "x", start + dt.timedelta(minutes=i)) for i in range(5)]
    spark.createDataFrame(rows, "doc_id long, content string, ts timestamp").write.parquet(f"{tmp_path}/d.parquet")
    stream = ingest.table_stream(spark, str(tmp_path), "d")
    fresh = ingest.new_content(stream, "doc_id", event_time="ts")
    assert drain(spark, fresh, str(tmp_path), "out").count() == 1


def test_late_requests_are_dropped(spark, tmp_path):
    start, base = dt.datetime(2024, 1, 1), str(tmp_path)

    def arrive(*minutes):
        rows = [(start + dt.timedelta(minutes=m), 7, m % 2 == 0) for m in minutes]
        frame = spark.createDataFrame(rows, "ts timestamp, user_id long, is_error boolean")
        frame.coalesce(1).write.mode("append").parquet(f"{base}/r.parquet")

    def run(make, name):
        return drain(spark, make(ingest.table_stream(spark, base, "r")), base, name)

    def windows():
        return run(requests.windowed_requests, "w")

    arrive(0, 1, 2, 200)
    first = {r["window_start"].hour: (r["requests"], r["errors"]) for r in windows().collect()}
    assert first == {0: (3, 2)}
    arrive(3, 201, 400)
    second = {r["window_start"].hour: (r["requests"], r["errors"]) for r in windows().collect()}
    assert second == {0: (3, 2), 3: (2, 1)}
    over = run(lambda s: requests.windowed_breaches(s, 2, "1 hour"), "b")
    assert [(r["user_id"], r["requests"]) for r in over.collect()] == [(7, 4)]


def test_contents_expire_with_their_state(spark, tmp_path):
    start, base, columns = dt.datetime(2024, 1, 1), str(tmp_path), "doc_id long, content string, ts timestamp, _odd int"

    def run(*rows):
        timed = [(i, c, None if s is None else start + dt.timedelta(seconds=s), 1) for i, c, s in rows]
        spark.createDataFrame(timed, columns).coalesce(1).write.mode("append").parquet(f"{base}/docs.parquet")
        fresh = expiring.expiring_content(ingest.table_stream(spark, base, "docs"), "doc_id", "ts", "640 seconds", "10 seconds")
        query = ingest.write_stream(fresh, f"{base}/out", f"{base}/state")
        query.awaitTermination()
        state = [{o.operatorName: o.numRowsTotal for o in p.stateOperators} for p in query.recentProgress]
        rows = spark.read.parquet(f"{base}/out").filter("_odd = 1").select("content", F.unix_timestamp("seen_at"))
        return sorted((c, s - 1704067200) for c, s in rows.collect()), state

    # A content that fills the stream, one that is met again in time, and a row without a time.
    first, _ = run(*[(i, "x", i) for i in range(300)], (1000, "b", 5), (1001, "c", 650), (1003, "t", None))
    assert first == [("b", 0), ("c", 650), ("x", 0)]
    again, _ = run((2000, "x", 700), (2001, "x", 700), (2002, "b", 660), (2003, "c", 700), (2004, "z", 20_000))
    assert [r for r in again if r[0] != "x"] == [("b", 0), ("b", 660), ("c", 650), ("z", 20_000)]
    assert [r for r in again if r[0] == "x"] == [("x", 0), ("x", 700)]
    last, state = run((3000, "x", 20_001), (3001, "n", 25_000))
    assert [r for r in last if r[1] >= 20_000] == [("n", 25_000), ("x", 20_000), ("z", 20_000)]
    # Only what is younger than the time to keep is still held.
    assert state[-1]["transformWithStateInPandasExec"] <= 1 and state[-1]["dedupe"] <= 1


def test_contents_share_few_states(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(expiring, "BUCKETS", 3)
    start, base = dt.datetime(2024, 1, 1), str(tmp_path)

    def run(seconds, contents):
        rows = [(i, f"c{i}", start + dt.timedelta(seconds=seconds)) for i in contents]
        spark.createDataFrame(rows, "doc_id long, content string, ts timestamp").write.mode("append").parquet(f"{base}/docs.parquet")
        fresh = expiring.expiring_content(ingest.table_stream(spark, base, "docs"), "doc_id", "ts", "640 seconds", "10 seconds")
        query = ingest.write_stream(fresh, f"{base}/out", f"{base}/state")
        query.awaitTermination()
        out = spark.read.parquet(f"{base}/out").select("content", F.unix_timestamp("seen_at"))
        state = [{o.operatorName: o.numRowsTotal for o in p.stateOperators} for p in query.recentProgress]
        return sorted((c, s - 1704067200) for c, s in out.collect()), state[-1]["transformWithStateInPandasExec"]

    wanted = [(f"c{i}", 0) for i in range(60)]
    found, states = run(0, range(60))
    assert found == sorted(wanted) and states <= 3
    # Half of them rest longer than the others.
    wanted += [(f"c{i}", 640) for i in range(30)]
    assert run(640, range(30))[0] == sorted(wanted)
    wanted += [(f"c{i}", 1000) for i in range(30, 60)]
    assert run(1000, range(60))[0] == sorted(wanted)
    assert run(1270, range(60))[0] == sorted(wanted)


def test_updates_survive_restart_and_replay(spark, tmp_path):
    start, base = dt.datetime(2024, 1, 1), str(tmp_path)

    def arrive(*minutes):
        rows = [(start + dt.timedelta(minutes=m), 7, m % 2 == 0) for m in minutes]
        frame = spark.createDataFrame(rows, "ts timestamp, user_id long, is_error boolean")
        frame.coalesce(1).write.mode("append").parquet(f"{base}/r.parquet")

    def run(name, write=ingest.write_updates):
        rows = requests.windowed_requests(ingest.table_stream(spark, base, "r"))
        query = write(rows, f"{base}/{name}", f"{base}/{name}-state")
        query.awaitTermination()
        return query

    def read(name):
        rows = spark.read.parquet(f"{base}/{name}").select("window_start", "requests", "errors")
        return sorted((int((r[0] - start).total_seconds() // 3600), r[1], r[2]) for r in rows.collect())

    arrive(0, 1, 62)
    run("once")
    assert read("once") == [(0, 2, 1), (1, 1, 1)]
    day_one = {f.name: f.stat().st_mtime_ns for f in (tmp_path / "once").rglob("folder=19723/*.parquet")}
    # The second batch changes one window of the first day and opens one on another.
    arrive(65, 2000)
    run("once")
    assert read("once") == [(0, 2, 1), (1, 2, 1), (33, 1, 1)]
    assert day_one.keys().isdisjoint(f.name for f in (tmp_path / "once").rglob("folder=19723/*.parquet"))
    # A batch that writes and then fails before it is committed is done again on restart.
    arrive(2005, 2006, 5000)
    merge, failures = ingest.merge_batch, [1]

    def fails_after_writing(rows, path, state):
        def write(batch, number):
            merge(batch, number, path, ("window_start",), "window_start")
            if failures:
                failures.pop()
                raise RuntimeError("lost")

        return rows.writeStream.outputMode("update").foreachBatch(write).option(
            "checkpointLocation", state).trigger(availableNow=True).start()

    with pytest.raises(StreamingQueryException):
        run("once", fails_after_writing)
    query = run("once", fails_after_writing)
    assert read("once") == [(0, 2, 1), (1, 2, 1), (33, 3, 2), (83, 1, 1)]
    run("all")
    assert read("all") == read("once")
    # The first day's folder was not touched again, and closed windows left the state.
    assert query.recentProgress[-1].stateOperators[0].numRowsTotal == 1
    days = spark.read.parquet(f"{base}/once").groupBy("folder").agg(F.max("batch").alias("b")).orderBy("folder").collect()
    assert [r["b"] for r in days] == sorted(r["b"] for r in days) and days[0]["b"] < days[-1]["b"]


def test_no_window_is_an_empty_table(spark, tmp_path):
    base = str(tmp_path)
    spark.createDataFrame([(dt.datetime(2024, 1, 1), 7)], "ts timestamp, user_id long").write.parquet(f"{base}/r.parquet")
    over = requests.windowed_breaches(ingest.table_stream(spark, base, "r"), 5)
    ingest.write_updates(over, f"{base}/b", f"{base}/s", ("user_id", "window_start")).awaitTermination()
    assert spark.read.schema(over.schema).parquet(f"{base}/b").count() == 0
