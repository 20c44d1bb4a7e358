from pyspark.sql import functions as F

from corpusloom.config import Chunking, Curation
from corpusloom.operators import trainset as ts
from corpusloom.operators.chunking import chunk, chunk_summary


def docs(spark, *texts):
    rows = [(i, t, "web") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, content string, source_type string")


def test_chunk_table_and_summary(spark):
    frame = docs(spark, "w. " * 100, "short", " " * 300)
    rows = chunk(frame, Chunking(100, 10), keep=("doc_id",)).orderBy("chunk_index").collect()
    assert {r["doc_id"] for r in rows} == {0}
    assert [r["chunk_index"] for r in rows] == list(range(len(rows)))
    assert all(r["total_chunks"] == len(rows) and r["char_count"] == len(r["content"]) for r in rows)
    assert rows[0]["chunk_id"].startswith("web_") and rows[0]["chunk_id"].endswith("_0")
    total = chunk_summary(frame, Chunking(100, 10)).first()
    assert (total["total_chunks"], total["total_items_processed"]) == (len(rows), 3)
    none = chunk_summary(frame.limit(0)).first()
    assert (none["total_chunks"], none["avg_chunk_size"]) == (0, 0.0)


def test_generation_and_failures(spark):
    chunks = spark.createDataFrame(
        [("c0", 0, "One two three four. Five!"), ("c1", 1, "bad"), ("c2", 2, "late")],
        "chunk_id string, chunk_index int, content string",
    )

    def make():
        def generate(text, count):
            if text == "bad":
                raise ValueError("no luck")
            return [("What?", text.split(". ")[0] + ".")][:count]

        return generate

    rows = ts.generate_pairs(chunks, make, num_pairs=1, max_chunks=2)
    found = {(r["chunk_id"], r["pair_index"], r["answer"], r["error"]) for r in rows.collect()}
    assert found == {("c0", 0, "One two three four.", None), ("c1", None, None, "no luck")}
    messages = ts.to_messages(rows).collect()
    assert len(messages) == 1
    assert [m["role"] for m in messages[0]["messages"]] == ["system", "user", "assistant"]


def test_conversation_texts(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (2, 0, "tool", "x"), (2, 1, None, "y"), (2, 2, "system", None)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    talks = ts.conversations(turns)
    plain = {r["conv_id"]: r["t"] for r in talks.select("conv_id", ts.plain_text(F.col("messages")).alias("t")).collect()}
    assert plain == {1: "User: a\nAssistant: b\n", 2: "User: y\nSystem: \n"}
    formed = talks.select("conv_id", ts.templated_text(F.col("messages"), "[{role}]{content};").alias("t"))
    assert {r["conv_id"]: r["t"] for r in formed.collect()} == {1: "[user]a;[assistant]b;", 2: plain[2]}
    assert ts.chat_dataset(talks).columns == ["text"]


def test_curation(spark):
    good = "The cat and the dog were in the house with the bird and that was it for the day. " * 7
    rows = [(i, good if i % 2 else "Nix.") for i in range(10)]
    pairs = spark.createDataFrame(rows, "id long, answer string")
    assert [r["id"] for r in ts.curate(pairs, "id", Curation(max_examples=3)).collect()] == [1, 3, 5]
    sized = spark.createDataFrame([(n, "x" * n) for n in (19, 20, 200, 201)], "id long, answer string")
    assert {r["id"] for r in ts.fits_bounds(sized).collect()} == {20, 200}


def test_union_and_stats(spark):
    a = spark.createDataFrame([(1, "q")], "id int, question string")
    b = spark.createDataFrame([(2, "t")], "id int, text string")
    rows = ts.dataset_union(a, b)
    assert {tuple(r) for r in rows.collect()} == {(1, "q", None), (2, None, "t")}
    stats = ts.dataset_stats(rows, 4, 25, "in").first().asDict()
    assert stats == {"total_examples": 2, "chunks_processed": "4", "pairs_per_chunk": 25, "input_source": "in"}
