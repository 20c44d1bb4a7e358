"""The stages over a small table with nulls, repeats and clashing columns."""

import corpus_pipeline
from corpusloom.llm.queries import QUERIES


def test_stages_pass_on_the_columns_of_documents(spark, tmp_path):
    rows = [(i, f"some words number {i} " * 12, "en", f"src{i % 3}", 10) for i in range(60)]
    rows += [(60, None, None, None, None), (61, "", "en", "src0", 0), (None, "no id here", "en", "src0", 3)]
    rows += [(62, rows[1][1], "en", "src0", 10), (63, "write to me@example.org " + rows[2][1], "en", "src1", 9), (5, *rows[5][1:])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 0), (2, 0)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        frame = stage(spark, docs, str(tmp_path))
        frame.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "packing":
            assert docs.columns == list(corpus_pipeline.COLUMNS)
        kept[name] = [r["doc_id"] for r in docs.collect()]
    assert len(kept["toxicity"]) == len(rows)
    assert 62 not in kept["near_dedup"] and {0, 1, 60, 61, None} <= set(kept["near_dedup"])
    assert sorted(map(str, kept["pii"])) == sorted(map(str, kept["near_dedup"]))
    assert "me@example.org" not in str(spark.read.parquet(f"{tmp_path}/pii").collect())
    assert set(kept["mixing"]) <= set(kept["pii"]) and set(kept["packing"]) == set(kept["mixing"])


def test_each_operator_has_its_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
