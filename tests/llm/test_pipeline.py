"""The corpus pipeline, stage by stage."""

import random

import corpus_pipeline
from pyspark.sql import functions as F

from pricegrain.llm.repeats import LENGTH

SMALL = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_decide(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").withColumn("extra", F.lit(1))
    junk = spark.createDataFrame([(5000, "12 34 !!", "en", "s", 8, 1), (5001, None, None, None, None, 1)], docs.schema)
    columns = docs.columns
    docs = docs.unionByName(junk)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMALL)
        path = str(tmp_path / name)
        out.write.parquet(path)
        new = spark.read.parquet(path)
        if name == "mix":
            assert new.count() == docs.count()
            break
        assert new.columns == columns
        before, after = {r["doc_id"]: r for r in docs.collect()}, {r["doc_id"]: r for r in new.collect()}
        assert set(after) <= set(before) and len(after) > 0.8 * len(before)
        if name == "language_id":
            assert set(before) - set(after) == {5000, 5001}
        if name == "suffix_dedup":
            seen = set()
            for i in sorted(after):
                b = after[i]["text"].encode()
                seen |= {b[p : p + LENGTH] for p in range(len(b) - LENGTH + 1)}
                assert after[i]["n_chars"] == len(after[i]["text"])
        elif name != "mix":
            assert all(after[i]["text"] == before[i]["text"] for i in after)
        docs = new


def test_language_stage_rejects_what_was_not_learnt(spark):
    rng = random.Random(6)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    polish = "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem i powinni postępować wobec innych w duchu braterstwa. "
    noise = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz    ") for _ in range(300))
    short = [r["text"][:60] for r in docs.filter("length(text) > 600").orderBy("doc_id").limit(20).collect()]
    more = [(7000, polish), (7001, noise), *((8000 + i, t) for i, t in enumerate(short))]
    extra = spark.createDataFrame([(i, t, None, "s", len(t)) for i, t in more], docs.schema)
    kept = {r["doc_id"] for r in corpus_pipeline.language(spark, docs.unionByName(extra), SMALL).collect()}
    assert kept == {r["doc_id"] for r in docs.collect()} | {8000 + i for i in range(len(short))}


def test_short_benchmark_items_take_no_document_along(spark, tmp_path):
    spark.createDataFrame([(1, "of the"), (2, "a passage of seven words it is")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.createDataFrame([(1, "one of the clean ones"), (2, "here a passage of seven words it is"), (None, "of the")], "doc_id long, text string")
    assert sorted((r["doc_id"] for r in corpus_pipeline.decontaminate(spark, docs, str(tmp_path)).collect()), key=str) == [1, None]


def test_run_and_registration(spark):
    import __spark_entry__

    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    first = {r["doc_id"]: r["taken"] for r in corpus_pipeline.run(spark, SMALL).collect()}
    assert first and first == {r["doc_id"]: r["taken"] for r in corpus_pipeline.run(spark, SMALL).collect()}
