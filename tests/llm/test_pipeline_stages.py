"""The corpus pipeline, stage by stage, on planted documents."""

import random

import corpus_pipeline
from strata.llm import decontaminate
from strata.session import scratch_path


def planted(spark):
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(400)]

    def text(n):
        return [rng.choice(words) for _ in range(n)]

    insults = ["vilegrub", "rotbrain"]
    rows, labels = [], []
    for i in range(200):
        w = text(60)
        toxic = i % 5 == 0
        if toxic:
            w[3], w[20] = insults[i % 2], insults[i % 2]
        rows.append((i, " ".join(w)))
        if i < 150:
            labels.append((i, 1, int(toxic)))
    clean = [i for i in range(200) if i % 5]
    rows += [(300 + k, rows[clean[k]][1]) for k in range(10)]  # exact copies
    near = []
    for k in range(10, 20):
        w = rows[clean[k]][1].split()
        w[-1] = "changed"
        near.append((400 + k, " ".join(w)))
    rows += near
    bench = [(k, " ".join(text(30))) for k in range(5)]
    rows += [(500 + k, " ".join(text(40) + bench[k][1].split() + text(10))) for k in range(5)]
    return rows, labels, bench, clean


def test_stages(spark, tmp_path):
    rows, labels, bench, clean = planted(spark)
    d = str(tmp_path)
    spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    docs = spark.read.parquet(f"{d}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, d).write.parquet(path)
        if name != "bpe":
            assert spark.read.parquet(path).columns == docs.columns
        docs = spark.read.parquet(path)
        kept[name] = {r["doc_id"] for r in docs.select("doc_id").collect()}
    all_ids = {i for i, _ in rows}
    assert kept["toxicity"] == all_ids - {i for i in range(200) if i % 5 == 0}
    assert kept["exact_dedup"] == kept["toxicity"] - {clean[k] for k in range(10)}
    assert kept["near_duplicates"] == kept["exact_dedup"] - {400 + k for k in range(10, 20)}
    assert kept["decontamination"] == kept["near_duplicates"] - {500 + k for k in range(5)}
    assert kept["bpe"] == kept["decontamination"]
    final = corpus_pipeline.run(spark, d)
    assert {r["doc_id"] for r in final.select("doc_id").collect()} == kept["bpe"]
    assert decontaminate.contaminated(docs.limit(0).selectExpr("doc_id", "'' AS text"), spark.read.parquet(f"{d}/benchmark.parquet")).count() == 0


def test_stages_on_nasty_and_empty_documents(spark, nasty, empty, tmp_path):
    d = str(tmp_path)
    spark.createDataFrame([(1, 1, 0), (7, None, 1), (None, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, None), (2, "q1 q2 q3 q4 q5 q6")], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    for docs in (nasty, empty):
        docs = docs.select("doc_id", "text", "lang", "source", "n_chars")
        for name, stage in corpus_pipeline.STAGES:
            path = scratch_path(spark, name)
            stage(spark, docs, d).write.parquet(path)
            docs = spark.read.parquet(path)
            assert name == "bpe" or docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
