from collections import Counter

import cases
from pyspark.sql import functions as F

import corpus_pipeline
from storelens.llm import decontam, language, rules, simhash


def test_stages_act_on_what_the_one_before_kept(spark):
    sf = cases.SF
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, kept = docs.columns, docs
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = corpus_pipeline.stored(stage(spark, kept, sf))
        assert kept.columns == columns
        counts.append(kept.count())
    assert counts == sorted(counts, reverse=True)
    pieces = corpus_pipeline.run(spark, sf)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == {r.doc_id for r in kept.select("doc_id").collect()}


def test_result_by_plain_steps(spark):
    """Each decision taken from its operator over the whole input, then applied by hand."""
    sf = cases.SF
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    subset = lambda ids: docs.where(F.col("doc_id").isin(sorted(ids)))
    judged = rules.judge(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    ids = {r[0] for r in judged.where("kept").select("_row.doc_id").collect()}
    ids -= {r[0] for r in language.identify(subset(ids)).where("rejected").select("_row.doc_id").collect()}
    groups = simhash.near_copies(subset(ids)).select("_row.doc_id", "component_id").collect()
    ids = {r[1] for r in groups}
    marked, _ = decontam.decontaminate(subset(ids), spark.read.parquet(f"{sf}/benchmark.parquet"))
    ids = {r[0] for r in marked.where("not contaminated").select("_row.doc_id").collect()}
    got = Counter(r.doc_id for r in corpus_pipeline.run(spark, sf).where("start = 0").collect())
    assert got == Counter(ids) and 0 < len(ids) < len(text)


def test_awkward_documents_pass_through(spark, tmp_path):
    docs = cases.documents(spark)
    for name, table in (("labels", cases.labels(spark)), ("benchmark", cases.benchmark(spark))):
        table.write.parquet(f"{tmp_path}/{name}.parquet")
    for frame in (docs, cases.empty(spark)):
        kept = frame
        for _, stage in corpus_pipeline.STAGES[:-1]:
            kept = corpus_pipeline.stored(stage(spark, kept, str(tmp_path)))
            assert kept.columns == docs.columns
        assert corpus_pipeline.STAGES[-1][1](spark, kept, str(tmp_path)).count() >= kept.count()
