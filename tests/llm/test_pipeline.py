"""The pipeline: stages keep the columns of documents, work on what the one before kept, and their decisions hold."""

import corpus_pipeline
from fcbias.llm import shared


def test_stages(spark, folder):
    docs = shared.table(spark, folder, "documents")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = shared.kept(stage(spark, before, folder), f"test-{name}")
        assert after.dtypes == docs.dtypes, name
        assert after.count() <= before.count()
        if name == "personal_data":
            assert after.count() == before.count()
        before = after
    mixed = corpus_pipeline.STAGES[-1][1](spark, before, folder)
    assert mixed.count() == before.count()
    run = corpus_pipeline.run(spark, folder)
    assert sorted(map(str, run.collect())) == sorted(map(str, mixed.collect()))


def test_one_row_of_a_group_stays(spark, folder):
    schema = "doc_id long, text string, lang string"
    a, b, c = ("the quick brown fox jumps over it again", "one two three four five six seven", "x y z u v w")
    rows = [(1, a, "en"), (1, a, "en"), (1, a, None), (2, a, "en"), (None, a, "en"), (3, b, "en"), (3, c, "en"), (None, b, "en"), (None, c + " q", "de"), (None, c + " q", "en"),
            (7, c, "en"), (None, "", "en"), (None, None, "en"), (8, " \n", "en"), (8, "p q r", "en"), (None, "s t", "en"), (None, "s t", "en"), (None, "lone", "en")]
    docs = spark.createDataFrame(rows, schema).repartition(4)
    got = sorted(map(tuple, corpus_pipeline.drop_near_duplicates(spark, docs, folder).collect()), key=str)
    want = [(1, a, None), (3, b, "en"), (3, c, "en"), (None, c + " q", "de"), (None, "", "en"), (None, None, "en"), (8, " \n", "en"), (8, "p q r", "en"), (None, "s t", "en"), (None, "lone", "en")]
    assert got == sorted(want, key=str)


def test_without_documents(spark, folder):
    docs = shared.table(spark, folder, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0
