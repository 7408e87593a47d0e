"""The pipeline's stages, each against what its operator says of the same input."""

import corpus_pipeline
from readloom.llm import jaccard_join, quality_rules, secrets, toxicity
from readloom.llm.store import cut

SF = "/root/testdata/sf0.01"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = cut(stage(spark, docs, SF), name)
        assert out.columns == columns
        ids = [r.doc_id for r in out.select("doc_id").collect()]
        if name == "quality_rules":
            assert sorted(ids) == sorted(r.doc_id for r in quality_rules.quality_rules(docs, labels).where("kept").collect())
        elif name == "toxicity":
            s = toxicity.score(docs, toxicity.train(docs, labels))
            assert sorted(ids) == sorted(r.doc_id for r in s.where("score < 0.5").collect())
        elif name == "ngram_jaccard_join":
            classes = {r.doc_id: r.class_id for r in jaccard_join.join(docs).collect()}
            assert sorted(ids) == sorted(set(classes.values()))
        else:
            assert sorted(ids) == sorted(r.doc_id for r in docs.collect())
            assert secrets.secrets(out).where("n_assign + n_access + n_hex > 0").count() == 0
        docs = out
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r.doc_id for r in pieces} == {r.doc_id for r in docs.collect()}
    assert len(pieces) == corpus_pipeline.run(spark, SF).count()


def test_odd_rows(spark):
    rows = [(k, f"{k} " + " ".join(f"w{(k * j) % 311}" for j in range(1, 90)), "en", "s", 1, "c", 5) for k in range(1, 30)]
    rows += [(None, None, None, None, None, None, None), (2, rows[1][1], "en", "s", 1, "c", 5), (77, rows[1][1], None, None, None, None, None), (78, "", "en", "s", 0, "c", 1), (None, rows[4][1], "en", "s", 1, "c", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, label string, __1 int")
    docs = docs.withColumnRenamed("__1", "score")
    kept = jaccard_join.deduplicate(docs)
    assert kept.columns == docs.columns
    words = [r.text for r in kept.collect() if r.text]
    assert len(words) == len(set(words)) and set(words) == {r[1] for r in rows if r[1]}
    assert sorted(r.doc_id for r in kept.collect() if r.text and r.text == rows[1][1]) == [2]
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality_rules.reject_anomalous(docs, labels).count() == len([r for r in rows if r[1]])
    assert toxicity.reject_toxic(docs, labels).count() == len(rows)
    assert secrets.redact(docs.limit(0)).count() == 0 and jaccard_join.deduplicate(docs.limit(0)).count() == 0
