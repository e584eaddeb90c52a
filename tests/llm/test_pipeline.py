"""The stages of the pipeline against plain versions, and the whole run."""

import numpy as np

import corpus_pipeline
from brute import jaccard, repeats
from loglens.llm import suffix_dedup, toxicity

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted((r["doc_id"], r["text"]) for r in df.collect())


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)

    def step(name, df):
        path = str(tmp_path / name)
        stages[name](spark, df, SF).write.parquet(path)
        made = spark.read.parquet(path)
        assert name == "packing" or made.columns == docs.columns
        return made

    clean = step("toxicity", docs)
    state = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    judged = toxicity.score_documents(docs, state).filter("score < 0.5").select("doc_id")
    assert sorted(r[0] for r in judged.collect()) == [r[0] for r in _rows(clean)]

    single = step("exact_dedup", clean)
    last = {}
    for doc, text in _rows(clean):
        last[text] = max(doc, last.get(text, doc))
    assert _rows(single) == sorted((d, t) for t, d in last.items())

    unlike = step("jaccard_join", single)
    heads = {c for d, _, c in jaccard(_rows(single)) if d == c}
    assert _rows(unlike) == [r for r in _rows(single) if r[0] in heads]

    short = step("suffix_dedup", unlike)
    expected = [(d, kept.decode(errors="ignore")) for d, _, _, _, kept in repeats(_rows(unlike))]
    assert _rows(short) == sorted(expected)

    packed = step("packing", short)
    run = corpus_pipeline.run(spark, SF)
    pieces = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert sorted(map(tuple, run.select(*pieces).collect())) == sorted(
        map(tuple, packed.select(*pieces).collect())
    )


def test_one_python_step_beside_the_texts(spark):
    """Steps that follow one another in a stage each keep a Python worker."""
    rows = [(i, f"{i} é" * 150 + "same é" * 60) for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    short = suffix_dedup.documents_without_repeats(docs)
    plan = short._jdf.queryExecution().optimizedPlan().toString()
    # One makes the texts' numbers, one removes the repeats.
    assert plan.count("MapInArrow") == 2
    expected = [(d, kept.decode(errors="ignore")) for d, _, _, _, kept in repeats(rows)]
    assert _rows(short) == sorted(expected)


def test_remembered_words_are_bounded(monkeypatch):
    weights = np.random.default_rng(1).normal(size=toxicity.FEATURES).astype(np.float32)
    texts = [[f"often again{i % 3} rare{i}x{j}" for j in range(40)] for i in range(12)]
    whole = [toxicity.Scorer(weights, -0.1).documents(some).tolist() for some in texts]
    monkeypatch.setattr(toxicity, "TABLE_WORDS", 60)
    scorer = toxicity.Scorer(weights, -0.1)
    for some, scores in zip(texts, whole):
        assert scorer.documents(some).tolist() == scores
        assert len(scorer.known) <= 60
    assert "often" in scorer.known
