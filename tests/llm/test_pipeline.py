"""The pipeline against a brute-force version of its stages."""

import collections

import corpus_pipeline
from tests.llm.test_operators import near_brute

from flowlog.llm import toxicity

SF = "/root/testdata/sf0.001"


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.train(docs, labels)
    rows = {r.doc_id: r for r in docs.collect()}
    clean = {i: r for i, r in rows.items() if model.score(toxicity.term_places((r.text or "").encode())) < 0.5}
    seen, single = set(), {}
    for i in sorted(clean):
        text = b" ".join(b"x" + w for w in (clean[i].text or "").encode().split())
        edges = ((clean[i].text or " ")[0].isspace(), (clean[i].text or " ")[-1].isspace())
        if (text, edges) not in seen:
            seen.add((text, edges))
            single[i] = clean[i]
    groups, _ = near_brute({i: (r.text or "").encode() for i, r in single.items()}, 5, 80)
    kept = {i for i, g in groups.items() if g == i}

    out = docs
    for (name, stage), want in zip(corpus_pipeline.STAGES[:3], (set(clean), set(single), kept)):
        out = stage(spark, out, SF)
        assert {r.doc_id for r in out.select("doc_id").collect()} == want, name
        assert out.columns == docs.columns
    final = corpus_pipeline.run(spark, SF).collect()
    taken = collections.Counter(r.doc_id for r in final)
    assert set(taken) <= kept and max(taken.values()) <= 3
    assert all(r.round_trip and len(r.ids) == 4 * r.n_tokens for r in final)


def test_pipeline_on_empty_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0


def test_pipeline_stages_on_awkward_rows(spark):
    """Nulls, ties, repeated rows, a very long text and columns with clashing names."""
    from pyspark.sql import functions as F

    from tests.llm.test_operators import AWKWARD, DOCS

    names = ("toxicity", "text_digest", "keep_id", "kept", "gone_id", "mix_size", "copy", "n_tokens")
    docs = spark.createDataFrame(AWKWARD, DOCS).withColumns({c: F.lit("clash") for c in names})
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        kept = stage(spark, kept, SF)
        assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
    # of the six-word texts one stays, of the two long ones the first, of the empty ones that of the smallest id; " \n " is one space
    assert sorted((r.doc_id for r in kept.collect()), key=lambda i: (i is None, i or 0)) == [1, 3, 8, 9, None]
    mixed = corpus_pipeline.mix_sources(spark, kept, SF)
    assert {r.doc_id for r in mixed.collect()} <= {3, 9, None}
    coded = corpus_pipeline.encode_texts(spark, mixed, SF).collect()
    assert all(r.round_trip for r in coded)
