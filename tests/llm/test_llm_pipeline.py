"""The pipeline: every stage against a plain version of what it must do."""

import os
import re

import corpus_pipeline
import numpy as np
from edge_cases import TEXTS
from test_llm_dedup import linked
from test_llm_texts import base_spans

from refgauge.llm import quality, secrets
from refgauge.workspace import new_path, shared_folder, written


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    columns = docs.columns

    def step(name, docs):
        out = written(stages[name](spark, docs, sf), "test-stage")
        assert out.columns == columns
        return out, [(r.doc_id, r.text) for r in docs.collect()], [(r.doc_id, r.text) for r in out.collect()]

    good, before, after = step("quality classifier", docs)
    model = quality.learned(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    accepted = {r.doc_id for r in quality.scored(docs, model).filter("predicted = 1").collect()}
    assert sorted(after) == sorted(x for x in before if x[0] in accepted)

    single, before, after = step("exact dedup", good)
    first = {}
    for i, text in sorted(before, key=lambda x: (-len(x[1] or ""), x[0])):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), (i, text))
    assert sorted(after) == sorted(first.values())

    apart, before, after = step("n-gram Jaccard join", single)
    least = {i for i, _, component in linked(before, 5, 80) if i == component}
    assert sorted(after) == sorted(x for x in before if x[0] in least)

    masked, before, after = step("secret scans", apart)
    assert len(after) == len(before) and not any(base_spans(text) for _, text in after)
    assert {x for x in before if not secrets.spans_of(x[1] or "")} <= set(after)
    assert all(r.n_chars == len(r.text) for r in masked.collect())

    packed = stages["best-fit packing"](spark, masked, sf).collect()
    assert {r.doc_id for r in packed} == {i for i, _ in after}


def test_run_gives_the_rows_of_its_stages(spark, sf):
    held = set(os.listdir(shared_folder(spark).removeprefix("file:")))
    rows = corpus_pipeline.run(spark, sf).collect()
    made = set(os.listdir(shared_folder(spark).removeprefix("file:"))) - held
    assert [name.split("-")[0] for name in made] == ["packed"]
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        assert np.cumsum([0, *(n for _, n in sorted(places))])[:-1].tolist() == [a for a, _ in sorted(places)]
        assert sum(n for _, n in places) <= 4096
    assert len(rows) > 50


def test_run_over_empty_tables(spark, sf):
    folder = new_path(spark, "empty")
    for name in ("documents", "labels"):
        spark.read.parquet(f"{sf}/{name}.parquet").limit(0).write.parquet(f"{folder}/{name}.parquet")
    assert corpus_pipeline.run(spark, folder).collect() == []


def test_stages_take_edge_cases(spark, sf):
    for texts in (TEXTS, []):
        rows = [(i, t, None, None, None) for i, t in texts]
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = written(stage(spark, docs, sf), "test-edges")
        rows = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
        assert bool(rows) == bool(docs.count()), name
