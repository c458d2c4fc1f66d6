"""The stages of the corpus pipeline, each against what its operator says of its input."""

from __future__ import annotations

import brute
import corpus_pipeline as pipeline
import pytest
from brute import AWKWARD, SF, frame
from pyspark.sql import functions as F

from shelfmark.llm.common import stored
from shelfmark.llm.folding import fold


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, stage in pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], SF), "stage"))
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_keep_the_columns(steps):
    for df in steps[:-1]:
        assert df.columns == pipeline.COLUMNS
    names = [name for name, _ in pipeline.STAGES]
    assert names == ["toxicity", "line dedup", "near-duplicates", "decontamination", "packing"]
    assert steps[-1].count() > 0


def test_toxicity_only_drops(spark, steps):
    before, after = texts(steps[0]), texts(steps[1])
    assert after.items() <= before.items()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    clean = [i for i in before if labels.get(i) == 0]
    assert sum(i in after for i in clean) >= 0.95 * len(clean)


def test_lines_of_earlier_documents_are_gone(steps):
    before, after = texts(steps[1]), texts(steps[2])
    want = {r[0]: r[3] for r in brute.line_dedup(sorted(before.items()))}
    assert {i: brute.sha(t) for i, t in after.items()} == want
    assert all(r.n_chars == len(r.text) for r in steps[2].collect())


def test_one_document_of_each_group_stays(steps):
    before, after = texts(steps[2]), texts(steps[3])
    want = {i for i, _, root in brute.simhash_dups(list(before.items())) if i == root}
    assert set(after) == want and after.items() <= before.items()


def test_documents_with_benchmark_items_are_gone(spark, steps):
    folded = lambda t: "".join(map(chr, fold(t)[0]))
    items = [folded(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before, after = texts(steps[3]), texts(steps[4])
    for i, t in before.items():
        nearest = min(brute.edit_distance_inside(x, folded(t)) / len(x) for x in items if x in folded(t)) \
            if any(x in folded(t) for x in items) else 1
        assert not (nearest == 0 and i in after)
    assert after.items() <= before.items()


def test_every_kept_document_is_packed(steps):
    kept = set(texts(steps[4]))
    whole = steps[5].groupBy("doc_id").agg(F.sum("length").alias("n"), F.first("doc_tokens").alias("all"))
    rows = whole.collect()
    assert {r.doc_id for r in rows} == kept and all(r.n == r["all"] for r in rows)


def test_run_is_the_stages(spark, steps):
    got = pipeline.run(spark, SF)
    assert got.columns == steps[-1].columns and got.count() == steps[-1].count()


def test_stages_on_awkward_and_empty_tables(spark):
    for rows in (AWKWARD, []):
        docs = frame(spark, rows)
        for _, stage in pipeline.STAGES:
            docs = stored(stage(spark, docs, SF), "awkward")
        assert (docs.count() > 0) == bool(rows)
