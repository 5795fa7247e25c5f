"""Extra columns that clash with inner names, nulls, empty texts, ties and empty tables: fitted operators and the pipeline."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strata.llm import decontaminate, language, quality

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASH = ("label_id", "at", "x", "rk", "row", "count", "share", "held_out", "score", "predicted", "lang_pred", "win", "terms", "size", "did", "node", "quality",
         "kind", "votes", "form", "context", "taken", "target", "doc", "block")
GOOD = "the plain words of text number {} go on and on about {} things that people read with some care every day"


def clashing(df):
    return df.withColumns({c: F.lit("x") for c in CLASH if c not in df.columns})


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, GOOD.format(i, i * 7), "en", f"s{i % 3}", None) for i in range(80)]
    rows += [(100 + i, f"$$ {i} !! ## {i * 3} %% WIN {i} !!! " * 6, "de", None, 5) for i in range(80)]
    rows += [(None, None, None, None, None), (None, GOOD.format(1, 7), None, None, 3), (900, "", "en", "s0", 0), (901, None, "en", "s0", None), (7, GOOD.format(7, 49), "en", "s1", None),
             (902, GOOD.format(2, 14) + " mail a@b.com now", None, "s2", None)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, 1, 0) for i in range(80)] + [(100 + i, 0, 1) for i in range(80)] + [(None, 1, None), (3, None, None)], "doc_id bigint, quality int, toxic int")


def test_fitted_operators_read_no_clashing_column(docs, labels):
    plain = quality.assess(docs, quality.train(docs, labels)).collect()
    other = clashing(labels.withColumnRenamed("toxic", "text"))
    assert sorted(map(str, quality.assess(clashing(docs), quality.train(clashing(docs), other)).collect())) == sorted(map(str, plain))
    rule = language.held_out_rule()
    plain = language.identify(docs, language.train(docs, ~rule), rule).collect()
    assert sorted(map(str, language.identify(clashing(docs), language.train(clashing(docs), ~rule), rule).collect())) == sorted(map(str, plain))


def test_benchmark_with_clashing_columns(spark, docs):
    items = spark.createDataFrame([("q1", "of text number 5 go on and on about 35"), ("q2", None), (None, "")], "item_id string, text string")
    more = clashing(items).withColumn("doc_id", F.lit(1)).withColumn("n_words", F.lit("y"))
    got = {r.doc_id: r for r in decontaminate.report(clashing(docs), more).collect()}
    assert [i for i, r in got.items() if r.contaminated] == [5] and got[5].n_hit == 10


def write(folder, docs, labels, benchmark):
    for name, df in (("documents", docs), ("labels", labels), ("benchmark", benchmark)):
        df.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_pipeline_on_odd_rows(spark, docs, labels, tmp_path):
    benchmark = spark.createDataFrame([("q1", "of text number 5 go on and on about 35"), ("q2", None)], "item_id string, text string")
    rows = corpus_pipeline.run(spark, write(tmp_path / "plain", docs, labels, benchmark)).collect()
    found = {r.doc_id: r for r in rows}
    assert 5 not in found and not any(100 <= (i or 0) < 200 for i in found)
    assert sum(r.doc_id == 7 for r in rows) <= 1  # a repeated row stays once at most
    assert not any("a@b.com" in (r.text or "") for r in rows)
    again = corpus_pipeline.run(spark, write(tmp_path / "clash", clashing(docs), clashing(labels), clashing(benchmark))).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows)) and rows


def test_pipeline_on_empty_tables(spark, docs, labels, tmp_path):
    benchmark = spark.createDataFrame([], "item_id string, text string")
    assert corpus_pipeline.run(spark, write(tmp_path / "none", docs.limit(0), labels.limit(0), benchmark)).count() == 0
    assert corpus_pipeline.run(spark, write(tmp_path / "docs", docs, labels.limit(0), benchmark)).count() > 0
