"""op5_quality: the fitting rows are bounded before they reach the driver, whatever repeats."""

from strata.llm import quality


def fitted(monkeypatch, docs, labels, max_rows):
    seen = []
    monkeypatch.setattr(quality, "fit", lambda rows, *a, **k: seen.extend(rows))
    quality.train(docs, labels, max_rows)
    return seen


def test_repeated_ids_and_rows(spark, monkeypatch):
    docs = spark.createDataFrame([(i % 3, f"text {i % 40} of words", "x", i) for i in range(400)] + [(None, "no id", "x", 1), (1, None, "x", 1), (2, "", "x", 1)],
                                 "doc_id bigint, text string, quality string, label_id int")
    labels = spark.createDataFrame([(i, i % 2, 0, "t") for i in range(3)] + [(1, 0, 0, "t"), (2, None, 0, "t"), (None, 1, 0, "t")],
                                   "doc_id int, quality int, toxic int, text string")
    free = {i for i in range(3) if __import__("zlib").crc32(str(i).encode()) % 4 != 2}
    distinct = docs.select("doc_id", "text").filter(docs.doc_id.isin(*free)).distinct().count()
    assert free and len(fitted(monkeypatch, docs, labels, 1000)) == distinct
    few = fitted(monkeypatch, docs, labels, 10)
    assert len(few) == 10
    again = fitted(monkeypatch, docs.repartition(5), labels.repartition(3), 10)
    assert sorted((a.tobytes(), x.tobytes(), y) for a, x, y in few) == sorted((a.tobytes(), x.tobytes(), y) for a, x, y in again)
    assert fitted(monkeypatch, docs.limit(0), labels, 10) == [] and fitted(monkeypatch, docs, labels.limit(0), 10) == []
