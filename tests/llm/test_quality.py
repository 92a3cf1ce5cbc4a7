import numpy as np
import pyarrow as pa

from skyledger.llm.quality import GRADES, OrdinalModel, features, fit, graded, op3_quality_classifier, score, train, trained


def test_features_do_not_depend_on_the_batch():
    texts = ["The cat sat.", None, "", "É cat cat | X!!", "The cat sat."]
    row, feature = features(pa.array(texts))
    for i, text in enumerate(texts):
        assert np.array_equal(feature[row == i], features(pa.array([text]))[1])
    assert len(feature[row == 0]) and not len(feature[row == 1])


def test_fit_orders_grades_and_thresholds():
    rng = np.random.default_rng(1)
    grade = rng.integers(0, 3, 900)
    row, feature = np.nonzero(np.stack([grade == 0, grade == 1, grade == 2, rng.random(900) < 0.5], axis=1) & (rng.random((900, 4)) < 0.9))
    model = fit(row, feature, grade)
    assert np.all(np.diff(model.thresholds) > 0)
    assert model.weights[0] < model.weights[1] < model.weights[2] and abs(model.weights[3]) < 0.3
    tails = model.tails(row, feature, 900)
    assert np.all(tails[:, 0] >= tails[:, 1])


def test_labels_with_nulls_and_repeats(spark):
    rows = [(1, 1, 0), (1, 0, 0), (2, 1, 1), (3, None, 0), (None, 1, 0), (4, 1, 0), (4, 1, 0)]
    got = graded(spark.createDataFrame(rows, "doc_id long, quality int, toxic int")).collect()
    assert sorted(map(tuple, got)) == [(1, 1), (2, 0), (4, 2)]


def test_rows_nulls_empty_tables_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b", 3.5, "x"), (1, "a b", 3.5, "x"), (2, None, None, None), (3, "", 1.0, "y"), (4, "w " * 300_000, 1.0, "z")], "doc_id long, text string, expected_grade double, grade string")
    none = train(docs.select("doc_id", "text"), spark.createDataFrame([], "doc_id long, grade int"))
    got = score(docs, none).collect()
    assert len(got) == 5 and all(r.keep and abs(r.expected_grade - (GRADES - 1)) < 1e-9 for r in got) and got[0].grade == "x"
    model = OrdinalModel(np.zeros(1 << 20), np.array([-1.0, 1.0]))
    assert score(docs.limit(0), model).count() == 0


def test_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    grades = graded(spark.read.parquet(f"{sf}/labels.parquet"))
    model = train(docs, grades.where("doc_id % 4 > 0"))
    got = score(docs, model).join(grades.where("doc_id % 4 = 0"), "doc_id").select("grade", "keep").toPandas()
    assert got[got.grade == 2].keep.mean() > 0.99
    assert got[got.grade == 0].keep.mean() < 0.2
    again = train(docs.repartition(7), grades.where("doc_id % 4 > 0"))
    assert np.array_equal(model.weights, again.weights)


def test_query_scores_every_document(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = op3_quality_classifier(spark, sf)
    assert got.count() == docs.count() and "keep" in got.columns
    model = trained(spark, docs, sf)
    one = docs.orderBy("doc_id").limit(20).toPandas()
    tails = model.tails(*features(pa.array(one.text)), len(one))
    want = dict(zip(one.doc_id, tails[:, -1], strict=True))
    for r in got.where(got.doc_id.isin([int(i) for i in want])).collect():
        assert abs(r.tail_probability - want[r.doc_id]) < 1e-12
