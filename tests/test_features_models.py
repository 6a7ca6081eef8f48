"""Indexing order, metrics and persistence of the fitted model."""

from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from citeflow import constants as K
from citeflow.functions.text import decode_label
from citeflow.operators.features import fitted_labels, frequency_index, label_names
from citeflow.operators.models import classification_metrics, score
from citeflow.plans.batch_job import fit_all
from citeflow.session import scratch_path
from citeflow.sources.models import load_model, save_model


def test_frequency_index_equals_string_indexer(spark, sf_small):
    f = fit_all(spark, sf_small, num_trees=5)
    ours = frequency_index(f.train, K.CATEGORY_COLUMNS).collect()
    table = {}
    for r in ours:
        table.setdefault(r["column_name"], {})[int(r["idx"])] = r["value"]
    fitted = fitted_labels(f.features)
    for col in K.CATEGORY_COLUMNS:
        labels = fitted[f"{col}_index"]
        assert None not in labels, col
        assert [table[col][i] for i in range(len(table[col]))] == labels, col


def test_unseen_value_goes_to_keep_bucket(spark, sf_small):
    f = fit_all(spark, sf_small, num_trees=5)
    row = f.test.limit(1).withColumn("vehicle_make", F.lit("NEVER_SEEN"))
    out = f.features.transform(row)
    n_labels = len(fitted_labels(f.features)["vehicle_make_index"])
    assert out.first()["vehicle_make_index"] == float(n_labels)


def test_metrics_match_spark_evaluator(spark, sf_small):
    f = fit_all(spark, sf_small, num_trees=5)
    pred = score(f.forest, f.test, decode=False).cache()
    ours = {r["metric"]: r["value"] for r in classification_metrics(pred).collect()}
    for m in ["f1", "accuracy", "weightedPrecision", "weightedRecall"]:
        ref = MulticlassClassificationEvaluator(metricName=m).evaluate(pred)
        assert abs(ours[m] - ref) < 1e-9, m


def test_model_roundtrip_same_predictions(spark, sf_small):
    f = fit_all(spark, sf_small, num_trees=5)
    path = save_model(f.forest, scratch_path(spark, "test-model"))
    a = score(f.forest, f.test).select("summons_number", "prediction").orderBy("summons_number").collect()
    b = score(load_model(path), f.test).select("summons_number", "prediction").orderBy("summons_number").collect()
    assert a == b


def test_decode_labels_exact(spark, sf_small):
    f = fit_all(spark, sf_small, num_trees=5)
    labels = label_names(f.forest)
    df = spark.createDataFrame([(float(i),) for i in range(len(labels) + 2)], "p double")
    got = [r[0] for r in df.select(decode_label("p", labels)).collect()]
    assert got[: len(labels)] == labels
    assert got[len(labels)] == f"{float(len(labels))}"


def test_wide_columns_indexed_by_join_match_string_indexer(spark, sf_small):
    from pyspark.ml.feature import StringIndexer
    from citeflow.operators.models import fit_feature_model
    f = fit_all(spark, sf_small, num_trees=5)
    wide_model = fit_feature_model(f.train, ordered=["street_code1", "street_code2", "street_code3"])
    stages = [type(s).__name__ for s in wide_model.stages]
    assert "SQLTransformer" in stages
    ref = StringIndexer(inputCols=K.CATEGORY_COLUMNS,
                        outputCols=[f"{c}_index" for c in K.CATEGORY_COLUMNS],
                        handleInvalid="keep").fit(f.train)
    cols = ["summons_number"] + [f"{c}_index" for c in K.CATEGORY_COLUMNS]
    a = sorted(wide_model.transform(f.test).select(*cols).collect())
    b = sorted(ref.transform(f.test).select(*cols).collect())
    assert a == b


def test_metrics_with_class_only_predicted(spark):
    rows = [(0.0, 0.0), (0.0, 2.0), (1.0, 1.0), (1.0, 0.0), (1.0, 2.0), (0.0, 0.0)]
    pred = spark.createDataFrame(rows, "label double, prediction double")
    ours = {r["metric"]: r["value"] for r in classification_metrics(pred).collect()}
    for m in ["f1", "accuracy", "weightedPrecision", "weightedRecall"]:
        ref = MulticlassClassificationEvaluator(metricName=m).evaluate(pred)
        assert abs(ours[m] - ref) < 1e-9, m


def test_nominal_columns_up_to_the_limit_fit_and_beyond_raise(spark, sf_small):
    import pytest
    from citeflow.operators import models as MD
    f = fit_all(spark, sf_small, num_trees=5)
    from citeflow.operators.features import label_counts
    widest = max(label_counts(f.features).items(), key=lambda x: x[1])
    exact = MD.fit_feature_model(f.train, most_bins=widest[1] + 1)
    assert MD.max_bins(exact) == widest[1] + 1
    MD.train_model(f.train, exact, MD.tree(exact))
    name = widest[0].removesuffix("_index")
    with pytest.raises(ValueError, match=name):
        MD.fit_feature_model(f.train, most_bins=widest[1])


def test_saved_model_carries_its_index_tables(spark, sf_small):
    from pyspark.ml.feature import SQLTransformer
    from citeflow.operators import models as MD
    from citeflow.session import scratch_path
    from citeflow.sources.models import load_model, save_model
    f = fit_all(spark, sf_small, num_trees=5)
    index = scratch_path(spark, "t-index")
    feats = MD.fit_feature_model(f.train, ordered=["street_code1"], index_path=index)
    model = MD.train_model(f.train, feats, MD.tree(feats))
    path = save_model(model, scratch_path(spark, "t-wide-model"))
    back = load_model(path)
    text = [s.getStatement() for s in back.stages if isinstance(s, SQLTransformer)][0]
    assert index not in text and f"{path}-tables" in text
    cols = ["summons_number", "prediction"]
    assert sorted(back.transform(f.test).select(*cols).collect()) == sorted(model.transform(f.test).select(*cols).collect())


def test_rows_without_a_key_train(spark):
    from citeflow.operators.sampling import key_split
    df = spark.createDataFrame([(5,), (6,), (None,)], "k long")
    train, test = key_split(df, "k")
    assert sorted(str(r[0]) for r in train.collect()) == ["6", "None"] and [r[0] for r in test.collect()] == [5]
    assert {r[0]: r[1] for r in key_split(df, "k", split_col="s").collect()} == {5: "test", 6: "train", None: "train"}
