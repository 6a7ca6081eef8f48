"""Tree classifiers, scoring and evaluation.

Training is Spark ML (level-wise distributed histogram aggregation). Histogram
memory per node is features x bins x classes, so ``maxBins`` is sized from the
fitted category counts (6700 in the original, whose widest column had that many).
A column with more categories is indexed by a join, so its labels stay off the
driver; trees split it as categories all the same. The caller may list it as
``ordered``, which feeds its frequency rank as an ordered number, or set a limit
(``most_bins``). A column never changes its meaning because the data grew.

Evaluation is computed from the (label, prediction) confusion table with
DataFrame aggregations: the confusion table has at most classes^2 rows, so the
metric is exact and never collects predictions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import (DecisionTreeClassificationModel, DecisionTreeClassifier,
                                       RandomForestClassificationModel, RandomForestClassifier)
from pyspark.ml.feature import SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeflow import constants as K
from citeflow.operators.compiled import CompiledModel, compiled
from citeflow.operators.features import (feature_assembler, frequency_index, index_name,
                                         label_counts, label_names)
from citeflow.operators.joined_index import JoinedIndexer
from citeflow.session import scratch_path


def fit_feature_model(train: DataFrame, cols: Sequence[str] = K.CATEGORY_COLUMNS,
                      target: str = K.TARGET,
                      ordered: Sequence[str] = (), most_bins: int | None = None,
                      index_path: str | None = None, features: Sequence[str] = K.FEATURES,
                      joined: Sequence[str] = ()) -> PipelineModel:
    """Fit the category indices on training rows; assemble the 17 features (or ``features``: the
    indices of ``cols`` and numeric columns).

    One distributed frequency-index job covers every column; the table is
    written to the shared folder. Columns become a ``StringIndexerModel`` built
    from their labels (nominal metadata, so trees split them as categories;
    identical to fitting a ``StringIndexer``, without a second pass). With the
    bucket for unseen values such a column has at most ``K.MAX_BINS`` categories;
    one with more becomes ``joined`` (below): the same index, nominal as well. More bins would make the
    learner try all subsets of more columns, at a cost of bins by rows; columns that have too many
    categories for that at ``K.MAX_BINS`` are kept from it (``most_subsets``).
    Where ``most_bins`` is set, a nominal column with more categories raises; so does
    a target with more than ``K.MAX_BINS``. Columns listed as ``ordered`` are indexed by a join
    against the stored table inside a ``SQLTransformer`` (a standard, saveable
    stage, see ``sources.models.save_model``): their labels never pass through
    the driver, and the tree sees their frequency rank as an ordered feature.
    Columns listed as ``joined`` are joined in the same way, and the index column is marked nominal
    (``operators.joined_index``): trees split them as categories, and the driver sees no label of theirs.
    Unseen or null values get the extra last index in both cases.
    """
    spark = train.sparkSession
    path = index_path or scratch_path(spark, "category-index")
    frequency_index(train, list(cols) + [target]).write.mode("overwrite").parquet(path)
    table = spark.read.parquet(path)
    sizes = {r["column_name"]: r["count"] for r in table.groupBy("column_name").count().collect()}
    many = [c for c in cols if categories(sizes.get(c, 0)) > K.MAX_BINS]
    wide = [c for c in cols if c in ordered]
    bins = max([K.MAX_BINS] + [categories(sizes[c]) for c in many if c not in wide])
    apart = [c for c in cols if most_subsets(K.MAX_BINS) < categories(sizes.get(c, 0)) <= most_subsets(bins)]
    nominal = [c for c in cols if (c in joined or c in many or c in apart) and c not in ordered]
    narrow = [c for c in cols if c not in wide and c not in nominal]
    for c, most in [*((c, most_bins) for c in narrow + nominal), (target, most_bins or K.MAX_BINS)]:
        if most is not None and categories(sizes.get(c, 0)) > most:
            raise ValueError(f"column {c} has {sizes[c]} values, more than {most} categories with "
                             "the one for unseen values; list it in `ordered` or raise `most_bins`")
    # labels of the other nominal columns and the target: fewer than MAX_BINS (or most_bins) per column
    labels: dict[str, list] = {c: [] for c in narrow + [target]}
    for r in (table.where(F.col("column_name").isin(narrow + [target]))
              .orderBy("column_name", "idx").collect()):
        labels[r["column_name"]].append(r["value"])
    # ``from_arrays_of_labels`` passes a rectangular Java array and pads shorter
    # label lists with nulls (wrong keep index, a null in the nominal metadata),
    # so one multi-column model is built per label-list length: no padding, and
    # fewer stages to save, load and plan than one model per column.
    by_length: dict[int, list[str]] = {}
    for c in narrow:
        by_length.setdefault(len(labels[c]), []).append(c)
    stages = []
    for group in by_length.values():
        if len(group) == 1:
            stages.append(StringIndexerModel.from_labels(
                labels[group[0]], inputCol=group[0], outputCol=index_name(group[0]), handleInvalid="keep"))
        else:
            stages.append(StringIndexerModel.from_arrays_of_labels(
                [labels[c] for c in group], inputCols=group, outputCols=[index_name(c) for c in group],
                handleInvalid="keep"))
    stages.append(StringIndexerModel.from_labels(labels[target], inputCol=target, outputCol="label",
                                                 handleInvalid="keep"))
    if nominal:
        stages.append(JoinedIndexer(inputCols=nominal, outputCols=[index_name(c) for c in nominal],
                                    sizes=[sizes.get(c, 0) for c in nominal], table=path,
                                    widths=[most_subsets(bins) + 1 if c in apart else categories(sizes.get(c, 0)) for c in nominal]))
    if wide:
        src = path.replace("`", "``")
        outs, joins = [], []
        for i, c in enumerate(wide):
            joins.append(f"LEFT JOIN (SELECT value, idx FROM parquet.`{src}` WHERE column_name = '{c}') "
                         f"w{i} ON CAST(t.`{c}` AS STRING) = w{i}.value")
            outs.append(f"coalesce(w{i}.idx, CAST({sizes[c]} AS DOUBLE)) AS {index_name(c)}")
        stages.append(SQLTransformer(
            statement=f"SELECT t.*, {', '.join(outs)} FROM __THIS__ t {' '.join(joins)}"))
    return PipelineModel(stages=stages + [feature_assembler(features)])


def categories(labels: int) -> int:
    """Categories of a nominal column: its labels and the bucket for unseen values."""
    return labels + 1


def most_subsets(bins: int) -> int:
    """Categories up to which Spark's trees try every subset of a nominal column (more are ordered by impurity)."""
    return (bins // 2 + 1).bit_length()


def max_bins(feature_model: PipelineModel, floor: int = 32) -> int:
    """One bin per category of the widest nominal column."""
    return max([floor] + [categories(n) for n in label_counts(feature_model).values()])


def forest(feature_model: PipelineModel, num_trees: int = K.FOREST_TREES,
           max_depth: int = K.TREE_DEPTH, seed: int = 42, max_memory_mb: int = 128,
           bootstrap: bool = True, subset: str = "auto") -> RandomForestClassifier:
    """Forest with the original settings (gini, auto subset, bootstrap) unless told otherwise."""
    return RandomForestClassifier(labelCol="label", featuresCol="features", numTrees=num_trees,
                                  maxDepth=max_depth, maxBins=max_bins(feature_model),
                                  seed=seed, maxMemoryInMB=max_memory_mb, bootstrap=bootstrap,
                                  featureSubsetStrategy=subset)


def tree(feature_model: PipelineModel, max_depth: int = K.TREE_DEPTH, seed: int = 42,
         max_memory_mb: int = 128) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(labelCol="label", featuresCol="features", maxDepth=max_depth,
                                  maxBins=max_bins(feature_model), seed=seed,
                                  maxMemoryInMB=max_memory_mb)


def train_models(train: DataFrame, feature_model: PipelineModel, estimators) -> list[PipelineModel]:
    """Fit several estimators on one featurization of the training rows; each
    result is features + model as one ``PipelineModel`` (the unit that is saved
    and reused by batch and stream).

    The featurized rows are persisted (memory, spilling to disk) for the fits'
    passes and released afterwards; a lost block is recomputed from lineage,
    which is deterministic (key split, fitted indexers).
    """
    feats = feature_model.transform(train).select("features", "label").persist()
    try:
        fitted = [est.fit(feats) for est in estimators]
    finally:
        feats.unpersist()
    return [PipelineModel(stages=list(feature_model.stages) + [m]) for m in fitted]


def train_model(train: DataFrame, feature_model: PipelineModel, estimator) -> PipelineModel:
    return train_models(train, feature_model, [estimator])[0]


def index_rows(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``df`` with the columns that the model's vector is assembled from, the vector left out."""
    return PipelineModel(stages=[s for s in model.stages[:-1] if not isinstance(s, VectorAssembler)]).transform(df)


def compiled_parts(model: PipelineModel) -> CompiledModel:
    """The model's classifier as expressions over those columns."""
    return compiled(model.stages[-1], next(s.getInputCols() for s in model.stages if isinstance(s, VectorAssembler)))


def score(model: PipelineModel, df: DataFrame, target_class: int = K.TARGET_CLASS,
          decode: bool = True, compile_trees: bool = True) -> DataFrame:
    """Batch (or stream) scoring: prediction, class probability and label text.

    The classifier runs as Catalyst expressions over the index columns (``operators.compiled``), whatever
    the size of the input; with ``compile_trees=False`` the model itself scores assembled vectors, row by
    row. The numbers are the same to the bit."""
    if compile_trees and isinstance(model.stages[-1], (DecisionTreeClassificationModel, RandomForestClassificationModel)):
        out = compiled_parts(model).transform(index_rows(model, df))
        # as the assembler does: a null feature is an error
        none = F.raise_error(F.lit("a feature of a row to score is null")).cast("double")
        out = out.withColumn("prediction", F.coalesce("prediction", none))
        probs = F.col("probabilities")
    else:
        out = model.transform(df)
        probs = vector_to_array("probability")
    out = out.withColumn("p_target", F.try_element_at(probs, F.lit(target_class + 1)))
    if decode:
        from citeflow.functions.text import decode_label
        out = out.withColumn("predicted_label", decode_label("prediction", label_names(model)))
    return out


def classification_metrics(pred: DataFrame, label_col: str = "label",
                           prediction_col: str = "prediction", digits: int = 10) -> DataFrame:
    """accuracy, weighted precision / recall / F1 (and error = 1 - value).

    Weighted over the classes present in the label column, like Spark's
    ``MulticlassMetrics``; the F1 is what the original printed as "Accuracy".
    """
    conf = pred.groupBy(F.col(label_col).alias("y"), F.col(prediction_col).alias("p")) \
        .agg(F.count(F.lit(1)).alias("n"))
    # each confusion cell counts once for its true class and once for its
    # predicted class; one grouping gives actual, true-positive and predicted
    # counts per class (a class only ever predicted gets weight 0 below)
    zero = F.lit(0).cast("long")
    roles = conf.select(F.explode(F.array(
        F.struct(F.col("y").alias("c"), F.col("n").alias("actual"),
                 F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(zero).alias("tp"),
                 zero.alias("predicted")),
        F.struct(F.col("p").alias("c"), zero.alias("actual"), zero.alias("tp"),
                 F.col("n").alias("predicted")))).alias("r")).select("r.*")
    per = roles.groupBy("c").agg(F.sum("actual").alias("actual"), F.sum("tp").alias("tp"),
                                 F.sum("predicted").alias("predicted"))
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(F.lit(0.0))
    rec = F.when(F.col("actual") > 0, F.col("tp") / F.col("actual")).otherwise(F.lit(0.0))
    per = per.withColumns({"precision": prec, "recall": rec})
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))) \
        .otherwise(F.lit(0.0))
    per = per.withColumn("f1", f1)
    total = F.sum("actual")
    wide = per.agg(
        (F.sum("tp") / total).alias("accuracy"),
        (F.sum(F.col("precision") * F.col("actual")) / total).alias("weightedPrecision"),
        (F.sum(F.col("recall") * F.col("actual")) / total).alias("weightedRecall"),
        (F.sum(F.col("f1") * F.col("actual")) / total).alias("f1"),
    )
    long = wide.selectExpr("stack(4, 'f1', f1, 'accuracy', accuracy, 'weightedPrecision', "
                           "weightedPrecision, 'weightedRecall', weightedRecall) as (metric, value)")
    return long.select("metric", F.round("value", digits).alias("value"),
                       F.round(1.0 - F.col("value"), digits).alias("error"))
