"""Model persistence: a fitted ``PipelineModel`` or a bare classifier, complete in itself."""

from __future__ import annotations

import re

from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import DecisionTreeClassificationModel, RandomForestClassificationModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import SparkSession

from citeflow.operators.joined_index import JoinedIndexer
from citeflow.sources.tables import resolve_path

INDEX_TABLE = re.compile(r"parquet\.`((?:[^`]|``)+)`")


def save_model(model: Model, path: str) -> str:
    """Overwrites ``path``. The index tables that a model joins with (see ``fit_feature_model``) are
    written beside it, below ``<path>-tables``, and the saved model names those, so it outlives
    the scratch folder."""
    target = resolve_path(path)
    if isinstance(model, PipelineModel):
        spark = SparkSession.getActiveSession()
        moved: dict[str, str] = {}
        stages = []

        def kept(source: str) -> str:
            if source not in moved:
                moved[source] = f"{target}-tables/{len(moved)}"
                spark.read.parquet(source.replace("``", "`")).write.mode("overwrite").parquet(moved[source])
            return moved[source]

        for stage in model.stages:
            if isinstance(stage, JoinedIndexer):
                stage = stage.copy({stage.table: kept(stage.getOrDefault("table"))})
            if isinstance(stage, SQLTransformer):
                stage = SQLTransformer(statement=INDEX_TABLE.sub(
                    lambda m: "parquet.`" + kept(m[1]).replace("`", "``") + "`", stage.getStatement()))
            stages.append(stage)
        model = PipelineModel(stages=stages)
    model.write().overwrite().save(target)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(resolve_path(path))


def load_forest(path: str) -> RandomForestClassificationModel:
    """A forest that was saved on its own; ``score_messages(labels=...)`` names its classes."""
    return RandomForestClassificationModel.load(resolve_path(path))


def load_tree(path: str) -> DecisionTreeClassificationModel:
    return DecisionTreeClassificationModel.load(resolve_path(path))
