"""Category indexing, feature assembly and the fitted feature stages.

``frequency_index`` computes the frequency-ranked index of every category column
as a distributed table (one scan for all columns): count descending, ties
alphabetical, unseen or null values in the extra last ("keep") bucket.
``operators/models.fit_feature_model`` turns it into fitted indexer stages.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeflow import constants as K
from citeflow.operators.joined_index import JoinedIndexer
from citeflow.operators.sampling import with_row_index
from citeflow.session import ensure_checkpoint_dir


def frequency_index(df: DataFrame, cols: Sequence[str], name_col: str = "column_name",
                    value_col: str = "value") -> DataFrame:
    """(column, value, n, idx) for every non-null value of every column.

    All columns are unpivoted with one ``stack`` and counted in one aggregation
    (partial counts are combined map-side, so the shuffle carries at most one
    row per distinct value and task). The index is the position in the order
    (count descending, value ascending) within the column: a range-partitioned
    sort of the distinct (column, value) pairs, which are all distinct keys, so
    even a column whose values mostly tie (a long tail of count 1) is split
    evenly over tasks instead of landing in one window partition. The sorted
    counts are checkpointed (reliably, in the shared folder) so that partition
    ids are stable for the dense row index; only one start position per column
    is broadcast.
    """
    cells = ", ".join(f"'{c}', cast(`{c}` as string)" for c in cols)
    pairs = (df.selectExpr(f"stack({len(cols)}, {cells}) as ({name_col}, {value_col})")
             .where(F.col(value_col).isNotNull()))
    counts = pairs.groupBy(name_col, value_col).agg(F.count(F.lit(1)).alias("n"))
    ensure_checkpoint_dir(df.sparkSession)
    ordered = counts.orderBy(name_col, F.desc("n"), value_col).checkpoint(eager=True)
    indexed = with_row_index(ordered, "pos")
    starts = indexed.groupBy(name_col).agg(F.min("pos").alias("start"))
    return (indexed.join(F.broadcast(starts), name_col)
            .select(name_col, value_col, "n", (F.col("pos") - F.col("start")).cast("double").alias("idx")))


def index_name(c: str) -> str:
    return f"{c}_index"


def feature_assembler(features: Sequence[str] = K.FEATURES, out: str = "features",
                      handle_invalid: str = "error") -> VectorAssembler:
    """17 features in fixed order. ``handle_invalid='skip'`` drops rows with a
    null feature instead of failing (used on streams)."""
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid=handle_invalid)


def fitted_labels(model: PipelineModel) -> dict[str, list[str]]:
    """Labels per indexed output column, from single- or multi-column indexers."""
    out: dict[str, list[str]] = {}
    for stage in model.stages:
        if not isinstance(stage, StringIndexerModel):
            continue
        if stage.isSet("outputCols"):
            out.update(zip(stage.getOutputCols(), (list(x) for x in stage.labelsArray)))
        else:
            out[stage.getOutputCol()] = list(stage.labels)
    return out


def label_counts(model: PipelineModel, label_col: str = "label") -> dict[str, int]:
    """Number of labels per nominal feature column, indexed by labels or by joins."""
    joined = {c: n for s in model.stages if isinstance(s, JoinedIndexer) for c, n in s.categories().items()}
    return {c: len(v) for c, v in fitted_labels(model).items() if c != label_col} | joined


def label_names(model: PipelineModel, label_col: str = "label") -> list[str]:
    for stage in model.stages:
        if isinstance(stage, StringIndexerModel) and stage.isSet("outputCol") \
                and stage.getOutputCol() == label_col:
            return list(stage.labels)
    raise ValueError("no label indexer in model")
