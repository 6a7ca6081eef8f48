"""Category indices by joins: nominal columns whose labels never pass through the driver.

The fitted state of this stage is the path of the index table (column, value, idx) and the number
of labels of each column. ``transform`` joins each column with its part of the table and marks the index
column as nominal with that many categories and one for unseen values, which is all that the tree
learners read, so they split it as they split the output of a fitted ``StringIndexerModel``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def nominal_metadata(name: str, categories: int) -> dict:
    """ML attribute metadata of a nominal column, by its number of categories alone."""
    return {"ml_attr": {"type": "nominal", "name": name, "num_vals": categories}}


class JoinedIndexer(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``outputCols``: the stored index of each value of ``inputCols``; unseen or null values get
    the number of labels (``sizes``), as with ``handleInvalid='keep'``. ``widths``: the categories that a column
    is marked with, where they shall be more than its labels and the one for unseen values."""

    inputCols = Param(Params._dummy(), "inputCols", "columns to index", TypeConverters.toListString)
    outputCols = Param(Params._dummy(), "outputCols", "index columns", TypeConverters.toListString)
    sizes = Param(Params._dummy(), "sizes", "labels of each column", TypeConverters.toListInt)
    widths = Param(Params._dummy(), "widths", "categories marked on each column", TypeConverters.toListInt)
    table = Param(Params._dummy(), "table", "path of the index table", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] | None = None, outputCols: Sequence[str] | None = None,
                 sizes: Sequence[int] | None = None, table: str | None = None, widths: Sequence[int] | None = None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def categories(self) -> dict[str, int]:
        """Labels of each index column, without the bucket for unseen values."""
        return dict(zip(self.getOrDefault("outputCols"), self.getOrDefault("sizes")))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        table = dataset.sparkSession.read.schema("column_name string, value string, n long, idx double").parquet(self.getOrDefault("table"))
        out = dataset
        widths = self.getOrDefault("widths") if self.isSet("widths") else [n + 1 for n in self.getOrDefault("sizes")]
        for i, (c, name, size) in enumerate(zip(*(self.getOrDefault(p) for p in ("inputCols", "outputCols", "sizes")))):
            # distinct values of one column: the join adds no rows
            part = table.where(F.col("column_name") == c).select(F.col("value").alias(f"_value{i}"), F.col("idx").alias(f"_idx{i}"))
            out = out.join(part, F.col(f"`{c}`").cast("string") == F.col(f"_value{i}"), "left")
            out = (out.withColumn(name, F.coalesce(F.col(f"_idx{i}"), F.lit(float(size)))).drop(f"_value{i}", f"_idx{i}")
                   .withMetadata(name, nominal_metadata(name, widths[i])))
        return out
