"""Feature scaling (A5, M4, M5) on MLlib's StandardScaler.

MLlib uses the sample standard deviation and maps a zero-variance feature
to 0; scikit-learn's scaler uses the population deviation.  The ratio is
sqrt((n-1)/n), negligible at the data sizes this runs on.
"""

from __future__ import annotations

from pyspark.ml.feature import StandardScaler, StandardScalerModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class ArrayScaler:
    """A fitted scaler that reads an ARRAY column and writes a vector column."""

    def __init__(self, model: StandardScalerModel, array_col: str):
        self.model = model
        self.array_col = array_col

    def transform(self, df: DataFrame) -> DataFrame:
        vec = self.model.getInputCol()
        return self.model.transform(
            df.withColumn(vec, array_to_vector(F.col(self.array_col)))).drop(vec)

    @property
    def mean(self):
        return self.model.mean.toArray()

    @property
    def std(self):
        return self.model.std.toArray()


def fit_scaler(df: DataFrame, array_col: str, out: str, with_mean: bool = True,
               with_std: bool = True) -> ArrayScaler:
    """Fit mean / std over the array entries; the summary is a tree aggregate
    (one partial summary per partition), so its cost is one scan."""
    vec = f"__{out}_vec"
    model = StandardScaler(inputCol=vec, outputCol=out, withMean=with_mean,
                           withStd=with_std).fit(
        df.select(array_to_vector(F.col(array_col)).alias(vec)))
    return ArrayScaler(model, array_col)
