"""Random Fourier features: an explicit map whose inner products approximate the RBF kernel."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def projection(inputs: int, size: int, gamma: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and phases of the map."""
    rng = np.random.default_rng(seed)
    return rng.normal(0.0, np.sqrt(2 * gamma), (inputs, size)), rng.uniform(0.0, 2 * np.pi, size)


class _Kernel(Params):
    inputCol = Param(Params._dummy(), "inputCol", "vector column", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "mapped vector column", TypeConverters.toString)
    gamma = Param(Params._dummy(), "gamma", "'scale', 'auto' or a number", TypeConverters.toString)
    dimensions = Param(Params._dummy(), "dimensions", "size of the mapped vector", TypeConverters.toInt)
    inputs = Param(Params._dummy(), "inputs", "size of the input vector", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "seed of the projection", TypeConverters.toInt)


class RandomFourierModel(Model, _Kernel, DefaultParamsReadable, DefaultParamsWritable):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        get = self.getOrDefault
        size, inputs, gamma = get(self.dimensions), get(self.inputs), float(get(self.gamma))
        weights, phases = projection(inputs, size, gamma, get(self.seed))

        # a matrix product per Arrow batch; Spark has no column function for it
        @F.pandas_udf("array<double>")
        def project(vectors: pd.Series) -> pd.Series:
            if not len(vectors):
                return pd.Series([], dtype=object)
            x = np.stack(vectors.to_numpy())
            return pd.Series(list(np.sqrt(2.0 / size) * np.cos(x @ weights + phases)))

        return dataset.withColumn(get(self.outputCol), array_to_vector(project(vector_to_array(get(self.inputCol)))))


class RandomFourierFeatures(Estimator, _Kernel, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, *, inputCol="features", outputCol="kernel", gamma="scale", dimensions=256, seed=42):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol, gamma=gamma, dimensions=dimensions, seed=seed)

    def _fit(self, dataset: DataFrame) -> RandomFourierModel:
        get = self.getOrDefault
        vector = F.col(get(self.inputCol))
        row = dataset.select(
            Summarizer.mean(vector).alias("mean"), Summarizer.normL2(vector).alias("norm"), Summarizer.count(vector).alias("n")
        ).first()
        mean, inputs = row["mean"].toArray(), row["mean"].size
        if get(self.gamma) == "scale":
            # variance over all cells of the feature matrix
            second = float((row["norm"].toArray() ** 2).sum()) / (row["n"] * inputs)
            variance = second - float(mean.mean()) ** 2
            gamma = 1.0 / (inputs * variance) if variance > 0 else 1.0
        elif get(self.gamma) == "auto":
            gamma = 1.0 / inputs
        else:
            gamma = float(get(self.gamma))
        model = RandomFourierModel()
        model._set(
            inputCol=get(self.inputCol),
            outputCol=get(self.outputCol),
            gamma=repr(gamma),
            dimensions=get(self.dimensions),
            inputs=inputs,
            seed=get(self.seed),
        )
        return model
