"""Principal components."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA, StandardScaler, StandardScalerModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.linalg import Vectors
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Components kept, and the variance share asked of the component count.
N_COMPONENTS = 50
TARGET_VARIANCE = 0.9


@dataclass(frozen=True)
class Components:
    """Loadings (features x k) and the variance share of each component."""

    loadings: np.ndarray
    share: np.ndarray


def fit_pca(
    cells: DataFrame, vec: str = "vec", k: int = N_COMPONENTS, covariance_width: int = 4096
) -> tuple[Components, DataFrame]:
    """Components of mean-centred vectors, and ``cells`` with an ``X_pca`` array.

    Up to ``covariance_width`` features the features^2 covariance matrix is small enough for the
    driver.  Wider vectors use the distributed singular value decomposition, which only moves
    vectors of the width of one row.
    """
    as_vector = cells.withColumn("_raw", array_to_vector(F.col(vec).cast("array<double>")))
    scaler = StandardScaler(withMean=True, withStd=False, inputCol="_raw", outputCol="_centred")
    scaled = scaler.fit(as_vector)
    centred = scaled.transform(as_vector)
    if scaled.mean.size <= covariance_width:
        model = PCA(k=k, inputCol="_centred", outputCol="_pca").fit(centred)
        found = Components(model.pc.toArray(), model.explainedVariance.toArray())
        scores = model.transform(centred).withColumn("X_pca", vector_to_array("_pca"))
        return found, scores.drop("_raw", "_centred", "_pca")
    found = _wide_components(centred, scaled, k)
    return found, _project(cells, vec, found, scaled.mean.toArray())


def _wide_components(centred: DataFrame, scaled: StandardScalerModel, k: int) -> Components:
    rows = centred.select(vector_to_array("_centred").alias("v")).rdd.map(lambda r: Vectors.dense(r.v))
    svd = RowMatrix(rows.cache()).computeSVD(k)
    variance = svd.s.toArray() ** 2 / (centred.count() - 1)
    return Components(svd.V.toArray(), variance / (scaled.std.toArray() ** 2).sum())


def _project(cells: DataFrame, vec: str, found: Components, mean: np.ndarray) -> DataFrame:
    shared = cells.sparkSession.sparkContext.broadcast((found.loadings, mean))

    def project(v: pd.Series) -> pd.Series:
        loadings, mean = shared.value
        return pd.Series(list((np.stack(v.to_numpy()) - mean) @ loadings))

    scored = F.pandas_udf(project, T.ArrayType(T.DoubleType()))
    return cells.withColumn("X_pca", scored(F.col(vec).cast("array<double>")))


def loadings_table(found: Components, spark: SparkSession) -> DataFrame:
    """The loading matrix as a table, one row per feature."""
    return spark.createDataFrame(list(enumerate(found.loadings.tolist())), "feature int, vec array<double>")


def explained(found: Components, spark: SparkSession) -> DataFrame:
    """Variance share and running share, one row per component."""
    rows = [(i + 1, float(v)) for i, v in enumerate(found.share)]
    upto = Window.orderBy("component").rowsBetween(Window.unboundedPreceding, 0)
    return spark.createDataFrame(rows, "component int, share double").withColumn(
        "running", F.sum("share").over(upto)
    )


def n_components(table: DataFrame, target: float = TARGET_VARIANCE, vec: str = "vec") -> DataFrame:
    """Smallest number of components of ``table`` that explain ``target`` of its variance."""
    width = table.select(F.size(vec).alias("n")).first()["n"]
    found, _ = fit_pca(table, vec, width)
    return explained(found, table.sparkSession).filter(F.col("running") >= target - 1e-12).agg(
        F.min("component").alias("n_components")
    )
