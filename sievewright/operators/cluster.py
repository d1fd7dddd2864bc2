"""Clusters of vectors and how well each row fits its own."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F

CLUSTERS = 5


def kmeans(
    df: DataFrame, vector: str = "embedding", k: int = CLUSTERS, seed: int = 42, target: str = "cluster"
) -> tuple[DataFrame, list[list[float]]]:
    """Every row with its cluster and ``distance`` to the centre, and the ``k`` centres.

    Rows without a vector belong to no cluster: both columns are null.
    """
    values = F.col(vector).cast("array<double>")
    model = KMeans(k=k, seed=seed, featuresCol="__vector", predictionCol="__cluster").fit(
        df.where(F.col(vector).isNotNull()).select(array_to_vector(values).alias("__vector"))
    )
    centres = [[float(x) for x in c] for c in model.clusterCenters()]
    return with_nearest(df, centres, vector, target), centres


def with_nearest(df: DataFrame, centres: list[list[float]], vector: str = "embedding", target: str = "cluster") -> DataFrame:
    """The nearest of a few centres and the distance to it, the lowest number on ties; one
    projection without a shuffle."""
    squares = F.array(
        *[
            F.aggregate(
                F.zip_with(F.col(vector), F.array(*map(F.lit, c)), lambda x, y: (x.cast("double") - y) * (x.cast("double") - y)),
                F.lit(0.0),
                lambda s, d: s + d,
            )
            for c in centres
        ]
    )
    nearest = F.array_min(F.col("__squares"))
    return df.withColumn("__squares", F.when(F.col(vector).isNotNull(), squares)).withColumns(
        {target: (F.array_position("__squares", nearest) - 1).cast("int"), "distance": F.sqrt(nearest)}
    ).drop("__squares")
