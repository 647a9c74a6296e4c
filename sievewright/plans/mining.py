"""Pattern mining and incremental assignment as runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import patterns as P
from ..tables import cut


def reduced(vectors: DataFrame, dim: int) -> DataFrame:
    """Vectors of more than ``dim`` values by their principal components; others as they are."""
    size = vectors.agg(F.max(F.size("embedding"))).first()[0] or 0
    if size <= dim:
        return vectors
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array

    rows = vectors.withColumn("v", array_to_vector(F.col("embedding").cast("array<double>")))
    model = PCA(k=dim, inputCol="v", outputCol="r").fit(rows)
    return model.transform(rows).select("id", vector_to_array("r").cast("array<float>").alias("embedding"))


def mine(problems: DataFrame, min_cluster_size: int = 10, noise: float | None = 0.75, dim: int = 64) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(patterns, assignments, metrics) of problems(id, ord, title, tags, difficulty, embedding)."""
    vectors = problems.select("id", "embedding")
    labels = P.cluster(reduced(vectors, dim), min_cluster_size)
    if noise is not None:
        labels = P.reassign_noise(vectors, labels, noise)
    labels = cut(labels, "labels")
    return P.summarize(problems.join(labels, "id")), P.initial_assignments(labels), P.mining_metrics(labels)
