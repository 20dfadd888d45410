"""Partition clustering of sellers, the Davies-Bouldin index and feature weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.functions.scaling import standardize
from marketlens.rules import MODEL_FEATURES, SELLER_FEATURES


def standardized_vectors(df: DataFrame, columns: Sequence[str], into: str = "features") -> DataFrame:
    """Add standardized columns ``z_*`` and the vector of them."""
    scaled = standardize(df, columns)
    return VectorAssembler(inputCols=[f"z_{c}" for c in columns], outputCol=into).transform(scaled)


def _fit(vectors: DataFrame, k: int, seed: int) -> KMeansModel:
    # The tolerance bounds the move of each centre; 0.003 on unit variance is
    # about a total squared shift of 1e-4.
    return KMeans(k=k, seed=seed, maxIter=300, tol=0.003, predictionCol="cluster").fit(vectors)


def kmeans_label(vectors: DataFrame, k: int = 4, seed: int = 42) -> tuple[DataFrame, KMeansModel]:
    """Sellers with a cluster; cluster numbers carry no meaning."""
    model = _fit(vectors, k, seed)
    return model.transform(vectors), model


def cluster_means(
    labelled: DataFrame, columns: Sequence[str] = SELLER_FEATURES, cluster: str = "cluster",
) -> DataFrame:
    """Mean of the raw features per cluster."""
    return labelled.groupBy(cluster).agg(*[F.avg(c).alias(c) for c in columns])


def _distance(a: Sequence[Column], b: Sequence[Column]) -> Column:
    return F.sqrt(sum(((x - y) * (x - y) for x, y in zip(a, b)), F.lit(0.0)))


def davies_bouldin(labelled: DataFrame, columns: Sequence[str], cluster: str = "cluster") -> DataFrame:
    """Davies-Bouldin index, one row: lower means tighter, better separated clusters.

    Points are reduced to one row per cluster before clusters are compared.
    """
    centres = labelled.groupBy(cluster).agg(*[F.avg(c).alias(f"_c{i}") for i, c in enumerate(columns)])
    own = _distance([F.col(c) for c in columns], [F.col(f"_c{i}") for i in range(len(columns))])
    # One row per cluster is broadcast.
    spread = labelled.join(F.broadcast(centres), cluster).groupBy(cluster).agg(
        F.avg(own).alias("spread"),
        F.array(*[F.first(f"_c{i}") for i in range(len(columns))]).alias("centre"),
    )
    clusters = spread.agg(F.collect_list(F.struct(cluster, "spread", "centre")).alias("all"))

    def similarity(a: Column, b: Column) -> Column:
        gap = F.sqrt(F.aggregate(
            F.zip_with(a["centre"], b["centre"], lambda x, y: (x - y) * (x - y)),
            F.lit(0.0), lambda acc, x: acc + x,
        ))
        return F.try_divide(a["spread"] + b["spread"], gap)

    worst = F.transform(
        F.col("all"),
        lambda a: F.array_max(F.transform(
            F.filter(F.col("all"), lambda b: b[cluster] != a[cluster]), lambda b: similarity(a, b)
        )),
    )
    total = F.aggregate(worst, F.lit(0.0), lambda acc, x: acc + F.coalesce(x, F.lit(0.0)))
    return clusters.select(F.try_divide(total, F.size("all")).alias("davies_bouldin"))


def feature_importance(
    labelled: DataFrame, columns: Sequence[str] = MODEL_FEATURES, cluster: str = "cluster",
    trees: int = 100, seed: int = 42, max_rows: int = 200_000, depth: int = 20,
) -> DataFrame:
    """Weight of each feature in telling the clusters apart: (feature, importance).

    Trees are at most ``depth`` deep and fitted on at most ``max_rows`` rows, those
    of the smallest hash of their values.
    """
    columns = list(columns)
    labelled = labelled.orderBy(F.xxhash64(*columns, cluster), *columns, cluster).limit(max_rows)
    assembled = VectorAssembler(inputCols=list(columns), outputCol="_features").transform(
        labelled.select(*columns, F.col(cluster).cast("double").alias("_label"))
    )
    # Remembering each row's node saves walking trees from the root at every level.
    forest = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, featureSubsetStrategy="sqrt", seed=seed, cacheNodeIds=True,
        featuresCol="_features", labelCol="_label",
    ).fit(assembled)
    return labelled.sparkSession.createDataFrame(
        list(zip(columns, forest.featureImportances.toArray().tolist())),
        "feature string, importance double",
    )
