"""Feature table -> imputed, scaled, clustered and explained entities."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from inciscope import config
from inciscope.operators import clustering
from inciscope.operators.stats import impute_median, zscore
from inciscope.session import materialise


@dataclass(frozen=True)
class Segments:
    scores: DataFrame | None
    labelled: DataFrame
    profiles: DataFrame
    insights: DataFrame
    projected: DataFrame
    explained: list[float]


def segment(
    features: DataFrame,
    id_col: str,
    cols: Sequence[str] = tuple(config.CLUSTER_FEATURES),
    k: int | None = None,
    n_init: int = config.FINAL_RESTARTS,
    sweep_restarts: int = config.SWEEP_RESTARTS,
    sweep: Sequence[int] = tuple(range(2, 11)),
) -> Segments:
    """Cluster entities on scaled features; without ``k`` the sweep's best silhouette decides."""
    filled = materialise(impute_median(features.select(id_col, *cols), cols), "filled")
    scaled = materialise(zscore(filled, cols), "scaled")
    scores = None
    if k is None:
        scores = clustering.sweep_k(scaled, id_col, cols, sweep, n_init=sweep_restarts)
        k = scores.filter("best_silhouette").first()["k"]
    clustered = materialise(clustering.kmeans(scaled, cols, k, n_init=n_init)[0], "clustered")
    labelled = features.join(clustered.select(id_col, "cluster"), id_col)
    projected, explained = clustering.pca(clustered, cols)
    return Segments(
        scores,
        labelled,
        clustering.cluster_profiles(labelled, cols, "cluster"),
        clustering.cluster_insights(labelled, "cluster"),
        projected.select(id_col, "cluster", "pc1", "pc2"),
        explained,
    )
