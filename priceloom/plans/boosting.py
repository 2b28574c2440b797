"""Gradient-boosted tree settings and the Spark ML stages around them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession

from priceloom.operators.metrics import PREDICTION
from priceloom.operators.schema import LOG_TARGET

FEATURES = "features"


@dataclass(frozen=True)
class Booster:
    """Hyper-parameters of one boosted model."""

    max_iter: int
    max_depth: int
    step_size: float
    subsampling_rate: float
    feature_subset: str
    max_bins: int
    min_instances: int = 1
    seed: int = 42
    # How trees are grown, not which: memory for one pass's histograms, node ids
    # kept with the rows, rounds between checkpoints.
    max_memory_mb: int = 256
    cache_node_ids: bool = False
    checkpoint_interval: int = 10

    def with_(self, **changes) -> Booster:
        return replace(self, **changes)

    def bins(self, max_arity: int = 0) -> int:
        """The effective bin count. Trees need at least as many bins as the
        widest nominal feature has values, and the count holds for continuous
        features too; the report shows it."""
        return max(self.max_bins, max_arity)

    def estimator(self, label: str = LOG_TARGET, max_arity: int = 0) -> GBTRegressor:
        """The Spark ML estimator."""
        return GBTRegressor(
            featuresCol=FEATURES,
            labelCol=label,
            predictionCol=PREDICTION,
            maxIter=self.max_iter,
            maxDepth=self.max_depth,
            stepSize=self.step_size,
            subsamplingRate=self.subsampling_rate,
            featureSubsetStrategy=self.feature_subset,
            maxBins=self.bins(max_arity),
            minInstancesPerNode=self.min_instances,
            seed=self.seed,
            maxMemoryInMB=self.max_memory_mb,
            cacheNodeIds=self.cache_node_ids,
            checkpointInterval=self.checkpoint_interval,
        )


# The two published settings.
BASIC = Booster(
    max_iter=100, max_depth=5, step_size=0.05, subsampling_rate=0.8, feature_subset="sqrt", max_bins=32
)
OPTIMIZED = Booster(
    max_iter=150, max_depth=7, step_size=0.03, subsampling_rate=0.7, feature_subset="all", max_bins=40
)


def assembler(inputs: Sequence[str]) -> VectorAssembler:
    """Inputs -> ``features``, in order; rows with null or NaN are skipped."""
    return VectorAssembler(inputCols=list(inputs), outputCol=FEATURES, handleInvalid="skip")


def feature_importances(spark: SparkSession, model: PipelineModel, inputs: Sequence[str]) -> DataFrame:
    """(feature_index, feature, importance) of the pipeline's last stage: one
    row per model input, however many rows the model was trained on."""
    weights = model.stages[-1].featureImportances.toArray()
    rows = [(i, name, float(w)) for i, (name, w) in enumerate(zip(inputs, weights, strict=True))]
    return spark.createDataFrame(rows, "feature_index int, feature string, importance double")
