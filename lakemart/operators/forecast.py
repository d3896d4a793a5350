"""One-week-ahead forecast with Spark ML (no rows pass through the driver).

The model input is the feature mart: one row per week x species x area,
so it stays small however large the landings grow. It is checkpointed to
the shared checkpoint folder before fitting, which cuts the lineage back to
the landings: the many passes of tree growing, and any executor lost during
them, re-read that small table instead of recomputing the whole mart.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.functions import abs_error
from lakemart.operators.features import ORDER, TARGET


@dataclass(frozen=True)
class ForestParams:
    """Random forest settings of the reference (min split size has no Spark twin)."""
    num_trees: int = 250
    max_depth: int = 12
    min_instances_per_node: int = 4
    feature_subset: str = "0.5"
    seed: int = 42
    max_memory_mb: int = 512


def forest_pipeline(features: Sequence[str], params: ForestParams = ForestParams(),
                    encode_species: bool = False) -> Pipeline:
    """Assembler (+ optional species indexer/one-hot) and random forest. A species
    that the training rows lack has a column of its own, always 0 in training."""
    stages = []
    inputs = list(features)
    if encode_species:
        stages += [StringIndexer(inputCol="species_id_text", outputCol="species_idx", stringOrderType="alphabetAsc", handleInvalid="keep"),
                   OneHotEncoder(inputCols=["species_idx"], outputCols=["species_vec"], dropLast=False)]
        inputs.append("species_vec")
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="error"))
    stages.append(RandomForestRegressor(
        featuresCol="features", labelCol=TARGET, predictionCol="predicted_kg",
        numTrees=params.num_trees, maxDepth=params.max_depth,
        minInstancesPerNode=params.min_instances_per_node, featureSubsetStrategy=params.feature_subset,
        seed=params.seed, maxMemoryInMB=params.max_memory_mb, cacheNodeIds=True, checkpointInterval=10))
    return Pipeline(stages=stages)


def with_species_text(df: DataFrame) -> DataFrame:
    return df.withColumn("species_id_text", F.col("species_id").cast("string"))


#: Partitions of the training rows. Spark seeds tree bagging per partition, so
#: a fixed number and order make the model the same on any cluster.
TRAIN_PARTITIONS = 8


def fit(train: DataFrame, features: Sequence[str], params: ForestParams = ForestParams(),
        encode_species: bool = False) -> PipelineModel:
    """Fits on the rows hashed by series and week into a fixed number of sorted
    partitions; the layout is checkpointed and kept for the passes of tree growing."""
    if encode_species:
        train = with_species_text(train)
    rows = (train.repartition(TRAIN_PARTITIONS, "species_code", "area_code", ORDER)
            .sortWithinPartitions("species_code", "species_name", "area_code", "area_name", ORDER).checkpoint(eager=True).persist())
    try:
        return forest_pipeline(features, params, encode_species).fit(rows)
    finally:
        rows.unpersist()


def predict(model: PipelineModel, test: DataFrame, encode_species: bool = False) -> DataFrame:
    if encode_species:
        test = with_species_text(test)
    return model.transform(test)


def predictions(scored: DataFrame) -> DataFrame:
    """Keys, actual, predicted and absolute error per holdout row."""
    return scored.select("week_start", "target_week", "species_code", "species_name", "area_code", "area_name",
                         "target_kg", "predicted_kg", abs_error("target_kg", "predicted_kg").alias("abs_error_kg"))


def importances(model: PipelineModel, features: Sequence[str], like: DataFrame) -> DataFrame:
    """Features by importance, largest first (one row per feature; the list is
    as long as the feature vector, not the data)."""
    values = model.stages[-1].featureImportances.toArray().tolist()
    names = list(features) + [f"species_vec_{i}" for i in range(len(values) - len(features))]
    rows = [(n, float(v)) for n, v in zip(names, values)]
    return (like.sparkSession.createDataFrame(rows, "feature string, importance double")
            .orderBy(F.desc("importance"), "feature"))


def species_levels(train: DataFrame) -> DataFrame:
    """Species levels learnt by the indexer, in index order."""
    indexer = StringIndexer(inputCol="species_id_text", outputCol="species_idx",
                            stringOrderType="alphabetAsc").fit(with_species_text(train))
    rows = [(i, lbl) for i, lbl in enumerate(indexer.labels)]
    return train.sparkSession.createDataFrame(rows, "idx int, species_id string")
