"""Distributed model training on the feature table's own split."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import partial, reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.operators.features import numeric_features
from cohortloom.operators.prep import impute_median, standardise
from cohortloom.sources.lake import materialise

NOT_FEATURES = (
    "hadm_id", "subject_id", "label", "split", "etl_run_id", "_run_id", "_loaded_at", "_source",
    "split_bucket", "ecg_path", "ecg_study_id", "admittime", "dischtime", "gender",
    "cohort_group", "feature_count",
)
SEED = 42


#: The deepest trees that MLlib grows.
DEEPEST = 30
#: Nodes of a forest that the driver may have to hold at once, and rows that a leaf has at least.
MOST_NODES, LEAF_ROWS = 1_000_000, 3
#: Training rows times trees of a part, where its trees turn out small: for each of them the
#: executors hold a count and a node number.
MOST_DRAWS = 20_000_000
#: Between the seeds of a forest's parts; MLlib adds the number of the partition to them.
SEED_STEP = 1_000_003


def classifiers(train_rows: int, seed: int = SEED, trees: int = 300, rounds: int = 100,
                depth: int = DEEPEST) -> dict:
    """Settings as close as MLlib allows to the usual single-machine defaults.

    ``depth`` bounds the trees of the forest; the default bounds nothing that MLlib can grow.
    """
    common = {"featuresCol": "features", "labelCol": "label"}
    return {
        "logistic_regression": LogisticRegression(
            maxIter=2000, regParam=1.0 / max(train_rows, 1), standardization=False, **common
        ),
        "random_forest": RandomForestClassifier(
            numTrees=trees, minInstancesPerNode=LEAF_ROWS, maxDepth=depth, seed=seed,
            cacheNodeIds=True, **common
        ),
        "gradient_boosting": GBTClassifier(
            maxIter=rounds, maxDepth=3, stepSize=0.1, seed=seed, **common
        ),
    }


def feature_names(df: DataFrame, exclude: Iterable[str] = NOT_FEATURES) -> list[str]:
    return numeric_features(df, exclude).columns


def prepare(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Impute and scale with training statistics, then assemble the vector.

    A feature without one training value has no median; it is left out.
    """
    train = F.col("split") == "train"
    numeric = df.select(
        "subject_id", "split", F.col("label").cast("double").alias("label"),
        *[F.col(f"`{c}`").cast("double").alias(c) for c in features],
    )
    ready = standardise(impute_median(numeric, features, train), features, train)
    return VectorAssembler(inputCols=list(features), outputCol="features").transform(ready).select(
        "subject_id", "split", "label", "features"
    )


def forest_parts(trees: int, train_rows: int) -> list[int]:
    """Numbers of trees that are grown one part after the other, ``trees`` in all.

    A tree has at most two nodes for each leaf, so no part has more than ``MOST_NODES``
    unless one tree has. A forest below that is one part.
    """
    at_once = max(1, MOST_NODES // max(1, 2 * train_rows // LEAF_ROWS))
    return [min(at_once, trees - done) for done in range(0, trees, at_once)]


def small_trees(train_rows: int, grown: int, nodes: int) -> int:
    """Trees of a part, by those ``grown`` before, which have so many ``nodes`` together.

    Trees of one forest are about as large, so a part of twice their mean fits. Every part
    reads the training rows once for each level: few large parts take less time.
    """
    return min(MOST_NODES * grown // (2 * nodes), MOST_DRAWS // max(1, train_rows))


def second_class() -> Column:
    return F.get(vector_to_array("probability"), F.lit(1))


def forest_scores(forest: RandomForestClassifier, train: DataFrame, rows: DataFrame,
                  train_rows: int) -> DataFrame:
    """``rows`` with the forest's ``score``, the mean over all its trees.

    Trees grow with the training rows and MLlib keeps a model at the driver. A large
    forest is grown in parts: each adds its trees' votes to the stored rows and is let
    go, so that the driver holds one part however many rows there are. The first part
    is as large as any trees allow; the next ones have more trees, if these are small.
    """
    trees, seed = forest.getNumTrees(), forest.getSeed()
    parts = forest_parts(trees, train_rows)
    if len(parts) == 1:
        return forest.fit(train).transform(rows).withColumn("score", second_class())
    voted = rows.withColumn("_votes", F.lit(0.0))
    i = grown = nodes = 0
    while grown < trees:
        most = max(parts[0], small_trees(train_rows, grown, nodes) if grown else 0)
        n = min(most, trees - grown)
        part = forest.copy({forest.numTrees: n, forest.seed: seed + i * SEED_STEP}).fit(train)
        i, grown, nodes = i + 1, grown + n, nodes + part.totalNumNodes
        votes = (F.col("_votes") + n * second_class()).alias("_votes")
        voted = materialise(part.transform(voted).select(*rows.columns, votes), "forest-votes")
        del part
    return voted.withColumn("score", F.col("_votes") / trees)


def train_classifiers(df: DataFrame, features: Sequence[str] | None = None, *,
                      seed: int = SEED, trees: int = 300, rounds: int = 100,
                      depth: int = DEEPEST) -> DataFrame:
    """Scored validation and test rows of every model: model, split, label, score.

    The stored split is used as it is. The prepared rows are written once; every
    model fits on a cache over that table, which is rebuilt from it when an
    executor is lost. The models are fitted side by side: boosting is many short
    jobs, which leave most cores to the forest. A forest that may have more than
    ``MOST_NODES`` is grown in parts.
    """
    names = list(features or feature_names(df))
    train_rows = df.where("split = 'train'").agg(
        F.count(F.lit(1)), *[F.count(F.col(f"`{c}`")) for c in names]
    ).first()
    usable = [c for c, n in zip(names, train_rows[1:], strict=True) if n > 0]
    rows = materialise(prepare(df, usable), "training-rows")
    train = rows.where("split = 'train'").persist()
    held_out = rows.where("split in ('validation', 'test')")

    def judge(name: str, estimator) -> DataFrame:
        if name == "random_forest":
            judged = forest_scores(estimator, train, held_out, train_rows[0])
        else:
            judged = estimator.fit(train).transform(held_out).withColumn("score", second_class())
        return judged.select(
            F.lit(name).alias("model_name"), "split", "subject_id",
            F.col("label").cast("int").alias("label"), "score",
        )

    # Each task is wrapped by itself: the wrapper holds the local properties of its thread.
    tasks = [
        inheritable_thread_target(df.sparkSession)(partial(judge, name, estimator))
        for name, estimator in classifiers(train_rows[0], seed, trees, rounds, depth).items()
    ]
    with ThreadPool(len(tasks)) as pool:
        scored = pool.map(lambda task: task(), tasks)
    train.unpersist()
    return reduce(DataFrame.unionByName, scored)
