"""Per-target model heads fitted and scored with Spark ML.

One logistic head per binary target (positive rows weighted) and one Huber
linear head for the continuous target, each fitted on the rows where its
label is valid. Inputs: the served features in contract order, zero-filled,
plus the ids' hash buckets, one-hot or (``width`` given) hashed into that many places,
so that a head does not grow with the ids. Model selection keeps the regularisation
value with the lowest combined validation loss (D6).

A :class:`Bundle` is what scoring from ids needs, saved as one folder: bucket sizes of
the training split, the encoder and the heads.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import FeatureHasher, OneHotEncoder, OneHotEncoderModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.buckets import bucket_size_map
from ..operators.latest import online_lookup
from ..operators.metrics import combined_loss, to_long
from ..operators.sampling import neg_sample_exact
from ..registry import Registry
from .training import training_table, with_buckets

#: Places for hashed ids: 8 bytes each in every head, which the driver holds.
MAX_WIDTH = 1 << 20


HASHED = "__hashed_ids"
#: Rows that are worth a task of a fit's iteration.
FIT_ROWS = 50_000


@dataclass
class Heads:
    features: list[str]
    categorical: list[str]
    binary: dict
    continuous: dict
    reg_param: float


def _prep(features: Sequence[str], categorical: Sequence[str], width: int | None = None) -> Pipeline:
    """Zero-filled continuous inputs + buckets: one-hot, or hashed into ``width`` places."""
    if width is not None and not 2 <= width <= MAX_WIDTH:
        raise ValueError(f"width must be between 2 and {MAX_WIDTH}, not {width}")
    stages = []
    onehots = []
    if width is not None and categorical:
        stages.append(FeatureHasher(inputCols=list(categorical), outputCol=HASHED, numFeatures=width, categoricalCols=list(categorical)))
        onehots.append(HASHED)
    elif categorical:
        onehots = [f"{c}_oh" for c in categorical]
        stages.append(OneHotEncoder(inputCols=list(categorical), outputCols=onehots, dropLast=False, handleInvalid="keep"))
    stages.append(VectorAssembler(inputCols=[*features, *onehots], outputCol="features", handleInvalid="keep"))
    return Pipeline(stages=stages)


def assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """B5 + B6: served inputs by name in contract order, missing -> 0.0."""
    return df.fillna(0.0, subset=list(features))


def encode(df: DataFrame, prep: PipelineModel, features: Sequence[str], keep: Sequence[str] | None = None) -> DataFrame:
    """``keep`` (default: all columns) and the ``features`` vector of the fitted ``prep``.

    Spark ML names every place of a one-hot vector in its column's metadata: as many
    objects as ids, on the driver for each plan and in each task. So one-hot places are
    set here, from the fitted encoder's sizes: the same vectors, and the column only
    tells how long they are."""
    x = assemble(df, features)
    kept = df.columns if keep is None else list(keep)
    encoders = [s for s in prep.stages if isinstance(s, OneHotEncoderModel)]
    if not encoders:
        return prep.transform(x).select(*kept, "features")
    size, cells = len(features), [F.when(F.col(c) != 0, _cell(F.lit(i), F.col(c).cast("double"))) for i, c in enumerate(features)]
    for encoder in encoders:
        for c, n in zip(encoder.getInputCols(), map(int, encoder.categorySizes)):
            place = F.when(F.col(c).between(0, n - 1), F.col(c).cast("int")).otherwise(F.lit(n))  # the last: none of the fitted rows had it
            cells.append(_cell(F.lit(size) + place, F.lit(1.0)))
            size += n + 1
    cells = F.filter(F.array(*cells), lambda c: c.isNotNull())
    sparse = F.struct(F.lit(0).alias("type"), F.lit(size).alias("size"), cells["i"].alias("indices"), cells["v"].alias("values"))
    schema = T.StructType([T.StructField("features", VectorUDT())])
    vector = F.from_json(F.to_json(F.struct(sparse.alias("features"))), schema, {"mode": "FAILFAST"})["features"]
    return x.select(*kept, vector.alias("features", metadata={"ml_attr": {"num_attrs": size}}))


def _cell(place: Column, value: Column) -> Column:
    return F.struct(place.alias("i"), value.alias("v"))


def in_few_tasks(x: DataFrame) -> DataFrame:
    """Persisted rows in as many partitions as a fit should have tasks: every iteration
    of every head sends one gradient as wide as the encoded ids from each of them, so
    they follow the rows and end at the cluster's cores, not at the shuffle's partitions."""
    tasks = min(x.sparkSession.sparkContext.defaultParallelism, -(-x.count() // FIT_ROWS))
    return x.coalesce(max(1, tasks))


def fit_heads(
    train: DataFrame,
    features: Sequence[str],
    categorical: Sequence[str],
    binary_targets: Sequence[str],
    continuous_targets: Sequence[str],
    *,
    pos_weight: float = 2.0,
    reg_param: float = 0.0,
    max_iter: int = 10,
    prep: PipelineModel | None = None,
    prepared: DataFrame | None = None,
    parallelism: int = 4,
) -> tuple[PipelineModel, Heads]:
    """One head per target on that target's valid rows.

    ``prep`` / ``prepared`` (the fitted preparation and ``train`` transformed
    by it) can be passed in to share them across several fits.
    """
    prep = prep or _prep(features, categorical).fit(train)
    held = prepared if prepared is not None else encode(train, prep, features, [*binary_targets, *continuous_targets]).persist()
    x = in_few_tasks(held)

    def fit_binary(t):
        rows = x.filter(F.col(t).isNotNull()).withColumn("__w", F.when(F.col(t) >= 0.5, F.lit(pos_weight)).otherwise(F.lit(1.0)))
        lr = LogisticRegression(featuresCol="features", labelCol=t, weightCol="__w", regParam=reg_param, maxIter=max_iter)
        return lr.fit(rows.withColumn(t, F.col(t).cast("double")))

    def fit_continuous(t):
        rows = x.filter(F.col(t).isNotNull())
        lin = LinearRegression(featuresCol="features", labelCol=t, loss="huber", regParam=reg_param, maxIter=max_iter)
        return lin.fit(rows)

    # The heads are independent: fit them as concurrent Spark jobs (as
    # CrossValidator's ``parallelism`` does), each one still distributed.
    with ThreadPoolExecutor(max_workers=max(1, int(parallelism))) as pool:
        bf = {t: pool.submit(fit_binary, t) for t in binary_targets}
        cf = {t: pool.submit(fit_continuous, t) for t in continuous_targets}
        binary = {t: f.result() for t, f in bf.items()}
        cont = {t: f.result() for t, f in cf.items()}
    if prepared is None:
        held.unpersist()
    return prep, Heads(list(features), list(categorical), binary, cont, reg_param)


def score(df: DataFrame, prep: PipelineModel, heads: Heads) -> DataFrame:
    """J3 + B13: ``logit_{t}`` / ``score_{t}`` per binary head, ``pred_{t}`` per continuous head."""
    x = encode(df, prep, heads.features)
    tmp = []
    for t, m in heads.binary.items():
        m = m.copy().setFeaturesCol("features").setRawPredictionCol(f"__raw_{t}").setProbabilityCol(f"__prob_{t}").setPredictionCol(f"__lab_{t}")
        x = m.transform(x)
        x = x.withColumn(f"logit_{t}", vector_to_array(f"__raw_{t}")[1]).withColumn(f"score_{t}", vector_to_array(f"__prob_{t}")[1])
        tmp += [f"__raw_{t}", f"__prob_{t}", f"__lab_{t}"]
    for t, m in heads.continuous.items():
        x = m.copy().setFeaturesCol("features").setPredictionCol(f"pred_{t}").transform(x)
    return x.drop("features", *tmp)


def validation_loss(scored: DataFrame, heads: Heads, pos_weight: float = 2.0) -> float:
    """D6 on a scored validation frame (one aggregate row); a target without a valid
    label there counts 0 like any fully masked one."""
    lb = to_long(scored, list(heads.binary), score="logit_{t}")
    lc = to_long(scored, list(heads.continuous), score="pred_{t}")
    return float(combined_loss(lb, lc, pos_weight, list(heads.binary)).first()["loss"])


def select_heads(
    train: DataFrame,
    valid: DataFrame,
    features: Sequence[str],
    categorical: Sequence[str],
    binary_targets: Sequence[str],
    continuous_targets: Sequence[str],
    grid: Sequence[float] = (0.0, 0.01),
    pos_weight: float = 2.0,
    width: int | None = None,
) -> tuple[PipelineModel, Heads, dict]:
    """Fit per grid value, keep the lowest validation loss, report all."""
    best, report = None, {}
    # One preparation and one persisted training frame serve every grid value.
    prep = _prep(features, categorical, width).fit(train)
    x = encode(train, prep, features, [*binary_targets, *continuous_targets]).persist()
    try:
        for reg in grid:
            _, heads = fit_heads(
                train, features, categorical, binary_targets, continuous_targets,
                pos_weight=pos_weight, reg_param=reg, prep=prep, prepared=x,
            )
            loss = validation_loss(score(valid, prep, heads), heads, pos_weight)
            report[reg] = loss
            if best is None or loss < best[2]:
                best = (prep, heads, loss)
    finally:
        x.unpersist()
    return best[0], best[1], report


@dataclass
class Bundle:
    """Sizes of the training split, encoder and heads: what :func:`score_ids` needs."""

    sizes: dict[str, int]
    width: int
    prep: PipelineModel
    heads: Heads

    def save(self, spark: SparkSession, path: str) -> str:
        """Write a new folder; its description comes last, so a folder that has one is whole."""
        self.prep.save(f"{path}/prep")
        h = self.heads
        for t, m in {**h.binary, **h.continuous}.items():
            m.save(f"{path}/head_{t}")
        about = {"sizes": self.sizes, "width": self.width, "features": h.features, "categorical": h.categorical, "binary": list(h.binary), "continuous": list(h.continuous), "reg_param": h.reg_param}
        spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.text(f"{path}/about")
        return path

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Bundle:
        about = json.loads(spark.read.text(f"{path}/about").first()["value"])
        binary = {t: LogisticRegressionModel.load(f"{path}/head_{t}") for t in about["binary"]}
        continuous = {t: LinearRegressionModel.load(f"{path}/head_{t}") for t in about["continuous"]}
        for t, m in {**binary, **continuous}.items():
            if m.numFeatures != len(about["features"]) + about["width"]:
                raise ValueError(f"the head of {t} takes {m.numFeatures} inputs, the encoder gives {len(about['features'])} + {about['width']}")
        heads = Heads(about["features"], about["categorical"], binary, continuous, about["reg_param"])
        return cls(about["sizes"], about["width"], PipelineModel.load(f"{path}/prep"), heads)


def training_rows(log: DataFrame, registry: Registry, *, end: str, ts: str = "ts") -> tuple[DataFrame, dict[str, int]]:
    """The training table of the whole log with bucket sizes pinned to the rows
    before ``end``: later ids share those buckets."""
    sizes = bucket_size_map(log.filter(F.col(ts) < F.lit(end).cast(log.schema[ts].dataType)), registry.bucket_sources)
    return training_table(log, registry, sizes=sizes), sizes


def fit_bundle(
    train: DataFrame,
    valid: DataFrame,
    registry: Registry,
    sizes: dict[str, int],
    *,
    width: int = 1 << 12,
    negatives: float = 1.0,
    signals: Sequence[str] | None = None,
    id_cols: Sequence[str] = (),
    grid: Sequence[float] = (0.0, 0.01),
) -> Bundle:
    """Sample the training rows without any of ``signals`` (B11), fit a head per
    target, keep the regularisation with the lowest validation loss."""
    kept = neg_sample_exact(train, list(signals or registry.signals), list(id_cols), negatives)
    prep, heads, _ = select_heads(kept, valid, registry.served, registry.bucket_columns, registry.binary_targets, registry.continuous_targets, grid=grid, width=width)
    return Bundle(sizes, width, prep, heads)


def score_ids(requests: DataFrame, latest: dict, bundle: Bundle, registry: Registry) -> DataFrame:
    """Score rows that hold ids only. Features are the latest values of every view
    (``latest``: key columns -> table; unknown ids and nulls get 0.0), ids fall into the
    buckets of the training split; every request gives one row."""
    if missing := set(registry.bucket_sources) - set(bundle.sizes):
        raise ValueError(f"the bundle has no bucket size for {sorted(missing)}")
    x = with_buckets(online_lookup(requests, latest, bundle.heads.features), registry, bundle.sizes)
    return score(x, bundle.prep, bundle.heads)
