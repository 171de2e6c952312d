"""Training, saving and applying an edge fraud classifier on MLlib."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import cached_property

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel, Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cardlake.functions import cleaning as fn
from cardlake.operators import features, graph, metrics
from cardlake.operators.features import LabelCodes, MinMax
from cardlake.operators import lookups
from cardlake.operators.lookups import heavy_keys, lookup, table_bytes
from cardlake.session import stage

_ENDS = ("src", "dst")
_STATS = ("fraud_rate", "log_degree")


@dataclass(frozen=True)
class EdgeModel:
    """Everything scoring needs, fitted on the training rows."""

    nodes: DataFrame
    codes: Mapping[str, LabelCodes]
    scaler: MinMax
    stats: DataFrame            # node_id, degree, frauds
    prior: float
    pipeline: PipelineModel

    @cached_property
    def node_sizes(self) -> dict[str, tuple[int, int]]:
        """Rows and bytes of each node type, measured when first asked for."""
        return graph.type_sizes(self.nodes)

    @cached_property
    def stats_bytes(self) -> int:
        return table_bytes(self.stats)

    @cached_property
    def least_merchant(self) -> int | None:
        return self.nodes.where(F.col("type") == "merchant").agg(F.min(F.col("key").try_cast("long"))).first()[0]


def _node_stats(train: DataFrame) -> DataFrame:
    ends = train.select(F.explode(F.array(*_ENDS)).alias("node_id"), "label")
    return stage(ends.groupBy("node_id").agg(F.count("*").alias("degree"), F.sum("label").alias("frauds")), "node-stats")


def _with_stats(edges: DataFrame, stats: DataFrame, size: int, prior: float, spread: list[str], counted: bool = False) -> DataFrame:
    """Add the smoothed fraud rate and the degree of both nodes. Edges that are ``counted`` in the statistics are left out
    of their own, so that a fit does not see its target in them."""
    out, hot = edges, heavy_keys(edges, {end: F.col(end) for end in _ENDS}) if size > lookups.BROADCAST_BYTES else ()
    own, own_fraud = (F.lit(1), F.col("label")) if counted else (F.lit(0), F.lit(0))
    for end in _ENDS:
        table = stats.select(F.col("node_id").alias(end), F.col("degree").alias("__degree"), F.col("frauds").alias("__frauds"))
        out = lookup(out, table, end, "left", size, hot, spread)
        degree = (F.coalesce("__degree", F.lit(0)) - own).cast("double")
        frauds = (F.coalesce("__frauds", F.lit(0)) - own_fraud).cast("double")
        out = out.withColumns({f"{end}_fraud_rate": (frauds + 10.0 * prior) / (degree + 10.0),
                               f"{end}_log_degree": F.log1p(degree)}).drop("__degree", "__frauds")
    return out


def _inputs() -> list[str]:
    return [*[f"x_{c}" for c in features.EDGE_ATTRIBUTES], *[f"{e}_{s}" for e in _ENDS for s in _STATS]]


def _classifier(kind: str, seed: int, iterations: int):
    if kind == "mlp":
        return MultilayerPerceptronClassifier(layers=[len(_inputs()), 64, 2], featuresCol="x", labelCol="label",
                                              maxIter=iterations, seed=seed)
    if kind == "gbt":
        return GBTClassifier(featuresCol="x", labelCol="label", maxIter=iterations, seed=seed)
    if kind == "logistic":
        return LogisticRegression(featuresCol="x", labelCol="label", maxIter=iterations)
    raise ValueError(f"unknown classifier {kind!r}")


def _encode(rows: DataFrame, codes: Mapping[str, LabelCodes], scaler: MinMax, unseen: str) -> DataFrame:
    spread = ["idx"] if "idx" in rows.columns else None
    coded = features.apply_label_codes(rows, codes, unseen=unseen, falsy_zero=True, spread=spread)
    scaled = features.apply_minmax(coded, scaler)
    return scaled.withColumns({f"x_{c}": F.coalesce(F.col(c).cast("double"), F.lit(0.0))
                               for c in features.EDGE_ATTRIBUTES})


def train_edge_classifier(rows: DataFrame, kind: str = "mlp", fit_on: str = "train", seed: int = 42,
                          iterations: int = 50) -> tuple[EdgeModel, DataFrame]:
    """Fit on ``rows`` (see :func:`cardlake.operators.features.prepare`) with a ``split`` of ``train`` / ``test``.

    Codes, scaler and node statistics come from the training rows; ``fit_on="all"`` fits codes and scaler on all rows.
    Returns the model and the rows of both splits, scored as :func:`score` would score them.
    """
    train = rows.where(F.col("split") == "train")
    base = rows if fit_on == "all" else train
    codes = features.fit_label_codes(base, features.CODED)
    scaler = features.fit_minmax(base, features.SCALED)
    nodes = graph.bipartite_nodes(rows)
    edges = stage(graph.resolve_edges(rows, nodes, spread=["idx"]), "model-edges")
    in_train = edges.where(F.col("split") == "train")
    prior = float(in_train.agg(F.avg("label")).first()[0] or 0.0)
    stats = _node_stats(in_train)
    size = table_bytes(stats)
    encoded = stage(_encode(edges, codes, scaler, "zero"), "model-inputs")
    to_fit = stage(_with_stats(encoded.where(F.col("split") == "train"), stats, size, prior, ["idx"], counted=True), "model-fit")
    steps = [VectorAssembler(inputCols=_inputs(), outputCol="raw"),
             StandardScaler(inputCol="raw", outputCol="x", withMean=True), _classifier(kind, seed, iterations)]
    fitted = Pipeline(stages=steps).fit(to_fit)
    model = EdgeModel(nodes, codes, scaler, stats, prior, fitted)
    return model, _predict(fitted, _with_stats(encoded, stats, size, prior, ["idx"]))


def _predict(fitted: PipelineModel, inputs: DataFrame) -> DataFrame:
    p = vector_to_array("probability")
    scored = fitted.transform(inputs).withColumns({"prob0": F.get(p, F.lit(0)), "prob1": F.get(p, F.lit(1))})
    return scored.withColumns({
        "confidence": F.col("prob1"), "pred": F.when(F.col("prob1") > F.col("prob0"), 1).otherwise(0),
        "prediction": F.when(F.col("prob1") > F.col("prob0"), "Yes").otherwise("No")}) \
        .drop("raw", "x", "rawPrediction", "probability", *_inputs())


def score(requests: DataFrame, model: EdgeModel, unseen: str = "zero", fill_errors: bool = True) -> DataFrame:
    """Add the prediction to requests; unknown nodes count as node 0 and are flagged ``src_known`` / ``dst_known``.

    A missing value counts as the first of its column: a request without a merchant is scored with the least merchant
    (and ``dst_known`` false), one without ``errors`` as the training rows are, with "No error". With
    ``fill_errors=False`` the latter is scored with the first error text.
    """
    names = requests.columns
    given = F.when(F.col("merchant_name") != 0, F.col("merchant_name"))
    rows = requests.select(
        F.struct(*names).alias("request"), fn.card_key(F.col("user"), F.col("card")).alias("card_id"),
        F.coalesce(given, F.lit(model.least_merchant).cast("long")).alias("merchant_name"), given.isNotNull().alias("has_merchant"),
        "merchant_city", "use_chip", (fn.or_default(F.col("errors")) if fill_errors else F.col("errors")).alias("errors"),
        fn.money(F.col("amount")).alias("amount"),
        *[F.col(c).cast("double").alias(c) for c in ("year", "month", "day")])
    edges = graph.resolve_edges(rows, model.nodes, default=0, sizes=model.node_sizes)
    edges = edges.withColumn("dst_known", F.col("dst_known") & F.col("has_merchant"))
    full = _with_stats(_encode(edges, model.codes, model.scaler, unseen), model.stats, model.stats_bytes, model.prior, edges.columns)
    return _predict(model.pipeline, full).select("request.*", "prediction", "confidence", "prob0", "prob1", "src_known",
                                                 "dst_known")


def split_metrics(scored: DataFrame) -> DataFrame:
    """Loss and accuracy of both splits."""
    loss = -F.log(F.greatest(F.when(F.col("label") == 1, F.col("prob1")).otherwise(F.col("prob0")), F.lit(1e-15)))
    return scored.groupBy("split").agg(
        F.count("*").alias("n"), F.avg(loss).alias("loss"),
        F.avg((F.col("pred") == F.col("label")).cast("double")).alias("accuracy"))


def quality(scored: DataFrame, split: str = "test") -> DataFrame:
    """Rates and areas of one split, in one row."""
    mask = F.col("split") == split
    rates = metrics.classification(scored, mask=mask).first().asDict()
    areas = metrics.areas(metrics.curve_points(scored, "prob1", mask=mask)).first().asDict()
    return scored.sparkSession.createDataFrame([{**rates, **areas}], T.StructType(
        [T.StructField(n, T.DoubleType()) for n in (*rates, *areas)]))


def save(model: EdgeModel, path: str) -> None:
    spark = model.nodes.sparkSession
    model.nodes.write.mode("overwrite").parquet(f"{path}/nodes")
    model.stats.write.mode("overwrite").parquet(f"{path}/stats")
    for column, codes in model.codes.items():
        codes.table.write.mode("overwrite").parquet(f"{path}/codes/{column}")
    ranges = [(c, float(model.scaler.low[c]), float(model.scaler.high[c]), model.prior) for c in model.scaler.low]
    spark.createDataFrame(ranges, "name string, low double, high double, prior double") \
        .write.mode("overwrite").parquet(f"{path}/scaler")
    model.pipeline.write().overwrite().save(f"{path}/pipeline")


def load(spark: SparkSession, path: str) -> EdgeModel:
    ranges = spark.read.parquet(f"{path}/scaler").collect()
    codes = {}
    for c in features.CODED:
        table = spark.read.parquet(f"{path}/codes/{c}")
        codes[c] = LabelCodes(table, table_bytes(table))
    return EdgeModel(
        spark.read.parquet(f"{path}/nodes"), codes,
        MinMax({r["name"]: r["low"] for r in ranges}, {r["name"]: r["high"] for r in ranges}),
        spark.read.parquet(f"{path}/stats"), ranges[0]["prior"], PipelineModel.load(f"{path}/pipeline"))


def _versions(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return spark.read.schema("at timestamp, version int").parquet(f"{root}/versions")
    except AnalysisException:
        return None


def latest_version(spark: SparkSession, root: str) -> int | None:
    """The last version whose mark is written."""
    versions = _versions(spark, root)
    return None if versions is None else versions.agg(F.max("version")).first()[0]


def save_version(model: EdgeModel, root: str) -> int:
    """Keep the model under the next number; the mark that makes readers see it is written behind everything else."""
    spark = model.nodes.sparkSession
    last = latest_version(spark, root)
    number = 0 if last is None else last + 1
    save(model, f"{root}/models/{number}")
    spark.range(1).select(F.current_timestamp().alias("at")).write.mode("overwrite").parquet(f"{root}/versions/version={number}")
    return number


class ModelScorer:
    """Scores the requests of each batch with a stored model: the last version, looked up once per batch, or a fixed one.

    The model's tables are static sides of the joins; a version that came meanwhile takes effect with the next batch.
    """

    def __init__(self, spark: SparkSession, root: str, version: int | None = None):
        self.spark, self.root, self.fixed = spark, root, version
        self.version, self.model = None, None

    def __call__(self, requests: DataFrame) -> DataFrame:
        wanted = latest_version(self.spark, self.root) if self.fixed is None else self.fixed
        if wanted is None:
            raise ValueError(f"no model under {self.root}")
        if wanted != self.version:
            self.version, self.model = wanted, load(self.spark, f"{self.root}/models/{wanted}")
        return score(requests, self.model).withColumn("model_version", F.lit(self.version))
