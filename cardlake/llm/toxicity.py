"""Toxicity scores: gradient-boosted trees over dense features of whole texts, calibrated by isotonic regression.

Features: densities and counts of lexicon words, of lexicon beginnings (for inflected forms) and of a small fixed list; nearness
of second-person words to such words; capitals; exclamation, question and other marks; words that mix letters with digits or signs
(read again with the signs undone). The lexicon is learned from one half of the labelled rows by grouped counts, the trees and the
calibration from the other half, so no tree sees a lexicon that was made from its own rows.

Training reads a sample of labelled rows of bounded size (``SAMPLE`` rows, least by hash of the text, equal texts once);
scoring reads every row whole.

Defined cases: a null text is scored like an empty one; an empty text has zero features and gets a score; a null label is no
training row; repeated rows are scored alike; without rows of both labels every score is the share of label 1 (0 without any
labelled row); empty tables give no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, SparkSession, functions as F

from cardlake.llm.memory import returned
from cardlake.session import stage

SAMPLE = 16_000
LABELLED = 24_000  # labelled ids that the query reads texts of
LEXICON = 4_000  # most distinctive words and beginnings kept, each
TREES, DEPTH, SEED = 24, 4, 7
THRESHOLD = 0.3
# Words of abuse in English, and second-person words in the four languages of the tables.
ABUSE = frozenset("idiot moron stupid dumb scum trash loser pathetic worthless disgusting clown garbage filth liar fool hate "
                  "kill ugly vermin imbecile jerk freak crap damn shit fuck bitch bastard asshole".split())
YOU = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta vous votre tú ti tus usted".split())
UNDO = str.maketrans("013457@$!|", "oieastasil")
FEATURES = ("lexicon", "log_lexicon", "distinct_lexicon", "beginnings", "log_beginnings", "abuse", "near_you", "you", "capitals",
            "shouted", "exclaims", "questions", "marks", "mixed", "undone", "stretched", "log_words")
WORD = re.compile(r"[^\W_]+")
MIXED = re.compile(r"\b[^\W\d_]+[0-9@$!|*]+[^\W\d_]+\w*")
STRETCHED = re.compile(r"([^\W\d_])\1\1")
SHOUTED = re.compile(r"\b[A-Z]{3,}\b")


def features(text: str, lexicon: frozenset, beginnings: frozenset) -> list[float]:
    low = text.lower()
    words = WORD.findall(low)
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    counts = Counter(words)
    bad = {w for w in counts if w in lexicon or w in ABUSE}
    hits = sum(counts[w] for w in bad)
    starts = sum(c for w, c in counts.items() if len(w) > 4 and (w[:5] in beginnings or w[:4] in beginnings))
    abuse = sum(counts[w] for w in bad if w in ABUSE)
    you = sum(counts[w] for w in YOU if w in counts)
    near = 0.0
    if hits and you:
        bad_at = [i for i, w in enumerate(words) if w in bad]
        you_at = [i for i, w in enumerate(words) if w in YOU]
        j = 0
        for i in bad_at:  # the nearest second-person word on either side
            while j + 1 < len(you_at) and you_at[j + 1] <= i:
                j += 1
            gap = min(abs(i - you_at[k]) for k in (j, j + 1) if k < len(you_at))
            near = max(near, 1 / gap if gap else 1.0)
    mixed = [m.group().translate(UNDO) for m in MIXED.finditer(low)]
    undone = sum(1 for w in mixed if w in lexicon or w in ABUSE)
    raw, size = text.encode("utf-8", "surrogatepass"), len(text)
    caps = len(raw) - len(raw.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    marks = len(raw) - len(raw.translate(None, b"#$%&*+/<=>@^_|~"))
    return [hits / n, math.log1p(hits), float(len(bad)), starts / n, math.log1p(starts), abuse / n, near, you / n, caps / size,
            len(SHOUTED.findall(text)) / n if caps > 2 else 0.0, text.count("!") / n, text.count("?") / n, marks / size,
            len(mixed) / n, undone / n, len(STRETCHED.findall(low)) / n, math.log1p(n)]


def _featurize(df: DataFrame, text: str, keep: list[str], words: frozenset, starts: frozenset) -> DataFrame:
    """The kept columns and ``features`` (an array); the word lists are of bounded size and travel with the function."""
    plain = df.select(F.struct(*[F.col(c).alias(f"keep_{i}") for i, c in enumerate(keep)]).alias("kept"),
                      F.col(text).cast("string").alias("text"))
    fields = plain.schema["kept"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            found = [features(t or "", words, starts) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("kept"), pa.array(found, pa.list_(pa.float64()))], ["kept", "features"])

    out = plain.mapInArrow(returned(run), f"kept {fields}, features array<double>")
    return out.select(*[F.col(f"kept.keep_{i}").alias(c) for i, c in enumerate(keep)], "features")


def _distinctive(words: DataFrame, key: str, positives: int, negatives: int) -> frozenset:
    """At most LEXICON keys that label-1 texts hold far more often than label-0 texts."""
    ratio = ((F.col("pos") + 0.5) / (positives + 1)) / ((F.col("neg") + 0.5) / (negatives + 1))
    rows = (words.groupBy(key).agg(F.sum("label").alias("pos"), F.sum(1 - F.col("label")).alias("neg"))
            .filter("pos >= 3").withColumn("ratio", ratio).filter("ratio >= 8")
            .orderBy((F.log("ratio") * F.sqrt("pos")).desc(), key).limit(LEXICON).select(key).collect())
    return frozenset(r[0] for r in rows)


class ToxicityModel:
    """A fitted scorer; ``score`` adds ``score`` and ``predicted`` to the kept columns of any table of texts."""

    def __init__(self, words: frozenset, starts: frozenset, trees, curve, share: float, threshold: float):
        self.words, self.starts, self.trees, self.curve, self.share, self.threshold = words, starts, trees, curve, share, threshold

    def score(self, docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
        inner = [f"keep_{i}" for i in range(len(keep))]
        renamed = docs.select(*[F.col(c).alias(i) for c, i in zip(keep, inner)], F.col(text).cast("string").alias("text"))
        if self.trees is None:
            scored = renamed.withColumn("score", F.lit(float(self.share)))
        else:
            rows = _featurize(renamed, "text", inner, self.words, self.starts)
            scored = _probability(self.trees, rows)
            scored = self.curve.transform(scored)
            # Isotonic steps tie many rows; a thousandth of the uncalibrated value keeps their order.
            scored = scored.withColumn("score", F.greatest(F.lit(0.0), F.least(F.lit(1.0), 0.999 * F.col("calibrated"))) + 0.001 * F.col("raw"))
        return scored.select(*[F.col(i).alias(c) for c, i in zip(keep, inner)], "score",
                             (F.col("score") >= self.threshold).cast("int").alias("predicted"))


def _probability(trees, rows: DataFrame) -> DataFrame:
    out = trees.transform(rows.withColumn("vector", array_to_vector("features")))
    return out.withColumn("raw", vector_to_array("probability")[1]).drop("vector", "features", "probability", "rawPrediction", "prediction")


def fit_toxicity(labelled: DataFrame, text: str = "text", label: str = "label", sample: int = SAMPLE,
                 threshold: float = THRESHOLD) -> ToxicityModel:
    rows = (labelled.select(F.col(text).cast("string").alias("text"), F.col(label).cast("int").alias("label"))
            .filter("text is not null and label in (0, 1)").withColumn("h", F.xxhash64("text")))
    # The sample is cut by hash first: only its rows' texts are gathered, and equal texts count once.
    cut = rows.select("h").distinct().orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    if cut is None:
        return ToxicityModel(frozenset(), frozenset(), None, None, 0.0, threshold)
    picked = stage(rows.filter(F.col("h") <= cut).groupBy("h").agg(F.first("text").alias("text"), F.max("label").alias("label"))
                   .withColumn("part", F.pmod(F.xxhash64(F.col("h").cast("string")), F.lit(20))), "labelled")
    sums = {r["first"]: r for r in picked.groupBy((F.col("part") < 10).alias("first")).agg(
        F.sum("label").alias("pos"), F.count("*").alias("n")).collect()}
    pos, n = sum(r["pos"] for r in sums.values()), sum(r["n"] for r in sums.values())
    if len(sums) < 2 or any(r["pos"] in (0, r["n"]) for r in sums.values()):
        return ToxicityModel(frozenset(), frozenset(), None, None, pos / n, threshold)
    words = (picked.filter("part < 10").select("label", F.explode(F.array_distinct(
        F.split(F.lower("text"), r"[^\p{L}\p{N}]+"))).alias("word")).filter("word <> ''"))
    a = sums[True]
    lexicon = _distinctive(words, "word", a["pos"], a["n"] - a["pos"])
    long = words.filter(F.length("word") > 4)
    starts = frozenset().union(*(_distinctive(long.withColumn("start", F.substring("word", 1, k)), "start", a["pos"], a["n"] - a["pos"])
                                 for k in (4, 5)))
    rest = stage(_featurize(picked.filter("part >= 10"), "text", ["label", "part"], lexicon, starts), "features")
    trees = GBTClassifier(featuresCol="vector", labelCol="label", maxIter=TREES, maxDepth=DEPTH, seed=SEED, stepSize=0.2,
                          minInstancesPerNode=5)
    fitted = trees.fit(rest.filter("part < 17").withColumn("vector", array_to_vector("features")))
    held = _probability(fitted, rest.filter("part >= 17"))
    if held.isEmpty():
        held = _probability(fitted, rest)
    curve = IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="calibrated").fit(held)
    return ToxicityModel(lexicon, starts, fitted, curve, pos / n, threshold)


def _remainder(n: int):
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(n))


def training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("toxic").alias("label"))
    labels, order = labels.filter((_remainder(4) != 2) & F.col("label").isNotNull()), F.xxhash64(F.col("doc_id").cast("string"))
    # Cut the ids before any text moves: the least LABELLED of them by hash.
    cut = labels.select(order.alias("h")).orderBy("h").limit(LABELLED).agg(F.max("h")).first()[0]
    bound = order <= F.lit(-(2**63) if cut is None else cut)
    return docs.filter((_remainder(4) != 2) & bound).join(labels.filter(bound), "doc_id")


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = fit_toxicity(training_rows(spark, sf_dir))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn(
        "held_out", F.coalesce(_remainder(4) == 2, F.lit(False)))
    return model.score(docs, keep=("doc_id", "held_out"))
