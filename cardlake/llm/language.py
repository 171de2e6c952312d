"""Language of web pages by fusing evidence with Bayes' rule.

p(language | page) is proportional to p(text | language) * p(declared markup language | language) * p(address suffix | language) *
p(language | host). The text likelihood is a trigram model of bytes learned from documents whose language is known. The two
channels are confusion tables, the host prior is smoothed towards its domain, that towards all pages; all come from grouped sums of
the text posteriors over all pages. A page's own share is taken out of its host's and domain's sums. All evidence is added up in
logarithms without floors, so a text that is clear enough outweighs a host of any size.

The languages are all that documents name; their model, 256 KB each, goes to every task. Trigram counts are fitted on a bounded sample of the
texts of each (``SAMPLE`` different ones, least by hash); counts over pages are complete.

Defined cases: null, empty or text-less pages are judged by the other evidence; a page without a declaration, suffix or host has the
empty value there, which has probabilities like any other; ties go to the first language in order; without training rows there is
no language: null, probability 0; repeated pages are judged row by row; empty tables give no rows.
"""

from __future__ import annotations

import html as entities
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from cardlake.llm.html_extract import host_of
from cardlake.session import stage

SAMPLE = 2_000  # texts of a language
SLOTS = 1 << 15
HELD = 20_000  # keys whose sums a task holds
SALTS, HOT = 32, 128  # a key with a 128th of all pages is frequent, and spread over so many tasks
DOMAIN_WEIGHT, HOST_WEIGHT = 20.0, 20.0  # pages that the level above counts for
EVIDENCE = 60.0  # trigrams of one text are not independent: what a text has more than these counts by its root
TAGS = re.compile(r"(?is)<(script|style|head)\b.*?(?:</\1\s*>|\Z)|<!--.*?(?:-->|\Z)|<[^>]*(?:>|\Z)")
UPPER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def trigrams(text: bytes) -> np.ndarray:
    """Slot numbers of the byte trigrams, with white space and ASCII signs as one separator and digits left out."""
    low = re.sub(rb"[\x00-\x60\x7b-\x7f]+", b" ", text.translate(UPPER))
    x = np.frombuffer(b" " + low + b" ", np.uint8).astype(np.uint32)
    return ((x[:-2] * np.uint32(0x9E3779B1) ^ x[1:-1] * np.uint32(0x85EBCA6B) ^ x[2:] * np.uint32(0xC2B2AE35)) * np.uint32(0x27D4EB2F)) >> np.uint32(17)


def _count(batches):
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            sums.setdefault(lang, np.zeros(SLOTS, np.int64))
            sums[lang] += np.bincount(trigrams(text), minlength=SLOTS)
    if sums:
        yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array([c.tobytes() for c in sums.values()], pa.binary())], ["lang", "counts"])


def _add(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(c, np.int64) for c in table.column("counts").to_pylist())
    return pa.table({"lang": [table.column("lang")[0].as_py()], "counts": pa.array([total.tobytes()], pa.binary())})


def fit_text_model(docs: DataFrame, text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> tuple[list[str], np.ndarray]:
    """The languages in order and log p(trigram | language), one row each."""
    rows = docs.filter(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    sizes = {r["lang"]: r["texts"] for r in rows.groupBy("lang").agg(F.count("*").alias("n"), F.approx_count_distinct("h").alias("texts"))
             .orderBy(F.desc("n"), "lang").collect()}
    if not sizes:
        return [], np.zeros((0, SLOTS))
    # The least texts of each language by hash: a few more by their number, cut at the exact one.
    place = F.col("h").cast("double") * 2.0 ** -64 + 0.5
    share = F.create_map(*[F.lit(y) for x, n in sizes.items() for y in (x, 2.0 * (sample + 10) / max(1, n))])
    near = place <= share[F.col("lang")]
    ranked = rows.filter(near).select("lang", "h").distinct().withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("h")))
    cuts = ranked.filter(F.col("rank") <= sample).groupBy("lang").agg(F.max("h").alias("cut")).collect()
    cut = F.create_map(*[F.lit(y) for r in cuts for y in (r["lang"], r["cut"])])
    chosen = F.coalesce(F.col("h") <= cut[F.col("lang")], F.lit(False))
    some = rows.filter(chosen).groupBy("lang", "h").agg(F.first("text").alias("text"))
    counted = (some.select("lang", F.col("text").cast("binary").alias("text"))
               .mapInArrow(_count, "lang string, counts binary").groupBy("lang").applyInArrow(_add, "lang string, counts binary").collect())
    counts = {r["lang"]: np.frombuffer(r["counts"], np.int64) for r in counted}
    names = sorted(counts)
    table = np.array([counts[n] + 0.5 for n in names])
    return names, np.log(table / table.sum(1, keepdims=True))


def text_posterior(page: str, model: np.ndarray) -> list[float]:
    """log p(language | text) for each language."""
    text = entities.unescape(TAGS.sub(" ", page)).encode("utf-8", "replace")
    found = trigrams(text)
    if len(found) < 2:
        return [-math.log(len(model))] * len(model)
    seen, n = np.unique(found, return_counts=True)
    total = model[:, seen] @ n * min(1.0, math.sqrt(EVIDENCE / len(found)))
    total -= total.max()
    return (total - math.log(np.exp(total).sum())).tolist()


def suffix_of(url: Column) -> Column:
    """The two-letter first folder of an address, else the last label of its host."""
    folder = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://[^/?#]+/([a-z]{2})(?:[/?#-]|$)", 1)
    return F.when(folder != "", F.concat(F.lit("/"), folder)).otherwise(F.regexp_extract(host_of(url), r"(\.[a-z]+)$", 1))


def _language_sums(seen: DataFrame, key: str) -> DataFrame:
    """``(key, sums)``: the posteriors of all pages with a key, added up per language. Tasks add up first, a row per key each."""
    kind = seen.schema[key].dataType.simpleString()

    def partial(batches):
        held: dict = {}
        for b in batches:
            for k, post in zip(b.column(key).to_pylist(), b.column("post")):
                own = post.values.to_numpy(zero_copy_only=False)
                held[k] = held[k] + own if k in held else own
            if len(held) >= HELD:
                yield rows(held)
                held = {}
        if held:
            yield rows(held)

    def rows(held):
        return pa.RecordBatch.from_arrays([pa.array(list(held)), pa.array([v.tolist() for v in held.values()], pa.list_(pa.float64()))], [key, "sums"])

    def add(table: pa.Table) -> pa.Table:
        total = np.sum([x.values.to_numpy(zero_copy_only=False) for x in table.column("sums")], axis=0)
        return pa.table({key: table.column(key).slice(0, 1), "sums": pa.array([total.tolist()], pa.list_(pa.float64()))})

    return seen.select(key, "post").mapInArrow(partial, f"{key} {kind}, sums array<double>").groupBy(key).applyInArrow(add, f"{key} {kind}, sums array<double>")


def identify(pages: DataFrame, names: list[str], model: np.ndarray, url: str = "url", html: str = "html",
             keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The kept columns, lang, probability, text_lang (by text alone), declared, suffix."""
    kept = F.struct(*[F.col(c).alias(f"keep_{i}") for i, c in enumerate(keep)]).alias("kept")
    outer = [F.col(f"kept.keep_{i}").alias(c) for i, c in enumerate(keep)]
    declared = F.lower(F.regexp_extract(F.coalesce(F.col(html).cast("string"), F.lit("")), r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]+)", 1))
    address = F.coalesce(F.col(url).cast("string"), F.lit(""))
    plain = pages.select(kept, declared.alias("declared"), suffix_of(address).alias("suffix"), host_of(address).alias("host"),
                         F.col(html).cast("string").alias("html"))
    if not names:
        return plain.select(*outer, F.lit(None).cast("string").alias("lang"), F.lit(0.0).alias("probability"),
                            F.lit(None).cast("string").alias("text_lang"), "declared", "suffix")
    fields = plain.schema["kept"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            post = [text_posterior(p or "", model) for p in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("kept", "declared", "suffix", "host")),
                                              pa.array(post, pa.list_(pa.float64()))], ["kept", "declared", "suffix", "host", "logs"])

    seen = stage(plain.mapInArrow(run, f"kept {fields}, declared string, suffix string, host string, logs array<double>")
                 .withColumn("domain", F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1)), "evidence").withColumn("post", F.transform("logs", F.exp))
    many = len(names)
    sums = lambda key: _language_sums(seen, key).withColumnRenamed("sums", f"{key}_sums")
    total = next(iter([list(r["sums"]) for r in _language_sums(seen.withColumn("every", F.lit("")), "every").collect()]), [0.0] * many)
    n = sum(total)
    overall = [(t + 1) / (n + many) for t in total]
    kinds = {c: seen.select(c).distinct().count() for c in ("declared", "suffix")}
    out = seen
    for key in ("declared", "suffix", "domain", "host"):  # one row per key; the pages of a frequent key are spread over many tasks
        table = stage(sums(key), f"{key}-sums")
        salt = F.when(F.col("frequent"), F.pmod(F.xxhash64("logs", "kept"), F.lit(SALTS))).otherwise(F.lit(0).cast("long"))
        copies = F.when(F.col("frequent"), F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).otherwise(F.array(F.lit(0).cast("long")))
        frequent = [r[0] for r in table.filter(F.aggregate(f"{key}_sums", F.lit(0.0), lambda a, x: a + x) >= n / HOT).select(key).collect()]
        is_hot = F.col(key).isin(frequent) if frequent else F.lit(False)
        spread = table.withColumn("frequent", is_hot).withColumn("salt", F.explode(copies)).drop("frequent")
        out = out.withColumn("frequent", is_hot).withColumn("salt", salt).join(spread, [key, "salt"], "left").drop("salt", "frequent")

    def fused(batches):
        """The scores of all languages for each page: its text's, its host's prior and the two channels, less its own share."""
        for b in batches:
            if not b.num_rows:
                continue
            wide = lambda c: b.column(c).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, many)
            own, logs = wide("post"), wide("logs")
            left = {c: np.maximum(wide(f"{c}_sums") - own, 0.0) for c in ("declared", "suffix", "domain", "host")}  # sums may round
            size = {c: np.maximum(wide(f"{c}_sums").sum(1, keepdims=True) - 1, 0.0) for c in ("domain", "host")}  # less the page itself
            domain = (left["domain"] + DOMAIN_WEIGHT * np.array(overall)) / (size["domain"] + DOMAIN_WEIGHT)
            host = (left["host"] + HOST_WEIGHT * domain) / (size["host"] + HOST_WEIGHT)
            scores = logs + np.log(host) + sum(np.log((left[c] + 0.5) / (np.array(total) + 0.5 * kinds[c])) for c in kinds)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, scores.size + 1, many, dtype=np.int32)), pa.array(scores.reshape(-1)))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("kept", "declared", "suffix", "logs")), lists],
                                             ["kept", "declared", "suffix", "logs", "scores"])

    out = out.mapInArrow(fused, f"kept {fields}, declared string, suffix string, logs array<double>, scores array<double>")
    out = out.withColumn("most", F.array_max("scores"))
    sure = 1 / F.aggregate("scores", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("most")))
    of = F.array(*[F.lit(x) for x in names])
    return out.select(*outer, F.element_at(of, F.array_position("scores", F.col("most")).cast("int")).alias("lang"), sure.alias("probability"),
                      F.element_at(of, F.array_position("logs", F.array_max("logs")).cast("int")).alias("text_lang"), "declared", "suffix")


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    names, model = fit_text_model(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return identify(spark.read.parquet(f"{sf_dir}/pages.parquet"), names, model).drop("url")
