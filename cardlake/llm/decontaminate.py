"""Benchmark decontamination by winnowing.

Every text is cut into runs of ``k`` words; of each ``window - k + 1`` consecutive runs the one with the smallest hash
is a fingerprint. Two texts that share ``window`` consecutive words therefore share a fingerprint inside them. Fingerprints
of documents that no item can have are dropped in the scan by a bit map of fixed size (its bits are set by a grouped
aggregation, at most 8 MiB whatever the items), the rest is joined with the items' fingerprints, and each match is
extended word by word to the longest shared span. An item of fewer than ``window`` words is one fingerprint of its own
length, looked for at every position.

Defined cases: a null or empty text has no words, so no hits; repeated rows and repeated ids are judged row by row; an item
without words (or a null one) never occurs; items with equal ids count once; an item whose id is null makes hits but is in
no list; empty tables give no rows, or rows without hits. Words are compared by 64-bit hashes; a span is accepted only if all
its words agree.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from cardlake.llm import hashing as H
from cardlake.llm.memory import returned
from cardlake.operators.lookups import heavy_keys
from cardlake.session import stage

WINDOW, GRAM = 13, 8
MAP_BITS = 26  # 2**26 bits are 8 MiB
SLICE_BITS = 16
ROWS = 4096  # fingerprints of items in a batch
SALTS = 16  # a fingerprint that many documents hold is spread over this many join keys


def fingerprints(words: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the selected runs of ``gram`` words."""
    grams, span = H.gram_hashes(words, gram), window - gram + 1
    n = len(grams) - span + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    least = grams[:n].copy()
    for j in range(1, span):
        np.minimum(least, grams[j:j + n], out=least)
    best = np.zeros(len(grams), np.uint64)  # the largest of the minima of all windows that hold a position
    for j in range(span):
        np.maximum(best[j:j + n], least, out=best[j:j + n])
    at = np.flatnonzero(best == grams)
    return at, grams[at]


def _item_rows(window: int, gram: int):
    schema = pa.schema([("item_row", pa.int64()), ("fp", pa.int64()), ("item_pos", pa.int32()), ("size", pa.int32()),
                        ("item_words", pa.list_(pa.int64())), ("n_words", pa.int64())])

    def run(batches):
        for batch in batches:
            ids, out = batch.column("item_row").to_pylist(), []
            for row, words in H.word_hashes(batch.column("text"), H.ALNUM):
                if not len(words):
                    continue
                short = len(words) < window
                at, fps = (np.zeros(1, np.int64), H.gram_hashes(words, len(words))) if short else \
                    fingerprints(words, window, gram)
                size = len(words) if short else gram
                for p, f in zip(at.tolist(), fps.view(np.int64).tolist()):
                    begin = max(0, p - window)  # an extension goes no further than a window on either side
                    out.append((ids[row], f, p - begin, size, words[begin:p + size + window].view(np.int64).tolist(), len(words)))
                    if len(out) >= ROWS:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)
                        out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)
    return run


def _document_rows(window: int, gram: int, shorts: list[int], bits):
    """A row per document with its number of words (fp null), and one per fingerprint that an item may have."""
    schema = pa.schema([("doc_row", pa.int64()), ("n_words", pa.int64()), ("fp", pa.int64()), ("size", pa.int32()),
                        ("pos", pa.int64()), ("before", pa.int32()), ("near", pa.list_(pa.int64()))])

    def run(batches):
        known = np.frombuffer(bits.value, np.uint8)
        for batch in batches:
            ids, out = batch.column("doc_row").to_pylist(), []
            for row, words in H.word_hashes(batch.column("text"), H.ALNUM):
                out.append((ids[row], len(words), None, None, None, None, None))
                sets = [(gram, *fingerprints(words, window, gram))]
                sets += [(n, np.arange(max(0, len(words) - n + 1)), H.gram_hashes(words, n)) for n in shorts]
                for size, at, fps in sets:
                    slot = (fps >> H.U(64 - MAP_BITS)).astype(np.int64)
                    hit = np.flatnonzero(known[slot >> 3] >> (slot & 7).astype(np.uint8) & 1)
                    for p, f in zip(at[hit].tolist(), fps[hit].view(np.int64).tolist()):
                        begin = max(0, p - window)
                        out.append((ids[row], None, f, size, p, p - begin,
                                    words[begin:p + size + window].view(np.int64).tolist()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema) \
                if out else pa.RecordBatch.from_arrays([pa.array([], t) for t in schema.types], schema=schema)
    return run


def _extend(window: int):
    """The longest shared span around each matched fingerprint, if it is a window's length at least."""
    schema = pa.schema([("doc_row", pa.int64()), ("item_row", pa.int64()), ("first", pa.int64()), ("last", pa.int64())])

    def run(batches):
        for batch in batches:
            out, cols = [], [batch.column(c).to_pylist() for c in
                             ("doc_row", "item_row", "pos", "size", "before", "near", "item_pos", "item_words", "n_words")]
            for doc, item, pos, size, a, near, b, words, n in zip(*cols):
                if near[a:a + size] != words[b:b + size]:
                    continue
                left, right = 0, size
                while left < min(a, b) and near[a - left - 1] == words[b - left - 1]:
                    left += 1
                while a + right < len(near) and b + right < len(words) and near[a + right] == words[b + right]:
                    right += 1
                if left + right >= min(window, n):
                    out.append((doc, item, pos - left, pos + right))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)
    return run


def _bit_map(spark: SparkSession, fps: DataFrame):
    """The set of slots (leading bits of a hash) in use, put together from slices of a fixed size."""
    def pack(batches):
        for batch in batches:
            rows = []
            for low in batch.column("low"):
                bits = np.zeros(1 << SLICE_BITS, np.uint8)
                bits[low.values.to_numpy()] = 1
                rows.append(np.packbits(bits, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("high"), pa.array(rows, pa.binary())], ["high", "bits"])

    slot = F.shiftrightunsigned("fp", 64 - MAP_BITS)
    slices = (fps.select(F.shiftright(slot, SLICE_BITS).alias("high"), slot.bitwiseAND((1 << SLICE_BITS) - 1).alias("low"))
              .groupBy("high").agg(F.collect_set("low").alias("low"))
              .mapInArrow(pack, "high long, bits binary").collect())  # at most 1,024 rows of 8 KiB
    whole = bytearray(1 << (MAP_BITS - 3))
    step = 1 << (SLICE_BITS - 3)
    for row in slices:
        whole[row["high"] * step:(row["high"] + 1) * step] = row["bits"]
    return spark.sparkContext.broadcast(bytes(whole))


def find_overlaps(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
                  keep: tuple[str, ...] = ("doc_id",), window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """One row per document: the kept columns, n_words, spans (word positions, end exclusive, merged), n_hit, item_ids.

    ``spans`` are the parts of the document that lie inside shared windows; ``item_ids`` are the items that have one.
    """
    spark = docs.sparkSession
    tests = stage(items.select(F.col(item_id).alias("item_id"), F.col(item_text).cast("binary").alias("text"))
                  .withColumn("item_row", F.monotonically_increasing_id()), "items")
    prints = stage(tests.select("item_row", "text").mapInArrow(
        _item_rows(window, gram), "item_row long, fp long, item_pos int, size int, item_words array<long>, n_words long"), "item-prints")
    shorts = sorted(r[0] for r in prints.filter(F.col("n_words") < window).select("size").distinct().collect())
    kept = [F.col(c).alias(f"keep_{i}") for i, c in enumerate(keep)]
    found = stage(
        docs.select(F.struct(*kept).alias("kept"), F.col(text).cast("binary").alias("text"))
        .withColumn("doc_row", F.monotonically_increasing_id()).transform(_scan, window, gram, shorts, _bit_map(spark, prints)),
        "document-prints")
    hits = found.filter("fp is not null").drop("n_words", "kept")
    # Only what many documents hold is repeated: Spark does not see that rows are when it decides what to broadcast.
    hot = F.col("fp").isin(heavy_keys(hits, {"fp": F.col("fp")})["fp"])
    zero = F.lit(0).cast("long")
    hits = hits.withColumn("salt", F.when(hot, F.pmod(F.xxhash64("doc_row"), F.lit(SALTS))).otherwise(zero))
    salted = prints.withColumn("salt", F.explode(F.when(hot, F.sequence(zero, F.lit(SALTS - 1).cast("long"))).otherwise(F.array(zero))))
    spans = (hits.join(salted, ["fp", "size", "salt"])
             .select("doc_row", "item_row", "pos", "size", "before", "near", "item_pos", "item_words", "n_words")
             .mapInArrow(_extend(window), "doc_row long, item_row long, first long, last long").distinct())
    named = spans.join(tests.select("item_row", "item_id"), "item_row")
    merged = F.aggregate(
        F.array_sort("parts"), F.array().cast("array<struct<first:long,last:long>>"),
        lambda done, x: F.when((F.size(done) > 0) & (F.element_at(done, -1)["last"] >= x["first"]),
                               F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(
                                   F.element_at(done, -1)["first"].alias("first"),
                                   F.greatest(F.element_at(done, -1)["last"], x["last"]).alias("last")))))
        .otherwise(F.concat(done, F.array(x))))
    by_doc = (named.groupBy("doc_row").agg(F.collect_set(F.struct("first", "last")).alias("parts"),
                                           F.collect_set("item_id").alias("item_ids"))
              .select("doc_row", merged.alias("spans"), "item_ids"))
    total = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["last"] - x["first"])
    return (found.filter("fp is null").select("doc_row", "kept", "n_words").join(by_doc, "doc_row", "left")
            .select(*[F.col(f"kept.keep_{i}").alias(c) for i, c in enumerate(keep)], "n_words",
                    F.coalesce("spans", F.array()).alias("spans"),
                    F.when(F.col("spans").isNull(), F.lit(0)).otherwise(total).cast("long").alias("n_hit"),
                    F.coalesce("item_ids", F.array()).alias("item_ids")))


def _scan(docs: DataFrame, window: int, gram: int, shorts: list[int], bits) -> DataFrame:
    """The rows of ``_document_rows`` with the kept columns, which travel beside the texts and not through Python twice."""
    inner = _document_rows(window, gram, shorts, bits)
    fields = docs.schema["kept"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            first = batch.column("doc_row")
            kept = dict(zip(first.to_pylist(), range(len(first))))
            for out in inner(iter([batch])):
                of = pa.array([kept[r] for r in out.column(0).to_pylist()], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("kept").take(of), *out.columns],
                                                 ["kept", *out.schema.names])
    return docs.mapInArrow(returned(run), f"kept {fields}, doc_row long, n_words long, fp long, size int, pos long, before int, "
                                "near array<long>")


def contaminated(n_hit="n_hit", n_words="n_words"):
    """The contract's rule: some word is hit, and at least a twentieth of all words."""
    return (F.col(n_hit) > 0) & (F.col(n_hit) * 20 >= F.col(n_words))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    found = find_overlaps(docs, items)
    listed = F.array_join(F.array_sort(F.transform("item_ids", lambda x: x.cast("string"))), ",")
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                        F.sha2(listed.cast("binary"), 256).alias("items_sha256"), contaminated().alias("contaminated"))
