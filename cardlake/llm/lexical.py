"""Exact ranked lexical search by sparse ball trees.

Documents become sparse vectors over the terms that some item has (terms that no item has are dropped in the scan by a bit map of
fixed size), items become sparse vectors of weights. Every few thousand documents make a block: equal vectors are one point with all
their ids, and the points are split between two far ones into a tree whose nodes hold a centroid and a radius. The
inner product of an item with anything below a node is at most <item, centroid> + |item| * radius, the item's length being taken over
the terms that occur below the node; the bound is rounded up by more than the arithmetic can lose. Two passes search the blocks:
the first opens the best leaf of each and gives a floor under every item's k-th score, the second opens subtrees best first until
no bound reaches the floor or the block's own k-th score. Leaves are scored in 64-bit integers. Items come in blocks of bounded size, one pass each.

Defined cases: a null text has no terms and is no document; an item without known terms (or a null one) has no rows; repeated
items are asked each, repeated documents rank each; equal scores go by ascending doc_id; a document without an id counts in N, L
and df but is not ranked; empty tables give no rows; other columns are ignored. Terms are compared by 64-bit hashes.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from cardlake.llm import hashing as H
from cardlake.llm.decontaminate import _bit_map, MAP_BITS
from cardlake.session import stage

K = 20
BLOCK, BLOCK_TERMS = 4096, 1 << 20  # documents and entries of a block of documents; one document more may end it
LEAF = 32  # points of a leaf
ITEMS, ITEM_TERMS = 2048, 1 << 18  # items and entries of a block of items; one item more may end it
_DF_HELD = 1 << 20
_SPARSE = "doc_id long, n long, terms binary, tfs binary"
_TREE = ("ids", "id_ptr", "ptr", "tix", "x", "vocab", "begin", "end", "right", "radius", "least", "cptr", "cnode", "cval")
_KINDS = dict(ids=np.int64, id_ptr=np.int32, ptr=np.int32, tix=np.int32, x=np.int64, vocab=np.uint64, begin=np.int32, end=np.int32,
              right=np.int32, radius=np.float64, least=np.int64, cptr=np.int64, cnode=np.int32, cval=np.float32)


def _item_terms(batches):
    for batch in batches:
        rows, terms, counts = [], [], []
        ids = batch.column("item_row").to_pylist()
        for row, words in H.word_hashes(batch.column("text"), H.ALNUM):
            own, n = np.unique(words, return_counts=True)
            rows += [ids[row]] * len(own)
            terms.append(own.view(np.int64))
            counts.append(n)
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(np.concatenate(terms) if rows else [], pa.int64()),
                                          pa.array(np.concatenate(counts) if rows else [], pa.int64())], ["item_row", "term", "count"])


def _sparse_rows(bits):
    """n and the terms that pass the bit map, with their counts, of every document that has a term."""
    def run(batches):
        known = np.frombuffer(bits.value, np.uint8)
        for batch in batches:
            out, ids = [], batch.column("doc_id").to_pylist()
            for row, words in H.word_hashes(batch.column("text"), H.ALNUM):
                if len(words):
                    slot = (words >> H.U(64 - MAP_BITS)).astype(np.int64)
                    hit = words[(known[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)]
                    terms, tfs = np.unique(hit, return_counts=True)
                    out.append((ids[row], len(words), terms.tobytes(), tfs.astype(np.int64).tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.binary(), pa.binary()))],
                                                 ["doc_id", "n", "terms", "tfs"])
    return run


def _document_counts(batches):
    """Documents per term, summed up in the task; what is held is passed on when it grows."""
    held, n = [], 0

    def flush():
        terms, counts = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(terms.view(np.int64)), pa.array(counts)], ["term", "df"])

    for batch in batches:
        for terms in batch.column("terms").to_pylist():
            held.append(np.frombuffer(terms, np.uint64))
            n += len(held[-1])
            if n >= _DF_HELD:
                yield flush()
                held, n = [], 0
    if held:
        yield flush()


def build_tree(ids: np.ndarray, ptr: np.ndarray, terms: np.ndarray, x: np.ndarray, leaf: int = LEAF) -> dict[str, np.ndarray]:
    """The ball tree of sparse rows; equal rows are one point. Nodes stand in preorder, the left child right behind its parent."""
    vocab, tix = np.unique(terms, return_inverse=True)
    points: dict[bytes, list[int]] = {}
    for i in range(len(ids)):
        a, b = ptr[i], ptr[i + 1]
        points.setdefault(tix[a:b].tobytes() + x[a:b].tobytes(), []).append(i)
    members = [sorted(ids[m].tolist()) for m in points.values()]
    rows = [(tix[ptr[m[0]]:ptr[m[0] + 1]], x[ptr[m[0]]:ptr[m[0] + 1]].astype(np.float64)) for m in points.values()]
    norms = np.array([v @ v for _, v in rows])
    least = np.array([m[0] for m in members], np.int64)
    lengths = np.array([len(t) for t, _ in rows], np.int64)
    dense, nodes, order, centroids = np.zeros(len(vocab)), [], [], []

    def gather(own):
        return np.concatenate([rows[i][0] for i in own]), np.concatenate([rows[i][1] for i in own]), np.concatenate([[0], np.cumsum(lengths[own])[:-1]])

    def distance(own, t, v, starts, c_terms, c_values):
        """Squared distances of points to a sparse vector, not below the exact ones by more than rounding."""
        dense[c_terms] = c_values
        near = dense[t]
        apart = np.add.reduceat((v - near) ** 2, starts) + np.maximum(0, (c_values @ c_values) - np.add.reduceat(near * near, starts))
        dense[c_terms] = 0
        return apart + 1e-9 * (norms[own] + c_values @ c_values)

    def split(own):
        t, v, starts = gather(own)
        support, where = np.unique(t, return_inverse=True)
        centre = (np.bincount(where, weights=v) / len(own)).astype(np.float32)
        away = distance(own, t, v, starts, support, centre.astype(np.float64))
        at = len(nodes)
        nodes.append([len(order), 0, 0, float(np.sqrt(away.max())), int(least[own].min())])
        centroids.append((support, centre))
        if len(own) <= leaf:
            order.extend(own.tolist())
        else:
            a = own[int(away.argmax())]
            from_a = distance(own, t, v, starts, *rows[a])
            b = own[int(from_a.argmax())]
            side = from_a - distance(own, t, v, starts, *rows[b])
            rank = np.argsort(side, kind="stable")
            half = min(max(int((side < 0).sum()), len(own) // 8), len(own) - len(own) // 8)  # keeps the depth logarithmic
            split(own[rank[:half]])
            nodes[at][2] = len(nodes)
            split(own[rank[half:]])
        nodes[at][1] = len(order)

    split(np.arange(len(rows)))
    support = np.concatenate([c for c, _ in centroids])
    by_term = np.argsort(support, kind="stable")
    begin, end, right, radius, low = zip(*nodes)
    out = dict(
        ids=np.concatenate([members[i] for i in order]), id_ptr=np.cumsum([0] + [len(members[i]) for i in order]),
        ptr=np.cumsum(np.append(0, lengths[order])), tix=np.concatenate([rows[i][0] for i in order]),
        x=np.concatenate([rows[i][1] for i in order]), vocab=vocab, begin=begin, end=end, right=right, radius=radius, least=low,
        cptr=np.searchsorted(support[by_term], np.arange(len(vocab) + 1)),
        cnode=np.repeat(np.arange(len(nodes)), [len(c) for c, _ in centroids])[by_term], cval=np.concatenate([v for _, v in centroids])[by_term])
    return {name: np.asarray(out[name]).astype(_KINDS[name]) for name in _TREE}


def _trees(documents: int, terms: int):
    """Blocks of documents as trees; a document's entries are 10**9 tf div (1000 tf + 12 m)."""
    def pack(held):
        ids, tixs, xs = zip(*held)
        tree = build_tree(np.array(ids, np.int64), np.cumsum([0] + [len(t) for t in tixs]), np.concatenate(tixs), np.concatenate(xs))
        return pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), *[pa.array([tree[c].tobytes()], pa.binary()) for c in _TREE]], ["one", *_TREE])

    def run(batches):
        held, n = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                tfs = np.frombuffer(row["tfs"], np.int64)
                m = 100 - 25 + (25 * row["n"] * documents) // terms
                held.append((row["doc_id"], np.frombuffer(row["terms"], np.uint64), 10**9 * tfs // (1000 * tfs + 12 * m)))
                n += len(tfs)
                if len(held) >= BLOCK or n >= BLOCK_TERMS:
                    yield pack(held)
                    held, n = [], 0
        if held:
            yield pack(held)
    return run


def search_tree(tree: dict[str, np.ndarray], items, k: int, opened: int | None = None, counted: list | None = None):
    """For each item (terms, weights, floor): ids and scores of the k best documents whose score is at least the floor.

    ``opened`` ends the search of an item after so many leaves; ``counted`` gets the leaves opened.
    """
    vocab, radius, ptr, n_nodes = tree["vocab"], tree["radius"], tree["ptr"], len(tree["radius"])
    dense = np.zeros(len(vocab), np.int64)
    for terms, weights, floor in items:
        at = np.searchsorted(vocab, terms)
        own = at < len(vocab)
        own[own] = vocab[at[own]] == terms[own]
        at, q = at[own], weights[own]
        best_id, best_score, least = np.zeros(0, np.int64), np.zeros(0, np.int64), max(1, floor)
        leaves = 0
        if len(at):
            first, last = tree["cptr"][at], tree["cptr"][at + 1]
            places = np.concatenate([np.arange(a, b) for a, b in zip(first, last)])
            weight = np.repeat(q, last - first).astype(np.float64)
            node = tree["cnode"][places]
            bound = np.bincount(node, weight * tree["cval"][places], n_nodes) + np.sqrt(np.bincount(node, weight * weight, n_nodes)) * radius
            bound = bound * (1 + 1e-9) + 1
            dense[at] = q
            heap = [(-bound[0], 0)]
            while heap and -heap[0][0] >= least and leaves != opened:
                i = heapq.heappop(heap)[1]
                if tree["right"][i]:
                    for child in (i + 1, int(tree["right"][i])):
                        heapq.heappush(heap, (-bound[child], child))
                    continue
                leaves += 1
                a, b = tree["begin"][i], tree["end"][i]
                score = np.add.reduceat(dense[tree["tix"][ptr[a]:ptr[b]]] * tree["x"][ptr[a]:ptr[b]], ptr[a:b] - ptr[a])
                for p in np.flatnonzero(score >= least):
                    ids = tree["ids"][tree["id_ptr"][a + p]:tree["id_ptr"][a + p + 1]][:k]
                    best_id, best_score = np.concatenate([best_id, ids]), np.concatenate([best_score, np.full(len(ids), score[p])])
                if len(best_id) >= k:
                    top = np.lexsort((best_id, -best_score))[:k]
                    best_id, best_score = best_id[top], best_score[top]
                    least = max(least, int(best_score[-1]))
            dense[at] = 0
        if counted is not None:
            counted.append(leaves)
        yield best_id, best_score


def _search(k: int, opened: int | None):
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                cell = lambda name: np.frombuffer(batch.column(name)[i].as_buffer(), _KINDS[name])
                tree = {name: cell(name) for name in _TREE}
                asked = np.frombuffer(batch.column("item_rows")[i].as_buffer(), np.int64)
                q_ptr = np.frombuffer(batch.column("q_ptr")[i].as_buffer(), np.int64)
                terms = np.frombuffer(batch.column("q_terms")[i].as_buffer(), np.uint64)
                weights = np.frombuffer(batch.column("q_weights")[i].as_buffer(), np.int64)
                floors = dict.fromkeys(asked.tolist(), 0) | {f["item_row"]: f["floor"] for f in batch.column("floors")[i].as_py() or []}
                items = [(terms[a:b], weights[a:b], floors[r]) for r, a, b in zip(asked.tolist(), q_ptr, q_ptr[1:])]
                found = list(search_tree(tree, items, k, opened))
                rows = np.repeat(asked, [len(ids) for ids, _ in found])
                yield pa.RecordBatch.from_arrays([pa.array(rows), *[pa.array(np.concatenate(c)) for c in zip(*found)]],
                                                 ["item_row", "doc_id", "score"])
    return run


def _item_blocks(batches):
    """Items with their terms and weights, as many per row as the bounds allow."""
    def pack(held):
        rows, terms, weights = zip(*held)
        ptr = np.cumsum([0] + [len(t) for t in terms])
        cells = [np.array(rows, np.int64), ptr.astype(np.int64), np.concatenate(terms).astype(np.int64), np.concatenate(weights).astype(np.int64)]
        return pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in cells], ["item_rows", "q_ptr", "q_terms", "q_weights"])

    held, n = [], 0
    for batch in batches:
        for row in batch.to_pylist():
            held.append((row["item_row"], np.array([e["term"] for e in row["entries"]], np.int64), np.array([e["weight"] for e in row["entries"]], np.int64)))
            n += len(held[-1][1])
            if len(held) >= ITEMS or n >= ITEM_TERMS:
                yield pack(held)
                held, n = [], 0
    if held:
        yield pack(held)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item_row").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def rank_documents(docs: DataFrame, items: DataFrame, k: int = K, text: str = "text", doc_id: str = "doc_id", item_id: str = "item_id",
                   item_text: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score of the k best documents with a score above 0, for every item."""
    spark = docs.sparkSession
    asked = stage(items.select(F.col(item_id).alias("item_id"), F.col(item_text).cast("binary").alias("text"),
                               F.monotonically_increasing_id().alias("item_row")), "items")
    entries = stage(asked.select("item_row", "text").mapInArrow(_item_terms, "item_row long, term long, count long"), "item-terms")
    bits = _bit_map(spark, entries.select(F.col("term").alias("fp")))
    sparse = stage(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
                   .mapInArrow(_sparse_rows(bits), _SPARSE), "sparse-documents")
    documents, terms = sparse.agg(F.count("*"), F.sum("n")).first()
    counts = sparse.select("terms").mapInArrow(_document_counts, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(1000 * F.log((2 * F.lit(documents) + 2) / (2 * F.col("df") + 1)))
    vectors = (entries.join(counts, "term").select("item_row", "term", (weight * F.col("count")).alias("weight")).filter("weight > 0")
               .groupBy("item_row").agg(F.sort_array(F.collect_list(F.struct("term", "weight"))).alias("entries")))
    vectors = stage(vectors, "item-vectors")
    items_n, entries_n = vectors.agg(F.count("*"), F.sum(F.size("entries"))).first()
    vectors = vectors.repartition(1 + max(items_n // ITEMS, (entries_n or 0) // ITEM_TERMS))  # full blocks, however the rows were dealt
    blocks = stage(vectors.mapInArrow(_item_blocks, "item_rows binary, q_ptr binary, q_terms binary, q_weights binary")
                   .withColumn("block", F.monotonically_increasing_id()), "item-blocks")
    trees = stage(sparse.filter("doc_id is not null and octet_length(terms) > 0")
                  .mapInArrow(_trees(documents, terms), "one int, " + ", ".join(f"{c} binary" for c in _TREE)), "trees")
    found = None
    for block in sorted(r[0] for r in blocks.select("block").collect()):  # numbers only; a block of items is one broadcast row
        own = blocks.filter(F.col("block") == block).withColumn("one", F.lit(0))
        kind = "item_row long, doc_id long, score long"
        first = trees.join(F.broadcast(own.withColumn("floors", F.lit(None).cast("array<struct<item_row:long,floor:long>>"))), "one")
        floors = (_best(first.mapInArrow(_search(k, 1), kind), k).filter(F.col("rank") == k)
                  .agg(F.collect_list(F.struct("item_row", F.col("score").alias("floor"))).alias("floors")))
        told = stage(own.join(F.broadcast(floors.withColumn("one", F.lit(0))), "one"), "floors")
        best = stage(_best(trees.join(F.broadcast(told), "one").mapInArrow(_search(k, None), kind), k), "ranked")
        found = best if found is None else found.unionByName(best)
    if found is None:
        found = spark.createDataFrame([], "item_row long, doc_id long, score long, rank int")
    return found.join(asked.select("item_row", "item_id"), "item_row").select("item_id", "rank", "doc_id", "score")


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(*[spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark")])
