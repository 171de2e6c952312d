"""The ball-tree search against a plain scan, and its pruning."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardlake.llm import lexical as L

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items, k):
    docs = [(i, Counter(terms(t))) for i, t in docs]
    docs = [(i, c) for i, c in docs if c]
    total, df = sum(sum(c.values()) for _, c in docs), Counter(t for _, c in docs for t in c)
    out = []
    for item, text in items:
        asked, scored = terms(text), []
        for doc, c in docs:
            m, score = 75 + 25 * sum(c.values()) * len(docs) // total, 0
            for t in asked:
                if t in c:
                    score += math.floor(1000 * math.log((2 * len(docs) + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
            if score > 0 and doc is not None:
                scored.append((-score, doc))
        out += [(item, r, doc, -score) for r, (score, doc) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("block,items_per_block", [(4096, 2048), (40, 7)])
def test_against_plain_scan(spark, monkeypatch, block, items_per_block):
    monkeypatch.setattr(L, "BLOCK", block)
    monkeypatch.setattr(L, "ITEMS", items_per_block)
    monkeypatch.setattr(L, "LEAF", 4)
    pick = random.Random(6)
    words = [f"w{i}" for i in range(60)] + ["Élan", "İx", "naïve", "X9"]
    text = lambda n: pick.choice([" ", "-", "\n", "!_"]).join(pick.choices(words, k=n))
    docs = [(i, text(pick.randrange(1, 60))) for i in range(400)]
    docs += [(1000 - i, "w1 w2 copied X9 text") for i in range(150)] + [(3, docs[3][1]), (2000, None), (2001, ""), (2002, "… ..."), (None, "w1 w2 w3 w59"),
                                                                     (2003, "w5 " * 30000), (2004, "WORDS elsewhere")]
    items = [(i, text(pick.randrange(1, 9))) for i in range(18)] + [(50, "w1 w2 copied"), (51, "W1 w1 x9"), (52, None), (53, "unknown"), (54, "!!"), (2, "w7 w8")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3).withColumn("one", F.lit("x")).withColumn("n", F.lit(1))
    asked = spark.createDataFrame(items, "item_id long, text string").repartition(2).withColumn("doc_id", F.lit(0))
    got = sorted(tuple(r) for r in L.rank_documents(frame, asked, 10).collect())
    assert got == plain(docs, items, 10)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert [tuple(r) for r in L.rank_documents(docs, items).collect()] == [(1, 1, 1, plain([(1, "a b")], [(1, "a")], 5)[0][3])]
    assert L.rank_documents(docs.limit(0), items).collect() == [] and L.rank_documents(docs, items.limit(0)).collect() == []


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(0)
    rows, topics = [], rng.integers(0, 40, 3000)
    for topic in topics:
        t = np.unique(np.concatenate([rng.integers(topic * 50, topic * 50 + 50, 30), rng.integers(2000, 2040, 5)]))
        rows.append((t.astype(np.uint64), rng.integers(1, 10**6, len(t))))
    ptr = np.cumsum([0] + [len(t) for t, _ in rows])
    tree = L.build_tree(np.arange(3000), ptr, np.concatenate([t for t, _ in rows]), np.concatenate([x for _, x in rows]))
    assert sorted(tree["ids"].tolist()) == list(range(3000))
    items = []
    for topic in range(40):
        t = np.sort(rng.choice(np.arange(topic * 50, topic * 50 + 50), 20, replace=False)).astype(np.uint64)
        items.append((t, rng.integers(1, 9000, 20), 0))
    counted = []
    for (t, q, _), (ids, scores) in zip(items, L.search_tree(tree, items, 10, counted=counted)):
        weight = dict(zip(t.tolist(), q.tolist()))
        want = sorted((-sum(weight.get(a, 0) * int(b) for a, b in zip(u.tolist(), x.tolist())), i) for i, (u, x) in enumerate(rows))[:10]
        assert [(-int(s), int(i)) for i, s in zip(ids, scores)] == want
    assert sum(counted) < 0.4 * 40 * int((tree["right"] == 0).sum())
