"""Operators on texts against brute force, with nulls, empty texts, repeated rows and clashing columns."""

import collections
import hashlib
import math
import os
import re
import subprocess
import sys

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cardlake.llm import bpe, decontaminate, hashing, jaccard_join, katz
from cardlake.llm.components import components

SMALL = "/root/testdata/sf0.001"
ALNUM = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
ODD = [(9001, None), (9002, ""), (9003, " \t\n"), (9004, "one"), (9005, "One two THREE four"), (9006, "é" * 5000 + " x"), (None, "no id at all"),
       (9007, "a b c d e f"), (9007, "a b c d e f"), (9008, "a b c d e f"), (9009, "<|endoftext|> x ²½ \x1c\x00 😀")]


@pytest.fixture(scope="module")
def docs(spark):
    some = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame(ODD, "doc_id long, text string")
    # names that operators use inside must not clash
    return some.union(odd).repartition(4).select("*", *[F.lit(1).alias(c) for c in ("kept", "doc_row", "sig", "salt", "train", "bucket")])


@pytest.fixture(scope="module")
def texts(docs):
    return [(r["doc_id"], (r["text"] or "").encode()) for r in docs.collect()]


def split(text):
    return text.translate(LOWER).split()


def test_hashes_tell_words_apart():
    import pyarrow as pa
    data = [None, b"", b"Ab aB\x00c ab", b"x " * 3_000_000 + b"y" * 2_000_000, b"z"]
    found = dict(hashing.word_hashes(pa.array(data, pa.binary()), hashing.NON_SPACE))
    assert [len(found[i]) for i in range(5)] == [0, 0, 3, 3_000_001, 1]
    assert found[2][0] == found[2][2] != found[2][1] and len(set(found[3].tolist())) == 2


def test_overlaps(docs, texts, spark):
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet").union(spark.createDataFrame(
        [(8001, "two three FOUR"), (8002, None), (8003, "..."), (None, "c d")], "item_id long, text string"))
    got = decontaminate.find_overlaps(docs, items)
    windows = collections.defaultdict(set)
    for r in items.collect():
        words = ALNUM.findall((r["text"] or "").encode().translate(LOWER))
        n = min(13, len(words))
        for i in range(len(words) - n + 1):
            if n:
                windows[tuple(words[i:i + n])].add(r["item_id"])
    want = []
    for doc, text in texts:
        words, hit, ids = ALNUM.findall(text.translate(LOWER)), set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(words) - n + 1):
                if tuple(words[i:i + n]) in windows:
                    hit.update(range(i, i + n))
                    ids |= windows[tuple(words[i:i + n])]
        want.append((doc, len(words), len(hit), sorted(x for x in ids if x is not None)))
    found = [(r["doc_id"], r["n_words"], r["n_hit"], sorted(r["item_ids"])) for r in got.collect()]
    assert sorted(found, key=str) == sorted(want, key=str)
    assert any(w[2] for w in want) and decontaminate.find_overlaps(docs.limit(0), items).count() == 0
    assert decontaminate.find_overlaps(docs, items.limit(0)).agg(F.sum("n_hit")).first()[0] == 0


def test_links(docs, texts):
    sets = [(doc, frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if (w := split(t)) else frozenset()) for doc, t in texts]
    root = list(range(len(sets)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            a, b = sets[i][1], sets[j][1]
            both = len(a & b)
            if both and 100 * both >= 80 * (len(a) + len(b) - both):
                root[max(top(i), top(j))] = min(top(i), top(j))
    least = collections.defaultdict(list)
    for i, (doc, _) in enumerate(sets):
        least[top(i)].append(doc)
    want = [(doc, len(s), min((x for x in least[top(i)] if x is not None), default=None)) for i, (doc, s) in enumerate(sets)]
    got = [tuple(r) for r in jaccard_join.link_documents(docs).collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and len({w[2] for w in want}) < len(want) - 3
    assert jaccard_join.link_documents(docs.limit(0)).count() == 0


def test_links_within_a_large_family(spark):
    """Near copies of one text that change different words: some link to each other, some only through the original."""
    base = [f"w{i}" for i in range(120)]
    rows = [(0, " ".join(base))]
    for i in range(1, 60):
        own = list(base)
        for k in range(1 + i % 4):
            own[(i * 7 + k * 31) % 120] = f"new{i}_{k}"
        rows.append((i, " ".join(own)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    sets = {d: frozenset(tuple(t.split()[i:i + 5]) for i in range(116)) for d, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    root = {d: d for d in sets}
    for _ in sets:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    assert {r["doc_id"]: r["component_id"] for r in jaccard_join.link_documents(df).collect()} == root


@pytest.fixture
def small_broadcasts(spark):
    """No table may take more than a page of 32 MiB and its index when it is broadcast."""
    before = spark.conf.get("spark.sql.maxBroadcastTableSize")
    spark.conf.set("spark.sql.maxBroadcastTableSize", str(40 << 20))
    yield
    spark.conf.set("spark.sql.maxBroadcastTableSize", before)


def test_linked_rows_are_broadcast_only_as_they_are(spark, small_broadcasts):
    """The classes' rows are not repeated for salts behind Spark's estimate, but for a class of very many documents."""
    texts = F.concat_ws(" ", *[F.concat(F.lit(f"w{i}x"), F.col("id").cast("string")) for i in range(6)])
    docs = spark.range(15_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "one and the same text of all these").otherwise(texts).alias("text"))
    got = jaccard_join.link_documents(docs.union(spark.range(-5, 0).select("id", F.lit(None).cast("string"))))
    assert got.groupBy((F.col("component_id") == F.col("doc_id")).alias("alone")).count().orderBy("alone").collect() == [(False, 4999), (True, 10_006)]
    assert got.where("component_id = 0 and doc_id % 3 = 0 and n_shingles = 4").count() == 5000


def test_item_prints_are_broadcast_only_as_they_are(spark, small_broadcasts):
    """A passage of all documents is spread, the other items' rows are not repeated."""
    words = F.concat_ws(" ", *[F.concat(F.lit(f"w{i}x"), F.pmod("id", F.lit(40)).cast("string")) for i in range(60)])
    own = F.concat_ws(" ", *[F.concat(F.lit(f"p{i}x"), F.pmod("id", F.lit(900)).cast("string")) for i in range(14)])
    passage = " ".join(f"c{i}" for i in range(14))
    items = spark.range(900).select(F.col("id").alias("item_id"), F.concat_ws(" ", words, own).alias("text")).union(
        spark.createDataFrame([(1000, passage)], "item_id long, text string"))
    docs = spark.range(9000).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit(passage), own).alias("text"))
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], sorted(r["item_ids"])) for r in decontaminate.find_overlaps(docs, items).collect()}
    assert got == {i: (28, 28, [i % 900, 1000]) for i in range(9000)}


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (7, 7)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}


@pytest.mark.parametrize("order", [2, 3])
def test_katz(docs, texts, order):
    train = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) != 1
    got = katz.score_documents(docs.withColumn("learn", train), "learn", keep=("doc_id",), order=order).collect()
    flags = {r["doc_id"]: r["learn"] for r in docs.select("doc_id", train.alias("learn")).collect()}
    rows = [(doc, split(t) + ["end"]) for doc, t in texts]
    counts = [collections.Counter() for _ in range(order + 1)]
    for doc, words in rows:
        if flags[doc]:
            for n in range(1, order + 1):
                counts[n].update(tuple(words[i:i + n]) for i in range(len(words) - n + 1))
    total, types = sum(counts[1].values()), len(counts[1])
    cut = [None] + [katz.discounts([0, 0, *[sum(c == r for c in counts[n].values()) for r in range(1, katz.LIMIT + 2)]]) for n in range(1, order + 1)]
    factor = lambda n, c: cut[n][c - 1] if c <= katz.LIMIT else 1.0
    unknown = sum((1 - factor(1, c)) * c for c in counts[1].values()) / total
    follow = collections.defaultdict(dict)
    for n in range(2, order + 1):
        for g, c in counts[n].items():
            follow[g[:-1]][g[-1]] = c
    weights = {}

    def p(word, history):
        if not history:
            c = counts[1].get((word,), 0)
            return factor(1, c) * c / total if c else unknown
        if history not in follow:
            return p(word, history[1:])
        n, seen = len(history) + 1, follow[history]
        if history not in weights:
            whole, left = sum(seen.values()), sum((1 - factor(n, c)) * c for c in seen.values())
            if left <= 0:
                whole, left = whole + 1, 1
            weights[history] = whole, left / whole / (1 - sum(p(w, history[1:]) for w in seen))
        whole, weight = weights[history]
        return factor(n, seen[word]) * seen[word] / whole if word in seen else weight * p(word, history[1:])

    want = sorted((str(doc), len(w), sum((x,) in counts[1] for x in w), total,
                   round(sum(math.log10((counts[1].get((x,), 0) + 0.5) / (total + 0.5 * (types + 1))) for x in w), 6),
                   round(sum(math.log10(p(w[i], tuple(w[max(0, i - order + 1):i]))) for i in range(len(w))), 6)) for doc, w in rows)
    found = sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6), round(r["score"], 6)) for r in got)
    assert [f[:4] for f in found] == [w[:4] for w in want]
    assert all(abs(a - b) < 1e-5 for f, w in zip(found, want) for a, b in zip(f[4:], w[4:]))
    history = max((h for h in follow if len(h) == order - 1), key=lambda h: sum(follow[h].values()))
    mass = sum(p(w, history) for (w,) in counts[1])
    assert abs(mass + p(object(), history) - 1) < 1e-9  # exactly normalised, the unknown word included


def test_katz_without_training(docs):
    rows = katz.score_documents(docs.limit(5).withColumn("learn", F.lit(False)), "learn").collect()
    assert len(rows) == 5 and all(r["score"] == 0 == r["train_tokens"] for r in rows)
    assert katz.score_documents(docs.limit(0).withColumn("learn", F.lit(True)), "learn").count() == 0


def test_katz_answers_take_few_bytes(spark):
    """Answers to a block hold no more than a few bytes per n-gram, and shuffle files don't outlive the query that made them."""
    import numpy as np

    from cardlake.session import scratch_path
    r = np.random.default_rng(3)
    rows = [(i, " ".join(f"w{x}" for x in np.minimum(r.zipf(1.3, 2000), 4000))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("learn", F.col("doc_id") % 5 != 1)
    path = scratch_path(spark, "katz-test")
    before = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    assert katz.score_documents(df, "learn", order=3, tables=path).count() == 60
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == before
    size = F.sum(F.octet_length("counts") + F.coalesce(F.octet_length("ranks"), F.lit(0)) + F.octet_length("details"))
    answers = spark.read.parquet(path).where(f"kind = {katz.RESPONSE} and n > 1").agg(size).first()[0]
    grams = sum(len({tuple(w[i:i + n]) for _, t in rows for w in [t.split() + ["end"]] for i in range(len(w) - n + 1)}) for n in (2, 3))
    assert answers < 5.5 * grams


def test_katz_tells_numbers_of_contexts_that_fail_alone(spark):
    """Where every n-gram was seen, a block gets a few bits of a context; hot contexts and those that nothing discounts are scored all the same."""
    import numpy as np

    from cardlake.session import scratch_path
    r = np.random.default_rng(4)
    rows = [(i, " ".join(f"w{x}" for x in np.minimum(r.zipf(1.3, 2000), 4000)) + " so it is" * 3) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("learn", F.lit(True))
    path = scratch_path(spark, "katz-test")
    assert all(x["n_known"] == x["n_tokens"] and x["score"] < 0 for x in katz.score_documents(df, "learn", order=3, tables=path).collect())
    told = spark.read.parquet(path).where(f"kind = {katz.RESPONSE} and n > 1")
    grams = sum(len({tuple(w[i:i + n]) for _, t in rows for w in [t.split() + ["end"]] for i in range(len(w) - n + 1)}) for n in (2, 3))
    assert told.agg(F.sum(F.octet_length("details"))).first()[0] - 80 * told.count() < 0.1 * grams


def test_katz_codes_are_exact():
    import numpy as np
    ids = np.array([5 << katz.RANK_BITS, (5 << katz.RANK_BITS) + 3, 7, (9 << katz.RANK_BITS) + 1], np.int64)
    assert katz._open_ids(katz._press_ids(ids)).tolist() == katz._open_numbers(katz._press_numbers(ids)).tolist() == ids.tolist()
    for top in (0, 255, 256, 1 << 40):
        assert katz._open_ints(katz._press_ints(np.array([0, top, 1]))).tolist() == [0, top, 1]
    for key in (np.array([4, 1, 4, 0]), np.array([4, 1, 4, 0]) << 60 >> 1):
        got, places = katz._sorted_places(key)
        assert got.tolist() == sorted(key.tolist()) and places.tolist() == [3, 1, 0, 2]


def test_python_workers_give_memory_back():
    """What a task has freed is not kept by its process, though something small was made last."""
    code = """
import numpy as np
from cardlake.llm import memory
def held(): return int(open('/proc/self/statm').read().split()[1]) * 4096 / 1e6
pins = []
def run(batches):
    for batch in batches:
        small = [np.zeros(4000, np.uint8) + 1 for _ in range(50_000)]
        pins.extend(np.zeros(100, np.uint8) for _ in range(100))
        yield len(small)
before = held()
assert list(memory.returned(run)(iter([0]))) == [50_000]
print(held() - before)
table = memory.returned_by_group(lambda t: [np.zeros(4000, np.uint8) + 1 for _ in range(t)][:1])(50_000)
print(held() - before)
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True,
                         env=os.environ | {"PYTHONPATH": os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))}).stdout
    assert all(float(x) < 50 for x in out.split()), out


def test_part_keys_take_no_objects():
    """The keys of many classes are passed on as arrays, a bounded number at a time."""
    import tracemalloc
    from types import SimpleNamespace

    import numpy as np
    import pyarrow as pa
    r = np.random.default_rng(1)
    sets = [np.sort(r.integers(1, 1 << 63, 400).astype(np.uint64)) for _ in range(2000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(2000), pa.int64()), pa.array([400] * 2000, pa.int64()), pa.array([400] * 2000, pa.int64()),
                                        pa.array([x.tobytes() for x in sets], pa.binary())], ["home", "n", "s", "tokens"])
    bits = SimpleNamespace(value=b"\xff" * (1 << (jaccard_join.MAP_BITS - 3)))
    for made, names in ((jaccard_join._holding((80, 100), [(200, 1, 1000), (250, 1, 1000)], bits), ["key", "other"]),
                        (jaccard_join._asking((80, 100)), ["key", "home", "n", "parts"])):
        tracemalloc.start()
        out = list(made(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        rows = sum(b.num_rows for b in out)
        assert out[0].schema.names == names and rows > 100_000 and peak < 60 * rows
        key, home = (np.concatenate([b.column(i).to_numpy() for b in out]) for i in range(2))
        parts = 200 if len(names) == 2 else out[0].column(3)[0].as_py()
        assert set(jaccard_join.part_keys(sets[7], parts).view(np.int64).tolist()) <= set(key[home == 7].tolist())


def test_bpe(docs, texts):
    tokenizers = pytest.importorskip("tokenizers")
    path = bpe.default_vocabulary()
    reference = tokenizers.Tokenizer.from_file(path)
    encoded = bpe.encode_documents(docs, path)
    got = sorted(((str(r["doc_id"]), r["n_tokens"], r["ids_sha256"], r["decoded_sha256"], r["ids"]) for r in encoded.collect()), key=str)
    want = []
    for doc, text in texts:
        ids = reference.encode(text.decode(), add_special_tokens=False).ids
        back = reference.decode(ids, skip_special_tokens=False).encode()
        want.append((str(doc), len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back).hexdigest(), ids))
    assert got == sorted(want, key=str)
    back = bpe.decode_documents(encoded, path)
    assert sorted((r["text"].encode() for r in back.collect())) == sorted(t for _, t in texts)


def test_automaton_with_hard_merges():
    """Repeated letters and overlapping merges; each string's path is the one that merging in order gives."""
    import itertools
    letters = {0: b"a", 1: b"b"}
    merges = [(0, 0, 2), (0, 1, 3), (2, 3, 4), (2, 2, 5), (1, 3, 6), (6, 0, 7)]
    labels = dict(letters)
    for u, v, new in merges:
        labels[new] = labels[u] + labels[v]
    automaton = bpe.Automaton(labels, merges, {})
    for n in range(1, 11):
        for word in itertools.product((0, 1), repeat=n):
            ids = list(word)
            for u, v, new in merges:
                i = 0
                while i + 1 < len(ids):
                    if (ids[i], ids[i + 1]) == (u, v):
                        ids[i:i + 2] = [new]
                    i += 1
            path, at = [], b"".join(letters[x] for x in word)
            automaton.token_of.pop(at, None)  # the whole word must not be looked up
            path = automaton.encode(at) if ids != [automaton.token_of.get(at)] and len(ids) > 1 else ids
            automaton.token_of = {label: t for t, label in labels.items()}
            assert path == ids, word


def test_encoding_many_words_holds_little():
    """Words that never come again leave next to nothing behind in a task."""
    import random
    import tracemalloc
    automaton = bpe.compile_merges(bpe.default_vocabulary())
    pick = random.Random(5)
    words = [bytes(pick.choices(b" etaoinshrdlu", k=9)) for _ in range(30_000)]
    tracemalloc.start()
    for word in words:
        assert automaton.decode(automaton.encode(word)) == word
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held < 20_000_000


def test_blocks_against_all_pairs():
    import numpy as np
    pick = np.random.default_rng(7)
    base = pick.integers(0, 2**63, 90, dtype=np.uint64)

    def block(seed, n):
        r, sets = np.random.default_rng(seed), []
        for _ in range(n):
            kept = base[r.random(90) > r.choice([0.02, 0.08, 0.2])]
            sets.append(np.unique(np.concatenate([kept, r.integers(0, 2**63, r.integers(0, 5), dtype=np.uint64)])))
        ns = np.array([len(s) + int(r.integers(0, 4)) for s in sets])  # some shingles that nobody else has
        return {"cids": np.arange(n) + 1000 * seed, "grps": r.integers(0, 25, n) + 1000 * (seed % 2), "ns": ns,
                "sizes": np.array([len(s) for s in sets]), "tokens": np.concatenate(sets)}, sets

    for seeds in ((1, 2), (3, 4), (5, 5)):
        (a, a_sets), (b, b_sets) = block(seeds[0], 60), block(seeds[1], 70 if seeds[0] != seeds[1] else 60)
        linked = set()
        for i, x in enumerate(a_sets):
            for j, y in enumerate(b_sets):
                both = len(np.intersect1d(x, y))
                if a["grps"][i] != b["grps"][j] and 100 * both >= 80 * (a["ns"][i] + b["ns"][j] - both):
                    linked.add((int(a["grps"][i]), int(b["grps"][j])))
        got = jaccard_join.block_links(a, b, (80, 100))
        group = dict(zip(a["cids"].tolist(), a["grps"].tolist())) , dict(zip(b["cids"].tolist(), b["grps"].tolist()))
        told = [(group[0][x], group[1][y]) for x, y in got]
        assert set(told) <= linked and linked

        def roots(edges):
            parent = {}
            def find(x):
                while x in parent:
                    x = parent[x]
                return x
            for x, y in edges:
                if find(x) != find(y):
                    parent[find(x)] = find(y)
            return {frozenset(n for e in linked for n in e if find(n) == find(x)) for x, _ in linked}
        assert roots(told) == roots(linked) and len(told) <= len({n for e in linked for n in e})


def test_sets_of_a_link_agree_in_a_part():
    import numpy as np
    pick = np.random.default_rng(1)
    for _ in range(300):
        a = np.unique(pick.integers(0, 2**63, pick.integers(1, 200), dtype=np.uint64))
        b = np.unique(np.concatenate([a[pick.random(len(a)) > 0.1], pick.integers(0, 2**63, pick.integers(0, 9), dtype=np.uint64)]))
        differing = len(np.setxor1d(a, b))
        for parts in jaccard_join._ladder(1000):
            keys = jaccard_join.part_keys(a, parts)
            if len(keys) > differing:
                assert np.isin(keys, jaccard_join.part_keys(b, parts)).any()
                break


def test_links_by_small_blocks(spark, monkeypatch):
    """Far copies of one text, which mostly do not link, in many blocks of few classes."""
    import random
    monkeypatch.setattr(jaccard_join, "BLOCK_CLASSES", 7)
    monkeypatch.setattr(jaccard_join, "_COLUMNS", 64)
    pick = random.Random(11)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for i in range(160):
        words = list(base)
        for _ in range(pick.randrange(0, 7)):
            at = pick.randrange(len(words))
            words[at:at + 1] = pick.choice([[], [f"x{pick.randrange(12)}"], [f"u{i}"]])
        texts.append((i, " ".join(words)))
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)

    def shingles(text):
        words = text.split()
        return {tuple(words[j:j + 5]) for j in range(len(words) - 4)}
    sets, root = [shingles(t) for _, t in texts], list(range(160))
    changed = True
    while changed:
        changed = False
        for i in range(160):
            for j in range(i):
                if root[i] != root[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                    root[i] = root[j] = min(root[i], root[j])
                    changed = True
    assert len(set(root)) > 5
    assert {r["doc_id"]: r["component_id"] for r in jaccard_join.link_documents(df).collect()} == dict(enumerate(root))


def test_overlaps_with_a_very_long_item(spark):
    """An item of 100,000 words: its fingerprints carry a window of it, not the whole."""
    import time
    words = [f"w{i}" for i in range(100_000)]
    items = spark.createDataFrame([(1, " ".join(words)), (2, "short item")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "x " + " ".join(words[50_000:50_040]) + " y"), (2, " ".join(words[70:82])), (3, "a short item here"),
                                  (4, " ".join(words))], "doc_id long, text string")
    start = time.time()
    got = {r["doc_id"]: (r["n_hit"], r["item_ids"]) for r in decontaminate.find_overlaps(docs, items).collect()}
    assert got == {1: (40, [1]), 2: (0, []), 3: (2, [2]), 4: (100_000, [1])} and time.time() - start < 60


def test_shared_shingles_are_found_slice_by_slice(monkeypatch):
    """Packs with a class sent twice and an only shingle; sorted by 7 at a time and all at once."""
    r = np.random.default_rng(3)
    sets = {bytes([i]) * 16: np.unique(r.integers(0, 1 << 48, 9 if i % 2 else 1).astype(np.uint64)) for i in range(20)}
    common = r.integers(0, 1 << 48, 12).astype(np.uint64)
    sets = {s: np.union1d(x, common[i % 3::3]) for i, (s, x) in enumerate(sets.items())}

    def pack(names):
        low = b"".join(sets[s].view(np.uint8).reshape(-1, 8)[:, :6].tobytes() for s in names)
        return 5, b"".join(names), np.array([len(sets[s]) for s in names], np.uint32).tobytes(), low

    names = list(sets)
    cells = list(zip(*[pack(names[:8]), pack(names[6:15]), pack(names[15:])]))
    table = pa.table({"bucket": pa.array(cells[0], pa.int32()), **{n: pa.array(c, pa.binary()) for n, c in zip(("sigs", "many", "low"), cells[1:])}})
    whole = jaccard_join._shared(4)(table).to_pylist()
    monkeypatch.setattr(jaccard_join, "SLICE", 7)
    assert jaccard_join._shared(4)(table).to_pylist() == whole
    got = {s: set() for s in names}
    for row in whole:
        tokens, at = np.frombuffer(row["tokens"], np.uint64) & np.uint64((1 << 48) - 1), 0
        for i, n in enumerate(np.frombuffer(row["many"], np.uint32)):
            got[row["sigs"][16 * i:16 * i + 16]] |= set(tokens[at:at + n].tolist())
            at += n
    holders = {}
    for s, x in sets.items():
        for t in x.tolist():
            holders.setdefault(t, set()).add(s)
    assert got == {s: {t for t in x.tolist() if len(holders[t]) > 1} for s, x in sets.items()}
