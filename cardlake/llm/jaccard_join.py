"""Exact n-gram Jaccard self-join with a token-group matrix.

1. *Sets.* A document's set is its distinct shingles (64-bit hashes). Equal sets form a class with a 128-bit signature; all
   further work is on classes, so thousands of copies count once per task and are linked by a grouped minimum.
2. *Shared shingles.* Shingles are dealt to buckets by hash, packed as arrays. A bucket counts in how many classes each
   occurs and passes on those of at least two; a shingle of one class alone cannot be part of any overlap. A class whose
   shared shingles are fewer than ``share`` of its set links with nothing and is done: that bound needs no threshold on data.
3. *Prefixes.* With shingles ordered rarest first, two sets that link have ``k`` of their first ``s - ceil(share*n) + k``
   shared shingles in common (k is 16, or the least overlap if that is smaller), so passages that many documents hold are
   not looked at unless a document is little else.
4. *Groups.* Classes are partitioned around leaders: in each round every class is compared with the one class that leads most of
   its prefix shingles. The linked ones form groups.
5. *Homes.* Every class is filed under its group or, if it is linked with nothing, under the group that holds most of its prefix.
   A class's shared shingles are dealt by hash into more parts than a link of that class can have differing shingles, so some part
   that is not empty is the same in both sets of a link. Homes with such a part in common meet.
6. *Token-group matrix.* Homes that meet are compared block by block. A block's matrix holds the union of its members' shingles for
   each group; the overlap of a class with a group's row bounds its overlap with any member. Only groups whose row reaches the least
   overlap are opened, and their members compared exactly, as products of matrices. A pair of blocks is one row, whatever is
   compared in it, and passes on no more links than connect its classes. Classes of one home that no link connects are compared
   with each other by their blocks: that work, though no row, grows with the square of their number.

Steps 4 and 6 leave out only pairs that are already in one component, so components are exact: a pair of different texts
that links is either compared or connected by compared links.

Defined cases: null, empty and word-less texts have an empty set and are linked with nothing; fewer than ``size`` words make one
shingle of the whole; repeated rows and ids link like copies; empty tables give no rows. A null id is never the least of a
component unless the component has no other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from cardlake.llm import hashing as H
from cardlake.llm.components import components
from cardlake.llm.decontaminate import _bit_map, MAP_BITS
from cardlake.llm.memory import returned, returned_by_group
from cardlake.operators.lookups import hot_keys, lookup
from cardlake.session import stage

SIZE, SHARE = 5, (80, 100)
FLUSH = 1 << 21  # shingles that a task holds before it sends them on
SLICE = 1 << 19  # shingles of a bucket that are sorted at a time
KEYS = 1 << 19  # part keys that a task holds before it passes them on
ROUNDS = 3  # leader rounds
PREFIX_OVERLAP = 16  # prefixes are this much longer than a link's differences
BLOCK_CLASSES, BLOCK_TOKENS = 1024, 1 << 20  # a block of classes: about as many of them and of their shingles
_COLUMNS = 4096  # columns of the matrices that are multiplied at a time


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    return np.unique(H.gram_hashes(words, size if len(words) >= size else max(1, len(words))))


def signature(found: np.ndarray) -> bytes:
    """12 bytes that identify a set, then its size in 4."""
    sums = [int(np.add.reduce(H.mix(found ^ H.U(salt)))) for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F)]
    return (((sums[0] << 64 | sums[1]) >> 32) & ((1 << 96) - 1)).to_bytes(12, "big") + len(found).to_bytes(4, "big")


def needed(n: np.ndarray, share: tuple[int, int]) -> np.ndarray:
    """The least overlap that a set of n can have with any set it links with."""
    return -(-n * share[0] // share[1])


def _signatures(size: int):
    def run(batches):
        for batch in batches:
            count, sig = [0] * len(batch), [None] * len(batch)
            for row, words in H.word_hashes(batch.column("text"), H.NON_SPACE):
                if len(words):
                    found = shingle_set(words, size)
                    count[row], sig[row] = len(found), signature(found)
            yield pa.RecordBatch.from_arrays([batch.column("kept"), pa.array(count, pa.int64()), pa.array(sig, pa.binary())],
                                             ["kept", "n_shingles", "sig"])
    return run


def _packs(size: int, buckets: int):
    """(bucket, signatures, how many shingles of each, 48-bit shingles in that order), each class once per flush."""
    def pack(sets: dict[bytes, np.ndarray]):
        sigs = np.frombuffer(b"".join(sets), np.uint8).reshape(-1, 16)
        hashes = np.concatenate(list(sets.values()))
        owner = np.repeat(np.arange(len(sets), dtype=np.int32), [len(x) for x in sets.values()])
        bucket = ((hashes >> H.U(48)) * H.U(buckets) >> H.U(16)).astype(np.uint16)
        order = np.argsort(bucket, kind="stable")
        ends = np.cumsum(np.bincount(bucket, minlength=buckets))
        out = []
        for b in range(buckets):
            at = order[ends[b - 1] if b else 0:ends[b]]
            if len(at):
                who, many = np.unique(owner[at], return_counts=True)
                low = (hashes[at] & H.U((1 << 48) - 1)).view(np.uint8).reshape(-1, 8)[:, :6]
                out.append((b, sigs[who].tobytes(), many.astype(np.uint32).tobytes(), low.tobytes()))
        cols = list(zip(*out))
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *[pa.array(c, pa.binary()) for c in cols[1:]]],
                                          ["bucket", "sigs", "many", "low"])

    def run(batches):
        sets, held = {}, 0
        for batch in batches:
            for _, words in H.word_hashes(batch.column("text"), H.NON_SPACE):
                if not len(words):
                    continue
                found = shingle_set(words, size)
                sig = signature(found)
                if sig not in sets:
                    sets[sig] = found
                    held += len(found)
                if held >= FLUSH:
                    yield pack(sets)
                    sets, held = {}, 0
        if sets:
            yield pack(sets)
    return run


def _wide(low, bucket: int) -> np.ndarray:
    """Shingles as numbers that differ between buckets: 48 bits of hash, then the bucket on top."""
    out = np.zeros((len(low) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(low, np.uint8).reshape(-1, 6)
    out[:, 6:] = np.frombuffer(int(bucket).to_bytes(2, "little"), np.uint8)
    return out.reshape(-1).view(np.uint64)


def _cells(column: pa.ChunkedArray) -> Iterator[pa.Buffer]:
    """The bytes of each cell, not copied."""
    for chunk in column.chunks:
        for cell in chunk:
            yield cell.as_buffer()


def _slices(table: pa.Table, bucket: int, which: np.ndarray, many: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """A bucket's shingles with their classes, in slices of about ``size`` by ascending hash."""
    lows = list(_cells(table.column("low")))
    bits = max(0, (sum(len(x) // 6 for x in lows) - 1) // size).bit_length()
    parts: list[list] = [[] for _ in range(1 << bits)]
    at = 0
    for low in lows:
        wide, end = _wide(low, bucket), at
        left = len(wide)
        while left > 0:
            left -= int(many[end])
            end += 1
        owner = np.repeat(which[at:end], many[at:end])
        at = end
        number = ((wide & H.U((1 << 48) - 1)) >> H.U(48 - bits)).astype(np.int32)
        order = np.argsort(number, kind="stable")
        wide, owner = wide[order], owner[order]
        ends = np.cumsum(np.bincount(number, minlength=1 << bits))
        for i, (a, b) in enumerate(zip([0, *ends[:-1]], ends)):
            if b > a:
                parts[i].append((wide[a:b].copy(), owner[a:b].copy()))
    for i, part in enumerate(parts):
        parts[i] = []
        if part:
            yield np.concatenate([w for w, _ in part]), np.concatenate([o for _, o in part])


def _of_several(low: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The shingles that occur in two classes or more, by shingle and class, and in how many."""
    order = np.lexsort((owner, low))
    low, owner = low[order], owner[order]
    fresh = np.ones(len(low), bool)  # a class that several tasks sent counts once
    fresh[1:] = (low[1:] != low[:-1]) | (owner[1:] != owner[:-1])
    low, owner = low[fresh], owner[fresh]
    start = np.ones(len(low), bool)
    start[1:] = low[1:] != low[:-1]
    runs = np.diff(np.append(np.flatnonzero(start), len(low)))
    counts = np.repeat(runs, runs)
    keep = counts > 1
    return low[keep], owner[keep], counts[keep]


def _shared(parts: int):
    def run(table: pa.Table) -> pa.Table:
        """Of one bucket: shingles that occur in two classes or more, packed per group of classes."""
        bucket = table.column("bucket")[0].as_py()
        raw = np.frombuffer(b"".join(_cells(table.column("sigs"))), "V16")
        many = np.frombuffer(b"".join(_cells(table.column("many"))), np.uint32)
        sigs, which = np.unique(raw, return_inverse=True)
        # Sorted slice by slice: what is held beside the packs is little more than the shared shingles.
        found = [_of_several(*piece) for piece in _slices(table, bucket, which.astype(np.int32), many, SLICE)]
        low, owner, counts = (np.concatenate(c) for c in zip(*found))
        rank = np.minimum(255, np.round(8 * np.log2(counts))).astype(np.uint8)
        part = sigs.view(np.uint8).reshape(-1, 16)[:, :4].copy().view(np.uint32).reshape(-1).astype(np.int64) % parts
        groups = part[owner]
        order = np.lexsort((owner, groups))
        low, owner, rank, groups = low[order], owner[order], rank[order], groups[order]
        out, flat = [], sigs.view(np.uint8).reshape(-1, 16)
        for g in np.unique(groups):
            a, b = np.searchsorted(groups, [g, g + 1])
            who, n = np.unique(owner[a:b], return_counts=True)
            out.append((int(g), flat[who].tobytes(), n.astype(np.uint32).tobytes(), low[a:b].tobytes(), rank[a:b].tobytes()))
        cols = list(zip(*out)) or [[]] * 5
        return pa.Table.from_arrays([pa.array(cols[0], pa.int32()), *[pa.array(c, pa.binary()) for c in cols[1:]]],
                                    ["part", "sigs", "many", "tokens", "ranks"])
    return run


def _candidates(share: tuple[int, int]):
    def run(table: pa.Table) -> pa.Table:
        """Classes whose shared shingles suffice for a link, with these shingles and their prefix."""
        raw = np.frombuffer(b"".join(table.column("sigs").to_pylist()), "V16")
        many = np.frombuffer(b"".join(table.column("many").to_pylist()), np.uint32)
        tokens = np.frombuffer(b"".join(table.column("tokens").to_pylist()), np.uint64)
        ranks = np.frombuffer(b"".join(table.column("ranks").to_pylist()), np.uint8)
        sigs, which = np.unique(raw, return_inverse=True)
        owner = np.repeat(which.astype(np.int32), many)
        sizes = sigs.view(np.uint8).reshape(-1, 16)[:, 12:].copy().view(">u4").reshape(-1).astype(np.int64)
        need, alpha = needed(sizes, share), needed(2 * sizes, (share[0], share[0] + share[1]))
        shared = np.bincount(owner, minlength=len(sigs))
        keep = (shared >= need)[owner]
        tokens, ranks, owner = tokens[keep], ranks[keep], owner[keep]
        order = np.lexsort((tokens, ranks, owner))
        tokens, owner = tokens[order], owner[order]
        out = []
        for i in np.unique(owner):
            a, b = np.searchsorted(owner, [i, i + 1])
            own = tokens[a:b]
            out.append((sigs[i].tobytes(), int(sizes[i]), len(own), int(alpha[i]),
                        own[:len(own) - int(need[i]) + min(PREFIX_OVERLAP, int(need[i]))].view(np.int64).tolist(), np.sort(own).tobytes()))
        cols = list(zip(*out)) or [[]] * 6
        kinds = (pa.binary(), *[pa.int64()] * 3, pa.list_(pa.int64()), pa.binary())
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                    ["sig", "n", "s", "alpha", "prefix", "tokens"])
    return run


def _ladder(limit: int) -> Iterator[int]:
    """Numbers of parts: few enough to be shared by classes of unlike sizes, at most half again as many as needed."""
    n = 1
    while n <= limit:
        yield n
        n = max(n + 1, n * 5 // 4)


def part_keys(tokens: np.ndarray, parts: int) -> np.ndarray:
    """A key for each part that is not empty: equal for sets that agree in this part."""
    spread = H.mix(tokens ^ H.U(0x2545F4914F6CDD1D))
    part = (spread >> H.U(32)) * H.U(parts) >> H.U(32)
    order = np.argsort(part, kind="stable")
    part, spread = part[order], H.mix(spread[order])
    starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
    return H.mix(np.add.reduceat(spread, starts) ^ H.mix(part[starts] * H.U(65537) + H.U(parts)))


def _keyed_rows(found: list[tuple], names: list[str]) -> pa.RecordBatch:
    """A row for each key of the arrays that come first, with the numbers behind them; no Python object per row."""
    keys, *others = zip(*found)
    many = [len(k) for k in keys]
    cols = [np.concatenate(keys).view(np.int64), *[np.repeat(np.array(c, np.int64), many) for c in others]]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names)


def _asking(share: tuple[int, int]):
    """The part keys with which a class looks for linked sets that are no smaller."""
    whole = sum(share)

    def run(batches):
        for batch in batches:
            out = []
            for home, n, s, raw in zip(*(batch.column(c).to_pylist() for c in ("home", "n", "s", "tokens"))):
                tokens, largest = np.frombuffer(raw, np.uint64), s * whole // share[0] - n
                differing = ((s + largest) * whole - 2 * share[0] * (n + largest)) // whole
                for parts in _ladder(8 * s + 8):
                    keys = part_keys(tokens, parts) if parts > differing else ()
                    if len(keys) > differing:
                        out.append((keys, home, n, parts))
                        break
                else:
                    raise AssertionError("no number of parts separates this set")
            if out:
                yield _keyed_rows(out, ["key", "home", "n", "parts"])
    return run


def _holding(share: tuple[int, int], levels: list[tuple[int, int, int]], bits):
    """The part keys of a class that some class asks for; ``levels``: numbers of parts with the sizes of the classes that use them."""
    def run(batches):
        known = np.frombuffer(bits.value, np.uint8)
        for batch in batches:
            out, held = [], 0
            for home, n, raw in zip(*(batch.column(c).to_pylist() for c in ("home", "n", "tokens"))):
                tokens = np.frombuffer(raw, np.uint64)
                for parts, least, most in levels:
                    if least <= n and most * share[1] >= n * share[0]:
                        keys = part_keys(tokens, parts)
                        slot = (keys >> H.U(64 - MAP_BITS)).astype(np.int64)
                        keys = keys[known[slot >> 3] >> (slot & 7).astype(np.uint8) & 1 == 1]
                        if len(keys):
                            out.append((keys, home))
                            held += len(keys)
                if held >= KEYS:
                    yield _keyed_rows(out, ["key", "other"])
                    out, held = [], 0
            if out:
                yield _keyed_rows(out, ["key", "other"])
    return run


def meeting_homes(classes: DataFrame, share: tuple[int, int]) -> DataFrame:
    """``(low, high)``: homes, or one home, that may hold the two sets of a link. Keys are counted once per home."""
    asked = stage(classes.where("s >= alpha").select("home", "n", "s", "tokens")
                  .mapInArrow(returned(_asking(share)), "key long, home long, n long, parts long"), "asked-parts")
    levels = sorted(tuple(r) for r in asked.groupBy("parts").agg(F.min("n"), F.max("n")).collect())  # one row per rung
    bits = _bit_map(classes.sparkSession, asked.select(F.col("key").alias("fp")))
    held = (classes.select("home", "n", "tokens").mapInArrow(returned(_holding(share, levels, bits)), "key long, other long").distinct())
    # The files of both sides are far smaller than their rows in memory, and Spark goes by the files: neither is broadcast.
    met = asked.select("key", "home").distinct().hint("merge").join(held, "key")
    return met.select(F.least("home", "other").alias("low"), F.greatest("home", "other").alias("high")).distinct()


_BLOCK = "home long, block long, cids binary, grps binary, ns binary, sizes binary, tokens binary"


def _pack_block(table: pa.Table) -> pa.Table:
    """Classes of one block in one row: numbers, groups, set sizes, and their shared shingles one after the other."""
    ints = lambda c: table.column(c).to_numpy().astype(np.int64).tobytes()
    raw = table.column("tokens").to_pylist()
    cells = [ints("cid"), ints("grp"), ints("n"), np.array([len(r) // 8 for r in raw], np.int64).tobytes(), b"".join(raw)]
    return pa.table({"home": table.column("home").slice(0, 1), "block": table.column("block").slice(0, 1)}
                    | {n: pa.array([c], pa.binary()) for n, c in zip(("cids", "grps", "ns", "sizes", "tokens"), cells)})


def _overlaps(left: tuple, right: tuple) -> np.ndarray:
    """Sizes of all intersections of two lists of sets, given as (row, column) entries of sparse matrices with so many rows."""
    (a_row, a_col, a_n), (b_row, b_col, b_n) = left, right
    out = np.zeros((a_n, b_n), np.float32)
    for at in range(0, int(max(a_col.max(initial=-1), b_col.max(initial=-1))) + 1, _COLUMNS):
        a, b = np.zeros((a_n, _COLUMNS), np.float32), np.zeros((b_n, _COLUMNS), np.float32)
        for matrix, row, col in ((a, a_row, a_col), (b, b_row, b_col)):
            own = (col >= at) & (col < at + _COLUMNS)
            matrix[row[own], col[own] - at] = 1
        out += a @ b.T
    return out.astype(np.int64)


def block_links(a: dict, b: dict, share: tuple[int, int]) -> list[tuple[int, int]]:
    """Links between the classes of two blocks that connect different groups; of those that close a circle only the first is told."""
    common = np.intersect1d(a["tokens"], b["tokens"])
    if not len(common):
        return []

    def entries(block):
        at = np.minimum(np.searchsorted(common, block["tokens"]), len(common) - 1)
        own = common[at] == block["tokens"]
        return np.repeat(np.arange(len(block["sizes"])), block["sizes"])[own], at[own]

    (a_row, a_col), (b_row, b_col) = entries(a), entries(b)
    groups, of_group = np.unique(b["grps"], return_inverse=True)
    # The matrix: a row per group with the union of its members' shingles, and the size of its smallest member.
    union = np.unique(of_group[b_row].astype(np.int64) * len(common) + b_col)
    least = np.full(len(groups), np.iinfo(np.int64).max)
    np.minimum.at(least, of_group, b["ns"])
    bound = _overlaps((a_row, a_col, len(a["ns"])), (union // len(common), union % len(common), len(groups)))
    whole = sum(share)
    qualify = (bound * whole >= share[0] * (a["ns"][:, None] + least[None, :])) & (a["grps"][:, None] != groups[None, :])
    opened, asks = qualify.any(0), qualify.any(1)
    if not opened.any():
        return []
    members, rows = np.flatnonzero(opened[of_group]), np.flatnonzero(asks)
    place = np.full(len(b["ns"]), -1)
    place[members] = np.arange(len(members))
    turn = np.full(len(a["ns"]), -1)
    turn[rows] = np.arange(len(rows))
    a_own, b_own = turn[a_row] >= 0, place[b_row] >= 0
    both = _overlaps((turn[a_row[a_own]], a_col[a_own], len(rows)), (place[b_row[b_own]], b_col[b_own], len(members)))
    fits = (both * whole >= share[0] * (a["ns"][rows][:, None] + b["ns"][members][None, :])) & qualify[rows][:, of_group[members]]
    root: dict[int, int] = {}

    def find(x):
        while x in root:
            x = root[x]
        return x

    out = []
    for i, j in zip(*np.nonzero(fits)):
        x, y = find(int(a["grps"][rows[i]])), find(int(b["grps"][members[j]]))
        if x != y:
            root[x] = y
            out.append((int(a["cids"][rows[i]]), int(b["cids"][members[j]])))
    return out


def _compared(share: tuple[int, int]):
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                def block(side):
                    cell = lambda name, kind: np.frombuffer(batch.column(f"{side}_{name}")[i].as_buffer(), kind)
                    return {n: cell(n, np.int64) for n in ("cids", "grps", "ns", "sizes")} | {"tokens": cell("tokens", np.uint64)}
                found = block_links(block("a"), block("b"), share)
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], ["a", "b"])
    return run


def compare_homes(classes: DataFrame, share: tuple[int, int]) -> DataFrame:
    """Links ``(a, b)`` between classes of different groups whose homes meet."""
    met = stage(meeting_homes(classes, share), "met-homes")
    homes = met.select(F.explode(F.array("low", "high")).alias("home")).distinct()
    own = classes.join(homes, "home").select("home", "cid", "grp", "n", "s", "tokens")
    sizes = own.groupBy("home").agg(F.greatest(F.ceil(F.count("*") / BLOCK_CLASSES), F.ceil(F.sum("s") / BLOCK_TOKENS)).alias("blocks"))
    dealt = own.join(sizes, "home").withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("long")).drop("blocks", "s")
    blocks = stage(dealt.groupBy("home", "block").applyInArrow(_pack_block, _BLOCK), "blocks")

    def side(name: str, home: str) -> DataFrame:
        return blocks.select(F.col("home").alias(home), *[F.col(c).alias(f"{name}_{c}") for c in blocks.columns if c != "home"])

    pairs = met.join(side("a", "low"), "low").join(side("b", "high"), "high").where("low <> high or a_block <= b_block")
    return pairs.mapInArrow(returned(_compared(share)), "a long, b long")


def _verified(share: tuple[int, int]):
    """Pairs whose exact overlap reaches the threshold."""
    def run(batches):
        for batch in batches:
            a, b, x, y, n, m = (batch.column(c).to_pylist() for c in ("a", "b", "x", "y", "n", "m"))
            kept = []
            for i in range(len(a)):
                both = len(np.intersect1d(np.frombuffer(x[i], np.uint64), np.frombuffer(y[i], np.uint64), True))
                if share[1] * both >= share[0] * (n[i] + m[i] - both):
                    kept.append(i)
            if kept:
                yield pa.RecordBatch.from_arrays([pa.array([a[i] for i in kept], pa.int64()),
                                                  pa.array([b[i] for i in kept], pa.int64())], ["a", "b"])
    return run


def _compare(pairs: DataFrame, classes: DataFrame, share: tuple[int, int]) -> DataFrame:
    left = classes.select(F.col("cid").alias("a"), F.col("n"), F.col("tokens").alias("x"))
    right = classes.select(F.col("cid").alias("b"), F.col("n").alias("m"), F.col("tokens").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y", "n", "m").mapInArrow(
        _verified(share), "a long, b long")


def _overlap_fits(n: str, m: str, shared: str, share: tuple[int, int]):
    """Whether a set of n with so many shared shingles can reach the overlap that a link with a set of m needs."""
    return (F.col(n) + F.col(m)) * share[0] <= F.col(shared) * (share[0] + share[1])


def _fits(share: tuple[int, int]):
    """Whether sets of n and m, with s and t shared shingles, can link."""
    sizes = (F.col("n") * share[1] >= F.col("m") * share[0]) & (F.col("m") * share[1] >= F.col("n") * share[0])
    return sizes & _overlap_fits("n", "m", "s", share) & _overlap_fits("n", "m", "t", share)


def similar_classes(docs: DataFrame, text: str = "text", size: int = SIZE,
                    share: tuple[int, int] = SHARE) -> tuple[DataFrame, DataFrame]:
    """Classes (cid, sig, n, ...) that may link, and links (a, b) between their numbers.

    The links connect every component of linked sets; pairs that other links connect already may be left out.
    """
    spark = docs.sparkSession
    buckets = min(1 << 16, max(16, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    packs = docs.select(F.col(text).cast("binary").alias("text")).mapInArrow(
        returned(_packs(size, buckets)), "bucket int, sigs binary, many binary, low binary")
    shared = packs.groupBy("bucket").applyInArrow(
        returned_by_group(_shared(buckets)), "part int, sigs binary, many binary, tokens binary, ranks binary")
    classes = stage(shared.groupBy("part").applyInArrow(
        returned_by_group(_candidates(share)), "sig binary, n long, s long, alpha long, "
        "prefix array<long>, tokens binary")
        .withColumn("cid", F.monotonically_increasing_id()), "candidates")
    posts = stage(classes.select("cid", "n", "s", F.explode("prefix").alias("token")), "prefixes")

    # Leaders: in round 0 the class with the fewest shingles of its own (an original among its copies), then any by salted
    # hash. A class meets the one that leads most of its prefix.
    rounds = F.explode(F.array(*[F.lit(i) for i in range(ROUNDS)]))
    own = F.when(F.col("round") == 0, F.floor(50 * (F.col("n") - F.col("s")) / F.col("n"))).otherwise(0)
    order = F.struct(own.alias("own"), F.xxhash64("cid", "round").alias("h"), "cid", "n", "s")
    seeded = posts.withColumn("round", rounds)
    leaders = seeded.groupBy("token", "round").agg(F.min(order).alias("lead"), F.count("*").alias("held")).filter("held > 1")
    met = (seeded.join(leaders.hint("merge"), ["token", "round"])  # Spark takes it for a part of the rounds' rows and might broadcast it
           .select("cid", "round", "n", "s", F.col("lead.cid").alias("lead"), F.col("lead.n").alias("m"), F.col("lead.s").alias("t"))
           .filter("cid <> lead").filter(_fits(share)).groupBy("cid", "round", "lead").count()
           .groupBy("cid", "round").agg(F.max(F.struct("count", "lead")).alias("best")))
    pairs = met.select(F.least("cid", "best.lead").alias("a"), F.greatest("cid", "best.lead").alias("b")).distinct()
    first = stage(_compare(pairs, classes, share), "leader-links")
    group_of = stage(components(first), "groups")

    # Once more with groups in place: a class meets the original of the group that holds most of its prefix shingles.
    grouped = posts.join(group_of.withColumnRenamed("node", "cid"), "cid", "left").withColumn("grp", F.coalesce("root", "cid"))
    rank = F.struct(((F.col("n") - F.col("s")) / F.col("n")).alias("own"), "cid", "n", "s")
    heads = (classes.select("cid", "n", "s").join(group_of.withColumnRenamed("node", "cid"), "cid", "left")
             .groupBy(F.coalesce("root", "cid").alias("grp")).agg(F.min(rank).alias("lead")))
    common = (grouped.groupBy("token", "grp").agg(F.count("*").alias("held")).groupBy("token")
              .agg(F.max(F.struct("held", "grp")).alias("top"), F.count("*").alias("groups")).filter("groups > 1")
              .select("token", F.col("top.grp").alias("other")))
    best = stage(grouped.join(common, "token").filter("grp <> other").groupBy("cid", "n", "s", "other").count()
                 .groupBy("cid", "n", "s").agg(F.max(F.struct("count", "other")).alias("best")), "nearest-groups")
    kin = best.select("cid", F.col("best.other").alias("other"))
    near = (best.join(heads.withColumnRenamed("grp", "other"), F.col("best.other") == F.col("other"))
            .select("cid", "n", "s", F.col("lead.cid").alias("lead"), F.col("lead.n").alias("m"), F.col("lead.s").alias("t"))
            .filter(_fits(share)).select(F.least("cid", "lead").alias("a"), F.greatest("cid", "lead").alias("b")).distinct())
    first = stage(first.unionByName(_compare(near, classes, share)), "leader-links")
    group_of = stage(components(first), "groups")

    # Homes for blocks; which classes are compared with each other does not depend on how they are filed.
    home = (classes.join(group_of.withColumnRenamed("node", "cid"), "cid", "left")
            .join(kin.withColumnRenamed("other", "kin"), "cid", "left")
            .select("cid", "n", "s", "alpha", "tokens", F.coalesce("root", "cid").alias("grp"), F.coalesce("root", "kin", "cid").alias("home")))
    second = stage(compare_homes(stage(home, "homes"), share), "group-links")
    return classes, first.unionByName(second)


def link_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: tuple[str, ...] = (),
                   size: int = SIZE, share: tuple[int, int] = SHARE) -> DataFrame:
    """One row per document: doc_id, the kept columns, n_shingles, component_id (the least id of its component)."""
    kept = [F.col(doc_id).alias("id"), *[F.col(c).alias(f"keep_{i}") for i, c in enumerate(keep)]]
    plain = docs.select(F.struct(*kept).alias("kept"), F.col(text).cast("binary").alias("text"))
    fields = plain.schema["kept"].dataType.simpleString()
    sets = stage(plain.mapInArrow(returned(_signatures(size)), f"kept {fields}, n_shingles long, sig binary"), "sets")
    classes, links = similar_classes(docs, text, size, share)
    root_of = components(links).withColumnRenamed("node", "cid").join(classes.select("cid", "sig"), "cid").select("sig", "root")
    least = (sets.filter("sig is not null").groupBy("sig").agg(F.min("kept.id").alias("least"), F.count("*").alias("copies"))
             .join(root_of, "sig", "left")
             .withColumn("root", F.coalesce(F.col("root").cast("string").cast("binary"), "sig")))
    by_root = least.groupBy("root").agg(F.min("least").alias("component_id"))
    by_sig = stage(least.select("sig", "root", "copies").join(by_root, "root").select("sig", "component_id", "copies"), "class-components")
    # A class may hold a third of all documents: only the rows of such classes are repeated for every salt. Spark does not see that rows are
    # repeated when it decides what to broadcast.
    out = lookup(sets, by_sig.drop("copies"), "sig", hot=hot_keys(by_sig, "sig", "copies"), spread=["kept"])
    return out.select(F.col("kept.id").alias(doc_id), *[F.col(f"kept.keep_{i}").alias(c) for i, c in enumerate(keep)],
                      "n_shingles", F.coalesce("component_id", "kept.id").alias("component_id"))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
