"""Katz backoff language model over all documents, fitted and applied by Spark.

Documents are packed into blocks of tokens. For each order, a block sends its distinct n-grams once (context, word, count in
training documents, and such a count of the n-gram without its first word) to buckets dealt by context; a bucket adds up the counts
of all blocks, which gives its part of the n-gram table, and answers each block in the order it asked. Contexts that hold more than an
eighth of a bucket's share are dealt over several buckets by word, and their sums are put together afterwards (some eight contexts a
bucket, each in as many parts as it holds eighths). The table of each order is written as Parquet, partitioned by order and bucket.

Words and n-grams go by number: the bucket, then the rank in it (words by falling count, n-grams by context and word). A context is the
number of an n-gram of the order below, and its n-grams stay in that one's bucket. So a block's n-grams are sorted as pairs of small
integers, and what it sends of them is mostly differences of ascending numbers.

Counts up to ``LIMIT`` get Good-Turing discounts. Backoff weights are normalised exactly: the mass left by discounting a context's
words, over the lower-order mass of all words not seen behind it. Words seen behind a context are seen behind the shorter one too, so
their lower-order mass is a sum of discounted counts over one number, and only counts travel. They travel for those contexts alone behind
which a block asked for a word that was never seen there: nothing else needs a weight, and the counts behind a context sum up to its own
count, as the end is the only word with nothing behind it. A token is evaluated recursively: the discounted n-gram if it was seen, else
the weight times the next lower order; a context that was never seen has weight 1. The lowest order leaves its mass to one unknown word,
as the base score does, so both are distributions over the same V + 1 types.

Defined cases: a null or empty text has one token, the end; without training rows every token has probability 1; where
Good-Turing gives no discount between 0 and 1 (a count of counts is missing), an absolute discount is used; a context whose
counts are all above LIMIT gets one more count for the unseen; repeated rows count and are scored row by row; empty tables give no
rows. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from cardlake.llm import hashing as H
from cardlake.session import scratch_path, shuffles_deleted, stage

ORDER, LIMIT = 3, 5
BLOCK = 3 << 19  # tokens
END = H.U(0x27220A95FE6D52B1)
_ANSWER = "kind int, block long, bucket int, counts binary, ranks binary, details binary, context long, stats array<double>"
_NAMES = ["kind", "block", "bucket", "counts", "ranks", "details", "context", "stats"]
_TYPES = [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.list_(pa.float64())]
RESPONSE, TOTALS, HOT, TABLE = range(4)
_SUMS = 2 * (LIMIT + 1)  # numbers that a bucket tells of a context
PLAIN, FIRST_KIND = 1, 2  # codes of contexts: all counts behind it are above LIMIT; the first of those whose numbers are told
_ZSTD = pa.Codec("zstd")
RANK_BITS = 40  # a number is a bucket, then a rank of so many bits
_RANK = (1 << RANK_BITS) - 1


def _press(a: np.ndarray) -> bytes:
    raw = np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize).T.tobytes()  # byte planes compress better
    return len(raw).to_bytes(8, "little") + _ZSTD.compress(raw, asbytes=True)


def _open(b: bytes, kind) -> np.ndarray:
    size, item = int.from_bytes(b[:8], "little"), np.dtype(kind).itemsize
    if not size:
        return np.zeros(0, kind)
    raw = np.frombuffer(_ZSTD.decompress(b[8:], size, asbytes=True), np.uint8)
    return np.ascontiguousarray(raw.reshape(item, -1).T).view(kind).reshape(-1)


def _press_ints(a: np.ndarray) -> bytes:
    """Numbers from 0 on, as narrow as they fit."""
    top = int(a.max(initial=0))
    width = next(w for w in (1, 2, 4, 8) if top < 1 << 8 * w)
    return bytes([width]) + _press(a.astype(f"u{width}"))


def _open_ints(b: bytes) -> np.ndarray:
    return _open(b[1:], f"u{b[0]}").astype(np.int64)


def _press_ids(ids: np.ndarray) -> bytes:
    """Mostly ascending numbers: the first and the differences."""
    step = np.diff(ids)
    return ids[:1].tobytes() + _press_ints(((step << 1) ^ (step >> 63)).view(np.uint64))


def _open_ids(b: bytes) -> np.ndarray:
    step = _open_ints(b[8:])
    return np.cumsum(np.append(np.frombuffer(b[:8], np.int64), (step >> 1) ^ -(step & 1)))


def _join(*parts: bytes) -> bytes:
    return b"".join(len(x).to_bytes(8, "little") + x for x in parts)


def _parts(raw: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(raw):
        size = int.from_bytes(raw[at:at + 8], "little")
        out.append(raw[at + 8:at + 8 + size])
        at += 8 + size
    return out


def _press_numbers(ids: np.ndarray) -> bytes:
    return _join(_press_ints(ids & _RANK), _press_ints(ids >> RANK_BITS))


def _open_numbers(b: bytes) -> np.ndarray:
    rank, bucket = map(_open_ints, _parts(b))
    return rank | bucket << RANK_BITS


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> H.U(40)) * H.U(buckets) >> H.U(24)).astype(np.int64)


def _pack_blocks(batches):
    """Blocks: kept rows, token numbers per document, training flags, distinct words by falling frequency, tokens as word numbers."""
    def pack(kept, docs, flags):
        tokens = np.concatenate(docs)
        words, which, many = np.unique(tokens, return_inverse=True, return_counts=True)
        order = np.argsort(-many, kind="stable")
        place = np.empty(len(words), np.uint32)
        place[order] = np.arange(len(words), dtype=np.uint32)
        rows = pa.concat_arrays(kept)
        return pa.RecordBatch.from_arrays(
            [pa.array([int.from_bytes(os.urandom(8), "little") >> 1], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows),
             *[pa.array([_press(a)], pa.binary()) for a in (np.array([len(d) for d in docs], np.uint32), np.array(flags, np.uint8),
                                                             words[order], place[which])]],
            ["block", "kept", "lens", "train", "words", "tokens"])

    kept, docs, flags, held = [], [], [], 0
    for batch in batches:
        rows, train, first = batch.column("kept"), batch.column("train").to_pylist(), 0
        for row, words in H.word_hashes(batch.column("text"), H.NON_SPACE):
            docs.append(np.append(words, END))
            flags.append(bool(train[row]))
            held += len(words) + 1
            if held >= BLOCK:
                kept.append(rows.slice(first, row + 1 - first))
                yield pack(kept, docs, flags)
                kept, docs, flags, held, first = [], [], [], 0, row + 1
        if first < len(rows):
            kept.append(rows.slice(first))
    if docs:
        yield pack(kept, docs, flags)


class _Block:
    """The arrays of one block row."""

    def __init__(self, row):
        self.block = row["block"].as_py() if hasattr(row["block"], "as_py") else row["block"]
        self.lens, self.train = _open(row["lens"], np.uint32).astype(np.int64), _open(row["train"], np.uint8)
        self.words, self.tokens = _open(row["words"], np.uint64), _open(row["tokens"], np.uint32)
        self.first = np.cumsum(self.lens) - self.lens
        self.place = np.arange(len(self.tokens), dtype=np.int32) - np.repeat(self.first.astype(np.int32), self.lens)  # in its document
        self.flag = np.repeat(self.train, self.lens)

    def unigrams(self, buckets: int):
        """Words by bucket: (order, buckets of the ordered words)."""
        bucket = _bucket(self.words, buckets)
        order = np.argsort(bucket, kind="stable")
        return order, bucket[order]


@dataclass
class _Level:
    """What a block knows of an order: per entry (distinct n-gram, by bucket, context and word) its number, its count, and what the counts
    behind its context are divided by; per token the entry of the n-gram that ends there, and the probability of the token."""

    ids: np.ndarray | None
    count: np.ndarray
    whole: np.ndarray | None
    entry: np.ndarray
    p: np.ndarray


def _sorted_places(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The keys in order and where each stood. The places are sorted as the low bits of the keys, if there is room for them."""
    bits = max(1, len(key).bit_length())
    if int(key.max(initial=0)) >> (63 - bits):
        order = np.argsort(key, kind="stable")
        return key[order], order
    both = key << bits
    both |= np.arange(len(key))
    both.sort()
    places = both & ((1 << bits) - 1)
    both >>= bits
    return both, places


class _Grams:
    """The distinct n-grams of a block, as entries by bucket, context and word."""

    def __init__(self, n: int, block: _Block, number: np.ndarray, word: np.ndarray, low: _Level, buckets: int, total: int):
        self.at = np.flatnonzero(block.place >= n - 1)
        bits = max(1, len(number).bit_length())
        key = low.entry[self.at - 1].astype(np.int64)
        key <<= bits
        key |= word[block.tokens[self.at]]
        key, places = _sorted_places(key)
        start = _runs(key)
        self.first = self.at[places[start]]  # a token at which the entry occurs
        self.which = np.empty(len(key), np.int32)
        self.which[places] = np.repeat(np.arange(len(start), dtype=np.int32), np.diff(np.append(start, len(key))))
        context = key[start] >> bits
        del key, places
        self.context, self.number = low.ids[context], number[block.tokens[self.first]]
        parts = np.minimum(1024, np.ceil(8 * low.count[context] * buckets / max(1, total))).astype(np.int64)
        self.hot = parts > 1
        self.bucket = self.context >> RANK_BITS
        if self.hot.any():
            hot = np.flatnonzero(self.hot)
            dealt = self.context[hot].astype(np.uint64) * H.U(1024) + (H.mix(self.number[hot].astype(np.uint64)) % parts[hot].astype(np.uint64))
            self.bucket[hot] = _bucket(H.mix(dealt), buckets)
            order = np.argsort(self.bucket.astype(np.uint16), kind="stable")
            back = np.empty(len(order), np.int32)
            back[order] = np.arange(len(order), dtype=np.int32)
            self.which = back[self.which]
            for name in ("first", "context", "number", "hot", "bucket"):
                setattr(self, name, getattr(self, name)[order])


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal keys."""
    if not len(keys[0]):
        return np.zeros(0, np.int64)
    new = np.zeros(len(keys[0]), bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def _rows(rows) -> pa.Table:
    cols = list(zip(*rows)) or [[]] * len(_NAMES)
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(cols, _TYPES)], _NAMES)


def _count_of_counts(counts: np.ndarray) -> list[float]:
    return [float((counts == r).sum()) for r in range(1, LIMIT + 2)]


def _ask_unigrams(buckets: int):
    def run(batches):
        for batch in batches:
            for row in batch.select(["block", "lens", "train", "words", "tokens"]).to_pylist():
                b = _Block(row)
                count = np.bincount(b.tokens, weights=b.flag, minlength=len(b.words)).astype(np.uint32)
                order, bucket = b.unigrams(buckets)
                starts = np.searchsorted(bucket, np.arange(buckets + 1))
                out = [(int(k), b.block, _press(b.words[order[i:j]]), _press(count[order[i:j]]))
                       for k, (i, j) in enumerate(zip(starts[:-1], starts[1:])) if j > i]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int64(), pa.binary(), pa.binary()))],
                                                 ["bucket", "block", "words", "counts"])
    return run


def _answer_unigrams(table: pa.Table) -> pa.Table:
    """Counts of one bucket's words and their ranks, in each block's order; totals, and the bucket's table by rank."""
    bucket = table.column("bucket")[0].as_py()
    words = [_open(x, np.uint64) for x in table.column("words").to_pylist()]
    counts = [_open(x, np.uint32) for x in table.column("counts").to_pylist()]
    known, which = np.unique(np.concatenate(words), return_inverse=True)
    total = np.bincount(which, weights=np.concatenate(counts)).astype(np.int64)
    order = np.lexsort((known, -total))
    rank = np.empty(len(known), np.int64)
    rank[order] = np.arange(len(known))
    rows, at = [], 0
    for block, own in zip(table.column("block").to_pylist(), words):
        mine = which[at:at + len(own)]
        rows.append((RESPONSE, block, bucket, _press_ints(total[mine]), _press_ints(rank[mine]), None, None, None))
        at += len(own)
    known, total = known[order], total[order]
    seen = total > 0
    rows.append((TOTALS, None, bucket, None, None, None, None, [float(total.sum()), float(seen.sum()), *_count_of_counts(total)]))
    rows.append((TABLE, None, bucket, _press(total[seen].astype(np.uint64)), None, _press(known[seen]), None, None))
    return _rows(rows)


def _answer_grams(top: bool):
    """``top``: no higher order needs the numbers of these n-grams."""
    def run(table: pa.Table) -> pa.Table:
        """Counts of one bucket's n-grams: answers in each block's order, sums per context, totals, and the bucket's table."""
        bucket = table.column("bucket")[0].as_py()
        col = lambda name, opened: [opened(x) for x in table.column(name).to_pylist()]
        contexts, sizes, hots = col("contexts", _open_ids), col("sizes", _open_ints), col("hot", _open_ints)
        known, code = np.unique(np.concatenate(contexts), return_inverse=True)
        ctx, w = np.repeat(code, np.concatenate(sizes)), np.concatenate(col("numbers", _open_numbers))
        rank = w & _RANK
        bits = max(1, int(rank.max(initial=0)).bit_length())
        wide = bits + max(1, int((w >> RANK_BITS).max(initial=0)).bit_length())
        if len(known).bit_length() + wide < 64:
            key = ctx << wide | (w >> RANK_BITS) << bits | rank
            order = np.argsort(key, kind="stable")  # the blocks' parts are in order already
            entry = _runs(key[order])
            del key
        else:
            order = np.lexsort((w, ctx))
            entry = _runs(ctx[order], w[order])
        del rank
        size = np.diff(np.append(entry, len(order)))
        total = np.add.reduceat(np.concatenate(col("counts", _open_ints))[order], entry)
        below = np.maximum.reduceat(np.concatenate(col("lower", _open_ints))[order], entry)
        each = np.empty(len(order), np.int64)
        each[order] = np.repeat(np.arange(len(entry)), size)
        e_ctx, e_w = ctx[order[entry]], w[order[entry]]
        del ctx, w, order
        # per context, of its words and of what the order below counts of them: the sum of the counts above LIMIT, and how many have
        # each count up to there
        start = _runs(e_ctx)
        below[total == 0] = 0
        sums = np.stack([np.add.reduceat(x, start) for c in (total, below) for x in (np.where(c > LIMIT, c, 0), *[c == r for r in range(1, LIMIT + 1)])]
                        ).astype(np.int64) if len(start) else np.zeros((_SUMS, 0), np.int64)
        behind = np.add.reduceat(total, start) if len(start) else np.zeros(0, np.int64)
        plain = (behind > 0) & ~sums[1:LIMIT + 1].any(axis=0)
        weighed = np.flatnonzero(np.add.reduceat(total == 0, start, dtype=np.int64) * behind if len(start) else behind)  # words fail behind them
        mixed = np.zeros(len(weighed), np.uint64)
        for row in sums:
            mixed = H.mix(mixed + row[weighed].view(np.uint64))
        _, one, alike = np.unique(mixed, return_index=True, return_inverse=True)  # few contexts differ in their sums
        by_sums = np.lexsort(sums[[7, 1, 6, 0]][:, weighed[one]])  # alike ones side by side
        kinds, place, kind = sums[:, weighed[one[by_sums]]], np.empty(len(one), np.int64), np.zeros(len(known), np.int64)
        place[by_sums] = np.arange(len(one))
        kind[weighed] = place[alike]
        rows, at, c_at = [], 0, 0
        for block, s, h in zip(table.column("block").to_pylist(), sizes, hots):
            many = int(s.sum())
            mine, own = each[at:at + many], code[c_at:c_at + len(s)]
            told = (np.add.reduceat(total[mine] == 0, np.cumsum(s) - s, dtype=np.int64) > 0) & (behind[own] > 0) & (h == 0)
            used, of = np.unique(kind[own[told]], return_inverse=True)
            codes = np.where(plain[own] & (h == 0), PLAIN, 0)
            codes[told] = FIRST_KIND + of
            rows.append((RESPONSE, block, bucket, _press_ints(total[mine]),
                         None if top else _press_ids(mine), _join(_press_ints(codes), _press_ints(kinds[:, used].reshape(-1))), None, None))
            at, c_at = at + many, c_at + len(s)
        hot = np.unique(np.concatenate([c[h > 0] for c, h in zip(contexts, hots)]))
        for c, i in zip(hot.tolist(), np.searchsorted(known, hot)):
            rows.append((HOT, None, bucket, None, None, None, c, sums[:, i].astype(np.float64).tolist()))
        rows.append((TOTALS, None, bucket, None, None, None, None, [float(total.sum()), float((total > 0).sum()), *_count_of_counts(total)]))
        seen = np.flatnonzero(total > 0)
        runs = _runs(e_ctx[seen])
        rows.append((TABLE, None, bucket, _press_ints(total[seen]), _press_ids(seen), _join(
            _press_ids(known[e_ctx[seen][runs]]), _press_ints(np.diff(np.append(runs, len(seen)))), _press_numbers(e_w[seen])),
            None, None))
        return _rows(rows)
    return run


def discounts(totals: list[float]) -> list[float]:
    """Good-Turing factors for counts 1 to LIMIT from counts of counts; an absolute discount where they are not usable."""
    n = totals[2:]
    absolute = n[0] / (n[0] + 2 * n[1]) if n[0] and n[1] else 0.5
    common = (LIMIT + 1) * n[LIMIT] / n[0] if n[0] else 1.0
    out = []
    for r in range(1, LIMIT + 1):
        good = ((r + 1) * n[r] / (r * n[r - 1]) - common) / (1 - common) if n[r - 1] and common < 1 else 0.0
        out.append(good if 0 < good < 1 else (r - absolute) / r)
    return out


def _factor(counts: np.ndarray, d: list[float]) -> np.ndarray:
    return np.array([1.0, *d, 1.0])[np.minimum(counts, LIMIT + 1).astype(np.int64)]


class _Scorer:
    """Evaluates a block from the answers to all orders so far."""

    def __init__(self, orders: list[dict], buckets: int):
        self.orders, self.buckets = orders, buckets  # per order: totals, discounts, hot context sums

    def words(self, block: _Block, answers: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, _Level]:
        """Per word its count, its number and its place by number; the lowest level."""
        order, bucket = block.unigrams(self.buckets)
        got = [a for _, a in sorted(answers.items())]
        count, number, place = (np.empty(len(block.words), np.int64) for _ in range(3))
        count[order] = np.concatenate([_open_ints(a["counts"]) for a in got])
        number[order] = np.concatenate([_open_ints(a["ranks"]) for a in got]) | bucket << RANK_BITS
        by_number = np.argsort(number)
        place[by_number] = np.arange(len(number))
        one = self.orders[0]
        total, d = one["totals"][0], one["discounts"]
        left = sum((1 - d[r]) * (r + 1) * one["totals"][2 + r] for r in range(LIMIT))
        if not total:
            whole, p = 1.0, np.ones(len(count))
        elif not left:
            whole = total + 1
            p = np.where(count > 0, count, 1.0) / whole
        else:
            whole, p = total, np.where(count > 0, _factor(count, d) * count, left) / total
        t = block.tokens
        return count, number, place, _Level(number[by_number], count[by_number], np.full(len(count), whole, np.float64),
                                            place.astype(np.int32)[t], p[t])

    def grams(self, n: int, block: _Block, number: np.ndarray, place: np.ndarray, low: _Level) -> _Grams:
        return _Grams(n, block, number, place, low, self.buckets, self.orders[0]["totals"][0])

    def run(self, block: _Block, answers: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray, _Level]:
        """Per word its count, number and place, and the level of the highest answered order."""
        count, number, place, level = self.words(block, answers[0])
        for n in range(2, len(answers) + 1):
            level = self._order(n, self.grams(n, block, number, place, level), answers[n - 1], level)
        return count, number, place, level

    def _order(self, n: int, g: _Grams, answers: dict, low: _Level) -> _Level:
        if not len(g.at):
            return _Level(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(len(low.p), np.int32), low.p)
        got = [a for _, a in sorted(answers.items())]
        count = np.concatenate([_open_ints(a["counts"]) for a in got])
        ids = np.concatenate([_open_ids(a["ranks"]) for a in got]) | g.bucket << RANK_BITS if got[0]["ranks"] else None
        entry = np.zeros(len(low.p), np.int32)
        entry[g.at] = g.which
        if got[0]["details"] is None:  # the next order is asked by number and count
            return _Level(ids, count, None, entry, low.p)
        codes, kinds = zip(*[map(_open_ints, _parts(a["details"])) for a in got])
        sums = np.concatenate([v.reshape(_SUMS, -1)[:, c[c >= FIRST_KIND] - FIRST_KIND] for c, v in zip(codes, kinds)], axis=1)
        codes = np.concatenate(codes)
        run = _runs(g.bucket, g.context)
        hot = np.flatnonzero(g.hot[run])
        if len(hot):
            sums = np.append(sums, np.array([self.orders[n - 1]["hot"][c] for c in g.context[run[hot]].tolist()], np.int64).T, axis=1)
        told = np.append(np.flatnonzero(codes >= FIRST_KIND), hot)
        total = low.count[low.entry[g.first[run] - 1]]  # something follows a context wherever it occurs
        d, lower = (np.array(self.orders[i]["discounts"]) for i in (n - 1, n - 2))
        each = np.arange(1, LIMIT + 1)
        left = ((1 - d) * each) @ sums[1:LIMIT + 1]
        below = sums[LIMIT + 1] + (lower * each) @ sums[LIMIT + 2:]
        plain = codes == PLAIN  # nothing was discounted: one count more, for the unseen
        plain[told] = (left <= 0) & (total[told] > 0)
        whole = np.where(plain, total + 1, np.maximum(total, 1))
        left = np.where(plain[told], 1.0, left)
        mass = below / low.whole[low.entry[g.first[run[told]]]]
        weight = np.ones(len(run))
        weight[told] = np.where(total[told] > 0, left / whole[told] / np.maximum(1 - mass, 1e-300), 1.0)
        size = np.diff(np.append(run, len(g.bucket)))  # entries of each context
        whole = np.repeat(whole, size)
        p = low.p.copy()
        p[g.at] = np.where(count > 0, _factor(count, d.tolist()) * count / whole, np.repeat(weight, size) * low.p[g.first])[g.which]
        return _Level(ids, count, whole, entry, p)


def _answers(table: pa.Table, orders: int) -> list[dict]:
    out: list[dict] = [{} for _ in range(orders)]
    for row in table.select(["n", "bucket", "counts", "ranks", "details"]).to_pylist():
        out[row["n"] - 1][row["bucket"]] = row
    return out


def _ask_grams(n: int, scorer: _Scorer, buckets: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        block = _Block(left.select(["block", "lens", "train", "words", "tokens"]).to_pylist()[0])
        _, number, place, low = scorer.run(block, _answers(right, n - 1))
        g = scorer.grams(n, block, number, place, low)
        many = np.bincount(g.which, weights=block.flag[g.at], minlength=len(g.first)).astype(np.int64)
        below = np.where(many > 0, low.count[low.entry[g.first]], 0)
        rows = []
        starts = _runs(g.bucket)
        for i, j in zip(starts, np.append(starts[1:], len(g.bucket))):
            run = _runs(g.context[i:j])
            rows.append((int(g.bucket[i]), block.block, _press_ids(g.context[i:j][run]), _press_ints(np.diff(np.append(run, j - i))),
                         _press_ints(g.hot[i:j][run]), _press_numbers(g.number[i:j]), _press_ints(many[i:j]), _press_ints(below[i:j])))
        cols = list(zip(*rows)) or [[]] * 8
        kinds = (pa.int32(), pa.int64(), *[pa.binary()] * 6)
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                    ["bucket", "block", "contexts", "sizes", "hot", "numbers", "counts", "lower"])
    return run


def _score(scorer: _Scorer, order: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        block = _Block(left.select(["block", "lens", "train", "words", "tokens"]).to_pylist()[0])
        word_count, _, _, level = scorer.run(block, _answers(right, order))
        count = word_count[block.tokens]
        total, types = scorer.orders[0]["totals"][:2]
        base = np.log10((word_count + 0.5) / (total + 0.5 * (types + 1)))[block.tokens]
        add = lambda x: np.add.reduceat(x, block.first)  # noqa: E731  every document has a token at least
        kept = left.column("kept").combine_chunks().flatten()
        return pa.Table.from_arrays([kept, pa.array(block.lens), pa.array(add((count > 0).astype(np.int64))), pa.array(add(base)),
                                     pa.array(add(np.log10(level.p)))], ["kept", "n_tokens", "n_known", "base_score", "score"])
    return run


def score_documents(docs: DataFrame, train: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), order: int = ORDER,
                    tables: str | None = None) -> DataFrame:
    """The kept columns, n_tokens, n_known, train_tokens, base_score, score; ``train`` names a boolean column.

    The n-gram tables are written under ``tables`` (a folder in the shared folder by default), partitioned by order and bucket.
    """
    with shuffles_deleted(docs.sparkSession):
        return _score_documents(docs, train, text, keep, order, tables)


def _score_documents(docs: DataFrame, train: str, text: str, keep: tuple[str, ...], order: int, tables: str | None) -> DataFrame:
    spark = docs.sparkSession
    buckets = max(16, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    tables = tables or scratch_path(spark, "katz")
    plain = docs.select(F.struct(*[F.col(c).alias(f"keep_{i}") for i, c in enumerate(keep)]).alias("kept"),
                        F.coalesce(F.col(train), F.lit(False)).alias("train"), F.col(text).cast("binary").alias("text"))
    fields = plain.schema["kept"].dataType.simpleString()
    # Bucketed by block: the answers come to the blocks, the blocks themselves are never shuffled.
    name = f"katz_{uuid.uuid4().hex}"
    (plain.mapInArrow(_pack_blocks, f"block long, kept array<{fields}>, lens binary, train binary, words binary, tokens binary")
     .write.bucketBy(buckets, "block").option("path", scratch_path(spark, "blocks")).saveAsTable(name))
    try:
        blocks = spark.read.table(name)
        asked = blocks.mapInArrow(_ask_unigrams(buckets), "bucket int, block long, words binary, counts binary")
        orders: list[dict] = []
        _write_answers(asked.groupBy("bucket").applyInArrow(_answer_unigrams, _ANSWER), tables, 1)
        orders.append(_summary(spark, tables, 1))
        for n in range(2, order + 1):
            answers = _read_answers(spark, tables).filter(F.col("kind") == RESPONSE).select(
                "n", "block", "bucket", "counts", "ranks", F.lit(None).cast("binary").alias("details"))
            asked = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
                _ask_grams(n, _Scorer(orders, buckets), buckets), "bucket int, block long, contexts binary, sizes binary, hot binary, numbers binary, "
                "counts binary, lower binary")
            _write_answers(asked.groupBy("bucket").applyInArrow(_answer_grams(n == order), _ANSWER), tables, n)
            orders.append(_summary(spark, tables, n))
        answers = _read_answers(spark, tables).filter(F.col("kind") == RESPONSE).select("n", "block", "bucket", "counts", "ranks", "details")
        scored = stage(blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
            _score(_Scorer(orders, buckets), order), f"kept {fields}, n_tokens long, n_known long, base_score double, score double"), "scores")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return scored.select(*[F.col(f"kept.keep_{i}").alias(c) for i, c in enumerate(keep)], "n_tokens", "n_known",
                         F.lit(int(orders[0]["totals"][0])).cast("long").alias("train_tokens"), "base_score", "score")


def _write_answers(rows: DataFrame, tables: str, n: int) -> None:
    rows.write.parquet(f"{tables}/n={n}")


def _read_answers(spark: SparkSession, tables: str) -> DataFrame:
    return spark.read.schema(_ANSWER + ", n int").parquet(tables)


def _summary(spark: SparkSession, tables: str, n: int) -> dict:
    """Totals, discounts and the sums of contexts that were spread (about eight per bucket) of one order."""
    rows = _read_answers(spark, tables).filter(F.col("n") == n)
    size = 2 + LIMIT + 1
    totals = rows.filter(F.col("kind") == TOTALS).agg(*[F.sum(F.col("stats")[i]) for i in range(size)]).first()
    totals = [x or 0.0 for x in totals]
    hot = rows.filter(F.col("kind") == HOT).groupBy("context").agg(*[F.sum(F.col("stats")[i]) for i in range(_SUMS)]).collect()
    return {"totals": totals, "discounts": discounts(totals), "hot": {r[0]: list(r)[1:] for r in hot}}


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 1
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("held_out", F.coalesce(held_out, F.lit(False)))
    return score_documents(docs.withColumn("in_training", ~F.col("held_out")), "in_training", keep=("doc_id", "held_out"))
