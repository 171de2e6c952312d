"""Repair of conversation structure by a run-length dynamic programme over min-plus transitions.

A conversation is put in order by one range exchange, in which every row gets a number that gives its place. Role class and fault
make a row's symbol. Only symbols are gathered: per conversation and block of places they become runs of equal symbols, and the runs
of a conversation meet in one row (shorter than the audit, which is one value per conversation too). What is left to pay behind a
run follows from what is left behind its last row by the run's min-plus transition, whose powers of two are cached; the cheapest edits
are unrolled run by run, halving long runs, so that no more than a few vectors are held. Edits go back to the rows by place.

The states are the regular expression's: nothing yet, behind s, behind u, behind a. Every edit leads from a state to one state only,
so taking the ASCII-least initial that keeps the total cheapest gives the least audit.

Defined cases: null roles and texts are one space, a null number is one space in the damage key; a null conv_id is a conversation of
its own; rows of one turn are ordered by role and text; repeated rows are rows; an empty role or another initial is a fourth role
class, which must be changed or deleted; a span of turns beyond 64 bits gives null gaps; an empty table gives no rows; other columns
are ignored. A text is hashed in the order of its conversation, in one task for each conversation but without holding it.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from cardlake.session import stage

SPACE = " \t\n\x0b\x0c\r"  # \x20 and \x09-\x0D
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
BLOCK_BITS = 16  # places per block: at most 65,536 symbols of one conversation are gathered at a time
_ROLES, _FAULTS = "sua", ("fine", "truncated", "blank", "duplicate")
_FAR = 1 << 60
_END = (0, 10, 5, 0)  # what is left to pay behind the last row: an insertion or two until the pattern ends
_INSERTED = (2, 2, 3, 2)  # the state behind an insertion: user, user, assistant, user
_KEPT = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}  # the state behind a kept row


def damage(rows: DataFrame) -> DataFrame:
    """The damaged rows, one per copy: conv_id, turn, role, text."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.crc32(key.cast("binary")) % 20
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return (rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
                        kind.alias("kind")).filter("kind <> 0")
            .select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                    F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("_"))
            .drop("_"))


def in_order(rows: DataFrame) -> DataFrame:
    """The rows with ``at``, whose order is that of the rows in their conversations, written once."""
    ranged = rows.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 32))
    return stage(ranged.sortWithinPartitions("conv_id", "turn", "role", "text").withColumn("at", F.monotonically_increasing_id()), "lines")


def _symbols(lines: DataFrame) -> DataFrame:
    """conv_id, block, begin, symbols: the rows of a conversation in a block, a byte each (role class and fault)."""
    bare = F.rtrim("text", F.lit(SPACE))
    initial = F.substring("role", 1, 1)
    role = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    fault = F.when(bare == "", 2).when(F.right(bare, F.lit(1)).isin(".", "!", "?"), 0).otherwise(1)
    thin = lines.select("conv_id", "at", (role * 4 + fault).alias("symbol"), F.lit(None).cast("long").alias("first"))
    firsts = (lines.groupBy("conv_id", "role", F.sha2("text", 256)).agg(F.min("at").alias("at"))
              .select("conv_id", "at", F.lit(None).cast("int").alias("symbol"), F.col("at").alias("first")))
    return (thin.union(firsts).groupBy("conv_id", F.shiftright("at", BLOCK_BITS).alias("block"))
            .agg(F.sort_array(F.collect_list(F.when(F.col("symbol").isNotNull(), F.struct("at", "symbol")))).alias("rows"),
                 F.collect_list("first").alias("firsts")))


def _runs(batches):
    """Runs of equal symbols of each block, with the duplicates told apart."""
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            begin = row["rows"][0]["at"]
            symbols = np.array([r["symbol"] for r in row["rows"]], np.uint8)
            seen = np.ones(len(symbols), bool)
            seen[np.array(row["firsts"], np.int64) - begin] = False
            symbols[seen & (symbols % 4 != 2)] |= 3
            cuts = np.flatnonzero(np.diff(symbols)) + 1
            starts = np.concatenate([[0], cuts])
            out.append((row["conv_id"], begin, symbols[starts].tobytes(), np.diff(np.append(starts, len(symbols))).astype(np.int32).tobytes()))
        if out:
            kinds = [batch.schema.field("conv_id").type, pa.int64(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], ["conv_id", "begin", "symbols", "lengths"])


@lru_cache(maxsize=None)
def choices(symbol: int) -> tuple:
    """For each state, the edits of a row with this symbol: (code, state behind it, cost). D: delete, K: keep, u and a: new role."""
    role, fault = (_ROLES + "o")[symbol // 4], _FAULTS[symbol % 4]
    out = []
    for state in range(4):
        some = [("D", state, DELETE)]
        if fault in ("fine", "truncated"):
            more = TRUNCATED if fault == "truncated" else 0
            if (role, state) in _KEPT:
                some.append(("K", _KEPT[role, state], more))
            some.append(("a" if state == 2 else "u", _INSERTED[state], REROLE + more))
        out.append(tuple(some))
    return tuple(out)


def _times(a: tuple, b: tuple) -> tuple:
    return tuple(tuple(min(a[i][k] + b[k][j] for k in range(4)) for j in range(4)) for i in range(4))


def _behind(m: tuple, v: tuple) -> tuple:
    return tuple(min(m[i][j] + v[j] for j in range(4)) for i in range(4))


@lru_cache(maxsize=None)
def power(symbol: int, bit: int) -> tuple:
    """The min-plus transition of 2 ** ``bit`` rows with one symbol; insertions come before a row. At most 16 x 32 of them exist."""
    if bit:
        half = power(symbol, bit - 1)
        return _times(half, half)
    row = [[_FAR] * 4 for _ in range(4)]
    for state, some in enumerate(choices(symbol)):
        for _, then, cost in some:
            row[state][then] = min(row[state][then], cost)
    inserted = [[_FAR] * 4 for _ in range(4)]
    for state in range(4):
        at = state
        for n in range(4):
            inserted[state][at] = min(inserted[state][at], n * INSERT)
            at = _INSERTED[at]
    return _times(inserted, row)


def advance(symbol: int, n: int, left: tuple) -> tuple:
    """What is left to pay before ``n`` rows, from what is left behind them."""
    for bit in range(n.bit_length()):
        if n >> bit & 1:
            left = _behind(power(symbol, bit), left)
    return left


@lru_cache(maxsize=1 << 14)
def _unroll_short(symbol: int, n: int, state: int, left: tuple) -> tuple[tuple[str, ...], int]:
    after = [left]
    for _ in range(n):
        after.append(_behind(power(symbol, 0), after[-1]))
    after.reverse()
    codes = []
    for i in range(n):
        code, pay, then = "", after[i], after[i + 1]
        while True:
            by = {c: (to, cost) for c, to, cost in choices(symbol)[state]}
            if DELETE + then[state] == pay[state]:
                code += "D"
                break
            if INSERT + pay[_INSERTED[state]] == pay[state]:
                state = _INSERTED[state]
                code += "U" if state == 2 else "A"
                continue
            kept = by.get("K")
            pick = "K" if kept and kept[1] + then[kept[0]] == pay[state] else "a" if state == 2 else "u"
            code, state = code + pick, by[pick][0]
            break
        codes.append(code)
    return tuple(codes), state


def _unroll(symbol: int, n: int, state: int, left: tuple, codes: list[str]) -> int:
    """Add the codes of ``n`` rows; long runs are halved, what is left at the middle comes from the cached powers."""
    if n <= 16:
        least = min(left)
        some, state = _unroll_short(symbol, n, state, tuple(x - least for x in left))
        codes.extend(some)
        return state
    head = 1 << (n - 1).bit_length() - 1
    state = _unroll(symbol, head, state, advance(symbol, n - head, left), codes)
    return _unroll(symbol, n - head, state, left, codes)


def repair(symbols, lengths) -> tuple[int, list[str]]:
    """The least cost, and per row the codes of the edits up to it (U, A: insertions; the last row also has those behind it)."""
    left = [_END]
    for symbol, n in zip(reversed(symbols), reversed(lengths)):
        left.append(advance(symbol, n, left[-1]))
    cost, state, codes = left[-1][0], 0, []
    for symbol, n, after in zip(symbols, lengths, reversed(left[:-1])):
        state = _unroll(symbol, n, state, after, codes)
    tail = {0: "", 1: "UA", 2: "A", 3: ""}[state]
    if tail:
        codes[-1] += tail
    return cost, codes


_INITIALS = str.maketrans({"u": "R", "a": "R", "U": "I", "A": "I"})
_LEGAL = {(0, 1), (1, 2), (2, 1)}


def _plan(batches):
    """Per conversation a row of counts and its audit, and per block a row of edits."""
    names = ["conv_id", "begin", "codes", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    for batch in batches:
        kinds = [batch.schema.field("conv_id").type, pa.int64(), pa.list_(pa.string()), *[pa.int64()] * 5, pa.large_string()]
        out = []
        for row in batch.to_pylist():
            symbols, lengths, sizes = [], [], []
            for block in row["blocks"]:
                own = np.frombuffer(block["lengths"], np.int32).tolist()
                sizes.append(sum(own))
                for s, n in zip(block["symbols"], own):
                    if symbols and symbols[-1] == s:
                        lengths[-1] += n
                    else:
                        symbols.append(s)
                        lengths.append(n)
            cost, codes = repair(symbols, lengths)
            faults = [0] * 4
            for s, n in zip(symbols, lengths):
                faults[s % 4] += n
            illegal = sum(lengths) - len(lengths) + sum((a // 4, b // 4) not in _LEGAL for a, b in zip(symbols, symbols[1:]))
            out.append((row["conv_id"], None, None, faults[2], faults[3], faults[1], illegal, cost, "".join(codes).translate(_INITIALS)))
            at = 0
            for block, n in zip(row["blocks"], sizes):
                out.append((row["conv_id"], block["begin"], codes[at:at + n], *[None] * 6))
                at += n
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)


def plan_repairs(lines: DataFrame) -> DataFrame:
    """Rows with an audit hold a conversation's counts; the others hold ``codes`` for the rows from ``begin`` on."""
    kind = lines.schema["conv_id"].dataType.simpleString()
    runs = _symbols(lines).mapInArrow(_runs, f"conv_id {kind}, begin long, symbols binary, lengths binary")
    whole = runs.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("begin", "symbols", "lengths"))).alias("blocks"))
    return stage(whole.mapInArrow(_plan, f"conv_id {kind}, begin long, codes array<string>, blank long, duplicate long, truncated long, "
                                         "illegal long, cost long, audit string"), "repairs")


def apply_repairs(lines: DataFrame, plans: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, at, step, edit, role, text, in the order of at and step."""
    edits = (plans.filter("audit is null").select("begin", F.posexplode("codes").alias("i", "code"))
             .select((F.col("begin") + F.col("i")).alias("at"), "code"))
    step = lines.join(edits, "at").select("conv_id", "at", "role", "text", F.posexplode(F.split("code", "")).alias("step", "code"))
    role = F.when(F.lower("code") == "u", "user").when(F.lower("code") == "a", "assistant").otherwise(F.col("role"))
    return (step.filter(F.col("code").isin(*"KuaUA"))
            .select("conv_id", "at", "step", F.translate("code", "uaUA", "RRII").alias("edit"), role.alias("role"),
                    F.when(F.col("code").isin("U", "A"), "").otherwise(F.col("text")).alias("text")))


def _digests(batches):
    """sha256 of each conversation's lines, which come in order; the lines of one may fill many batches."""
    at, running, begun = None, None, False
    for batch in batches:
        out = []
        for conv, line in zip(batch.column("conv_id").to_pylist(), batch.column("line")):
            text = line.as_py().encode()
            if begun and conv == at:
                running.update(b"\n")
            else:
                if begun:
                    out.append((at, running.hexdigest()))
                at, running, begun = conv, hashlib.sha256(), True
            running.update(text)
        kind = batch.schema.field("conv_id").type
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], kind), pa.array([o[1] for o in out])], ["conv_id", "repaired_sha256"])
    if begun:
        yield pa.RecordBatch.from_arrays([pa.array([at], kind), pa.array([running.hexdigest()])], ["conv_id", "repaired_sha256"])


def digests(repaired: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256 of the lines ``role:text``."""
    kind = repaired.schema["conv_id"].dataType.simpleString()
    return (repaired.repartition("conv_id").sortWithinPartitions("conv_id", "at", "step")
            .select("conv_id", F.concat("role", F.lit(":"), "text").alias("line"))
            .mapInArrow(_digests, f"conv_id {kind}, repaired_sha256 string"))


def repair_report(rows: DataFrame, damaged: DataFrame) -> DataFrame:
    """One row per conversation of ``rows``, from its rows after damage."""
    lines = in_order(damaged)
    plans = plan_repairs(lines)
    span = F.max("turn").cast("decimal(20)") - F.min("turn").cast("decimal(20)") + 1 - F.count_distinct("turn")
    gaps = lines.groupBy("conv_id").agg(span.alias("span"))
    gaps = gaps.select("conv_id", F.expr("try_cast(coalesce(span, 0) AS BIGINT)").alias("gaps"), F.lit(True).alias("some"))
    parts = [rows.select("conv_id"), gaps, plans.filter("audit is not null").drop("begin", "codes"), digests(apply_repairs(lines, plans))]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    counts = ["blank", "duplicate", "truncated", "illegal", "cost"]
    grouped = whole.groupBy("conv_id").agg(F.max("some").alias("some"), *[F.max(c).alias(c) for c in ("gaps", *counts, "audit", "repaired_sha256")])
    return grouped.select("conv_id", F.when(F.col("some").isNull(), 0).otherwise(F.col("gaps")).cast("long").alias("gaps"),
                          *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts], F.coalesce("audit", F.lit("")).alias("audit"),
                          F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return repair_report(rows, damage(rows))
