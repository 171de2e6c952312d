"""Conversation repair against a row-by-row search and by hand."""

import hashlib
import itertools
import random
import re
import zlib
from functools import cache

from pyspark.sql import functions as F

from cardlake.llm import conversations as C
from cardlake.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"
BLANK = " \t\n\x0b\x0c\r"


def cheapest(rows):
    """(cost, audit, repaired rows) by trying every edit at every row; rows: (role, text, fault)."""
    @cache
    def rest(i, state, inserted=0):
        out = [] if state not in "$a" else [(0, "", ())] if i == len(rows) else []
        turn = "a" if state == "u" else "u"
        name = {"u": "user", "a": "assistant"}[turn]
        if inserted < 2:  # a third insertion in a row leads where the first one did
            cost, audit, left = rest(i, turn, inserted + 1)
            out.append((cost + 5, "I" + audit, ((name, ""),) + left))
        if i < len(rows):
            role, text, fault = rows[i]
            cost, audit, left = rest(i + 1, state)
            out.append((cost + 2, "D" + audit, left))
            if fault in ("fine", "truncated"):
                more, first = 5 * (fault == "truncated"), role[:1]
                if (first, state) in {("s", "$"), ("u", "$"), ("u", "s"), ("u", "a"), ("a", "u")}:
                    cost, audit, left = rest(i + 1, first)
                    out.append((cost + more, "K" + audit, ((role, text),) + left))
                cost, audit, left = rest(i + 1, turn)
                out.append((cost + more + 1, "R" + audit, ((name, text),) + left))
        return min(out, default=(10**9, "", ()))
    return rest(0, "$")


def expected(rows):
    """The report of already damaged rows of one conversation, in order: (turn, role, text)."""
    seen, told = set(), []
    for _, role, text in rows:
        bare = text.rstrip(BLANK)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "fine" if bare[-1] in ".!?" else "truncated"
        seen.add((role, text))
        told.append((role, text, fault))
    cost, audit, left = cheapest(tuple(told))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    firsts = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(firsts))
    assert re.fullmatch(r"(s?(ua)+)?", "".join(r[0] for r, _ in left))
    lines = "\n".join(f"{r}:{t}" for r, t in left)
    count = [sum(f == k for _, _, f in told) for k in ("blank", "duplicate", "truncated")]
    return (gaps, *count, illegal, cost, audit, hashlib.sha256(lines.encode()).hexdigest())


def damaged(rows):
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out[conv] += [(turn, "user" if kind == 4 else role, text)] * (1 + (kind == 3))
    return {c: sorted(v, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])) for c, v in out.items()}


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def found(df):
    return {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in df.collect()}


def test_against_search(spark):
    pick = random.Random(5)
    rows = []
    for conv in [None, *range(150)]:
        for turn in range(pick.randrange(1, 9)):
            rows.append((conv, pick.choice([turn, turn, turn, turn + 2, None]), pick.choice(["user", "assistant", "user", "system", "", None, "tool"]),
                         pick.choice(["One.", "Two?", "Three!  \n", "half", "", " \t", None, "One.", "é…", "end.\x0b"])))
    rows += [(500, t, r, f"{t}.") for t, r in enumerate(["user", "assistant"] * 6)] + rows[:7]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumn("at", F.lit(1)).withColumn("symbol", F.lit("x"))
    want = {c: expected(v) for c, v in damaged(rows).items()}
    assert found(C.repair_report(df, C.damage(df))) == want


def test_registered_query(spark):
    path = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(QUERIES["op11_conversation_repair"](spark, path)) == {c: expected(v) for c, v in damaged(rows).items()}


def test_long_runs_are_unrolled_as_single_rows():
    pick = random.Random(1)
    for _ in range(60):
        symbols, lengths = [], []
        for _ in range(pick.randrange(1, 6)):
            s = pick.randrange(16)
            if not symbols or symbols[-1] != s:
                symbols.append(s)
                lengths.append(pick.choice([1, 2, 3, 17, 40, 150]))
        single = [s for s, n in zip(symbols, lengths) for _ in range(n)]
        assert C.repair(symbols, lengths) == C.repair(single, [1] * len(single))


def test_one_conversation_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(C, "BLOCK_BITS", 3)
    rows = [(7, t % 200, ["user", "assistant", "user"][t % 3], f"Line {t % 150}{'.' * (t % 7 > 0)}") for t in range(300)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = found(C.repair_report(df, df))
    ordered = sorted([r[1:] for r in rows])
    symbols, seen = [], set()
    for _, role, text in ordered:
        symbols.append("sua".index(role[0]) * 4 + (3 if (role, text) in seen else 0 if text[-1] == "." else 1))
        seen.add((role, text))
    cost, codes = C.repair(symbols, [1] * len(symbols))
    audit = "".join(codes).translate(C._INITIALS)
    assert got[7][5:7] == (cost, audit) and got[7][2] == sum(s % 4 == 3 for s in symbols)


def test_by_hand_and_odd_rows(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Hi."), (1, 2, "assistant", "Yes."),   # the copy goes
            (2, 0, "assistant", "A."),                                                     # deleted (2), not preceded by an insertion (5)
            (3, 0, "system", "S."), (3, 1, "user", "U."), (3, 2, "user", "V."),            # V becomes the answer
            (4, None, "user", "Q."), (4, -5, "assistant", "A."), (4, 2**62, "user", "")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = found(C.repair_report(df, df))
    assert [got[c][5:7] for c in (1, 2, 3, 4)] == [(2, "KDK"), (2, "D"), (1, "KKR"), (2, "KKD")]
    assert got[4][:2] == (2**62 + 5 + 1 - 2, 1)
    assert got[2][7] == hashlib.sha256(b"").hexdigest()
    assert got[3][7] == hashlib.sha256(b"system:S.\nuser:U.\nassistant:V.").hexdigest()
    wide = spark.createDataFrame([(1, -2**63, "user", "A."), (1, 2**63 - 1, "assistant", "B.")], SCHEMA)
    assert found(C.repair_report(wide, wide))[1][0] is None
    none = found(C.repair_report(df, df.limit(0)))
    assert none == {c: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c in (1, 2, 3, 4)}
    assert found(C.repair_report(df.limit(0), df.limit(0))) == {}
    long = spark.createDataFrame([(1, 0, "user", "a " * 400000 + "."), (1, 1, "assistant", " " * 400000)], SCHEMA)
    assert found(C.repair_report(long, long))[1][1:7] == (1, 0, 0, 0, 4, "DD")
