"""op11: every edit sequence by brute force, conversations over several tasks, odd rows."""

import hashlib
import random
import re
import zlib
from itertools import product

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from llm_helpers import CLASHING
from citeflow.llm import conversation_repair as R
from citeflow.llm.common import stored

RIGHT = re.compile(r"(s?(ua)+)?")


def brute(codes):
    """All edits of each turn, up to three inserts at each place: the cheapest, then the least audit."""
    best = None
    options = [["D", *([] if c[1] == "2" else ["K", "Ru", "Ra"])] for c in codes]
    inserts = ["", "u", "a", "ua", "au", "uau", "aua"]
    for edits in product(*options):
        for gaps in product(inserts, repeat=len(codes) + 1):
            out = audit = ""
            cost = 0
            for k, g in enumerate(gaps):
                out, audit, cost = out + g, audit + "I" * len(g), cost + 2 * len(g)
                if k < len(codes):
                    e, (c, fault) = edits[k], codes[k]
                    out += "" if e == "D" else c if e == "K" else e[1]
                    audit += e[0]
                    cost += {"D": 3, "K": 0, "R": 2}[e[0]] + (e != "D" and fault == "1")
            if RIGHT.fullmatch(out) and (best is None or (cost, audit) < best):
                best = cost, audit
    return best


def plain(codes):
    """The same by a table over turns and states, without heaps."""
    at = {0: (0, "")}

    def inserted(at):
        for _ in range(3):
            for s, (c, a) in list(at.items()):
                t = R.FORCED[s]
                at[t] = min(at.get(t, (10**9, "")), (c + 2, a + "I"))
        return at

    for code in codes:
        now = {}
        for s, (c, a) in inserted(at).items():
            for t, cost, op in R._steps(code, s):
                now[t] = min(now.get(t, (10**9, "")), (c + cost, a + op))
        at = now
    at = inserted(at)
    return min(at[e] for e in R.ACCEPTED if e in at)


CODES = [i + f for i in "sua?" for f in "012"]


def test_every_short_conversation():
    for n in (0, 1, 2):
        for codes in product(CODES, repeat=n):
            assert R.repair(list(codes)) == brute(codes) == plain(codes), codes


def test_some_of_three():
    rng = random.Random(2)
    for _ in range(25):
        codes = tuple(rng.choice(CODES) for _ in range(3))
        assert R.repair(list(codes)) == brute(codes) == plain(codes), codes


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(CODES), max_size=60), st.integers(1, 9))
def test_long_ones_and_chained_segments(codes, size):
    want = plain(codes)
    assert R.repair(codes) == want
    whole = R._chain(R.segment(codes[:size]), R.segment(codes[size:]))[0]
    assert R._least(iter([whole[e] for e in R.ACCEPTED])) == want


def expected(rows, damage=True):
    """Results per conversation, from plain Python over all rows."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = []
        for c, turn, role, text in rows:
            if c != conv:
                continue
            role, text = " " if role is None else role, " " if text is None else text
            code = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20 if damage else 9
            if code == 0:
                continue
            text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
            mine += [(turn, "user" if code == 4 else role, text)] * (2 if code == 3 else 1)
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        seen, codes, counts, initials = set(), [], [0, 0, 0], []
        for turn, role, text in mine:
            shown = text.rstrip(" \t\n\x0b\x0c\r")
            fault = 0 if not shown else 1 if (role, text) in seen else 2 if shown[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            initials.append(role[:1])
            codes.append((role[:1] if role[:1] in ("s", "u", "a") else "?") + {None: "0", 2: "1"}.get(fault, "2"))
        turns = {r[0] for r in mine} - {None}
        cost, audit = plain(codes)
        lines, state, at = [], 0, iter(mine)
        for op in audit:
            turn = next(at) if op != "I" else None
            if op == "D":
                continue
            state = R.FOLLOWS[state][turn[1][:1]] if op == "K" else R.FORCED[state]
            lines.append((turn[1] if op == "K" else {2: "user", 3: "assistant"}[state]) + ":" + (turn[2] if turn else ""))
        assert RIGHT.fullmatch("".join(x[0] for x in lines))
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *counts,
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def rows_of(rng, conv, n, start=0):
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", "Umpire", None]
    texts = ["Well.", "Why?", "No end", "", " \n", None, "x!  \t", "Ja … é", "a.b", "more. \x00"]
    return [(conv, start + k, rng.choice(roles if rng.random() < 0.3 else ["user", "assistant"][k % 2:][:1]), rng.choice(texts) if rng.random() < 0.5 else f"text {k}.")
            for k in range(n) if rng.random() < 0.95]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    out = [r for c in range(60) for r in rows_of(rng, c, rng.randrange(1, 12))]
    out += rows_of(rng, 1000, 900) + rows_of(rng, None, 5) + rows_of(rng, -7, 700, 10**15)
    out += [(2000, None, "user", "Null turn."), (2000, None, None, None), (2000, 3, "assistant", "y" * 200_000 + "."), (2001, None, "user", "a")]
    rng.shuffle(out)
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


@pytest.mark.parametrize("per_task", [40, 100_000])
def test_whole_results(spark, rows, per_task):
    df = frame(spark, rows).withColumns({c: F.lit(1) for c in CLASHING}).repartition(4)
    turns, present = R.damaged(df)
    turns = stored(R.coded(turns, present=present), "t")
    found = stored(R.audits(turns, per_task), "t")
    got = {r["conv_id"]: tuple(r)[1:] for r in R.repair_digests(turns, found).collect()}
    assert got == expected(rows)
    out = {}
    for r in sorted(R.repaired_turns(turns, found).collect(), key=lambda r: r["place"]):
        out.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    for conv, result in got.items():
        assert hashlib.sha256("\n".join(out.get(conv, [])).encode()).hexdigest() == result[-1]


def test_without_damage_and_nothing(spark, rows):
    turns = stored(R.coded(frame(spark, rows)), "t")
    got = {r["conv_id"]: tuple(r)[1:] for r in R.repair_digests(turns, stored(R.audits(turns, 50), "t")).collect()}
    assert got == expected(rows, damage=False)
    none = stored(R.coded(frame(spark, rows).where("turn < -9")), "t")
    audits = stored(R.audits(none), "t")
    assert R.repair_digests(none, audits).count() == 0 and R.repaired_turns(none, audits).count() == 0


def test_repeated_rows_and_other_keys(spark):
    rows = [("a", 1, "user", "Hi."), ("a", 1, "user", "Hi."), ("a", 2, "assistant", "Yes."), ("b", 1, "user", "Hi.")]
    df = spark.createDataFrame(rows, "who string, n long, part string, said string")
    turns = stored(R.coded(df, "who", "n", "part", "said"), "t")
    got = {r["conv_id"]: (r["duplicate"], r["cost"], r["audit"]) for r in R.audits(turns).collect()}
    assert got == {"a": (1, 3, "KDK"), "b": (0, 2, "KI")}


def test_dropped_conversations_remain(spark):
    key = next(i for i in range(1000) if zlib.crc32(f"{i}:7".encode()) % 20 == 0)
    df = frame(spark, [(key, 7, "user", "Gone."), (key + 10**9, 1, "user", "Hi.")])
    turns, present = R.damaged(df)
    turns = stored(R.coded(turns, present=present), "t")
    got = {r["conv_id"]: tuple(r)[1:] for r in R.repair_digests(turns, stored(R.audits(turns), "t")).collect()}
    assert got[key] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
