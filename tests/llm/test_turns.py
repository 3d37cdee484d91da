"""Repaired conversations against a search over all scripts of edits."""

import random
import re
import zlib
from collections import defaultdict
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from brontide.llm import queries, turns
from tests.llm.helpers import sha256

FIELDS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
NONE = (0, 0, 0, 0, 0, 0, "", sha256(""))


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        out += [(conv, turn, "user" if h == 4 else role, text)] * (0 if h == 0 else 2 if h == 3 else 1)
    return out


def facts(rows):
    """(role, text, fault) of the rows of a conversation in order."""
    seen, out = set(), []
    for _, _, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3])):
        last = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
        fault = "blank" if not last else "duplicate" if (role, text) in seen else "" if last[0] in ".!?" else "truncated"
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def search(rows):
    """(cost, audit) of the cheapest and then least of all scripts. No cheapest script inserts three
    letters in a row, as two of them can go."""

    @lru_cache(None)
    def best(i, before, inserted):
        ways = [(0, "")] if i == len(rows) and before in ("", "a") else []

        def way(price, edit, then):
            ways.append((price + then[0], edit + then[1]))

        if inserted < 3:
            for letter in "ua":
                if before + letter in {"u", "su", "ua", "au"}:
                    way(3, "I", best(i, letter, inserted + 1))
        if i < len(rows):
            role, _, fault = rows[i]
            way(4, "D", best(i + 1, before, 0))
            if fault not in ("blank", "duplicate"):
                for new, price, edit in [(role, 0, "K"), ("user", 3, "R"), ("assistant", 3, "R")]:
                    if new[:1] and before + new[0] in {"s", "u", "su", "ua", "au"}:
                        way(price + 3 * (fault == "truncated"), edit, best(i + 1, new[0], 0))
        return min(ways, default=(10**9, ""))

    return best(0, "", 0)


def repaired(rows, audit):
    out, i, before = [], 0, ""
    for edit in audit:
        following = {"": "user", "s": "user", "u": "assistant", "a": "user"}[before]
        if edit == "I":
            out.append((following, ""))
        else:
            role, text, _ = rows[i]
            i += 1
            if edit == "D":
                continue
            out.append((role if edit == "K" else following, text))
        before = out[-1][0][0]
    assert i == len(rows) and re.fullmatch("(s?(ua)+)?", "".join(r[0] for r, _ in out))
    return out


def expected(rows):
    convs = defaultdict(list)
    for r in rows:
        convs[r[0]].append(r)
    out = {}
    for conv, own in convs.items():
        found = facts(own)
        at = {r[1] for r in own if r[1] is not None}
        initials = [r[0][:1] for r in found]
        cost, audit = search(found)
        faults = [sum(f == k for *_, f in found) for k in ("blank", "duplicate", "truncated")]
        illegal = sum(a + b not in {"su", "ua", "au"} for a, b in zip(initials, initials[1:], strict=False))
        digest = sha256("\n".join(f"{r}:{t}" for r, t in repaired(found, audit)))
        out[conv] = (max(at) - min(at) + 1 - len(at) if at else 0, *faults, illegal, cost, audit, digest)
    return out


def found(frame):
    rows = frame.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r[f] for f in FIELDS) for r in rows}


def of(spark, rows):
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"ck": F.lit("x"), "w": F.lit(1), "pos": F.lit(2), "audit": F.lit("")})
    fixed = turns.Repaired(frame)
    return found(fixed.summary.join(fixed.digest(), "ck")), fixed


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = dict.fromkeys((r[0] for r in rows), NONE) | expected(damage(rows))
    got = found(queries.queries()["op11_turn_repair"](spark, sf))
    assert got == want


def some_rows(conv, n, dice):
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "s"]
    texts = ["Fine.", "And so", " \t", "What?", "no end", None, "Yes!  \n", "Fine."]
    return [(conv, dice.choice([None, i // 2, i, i + 3]), dice.choice(roles), dice.choice(texts) if dice.random() < 0.6 else f"text {i}.") for i in range(n)]


def test_small_conversations_with_all_faults(spark):
    dice = random.Random(5)
    rows = [r for conv in [None, *range(120)] for r in some_rows(conv, dice.randint(1, 9), dice)]
    got, fixed = of(spark, rows)
    spaced = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    assert got == expected(spaced)
    fixed.clear()
    assert found(turns.Repaired(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).summary.withColumns({"audit": F.lit(""), "repaired_sha256": F.lit("")})) == {}


def automaton(rows):
    """Cost and least audit by what was written last, from the end; quick for many rows."""
    far, letters = (10**9, ""), {"": 0, "s": 1, "u": 2, "a": 3}
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}

    def inserted(at):
        for _ in range(3):
            at = {b: min([at[b], *((at[x][0] + 3, "I" + at[x][1]) for x in follow[b] if x != "s")]) for b in letters}
        return at

    at = inserted({b: (0, "") if b in ("", "a") else far for b in letters})
    for role, _, fault in reversed(rows):
        here = {}
        for b in letters:
            ways = [(at[b][0] + 4, "D" + at[b][1])]
            if fault not in ("blank", "duplicate"):
                extra = 3 * (fault == "truncated")
                for x in follow[b]:
                    if role[:1] == x:
                        ways.append((at[x][0] + extra, "K" + at[x][1]))
                    if x != "s":
                        ways.append((at[x][0] + extra + 3, "R" + at[x][1]))
            here[b] = min(ways)
        at = inserted(here)
    return at[""]


def test_long_conversation_over_several_windows(spark, monkeypatch):
    """A conversation of many windows and two levels of chains, most rows of the table, beside short ones."""
    monkeypatch.setattr(turns, "ROWS", 8)
    monkeypatch.setattr(turns, "FAN", 3)
    dice = random.Random(3)
    rows = [(1, i, dice.choice(["user", "assistant", "system"]), f"{'x' * 50 * (i % 7)} {dice.randint(0, 150)}{dice.choice('.,')}") for i in range(240)]
    rows += [r for conv in range(2, 30) for r in some_rows(conv, dice.randint(1, 20), dice)]
    rows = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    got, fixed = of(spark, rows)
    convs = defaultdict(list)
    for r in rows:
        convs[r[0]].append(r)
    for conv, own in convs.items():
        own = facts(own)
        cost, audit = automaton(own)
        assert got[conv][5:] == (cost, audit, sha256("\n".join(f"{r}:{t}" for r, t in repaired(own, audit))))
    edited = [r for r in fixed.turns.where("conv_id = 1").orderBy("w", "place").collect()]
    assert "".join(r.edit for r in edited) == got[1][6]
    assert [(r.role, r.text) for r in edited if r.edit != "D"] == repaired(facts(convs[1]), got[1][6])


@pytest.mark.parametrize("n", [1, 5, 17, 60])
def test_windows_agree_with_the_automaton(n):
    dice = random.Random(n)
    for _ in range(60):
        codes = "".join(dice.choice("suaxSUAX04suauaua") for _ in range(n))
        rows = [({"s": "s", "u": "u", "a": "a", "x": "x"}["suax"["suaxSUAX01234567".index(c) % 4]], "", "blank" if c in "04" else "truncated" if c.isupper() else "") for c in codes]
        own = turns.aligned(codes, (0,), True)
        assert min((e[2], e[3]) for e in own) == automaton(rows)
