"""Repair of a conversation's structure by Wagner-Fischer alignment of its turns to the grammar `(s?(ua)+)?`.

The rows of a conversation are edited (Keep, Rerole, Delete, Insert) until the initials of their
roles follow the grammar, at the least cost, and of the cheapest edits those whose initials, read
as a string, are the least in ASCII. The rows are aligned to the alternating target string: one
table holds the cost of aligning the first i rows to the first j letters, so its last row has
every feasible length. Only cells that a script no dearer than the incumbent, a greedy repair, can
reach are filled (Ukkonen's band); each length of the least cost is backtraced, and the audits are
compared.

A conversation is aligned in windows of ROWS rows. What lies before a window matters only by the
last letter written (STATES), so each window is aligned from every letter and gives its cheapest
audit for every letter that it may end on. Inserts belong to the row behind them, so a repair
is cut into windows in one way, and two audits from the same letter differ before either ends.
Windows are then chained, FAN at a time, level by level, by costs and ranks of audits alone, and
the choices go down again: no task holds a conversation. Places in a conversation come from a range
partitioning and counts before each partition, not from a window over the conversation. Only
digest(), whose hash runs over a whole conversation by definition, reads one in one task, and
it streams.

Defined results: a null role or text is one space, as the contract has it; a null conv_id is a conversation;
rows of one turn are taken by role and text; null turns come first and leave no gap; a role whose
initial is none of s, u and a, or that is empty, cannot be kept; of repeated rows all but the
first are duplicates; texts are equal if their SHA-256 are; an empty table gives no rows; further
columns are not read, and names of the result may be among them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brontide.llm.common import Scratch

#: Rows of a window, and windows (or groups of them) that are chained at once.
ROWS, FAN = 256, 64
#: Costs of the contract.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: What was written last: nothing, s, u, a; the alternating letters that may follow; where a repair may end.
STATES = {"": 0, "s": 1, "u": 2, "a": 3}
_FOLLOW = {0: "ua", 1: "ua", 2: "au", 3: "ua"}
_ENDS = (0, 3)
#: A row as a letter: initial (x: another) of a good, a truncated, a blank and a repeated row.
_GOOD, _CUT, _BLANK, _REPEATED = "suax", "SUAX", "0123", "4567"
_LEGAL = {"su", "ua", "au"}
_NONSPACE = r"[^\x20\x09-\x0D]"


def _greedy(rows: str, state: int, end: int) -> int:
    """Cost of a repair that keeps or reroles every row it may, and ends on letter u (2) or a (3)."""
    kept = [r for r in rows if r.isalpha()]
    cost = DELETE * (len(rows) - len(kept))
    for i, r in enumerate(kept):
        cost += TRUNCATED * r.isupper()
        if state == 0 and r in "sS" and i + 1 < len(kept):
            state = 1
            continue
        letter = 3 if state == 2 else 2
        if i + 1 == len(kept) and letter != end:
            cost, letter = cost + INSERT, end
        cost += REROLE * (r.lower() != "?sua"[letter])
        state = letter
    return cost


def _audits(rows: str, target: str, last: bool, ins: int, dels: int) -> dict[int, tuple[int, list]]:
    """(cost, table) of aligning all rows to each prefix of target that stays inside the band: at most ins
    letters more, and dels fewer, than rows that may stay."""
    n, free = len(rows), [0]
    for r in rows:
        free.append(free[-1] + r.isalpha())
    far = 10**9
    low = [max(0, f - dels) for f in free]
    high = [min(len(target), f + ins) for f in free]
    table: list[list[int]] = []
    for i in range(n + 1):
        line = [far] * (high[i] - low[i] + 1)
        above, r = (table[i - 1], rows[i - 1]) if i else (None, "")
        for j in range(low[i], high[i] + 1):
            best = 0 if i == j == 0 else far
            if i:
                k = j - low[i - 1]
                if 0 <= k < len(above):
                    best = above[k] + DELETE
                if r.isalpha() and 0 < k <= len(above):
                    best = min(best, above[k - 1] + _match(r, target[j - 1]))
            if j > low[i] and (i < n or last) and target[j - 1] != "s":
                best = min(best, line[j - 1 - low[i]] + INSERT)
            line[j - low[i]] = min(best, far)
        table.append(line)
    return {j: (table[n][j - low[n]], [table, low]) for j in range(low[n], high[n] + 1) if table[n][j - low[n]] < far}


def _match(row: str, letter: str) -> int:
    extra = TRUNCATED * row.isupper()
    if row.lower() == letter:
        return extra
    return extra + REROLE if letter != "s" else 10**9


def _backtrace(rows: str, target: str, length: int, held: list, last: bool) -> str:
    """The least of the cheapest scripts: cells on a cheapest path are marked from the end, and the
    path from the start takes the least edit that stays on them."""
    table, low = held
    n = len(rows)

    def at(i: int, j: int) -> int:
        k = j - low[i]
        return table[i][k] if 0 <= k < len(table[i]) else 10**9

    alive: list[set[int]] = [set() for _ in range(n + 1)]
    alive[n].add(length)
    for i in range(n, -1, -1):
        for j in range(low[i] + len(table[i]) - 1, low[i] - 1, -1):
            here = at(i, j)
            if j not in alive[i] and (i < n or last) and j < len(target) and target[j] != "s" and j + 1 in alive[i] and at(i, j + 1) == here + INSERT:
                alive[i].add(j)
            if j in alive[i] and i:
                if at(i - 1, j) + DELETE == here:
                    alive[i - 1].add(j)
                if j and rows[i - 1].isalpha() and at(i - 1, j - 1) + _match(rows[i - 1], target[j - 1]) == here:
                    alive[i - 1].add(j - 1)
    out, i, j = [], 0, 0
    while (i, j) != (n, length):
        here = at(i, j)
        if i < n and j in alive[i + 1] and at(i + 1, j) == here + DELETE:
            i, edit = i + 1, "D"
        elif j + 1 in alive[i] and (i < n or last) and target[j] != "s" and at(i, j + 1) == here + INSERT:
            j, edit = j + 1, "I"
        else:
            edit = "K" if rows[i].lower() == target[j] else "R"
            i, j = i + 1, j + 1
        out.append(edit)
    return "".join(out)


@lru_cache(20_000)
def aligned(rows: str, starts: tuple[int, ...], last: bool) -> list[tuple[int, int, int, str]]:
    """(start, end, cost, audit): the cheapest and then least audit of the rows between two letters."""
    stay = [r for r in rows if r.isalpha()]
    least = DELETE * (len(rows) - len(stay)) + TRUNCATED * sum(r.isupper() for r in stay)
    unit = DELETE - TRUNCATED if any(r.isupper() for r in stay) else DELETE
    out = []
    for start in starts:
        found: dict[int, list[tuple[int, str, int, list]]] = {}
        # Of a window that is followed by another, an end without a row kept or reroled is its start.
        ends = [e for e in (2, 3) if stay or last]
        incumbent = max([_greedy(rows, start, e) if stay else least + 2 * INSERT for e in ends] or [least]) - least
        # An end on s keeps one row and deletes the others.
        if start == 0 and not last:
            incumbent = max(incumbent, DELETE * len(stay))
        ins, dels = incumbent // INSERT, min(len(stay), incumbent // unit)
        for first in ("s", "") if start == 0 else ("",):
            size = len(stay) + ins + 1
            target = (first + _FOLLOW[start] * (size // 2 + 1))[:size]
            for length, (cost, held) in _audits(rows, target, last, ins, dels).items():
                if first and not length:
                    continue
                end = STATES[target[length - 1]] if length else start
                if last and end not in _ENDS:
                    continue
                found.setdefault(end, []).append((cost, target, length, held))
        if len(stay) > dels and (start in _ENDS or not last):
            found.setdefault(start, []).append((DELETE * len(rows), "", 0, []))
        for end, ways in found.items():
            cost = min(w[0] for w in ways)
            audits = [_backtrace(rows, w[1], w[2], w[3], last) if w[3] else "D" * len(rows) for w in ways if w[0] == cost]
            out.append((start, end, cost, min(audits)))
    return out


def _ranked(own: list[tuple[int, int, int, str]], last: bool, first: bool) -> list[dict]:
    """Audits of one start, in order; of a whole conversation only the best."""
    if first and last:
        own = [min(own, key=lambda e: (e[2], e[3]))]
    order = sorted(own, key=lambda e: e[3])
    return [{"start": e[0], "end": e[1], "cost": e[2], "rank": order.index(e), "audit": e[3]} for e in own]


_WAY = T.StructType().add("start", "integer").add("end", "integer").add("cost", "long").add("rank", "integer")
_WINDOW = T.StructType().add("illegal", "long").add("ways", T.ArrayType(T.StructType([*_WAY.fields, T.StructField("audit", T.StringType())])))
_CHOICE = T.StructType().add("g", "long").add("start", "integer").add("end", "integer")
_ENTRY = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("rank", pa.int32())])


@F.arrow_udf(_WINDOW)
def _window(codes: pa.Array, numbers: pa.Array, last: pa.Array) -> pa.Array:
    out = []
    for code, w, end in zip(codes.to_pylist(), numbers.to_pylist(), last.to_pylist(), strict=True):
        initials = ["suax"["suaxSUAX01234567".index(c) % 4] for c in code]
        illegal = sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:], strict=False))
        own = aligned(code[1:] if w else code, (0, 1, 2, 3) if w else (0,), end)
        out.append({"illegal": illegal, "ways": _ranked(own, end, not w)})
    return pa.array(out, pa.struct([("illegal", pa.int64()), ("ways", pa.list_(pa.struct([*_ENTRY, ("audit", pa.string())])))]))


def _chained(children: list[list[dict]]) -> dict[tuple[int, int], tuple[int, tuple, tuple]]:
    """(cost, ranks, letters between) of the best way through all children, by start and end."""
    best = {(e["start"], e["end"]): (e["cost"], (e["rank"],), (e["end"],)) for e in children[0]}
    for ways in children[1:]:
        longer: dict[tuple[int, int], tuple[int, tuple, tuple]] = {}
        for (start, middle), (cost, ranks, letters) in best.items():
            for e in ways:
                if e["start"] == middle:
                    new = (cost + e["cost"], (*ranks, e["rank"]), (*letters, e["end"]))
                    if (start, e["end"]) not in longer or new < longer[start, e["end"]]:
                        longer[start, e["end"]] = new
        best = longer
    return best


@F.arrow_udf(T.ArrayType(_WAY))
def _up(groups: pa.Array) -> pa.Array:
    out = []
    for children in groups.to_pylist():
        best = _chained([c["ways"] for c in children])
        order = sorted(best, key=lambda k: best[k][1])
        out.append([{"start": k[0], "end": k[1], "cost": v[0], "rank": order.index(k)} for k, v in best.items()])
    return pa.array(out, pa.list_(_ENTRY))


@F.arrow_udf(T.ArrayType(_CHOICE))
def _down(groups: pa.Array, starts: pa.Array, ends: pa.Array) -> pa.Array:
    out = []
    for children, start, end in zip(groups.to_pylist(), starts.to_pylist(), ends.to_pylist(), strict=True):
        letters = _chained([c["ways"] for c in children])[start, end][2]
        out.append([{"g": c["g"], "start": a, "end": b} for c, a, b in zip(children, (start, *letters), letters, strict=False)])
    return pa.array(out, pa.list_(pa.struct([("g", pa.int64()), ("start", pa.int32()), ("end", pa.int32())])))


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places of rows among those of their conversation in this partition."""
    before, place = None, 0
    for batch in batches:
        places = []
        for key in batch.column("ck").to_pylist():
            place = place + 1 if key == before else 0
            before = key
            places.append(place)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(places, pa.int64())], [*batch.schema.names, "place"])


def _laid(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """Rows with the place in their conversation and its size. rand: equal rows are dealt to several ranges."""
    order = ["ck", F.col("turn").asc_nulls_first(), "role"]
    dealt = rows.repartitionByRange(*order, F.substring("text", 1, 64), F.rand(11)).sortWithinPartitions(*order, "text")
    dealt = dealt.withColumn("part", F.spark_partition_id())
    laid = scratch.written(dealt.mapInArrow(_numbered, f"{_ddl(dealt)}, place long"), "turns")
    # A partition goes on with one earlier conversation at most, so there are no more offsets than partitions.
    counts = laid.groupBy("ck", "part").agg(F.count("*").alias("rows"))
    w = Window.partitionBy("ck").orderBy("part")
    offsets = counts.withColumn("offset", F.sum("rows").over(w.rowsBetween(Window.unboundedPreceding, -1))).where("offset IS NOT NULL")
    offsets = scratch.written(offsets.select("ck", "part", "offset"), "offsets")
    return laid.join(F.broadcast(offsets), ["ck", "part"], "left").withColumn("pos", F.col("place") + F.coalesce("offset", F.lit(0))).drop("place", "offset", "part")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{n}` {t}" for n, t in df.dtypes)


def _code(blank: Column, repeated: Column, cut: Column) -> Column:
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 1).when(initial == "u", 2).when(initial == "a", 3).otherwise(4)
    letters = F.when(blank, _BLANK).when(repeated, _REPEATED).when(cut, _CUT).otherwise(_GOOD)
    return letters.substr(kind, F.lit(1))


def never_null(col: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(col).cast("string")), F.lit(""))


class Repaired:
    """summary: ck (a key that is never null), conv_id, gaps, blank, duplicate, truncated, illegal, cost. turns: the rows of the
    repaired conversations (deleted ones too) with their edit. clear() deletes what both read."""

    def __init__(self, conversations: DataFrame):
        self._scratch = Scratch(conversations.sparkSession)
        key = never_null("conv_id")
        space = F.lit(" ")
        rows = conversations.select(key.alias("ck"), "conv_id", "turn", F.coalesce(F.col("role"), space).alias("role"), F.coalesce(F.col("text"), space).alias("text"))
        self._rows = _laid(rows, self._scratch)
        self._windows = self._align(self._coded())
        self._plans = self._choose()

    def _coded(self) -> DataFrame:
        last = F.regexp_extract("text", rf"(?s)({_NONSPACE})[\x20\x09-\x0D]*\z", 1)
        same = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256)
        rows = self._rows.select("ck", "pos", "role", same.alias("same"), (last == "").alias("blank"), (~last.isin(*".!?")).alias("cut"))
        rows = self._scratch.written(rows, "turn-facts")
        firsts = rows.where("NOT blank").groupBy("ck", "same").agg(F.min("pos").alias("first"), F.count("*").alias("times")).where("times > 1")
        rows = rows.join(firsts.drop("times"), ["ck", "same"], "left")
        repeated = F.coalesce(F.col("pos") > F.col("first"), F.lit(False))
        return rows.select("ck", "pos", _code(F.col("blank"), repeated, F.col("cut")).alias("code"))

    def _align(self, coded: DataFrame) -> DataFrame:
        """(ck, w, codes, illegal, ways); the last row of a window also stands before the next one."""
        w = F.floor(F.col("pos") / ROWS)
        each = coded.select("ck", F.explode(F.when(F.col("pos") % ROWS == ROWS - 1, F.array(w, w + 1)).otherwise(F.array(w))).alias("w"), "pos", "code")
        codes = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "code"))), lambda x: x["code"]), "")
        grouped = each.groupBy("ck", "w").agg(codes.alias("codes"), F.max("pos").alias("end")).where(F.col("end") >= F.col("w") * ROWS)
        size = grouped.groupBy("ck").agg(F.max("end").alias("size"))
        grouped = self._scratch.written(grouped.join(size, "ck"), "windows")
        # Few bytes, much work: dealt by number, so that no task gets all that fits into a partition.
        parts = int(grouped.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        grouped = grouped.repartition(parts, "ck", "w")
        ways = _window("codes", "w", F.col("end") == F.col("size"))
        return self._scratch.written(grouped.select("ck", "w", "codes", ways.alias("a")).select("ck", "w", "codes", "a.illegal", "a.ways"), "aligned")

    def _choose(self) -> DataFrame:
        """(ck, w, start, audit, cost) of all windows."""
        several = self._windows.groupBy("ck").agg(F.max("w").alias("most")).where("most > 0").select("ck")
        levels = [self._scratch.written(self._windows.join(several, "ck", "left_semi").select("ck", F.col("w").alias("g"), "ways"), "chain")]
        groups: list[DataFrame] = []
        while not levels[-1].where("g > 0").isEmpty():
            group = levels[-1].groupBy("ck", F.floor(F.col("g") / FAN).alias("up")).agg(F.array_sort(F.collect_list(F.struct("g", F.transform("ways", lambda e: F.struct(e["start"].alias("start"), e["end"].alias("end"), e["cost"].alias("cost"), e["rank"].alias("rank"))).alias("ways")))).alias("children"))
            groups.append(self._scratch.written(group, "chain"))
            levels.append(self._scratch.written(groups[-1].select("ck", F.col("up").alias("g"), _up("children").alias("ways")), "chain"))
        one = self._windows.join(several, "ck", "left_anti").select("ck", "w", F.lit(0).alias("start"), F.col("ways")[0]["audit"].alias("audit"), F.col("ways")[0]["cost"].alias("cost"))
        if not groups:
            return one
        best = F.array_min(F.transform("ways", lambda e: F.struct(e["cost"].alias("cost"), e["rank"].alias("rank"), e["start"].alias("start"), e["end"].alias("end"))))
        chosen = levels[-1].select("ck", "g", best.alias("b")).select("ck", "g", "b.start", "b.end")
        for group in reversed(groups):
            chosen = group.join(chosen.withColumnRenamed("g", "up"), ["ck", "up"]).select("ck", F.inline(_down("children", "start", "end")))
            chosen = self._scratch.written(chosen, "chosen")
        way = F.filter("ways", lambda e: (e["start"] == F.col("start")) & (e["end"] == F.col("end")))[0]
        picked = levels[0].join(chosen, ["ck", "g"]).select("ck", F.col("g").alias("w"), "start", way.alias("way"))
        return one.unionByName(picked.select("ck", "w", "start", "way.audit", "way.cost"))

    @property
    def summary(self) -> DataFrame:
        counts = {"blank": _BLANK, "duplicate": _REPEATED, "truncated": _CUT}
        own = F.when(F.col("w") > 0, F.expr("substr(codes, 2)")).otherwise(F.col("codes"))
        found = [F.sum(F.length(F.translate(own, "".join(x for k in (_GOOD, _CUT, _BLANK, _REPEATED) if k != v for x in k), ""))).alias(k) for k, v in counts.items()]
        faults = self._windows.groupBy("ck").agg(*found, F.sum("illegal").alias("illegal"))
        costs = self._plans.groupBy("ck").agg(F.sum("cost").alias("cost"))
        turns = self._rows.groupBy("ck", "turn").agg(F.first("conv_id").alias("conv_id")).groupBy("ck").agg(F.first("conv_id").alias("conv_id"), (F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps"))
        return turns.join(faults, "ck").join(costs, "ck").select("ck", "conv_id", F.coalesce("gaps", F.lit(0)).cast("long").alias("gaps"), *(F.col(c).cast("long").alias(c) for c in (*counts, "illegal", "cost")))

    def _edited(self, *by: str) -> DataFrame:
        """Rows behind the plan of their window, in order; by: what a task gets whole."""
        plans = self._plans.select("ck", F.col("w").cast("long").alias("w"), F.lit(-1).cast("long").alias("pos"), "start", "audit")
        rows = self._rows.withColumn("w", F.floor(F.col("pos") / ROWS))
        both = rows.unionByName(plans, allowMissingColumns=True)
        both = both.repartition(*by).sortWithinPartitions("ck", "w", "pos")
        return both.select("ck", "conv_id", "turn", "role", "text", "w", "pos", "start", "audit").mapInArrow(_apply, _TURNS.format(conv=dict(both.dtypes)["conv_id"], turn=dict(both.dtypes)["turn"]))

    @property
    def turns(self) -> DataFrame:
        return self._edited("ck", "w").select("conv_id", "w", "place", "turn", "role", "text", "edit")

    def digest(self) -> DataFrame:
        """(ck, audit, repaired_sha256). The hash of a conversation is one chain, so a task reads
        a conversation whole, as a stream."""
        return self._edited("ck").select("ck", "role", "text", "edit").mapInArrow(_hashed, "ck string, audit string, repaired_sha256 string")

    def clear(self) -> None:
        self._scratch.clear()


_TURNS = "ck string, conv_id {conv}, w long, place long, turn {turn}, role string, text string, edit string"
_NEXT = {0: "user", 1: "user", 2: "assistant", 3: "user"}


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edits of each plan, applied to the rows that follow it."""
    rest, at, tail, state, place = "", 0, 0, 0, 0
    names = ["ck", "conv_id", "w", "place", "turn", "role", "text", "edit"]
    for batch in batches:
        kinds = {f.name: f.type for f in batch.schema}
        out: list[list] = [[] for _ in names]

        def put(*row, out=out):
            for own, value in zip(out, row, strict=True):
                own.append(value)

        for key, conv, turn, role, text, w, pos, start, audit in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if pos < 0:
                rest, at, tail, state, place = audit, 0, len(audit.rstrip("I")), start, 0
                continue
            while rest[at] == "I":
                put(key, conv, w, place, None, _NEXT[state], "", "I")
                state, at, place = STATES[_NEXT[state][0]], at + 1, place + 1
            edit = rest[at]
            at += 1
            if edit == "R":
                role = _NEXT[state]
            if edit != "D":
                state = STATES[role[0]]
            put(key, conv, w, place, turn, role, text, edit)
            place += 1
            while tail <= at < len(rest):  # inserts behind the last row
                put(key, conv, w, place, None, _NEXT[state], "", "I")
                state, at, place = STATES[_NEXT[state][0]], at + 1, place + 1
        types = [pa.string(), kinds["conv_id"], pa.int64(), pa.int64(), kinds["turn"], pa.string(), pa.string(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, types, strict=True)], names)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, sha, audit, written_before = None, hashlib.sha256(), bytearray(), False

    def row():
        return pa.RecordBatch.from_pydict({"ck": [key], "audit": [audit.decode()], "repaired_sha256": [sha.hexdigest()]})

    for batch in batches:
        done = []
        for own, role, text, edit in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if own != key:
                if key is not None:
                    done.append(row())
                key, sha, audit, written_before = own, hashlib.sha256(), bytearray(), False
            audit += edit.encode()
            if edit != "D":
                sha.update((b"\n" if written_before else b"") + f"{role}:{text}".encode())
                written_before = True
        yield from done
    if key is not None:
        yield row()


def damaged(conversations: DataFrame) -> DataFrame:
    """The contract's damage, by the CRC-32 of `conv_id:turn`: what a repair can be tried on."""
    space = F.lit(" ")
    text, role = F.coalesce(F.col("text"), space), F.coalesce(F.col("role"), space)
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(key.cast("binary")) % 20).alias("h")).where("h <> 0")
    text = F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = rows.select("conv_id", "turn", F.when(F.col("h") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.when(F.col("h") == 3, 2).otherwise(1).alias("times"))
    return rows.select("conv_id", "turn", "role", "text", F.explode(F.array_repeat(F.lit(0), F.col("times")))).drop("col")
