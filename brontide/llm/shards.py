"""Sharding by minimax contiguous partition.

Rows with equal texts form one atomic group; groups are ordered by their text's 64-bit hash.
The smallest capacity for which greedy filling needs no more than the given shards is found by
binary search, and shards are cut under it. The driver never sees all groups: it holds sums of
hash ranges, asks both an optimist (ranges can be cut anywhere) and a pessimist (ranges are
whole), and splits only those ranges where a cut may fall, until both agree. The cuts are then
a few hash values, and assigning rows is one expression.

Defined results: a null text is empty and grouped with empty ones; with fewer groups than
shards some shards are empty; repeated rows share a shard and have slots of their own; an empty
table gives no rows; result columns replace input columns of the same name, and working columns
take names that the input does not have. Texts are only measured and hashed, so very long ones
cost no more memory than themselves.
"""

from __future__ import annotations

import bisect
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brontide.llm.common import free_names, text_of, written

#: Bytes that a row counts besides its text.
ROW_BYTES = 16
#: Hash bits that the first sums and each further split look at.
FIRST_BITS, MORE_BITS = 14, 6
#: Ranges that are split in one step, so that a step brings back at most these times 2 ** MORE_BITS.
SPLITS = 4096


@dataclass(order=True, frozen=True)
class Range:
    """Groups whose shifted hash lies in [low, low + 2 ** (64 - bits)): bytes and number."""

    low: int
    bits: int
    size: int
    groups: int


def _hash(text):
    """The order of groups, as an unsigned number in a decimal-free way: the sign bit is turned."""
    return F.xxhash64(text)


def _prefix(bits: int):
    """The first bits of a hash, counted so that order stays: signed shift, then moved up."""
    return F.shiftright("hash", 64 - bits) + (1 << (bits - 1))


def _sums(groups: DataFrame, bits: int, parents: list[Range] | None = None) -> list[Range]:
    if parents:
        spark = groups.sparkSession
        own = spark.createDataFrame([(p.low >> (64 - p.bits), p.bits) for p in parents], "at long, b int")
        found = []
        for b in sorted({p.bits for p in parents}):
            more = min(64, b + MORE_BITS)
            # At most SPLITS rows are broadcast.
            part = groups.withColumn("at", _prefix(b)).join(F.broadcast(own.where(F.col("b") == b)), "at", "left_semi")
            found += _sums(part, more)
        return found
    at = _prefix(bits) if bits < 64 else F.col("hash")
    rows = groups.groupBy(at.alias("at")).agg(F.sum("size").alias("size"), F.count("*").alias("groups")).collect()
    base = 0 if bits < 64 else 1 << 63
    return sorted(Range((r["at"] + base) << (64 - bits), bits, r["size"], r["groups"]) for r in rows)


class Plan:
    """Greedy filling over ranges."""

    def __init__(self, ranges: list[Range], shards: int):
        self.ranges, self.shards = ranges, shards
        self.ends = []
        total = 0
        for r in ranges:
            total += r.size
            self.ends.append(total)
        self.total = total

    def reach(self, start: int, capacity: int, optimist: bool) -> int:
        """How far one shard goes from a place in the bytes."""
        goal = start + capacity
        if goal >= self.total:
            return self.total
        k = bisect.bisect_right(self.ends, goal)
        whole = self.ends[k - 1] if k else 0
        return goal if optimist and self.ranges[k].groups > 1 else whole

    def places(self, capacity: int, optimist: bool) -> list[int]:
        out = [0]
        for _ in range(self.shards):
            out.append(max(out[-1], self.reach(out[-1], capacity, optimist)))
        return out

    def smallest(self, optimist: bool) -> int:
        low, high = 0, self.total
        while low < high:
            mid = (low + high) // 2
            if self.places(mid, optimist)[-1] >= self.total:
                high = mid
            else:
                low = mid + 1
        return low

    def open(self, low: int, high: int) -> list[int]:
        """Ranges of several groups where some shard may end at a capacity from low to high."""
        found: set[int] = set()
        for a, b in zip(self.places(low, False)[1:], self.places(high, True)[1:], strict=True):
            first, last = bisect.bisect_right(self.ends, min(a, b)), bisect.bisect_left(self.ends, max(a, b))
            found.update(k for k in range(first, min(last + 1, len(self.ranges))) if self.ranges[k].groups > 1)
        return sorted(found)

    def cuts(self, capacity: int) -> list[int]:
        """First range of each shard but the first. Each shard takes its even part of what is
        left where the capacity and the shards behind allow it, so that the last are not empty."""
        # The latest place that the shards from k on can still start at: filled from the back.
        earliest = [self.total]
        for _ in range(self.shards):
            need = earliest[-1] - capacity
            k = bisect.bisect_left(self.ends, need) if need > 0 else -1
            earliest.append(self.ends[k] if need > 0 else 0)
        earliest = earliest[::-1]  # earliest[k]: shards k.. can take all bytes behind it
        out, start = [], 0
        for k in range(1, self.shards):
            goal = start + (self.total - start) / (self.shards - k + 1)
            most = self.reach(start, capacity, False)
            at = bisect.bisect_left(self.ends, goal)
            above = self.ends[min(at, len(self.ends) - 1)] if self.ends else 0
            below = self.ends[at - 1] if at else 0
            near = above if above - goal <= goal - below else below
            start = min(most, max(start, earliest[k], near))
            out.append(bisect.bisect_right(self.ends, start))
        return out


def plan_shards(groups: DataFrame, shards: int) -> tuple[int, list[int]]:
    """The smallest capacity and, for each shard but the first, the hash it starts at (shifted
    to be unsigned). groups: hash and size of each group."""
    ranges = _sums(groups, FIRST_BITS)
    while True:
        plan = Plan(ranges, shards)
        low, high = plan.smallest(True), plan.smallest(False)
        split = plan.open(low, high) if low < high else []
        if not split:
            cuts = [ranges[k].low if k < len(ranges) else 1 << 64 for k in plan.cuts(high)]
            return high, cuts
        chosen = set(split[:SPLITS])
        finer = _sums(groups, 0, [ranges[k] for k in sorted(chosen)])
        ranges = sorted([r for k, r in enumerate(ranges) if k not in chosen] + finer)


def shard(docs: DataFrame, shards: int = 40, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """docs (or only the columns keep of them) with size, text_crc32, shard and slot."""
    text = text_of(text_col)
    new = ("size", "text_crc32", "shard", "slot")
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in new]
    hashed, spread, part, place, first, offset = free_names(docs.select(*keep, *(F.lit(0).alias(n) for n in new)), "hash", "spread", "part", "place", "first", "offset")
    rows = docs.select(*keep, (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), _hash(text).alias(hashed))
    rows = written(rows, "rows")
    groups = rows.groupBy(F.col(hashed).alias("hash")).agg(F.sum("size").alias("size"))
    _, cuts = plan_shards(written(groups, "groups"), shards)
    starts = [c - (1 << 63) for c in cuts if c < 1 << 64]
    number = sum((F.when(F.col(hashed) >= F.lit(s), 1).otherwise(0) for s in starts), F.lit(0))
    # Skipped shards (of equal starts) are counted too, so shard k is what lies before start k + 1.
    dealt = rows.withColumn("shard", number.cast("int"))
    # Order by shard over many tasks, with the rows of large groups spread; then a row's slot is
    # its place in its task's part of the shard plus the rows of the parts before.
    dealt = dealt.withColumn(spread, F.xxhash64(hashed, F.monotonically_increasing_id())).repartitionByRange("shard", spread).sortWithinPartitions("shard", spread)
    at = F.monotonically_increasing_id()
    dealt = written(dealt.withColumns({part: F.shiftright(at, 33), place: at.bitwiseAND((1 << 33) - 1)}), "dealt")
    parts = dealt.groupBy("shard", part).agg(F.min(place).alias(first), F.count("*").alias("n")).collect()
    # One row per task and shard: no more than tasks plus shards.
    before: dict[int, int] = {}
    offsets = []
    for p in sorted(parts):
        offsets.append((p["shard"], p[part], before.get(p["shard"], 0) - p[first]))
        before[p["shard"]] = before.get(p["shard"], 0) + p["n"]
    given = docs.sparkSession.createDataFrame(offsets, f"shard int, `{part}` long, `{offset}` long")
    out = dealt.join(F.broadcast(given), ["shard", part])
    return out.withColumn("slot", F.col(place) + F.col(offset)).drop(hashed, spread, part, place, offset)
