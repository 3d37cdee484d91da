"""Near-duplicates by MinHash with tensored banding, confirmed on full shingle sets.

Two collections of `collection` short tuples of minhashes are made for each distinct shingle
set. A table key is a pair (left tuple, right tuple), so collection ** 2 tables need only
2 * collection * rows minhashes. Tuples that nobody shares are dropped before pairs are made.
Two sets at similarity s meet in some table with probability 1 - 2 * (1 - s ** rows) ** collection
at least; with the production values that leaves out 2e-5 at s = 0.85 and less above.

Inside a bucket no pairs are listed, so what is written grows with the members. A first round
compares every member with one centre, the member with most links so far, and merges components;
buckets of one component are done. The others are compared in full inside a task, by one byte of
each minhash, if they have up to SMALL members, and give the pairs that may be similar. Where
these would be more than DENSE times the members, the task gets the members' sets instead, counts
all intersections as a product of matrices, and gives links that join components, fewer than members.
Such buckets of different tables have most members in common, so those of one centre are compared
as one, with each member once, where that costs less than bucket by bucket.
Larger buckets are keyed again by further minhashes of each of their two families, as many as their
size asks for, and as many times as leave out LOST of the pairs at the threshold. What is large
even then (sets that are nearly, but not quite, similar) is dealt in blocks, and the sets of
every block are compared with those of every other.
So besides the tables' 2e-5, only LOST of the pairs inside large buckets can be missed. Pairs of
fewer equal bytes than six standard deviations below the threshold allow (a chance of about 1e-7)
are not compared further.

Defined results: a null or wordless text has the empty set and is linked with nothing; fewer
words than a shingle form one shingle; equal sets are one node, whatever their number; rows of
one doc_id with several texts are several nodes; a null doc_id is linked with nothing, has a
null component_id and is kept; repeated rows get equal results; empty tables give no rows;
result columns replace input columns of the same name. Equality of shingles and sets is that
of their 64 and 128 bit hashes. A very long text costs memory for its words and hashes, one
text at a time. What is written on the way is deleted; only the narrow result stays.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brontide.llm.common import Scratch, release, text_of, written

#: Word hashes that a worker process keeps; it starts again when full.
MEMO_ENTRIES = 60_000
#: Buckets of at most so many nodes are compared in full by one task.
SMALL = 2000
#: Likely pairs for each member beyond which sets are compared where they are; shingles of the sets
#: and sets of each of two blocks that one task compares then; columns of a product of matrices.
DENSE, DENSE_SHINGLES, DENSE_SETS, COLUMNS = 4, 1 << 21, 2000, 4096
#: Pairs of sets that cost about as much as a set that is moved to a task.
PAIRS_A_SET = 100
#: Other dense buckets are dealt by hash into as many parts as the last number says; a turn takes those
#: from one number to the next.
DENSE_TURNS = (0, 1, 6, 32)
#: Share of the pairs at the threshold that keying a large bucket again may leave out; similarity of
#: the members that it is to bring down to SMALL; the most minhashes of a family, and keys, for that.
LOST, LEAVES, FURTHER, REPEATS = 1e-4, 0.8, 24, 64
#: Rows that Python workers get at once: texts, and pairs of sets.
TEXT_ROWS, PAIR_ROWS = 1000, 200
#: Up to so many ids of candidate documents are broadcast to the scan that makes their sets, and
#: up to so many digests with their component to the rows; beyond it rows are joined by salt.
BROADCAST_IDS = 500_000
SALTS = 32

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SIGNATURE = T.StructType().add("n_shingles", "long").add("digest", "binary").add("left", T.ArrayType(T.LongType())).add("right", T.ArrayType(T.LongType())).add("sketch", "binary")
_SIGNATURE_ARROW = pa.struct([("n_shingles", pa.int64()), ("digest", pa.binary()), ("left", pa.list_(pa.int64())), ("right", pa.list_(pa.int64())), ("sketch", pa.binary())])
_WORDS: dict[bytes, int] = {}


@dataclass(frozen=True)
class Params:
    """share: least intersection per union, in hundredths."""

    shingle: int = 3
    share: int = 85
    rows: int = 3
    collection: int = 12
    seed: int = 20_261


def _mixed(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(64)
def _odd(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**64, n, dtype=np.uint64) | np.uint64(1)


def shingle_set(text: str, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles."""
    words = text.encode("utf-8", "replace").translate(_LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    if len(_WORDS) > MEMO_ENTRIES:
        _WORDS.clear()
    memo, hashed = _WORDS, []
    for w in words:
        h = memo.get(w)
        if h is None:
            h = memo[w] = xxhash.xxh64_intdigest(w)
        hashed.append(h)
    h = np.array(hashed, np.uint64)
    n = min(size, len(h))
    factors = _odd(size, 7)
    total = np.full(len(h) - n + 1, n, np.uint64)
    for i in range(n):
        total = _mixed(total * factors[i] + h[i : len(h) - n + 1 + i])
    return np.unique(total)


def minhashes(hashes: np.ndarray, n: int, seed: int) -> np.ndarray:
    factors, terms = _odd(n, seed)[:, None], _odd(n, seed + 1)[:, None]
    out = np.full(n, 2**64 - 1, np.uint64)
    for at in range(0, len(hashes), 4096):
        np.minimum(out, (hashes[None, at : at + 4096] * factors + terms).min(axis=1), out=out)
    return out


def signature(text: str, p: Params) -> dict | None:
    found = shingle_set(text, p.shingle)
    if not len(found):
        return {"n_shingles": 0, "digest": None, "left": None, "right": None, "sketch": None}
    low = minhashes(found, 2 * p.collection * p.rows, p.seed).reshape(2 * p.collection, p.rows)
    keys = np.arange(1, 2 * p.collection + 1, dtype=np.uint64)
    for i in range(p.rows):
        keys = _mixed(keys * np.uint64(0x9E3779B97F4A7C15) + low[:, i])
    keys = keys.view(np.int64)
    return {"n_shingles": len(found), "digest": xxhash.xxh3_128_digest(found.tobytes()), "left": keys[: p.collection], "right": keys[p.collection :], "sketch": low.astype(np.uint8).tobytes()}


def _signatures(p: Params):
    @F.arrow_udf(_SIGNATURE)
    def signed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([signature(t.as_py(), p) for t in texts], _SIGNATURE_ARROW)
        release(_WORDS)

    return signed


def _sets(size: int):
    """The set of a text, if it is that of the given digest. As it takes both, no filter on it
    can move below the join that brings them together."""

    @F.arrow_udf(T.BinaryType())
    def made(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, digests in batches:
            sets = ((shingle_set(t.as_py(), size).tobytes(), d.as_py()) for t, d in zip(texts, digests, strict=True))
            yield pa.array([x if xxhash.xxh3_128_digest(x) == d else None for x, d in sets], pa.binary())
        release(_WORDS)

    return made


def similar(a: bytes, b: bytes, share: int) -> bool:
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    both = np.concatenate((x, y))
    both.sort(kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= share * (len(both) - common)


def _confirmed(share: int):
    @F.arrow_udf(T.BooleanType())
    def confirmed(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for a, b in batches:
            yield pa.array([similar(x.as_py(), y.as_py(), share) for x, y in zip(a, b, strict=True)], pa.bool_())
        release()

    return confirmed


def _least(p: Params) -> float:
    """Equal bytes of two sketches that sets at the threshold have, but for a chance of 1e-7."""
    n, share = 2 * p.collection * p.rows, p.share / 100
    return n * (share - 6 * (share * (1 - share) / n) ** 0.5)


def _likely(p: Params):
    n, least = 2 * p.collection * p.rows, _least(p)

    @F.arrow_udf(T.BooleanType())
    def likely(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for a, b in batches:
            x, y = (np.frombuffer(b"".join(s.to_pylist()), np.uint8).reshape(-1, n) for s in (a, b))
            yield pa.array((x == y).sum(axis=1) >= least, pa.bool_())

    return likely


def components(links: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """(node, comp) of all nodes in links (a, b): comp is the smallest node that can be reached.

    Labels take the smallest label next to them and then that label's own label; both steps
    are joins and aggregates of narrow rows, written each time.
    """
    scratch = scratch or Scratch(links.sparkSession)
    both = scratch.written(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = scratch.written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("comp")), "labels")
    while True:
        near = both.join(labels, both.b == labels.node).groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near"))
        step = labels.join(near, "node").select("node", "comp", F.least("comp", "near").alias("next"))
        up = labels.select(F.col("node").alias("next"), F.col("comp").alias("up"))
        moved = scratch.written(step.join(up, "next", "left").select("node", F.least("next", F.coalesce("up", "next")).alias("comp"), (F.col("comp") > F.least("next", F.coalesce("up", "next"))).alias("moved")), "labels")
        scratch.drop(labels)
        labels = moved
        if moved.where("moved").isEmpty():
            scratch.drop(both)
            return labels


def _shared_keys(nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """(key, nid, i, j) of the tensored tables i, j, without keys of one node."""

    def shared(side: str, place: str) -> DataFrame:
        each = nodes.select("nid", F.posexplode(side).alias(place, "h"))
        often = each.groupBy("h").count().where("count > 1").select("h")
        return each.join(often, "h", "left_semi").groupBy("nid").agg(F.collect_list(F.struct(place, "h")).alias(side))

    pairs = shared("left", "i").join(shared("right", "j"), "nid")
    keys = pairs.select("nid", F.explode("left").alias("l"), "right").select("nid", "l", F.explode("right").alias("r"))
    keys = scratch.written(keys.select(F.xxhash64("l.h", "r.h").alias("key"), "nid", F.col("l.i").cast("byte").alias("i"), F.col("r.j").cast("byte").alias("j")), "keys")
    often = keys.groupBy("key").count().where("count > 1").select("key")
    shared_keys = scratch.written(keys.join(often, "key", "left_semi"), "shared")
    scratch.drop(keys)
    return shared_keys


def _candidate_sets(docs: DataFrame, nodes: DataFrame, keys: DataFrame, text_col: str, id_col: str, size: int, scratch: Scratch) -> DataFrame:
    """(nid, n, hashes) of the nodes in keys, made from one document of each."""
    wanted = scratch.written(keys.select("nid").distinct().join(nodes.select("nid", "digest", "n", "rep"), "nid"), "wanted")
    texts = docs.select(F.col(id_col).alias("rep"), text_of(text_col).alias("text"))
    texts = texts.join(F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted, "rep")
    # A rep can have several rows; only those of the node's own text count, and one of them is enough.
    made = texts.select("nid", "n", _sets(size)("text", "digest").alias("hashes")).where("hashes IS NOT NULL")
    sets = scratch.written(made.dropDuplicates(["nid"]), "sets", PAIR_ROWS)
    scratch.drop(wanted)
    return sets


def set_digests(size: int, col: str):
    """The digest of each text's set, as near_duplicates_by_set gives it; null for a wordless text."""

    @F.arrow_udf(T.BinaryType())
    def digests(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            sets = (shingle_set(t.as_py(), size) for t in texts)
            yield pa.array([xxhash.xxh3_128_digest(x.tobytes()) if len(x) else None for x in sets], pa.binary())
        release(_WORDS)

    return digests(text_of(col))


def _sides(p: Params, depth: int, share: float) -> float:
    """Chance that two sets of a similarity share a left, or a right, tuple and depth further minhashes of its family."""
    return 1 - (1 - share ** (p.rows + depth)) ** p.collection


def repeats(p: Params, depth: int) -> int:
    """How often keys of so many further minhashes are made, to leave out LOST of the pairs at the threshold."""
    met = _sides(p, depth, p.share / 100) ** 2
    return min(REPEATS, max(1, math.ceil(math.log(LOST) / math.log(max(1 - met, 1e-12)))))


def further_keys(hashes: np.ndarray, tables: list[dict], p: Params) -> np.ndarray:
    """For each table entry (key, i, j, depth), repeats(depth) keys that also hold depth further
    minhashes of left family i and of right family j."""
    out = []
    deepest = max(t["depth"] for t in tables)
    for r in range(max(repeats(p, t["depth"]) for t in tables)):
        low = minhashes(hashes, 2 * p.collection * deepest, p.seed + 1000 * (r + 1)).reshape(2 * p.collection, deepest)
        so_far = np.empty_like(low)
        so_far[:, 0] = _mixed(low[:, 0])
        for d in range(1, deepest):
            so_far[:, d] = _mixed(so_far[:, d - 1] * np.uint64(0x9E3779B97F4A7C15) + low[:, d])
        own = [t for t in tables if r < repeats(p, t["depth"])]
        old, i, j, depth = (np.array([t[k] for t in own], np.int64) for k in ("key", "i", "j", "depth"))
        left, right = so_far[i, depth - 1], so_far[p.collection + j, depth - 1]
        out.append(_mixed(_mixed(old.view(np.uint64) + np.uint64(r) + left) * np.uint64(0x9E3779B97F4A7C15) + right))
    return np.concatenate(out).view(np.int64)


def _further(p: Params):
    @F.arrow_udf(T.ArrayType(T.LongType()))
    def further(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for sets, tables in batches:
            yield pa.array([further_keys(np.frombuffer(h.as_py(), np.uint64), t.as_py(), p) for h, t in zip(sets, tables, strict=True)], pa.list_(pa.int64()))
        release()

    return further


def likely_pairs(members: list[dict], p: Params) -> dict:
    """Pairs of members (nid, comp, n, sketch) of different components whose sizes and sketches
    allow the threshold, or only that they are too many."""
    found, most = [], DENSE * len(members)
    sketches = np.frombuffer(b"".join(m["sketch"] for m in members), np.uint8).reshape(len(members), -1)
    comp, size, nid = (np.array([m[k] for m in members], np.int64) for k in ("comp", "n", "nid"))
    least = _least(p)
    for k in range(len(members) - 1):
        rest = slice(k + 1, None)
        fit = (comp[rest] != comp[k]) & (np.minimum(size[rest], size[k]) * 100 >= np.maximum(size[rest], size[k]) * p.share)
        at = np.flatnonzero(fit) + k + 1
        if len(at):
            at = at[(sketches[at] == sketches[k]).sum(axis=1) >= least]
            found += [{"a": int(nid[k]), "b": b} for b in nid[at].tolist()]
        if len(found) > most:
            return {"pairs": [], "dense": True}
    return {"pairs": found, "dense": False}


_PAIRS = T.ArrayType(T.StructType().add("a", "long").add("b", "long"))
_PAIRS_ARROW = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))


def _likely_pairs(p: Params):
    @F.arrow_udf(T.StructType().add("pairs", _PAIRS).add("dense", "boolean"))
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for groups in batches:
            yield pa.array([likely_pairs(g.as_py(), p) for g in groups], pa.struct([("pairs", _PAIRS_ARROW), ("dense", pa.bool_())]))
        release()

    return found


def joining_links(members: list[dict], share: int) -> list[dict]:
    """Of the similar pairs of members (nid, comp, side, hashes) as many as it takes to join all
    components that such pairs join. Sides 1 and 2 meet only the other side."""
    sets = [np.frombuffer(m["hashes"], np.uint64) for m in members]
    size = np.array([len(x) for x in sets])
    owner = np.repeat(np.arange(len(sets)), size)
    _, column, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    # Only shingles of two sets can be common; they get columns without gaps.
    number = np.cumsum(counts > 1) - 1
    kept = counts[column] > 1
    owner, column = owner[kept], number[column[kept]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common = np.zeros((len(sets), len(sets)), np.float32)
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        own = slice(*np.searchsorted(column, (first, first + COLUMNS)))
        part = np.zeros((len(sets), COLUMNS), np.float32)
        part[owner[own], column[own] - first] = 1
        common += part @ part.T
    root = {m["comp"]: m["comp"] for m in members}

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    side = np.array([m["side"] for m in members])
    links = []
    for k in range(len(sets) - 1):
        rest = common[k, k + 1 :]
        near = (100 * rest >= share * (size[k] + size[k + 1 :] - rest)) & ((side[k] == 0) | (side[k + 1 :] != side[k]))
        for other in (np.flatnonzero(near) + k + 1).tolist():
            one, two = top(members[k]["comp"]), top(members[other]["comp"])
            if one != two:
                root[one] = two
                links.append({"a": members[k]["nid"], "b": members[other]["nid"]})
    return links


def _joining_links(share: int):
    @F.arrow_udf(_PAIRS)
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for groups in batches:
            yield pa.array([joining_links(g.as_py(), share) for g in groups], _PAIRS_ARROW)
        release()

    return found


def _blocks():
    """Blocks of a group's sets, such that a task can hold two."""
    return F.greatest(F.ceil(F.sum("n") / DENSE_SHINGLES), F.ceil(F.count("*") / DENSE_SETS)).cast("int").alias("count")


class _Merger:
    """The links found so far and the components they make, round by round."""

    def __init__(self, nodes: DataFrame, sets: DataFrame, p: Params, scratch: Scratch):
        self.sizes, self.sketches = nodes.select("nid", "n"), nodes.select("nid", "sketch")
        self.sets, self.p, self.scratch = sets, p, scratch
        self.links: DataFrame | None = None
        self.comps: DataFrame | None = None  # node, comp, degree

    def open_buckets(self, keys: DataFrame) -> DataFrame:
        """Members of the buckets of several components, with the number of members and the
        centre: the member with most links so far is the likeliest."""
        if self.comps is None:
            now = keys.withColumns({"comp": F.col("nid"), "degree": F.lit(0).cast("long")})
        else:
            now = keys.join(self.comps.withColumnRenamed("node", "nid"), "nid", "left")
            now = now.withColumns({"comp": F.coalesce("comp", "nid"), "degree": F.coalesce("degree", F.lit(0).cast("long"))})
        centre = F.max(F.struct("degree", F.xxhash64("nid"), "nid", "comp")).alias("mid")
        about = now.groupBy("key").agg(F.count("*").alias("members"), F.min("comp").alias("lo"), F.max("comp").alias("hi"), centre)
        about = about.where("lo <> hi").select("key", "members", F.col("mid.nid").alias("mid"), F.col("mid.comp").alias("mid_comp"))
        return self.scratch.written(now.join(about, "key"), "buckets")

    def stars(self, keys: DataFrame) -> DataFrame:
        """Compares the members of every open bucket with its centre; the members of those that need more."""
        left = self.open_buckets(keys)
        self.confirm(left.where("comp <> mid_comp").select(F.col("mid").alias("a"), F.col("nid").alias("b")))
        rest = self.scratch.written(left.where("members > 2").select(keys.columns), "rest")
        self.scratch.drop(left)
        return rest

    def groups(self, keys: DataFrame) -> DataFrame:
        """Compares all members of open buckets of up to SMALL; the larger buckets."""
        left = self.open_buckets(keys)
        own = left.where(F.col("members") <= SMALL).select("key", "nid", "comp")
        about = self.sizes.join(self.sketches, "nid")
        listed = own.join(about, "nid").groupBy("key").agg(F.collect_list(F.struct("nid", "comp", "n", "sketch")).alias("members"))
        found = self.scratch.written(listed.select("key", _likely_pairs(self.p)("members").alias("j")).select("key", "j.pairs", "j.dense"), "pairs", PAIR_ROWS)
        self.confirm(found.select(F.inline("pairs")))
        dense = found.where("dense").select("key")
        if not dense.isEmpty():
            self.by_parts(own.join(dense, "key", "left_semi").select("key", "nid"))
        rest = self.scratch.written(left.where(F.col("members") > SMALL), "rest")
        self.scratch.drop(left, found)
        return rest

    def by_parts(self, members: DataFrame) -> None:
        """Compares the sets of dense buckets (key, nid): those of one centre as one where that is
        less, and some of the others first, as what these join needs no second comparison."""
        members = self.by_centres(members)
        if members.isEmpty():
            self.scratch.drop(members)
            return
        rest, members = members, self.scratch.written(members.withColumn("turn", F.pmod(F.xxhash64("key", F.lit(5)), F.lit(DENSE_TURNS[-1]))), "dense")
        self.scratch.drop(rest)
        for first, end in zip(DENSE_TURNS, DENSE_TURNS[1:], strict=False):
            again = self.open_buckets(members.where(F.col("turn").between(first, end - 1)).select("key", "nid"))
            if not again.isEmpty():
                self.sets_of(again)
            self.scratch.drop(again)
        self.scratch.drop(members)

    def by_centres(self, members: DataFrame) -> DataFrame:
        """Compares all members of the open buckets that share a centre, each once, where this costs
        no more than the buckets would; the members of the other open buckets."""
        left = self.open_buckets(members)
        apart = left.groupBy("mid").agg(F.count("*").alias("rows"), F.sum("members").alias("pairs"))
        each = self.scratch.written(left.select("mid", "nid", "comp").distinct(), "centres")
        together = each.join(self.sizes, "nid").groupBy("mid").agg(F.count("*").alias("sets"), _blocks())
        less = F.expr(f"sets * count + sets * sets / {PAIRS_A_SET} <= rows + pairs / {PAIRS_A_SET}")
        fewer = self.scratch.written(together.join(apart, "mid").where(less).select("mid"), "fewer")
        if not fewer.isEmpty():
            self.sets_of(each.join(fewer, "mid", "left_semi").withColumnRenamed("mid", "key"))
        rest = self.scratch.written(left.join(fewer, "mid", "left_anti").select("key", "nid"), "rest")
        self.scratch.drop(left, each, fewer)
        return rest

    def sets_of(self, buckets: DataFrame) -> None:
        """Compares the sets of all members (key, nid, comp), in blocks that a task can hold."""
        rows = buckets.select("key", "nid", "comp").join(self.sizes, "nid")
        count = rows.groupBy("key").agg(_blocks())
        rows = rows.join(count, "key").withColumn("block", F.pmod(F.xxhash64("nid"), F.col("count")).cast("int"))
        rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("count") - 1)))
        side = F.when(F.col("block") == F.col("other"), 0).when(F.col("block") < F.col("other"), 1).otherwise(2)
        rows = rows.select("key", "nid", "comp", side.alias("side"), F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"))
        listed = rows.join(self.sets.select("nid", "hashes"), "nid").groupBy("key", "one", "two").agg(F.collect_list(F.struct("nid", "comp", "side", "hashes")).alias("members"))
        self.add(self.scratch.written(listed.select(F.inline(_joining_links(self.p.share)("members"))).distinct(), "found", 2))

    def confirm(self, pairs: DataFrame) -> None:
        """Adds the similar ones of the pairs to the links, and merges their components."""
        share = self.p.share
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        for s in "ab":
            own = self.sizes.join(self.sketches, "nid").select(F.col("nid").alias(s), F.col("n").alias(f"{s}_n"), F.col("sketch").alias(f"{s}_sketch"))
            pairs = pairs.join(own, s)
        # Of sets whose sizes differ by more, even one inside the other is too far.
        pairs = pairs.where(F.least("a_n", "b_n") * 100 >= F.greatest("a_n", "b_n") * share)
        likely = self.scratch.written(pairs.where(_likely(self.p)("a_sketch", "b_sketch")).select("a", "b"), "likely")
        a, b = (self.sets.select(F.col("nid").alias(s), F.col("hashes").alias(f"{s}_hashes")) for s in "ab")
        found = self.scratch.written(likely.join(a, "a").join(b, "b").where(_confirmed(share)("a_hashes", "b_hashes")).select("a", "b"), "found", PAIR_ROWS)
        self.scratch.drop(likely)
        self.add(found)

    def add(self, found: DataFrame) -> None:
        """Adds links, and merges the components that they join."""
        if found.isEmpty():
            return
        self.links = found if self.links is None else self.links.unionByName(found)
        known = found if self.comps is None else found.union(self.comps.where("node <> comp").select("node", "comp"))
        merged = components(known, self.scratch)
        degree = self.links.select("a").union(self.links.select("b")).groupBy(F.col("a").alias("node")).agg(F.count("*").alias("degree"))
        comps = self.scratch.written(merged.join(degree, "node").select("node", "comp", "degree"), "comps")
        self.scratch.drop(merged, self.comps)
        self.comps = comps

    def further(self, buckets: DataFrame) -> DataFrame:
        """(key, nid) of open buckets by further minhashes, as many as bring sets of similarity
        LEAVES down to SMALL."""
        depth = F.ceil(F.log(F.col("members") / SMALL) / F.lit(-2 * math.log(LEAVES)))
        tables = buckets.groupBy("nid").agg(F.collect_list(F.struct("key", "i", "j", F.least(F.greatest(depth, F.lit(1)), F.lit(FURTHER)).cast("int").alias("depth"))).alias("tables"))
        keyed = tables.join(self.sets, "nid").select("nid", _further(self.p)("hashes", "tables").alias("keys"))
        keys = self.scratch.written(keyed.select("nid", F.explode("keys").alias("key")).select("key", "nid"), "further", PAIR_ROWS)
        # Keys of one node are no bucket.
        often = keys.groupBy("key").count().where("count > 1").select("key")
        shared = self.scratch.written(keys.join(often, "key", "left_semi"), "shared")
        self.scratch.drop(keys)
        return shared


def _merged(keys: DataFrame, nodes: DataFrame, sets: DataFrame, p: Params, scratch: Scratch) -> DataFrame | None:
    """(node, comp, degree): the components of the pairs that share a key and are similar."""
    merger = _Merger(nodes, sets, p, scratch)
    rest = merger.stars(keys)
    scratch.drop(keys)
    large = merger.groups(rest)
    scratch.drop(rest)
    if not large.isEmpty():
        again = merger.further(large)
        larger = merger.groups(again)
        scratch.drop(again)
        if not larger.isEmpty():
            merger.sets_of(merger.open_buckets(larger.select("key", "nid")))
    return merger.comps


def near_duplicates(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", params: Params = Params()) -> DataFrame:
    """One row per row of docs: its id, n_shingles, component_id and kept."""
    return near_duplicates_by_set(docs, text_col, id_col, params).select(id_col, "n_shingles", "component_id", "kept")


def near_duplicates_by_set(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", params: Params = Params()) -> DataFrame:
    """near_duplicates with the digest of each row's set, and stays: kept, and of several sets of
    the smallest id in a component that of the smallest digest."""
    scratch = Scratch(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    signed = scratch.written(rows.select("id", _signatures(params)("text").alias("s")).select("id", "s.*"), "signatures", TEXT_ROWS)
    own = signed.where(F.col("digest").isNotNull() & F.col("id").isNotNull())
    nodes = own.groupBy("digest").agg(F.min("id").alias("rep"), F.count("*").alias("copies"), F.first("n_shingles").alias("n"), F.first("left").alias("left"), F.first("right").alias("right"), F.first("sketch").alias("sketch"))
    nodes = scratch.written(nodes.withColumn("nid", F.monotonically_increasing_id()), "nodes")
    keys = _shared_keys(nodes, scratch)
    comps = None
    if not keys.isEmpty():
        sets = _candidate_sets(docs, nodes, keys, text_col, id_col, params.shingle, scratch)
        comps = _merged(keys, nodes, sets, params, scratch)
        scratch.drop(sets)
    # Rows of a set that nothing shares stand for themselves; only the others look up who does.
    rep = nodes.select("nid", "digest", "rep", "copies").withColumn("first", F.lit(True))
    if comps is None:
        rep = rep.where("copies > 1")
    else:
        rep = rep.join(comps.select(F.col("node").alias("nid"), "comp"), "nid", "left").where("copies > 1 OR comp IS NOT NULL")
        lowest = rep.where("comp IS NOT NULL").groupBy("comp").agg(F.min(F.struct("rep", "digest")).alias("lowest"))
        rep = rep.join(lowest, "comp", "left").withColumns({"rep": F.coalesce("lowest.rep", "rep"), "first": F.coalesce(F.col("lowest.digest") == F.col("digest"), F.lit(True))})
    rep = scratch.written(rep.select("digest", "rep", "first"), "representatives")
    out = signed.select("id", "n_shingles", "digest")
    if rep.count() <= BROADCAST_IDS:
        out = out.join(F.broadcast(rep), "digest", "left")
    else:
        # A set may have a third of all rows: they are dealt over salts, and each set's row copied to them.
        salted = rep.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        out = out.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")).join(salted, ["digest", "salt"], "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("rep", "id"))
    kept = component.isNull() | (component == F.col("id"))
    stays = kept & (component.isNull() | F.coalesce("first", F.lit(True)))
    out = written(out.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"), kept.alias("kept"), "digest", stays.alias("stays")), "near-duplicates")
    scratch.clear()
    return out
