"""Removal of repeated byte strings by suffix order and longest-previous-factor arrays.

A start is a place where a string of `length` bytes begins. Only starts that may have a match are
sorted: a start's anchor is the place of the least hash among the GRAM-byte strings inside its
string, which depends on that string alone, so equal strings have equal anchors at equal
distances. Starts of one anchor lie side by side; they are one row, with the anchor's hash and the
hash of all their bytes. An anchor hash met once has no match; one that always comes with the
same bytes is all matches; the bytes of the others, one copy of each, are brought together by
anchor hash.

There the suffixes at all starts are ranked by their first `length` bytes (prefix doubling:
ranks of 8 bytes make those of 16, and so on). In suffix order, with ties by place, a
longest-previous-factor entry reaches `length` exactly if the entry before has the same rank: then that
is the previous smaller position; a next smaller one at that length cannot be left. The entry
behind shows a later copy likewise.

Anchors with more than GROUP different surroundings (the edges of a passage that many documents
hold) would be too much for one task. Their starts are halved by the distance to the anchor, again
and again: starts of one half share the bytes around the anchor that all strings of that half
hold, so they fall into groups by these. Groups alone or all equal are done, small ones are ranked, and
only the halves over a passage's edge are halved further, so rows grow with surroundings, not
with their starts.

keep="first" removes what an earlier document, or the same one further up, already has (documents
in order of id, then of the hash of their text); keep="none" removes all copies. Matches do not
cross rows, and are judged on the input.

Defined results: a null text is empty; a text shorter than `length` keeps all; rows of one id and
one text are copies of each other, and as nothing tells them apart each keeps what the first one
keeps; a null id is an id, before all others; an empty table gives no rows; result columns replace
input columns of the same name. Anchors of very long texts are found PIECE starts at a time, a
text of equal letters has as many rows as starts. Equality of surroundings is that of two 64-bit
hashes together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brontide.llm.common import Scratch, free_names, release, text_of

#: Bytes of the strings whose hashes make anchors; starts of a text that are looked at together.
GRAM, PIECE = 32, 1 << 22
#: Different surroundings of an anchor that one task ranks; bytes that are ranked at once, at least.
GROUP, BLOCK = 2000, 1 << 20
#: Up to so many documents whose bytes are wanted are told to the scan; beyond, texts are shuffled.
BROADCAST_DOCS = 500_000
#: Rows that Python workers get at once: texts, and surroundings.
TEXT_ROWS, CONTENT_ROWS = 500, 2000

_SPAN = T.ArrayType(T.StructType().add("start", "long").add("end", "long"))
_SPAN_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_TOP = np.uint64(0xFFFFFFFFFF000000)
_PLACE = np.uint64(0xFFFFFF)


def _mixed(x: np.ndarray) -> np.ndarray:
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def _words(b: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as a number."""
    x = b.astype(np.uint64)
    for width in (1, 2, 4):
        x = x[:-width] << np.uint64(8 * width) | x[width:]
    return x


def _grams(b: np.ndarray) -> np.ndarray:
    x, width = _mixed(_words(b)), 8
    while width < GRAM:
        x = _mixed(x[:-width] * np.uint64(0xA0761D6478BD642F) + x[width:])
        width *= 2
    return x


def anchors(data: bytes, length: int) -> Iterator[tuple[int, int, int, int]]:
    """(first start, distance from it to the anchor, bytes, anchor hash, hash of the bytes) of the
    starts of each anchor."""
    for begin in range(0, len(data) - length + 1, PIECE):
        piece = data[begin : begin + PIECE + length - 1]
        starts, reach = len(piece) - length + 1, length - GRAM + 1
        hashes = _grams(np.frombuffer(piece, np.uint8))
        least = hashes & _TOP | np.arange(len(hashes), dtype=np.uint64)
        width = 1
        while 2 * width <= reach:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < reach:
            least = np.minimum(least[: width - reach], least[reach - width :])
        at = least[:starts] & _PLACE
        first = np.concatenate(([0], np.flatnonzero(at[1:] != at[:-1]) + 1))
        end = np.concatenate((first[1:], [starts])) + length - 1
        places = at[first].astype(np.int64)
        own = hashes[places].view(np.int64)
        for s, e, p, a in zip(first.tolist(), end.tolist(), places.tolist(), own.tolist(), strict=True):
            yield begin + s, p - s, e - s, a, xxhash.xxh3_64_intdigest(piece[s:e]) - (1 << 63)


def _anchored(length: int):
    def anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, out = [], ([], [], [], [], [])
            for i, text in enumerate(batch.column("text")):
                n = 0
                for found in anchors(text.as_py(), length):
                    for own, x in zip(out, found, strict=True):
                        own.append(x)
                    n += 1
                rows.append(np.full(n, i))
            rows = pa.array(np.concatenate(rows) if rows else [], pa.int64())
            ids = [batch.column(c).take(rows) for c in ("id", "th")]
            yield pa.RecordBatch.from_arrays([*ids, *(pa.array(x, pa.int64()) for x in out)], ["id", "th", "s0", "far", "bytes", "a", "c"])
        release()

    return anchored


def ranks(text: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Of the suffixes at starts, in order of their first `length` bytes; equal ones have equal ranks."""
    width = 8
    rank = np.unique(_words(text), return_inverse=True)[1].astype(np.uint64)
    while 2 * width <= length:
        rank = np.unique(rank[:-width] << np.uint64(32) | rank[width:], return_inverse=True)[1].astype(np.uint64)
        width *= 2
    return np.unique(rank[starts] << np.uint64(32) | rank[starts + length - width], return_inverse=True)[1]


def matches(contents: list[bytes], length: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For the starts of each of contents, which come in the order of their places: whether the same
    string starts in another of them, and whether in an earlier one."""
    text = np.frombuffer(b"".join(contents), np.uint8)
    ends = np.cumsum([len(x) for x in contents])
    counts = np.array([len(x) - length + 1 for x in contents])
    begin = np.concatenate(([0], np.cumsum(counts)))
    starts = np.arange(begin[-1]) + np.repeat(ends - counts - length + 1 - begin[:-1], counts)
    rank = ranks(text, starts, length)
    order = np.argsort(rank, kind="stable")  # the suffix array of the starts
    same = rank[order][1:] == rank[order][:-1]
    previous, following = np.zeros(len(order), bool), np.zeros(len(order), bool)
    previous[order[1:]], following[order[:-1]] = same, same
    for i in range(len(contents)):
        own = slice(begin[i], begin[i + 1])
        yield previous[own] | following[own], previous[own]


def _runs(flags: np.ndarray) -> list[dict]:
    """Runs of true places; end: behind the last."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return [{"start": s, "end": e} for s, e in edges.reshape(-1, 2).tolist()]


def _ranked(length: int):
    def handed(block: list[tuple]) -> pa.RecordBatch:
        block = sorted(block, key=lambda r: (r[2] is not None, r[2], *r[3:5]))
        flags = list(matches([r[5] for r in block], length))
        cells = [[r[0] for r in block], [r[1] for r in block], [_runs(f[0]) for f in flags], [_runs(f[1]) for f in flags]]
        types = [pa.int64(), pa.int64(), _SPAN_ARROW, _SPAN_ARROW]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cells, types, strict=True)], ["g", "c", "other", "earlier"])

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, size = [], 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("g", "c", "id", "th", "s0", "content")), strict=True):
                if size >= BLOCK and row[0] != block[-1][0]:
                    yield handed(block)
                    block, size = [], 0
                block.append(row)
                size += len(row[5])
        if block:
            yield handed(block)
        release()

    return ranked


def halves(content: bytes, far: int, width: int, length: int) -> Iterator[tuple[int, int, int, int, bytes]]:
    """Parts of a content by the distance of their starts to the anchor, which lies far behind the
    first start: part, place in the content, distance of its first start, hash of the bytes that all
    starts of the part have in common, and the part's bytes."""
    starts = len(content) - length + 1
    for part in range((far - starts + 1) // width, far // width + 1):
        near, least = max(part * width, far - starts + 1), part * width
        most = min(least + width - 1, far)
        first = far - most
        common = content[far - least : far + length - min(least + width - 1, length - 1)]
        yield part, first, most, xxhash.xxh3_64_intdigest(common) - (1 << 63), content[first : far - near + length]


def _halved(length: int, width: int):
    def halved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, out = [], [[] for _ in range(6)]
            for i, (g, s0, far, x, content) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("g", "s0", "far", "x", "content")), strict=True)):
                for part, first, most, common, own in halves(content, far, width, length):
                    rows.append(i)
                    group = xxhash.xxh3_64_intdigest(f"{g}:{part}:{common}") - (1 << 63)
                    for cell, value in zip(out, (group, xxhash.xxh3_64_intdigest(own) - (1 << 63), s0 + first, most, x + first, own), strict=True):
                        cell.append(value)
            kept = [batch.column(c).take(pa.array(rows, pa.int64())) for c in ("a", "top", "id", "th")]
            types = [pa.int64()] * 5 + [pa.binary()]
            yield pa.RecordBatch.from_arrays([*kept, *(pa.array(v, t) for v, t in zip(out, types, strict=True))], ["a", "top", "id", "th", "g", "c", "s0", "far", "x", "content"])
        release()

    return halved


@F.arrow_udf(_SPAN)
def _merged(spans: pa.Array) -> pa.Array:
    out = []
    for own in spans.to_pylist():
        merged: list[dict] = []
        for s in sorted(own, key=lambda s: s["start"]):
            if merged and s["start"] <= merged[-1]["end"]:
                merged[-1]["end"] = max(merged[-1]["end"], s["end"])
            else:
                merged.append(s)
        out.append(merged)
    return pa.array(out, _SPAN_ARROW)


@F.arrow_udf(T.BinaryType())
def _kept(texts: pa.Array, spans: pa.Array) -> pa.Array:
    out = []
    for text, own in zip(texts, spans.to_pylist(), strict=True):
        data = text.as_py()
        ends = [0, *(s["end"] for s in own or [])]
        begins = [*(s["start"] for s in own or []), len(data)]
        out.append(b"".join(data[e:s] for e, s in zip(ends, begins, strict=True)))
    return pa.array(out, pa.binary())


def _contents(docs: DataFrame, own: DataFrame, scratch: Scratch) -> DataFrame:
    """own with the bytes of each of its rows (id, th, s0, bytes), cut from the documents."""
    wanted = own.groupBy("id", "th").agg(F.collect_list(F.struct("a", "c", "s0", "far", "bytes", "members")).alias("own"))
    wanted = scratch.written(wanted, "wanted")
    if wanted.count() <= BROADCAST_DOCS:
        ids = wanted.select(F.col("id").alias("i"), F.col("th").alias("t"))
        docs = docs.join(F.broadcast(ids), F.col("id").eqNullSafe(F.col("i")) & (F.col("th") == F.col("t")), "left_semi")
    right = wanted.select(F.col("id").alias("i"), F.col("th").alias("t"), "own")
    found = docs.join(right, F.col("id").eqNullSafe(F.col("i")) & (F.col("th") == F.col("t")))
    cut = F.transform("own", lambda o: F.struct(o["a"].alias("a"), o["c"].alias("c"), o["s0"].alias("s0"), o["far"].alias("far"), o["members"].alias("members"), F.substring(F.col("text"), o["s0"].cast("int") + 1, o["bytes"].cast("int")).alias("content")))
    # Copies of one row give the same bytes again; one is enough.
    return found.select("id", "th", F.inline(cut)).dropDuplicates(["a", "c"])


def _first() -> Column:
    return F.min(F.struct(F.col("id").isNotNull().alias("known"), "id", "th", "s0", "far", "x", "top", "a", "content"))


def _all(n: Column) -> Column:
    return F.array(F.struct(F.lit(0).cast("long").alias("start"), n.alias("end")))


def _shifted(runs: str) -> Column:
    return F.transform(runs, lambda r: F.struct((r["start"] + F.col("x")).alias("start"), (r["end"] + F.col("x")).alias("end")))


def _flags(contents: DataFrame, length: int, scratch: Scratch) -> DataFrame:
    """(a, c, other, earlier): runs of starts whose string is met in other surroundings of the
    anchor, and in earlier ones."""
    kinds = T.StructType().add("g", "long").add("c", "long").add("other", _SPAN).add("earlier", _SPAN)

    def ranked(groups: DataFrame) -> DataFrame:
        few = groups.where(F.col("members") <= GROUP).select("g", "c", "id", "th", "s0", "content")
        return few.repartition("g").sortWithinPartitions("g").mapInArrow(_ranked(length), kinds)

    found = [ranked(contents.withColumn("g", F.col("a"))).select(F.col("g").alias("a"), "c", "other", "earlier")]
    # g: group; c: hash of a part; top: hash of the surroundings it was cut from, where it starts at x.
    many = contents.where(F.col("members") > GROUP).withColumns({"g": F.col("a"), "top": F.col("c"), "x": F.lit(0).cast("long")})
    width = 1 << (length - GRAM).bit_length()
    while width > 1 and not many.isEmpty():
        width //= 2
        fields = [contents.schema["a"], T.StructField("top", T.LongType()), *(contents.schema[c] for c in ("id", "th")), *(T.StructField(c, T.LongType()) for c in ("g", "c", "s0", "far", "x")), contents.schema["content"]]
        parts = scratch.written(many.mapInArrow(_halved(length, width), T.StructType(fields)), "halves", CONTENT_ROWS)
        met = scratch.written(parts.groupBy("g").agg(F.count("*").alias("n")).where("n > 1").select("g"), "met")
        same = parts.join(met, "g", "left_semi").groupBy("g", "c").agg(F.count("*").alias("n"), _first().alias("first"))
        same = scratch.written(same, "equal-parts", CONTENT_ROWS)
        members = same.groupBy("g").agg(F.count("*").alias("members"))
        reps = same.join(members, "g").select("g", "c", "n", "members", "first.id", "first.th", "first.s0", "first.far", "first.x", "first.top", "first.a", "first.content")
        reps = scratch.written(reps, "representatives", CONTENT_ROWS)
        # Equal parts match wholly: all but the first have an earlier copy.
        about = reps.where("n > 1").select("g", "c", F.col("id").alias("i"), F.col("th").alias("t"), F.col("s0").alias("s"))
        copies = parts.select("g", "c", "a", "top", "id", "th", "s0", "x", (F.length("content") - length + 1).cast("long").alias("starts")).join(about, ["g", "c"])
        own = F.col("id").eqNullSafe(F.col("i")) & (F.col("th") == F.col("t")) & (F.col("s0") == F.col("s"))
        copies = copies.select("a", F.col("top").alias("c"), "x", _all(F.col("starts")).alias("other"), F.when(own, F.array().cast(_SPAN)).otherwise(_all(F.col("starts"))).alias("earlier"))
        some = ranked(reps.where("members > 1")).join(reps.select("g", "c", "a", "top", "x"), ["g", "c"]).select("a", F.col("top").alias("c"), "x", "other", "earlier")
        found += [df.select("a", "c", _shifted("other").alias("other"), _shifted("earlier").alias("earlier")) for df in (copies, some)]
        many = reps.where(F.col("members") > GROUP)
    if len(found) == 1:
        return found[0]
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every.groupBy("a", "c").agg(F.flatten(F.collect_list("other")).alias("other"), F.flatten(F.collect_list("earlier")).alias("earlier"))


def repeated_spans(docs: DataFrame, length: int, keep: str, scratch: Scratch) -> DataFrame:
    """(id, th, spans): the bytes to remove of documents (id, th, text) that lose any."""
    starts = T.StructType([docs.schema["id"], *(T.StructField(c, T.LongType()) for c in ("th", "s0", "far", "bytes", "a", "c"))])
    rows = scratch.written(docs.where(F.length("text") >= length).mapInArrow(_anchored(length), starts), "anchors", TEXT_ROWS)
    met = rows.groupBy("a").agg(F.count("*").alias("n"), F.min("c").alias("lo"), F.max("c").alias("hi")).where("n > 1")
    # Written, so that the rows of a hot anchor can be split in the join.
    met = scratch.written(met.select("a", (F.col("lo") != F.col("hi")).alias("mixed")), "met")
    common = scratch.written(rows.join(met, "a"), "common")
    scratch.drop(rows)
    place = F.struct(F.col("id").isNotNull().alias("known"), "id", "th", "s0", "far", "bytes")
    per = common if keep == "first" else common.where("mixed")
    per = scratch.written(per.groupBy("a", "c").agg(F.count("*").alias("n"), F.min(place).alias("first"), F.first("mixed").alias("mixed")), "surroundings")
    members = per.where("mixed").groupBy("a").agg(F.count("*").alias("members"))
    own = per.where("mixed").join(members, "a").select("a", "c", "first.id", "first.th", "first.s0", "first.far", "first.bytes", "members")
    contents = scratch.written(_contents(docs, own, scratch), "contents", CONTENT_ROWS)
    flags = scratch.written(_flags(contents, length, scratch), "flags")
    scratch.drop(contents)
    # Written, so that rows of hot surroundings can be split in the join.
    judged = scratch.written(per.join(flags, ["a", "c"], "left"), "judged")
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), (F.col("bytes") - length + 1).alias("end")))
    runs: Column
    if keep == "first":
        own_first = F.col("first.id").eqNullSafe(F.col("id")) & (F.col("first.th") == F.col("th")) & (F.col("first.s0") == F.col("s0"))
        found = common.drop("mixed").join(judged.select("a", "c", "first", "earlier"), ["a", "c"])
        runs = F.when(own_first, F.col("earlier")).otherwise(whole)
    else:
        found = common.join(judged.select("a", "c", "n", "other"), ["a", "c"], "left")
        runs = F.when(~F.col("mixed") | (F.col("n") > 1), whole).otherwise(F.col("other"))
    spans = found.select("id", "th", "s0", F.inline(runs)).select("id", "th", F.struct((F.col("s0") + F.col("start")).alias("start"), (F.col("s0") + F.col("end") + length - 1).alias("end")).alias("span"))
    return spans.groupBy("id", "th").agg(F.collect_list("span").alias("spans")).select("id", "th", _merged("spans").alias("spans"))


def without_repeats(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", length: int = 200, keep: str = "first") -> tuple[DataFrame, Scratch]:
    """docs with kept (the bytes that stay, in order), spans (start and end of the removed runs) and
    n_bytes; and what it reads, to be cleared when it has been used."""
    if keep not in ("first", "none"):
        raise ValueError(f"keep is first or none, not {keep}")
    if length < GRAM + 8:
        raise ValueError(f"strings of at least {GRAM + 8} bytes can be compared")
    scratch = Scratch(docs.sparkSession)
    docs = docs.drop("kept", "spans", "n_bytes")
    th, right_id, right_th, text = free_names(docs, "th", "i", "t", "bytes")
    data = text_of(text_col).cast("binary")
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(data).alias("th"), data.alias("text"))
    spans = scratch.written(repeated_spans(texts, length, keep, scratch), "repeats")
    right = spans.select(F.col("id").alias(right_id), F.col("th").alias(right_th), "spans")
    left = docs.withColumns({text: data, th: F.xxhash64(data)})
    both = left.join(right, F.col(id_col).eqNullSafe(F.col(right_id)) & (F.col(th) == F.col(right_th)), "left")
    out = both.withColumns({"kept": _kept(text, "spans"), "n_bytes": F.length(text).cast("long"), "spans": F.coalesce("spans", F.array().cast(_SPAN))})
    return out.drop(text, th, right_id, right_th), scratch
