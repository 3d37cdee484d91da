"""Benchmark decontamination by one Aho-Corasick automaton.

Every benchmark item becomes windows of 13 consecutive normalised words (an item of fewer
words is one window). Spark makes the distinct windows of the distinct item texts; all of them
form one automaton, which scans each normalised document once. Matches are turned into word
ranges and mapped to code point offsets of the original.

The automaton has to fit in a Python worker, so the windows' bytes are measured before they are
fetched; a benchmark beyond MAX_WINDOW_BYTES (about a hundred million words) is refused, not cut.

Defined results: a null or wordless text has no words, hits or items; an item without words
has no windows; an item without id still hits but is not listed; an empty benchmark hits
nothing; repeated rows each get the same result; result columns replace input columns of the
same name, and working columns take names that the input does not have. Normalisation is
linear, so very long texts need memory in proportion only.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brontide.llm.common import free_names, release, text_of, written

WINDOW = 13
#: Bytes of distinct windows that one automaton may have.
MAX_WINDOW_BYTES = 1 << 30

_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
#: The words in the original text, upper case included.
_ORIGINAL_WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
_RANGES = T.ArrayType(T.StructType().add("start", "integer").add("end", "integer"))
RESULT = T.StructType().add("n_words", "long").add("n_hit", "long").add("item_ids", T.ArrayType(T.StringType())).add("ranges", _RANGES).add("spans", _RANGES)
_ARROW = pa.struct(
    [
        ("n_words", pa.int64()),
        ("n_hit", pa.int64()),
        ("item_ids", pa.list_(pa.string())),
        ("ranges", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
        ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
    ]
)


def words_of(text: str) -> list[bytes]:
    """UTF-8 words after lower-casing A-Z."""
    return text.encode("utf-8", "replace").translate(_TABLE).split()


def windows_of(text: str, size: int = WINDOW) -> dict[str, int]:
    """Padded windows of one item text with their words. Bytes are kept as Latin-1."""
    words = words_of(text)
    n = min(size, len(words))
    return {(b" %b " % b" ".join(words[i : i + n])).decode("latin-1"): n for i in range(len(words) - n + 1 if n else 0)}


def _windows(size: int):
    @F.arrow_udf(T.ArrayType(T.StructType().add("key", "string").add("n", "integer")))
    def made(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("key", pa.string()), ("n", pa.int32())]))
        for texts in batches:
            yield pa.array([[{"key": k, "n": n} for k, n in windows_of(t.as_py(), size).items()] for t in texts], kind)
        release()

    return made


def benchmark_windows(benchmark: DataFrame, item_id_col: str, item_text_col: str, size: int, most_bytes: int) -> tuple[dict, list[list[str]]]:
    """(window -> (its words, numbers of the texts that have it), ids of each text). Equal items
    are one text; the result is measured before it is fetched."""
    items = benchmark.select(F.col(item_id_col).cast("string").alias("id"), F.coalesce(F.col(item_text_col).cast("string"), F.lit("")).alias("text"))
    texts = items.groupBy("text").agg(F.array_sort(F.collect_set("id")).alias("ids"))
    texts = written(texts.withColumn("text_no", F.monotonically_increasing_id()), "benchmark")
    found = texts.select("text_no", F.explode(_windows(size)("text")).alias("w")).groupBy("w.key", "w.n").agg(F.collect_list("text_no").alias("in"))
    found = written(found, "windows")
    measured = found.agg(F.coalesce(F.sum(F.octet_length("key") + 8 * F.size("in")), F.lit(0))).first()[0]
    if measured > most_bytes:
        raise ValueError(f"{measured} bytes of benchmark windows are more than one automaton may have ({most_bytes})")
    ids = {r["text_no"]: r["ids"] for r in texts.select("text_no", "ids").collect()}
    numbers = {k: i for i, k in enumerate(sorted(ids))}
    windows = {r["key"]: (r["n"], [numbers[k] for k in r["in"]]) for r in found.collect()}
    return windows, [ids[k] for k in sorted(ids)]


def automaton_of(windows: dict[str, tuple[int, list[int]]]):
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for key, value in windows.items():
        automaton.add_word(key, value)
    if windows:
        automaton.make_automaton()
    return automaton


def joined_ranges(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching half-open ranges made one."""
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def scan(text: str | None, automaton, ids: list[list[str]]) -> dict:
    """One pass over a text: counts, ids of the items found, hit word ranges and original spans."""
    words = words_of(text or "")
    out = {"n_words": len(words), "n_hit": 0, "item_ids": [], "ranges": [], "spans": []}
    if not words or not len(automaton):
        return out
    hits = list(automaton.iter(f" {b' '.join(words).decode('latin-1')} "))
    if not hits:
        return out
    after = np.cumsum([len(w) + 1 for w in words])  # the place of the space behind each word
    last = np.searchsorted(after, [end for end, _ in hits])
    ranges = joined_ranges([(int(k) - n + 1, int(k) + 1) for k, (_, (n, _)) in zip(last, hits, strict=True)])
    places = [m.span() for m in _ORIGINAL_WORD.finditer(text)]
    out["n_hit"] = sum(b - a for a, b in ranges)
    out["item_ids"] = sorted({i for k in {k for _, (_, own) in hits for k in own} for i in ids[k]})
    out["ranges"] = [{"start": a, "end": b} for a, b in ranges]
    out["spans"] = [{"start": places[a][0], "end": places[b - 1][1]} for a, b in ranges]
    return out


#: The automaton of a worker process for one broadcast value, as building it takes longer than a
#: small task. It stays when a task ends; one of another value takes its place.
_BUILT: dict[int, tuple] = {}


def _scanner(shared):
    def scanned(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        if shared.id not in _BUILT:
            _BUILT.clear()
            windows, ids = shared.value
            _BUILT[shared.id] = automaton_of(windows), ids
        automaton, ids = _BUILT[shared.id]
        for texts in batches:
            yield pa.array([scan(t.as_py(), automaton, ids) for t in texts], _ARROW)
        release()

    return F.arrow_udf(scanned, RESULT)


class _Shared:
    """A broadcast value with an id that outlives pickling."""

    def __init__(self, broadcast):
        self.id, self._broadcast = broadcast._jbroadcast.id(), broadcast

    def __getstate__(self):
        return {"id": self.id, "_broadcast": self._broadcast}

    @property
    def value(self):
        return self._broadcast.value


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    share: int = 20,
    max_window_bytes: int = MAX_WINDOW_BYTES,
) -> DataFrame:
    """docs with n_words, n_hit, n_items, item_ids, ranges, spans and contaminated.

    contaminated: some word is hit and share * n_hit >= n_words.
    """
    value = benchmark_windows(benchmark, item_id_col, item_text_col, window, max_window_bytes)
    shared = _Shared(docs.sparkSession.sparkContext.broadcast(value))
    (name,) = free_names(docs, "found")
    out = docs.withColumn(name, _scanner(shared)(text_of(text_col)))
    found = {k: F.col(name)[k] for k in ("n_words", "n_hit", "item_ids", "ranges", "spans")}
    found["n_items"] = F.size(F.col(name)["item_ids"]).cast("long")
    found["contaminated"] = (F.col(name)["n_hit"] > 0) & (F.col(name)["n_hit"] * share >= F.col(name)["n_words"])
    return out.withColumns(found).drop(name)
