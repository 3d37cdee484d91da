"""Spelling variants: words one insertion, deletion or replacement apart, by a dictionary of pairs of trie nodes.

The nodes of a trie of the dictionary's words, and of one of the reversed words, get integers.
A word of length L has L pairs that skip a position, (node of the prefix before it, node of the
suffix behind it), and L + 1 pairs that meet between two positions. Two words that skip to
the same pair differ by one replacement; where a skipping pair of one equals a meeting pair
of the other, the second is the first without that letter. So equal integer pairs are all near
words and nothing else. One of several equal letters in a row gives the same shorter word;
only the first of a row counts, so no two words are found near twice. A pair belongs to at
most as many words as the alphabet has letters, and one more.

Nodes are numbered where they are met: words with the same HEAD first letters come to one task
in order, so a node below that depth is new if the word before does not share it, and its number
is the task's and a count. Shorter prefixes are their own number, eight bits a letter (all
letters are below U+0100). A task holds the path of one word.

Words are maximal runs of RUN; only A-Z are lower-cased. Defined results: a null text has no
words, a null id counts as empty; a word of fewer than least_length code points or least_count
occurrences is no word, and is nobody's neighbour; ties of a form go to the smallest word in
code-point order; repeated rows count each time; a text without words and an empty table add
nothing; further columns of docs are not read. A text of any length is one counter of its
distinct words at a time, a word of any length a path of as many numbers.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brontide.llm.common import Scratch, release, text_of, written

RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: Distinct words that a task counts before it hands the counts on.
MOST_COUNTED = 300_000
#: Prefixes of so many letters are their own number.
HEAD = 7
#: Rows that Python workers get at once: texts.
TEXT_ROWS = 1000
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_PAIRS = "p long, s long, gap boolean, lead boolean, word string, n long"


def _handed(counts: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])


def word_counts(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", least_length: int = 5, damage: int | None = None) -> DataFrame:
    """(word, n) of all texts. damage: where this number divides the CRC-32 h of `id:run`, the run
    loses its code point h % length, so that a corpus without misspellings has some."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for own_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                runs = Counter(RUN.findall(text.as_py().encode("utf-8", "replace").translate(_LOWER).decode()))
                start = zlib.crc32(f"{own_id}:".encode("utf-8", "replace"))
                for run, n in runs.items():
                    if len(run) < least_length:
                        continue
                    if damage:
                        h = zlib.crc32(run.encode(), start)
                        if not h % damage:
                            at = h % len(run)
                            run = run[:at] + run[at + 1 :]
                            if len(run) < least_length:
                                continue
                    found[run] += n
                if len(found) > MOST_COUNTED:
                    yield _handed(found)
                    found.clear()
        yield _handed(found)
        release(found)

    texts = docs.select(text_of(id_col).alias("id"), text_of(text_col).alias("text"))
    return texts.mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _path(word: str, before: str, nodes: list[int], fresh: Iterator[int]) -> None:
    """Turns nodes, those of all prefixes of the word before, into those of word."""
    shared = 0
    for a, b in zip(word, before, strict=False):
        if a != b:
            break
        shared += 1
    del nodes[shared + 1 :]
    for depth in range(shared + 1, len(word) + 1):
        nodes.append(nodes[-1] << 8 | ord(word[depth - 1]) if depth <= HEAD else next(fresh))


def _fresh() -> Iterator[int]:
    """Numbers that no other task gives, above those of short prefixes."""
    own = 1 << 62 | TaskContext.get().partitionId() << 36
    while True:
        yield own
        own += 1


def _prefix_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    before, nodes, fresh = "", [1], _fresh()
    for batch in batches:
        words, out = batch.column(0).to_pylist(), []
        for word in words:
            _path(word, before, nodes, fresh)
            out.append(nodes.copy())
            before = word
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.int64()))], ["word", "n", "prefixes"])


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The skipping and the meeting pairs of words that come in the order of their reversal."""
    before, nodes, fresh = "", [1], _fresh()
    for batch in batches:
        p, s, gap, lead, words, counts = [], [], [], [], [], []
        for word, n, prefixes in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            back, size = word[::-1], len(word)
            _path(back, before, nodes, fresh)
            before = back
            p += prefixes[:-1]
            s += nodes[-2::-1]
            lead += [i == 0 or word[i] != word[i - 1] for i in range(size)]
            p += prefixes
            s += nodes[::-1]
            lead += [False] * (size + 1)
            gap += [False] * size + [True] * (size + 1)
            words += [word] * (2 * size + 1)
            counts += [n] * (2 * size + 1)
        yield pa.RecordBatch.from_arrays([pa.array(p, pa.int64()), pa.array(s, pa.int64()), pa.array(gap, pa.bool_()), pa.array(lead, pa.bool_()), pa.array(words, pa.string()), pa.array(counts, pa.int64())], ["p", "s", "gap", "lead", "word", "n"])


def near_words(words: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, n_near, best): the number of near words of each of words (word, n) that has any, and
    the one of largest n, as (negated n, word)."""
    forward = words.repartition(F.substring("word", 1, HEAD)).sortWithinPartitions("word")
    # Numbers are good only if all of a task's come from one run of it, so they are written.
    numbered = scratch.written(forward.mapInArrow(_prefix_nodes, "word string, n long, prefixes array<long>"), "prefix-nodes")
    back = numbered.withColumn("back", F.reverse("word")).repartition(F.substring("back", 1, HEAD)).sortWithinPartitions("back").drop("back")
    pairs = scratch.written(back.mapInArrow(_pairs, _PAIRS), "node-pairs")
    # One shuffle: both halves of the aggregate run where equal pairs have come together.
    groups = pairs.repartition("p", "s").groupBy("p", "s").agg(F.collect_list(F.struct("gap", "lead", "n", "word")).alias("own")).where(F.size("own") > 1)

    def near(e):
        return F.filter("own", lambda x: F.when(e["gap"], x["lead"]).when(x["gap"], e["lead"]).otherwise(x["word"] != e["word"]))

    def row(e):
        found = near(e)
        best = F.array_min(F.transform(found, lambda x: F.struct((-x["n"]).alias("less"), x["word"].alias("word"))))
        return F.struct(e["word"].alias("word"), F.size(found).cast("long").alias("n_near"), best.alias("best"))

    each = groups.select(F.inline(F.transform("own", row))).where("n_near > 0")
    return each.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, root) of forms (word, root): the end of the path from each word. Every round doubles
    the steps that a row spans; as the n of forms at least doubles, paths are short."""
    at = forms
    while True:
        up = at.select(F.col("word").alias("root"), F.col("root").alias("up"))
        moved = scratch.written(at.join(up, "root", "left").select("word", F.coalesce("up", "root").alias("root"), F.col("up").isNotNull().alias("moved")), "roots")
        if at is not forms:
            scratch.drop(at)
        at = moved
        if at.where("moved").isEmpty():
            return at.select("word", "root")


def variants(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", least_length: int = 5, least_count: int = 3, ratio: int = 2, damage: int | None = None) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of all words of docs: form is the near word of largest
    n if that is at least ratio times the word's own, root where following forms ends."""
    scratch = Scratch(docs.sparkSession)
    counts = word_counts(docs, text_col, id_col, least_length, damage).where(F.col("n") >= least_count)
    words = scratch.written(counts, "words", TEXT_ROWS)
    near = near_words(words, scratch)
    found = words.join(near, "word", "left").withColumn("strong", -F.col("best.less") >= ratio * F.col("n"))
    found = found.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(F.col("strong"), F.col("best.word")).alias("form"), F.when(F.col("strong"), -F.col("best.less")).alias("form_n"))
    found = scratch.written(found, "forms")
    ends = roots(found.where("form IS NOT NULL").select("word", F.col("form").alias("root")), scratch)
    out = found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
    out = written(out, "variants")
    scratch.clear()
    return out
