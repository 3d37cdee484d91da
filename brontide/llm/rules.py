"""Quality rules: text statistics and a learned decision list, in Spark expressions only.

Sequential covering: a rule is grown from threshold conditions, one at a time, by the gain
they bring on labelled rows of the growing part, pruned on the other part, and kept if it is
precise there; the rows it covers go, and the next rule is grown. Only label counts by bin
reach the driver: features x bins x 2 labels x 2 parts numbers, whatever the table's size.

Texts are never written on the way: statistics of labelled rows are learned from, and the
result computes those of every row where it is read.

Defined results: a null or wordless text has no words, so it fails the base rule and is not
kept; rows without a label take no part in learning; of several labels of one id the lowest
counts; without labelled rows the list is empty and only the base rule rejects; repeated rows
get equal verdicts; an empty table gives no rows; result columns replace input columns of the
same name, and working columns take names that the input does not have. Windows are sorted by
hash and compared by their words, so a very long text costs time in proportion to n log n and
memory for its words and windows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brontide.llm.common import free_names, text_of, written

WORD = r"[^\x20\x09-\x0D]+"
#: Features that the learned conditions use.
FEATURES = ("symbols_per_char", "upper_per_char", "marks_per_word", "digits_per_char", "dup_line_share", "repeat_share", "chars_per_word", "n_words")
BINS = 16
MAX_RULES = 8
MAX_CONDITIONS = 3
MIN_PRECISION = 0.95
MIN_COVERED = 4
#: Up to so many labelled ids are broadcast to the texts.
BROADCAST_LABELS = 1_000_000


def sorted_windows(words: Column, n: Column) -> Column:
    """Of an array of words: its 3-word windows as (hash, words, place), equal ones side by side."""
    get = lambda i: F.get(words, i)
    each = F.transform(words, lambda w, i: F.struct(F.xxhash64(w, get(i + 1), get(i + 2)).alias("h"), w.alias("a"), get(i + 1).alias("b"), get(i + 2).alias("c"), i.alias("i")))
    return F.when(n >= 4, F.sort_array(F.slice(each, F.lit(1), F.greatest(n - 2, F.lit(0)))))


def text_statistics(df: DataFrame, text_col: str = "text") -> DataFrame:
    """df with the base counts and the features, from whole texts."""
    text = text_of(text_col)
    count = lambda chars: F.regexp_count(text, F.lit(chars)).cast("long")
    words, n, windows, lines, at, n_lines, upper, marks, digits = free_names(df, "words", "n", "windows", "lines", "at", "n_lines", "upper", "marks", "digits")
    out = df.withColumn(words, F.regexp_extract_all(text, F.lit(WORD), F.lit(0)))
    out = out.withColumn(n, F.size(words))
    out = out.withColumns(
        {
            windows: sorted_windows(F.col(words), F.col(n)),
            "word_chars": F.length(F.array_join(words, "")).cast("long"),
            lines: F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD)),
        }
    )
    def same(x: Column, i: Column) -> Column:
        y = F.get(F.col(windows), i)
        return F.coalesce((x["h"] == y["h"]) & (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"]), F.lit(False))

    twice = F.filter(windows, lambda x, i: same(x, i + 1) | same(x, i - 1))
    out = out.withColumn(at, F.sort_array(F.transform(twice, lambda x: x["i"])))
    covered = F.transform(at, lambda x, i: F.coalesce(F.least(F.get(at, i + 1) - x, F.lit(3)), F.lit(3)).cast("long"))
    out = out.withColumns(
        {
            "n_words": F.col(n).cast("long"),
            "n_symbols": count(r"[#*$%&|<>]"),
            "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
            "n_repeat_words": F.coalesce(F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0).cast("long")),
            n_lines: F.size(lines),
            upper: count(r"\p{Lu}"),
            marks: count(r"[!?]"),
            digits: count(r"[0-9]"),
        }
    )
    share = lambda a, b: F.coalesce(F.col(a) / F.nullif(F.col(b), F.lit(0)), F.lit(0.0))
    out = out.withColumns(
        {
            "symbols_per_char": share("n_symbols", "word_chars"),
            "upper_per_char": share(upper, "word_chars"),
            "marks_per_word": share(marks, "n_words"),
            "digits_per_char": share(digits, "word_chars"),
            "dup_line_share": share("n_dup_lines", n_lines),
            "repeat_share": share("n_repeat_words", "n_words"),
            "chars_per_word": share("word_chars", "n_words"),
            "base_failed": (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
        }
    )
    return out.drop(words, n, windows, lines, at, n_lines, upper, marks, digits)


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        return F.col(self.feature) > self.threshold if self.above else F.col(self.feature) <= self.threshold

    def __str__(self):
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


def _all(conditions) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c.column()
    return out


def _gain(p: float, n: float, p0: float, n0: float) -> float:
    """FOIL's gain in bits of a condition that leaves p of p0 and n of n0."""
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else 0.0


def _histograms(rows: DataFrame, cuts: dict[str, list[float]]) -> dict[str, dict[tuple[int, int], int]]:
    """Rows by feature, bin and label; bin i lies above i of the feature's cuts."""
    each = [F.struct(F.lit(f).alias("f"), sum((F.col(f) > c).cast("int") for c in own).alias("b")) for f, own in cuts.items() if own]
    counts = rows.select("bad", F.explode(F.array(*each)).alias("x")).groupBy("x.f", "x.b", "bad").count().collect()
    out: dict[str, dict[tuple[int, int], int]] = {f: {} for f in cuts}
    for r in counts:
        out[r["f"]][r["b"], r["bad"]] = r["count"]
    return out


def learn_rules(labelled: DataFrame) -> list[list[Condition]]:
    """Ordered conjunctions that find bad rows. labelled: the features, bad (0 or 1) and part
    (0: growing, 1: pruning). Every step is one aggregate over all labelled rows."""
    at = [k / BINS for k in range(1, BINS)]
    marks = labelled.agg(*(F.percentile_approx(f, F.array(*map(F.lit, at)), 2000).alias(f) for f in FEATURES), *(F.percentile_approx(F.when(F.col("bad") == 1, F.col(f)), F.array(*map(F.lit, at)), 2000).alias(f"bad_{f}") for f in FEATURES)).first()
    cuts = {f: sorted({x for own in (marks[f], marks[f"bad_{f}"]) for x in own or ()}) for f in FEATURES}
    if not any(cuts.values()):
        return []
    rules: list[list[Condition]] = []
    left = labelled
    while len(rules) < MAX_RULES:
        conditions: list[Condition] = []
        while len(conditions) < MAX_CONDITIONS:
            grown = _histograms(left.where(F.col("part") == 0).where(_all(conditions)), cuts)
            best, most = None, 0.0
            for f, counts in grown.items():
                p0, n0 = (sum(v for (_, bad), v in counts.items() if bad == y) for y in (1, 0))
                if not p0:
                    continue
                for k, cut in enumerate(cuts[f], 1):
                    p, n = (sum(v for (b, bad), v in counts.items() if bad == y and b >= k) for y in (1, 0))
                    for above, pp, nn in ((True, p, n), (False, p0 - p, n0 - n)):
                        if (gain := _gain(pp, nn, p0, n0)) > most + 1e-9:
                            best, most = Condition(f, above, cut), gain
            if best is None:
                break
            conditions.append(best)
        if not conditions:
            break
        # Pruning: the prefix that does best on the other part.
        stages = [_all(conditions[: k + 1]) for k in range(len(conditions))]
        sums = left.where(F.col("part") == 1).agg(*(F.count_if(s & (F.col("bad") == y)).alias(f"s{k}_{y}") for k, s in enumerate(stages) for y in (0, 1))).first()
        score = [(sums[f"s{k}_1"] - sums[f"s{k}_0"]) / max(1, sums[f"s{k}_1"] + sums[f"s{k}_0"]) for k in range(len(stages))]
        k = max(range(len(stages)), key=lambda i: (score[i], -i))
        p, n = sums[f"s{k}_1"], sums[f"s{k}_0"]
        if p < MIN_COVERED or p < MIN_PRECISION * (p + n):
            break
        rules.append(conditions[: k + 1])
        left = left.where(~_all(rules[-1]))
    return rules


def rule_column(rules: list[list[Condition]]) -> Column:
    """The first rule that holds, as text; null if none does."""
    if not rules:
        return F.lit(None).cast("string")
    out = F
    for k, conditions in enumerate(rules):
        out = out.when(_all(conditions), F.lit(f"{k + 1}: " + " and ".join(map(str, conditions))))
    return out


def labelled_rows(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """The features of labelled rows with bad and part; narrow, and written once. Up to
    BROADCAST_LABELS ids are broadcast, so only labelled texts are counted; beyond it every
    text is, and the narrow statistics are joined."""
    own = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg((F.min(label_col) < 1).cast("int").alias("bad"))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    if own.count() <= BROADCAST_LABELS:
        features = text_statistics(rows.join(F.broadcast(own), "id"))
    else:
        features = text_statistics(rows).select("id", *FEATURES).join(own, "id")
    part = (F.pmod(F.xxhash64("id"), F.lit(3)) == 0).cast("int")
    return written(features.select(*FEATURES, "bad", part.alias("part")), "labelled")


def judge(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """docs with the statistics, base_failed, rule (the learned rule that holds) and kept."""
    rules = learn_rules(labelled_rows(docs, labels, text_col, id_col, label_col))
    counted = text_statistics(docs, text_col)
    # A row number, which no filter can move below: else a filter on the verdict would be pushed
    # into the statistics and repeat their expressions for each use. No row has a negative one.
    (number,) = free_names(counted, "number")
    counted = counted.withColumn(number, F.monotonically_increasing_id()).withColumn("rule", rule_column(rules))
    return counted.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull() & (F.col(number) >= 0)).drop(number)
