"""Personal data by weak supervision, in Spark expressions only.

Base spans are exact regular expressions with their checks. Around them the method looks at
more candidates: base matches that fail their check, local phone numbers and spelled-out mail
addresses. A regex, a gazetteer and a context labeler vote on every candidate.
Expectation-maximisation over the counts of vote patterns estimates the labelers' reliabilities,
and its posteriors train a naive Bayes span classifier, whose scores are Spark expressions.
Candidates that it accepts are added; base spans always stay. Only counts of vote patterns
reach the driver: some hundreds, whatever the table's size.

Defined results: a null text is empty and has no spans; without candidates nothing is learned
or added; repeated rows get equal spans; an empty table gives no rows; result columns replace
input columns of the same name, and working columns take names that the input does not have.
Patterns are possessive, so very long texts neither backtrack nor recurse; context comes from
the gap before a match and pieces from slices, so texts are passed over once; spans are gathered
by blocks, so their number counts once, too. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brontide.llm.common import free_names, text_of, written

KINDS = ("email", "ip", "card", "phone")
#: What is found leftmost and without overlap for each kind; the same spans as the plain
#: patterns, with starts held to the beginning of a run so that failing runs are read once.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # A run of digits with single separators that has 12 to 19 digits, whole.
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){11,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: Further candidates, which only the classifier can accept.
EXTRA = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?[\[(](?:at|AT)[\])] ?[A-Za-z0-9-]++(?: ?(?:[\[(](?:dot|DOT)[\])]|\.) ?[A-Za-z0-9-]++)++",
    "phone": r"(?<![0-9A-Za-z+(.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9-])",
}
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
#: Fixed values of the gazetteer labeler: top-level domains, calling codes, issuers' first digits.
DOMAINS = ("com", "net", "org", "edu", "gov", "info", "io", "de", "fr", "es", "it", "nl", "uk", "eu", "ch", "at", "be", "pl", "se", "us", "ca", "kr", "jp")
CALLING = r"^\+(?:1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|82|852|971)"
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[0478]|6)"
#: Fixed values of the context labeler: words just before a candidate, for and against each kind.
CONTEXT = {
    "email": (r"(?:e-?mail|contact|write|reach|address)", r"(?:example only|placeholder)"),
    "ip": (r"(?:\bip\b|host|server|address|client)", r"(?:version|release|section|build)"),
    "card": (r"(?:card|visa|mastercard|amex|credit|payment)", r"(?:order|serial|isbn|invoice|tracking|token|\bid\b)"),
    "phone": (r"(?:phone|\btel\b|call|mobile|fax|whatsapp)", r"(?:order|serial|isbn|invoice|version|\bid\b)"),
}
CONTEXT_CHARS = 40
#: Added spans need this probability.
ACCEPT = 0.9
EM_STEPS = 50
#: First guesses of P(vote | class) for votes -1, 0, 1; in each step they weigh as much as
#: PRIOR candidates, whatever the data's size.
PRIOR = 20
_GUESS = {
    "regex": ((0.70, 0.28, 0.02), (0.02, 0.28, 0.70)),
    "gazetteer": ((0.50, 0.35, 0.15), (0.10, 0.35, 0.55)),
    "context": ((0.30, 0.65, 0.05), (0.05, 0.55, 0.40)),
}
LABELERS = tuple(_GUESS)
_FEATURES = (*LABELERS, "size", "grouped")


def luhn(digits: Column) -> Column:
    """Whether a text of digits passes the check sum."""
    n = F.length(digits)
    values = F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(digits, i, F.lit(1)).cast("int"))
    # From the right, every second digit counts double, with its digits added up.
    doubled = F.transform(values, lambda d, i: F.when((n - i) % 2 == 0, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def valid(kind: str, value: Column) -> Column:
    """The base check of a match."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return value.rlike(rf"^{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}$")
    n = F.length(_digits(value))
    return luhn(_digits(value)) if kind == "card" else (n >= 9) & (n <= 15)


#: Elements that are gathered before they are put behind those gathered earlier.
BLOCK = 64


def _gathered(items: Column, kind: str, step: Callable[[Column, Column], Column]) -> Column:
    """(at, out) of a fold over items that starts at 0 and gathers an array out of elements of a
    kind. An array copies itself for every element that it takes, so blocks are gathered first and then listed:
    for n items that is BLOCK * n + (n / BLOCK) ** 2 copies of a reference, not n ** 2."""
    none = F.array().cast(f"array<{kind}>")

    def folded(own: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(own) - 1) / BLOCK).cast("int")), lambda b: F.slice(own, b * BLOCK + 1, F.lit(BLOCK)))

        def listed(acc: Column, block: Column) -> Column:
            inner = F.aggregate(block, F.struct(acc["at"].alias("at"), none.alias("out")), step)
            return _once(inner, lambda r: F.struct(r["at"].alias("at"), F.concat(acc["out"], F.array(r["out"])).alias("out")))

        done = F.aggregate(blocks, F.struct(F.lit(0).alias("at"), F.array().cast(f"array<array<{kind}>>").alias("out")), listed)
        return _once(done, lambda r: F.struct(r["at"].alias("at"), F.flatten(r["out"]).alias("out")))

    return _once(items, folded)


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), where value is made once however often use names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _spans(text: Column, pattern: str) -> Column:
    """Matches with their offsets and what comes before them: the gaps between matches come from
    a split by the same pattern, and lengths of gaps and matches add up to offsets."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)  # one more than the matches
    pairs = F.zip_with(gaps, found, lambda g, v: F.struct(F.length(g).alias("gap"), F.substring(g, -CONTEXT_CHARS, CONTEXT_CHARS).alias("before"), v.alias("value")))
    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + F.length(x["value"])
        own = F.struct(start.alias("start"), end.alias("end"), x["value"].alias("value"), x["before"].alias("before"))
        return F.struct(F.coalesce(end, acc["at"]).alias("at"), F.when(x["value"].isNotNull(), F.concat(acc["out"], F.array(own))).otherwise(acc["out"]).alias("out"))

    return _gathered(pairs, "struct<start:int,end:int,value:string,before:string>", add)["out"]


def _votes(kind: str, x: Column, before: Column, extra: bool) -> list[Column]:
    value, no = x["value"], F.lit(0)
    regex = no if extra else F.when(valid(kind, value), 1).otherwise(-1)
    if kind == "email":
        top = F.lower(F.regexp_extract(value, r"([A-Za-z]+)$", 1))
        gazetteer = F.when(top.isin(*DOMAINS), 1).otherwise(0)
    elif kind == "ip":
        gazetteer = F.when(value.rlike(r"^0*(?:0|127|2[3-9][0-9]|22[4-9])\.") | value.rlike(r"[0-9]{4}"), -1).otherwise(0)
    elif kind == "card":
        gazetteer = F.when(_digits(value).rlike(ISSUERS), 1).otherwise(-1)
    else:
        gazetteer = F.when(value.rlike(CALLING), 1).otherwise(0)
    yes, against = CONTEXT[kind]
    context = F.when(before.rlike(against), -1).when(before.rlike(yes), 1).otherwise(0)
    return [v.cast("int").alias(n) for n, v in zip(LABELERS, (regex, gazetteer, context), strict=True)]


def _candidates(text: Column, kind: str, extra: bool) -> Column:
    pattern = (EXTRA if extra else BASE)[kind]
    check = (lambda x: F.lit(False)) if extra else (lambda x: valid(kind, x["value"]))

    def described(x: Column) -> Column:
        before = F.lower(x["before"])
        return F.struct(
            x["start"].alias("start"),
            x["end"].alias("end"),
            F.lit(KINDS.index(kind)).alias("kind"),
            check(x).alias("base"),
            *_votes(kind, x, before, extra),
            F.least(F.length(x["value"]).bitwiseAND(-8), F.lit(32)).alias("size"),
            x["value"].rlike("[ ().-]").cast("int").alias("grouped"),
        )

    # A cheap look first: most texts have no such thing.
    hint = {"email": F.contains(text, F.lit("@")), "phone": F.contains(text, F.lit("+"))}.get(kind, F.lit(True))
    if extra:
        hint = F.lower(text).rlike(r"[\[(]at[\])]") if kind == "email" else F.lit(True)
    return F.when(hint & text.rlike(pattern), F.transform(_spans(text, pattern), described))


CANDIDATE = "array<struct<start:int,end:int,kind:int,base:boolean,regex:int,gazetteer:int,context:int,size:int,grouped:int>>"


def find_candidates(docs: DataFrame, text_col: str = "text", name: str = "candidates") -> DataFrame:
    """docs with every candidate: start, end, kind, base, votes and features."""
    text, *found = free_names(docs, "plain", *(f"c{i}" for i in range(len(BASE) + len(EXTRA))))
    out = docs.withColumn(text, text_of(text_col))
    kinds = [(k, False) for k in BASE] + [(k, True) for k in EXTRA]
    out = out.withColumns({c: _candidates(F.col(text), kind, extra) for c, (kind, extra) in zip(found, kinds, strict=True)})
    empty = F.array().cast(CANDIDATE)
    return out.withColumn(name, F.concat(*(F.coalesce(F.col(c), empty) for c in found))).drop(text, *found)


def _estimate(patterns: list[dict]) -> None:
    """Expectation-maximisation for one kind; adds p, the posterior of personal data, to each
    pattern of votes with its count n."""
    total = sum(x["n"] for x in patterns)
    share, rates = 0.5, {k: [list(own) for own in v] for k, v in _GUESS.items()}
    for _ in range(EM_STEPS):
        for x in patterns:
            yes, no = math.log(share), math.log(1 - share)
            for k in LABELERS:
                yes, no = yes + math.log(rates[k][1][x[k] + 1]), no + math.log(rates[k][0][x[k] + 1])
            x["p"] = 1 / (1 + math.exp(min(700, no - yes)))
        share = (sum(x["n"] * x["p"] for x in patterns) + 1) / (total + 2)
        for k in LABELERS:
            for y in (0, 1):
                mass = [PRIOR * g for g in _GUESS[k][y]]
                for x in patterns:
                    mass[x[k] + 1] += x["n"] * (x["p"] if y else 1 - x["p"])
                rates[k][y] = [m / sum(mass) for m in mass]


def train(counts: list[dict]) -> dict[int, tuple[float, dict[str, dict[int, float]]]]:
    """By kind: the log odds of a span and what each feature's value adds to them."""
    models = {}
    for kind in sorted({x["kind"] for x in counts}):
        own = [x for x in counts if x["kind"] == kind]
        _estimate(own)
        yes, no = sum(x["n"] * x["p"] for x in own), sum(x["n"] * (1 - x["p"]) for x in own)
        weights: dict[str, dict[int, float]] = {}
        for f in _FEATURES:
            values = sorted({x[f] for x in own})
            k = len(values)
            weights[f] = {
                v: math.log((sum(x["n"] * x["p"] for x in own if x[f] == v) + 1) / (yes + k)) - math.log((sum(x["n"] * (1 - x["p"]) for x in own if x[f] == v) + 1) / (no + k)) for v in values
            }
        models[kind] = (math.log((yes + 1) / (no + 1)), weights)
    return models


def _score(models, x: Column) -> Column:
    out = F.lit(-1e9)
    for kind, (prior, weights) in models.items():
        total = F.lit(prior)
        for f, own in weights.items():
            part = F.lit(0.0)
            for value, w in own.items():
                part = F.when(x[f] == value, F.lit(w)).otherwise(part)
            total = total + part
        out = F.when(x["kind"] == kind, total).otherwise(out)
    return out


def find_pii(docs: DataFrame, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """docs with base_spans and spans: arrays of (start, kind, end), kind an index into KINDS,
    by start and kind. Rows and candidates are written once, as learning and scoring read them."""
    all_, base, added = free_names(docs, "candidates", "base", "added")
    found = find_candidates(docs, text_col, all_)
    found = written(found if keep_text else found.drop(text_col), "candidates")
    votes = found.select(F.explode(all_).alias("x")).groupBy("x.kind", *(f"x.{f}" for f in _FEATURES)).agg(F.count("*").alias("n"))
    models = train([r.asDict() for r in votes.collect()])
    short = lambda a: F.array_sort(F.transform(a, lambda x: F.struct(x["start"], x["kind"], x["end"])))
    limit = math.log(ACCEPT / (1 - ACCEPT))
    out = found.withColumn(base, F.filter(all_, lambda x: x["base"]))
    out = out.withColumn(added, F.filter(all_, lambda x: ~x["base"] & (_score(models, x) > limit) & ~F.exists(F.col(base), lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"]))))
    return out.withColumns({"base_spans": short(F.col(base)), "spans": short(F.concat(base, added))}).drop(all_, base, added)


def spans_text(spans: str) -> Column:
    """kind:start:end of every span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by <KIND>; overlapping spans become one, named by the
    first. Pieces are slices of the text's characters, so each is copied once."""
    names = F.array(*(F.lit(f"<{k.upper()}>") for k in KINDS))
    def add(acc: Column, x: Column) -> Column:
        own = F.struct(acc["at"].alias("after"), x["start"].alias("start"), x["kind"].alias("kind"))
        heads = F.when(x["start"] >= acc["at"], F.concat(acc["out"], F.array(own))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], x["end"]).alias("at"), heads.alias("out"))

    done = _gathered(spans, "struct<after:int,start:int,kind:int>", add)

    def pieces(both: Column) -> Column:
        chars, own = both["chars"], both["own"]
        shown = F.transform(own["out"], lambda x: F.concat(F.array_join(F.slice(chars, x["after"] + 1, x["start"] - x["after"]), ""), F.get(names, x["kind"])))
        rest = F.slice(chars, own["at"] + 1, F.greatest(F.size(chars) - own["at"], F.lit(0)))
        return F.concat(F.array_join(shown, ""), F.array_join(rest, ""))

    # As an array of one, characters and heads are made once and used for every piece.
    once = F.transform(F.array(F.struct(F.split(text, "").alias("chars"), done.alias("own"))), pieces)
    return F.when(F.size(spans) > 0, F.element_at(once, 1)).otherwise(text)
