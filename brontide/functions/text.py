"""Text: masking of secrets, neutral logs, place names, canonical forms and identities."""

from __future__ import annotations

import unicodedata

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: White space as Unicode has it; a plain \s is ASCII only.
_WHITE = r"\s\x0b\x1c-\x1f\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
#: Fixed values of masking: what stands for a secret, the shortest known one, names of secrets.
MASK = "***REDACTED***"
LEAST_SECRET = 6
SECRET_NAMES = r"service[_-]?key|api[_-]?key|access[_-]?key[_-]?id|secret[_-]?access[_-]?key|access[_-]?key|credential|signature|password|passwd|secret|token|pwd"
#: The shapes of secrets in the order they are masked, with what stays of them.
SECRET_SHAPES = (
    (rf"(?iu)(https?://openapi\.seoul\.go\.kr(?::\d+)?/)[^/{_WHITE}?#]+(/)", f"$1{MASK}$2"),
    (rf"(?iu)([/{_WHITE}\"'=:])[A-Za-z0-9%._\-]{{6,}}(/(?:json|xml)/)", f"$1{MASK}$2"),
    (rf"(?iu)(authorization[{_WHITE}]*[:=][{_WHITE}]*)(?:bearer[{_WHITE}]+)?[^{_WHITE}]+", f"$1{MASK}"),
    (r"(?U)\bAKIA[0-9A-Z]{16}\b", MASK),
    (rf"(?<=://)[^/@{_WHITE}]{{1,256}}(?=@)", MASK),
    (rf"(?iu)((?:{SECRET_NAMES})[{_WHITE}]*[=:][{_WHITE}]*[\"']?)[^{_WHITE}\"'&;]+", f"$1{MASK}"),
)
#: Control characters beyond \r, \n and \t that logs must not hold, and line separators.
CONTROLS = (*range(0x00, 0x09), *range(0x0B, 0x20), *range(0x7F, 0xA0), 0x2028, 0x2029)


def masked(text: Column, known: tuple[str, ...] = ()) -> Column:
    """Known secrets first, the longest first, then whatever has the shape of one."""
    for secret in sorted({s for s in known if len(s) >= LEAST_SECRET}, key=lambda s: (-len(s), s)):
        text = F.replace(text, F.lit(secret), F.lit(MASK))
    for shape, left in SECRET_SHAPES:
        text = F.regexp_replace(text, shape, left)
    return text


def masked_items(items: Column, known: tuple[str, ...] = ()) -> Column:
    return F.transform(items, lambda x: masked(x, known))


def masked_values(entries: Column, known: tuple[str, ...] = ()) -> Column:
    """A map with its keys and values masked; keys that become equal keep the last value."""
    pairs = F.transform(F.map_entries(entries), lambda e: F.struct(masked(e["key"], known).alias("k"), masked(e["value"], known).alias("v")))
    last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda q: q["k"] == p["k"]))
    return F.map_from_entries(last)


def neutral(text: Column, most: int = 2000) -> Column:
    """One log line: backslashes, line ends, tabs and control characters become visible
    escapes; what is beyond the cap is named by its length. Null stays null."""
    out = text
    for plain, shown in (("\\", "\\\\"), ("\r", "\\r"), ("\n", "\\n"), ("\t", "\\t")):
        out = F.replace(out, F.lit(plain), F.lit(shown))
    clean = out
    for code in CONTROLS:
        clean = F.replace(clean, F.lit(chr(code)), F.lit(f"\\u{code:04x}"))
    # Few texts have any, so the rest skip the replacements.
    out = F.when(out.rlike(r"[\x00-\x08\x0b-\x1f\x7f-\x9f\x{2028}\x{2029}]"), clean).otherwise(out)
    n = F.length(out)
    return F.when(n > most, F.concat(F.substring(out, 1, most), F.lit("…(+"), (n - most).cast("string"), F.lit(")"))).otherwise(out)


@F.arrow_udf(T.StringType())
def _nfc(text: pa.Array) -> pa.Array:
    # Batches of ASCII, the usual ones, are composed as they are.
    if pc.all(pc.string_is_ascii(text)).as_py() is not False:
        return text
    return pa.array([None if t is None else unicodedata.normalize("NFC", t) for t in text.to_pylist()], pa.string())


def nfc(text: Column) -> Column:
    """Composed form, for which Spark has no function."""
    return _nfc(text.cast("string"))


def place_name(text: Column) -> Column:
    """Composed, without outer blanks, with single blanks inside."""
    return F.trim(F.regexp_replace(nfc(text), f"[{_WHITE}]+", " "))


def alias_keys(name: Column) -> Column:
    """The distinct spellings of one name: without blanks, with and without the ordinal mark
    before digits, with dots as they are, as middle dots, or left out."""
    compact = F.regexp_replace(nfc(name), f"[{_WHITE}]+", "")
    plain = F.regexp_replace(compact, r"제(?=\d)", "")
    dots = lambda c, to: F.replace(c, F.lit("."), F.lit(to))
    own = F.array(compact, plain, dots(compact, "·"), dots(compact, ""), dots(plain, "·"), dots(plain, ""))
    return F.array_distinct(F.filter(own, lambda x: x.isNotNull() & (x != "")))


def region_name(text: Column) -> Column:
    """A region's name without blanks."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"[{_WHITE}]+", "")


def unit_name(text: Column, strip_ordinal: bool = False) -> Column:
    """A unit's name without blanks and separators; the ordinal mark before digits goes on one
    side only."""
    out = region_name(text)
    out = F.regexp_replace(out, r"제(?=\d)", "") if strip_ordinal else out
    return F.translate(out, "·・ㆍ.", "")


@F.arrow_udf(T.StringType())
def _real(value: pa.Array) -> pa.Array:
    return pa.array([None if v is None else format(v, ".17g") for v in value.to_pylist()], pa.string())


def _refused(why: str) -> Column:
    return F.raise_error(F.lit(why)).cast("string")


def canonical(column: Column, kind: str, of: str = "double") -> Column:
    """Text of a value that is equal for equal values: INTEGER, REAL or TEXT. of: the column's
    type. Values that the kind cannot hold are refused: fractions and texts as INTEGER, booleans
    and what is not finite as REAL."""
    if of.startswith(("array", "map", "struct")):
        raise ValueError("nested values have no canonical text")
    if kind == "INTEGER":
        if of == "string":
            raise ValueError("a text is no INTEGER")
        whole = (column.cast("double") == F.floor(column.cast("double"))) if of in ("float", "double") or of.startswith("decimal") else F.lit(True)
        good = F.coalesce(whole, F.lit(False)) & (~F.isnan(column) if of in ("float", "double") else F.lit(True))
        return F.when(column.isNull(), F.lit(None).cast("string")).when(good, column.cast("decimal(38,0)" if of in ("float", "double") else "int" if of == "boolean" else "decimal(38,0)" if of.startswith("decimal") else "long").cast("string")).otherwise(_refused("a fraction is no INTEGER"))
    if kind == "REAL":
        if of == "boolean":
            raise ValueError("a boolean is no REAL")
        value = column.try_cast("double")
        good = value.isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf"))
        return F.when(column.isNull(), F.lit(None).cast("string")).when(good, _real(value)).otherwise(_refused("a REAL is a finite number"))
    if kind == "TEXT":
        return nfc(column)
    raise ValueError(f"no such kind: {kind}")


@F.arrow_udf(T.StringType())
def _escaped(text: pa.Array) -> pa.Array:
    import json

    if pc.all(pc.string_is_ascii(text)).as_py() is not False:
        return text
    return pa.array([t if t is None or t.isascii() else "".join(c if c < "\x80" else json.dumps(c)[1:-1] for c in t) for t in text.to_pylist()], pa.string())


def sorted_json(parts: dict[str, Column]) -> Column:
    """A JSON object with its names in order; nulls stay in it."""
    return F.to_json(F.struct(*(parts[k].alias(k) for k in sorted(parts))), {"ignoreNullFields": "false"})


def identity(**parts: Column) -> Column:
    """SHA-256 of a JSON object with its names in order, nulls included, as ASCII."""
    return F.sha2(_escaped(sorted_json(parts)), 256)


def joined_identity(*parts: Column) -> Column:
    """SHA-256 of parts with a unit separator between them."""
    return F.sha2(F.concat_ws("\x1f", *(p.cast("string") for p in parts)), 256)


def clock(seconds: Column) -> Column:
    """[-]HH:MM:SS of a number of seconds, rounded half to even."""
    s = F.bround(seconds.cast("double"), 0).cast("long")
    n = F.abs(s)
    shown = F.format_string("%02d:%02d:%02d", F.floor(n / 3600), F.floor(n % 3600 / 60), n % 60)
    return F.when(s < 0, F.concat(F.lit("-"), shown)).otherwise(F.when(s.isNotNull(), shown))
