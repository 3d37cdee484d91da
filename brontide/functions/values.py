"""Meaning of forecast values: classes of text, labels, risk flags, digests of items."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of the source: texts that say "none", and words for below and from.
NONE_TEXTS = ("강수없음", "강수 없음", "적설없음", "적설 없음", "눈날림")
BELOW, FROM = "미만", "이상"
AMOUNTS, CODES = ("PCP", "SNO"), ("PTY", "SKY")
#: Labels of codes.
SKY_LABELS = {"1": "맑음", "3": "구름많음", "4": "흐림"}
PTY_LABELS = {"0": "없음", "1": "비", "2": "비/눈", "3": "눈", "4": "소나기", "5": "빗방울", "6": "빗방울눈날림", "7": "눈날림"}
#: Risks in order, with their labels.
RISKS = {"heat_risk": "폭염후보", "cold_risk": "한파후보", "heavy_rain_risk": "호우후보", "snow_risk": "대설후보", "wind_risk": "강풍후보"}

_N = r"[0-9]+(?:\.[0-9]+)?"
_UNIT = "(?:mm|cm)"
#: Plain decimal numbers, with an exponent at most; Spark's cast alone also takes 1d or NaN.
NUMBER = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"


def number(text: Column) -> Column:
    """A plain number, else null."""
    t = F.trim(text)
    return F.when(t.rlike(NUMBER), t.try_cast("double"))


def value_semantics(category: Column, raw: Column) -> dict[str, Column]:
    """Five columns that say what a raw value is: representation, number, bounds and code."""
    v = F.trim(raw.cast("string"))
    part = lambda pattern: F.regexp_extract(v, pattern, 1).try_cast("double")
    is_amount, is_code = category.isin(*AMOUNTS), category.isin(*CODES)
    below, above, between = v.rlike(f"^{_N}{_UNIT} ?{BELOW}$"), v.rlike(f"^{_N}{_UNIT} ?{FROM}$"), v.rlike(f"^{_N}~{_N}{_UNIT}$")
    exact, bare, coded = v.rlike(f"^{_N}{_UNIT}$"), v.rlike(f"^{_N}$"), v.rlike("^[0-9]+$")
    missing = raw.isNull() | v.isin("", "-")
    first = part(f"^({_N})")
    amount = (
        F.when(v.isin(*NONE_TEXTS), "explicit_none")
        .when(below | above | between, "quantitative_range")
        .when(exact, "quantitative_exact")
        .when(bare, "bare_numeric")
        .otherwise("unparseable")
    )
    kind = (
        F.when(missing, "missing")
        .when(is_code, F.when(coded, "qualitative_code").otherwise("unparseable"))
        .when(is_amount, amount)
        .otherwise(F.when(number(v).isNotNull(), "quantitative_exact").otherwise("unparseable"))
    )
    plain = F.when(~missing & ~is_code, F.when(is_amount, F.when(exact | bare, first)).otherwise(number(v)))
    return {
        "value_representation": kind,
        "value_num": plain,
        "value_lower_bound": F.when(is_amount, F.when(below, F.lit(0.0)).when(above | between, first)),
        "value_upper_bound": F.when(is_amount, F.when(below, first).when(between, part(f"~({_N})"))),
        "qualitative_code": F.when(is_code & coded, v),
    }


def label(code: Column, labels: dict[str, str]) -> Column:
    pairs = [F.lit(x) for kv in labels.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), code)


def sky_label(code: Column) -> Column:
    return label(code, SKY_LABELS)


def pty_label(code: Column) -> Column:
    return label(code, PTY_LABELS)


def risk_flags() -> dict[str, Column]:
    """Flags of an hourly outlook; a missing measure leaves heat, cold and wind unknown."""
    c = F.col
    return {
        "heat_risk": c("temp_c") >= 33,
        "cold_risk": c("temp_c") <= -12,
        "heavy_rain_risk": c("pty_code").isin("1", "4", "5") & (F.coalesce("pcp_mm", F.lit(0.0)) >= 15),
        "snow_risk": F.coalesce("sno_cm", F.lit(0.0)) >= 1,
        "wind_risk": c("wind_ms") >= 14,
    }


def any_risk() -> Column:
    out = F.lit(False)
    for name in RISKS:
        out = out | F.col(name)
    return out


def risk_labels() -> Column:
    return F.array_join(F.array_compact(F.array(*(F.when(F.col(k), F.lit(v)) for k, v in RISKS.items()))), ", ")


ITEM_FIELDS = ("base_date", "base_time", "nx", "ny", "category", "fcst_date", "fcst_time", "fcst_value")


def item_signature(item: dict[str, Column]) -> Column:
    """SHA-256 of a JSON list of an item's eight tagged values, so that null differs from any
    text. Texts are trimmed, cells are whole numbers where they can be, categories upper case."""

    def tagged(name: str) -> Column:
        plain = F.trim(item[name].cast("string"))
        if name in ("nx", "ny"):
            plain = F.coalesce(plain.try_cast("int").cast("string"), plain)
        if name == "category":
            plain = F.upper(plain)
        return F.when(item[name].isNull(), F.lit("N:<NULL>")).otherwise(F.concat(F.lit("V:"), plain))

    return F.sha2(F.to_json(F.array(*map(tagged, ITEM_FIELDS))), 256)


def wide_measures(value: str, code: str, raw: str = "fcst_value_raw", semantic: bool = False) -> list[Column]:
    """The aggregates that turn rows by category into one wide row."""

    def of(category: str, column: str, name: str) -> Column:
        return F.max(F.when(F.col("category") == category, F.col(column))).alias(name)

    out = [of(c, value, n) for c, n in (("TMP", "temp_c"), ("REH", "humidity_pct"), ("WSD", "wind_ms"), ("VEC", "wind_dir_deg"), ("POP", "precip_prob_pct"))]
    out += [of("SKY", code, "sky_code"), of("PTY", code, "pty_code"), of("PCP", raw, "pcp_raw"), of("PCP", value, "pcp_mm"), of("SNO", raw, "sno_raw"), of("SNO", value, "sno_cm")]
    if semantic:
        out += [of("PCP", "value_representation", "pcp_representation"), of("PCP", "value_lower_bound", "pcp_lower_mm"), of("PCP", "value_upper_bound", "pcp_upper_mm"), of("SNO", "value_representation", "sno_representation")]
    return out
