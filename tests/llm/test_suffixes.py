"""Repeated strings against a table of all strings."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from brontide.llm import queries, suffixes
from tests.llm.helpers import docs_frame


def brute(rows, length, keep="none"):
    """(id, bytes, removed runs, kept bytes) of each row; rows in order of their ids for keep first."""
    data = [(i, (t or "").encode()) for i, t in rows]
    counts = Counter(d[k : k + length] for _, d in data for k in range(len(d) - length + 1))
    seen, out = set(), []
    for i, d in data:
        gone = bytearray(len(d))
        for k in range(len(d) - length + 1):
            s = d[k : k + length]
            if s in seen if keep == "first" else counts[s] > 1:
                gone[k : k + length] = b"\1" * length
            seen.add(s)
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(d), sum(gone), runs, bytes(x for x, g in zip(d, gone, strict=True) if not g)))
    return out


def found(frame):
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    rows = frame.select("doc_id", "n_bytes", removed.alias("r"), F.size("spans").alias("s"), "kept").collect()
    return sorted(((r[0], r[1], r[2], r[3], bytes(r[4])) for r in rows), key=repr)


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want = {(i, n, r, s, sha256_bytes(k)) for i, n, r, s, k in brute(rows, 200)}
    got = queries.queries()["op13_suffix_dedup"](spark, sf).collect()
    assert len(got) == len(rows) and {tuple(r) for r in got} == want
    assert any(r.n_removed for r in got)


def sha256_bytes(data):
    import hashlib

    return hashlib.sha256(data).hexdigest()


def prose(dice, n):
    return " ".join("".join(dice.choices("abcdeé", k=dice.randint(1, 8))) for _ in range(n))


def cases():
    """Copies, passages in other surroundings, near copies, runs of one letter, periods, repeats inside a text."""
    dice = random.Random(4)
    passage, long = prose(dice, 60), prose(dice, 400)
    rows = [(i, f"{prose(dice, 5 + i)} {passage[i % 5 :]} {prose(dice, 30)}") for i in range(12)]
    rows += [(20, long), (21, long), (22, long[:700] + "#" + long[701:]), (23, long[300:]), (24, long + long)]
    rows += [(30, "a" * 900), (31, "b" + "a" * 85), (32, "ab" * 300), (33, "abc" * 90 + "x" + "abc" * 90), (34, "é" * 150), (35, "a" * 79), (36, None), (37, "")]
    rows += [(40, prose(dice, 3)), (41, passage + "," + passage)]
    return rows


@pytest.mark.parametrize(("keep", "group"), [("none", 2000), ("none", 2), ("first", 2000), ("first", 2)])
def test_edges(spark, monkeypatch, keep, group):
    monkeypatch.setattr(suffixes, "GROUP", group)
    monkeypatch.setattr(suffixes, "BLOCK", 4000)
    monkeypatch.setattr(suffixes, "BROADCAST_DOCS", 1000 if group == 2 else 0)
    rows = cases()
    docs = docs_frame(spark, rows).withColumnsRenamed({"lang": "th", "source": "a", "n_chars": "spans"}).withColumn("bytes", F.lit("x"))
    frame, scratch = suffixes.without_repeats(docs.repartition(3), length=80, keep=keep)
    assert found(frame) == sorted(brute(rows, 80, keep), key=repr)
    assert {"th", "a", "bytes"} <= {*frame.columns}
    scratch.clear()


def test_repeated_rows_nulls_and_empty(spark):
    text = prose(random.Random(1), 50)
    rows = [(None, text), (1, text), (1, text), (2, "short"), (2, "short")]
    frame, _ = suffixes.without_repeats(docs_frame(spark, rows), length=80, keep="none")
    assert found(frame) == sorted(brute(rows, 80), key=repr)
    frame, _ = suffixes.without_repeats(docs_frame(spark, rows[:2] + rows[3:]), length=80)
    assert found(frame) == sorted(brute(rows[:2] + rows[3:], 80, "first"), key=repr)
    frame, _ = suffixes.without_repeats(docs_frame(spark, []), length=80)
    assert found(frame) == []


def test_pieces_of_very_long_texts(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "PIECE", 100)
    rows = cases()
    for data in ((t or "").encode() for _, t in rows):
        starts = [s + k for s, _, n, _, _ in suffixes.anchors(data, 80) for k in range(n - 79)]
        assert starts == list(range(max(0, len(data) - 79)))
