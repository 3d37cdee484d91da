"""Spelling variants against all edits of all words."""

import re
import zlib
from collections import Counter

from brontide.llm import queries, spelling
from tests.llm.helpers import LOWER, docs_frame

#: (form, root, n, n_near, form_n) by word.


def brute(rows, damage=97, least_length=5, least_count=3, ratio=2):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if damage and h % damage == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_count}
    letters = {x for w in words for x in w}

    def near(w):
        out = {w[:i] + w[i + 1 :] for i in range(len(w))} | {w[:i] + a + w[i:] for i in range(len(w) + 1) for a in letters}
        return (out | {w[:i] + a + w[i + 1 :] for i in range(len(w)) for a in letters}) & words.keys() - {w}

    forms, n_near = {}, {}
    for w, n in words.items():
        found = near(w)
        best = min(found, key=lambda v: (-words[v], v), default=None)
        n_near[w], forms[w] = len(found), best if best and words[best] >= ratio * n else None

    def root(w):
        return root(forms[w]) if forms[w] else w

    return {w: (forms[w], root(w), n, n_near[w], words[forms[w]] if forms[w] else None) for w, n in words.items()}


def found(frame):
    rows = frame.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    expected = brute(rows)
    assert found(queries.queries()["op12_spelling"](spark, sf)) == expected
    assert any(f[0] for f in expected.values())


def test_edges(spark):
    """Runs of equal letters, chains of forms, ties, accents and capitals, long words, nulls and repeated rows."""
    long = "ab" * 700
    texts = {
        "hello": 9, "helo": 40, "helllo": 4, "hallo": 20, "hullo": 20, "hxllo": 5, "HELLO": 1, "Étape": 3, "étape": 8, "etape": 3,
        "aaaaa": 3, "aaaaaa": 7, "aaaaaaa": 15, "÷×abc": 3, "÷×abd": 6, "twice": 2, long: 3, long + "c": 6, "x" + long: 3, long[:-1] + "z": 3,
    }
    rows = [(i, " ".join([w] * n)) for i, (w, n) in enumerate(texts.items())] + [(None, "hello, world's worlds"), (5, None), (5, ""), (5, "1234 .")]
    rows += [(7, "twice2twice")] * 2
    docs = docs_frame(spark, rows).withColumnsRenamed({"lang": "word", "source": "n", "n_chars": "root"})
    for damage in (None, 3):
        assert found(spelling.variants(docs, damage=damage)) == brute(rows, damage)
    assert brute(rows, None)["hxllo"][0] == "hallo"
    assert spelling.variants(docs.limit(0)).count() == 0


def test_prefixes_shared_by_many_words(spark):
    """Many words below one node, dealt to one task, and near words at every place."""
    letters = "abcdefgh"
    words = [f"common{a}{b}end{c}" for a in letters for b in letters for c in letters[:4]]
    rows = [(i, " ".join([w] * (3 + i % 11))) for i, w in enumerate(words)]
    assert found(spelling.variants(docs_frame(spark, rows))) == brute(rows, None)
