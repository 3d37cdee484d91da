import random
import time

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from brontide.llm import decontaminate, pieces, pii, rules, tokens
from tests.llm.helpers import base_spans, contamination, docs_frame, repeated, words

MODEL = public_tokenizers.path("piece_bpe_32k.model")
BPE = public_tokenizers.path("byte_bpe_50k.json")
LONG = "lorem ipsum dolor sit amet " * 8000
EDGES = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, LONG), (6, "same text here"), (6, "same text here"), (None, "no id at all")]


def sample(seed=1, n=60, vocabulary="the an of to In oN Été x1 naïve 12 a.b c-d".split()):
    rnd = random.Random(seed)
    return [(100 + i, " ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(0, 80))) + rnd.choice(["", "\n", " \n a"])) for i in range(n)]


@pytest.fixture(scope="module")
def benchmark_items():
    rnd = random.Random(4)
    items = [(i, " ".join(rnd.choice("red green blue Yellow black white".split()) for _ in range(20))) for i in range(5)]
    return [*items, (7, "short item only"), (8, ""), (9, None), (10, "red"), (3, items[3][1])]


def test_contamination_is_that_of_brute_force(spark, benchmark_items):
    rnd = random.Random(2)
    texts = [(200 + i, " ".join(rnd.choice("red green, BLUE yellow! black white short item only".split()) for _ in range(60))) for i in range(20)]
    texts += [(300, "é " + benchmark_items[0][1].upper() + " tail"), (301, "nothing of it " * 30 + benchmark_items[1][1])] + EDGES
    bench = spark.createDataFrame(benchmark_items, "item_id long, text string")
    got = decontaminate.decontaminate(docs_frame(spark, texts), bench).collect()
    assert len(got) == len(texts)
    for r in got:
        n, hit, ids = contamination(r.text, benchmark_items)
        assert (r.n_words, r.n_hit, r.item_ids, r.n_items) == (n, hit, ids, len(ids))
        assert r.contaminated == (hit > 0 and 20 * hit >= n)
    whole = next(r for r in got if r.doc_id == 300)
    assert any(whole.text[s.start : s.end].lower().startswith(benchmark_items[0][1].lower()[:20]) for s in whole.spans)


def test_contamination_of_empty_tables_and_clashing_columns(spark, benchmark_items):
    none = spark.createDataFrame([], "item_id long, text string")
    rows = docs_frame(spark, sample()).withColumns({"n_hit": F.lit("mine"), "spans": F.lit(0)})
    got = decontaminate.decontaminate(rows, none).collect()
    assert all(r.n_hit == 0 and not r.contaminated and r.spans == [] for r in got)
    assert decontaminate.decontaminate(docs_frame(spark, []), none).count() == 0


def test_base_spans_are_exact(spark):
    rnd = random.Random(5)
    parts = ["a", "@", ".", "-", "1", "23", "+1", " ", "(", "4111", "255", "%", "b@c.de", "4111 1111 1111 1111", "é", "😀"]
    rows = [(i, "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40)))) for i in range(1500)]
    rows += [(9001, "1" * 40000), (9002, "a" * 40000 + "@"), (9003, "a.b" * 10000 + "@x.y"), (9004, "1 " * 20000)] + EDGES
    got = pii.find_pii(docs_frame(spark, rows).withColumn("spans", F.lit("mine"))).select("text", pii.spans_text("base_spans").alias("base"), pii.spans_text("spans").alias("all")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.base == base_spans(r.text)
        assert set(filter(None, r.base.split(","))) <= set(r.all.split(","))


def test_added_spans_and_redaction(spark):
    rows = [(i, f"doc {i} please call my phone 555-123-45{i:02d} today") for i in range(20)] + [(50, "mail joe@example.com or 1.2.3.4"), (51, "order id 4111111111111112 shipped"), (52, None)]
    got = {r.doc_id: r for r in pii.find_pii(docs_frame(spark, rows)).withColumn("clean", pii.redacted(F.coalesce("text", F.lit("")), F.col("spans"))).collect()}
    assert got[3].clean == "doc 3 please call my phone <PHONE> today"
    assert got[50].clean == "mail <EMAIL> or <IP>"
    assert got[51].spans == [] and got[52].clean == ""
    assert pii.find_pii(docs_frame(spark, [])).count() == 0


def test_ids_are_the_librarys_and_decode_to_the_text(spark):
    rnd = random.Random(1)
    odd = ["".join(rnd.choice("aabtheinr  \n\t▁é中½<s>0x.,") for _ in range(rnd.randint(0, 150))) for _ in range(300)]
    rows = [(1000 + i, t) for i, t in enumerate(odd)] + sample() + EDGES + [(9, "thent" * 4000), (10, " " * 500)]
    lib = pieces.Vocabulary(MODEL).library
    got = pieces.decode(pieces.encode(docs_frame(spark, rows).withColumn("ids", F.lit(1)), MODEL), MODEL).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.text is None:
            assert r.ids is None and r.decoded is None
        else:
            assert r.ids == lib.encode(r.text)
            assert r.decoded == lib.decode(r.ids)
    assert pieces.encode(docs_frame(spark, []), MODEL).count() == 0


def test_streaming_commits_before_the_end(monkeypatch):
    v = pieces.Vocabulary(MODEL)
    text = v.normalised("thenationofeverything" * 50)
    committed = []
    read = 0

    def chars():
        nonlocal read
        for c in text:
            read += 1
            yield c

    stream = pieces.Viterbi(v).encode(chars())
    for i in stream:
        committed.append(i)
        if len(committed) == 20:
            break
    assert read < 200
    assert committed + list(stream) == v.library.encode("thenationofeverything" * 50)


def test_unigram_paths_maximise_the_sum():
    """A small hand-made unigram vocabulary against all segmentations."""
    v = pieces.Vocabulary.__new__(pieces.Vocabulary)
    v.pieces = ["<unk>", "a", "b", "ab", "aba", "ba"]
    v.ids = {p: i for i, p in enumerate(v.pieces) if i}
    v.scores, v.special, v.unknown, v.byte_ids, v.bytes = [0, -2.0, -2.5, -3.0, -4.2, -3.1], [True] + [False] * 5, 0, None, {}
    v.longest, v.chars, v.merges = 3, {"a", "b"}, False
    v.index()

    def best(s):
        return max((sum(v.scores[v.ids[p]] for p in c) for c in cuts(s)), default=None)

    def cuts(s):
        if not s:
            yield []
        for p in v.ids:
            if s.startswith(p):
                for rest in cuts(s[len(p) :]):
                    yield [p, *rest]

    for s in ("a", "abab", "babaab", "abaabab", "bbbabaab"):
        ids = list(pieces.Viterbi(v).encode(s))
        assert "".join(v.pieces[i] for i in ids) == s
        assert sum(v.scores[i] for i in ids) == pytest.approx(best(s))


def test_token_counts_are_the_librarys(spark, tmp_path):
    rnd = random.Random(3)
    odd = ["".join(rnd.choice("ab  \n\t's1!é中 \x1c<|endoftext|>") for _ in range(rnd.randint(0, 80))) for _ in range(200)]
    odd += ["x<|endoftext|>y", "a  b\n\nc 's", "tab\there"]
    rows = [(1000 + i, t) for i, t in enumerate(odd)] + sample() + EDGES
    whole = tokens.Counter(BPE)
    cache = str(tmp_path / "cache")
    docs = docs_frame(spark, rows).withColumn("n_tokens", F.lit("mine"))
    for _ in range(2):
        got = tokens.count_tokens(docs, BPE, cache).collect()
        assert len(got) == len(rows)
        for r in got:
            assert r.n_tokens == whole.whole([r.text or ""])[0]
            assert r.n_bytes == len((r.text or "").encode())
    stored = spark.read.parquet(cache)
    assert stored.count() == stored.select("digest").distinct().count() == len({t or "" for _, t in rows})
    assert tokens.count_tokens(docs_frame(spark, []), BPE).count() == 0


def test_statistics_are_those_of_brute_force(spark):
    rows = sample(7, 80, "a b c d".split()) + EDGES + [(11, "x y\nx y\n\n \nx y"), (12, "a b a b a b"), (13, "# * $ hi |<>&%")]
    got = rules.text_statistics(docs_frame(spark, rows).withColumn("n_words", F.lit(None))).collect()
    assert len(got) == len(rows)
    for r in got:
        w, t = words(r.text), r.text or ""
        lines = [x for x in t.split("\n") if words(x)]
        assert (r.n_words, r.word_chars, r.n_symbols) == (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t))
        assert r.n_dup_lines == len(lines) - len(set(lines))
        assert r.n_repeat_words == repeated(t)
        assert r.base_failed == (len(w) < 50 or 100 * r.n_repeat_words > 50 * len(w))


def test_rules_find_junk_and_keep_the_rest(spark):
    rnd = random.Random(8)
    vocabulary = [f"w{i}" for i in range(3000)]
    clean = [(i, " ".join(rnd.choice(vocabulary) for _ in range(80))) for i in range(200)]
    junk = [(1000 + i, " ".join(rnd.choice(vocabulary) + "$$$" for _ in range(80))) for i in range(80)]
    labels = spark.createDataFrame([(i, 1) for i, _ in clean[:120]] + [(i, 0) for i, _ in junk[:50]] + [(None, 0), (5, None)], "doc_id long, quality int")
    got = {r.doc_id: r for r in rules.judge(docs_frame(spark, clean + junk), labels).collect()}
    assert all(got[i].kept for i, _ in clean)
    assert not any(got[i].kept for i, _ in junk) and "symbols_per_char" in got[1000].rule
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert all(r.kept for r in rules.judge(docs_frame(spark, clean + junk), none).collect())
    assert rules.judge(docs_frame(spark, []), none).count() == 0


@pytest.mark.parametrize("n", [63, 64, 65, 129, 1000])
def test_spans_are_gathered_by_blocks(spark, n):
    """Texts with as many matches as fill blocks, or one less or more; redaction goes by blocks, too."""
    text = "".join(f"{i} name{i}@host.example.org, " for i in range(n))
    r = pii.find_pii(docs_frame(spark, [(1, text)])).withColumn("clean", pii.redacted(F.col("text"), F.col("spans"))).select(pii.spans_text("base_spans").alias("base"), "clean").first()
    assert r.base == base_spans(text) and r.clean == "".join(f"{i} <EMAIL>, " for i in range(n))


def test_many_matches_cost_their_number_once(spark):
    seconds = []
    for n in (6000, 24000):
        docs = docs_frame(spark, [(1, " ".join(f"name{i}@host.example.org" for i in range(n)))])
        start = time.time()
        assert len(pii.find_pii(docs).first().base_spans) == n
        seconds.append(time.time() - start)
    assert seconds[1] < 6 * seconds[0] + 2
