"""The pipeline on a small folder, stage by stage, against brute force."""

import random

import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.helpers import base_spans, contamination, docs_frame, near_components

WORDS = [f"{a}{b}{c}" for a in ("ba", "ke", "lo", "mi", "su") for b in ("n", "r", "t", "l") for c in ("a", "e", "o", "u")]


def folder(spark, path):
    rnd = random.Random(3)
    text = lambda n: " ".join(rnd.choice(WORDS) for _ in range(n))
    items = [(i, text(20)) for i in range(3)]
    docs = [(i, text(120)) for i in range(60)]
    docs += [(100 + i, docs[i][1] + " tail") for i in range(5)] + [(110, docs[9][1])]
    docs += [(200 + i, text(20) + " " + items[i][1] + " " + text(20)) for i in range(3)]
    docs += [(300, text(70) + " write to joe@example.com or 4111 1111 1111 1111"), (301, "too short"), (302, None), docs[1], docs[1]]
    docs += [(400 + i, " ".join(rnd.choice(WORDS) + "$$$" for _ in range(80))) for i in range(30)]
    labels = [(i, 1, 0) for i in range(40)] + [(400 + i, 0, 0) for i in range(30)]
    docs_frame(spark, docs).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return docs, items


def test_every_stage(spark, tmp_path):
    path = str(tmp_path / "sf")
    _, items = folder(spark, path)
    docs = spark.read.parquet(f"{path}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    stage = dict(corpus_pipeline.STAGES)
    kept = stage["quality_rules"](spark, docs, path)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert ids == {*range(60), *range(100, 105), 110, *range(200, 203), 300}
    once = stage["near_duplicates"](spark, kept, path)
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    want = {c for _, c in near_components(rows).values()}
    got = [r.doc_id for r in once.collect()]
    assert once.columns == docs.columns and sorted(got) == sorted(want)
    clean = stage["benchmark_decontamination"](spark, once, path)
    for r in once.collect():
        n, hit, _ = contamination(r.text, items)
        assert (r.doc_id in {x.doc_id for x in clean.collect()}) == (20 * hit < n or hit == 0)
    private = stage["personal_data"](spark, clean, path)
    assert private.columns == docs.columns
    for r in private.collect():
        assert base_spans(r.text) == "" and r.n_chars == len(r.text)
    coded = stage["sentencepiece"](spark, private, path).collect()
    lib = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = {r.doc_id: r.text for r in private.collect()}
    assert len(coded) == len(texts)
    assert all(r.ids == lib.encode(texts[r.doc_id]) and r.round_trip for r in coded)
    whole = corpus_pipeline.run(spark, path)
    assert {r.doc_id for r in whole.collect()} == set(texts)
    assert whole.where(~F.col("round_trip")).count() == 0


def test_near_copies_are_those_of_five_words_and_four_fifths(spark):
    rnd = random.Random(5)
    text = lambda n: [f"w{rnd.randrange(10**9)}" for _ in range(n)]
    rows = []
    for i in range(12):
        base = text(404)
        # A footer (similarity 0.82 in both shingle sizes), a replaced block, and two that are too far.
        rows += [(100 * i, base), (100 * i + 1, base + text(88)), (100 * i + 2, base[:180] + text(40) + base[220:]), (100 * i + 3, base + text(150)), (100 * i + 4, base[:150] + text(70) + base[220:])]
    rows = [(i, " ".join(w)) for i, w in rows]
    want = {c for _, c in near_components(rows, 5, 80).values()}
    assert want != {c for _, c in near_components(rows).values()}
    got = corpus_pipeline.near_duplicates(spark, docs_frame(spark, rows), "")
    assert sorted(r.doc_id for r in got.collect()) == sorted(want)


def test_texts_of_one_id_go_and_stay_by_themselves(spark):
    rnd = random.Random(6)
    text = lambda: " ".join(f"w{rnd.randrange(10**9)}" for _ in range(80))
    a, b, c, d, e = (text() for _ in range(5))
    rows = [(1, a), (5, a + " tail"), (5, b), (6, c), (6, d), (6, d), (6, d.upper()), (7, e), (7, e + " tail"), (8, ""), (8, None), (8, None), (None, a), (None, a)]
    got = [(r.doc_id, (r.text or "").lower() if r.doc_id != 8 else r.text) for r in corpus_pipeline.near_duplicates(spark, docs_frame(spark, rows), "").collect()]
    sevens = [t for i, t in got if i == 7]
    assert len(sevens) == 1 and sevens[0] in (e, e + " tail")
    want = [(1, a), (5, b), (6, c), (6, d), (8, ""), (8, None), (None, a), (None, a)]
    assert sorted((x for x in got if x[0] != 7), key=repr) == sorted(want, key=repr)
