import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from brontide.llm import near_dup, quality, shards, urls, warc
from tests.llm.helpers import docs_frame, near_components

WORDS = [f"w{i}" for i in range(2000)]


def edited(rnd, base, edits):
    w = base.split()
    for _ in range(edits):
        w[rnd.randrange(len(w))] = rnd.choice(WORDS)
    return " ".join(w)


def near_rows(seed=1):
    rnd = random.Random(seed)
    rows, i = [], 0
    for size, edits, length in ((40, 1, 90), (25, 3, 120), (60, 2, 60), (2, 1, 40), (12, 6, 200), (1, 0, 5)):
        base = " ".join(rnd.choice(WORDS) for _ in range(length))
        for _ in range(size):
            rows.append((i := i + 1, edited(rnd, base, rnd.randint(0, edits))))
    rows += [(900, None), (901, ""), (902, "  \n"), (903, "one two"), (904, "One  TWO"), (905, "one")]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("small", [near_dup.SMALL, 3])
def test_components_are_those_of_all_pairs(spark, monkeypatch, small):
    monkeypatch.setattr(near_dup, "SMALL", small)
    rows = near_rows()
    want = near_components(rows)
    got = near_dup.near_duplicates(docs_frame(spark, rows).withColumn("kept", F.lit(1))).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_shingles, r.component_id) == want[r.doc_id]
        assert r.kept == (r.doc_id == r.component_id)


def test_near_duplicates_beyond_the_broadcast_bound_and_edges(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BROADCAST_IDS", 0)
    monkeypatch.setattr(near_dup, "SMALL", 2)
    rows = near_rows(3)
    want = near_components(rows)
    more = rows + [(None, rows[0][1]), rows[5], rows[5]]
    got = near_dup.near_duplicates(docs_frame(spark, more)).collect()
    assert len(got) == len(more)
    assert all(r.component_id == want[r.doc_id][1] for r in got if r.doc_id is not None)
    alone = next(r for r in got if r.doc_id is None)
    assert alone.component_id is None and alone.kept
    assert near_dup.near_duplicates(docs_frame(spark, [])).count() == 0


def test_minhash_tuples_meet_as_often_as_they_should():
    p = near_dup.Params()
    rng = np.random.default_rng(1)
    missed = 0
    for _ in range(200):
        both = rng.integers(0, 2**64, 400, dtype=np.uint64)
        a, b = both[:370], both[30:]  # similarity 340 / 400
        low = [near_dup.minhashes(x, 2 * p.collection * p.rows, p.seed).reshape(2, p.collection, p.rows) for x in (a, b)]
        same = (low[0] == low[1]).all(axis=2)
        missed += not (same[0].any() and same[1].any())
    assert missed <= 1


def minimax(sizes, shards_n):
    low, high = max(sizes, default=0), sum(sizes)
    while low < high:
        mid, used, left = (low + high) // 2, 1, 0
        mid = (low + high) // 2
        for s in sizes:
            if left + s > mid:
                used, left = used + 1, 0
            left += s
        if used <= shards_n:
            high = mid
        else:
            low = mid + 1
    return low


@pytest.mark.parametrize("hot", [0, 150])
def test_shards_have_the_smallest_capacity(spark, hot, monkeypatch):
    monkeypatch.setattr(shards, "FIRST_BITS", 4)
    rnd = random.Random(9)
    rows = [(i, "x" * rnd.randint(0, 400) + str(i % 170)) for i in range(300)] + [(1000 + i, "hot copy") for i in range(hot)] + [(5000, None), (5001, ""), (5002, "é")]
    got = shards.shard(docs_frame(spark, rows).withColumn("shard", F.lit("mine")), 7).withColumn("h", F.xxhash64(F.coalesce("text", F.lit("")))).collect()
    assert len(got) == len(rows)
    by_text, sizes = {}, {}
    for r in got:
        assert r.size == len((r.text or "").encode()) + 16
        by_text.setdefault(r.h, set()).add(r.shard)
        sizes[r.h] = sizes.get(r.h, 0) + r.size
    assert all(len(s) == 1 for s in by_text.values())
    loads = {}
    for r in got:
        loads[r.shard] = loads.get(r.shard, 0) + r.size
    assert max(loads.values()) <= minimax([sizes[h] for h in sorted(sizes)], 7)
    assert len(loads) == 7
    for k in loads:
        assert sorted(r.slot for r in got if r.shard == k) == list(range(sum(r.shard == k for r in got)))
    assert shards.shard(docs_frame(spark, []), 7).count() == 0


def test_plan_is_exact(spark):
    rnd = random.Random(2)
    for n, k in ((1, 3), (5, 3), (200, 12), (50, 40)):
        pairs = sorted({(rnd.randint(-(2**63), 2**63 - 1), rnd.randint(1, 1000)) for _ in range(n)})
        capacity, cuts = shards.plan_shards(spark.createDataFrame(pairs, "hash long, size long"), k)
        assert capacity == minimax([s for _, s in pairs], k)
        assert len(cuts) == k - 1 and cuts == sorted(cuts)


RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
URLS = ["http://a.org", "http://a.org/x", "http://ORG/x", "https://example.org/es/1", "https://w.EXAMPLE.org/en/12?x=://b/c", "http://notexample.org/es/", "http://x.com/fr/1#y", "http://x.com/de/", "http://x.com/frx", "nothing", "", None, "http://", "ftp://bad.net/1", "http://bad.net/2", "http://bad.net/2", "http://good.net/2"]


@pytest.mark.parametrize("bits", [urls.MAX_BITS, 1500])
def test_url_rules_and_exact_membership(spark, monkeypatch, bits):
    monkeypatch.setattr(urls, "MAX_BITS", bits)
    many = [f"http://h{i}.net/{i}" for i in range(3000)]
    pages = spark.createDataFrame([(i, u, "mine") for i, u in enumerate(URLS + many)], "page_id long, url string, rule string")
    listed = spark.createDataFrame([("bad.net/2",), ("bad.net/2",), (None,), ("elsewhere.net/",), *((f"h{i}.net/{i}",) for i in range(0, 3000, 7))], "key string")
    got = {r.page_id: r for r in urls.filter_urls(pages, RULES, listed).collect()}
    assert len(got) == len(URLS) + len(many)
    keys = {r[0] for r in listed.collect()}
    for i, u in enumerate(URLS + many):
        rest = u.split("://", 1)[1] if u and "://" in u else None
        end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest)) if rest is not None else 0
        host = rest[:end].lower() if rest is not None else ""
        path = rest[end:].split("?")[0].split("#")[0] if rest is not None else ""
        own = [(h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule, verdict = max(own, key=lambda x: len(x[0])) if own else (None, "block" if host + path in keys else "allow")
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (host, path, rule, verdict), u
    assert urls.filter_urls(pages.limit(0), RULES, listed).count() == 0
    assert urls.filter_urls(pages, RULES).where("listed").count() == 0


def test_archives_read_back(spark):
    rnd = random.Random(1)
    same = "copy " * 400
    rows = [(i, f"http://a/{i}\r\n é", "".join(rnd.choice("abcé\n") for _ in range(rnd.randint(0, 3000)))) for i in range(150)]
    rows += [(500 + i, "http://b", same) for i in range(30)] + [(600, "u", "tiny"), (601, "u", "tiny"), (602, None, None), (603, "u", ""), (None, "u", same), (604, "u", "x" * 700_000), (605, "u", "q"), (605, "u", "q")]
    rnd.shuffle(rows)
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3).withColumn("digest", F.lit("mine"))
    archive = warc.write_archive(pages)
    got = warc.read_archive(archive).collect()
    assert len(got) == len(rows)
    last = 529
    for r in got:
        if r.page_id is not None and 500 <= r.page_id < last:
            assert (r.record_type, r.refers_to, r.payload_bytes) == ("revisit", last, len(same)) and r.payload == b""
            assert r.payload_digest == hashlib.sha1(same.encode()).hexdigest()
        else:
            html = next(h for i, _, h in rows if i == r.page_id) or ""
            assert (r.record_type, r.refers_to, r.payload_bytes, bytes(r.payload)) == ("response", None, len(html.encode()), html.encode())
    some = warc.read_records(archive, spark.createDataFrame([(3,), (604,), (510,)], "page_id long")).collect()
    assert sorted(r.page_id for r in some) == [3, 510, 604]
    assert warc.read_archive(warc.write_archive(pages.limit(0))).count() == 0


def test_bundles_are_plain_zstandard(spark):
    import zstandard

    archive = warc.write_archive(spark.createDataFrame([(1, "http://a", "hello")], "page_id long, url string, html string"))
    path = archive.index.first()["bundle"]
    raw = open(path.removeprefix("file:"), "rb").read()
    text = b"".join(zstandard.ZstdDecompressor().decompressobj().decompress(raw[a : a + n]) for a, n, _ in warc.Reader(path).frames)
    assert text.startswith(b"WARC/1.1\r\n") and b"hello" in text


def test_classifier_learns_held_out_labels(spark):
    rnd = random.Random(6)
    rows, labels = [], []
    for i in range(600):
        bad = i % 3 == 0
        word = (lambda: rnd.choice(WORDS).upper() + "!!") if bad else (lambda: rnd.choice(WORDS))
        lead = " ".join(rnd.choice(WORDS) for _ in range(rnd.choice([0, 0, 300])))
        rows.append((i, lead + " " + " ".join(word() for _ in range(150))))
        labels.append((i, 0 if bad else 1))
    labelled = spark.createDataFrame(labels + [(None, 0), (1, None)], "doc_id long, quality int")
    more = rows + [(9000, None), (9001, ""), (9002, "word " * 60000), (None, "x")]
    got = quality.classify(docs_frame(spark, more).withColumn("score", F.lit("mine")), labelled).collect()
    assert len(got) == len(more)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 600]
    assert len(held) > 100
    assert sum(r.predicted == (r.doc_id % 3 != 0) for r in held) / len(held) > 0.95
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality.classify(docs_frame(spark, more), none).collect()} == {0.5}
    assert quality.classify(docs_frame(spark, []), labelled).count() == 0


def test_gradients_are_right():
    """Against finite differences, in every parameter, and the score against a plain loop."""
    rng = np.random.default_rng(2)
    bags = [rng.normal(size=(n, quality.WIDTH)) for n in (1, 3, 2, 4, 1)]
    labels, weight = np.array([0.0, 1.0, 1.0, 0.0, 1.0]), rng.uniform(0.5, 2, 5)
    x, starts = np.concatenate(bags), np.array([0, 1, 4, 6, 10])
    own = np.repeat(np.arange(5), [len(b) for b in bags])
    shapes = {"v": (quality.WIDTH, quality.HIDDEN), "u": (quality.WIDTH, quality.HIDDEN), "w": quality.HIDDEN, "c": quality.WIDTH, "b": 1}
    p = {k: rng.normal(0, 0.3, n) for k, n in shapes.items()}
    loss, grads = quality.gradients(p, x, starts, own, labels, weight)
    plain = 0.0
    for bag, y, w in zip(bags, labels, weight, strict=True):
        energy = [float((np.tanh(r @ p["v"]) / (1 + np.exp(-(r @ p["u"])))) @ p["w"]) for r in bag]
        share = np.exp(energy) / np.exp(energy).sum()
        score = 1 / (1 + np.exp(-float(sum(a * r for a, r in zip(share, bag, strict=True)) @ p["c"] + p["b"][0])))
        plain -= w * (y * np.log(score) + (1 - y) * np.log(1 - score))
    assert loss == pytest.approx(plain)
    for name, grad in grads.items():
        for at in rng.integers(0, p[name].size, 12):
            ends = []
            for step in (1e-6, -1e-6):
                moved = p | {name: p[name].copy()}
                moved[name].flat[at] += step
                ends.append(quality.gradients(moved, x, starts, own, labels, weight)[0])
            assert np.asarray(grad).flat[at] == pytest.approx((ends[0] - ends[1]) / 2e-6, rel=1e-4, abs=1e-7), name


def test_held_out_accuracy_on_the_given_tables(spark):
    """Scores of rows that were not learned from, against their labels, on sf0.01."""
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.classify(docs.select("doc_id", "text"), labels).where("held_out").join(labels.select("doc_id", "quality"), "doc_id").collect()
    assert len(rows) > 50
    right = sum(r.predicted == r.quality for r in rows) / len(rows)
    most = max(sum(r.quality == y for r in rows) for y in (0, 1)) / len(rows)
    print(f"held out: {right:.3f} of {len(rows)}, the commoner label alone {most:.3f}")
    assert right > most


def test_learning_takes_whole_bags_or_none(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality, "fit", lambda bags, labels: seen.append((bags, labels)))
    rows = [(i, " ".join(WORDS[i : i + 30])) for i in range(40)] + [(50, " ".join(WORDS * 12)), (51, None)]
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, quality int")
    quality.learn(docs_frame(spark, rows), labels)
    want = [quality.passages(t or "") for i, t in rows if zlib.crc32(str(i).encode()) % 3 != 1]
    assert max(map(len, want)) > 60
    assert len(seen[0][0]) == len(want) and all((a == b).all() for a, b in zip(seen[0][0], want, strict=True))
    monkeypatch.setattr(quality, "MAX_PASSAGES", 50)
    quality.learn(docs_frame(spark, rows), labels)
    short = [x for x in want if len(x) <= 50]
    assert [len(b) for b in seen[1][0]] == [len(b) for b in short]


def test_partners_in_large_buckets_are_found(spark):
    """Members of one family share buckets but are no links of each other; each has one partner
    at a similarity just above the threshold, with which it alone shares its own words."""
    rnd = random.Random(12)
    fresh = lambda n: [f"x{rnd.randrange(10**9)}" for _ in range(n)]
    base, rows = fresh(300), []
    for i in range(150):
        own = list(base)
        for at in rnd.sample(range(10, 290, 14), 5):
            own[at : at + 6] = fresh(6)  # each block renews eight shingles
        partner = list(own)
        for at in rnd.sample(range(15, 290, 14), 2):
            partner[at : at + 6] = fresh(6)
        rows += [(2 * i, " ".join(own)), (2 * i + 1, " ".join(partner))]
    want = near_components(rows)
    pairs = [(2 * i, 2 * i + 1) for i in range(150) if want[2 * i][1] == want[2 * i + 1][1]]
    got = {r.doc_id: r.component_id for r in near_dup.near_duplicates(docs_frame(spark, rows)).collect()}
    assert len(pairs) > 100 and len({c for _, c in want.values()}) > 100
    found = sum(got[a] == got[b] for a, b in pairs) / len(pairs)
    print(f"partners found: {found:.3f} of {len(pairs)}")
    assert found >= 0.9
    assert all(got[i] >= want[i][1] for i in got)


def variant_rows(n, seed=5, length=880, places=80):
    """A group in which no shingle is rare: two variants of single words at some places, partners
    of which only some differ."""
    rnd = random.Random(seed)
    base = [f"w{rnd.randrange(10**9)}" for _ in range(length)]
    at = range(5, length - 5, (length - 10) // places)
    rows = []
    for i in range(n):
        own = list(base)
        chosen = [rnd.random() < 0.5 for _ in at]
        if i % 2:  # about seven of ten partners are links
            chosen = [c != (rnd.random() < 0.57) if k < 46 else c for k, c in enumerate(previous)]
        previous = chosen
        for k, c in zip(at, chosen, strict=False):
            if c:
                own[k] = f"v{k}"
        rows.append((i, " ".join(own)))
    return rows


@pytest.mark.parametrize("way", ["one task", "further keys", "blocks"])
def test_no_link_is_lost_without_rare_shingles(spark, monkeypatch, way):
    if way != "one task":
        monkeypatch.setattr(near_dup, "SMALL", 20)
    if way == "blocks":
        monkeypatch.setattr(near_dup, "LEAVES", 1e-9)
        monkeypatch.setattr(near_dup, "DENSE_SHINGLES", 30_000)
    rows = variant_rows(160)
    want = near_components(rows)
    assert 30 < len({c for _, c in want.values()}) < 150
    got = {r.doc_id: r.component_id for r in near_dup.near_duplicates(docs_frame(spark, rows)).collect()}
    assert got == {i: c for i, (_, c) in want.items()}


@pytest.mark.parametrize("size", [2000, 30])
def test_dense_buckets_of_one_centre_move_each_set_a_few_times(spark, monkeypatch, size):
    if hasattr(near_dup, "DENSE_SETS"):
        monkeypatch.setattr(near_dup, "DENSE_SETS", size)
    moved, compare = [], near_dup._Merger.sets_of

    def counted(self, buckets):
        moved.append(buckets.count())
        compare(self, buckets)

    monkeypatch.setattr(near_dup._Merger, "sets_of", counted)
    rows = variant_rows(160)
    want = near_components(rows)
    got = {r.doc_id: r.component_id for r in near_dup.near_duplicates(docs_frame(spark, rows)).collect()}
    assert got == {i: c for i, (_, c) in want.items()}
    assert 0 < sum(moved) <= 40 * len(rows)
