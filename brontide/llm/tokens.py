"""Token counts behind a digest cache.

The digest of a text (null: empty; the text as it is, as any folding would change counts) and
the digest of the tokenizer file name a stored count. Only distinct texts without a stored
count are encoded; their counts are appended to the cache, and all rows read theirs from it.
Digests are looked up before any text crosses the network, so a run that finds all counts
stored encodes and shuffles no text.

Defined results: null and empty texts have 0 tokens; repeated rows each get their count; an
empty table gives no rows; result columns replace input columns of the same name. Two runs
that append the same digest store it twice; readers take one. A very long text costs memory
for its segments, some MB of text at a time.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brontide.llm.common import free_names, release, shared_folder, text_of, written

CACHE = T.StructType(
    [
        T.StructField("tokenizer", T.StringType()),
        T.StructField("digest", T.BinaryType()),
        T.StructField("n_tokens", T.LongType()),
    ]
)
#: Counts of segments that a worker process keeps; it starts again when full.
MEMO_ENTRIES = 200_000
MEMO_CHARS = 40
#: Up to so many digests without a count are broadcast to the texts.
BROADCAST_DIGESTS = 500_000
#: Digests of more rows than this are looked up by broadcast.
HOT_COPIES = 1000
#: Characters of text whose segments are held at once.
GROUP_CHARS = 2_000_000

_SEGMENT = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
_OTHER_SPACE = re.compile(r"[^\S \n]")


class Counter:
    """Counts tokens with the library, by segments where that gives the library's own result.

    A byte-level pre-tokenizer never puts white space behind other characters into one token,
    so a text whose only white space is blanks and line ends can be cut before each run of
    them. Texts with other white space or with an added token's string, and all texts of
    other tokenizers, go to the library whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.memo: dict[str, int] = {}
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        before = repr(self.library.pre_tokenizer)
        self.by_segments = self.library.normalizer is None and before.startswith("ByteLevel(add_prefix_space=False") and "use_regex=True" in before

    def whole(self, texts: list[str]) -> list[int]:
        return [len(e.ids) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def counts(self, texts: list[str]) -> list[int]:
        """Texts are taken some MB at a time, so that their segments fit in memory."""
        out: list[int] = []
        group: list[str] = []
        chars = 0
        for text in texts:
            group.append(text)
            chars += len(text)
            if chars > GROUP_CHARS:
                out += self._group(group)
                group, chars = [], 0
        return out + self._group(group)

    def _group(self, texts: list[str]) -> list[int]:
        cut = [self.by_segments and not _OTHER_SPACE.search(t) and not any(a in t for a in self.added) for t in texts]
        segments = [_SEGMENT.findall(t) if c else [t] for t, c in zip(texts, cut, strict=True)]
        if len(self.memo) > MEMO_ENTRIES:
            self.memo.clear()
        memo = self.memo
        unknown = list({s for own in segments for s in own if s not in memo})
        memo.update(zip(unknown, self.whole(unknown), strict=True))
        out = [sum(map(memo.__getitem__, own)) for own in segments]
        for s in unknown:
            if len(s) > MEMO_CHARS:
                del memo[s]
        return out


_COUNTERS: dict[str, Counter] = {}


def _counted(path: str):
    @F.arrow_udf("bigint")
    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if path not in _COUNTERS:
            _COUNTERS[path] = Counter(path)
        for texts in batches:
            yield pa.array(_COUNTERS[path].counts(texts.to_pylist()), pa.int64())
        release(_COUNTERS[path].memo)

    return counted


def tokenizer_digest(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def count_tokens(docs: DataFrame, tokenizer_path: str, cache_path: str | None = None, text_col: str = "text") -> DataFrame:
    """docs with text_digest (binary SHA-256), n_bytes and n_tokens.

    tokenizer_path: a tokenizers .json that is installed on every machine. cache_path: a
    folder all machines share; by default that of this library in the shared folder, which
    outlives the run.
    """
    spark = docs.sparkSession
    version = tokenizer_digest(tokenizer_path)
    cache_path = cache_path or f"{shared_folder(spark)}/brontide/token-cache"
    # An empty append makes the cache readable before its first use.
    spark.createDataFrame([], CACHE).write.mode("append").parquet(cache_path)

    def stored() -> DataFrame:
        own = spark.read.schema(CACHE).parquet(cache_path).where(F.col("tokenizer") == version)
        return own.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))

    digest = F.unhex(F.sha2(text_of(text_col).cast("binary"), 256))
    counts = written(docs.select(digest.alias("digest")).groupBy("digest").agg(F.count("*").alias("copies")), "digests")
    misses = written(counts.join(stored(), "digest", "left_anti").select("digest"), "misses")
    n = misses.count()
    if n:
        texts = docs.select(digest.alias("digest"), text_of(text_col).alias("text"))
        if n < counts.count():
            texts = texts.join(F.broadcast(misses) if n <= BROADCAST_DIGESTS else misses, "digest", "left_semi")
        new = texts.dropDuplicates(["digest"]).select(F.lit(version).alias("tokenizer"), "digest", _counted(tokenizer_path)("text").alias("n_tokens"))
        new.write.mode("append").parquet(cache_path)
    # Counts of digests with many rows are broadcast, so that no task gets all rows of one; there
    # are at most rows / HOT_COPIES of them. Their rows join the rest by a value of their own.
    known = stored()
    hot = counts.where(F.col("copies") > HOT_COPIES).select("digest").join(known, "digest").select(F.col("digest").alias("hot_digest"), F.col("n_tokens").alias("hot_tokens"))
    hot_digest, hot_tokens, key, cold = free_names(docs, "hot_digest", "hot_tokens", "digest_key", "cold_tokens")
    hot = hot.toDF(hot_digest, hot_tokens)
    rows = docs.drop("n_tokens").withColumns({"text_digest": digest, "n_bytes": F.octet_length(text_of(text_col)).cast("long")})
    rows = rows.join(F.broadcast(hot), F.col("text_digest") == F.col(hot_digest), "left")
    alone = F.encode(F.concat(F.lit("row "), F.monotonically_increasing_id()), "UTF-8")
    rows = rows.withColumn(key, F.when(F.col(hot_tokens).isNull(), F.col("text_digest")).otherwise(alone))
    out = rows.join(known.toDF(key, cold), key, "left").withColumn("n_tokens", F.coalesce(hot_tokens, cold))
    return out.drop(key, hot_digest, hot_tokens, cold)
