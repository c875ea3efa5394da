"""Importance resampling towards a target distribution, over hashed word and word-pair counts.

1. The tokenizers library cuts ASCII-lowered text into words with offsets: an untrained `Split` on a regex, nothing else of a
   tokenizer. Windows of one and of two neighbouring offset pairs are the features; a feature's bucket is its CRC-32 modulo `BUCKETS`.
   A pair's CRC goes on from its first word's, so no pair is ever joined.
2. A document is written once as its buckets, 16 bits a feature. From there each task adds up one histogram and sends at most
   `BUCKETS` rows; the same is done for the target texts.
3. The gains of the buckets, `BUCKETS` whole numbers, travel with the tasks; a document's weight is the floored mean of the gains
   over its features, a gather and a sum. The score adds Gumbel noise drawn from the id alone.
4. The share of highest scores among documents of `LEAST_WORDS` words or more is drawn by numbering them: range slices by score,
   written in order. No window and no task holds the whole table.

Null and empty texts have no features, weight 0, and are never drawn; a null id draws the noise of an empty one and loses ties.
Repeated rows are documents of their own; their ranks follow one another. Texts are read whole, however long. An empty table
gives no rows, an empty target no difference between buckets that the corpus fills alike. Other columns may have any name.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinis.functions.ordering import numbered
from affinis.llm.textscan import LOWERED, column_bytes
from affinis.session import pin

# What separates words once A-Z are lowered, the number of buckets, the noise's seed, and who is drawn.
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
SEED = 7
LEAST_WORDS, PERCENT = 20, 25
CACHED_WORDS = 200_000

_HASHED = "doc_id long, n_words long, buckets binary"


class Features:
    """Buckets of the features of texts; the CRCs of frequent words are kept."""

    def __init__(self):
        from tokenizers import Regex
        from tokenizers.pre_tokenizers import Split

        self.split = Split(Regex(BETWEEN_WORDS), "removed")
        self.known: dict[str, tuple[int, int, bytes]] = {}

    def _word(self, word: str) -> tuple[int, int, bytes]:
        """CRC and bucket of a word, and the bytes that it adds to a pair as second word."""
        data = word.encode()
        crc = zlib.crc32(data)
        found = crc, crc % BUCKETS, b" " + data
        if len(data) <= 64:
            if len(self.known) >= CACHED_WORDS:
                self.known.clear()
            self.known[word] = found
        return found

    def words(self, text: bytes) -> list[tuple[str, tuple[int, int]]]:
        """Words of the ASCII-lowered text with their offsets in characters."""
        return self.split.pre_tokenize_str(text.translate(LOWERED).decode())

    def buckets(self, text: bytes) -> tuple[int, bytes]:
        """Number of words, and the buckets of all words and pairs as 16-bit numbers."""
        out, known, crc32, before = array("H"), self.known, zlib.crc32, None
        add = out.append
        pairs = self.words(text)
        for word, _ in pairs:
            crc, bucket, tail = known.get(word) or self._word(word)
            add(bucket)
            if before is not None:
                add(crc32(tail, before) % BUCKETS)
            before = crc
        return len(pairs), out.tobytes()


def hashed(docs: DataFrame, id_col: str | None, text_col: str) -> DataFrame:
    """doc_id, n_words and the feature buckets of every text, written once with a `uid` for each row."""

    def scan(batches):
        features = Features()
        for batch in batches:
            counts, found = [], []
            for text in column_bytes(batch.column(1)):
                n, buckets = features.buckets(text)
                counts.append(n)
                found.append(buckets)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(found, pa.binary())], names=["doc_id", "n_words", "buckets"]
            )

    ident = F.col(id_col).cast("long") if id_col else F.lit(None).cast("long")
    slim = docs.select(ident.alias("doc_id"), F.col(text_col).alias("text"))
    return pin(slim.mapInArrow(scan, _HASHED).withColumn("uid", F.monotonically_increasing_id()))


def histogram(texts: DataFrame) -> np.ndarray:
    """Number of features in each bucket; `BUCKETS` sums reach the driver, whatever the size of the table."""

    def count(batches):
        total = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            for buckets in batch.column(0):
                total += np.bincount(np.frombuffer(buckets.as_buffer(), np.uint16), minlength=BUCKETS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(at, pa.int32()), "n": total[at]})

    sums = texts.select("buckets").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS, dtype=np.int64)
    for r in sums.collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed target and source shares, a whole number a bucket."""
    all_s, all_t = float(source.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array(
        [math.floor(1000 * math.log((t + 1) * all_s / ((s + 1) * all_t))) for s, t in zip(map(float, source), map(float, target))],
        dtype=np.int64,
    )


def noise(doc_id: int | None) -> int:
    """Thousandths of a Gumbel draw from the id."""
    h = int(hashlib.sha256(f"{SEED}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weighed(texts: DataFrame, gain: np.ndarray) -> DataFrame:
    """uid, doc_id, n_words, n_features, weight, score of every hashed text."""

    def weigh(batches):
        for batch in batches:
            n, weights = [], []
            for buckets in batch.column(2):
                at = np.frombuffer(buckets.as_buffer(), np.uint16)
                n.append(len(at))
                weights.append(int(gain[at].sum()) // len(at) if len(at) else 0)
            scores = [w + noise(i) for w, i in zip(weights, batch.column(0).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(3), batch.column(0), batch.column(1), *[pa.array(x, pa.int64()) for x in (n, weights, scores)]],
                names=["uid", "doc_id", "n_words", "n_features", "weight", "score"],
            )

    return texts.select("doc_id", "n_words", "buckets", "uid").mapInArrow(
        weigh, "uid long, doc_id long, n_words long, n_features long, weight long, score long"
    )


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text: str = "text",
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every document; rank is null for those not drawn."""
    texts = hashed(docs, id_col, text_col)
    gain = gains(histogram(texts), histogram(hashed(target, None, target_text)))
    scored = pin(weighed(texts, gain))
    columns = ["doc_id", "n_features", "weight", "score"]
    able = F.col("n_words") >= least_words
    open_to = scored.filter(able).select("uid", *columns)
    drawn = open_to.count() * percent // 100
    ranked = numbered(open_to, [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("uid")], "at")
    rank = F.when(F.col("at") < drawn, F.col("at") + 1).cast("long").alias("rank")
    return ranked.select(*columns, rank).unionByName(
        scored.filter(~able).select(*columns, F.lit(None).cast("long").alias("rank"))
    )
