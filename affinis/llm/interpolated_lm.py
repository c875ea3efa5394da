"""Deleted interpolation: a bigram language model counted, tuned and applied on Spark.

p(w | v) = l0 / (V + 1) + l1 c(w) / N + l2 c(v, w) / c(v), with weights l that depend on how often the context v was seen
(one set for each doubling of c(v)). The weights come from expectation-maximisation on deleted counts: each
training token is held out of its own counts, so no part of the training set is lost to tuning.

How the corpus is counted: a task reads a unit of texts (at most UNIT bytes, or one longer text), hashes its words, and sends
the distinct words and word pairs of the unit, with their training counts, to buckets of the hash space, as sorted
compressed arrays. A bucket adds them up over all units and answers every unit with total counts in the order asked.
A word that makes up a third of all text is one entry a unit, so no bucket is hot. Each unit then has the counts of all its
tokens. For the weights, tokens are summed in cells of (context bucket, binned p1, binned p2); the grid of cells has a fixed size
(under a million) and is all that reaches the driver.

Defined cases: a null or empty text is the end token alone; a null id counts as the empty string in the split; repeated rows count
as often as they occur; with no training documents all counts are 0; an empty table gives no rows; words are told apart by
64-bit hashes, pairs by 40 bits within a bucket.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from affinis.llm.textscan import column_bytes, mix, word_hashes
from affinis.session import drop_folder, pin, scratch_dir, unpin

UNIT = 6 << 20
END = np.uint64(0x5851F42D4C957F2D)
PAIR = np.uint64(0xD6E8FEB86659FD93)
PAIR_BITS = 40
CONTEXTS, P_STEPS, P_BINS = 24, 8, 320
WORDS, PAIRS = 0, 1
SCORES = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def _zip(a: np.ndarray) -> bytes:
    """Compress an integer array, byte plane by byte plane."""
    import zstandard

    planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unzip(data: bytes, dtype) -> np.ndarray:
    import zstandard

    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(flat.reshape(size, -1).T).view(dtype).ravel()


def _gaps(a: np.ndarray) -> bytes:
    return _zip(np.diff(a, prepend=np.uint64(0)))


def _ungaps(data: bytes) -> np.ndarray:
    return np.cumsum(_unzip(data, np.uint64), dtype=np.uint64)


def _bucket_edges(buckets: int) -> np.ndarray:
    """First hash of each bucket but the first: equal stretches of the hash space."""
    return np.array([(k << 64) // buckets for k in range(1, buckets)], dtype=np.uint64)


def _pair_keys(hashes: np.ndarray, tokens: np.ndarray, counts: np.ndarray, buckets: int) -> np.ndarray:
    """Key of (previous token, token); the end token stands before the first of a text."""
    h = hashes[tokens]
    before = np.empty_like(h)
    before[1:] = h[:-1]
    before[np.concatenate([[0], np.cumsum(counts)[:-1]])] = END
    keys = mix(before * PAIR + h)
    # Within its bucket a key keeps its leading bits only; what is cut is made zero.
    shift = np.uint64(max(0, 64 - PAIR_BITS - max(1, (buckets - 1).bit_length())))
    return (keys >> shift) << shift


def held_out(doc_id) -> bool:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def _count(docs: DataFrame, buckets: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, str]:
    """Units with their tokens, and what they ask of the buckets; both below one written folder."""
    spark = docs.sparkSession

    def scan(batches):
        part, number, edges = TaskContext.get().partitionId(), 0, _bucket_edges(buckets)

        def unit(ids, texts):
            name = part * (1 << 24) + number
            hashes, n_words = word_hashes(texts)
            counts = n_words + 1
            at = np.cumsum(counts) - 1
            h = np.empty(len(hashes) + len(texts), dtype=np.uint64)
            inside = np.ones(len(h), dtype=bool)
            inside[at] = False
            h[inside], h[at] = hashes, END
            train = np.repeat([not held_out(i) for i in ids], counts)
            known, tokens = np.unique(h, return_inverse=True)
            pairs = _pair_keys(known, tokens, counts, buckets)
            rows = []
            for kind, keys, n in (
                (WORDS, known, np.bincount(tokens, weights=train, minlength=len(known))),
                (PAIRS, *_sum_by(pairs, train)),
            ):
                cut = [0, *np.searchsorted(keys, edges), len(keys)]
                for b in range(buckets):
                    if cut[b + 1] > cut[b]:
                        rows.append((kind, name, b, _gaps(keys[cut[b] : cut[b + 1]]), _zip(n[cut[b] : cut[b + 1]].astype(np.uint32)), None, None))
            doc_ids = pa.array(ids, pa.int64())
            rows.append((-1, name, -1, _gaps(known), _zip(tokens.astype(np.uint32)), _zip(counts.astype(np.uint32)), doc_ids.to_pylist()))
            kinds = (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64()))
            names = ("kind", "unit", "bucket", "keys", "counts", "lengths", "doc_ids")
            for lo in range(0, len(rows), 64):
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows[lo : lo + 64]), kinds)], names)

        ids, texts, size = [], [], 0
        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), column_bytes(batch.column(1))):
                if texts and size + len(t) > UNIT:
                    yield from unit(ids, texts)
                    ids, texts, size, number = [], [], 0, number + 1
                ids.append(i)
                texts.append(t)
                size += len(t)
        if texts:
            yield from unit(ids, texts)

    schema = "kind int, unit long, bucket int, keys binary, counts binary, lengths binary, doc_ids array<long>"
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    folder = scratch_dir(spark, "lm")
    slim.mapInArrow(scan, schema).withColumn("asks", F.col("kind") >= 0).write.partitionBy("asks").parquet(folder)
    parts = [spark.read.schema(schema).parquet(f"{folder}/asks={x}") if x in _values(spark, folder) else spark.createDataFrame([], schema) for x in ("false", "true")]
    return parts[0].select("unit", F.col("keys"), F.col("counts").alias("tokens"), "lengths", "doc_ids"), parts[1].select("kind", "unit", "bucket", "keys", "counts"), folder


def _values(spark, folder: str, column: str = "asks") -> set[str]:
    """The values of the partition column that were written."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    return {f.getPath().getName().removeprefix(f"{column}=") for f in found}


def _sum_by(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.empty(0, int)
    return k[first], np.add.reduceat(weights[order].astype(np.int64), first) if len(k) else np.empty(0, np.int64)


def _answer(table: pa.Table) -> pa.Table:
    """Totals of one bucket and kind, for each unit in the order it asked; a row with unit -1 has N and V."""
    units, kind, bucket = table["unit"].to_pylist(), table["kind"][0].as_py(), table["bucket"][0].as_py()
    keys = [_ungaps(k.as_py()) for k in table["keys"]]
    counts = [_unzip(c.as_py(), np.uint32) for c in table["counts"]]
    known, where = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(where, weights=np.concatenate(counts), minlength=len(known)).astype(np.int64)
    ends = np.cumsum([len(k) for k in keys])
    rows = [(kind, u, bucket, _zip(x), 0, 0) for u, x in zip(units, np.split(total[where], ends[:-1]))]  # totals outgrow 32 bits
    rows.append((kind, -1, bucket, b"", int(total.sum()), int((total > 0).sum())))
    kinds = (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64())
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["kind", "unit", "bucket", "counts", "n", "v"])


def _context_bucket(c: np.ndarray) -> np.ndarray:
    return np.minimum(np.floor(np.log2(np.maximum(c, 0) + 1.0)), CONTEXTS - 1).astype(np.int64)


def _bins(p: np.ndarray) -> np.ndarray:
    """0 for p = 0, else a bin of log2 p, P_STEPS to the octave."""
    with np.errstate(divide="ignore"):
        x = np.round(-np.log2(p) * P_STEPS)
    return np.where(p > 0, np.clip(x, 0, P_BINS - 2) + 1, 0).astype(np.int64)


def _before(c: np.ndarray, lengths: np.ndarray, of_end: int) -> np.ndarray:
    out = np.empty_like(c)
    out[1:] = c[:-1]
    out[np.concatenate([[0], np.cumsum(lengths)[:-1]])] = of_end
    return out


def learn_weights(cells: np.ndarray, counts: np.ndarray, p0: float, rounds: int = 60) -> np.ndarray:
    """Weights (context bucket, 3) by expectation-maximisation over cells (context, p1 bin, p2 bin)."""
    context, b1, b2 = (cells // P_BINS // P_BINS, cells // P_BINS % P_BINS, cells % P_BINS)
    p = np.stack(
        [np.full(len(cells), p0), *[np.where(b > 0, 2.0 ** (-(b - 1.0) / P_STEPS), 0.0) for b in (b1, b2)]], axis=1
    )
    weights = np.full((CONTEXTS, 3), 1 / 3)
    for _ in range(rounds):
        share = weights[context] * p
        share *= (counts / share.sum(axis=1))[:, None] if len(cells) else 1.0
        total = np.stack([np.bincount(context, share[:, j], CONTEXTS) for j in range(3)], axis=1)
        # Half a token for each part keeps unseen contexts defined and every word possible.
        weights = (total + 0.5) / (total + 0.5).sum(axis=1, keepdims=True)
    weights[0, :2] += weights[0, 2] / 2  # an unseen context has no pairs
    weights[0, 2] = 0.0
    return weights


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """SCORES of every document, by the model learned from the training part."""
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    units, asks, folder = _count(docs, buckets, id_col, text_col)
    answers = pin(
        asks.groupBy("kind", "bucket").applyInArrow(
            _answer, "kind int, unit long, bucket int, counts binary, n long, v long"
        )
    )
    drop_folder(spark, f"{folder}/asks=true")  # the answers are written
    sums = answers.where("unit = -1 AND kind = 0").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).first()
    n_train, vocabulary = sums["n"] or 0, sums["v"] or 0
    p0 = 1.0 / (vocabulary + 1)

    def look_up(left: pa.Table, right: pa.Table) -> pa.Table:
        unit = left.to_pylist()[0]
        known, tokens = _ungaps(unit["keys"]), _unzip(unit["tokens"], np.uint32)
        lengths = _unzip(unit["lengths"], np.uint32).astype(np.int64)
        found = {WORDS: [], PAIRS: []}
        for row in sorted(right.to_pylist(), key=lambda r: r["bucket"]):
            found[row["kind"]].append(_unzip(row["counts"], np.int64))
        c1 = np.concatenate(found[WORDS])
        of_end = int(c1[np.searchsorted(known, END)])
        c1 = c1[tokens]
        keys = _pair_keys(known, tokens, lengths, buckets)
        _, where = np.unique(keys, return_inverse=True)
        c2 = np.concatenate(found[PAIRS])[where]
        train = np.repeat([not held_out(i) for i in unit["doc_ids"]], lengths)
        cv = _before(c1, lengths, of_end)
        left_v, left_1, left_2 = cv[train] - 1, c1[train] - 1, c2[train] - 1
        p1 = left_1 / max(1, n_train - 1)
        p2 = np.where(left_v > 0, left_2 / np.maximum(left_v, 1), 0.0)
        cells, n = np.unique((_context_bucket(left_v) * P_BINS + _bins(p1)) * P_BINS + _bins(np.clip(p2, 0, 1)), return_counts=True)
        kinds = (pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.binary(), pa.binary())
        row = (unit["doc_ids"], _zip(lengths.astype(np.uint32)), _zip(c1), _zip(c2), of_end, _zip(cells), _zip(n))
        return pa.Table.from_arrays([pa.array([c], k) for c, k in zip(row, kinds)], ["doc_ids", "lengths", "c1", "c2", "of_end", "cells", "n"])

    looked = pin(
        units.groupBy("unit")
        .cogroup(answers.where("unit >= 0").groupBy("unit"))
        .applyInArrow(look_up, "doc_ids array<long>, lengths binary, c1 binary, c2 binary, of_end long, cells binary, n binary")
    )
    drop_folder(spark, folder)
    unpin(answers)

    def list_cells(batches):
        for batch in batches:
            for cells, n in zip(batch.column(0), batch.column(1)):
                yield pa.RecordBatch.from_arrays([pa.array(_unzip(cells.as_py(), np.int64)), pa.array(_unzip(n.as_py(), np.int64))], ["cell", "n"])

    cells = looked.select("cells", "n").mapInArrow(list_cells, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    table = cells.toPandas().sort_values("cell")
    weights = learn_weights(table["cell"].to_numpy(np.int64), table["n"].to_numpy(np.float64), p0)

    def apply(batches):
        for batch in batches:
            for unit in batch.to_pylist():
                lengths = _unzip(unit["lengths"], np.uint32).astype(np.int64)
                c1, c2 = (_unzip(unit[c], np.int64).astype(np.float64) for c in ("c1", "c2"))
                cv = _before(c1, lengths, unit["of_end"])
                w = weights[_context_bucket(cv)]
                p = w[:, 0] * p0 + w[:, 1] * (c1 / max(1, n_train)) + w[:, 2] * np.where(cv > 0, c2 / np.maximum(cv, 1), 0.0)
                first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
                base = np.log10((c1 + 1) / (n_train + vocabulary + 1))
                ids = unit["doc_ids"]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64()),
                        pa.array([held_out(i) for i in ids]),
                        pa.array(lengths),
                        pa.array(np.add.reduceat((c1 > 0).astype(np.int64), first)),
                        pa.array(np.full(len(ids), n_train, dtype=np.int64)),
                        pa.array(np.add.reduceat(base, first)),
                        pa.array(np.add.reduceat(np.log10(p), first)),
                    ],
                    [c.split()[0] for c in SCORES.split(", ")],
                )

    return looked.select("doc_ids", "lengths", "c1", "c2", "of_end").mapInArrow(apply, SCORES)
