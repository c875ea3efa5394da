"""Product codes of vectors in whole numbers, by per-dimension value dictionaries.

1. Components become floor(256 * x). Blocks of vectors are written once as dictionary codes: for every dimension the distinct
   integers of the block, ascending, and a 16-bit index into them per vector.
2. In a round, for every dimension the squared differences of all its distinct integers to all codebook entries are tabulated; a
   part's distances are then gathers of table rows by code, added over the part's dimensions. No difference is formed per vector.
3. The same codes give the sums for new entries: counts of (entry, code) times the dictionary. Tasks add up their blocks and send at
   most entries x dimensions rows, which are summed before and after the shuffle.
4. Codebooks (entries x dimensions integers, a size set by parameters) are all that passes through the driver.

Results do not depend on partitioning: everything is whole numbers, ties go to the lower index.

Rows with a null vector, or null or non-finite components, are dropped. Vectors shorter than the longest, or than a multiple of `parts`,
count as if they ended in zeros. Null ids come after all others when the first entries are chosen, equal ids in order of their
vectors; repeated rows are vectors of their own. With fewer vectors than entries the codebooks are shorter; an empty table gives no
rows. Components beyond +-2**27 in whole numbers raise an ArithmeticError, as squared distances would not fit a long. Other columns
may have any name.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinis.llm.common import attach
from affinis.session import pin

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
BLOCK_ROWS = 4_096  # vectors a block; their codes fit 16 bits
LARGEST = 1 << 27

_BLOCK = "width int, ids array<long>, labels array<string>, dictionaries array<binary>, codes array<binary>"


def finite_rows(table: DataFrame, vector: str) -> DataFrame:
    """The rows whose vector has only finite components."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf")))
    )
    return table.filter(F.col(vector).isNotNull() & finite)


def _whole(column: pa.ListArray) -> np.ndarray:
    """floor(256 * x) of a list column, as rows of one width filled up with zeros."""
    offsets = np.asarray(column.offsets, dtype=np.int64)
    values = np.asarray(column.values, dtype=np.float64)[offsets[0] : offsets[-1]]
    lengths = np.diff(offsets)
    found = np.floor(values * SCALE)
    if len(found) and np.abs(found).max() > LARGEST:
        raise ArithmeticError(f"a component exceeds {LARGEST} in whole numbers")
    out = np.zeros((len(lengths), int(lengths.max(initial=0))), dtype=np.int64)
    out[np.arange(out.shape[1]) < lengths[:, None]] = found.astype(np.int64)
    return out


def _coded(rows: np.ndarray) -> tuple[list[bytes], list[bytes]]:
    dictionaries, codes = [], []
    for column in rows.T:
        values, at = np.unique(column, return_inverse=True)
        dictionaries.append(values.astype("<i8").tobytes())
        codes.append(at.astype("<u2").tobytes())
    return dictionaries, codes


def dictionary_blocks(kept: DataFrame, vec_id: str, vector: str, label: str) -> DataFrame:
    """Blocks of at most `BLOCK_ROWS` vectors as dictionary codes, written once."""

    def blocks(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(start, BLOCK_ROWS)
                column = part.column(2)
                rows = _whole(column)
                dictionaries, codes = _coded(rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([rows.shape[1]], pa.int32()),
                        pa.array([part.column(0).to_pylist()], pa.list_(pa.int64())),
                        pa.array([part.column(1).to_pylist()], pa.list_(pa.string())),
                        pa.array([dictionaries], pa.list_(pa.binary())),
                        pa.array([codes], pa.list_(pa.binary())),
                    ],
                    names=["width", "ids", "labels", "dictionaries", "codes"],
                )

    slim = kept.select(
        F.col(vec_id).cast("long"), F.col(label).cast("string"), F.col(vector).cast("array<double>").alias("v")
    )
    return pin(slim.mapInArrow(blocks, _BLOCK))


class Block:
    """One block's dictionaries and codes, and its nearest entries under given codebooks."""

    def __init__(self, dictionaries: list[bytes], codes: list[bytes], n: int, width: int):
        none, zeros = np.zeros(1, dtype=np.int64), np.zeros(n, dtype=np.uint16)
        missing = width - len(codes)
        self.values = [np.frombuffer(d, "<i8") for d in dictionaries] + [none] * missing
        self.codes = [np.frombuffer(c, "<u2") for c in codes] + [zeros] * missing
        self.n = n

    def nearest(self, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(parts, n) entry indexes and squared distances; `books` is (parts, entries, dimensions of a part)."""
        parts, entries, size = books.shape
        index, distance = np.empty((parts, self.n), dtype=np.int64), np.empty((parts, self.n), dtype=np.int64)
        for p in range(parts):
            total = np.zeros((self.n, entries), dtype=np.int64)
            for k in range(size):
                d = p * size + k
                table = np.square(self.values[d][:, None] - books[p, :, k])
                total += table[self.codes[d]]
            index[p] = total.argmin(axis=1)
            distance[p] = np.take_along_axis(total, index[p][:, None], axis=1)[:, 0]
        return index, distance

    def sums(self, index: np.ndarray, entries: int) -> tuple[np.ndarray, np.ndarray]:
        """(parts, entries) counts and (dimensions, entries) component sums of the vectors assigned to each entry."""
        size = len(self.codes) // len(index)
        counts = np.stack([np.bincount(i, minlength=entries) for i in index])
        totals = np.empty((len(self.codes), entries), dtype=np.int64)
        for d, (values, codes) in enumerate(zip(self.values, self.codes)):
            at = index[d // size] * len(values) + codes
            totals[d] = np.bincount(at, minlength=entries * len(values)).reshape(entries, -1) @ values
        return counts, totals


def _blocks(batch):
    for width, ids, labels, dictionaries, codes in zip(*(batch.column(i) for i in range(5))):
        yield ids.as_py(), labels.as_py(), dictionaries.as_py(), codes.as_py()


def _replaced(blocks: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round."""
    parts, entries, size = books.shape
    width = parts * size

    def add(batches):
        counts, totals = np.zeros((parts, entries), dtype=np.int64), np.zeros((width, entries), dtype=np.int64)
        for batch in batches:
            for ids, _, dictionaries, codes in _blocks(batch):
                block = Block(dictionaries, codes, len(ids), width)
                c, t = block.sums(block.nearest(books)[0], entries)
                counts, totals = counts + c, totals + t
        d, e = np.nonzero(np.repeat(counts, size, axis=0))
        yield pa.RecordBatch.from_pydict(
            {"d": pa.array(d, pa.int32()), "e": pa.array(e, pa.int32()), "n": counts[d // size, e], "s": totals[d, e]}
        )

    sums = blocks.mapInArrow(add, "d int, e int, n long, s long").groupBy("d", "e").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    out = books.copy()
    for r in sums.collect():  # at most entries x dimensions rows
        out[r["d"] // size, r["e"], r["d"] % size] = r["s"] // r["n"]
    return out


def first_entries(kept: DataFrame, vec_id: str, vector: str, entries: int, parts: int, width: int) -> np.ndarray:
    """The parts of the vectors with the smallest ids; `entries` rows reach the driver."""
    rows = kept.select(F.col(vec_id).cast("long").alias("i"), F.col(vector).cast("array<double>").alias("v"))
    first = rows.orderBy(F.asc_nulls_last("i"), "v").limit(entries).collect()
    out = np.zeros((len(first), width), dtype=np.int64)
    for k, r in enumerate(first):
        out[k, : len(r["v"])] = np.floor(np.array(r["v"], dtype=np.float64) * SCALE)
    return out.reshape(len(first), parts, width // parts).transpose(1, 0, 2)


def train(blocks: DataFrame, books: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    for _ in range(rounds):
        books = _replaced(blocks, books)
    return books


def encode(blocks: DataFrame, books: np.ndarray) -> DataFrame:
    """vec_id, label (as text), code (two hex digits a part), error of every vector."""
    parts, _, size = books.shape

    def code(batches):
        digits = np.array([f"{k:02x}" for k in range(256)])
        for batch in batches:
            for ids, labels, dictionaries, codes in _blocks(batch):
                index, distance = Block(dictionaries, codes, len(ids), parts * size).nearest(books)
                yield pa.RecordBatch.from_pydict(
                    {
                        "vec_id": pa.array(ids, pa.int64()),
                        "label": pa.array(labels, pa.string()),
                        "code": pa.array(["".join(row) for row in digits[index.T].tolist()], pa.string()),
                        "error": pa.array(distance.sum(axis=0), pa.int64()),
                    }
                )

    return blocks.mapInArrow(code, "vec_id long, label string, code string, error long")


def books_sha256(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def compress(
    table: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """vec_id, code, error, label_error (summed over equal labels, nulls together), codebooks_sha256 of every kept vector."""
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits: 1 to 256 entries")
    kept = finite_rows(table, vector)
    blocks = dictionary_blocks(kept, vec_id, vector, label)
    longest = blocks.agg(F.max("width")).first()[0]
    if longest is None:
        return table.sparkSession.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    width = -(-longest // parts) * parts
    books = train(blocks, first_entries(kept, vec_id, vector, entries, parts, width), rounds)
    coded = pin(encode(blocks, books))
    per_label = pin(coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("n")))
    return attach(coded, per_label, "label", "n").select(
        "vec_id", "code", "error", "label_error", F.lit(books_sha256(books)).alias("codebooks_sha256")
    )
