"""Harmonic packing of token sequences.

Class k takes lengths in (capacity / (k + 1), capacity / k]; its bins hold exactly k pieces, so a piece's bin follows
from its rank in the class alone and every worker fills bins without looking at others. To leave little padding, a
remainder that would waste more than `slack` of its share is cut: capacity // (k + 1) tokens go to class k + 1 and
the rest is classed again (each cut shrinks the rest quadratically). Rests of at most capacity / CLASSES tokens are small:
laid end to end, those that start in the same stretch of capacity - small + 1 tokens share a bin. The
ranks come from counts of each class in each partition (prefix sums). What is left over in the last, incomplete bin of each
class is at most CLASSES * CLASSES / 2 pieces and one small bin, whatever the input; these are packed first-fit decreasing.

Defined cases: a null or empty text is the end id alone; repeated rows are packed as often as they occur; null ids stay
null; an empty table gives no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from affinis.llm.tokens import encoded
from affinis.session import pin

CAPACITY, CLASSES = 4096, 64
PIECE = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part long, class int, rank long, ahead long"
)


def cut(length: int, capacity: int = CAPACITY, classes: int = CLASSES, slack: float = 0.01) -> list[tuple[int, int]]:
    """(piece length, class) of one document, in order; class 0 is the small one."""
    out = [(capacity, 1)] * (length // capacity)
    rest = length % capacity
    small = capacity // classes
    while rest:
        if rest <= small:
            out.append((rest, 0))
            break
        k = capacity // rest
        share = capacity // k
        if share - rest <= slack * share:
            out.append((rest, k))
            break
        piece = capacity // (k + 1)
        out.append((piece, 0 if piece <= small else k + 1))
        rest -= piece
    return out


def pieces(
    docs: DataFrame, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False
) -> DataFrame:
    """Encode and cut each document; PIECE, with the piece's rank (and, if small, the tokens ahead) in its partition."""

    def build(batches):
        part = TaskContext.get().partitionId()
        count, ahead = [0] * (CLASSES + 1), 0
        for batch in batches:
            doc_ids, rows, kept = batch.column(0), [], []
            for row, ids in encoded(batch, 1, tokenizer_path, end_id):
                doc_id, start, total = doc_ids[row].as_py(), 0, len(ids) // 4
                for length, k in cut(total):
                    own = ids[4 * start : 4 * (start + length)]
                    rows.append((doc_id, start, length, zlib.crc32(own), total, part, k, count[k], ahead if k == 0 else 0))
                    if with_ids:
                        kept.append(own)
                    count[k] += 1
                    ahead += length if k == 0 else 0
                    start += length
            columns = list(zip(*rows)) if rows else [[]] * 9
            arrays = [pa.array(c, pa.int32() if j == 6 else pa.int64()) for j, c in enumerate(columns)]
            names = [c.split()[0] for c in PIECE.split(", ")]
            yield pa.RecordBatch.from_arrays(
                arrays + ([pa.array(kept, pa.binary())] if with_ids else []), names + (["ids"] if with_ids else [])
            )

    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return slim.mapInArrow(build, PIECE + (", ids binary" if with_ids else ""))


def first_fit(lengths: list[int], capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(bin, offset) of each of a bounded number of pieces, largest first."""
    fill, place = [], [(0, 0)] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        b = next((b for b, used in enumerate(fill) if used + lengths[i] <= capacity), len(fill))
        if b == len(fill):
            fill.append(0)
        place[i] = (b, fill[b])
        fill[b] += lengths[i]
    return place


def pack(cut_pieces: DataFrame) -> DataFrame:
    """The pieces with sequence_id and offset; `cut_pieces` comes from `pieces` and is written once here."""
    held = pin(cut_pieces)
    span = CAPACITY - CAPACITY // CLASSES + 1
    counts = held.groupBy("part", "class").agg(F.count("*").alias("n"), F.sum("length").alias("tokens"))
    before = W.partitionBy("class").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    counts = pin(
        counts.select(
            "part",
            "class",
            "n",
            "tokens",
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n_before"),
            F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("tokens_before"),
        )
    )
    # One row a class: how many full bins it has, and where its sequence ids begin.
    totals = {r["class"]: (r["n"], r["tokens"]) for r in counts.groupBy("class").agg(F.sum("n").alias("n"), F.sum("tokens").alias("tokens")).collect()}
    base, next_id, full = {}, 0, {}
    for k in sorted(totals):
        full[k] = totals[k][0] // k if k else totals[k][1] // span
        base[k] = next_id
        next_id += full[k]
    spark = held.sparkSession
    bounds = F.broadcast(spark.createDataFrame([(k, base[k], full[k]) for k in totals], "class int, base long, full long"))
    at = F.col("n_before") + F.col("rank")
    placed = (
        held.join(counts.drop("n", "tokens"), ["part", "class"])
        .join(bounds, "class")
        .withColumn(
            "bin",
            F.when(F.col("class") == 0, F.floor((F.col("tokens_before") + F.col("ahead")) / span)).otherwise(
                F.floor(at / F.greatest(F.col("class"), F.lit(1)))
            ),
        )
        .withColumn("order", F.when(F.col("class") == 0, F.col("tokens_before") + F.col("ahead")).otherwise(at))
        .drop("n_before", "tokens_before", "rank", "ahead", "part")
    )
    inside = W.partitionBy("class", "bin").orderBy("order").rowsBetween(W.unboundedPreceding, -1)
    whole = placed.where("bin < full").select(
        "*",
        (F.col("base") + F.col("bin")).alias("sequence_id"),
        F.coalesce(F.sum("length").over(inside), F.lit(0)).alias("offset"),
    )
    extra = [c for c in held.columns if c == "ids"]
    kept = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", *extra]

    def rest(batches):
        frame = pd.concat(list(batches) or [pd.DataFrame(columns=["length"])])
        frame = frame.sort_values(["class", "order"], kind="stable") if len(frame) else frame
        place = first_fit(frame["length"].tolist())
        frame = frame.assign(sequence_id=[next_id + b for b, _ in place], offset=[o for _, o in place])
        if len(frame):
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            yield frame[[*kept, "sequence_id", "offset"]]

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + (", ids binary" if extra else "")
    left = (
        placed.where("bin >= full").coalesce(1).mapInPandas(rest, f"{schema}, sequence_id long, offset long")
    )
    return whole.select(*kept, "sequence_id", "offset").unionByName(left)


def assemble(packed: DataFrame, pad_id: int = 0) -> DataFrame:
    """sequence_id, n_tokens, ids: the padded sequences (32-bit little-endian); needs pieces with ids.

    A sequence is padded to the capacity unless its length is a power of two.
    """

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("offset")
        ids = np.frombuffer(b"".join(pdf["ids"]), dtype="<u4")
        size = len(ids) if len(ids) & (len(ids) - 1) == 0 else CAPACITY
        out = np.concatenate([ids, np.full(size - len(ids), pad_id, dtype="<u4")])
        return pd.DataFrame({"sequence_id": [pdf["sequence_id"].iloc[0]], "n_tokens": [len(ids)], "ids": [out.tobytes()]})

    return packed.groupBy("sequence_id").applyInPandas(build, "sequence_id long, n_tokens long, ids binary")
