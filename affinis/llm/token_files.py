"""Token ids as flat binary files that are memory-mapped when read.

Format of one part: `<name>.bin` holds the ids of its documents one after another, little-endian, 16 bits where the
vocabulary fits, else 32; `<name>.idx` holds, as little-endian 64-bit numbers, the count n, the n document ids, and
n + 1 offsets (in ids, from 0) of the documents in the part. Parts follow the order of document ids, so a part's base
is the sum of the parts before it.

Files go to a folder that all executors share, under names of their own for every attempt; a part counts only when
its task's row of the manifest was committed, so lost or repeated tasks leave nothing but unread files. Only the manifest,
one row a file, passes the driver.

Defined cases: a null or empty text gives the end id alone; null document ids come first and are marked in a third
file section; repeated rows are stored as often as they occur; an empty table gives no rows.
"""

from __future__ import annotations

import tempfile
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from affinis.llm.tokens import encoded, encoder
from affinis.session import pin, scratch_dir

MANIFEST = "part long, name string, n_docs long, n_ids long, width int"


def _file_system(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("/") else f"file://{folder}")


def write_token_files(
    docs: DataFrame, tokenizer_path: str, end_id: int, folder: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Write the files and return the committed manifest (MANIFEST), one row a part."""

    def write(batches):
        store, root = _file_system(folder)
        store.create_dir(root, recursive=True)
        coder = encoder(tokenizer_path)
        width = 2 if coder.vocab_size <= 1 << 16 and end_id < 1 << 16 else 4
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}"
        ids, nulls, lengths = [], [], []
        with store.open_output_stream(f"{root}/{name}.bin") as out:
            for batch in batches:
                column = batch.column(0)
                nulls.append(np.asarray(column.is_null()))
                ids.append(column.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"))
                for _, found in encoded(batch, 1, tokenizer_path, end_id):
                    lengths.append(len(found) // 4)
                    out.write(found if width == 4 else np.frombuffer(found, "<u4").astype("<u2").tobytes())
        if not lengths:
            return
        offsets = np.concatenate([[0], np.cumsum(lengths)]).astype("<i8")
        with store.open_output_stream(f"{root}/{name}.idx") as out:
            out.write(np.array([len(lengths)], dtype="<i8").tobytes())
            out.write(np.concatenate(ids).tobytes())
            out.write(offsets.tobytes())
            out.write(np.concatenate(nulls).astype("u1").tobytes())
        yield pa.RecordBatch.from_pydict(
            {"part": [part], "name": [name], "n_docs": [len(lengths)], "n_ids": [int(offsets[-1])], "width": pa.array([width], pa.int32())}
        )

    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    ordered = slim.repartitionByRange("id", F.xxhash64("text")).sortWithinPartitions("id", F.xxhash64("text"))
    return pin(ordered.mapInArrow(write, MANIFEST))


def with_bases(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """The manifest and `base`, the ids in the parts before; one row a part, each in a task of its own."""
    rows, base, out = sorted(manifest.collect(), key=lambda r: r["part"]), 0, []
    for r in rows:
        out.append((*r, base))
        base += r["n_ids"]
    return spark.createDataFrame(out, f"{MANIFEST}, base long").repartition(max(1, len(out)))


def _mapped(store, path: str, dtype: str) -> np.ndarray:
    """A file as a read-only map; files of other stores are copied to the task's own disk first."""
    if store.type_name == "local":
        return np.memmap(path, dtype=dtype, mode="r")
    local = tempfile.NamedTemporaryFile()
    with store.open_input_stream(path) as source:
        while block := source.read(1 << 22):
            local.write(block)
    local.flush()
    found = np.memmap(local.name, dtype=dtype, mode="r")
    local.close()
    return found


def read_token_files(parts: DataFrame, folder: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and `ids`, 32-bit little-endian) of every stored document."""

    def read(batches):
        store, root = _file_system(folder)
        for batch in batches:
            for part in batch.to_pylist():
                data = _mapped(store, f"{root}/{part['name']}.bin", f"<u{part['width']}")
                index = _mapped(store, f"{root}/{part['name']}.idx", "u1")
                n = int(index[:8].view("<i8")[0])
                doc_ids = index[8 : 8 + 8 * n].view("<i8")
                offsets = index[8 + 8 * n : 16 + 16 * n].view("<i8")
                nulls = index[16 + 16 * n :].astype(bool)
                for lo in range(0, n, 4096):
                    hi = min(n, lo + 4096)
                    found = [data[offsets[k] : offsets[k + 1]].astype("<u4").tobytes() for k in range(lo, hi)]
                    columns = {
                        "doc_id": pa.array(doc_ids[lo:hi].astype("i8"), pa.int64(), mask=nulls[lo:hi]),
                        "start": pa.array(offsets[lo:hi].astype("i8") + part["base"]),
                        "n_tokens": pa.array(np.diff(offsets[lo : hi + 1]).astype("i8")),
                        "ids_crc32": pa.array([zlib.crc32(x) for x in found], pa.int64()),
                    }
                    if with_ids:
                        columns["ids"] = pa.array(found, pa.binary())
                    yield pa.RecordBatch.from_pydict(columns)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else "")
    return parts.mapInArrow(read, schema)


def token_round_trip(docs: DataFrame, tokenizer_path: str, end_id: int, with_ids: bool = False) -> DataFrame:
    """Write `docs` to a new folder below the shared root and read them back."""
    spark = docs.sparkSession
    folder = scratch_dir(spark, "tokens")
    parts = with_bases(spark, write_token_files(docs, tokenizer_path, end_id, folder))
    return read_token_files(parts, folder, with_ids)
