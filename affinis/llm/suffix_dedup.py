"""Removal of long repeated byte strings, by suffix order over regions that can hold repeats.

Every string of `size` bytes contains runs of ANCHOR bytes; the one with the smallest hash is its mark, which depends on the
string alone. So equal strings have equal marks, and neighbouring strings mostly share one: a document falls into regions of
consecutive strings with the same mark (about one for each 70 bytes). Marks that occur once, and once in their region, cannot hold a repeat and
are left out; regions with equal content are repeats as a whole. What remains are marks with different contents, as at the
edges of shared passages, or with a mark twice in a region, as in periodic text. There a suffix order of the regions' strings is built (ranks by prefix doubling, equal strings in order of their
position), in which the previous smaller position of a string is its entry before: that gives the longest previous factor
up to `size`, the earlier match, and with it all strings that start anywhere else too. With keep="first" only strings
with an earlier match are covered, so the first copy stays; with keep="none" all copies go.

A mark with more than BUCKET different regions is not gathered: tasks send the distinct hashes (128 bits) of its strings, as sorted
arrays, to buckets of the hash space, which answer whether a string is repeated and where it is first.

Defined cases: texts are UTF-8 bytes and null is empty; matches never cross documents; rows equal in id and text match each
other; a text shorter than `size` keeps all its bytes; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from affinis.llm.common import row_key
from affinis.llm.interpolated_lm import _bucket_edges, _gaps, _ungaps, _unzip, _zip
from affinis.llm.textscan import BYTE_VALUES, column_bytes, mix, powers
from affinis.session import pin, unpin

SIZE, ANCHOR, BUCKET, LONGEST, BLOCK = 200, 64, 256, 2048, 1 << 20
SECOND = np.uint64(0xC2B2AE3D27D4EB4F)
KEYS = "key_id long, key_mark long"


def _sums(data: np.ndarray, salt: np.uint64 = np.uint64(0)) -> np.ndarray:
    values = BYTE_VALUES if not salt else mix(BYTE_VALUES ^ salt)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(values[data] * powers(len(data) + 1)[0][:-1], out=total[1:])
    return total


def _hash(total: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix((total[end] - total[start]) * powers(len(total))[1][start])


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each `width` consecutive values, from block-wise running minima of both directions."""
    n = len(x) - width + 1
    padded = np.full(-(-len(x) // width) * width, np.iinfo(x.dtype).max, dtype=x.dtype)
    padded[: len(x)] = x
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def regions(texts: list[bytes], size: int = SIZE, anchor: int = ANCHOR):
    """(text number, start, number of strings, mark, content hash, mark occurs twice) arrays of the regions of some texts."""
    joined = np.frombuffer(b"".join(texts), dtype=np.uint8)
    lengths = np.array([len(t) for t in texts])
    begin = np.cumsum(lengths) - lengths
    if len(joined) < size:
        return [*[np.empty(0, np.int64)] * 5, np.empty(0, bool)]
    total = _sums(joined)
    at = np.arange(len(joined) - anchor + 1)
    width = size - anchor + 1
    grams = _hash(total, at, at + anchor)
    marks = sliding_min(grams, width)
    # Where runs are the mark of some string: there the largest mark around equals the run's own hash.
    edge = np.zeros(width - 1, dtype=np.uint64)
    at = np.flatnonzero(grams == ~sliding_min(~np.concatenate([edge, marks, edge]), width))
    # A string starts only where it ends in the same text.
    owner = np.repeat(np.arange(len(texts)), np.maximum(lengths - size + 1, 0))
    starts = np.arange(len(owner)) + (begin - (np.cumsum(np.maximum(lengths - size + 1, 0)) - np.maximum(lengths - size + 1, 0)))[owner]
    if not len(starts):
        return [*[np.empty(0, np.int64)] * 5, np.empty(0, bool)]
    mark = marks[starts]
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (mark[1:] != mark[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    inside = np.arange(len(starts)) - np.repeat(first, np.diff(first, append=len(starts)))
    first = np.flatnonzero(new | (inside % LONGEST == 0))
    n = np.diff(first, append=len(starts))
    s, mark = starts[first], mark[first]
    lo, hi = np.searchsorted(at, s), np.searchsorted(at, s + n + width - 1)
    inside = np.arange((hi - lo).sum()) + np.repeat(lo - (np.cumsum(hi - lo) - (hi - lo)), hi - lo)
    twice = np.add.reduceat(grams[at[inside]] == np.repeat(mark, hi - lo), np.cumsum(hi - lo) - (hi - lo), dtype=np.int64) > 1
    return owner[first], s - begin[owner[first]], n, mark.view(np.int64), _hash(total, s, s + n + size - 1).view(np.int64), twice


def _find(docs: DataFrame, size: int) -> DataFrame:
    """KEYS, start, n (strings in the region), mark, content of every region."""

    def run(batches):
        for batch in batches:
            texts = column_bytes(batch.column(2))
            ids, marks = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
            lo, held = 0, 0
            for k, text in enumerate(texts):
                held += len(text)
                if held >= BLOCK or k == len(texts) - 1:
                    owner, start, n, mark, content, twice = regions(texts[lo : k + 1], size)
                    owner = owner + lo
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[owner]), pa.array(marks[owner]), pa.array(start), pa.array(n), pa.array(mark), pa.array(content), pa.array(twice)],
                        ["key_id", "key_mark", "start", "n", "mark", "content", "twice"],
                    )
                    lo, held = k + 1, 0

    return docs.mapInArrow(run, f"{KEYS}, start long, n long, mark long, content long, twice boolean")


def string_ranks(data: np.ndarray, size: int) -> np.ndarray:
    """For each start, the rank of the `size` bytes from there among all starts (prefix doubling from 8 bytes)."""
    padded = np.concatenate([data, np.zeros(size + 8, dtype=np.uint8)])
    rank = np.zeros(len(data) + size, dtype=np.uint64)
    for k in range(8):
        rank = (rank << np.uint64(8)) | padded[k : k + len(rank)]
    width = 8
    while width < size:
        step = min(width, size - width)
        _, order = np.unique(rank, return_inverse=True)
        order = order.astype(np.uint64)
        after = np.zeros_like(order)
        after[: len(order) - step] = order[step:]
        rank = (order << np.uint64(32)) | after
        width += step
    return rank[: len(data)]


def earlier_matches(contents: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of all strings of `size` bytes in concatenated contents, and for each whether it has an earlier match and a later one.

    Contents come in the order of their places, so positions order strings as the corpus does.
    """
    data = np.frombuffer(b"".join(contents), dtype=np.uint8)
    lengths = np.array([len(c) for c in contents])
    n = lengths - size + 1
    base = np.repeat(np.cumsum(lengths) - lengths, n)
    starts = base + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    rank = string_ranks(data, size)[starts]
    order = np.lexsort((starts, rank))  # suffix order, equal strings by position
    same = rank[order][1:] == rank[order][:-1]
    earlier, later = np.zeros(len(starts), dtype=bool), np.zeros(len(starts), dtype=bool)
    earlier[order[1:]] = same  # the entry before is the previous smaller position
    later[order[:-1]] = same
    return starts, earlier, later


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    step = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    begin = np.flatnonzero(step == 1)
    return begin, np.flatnonzero(step == -1) - begin


def _match(keep: str, size: int):
    """Rows of regions sorted by mark -> KEYS, start, n of the strings to cover."""

    def flush(rows):
        rows.sort(key=lambda r: (r["mark"], r["key_id"], r["key_mark"], r["start"]))
        out, lo = [], 0
        _, earlier, later = earlier_matches([r["bytes"] for r in rows], size)
        for r in rows:
            e, x = earlier[lo : lo + r["n"]], later[lo : lo + r["n"]]
            # A region that occurs again elsewhere is its own later match; its later copies are covered as a whole.
            flags = e if keep == "first" else e | x
            for start, n in zip(*_runs(flags)):
                out.append((r["key_id"], r["key_mark"], r["start"] + int(start), int(n)))
            lo += r["n"]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out) if out else [[]] * 4)], ["key_id", "key_mark", "start", "n"])

    def run(batches):
        rows, held = [], 0
        for batch in batches:
            for r in batch.to_pylist():
                if held >= BLOCK and r["mark"] != rows[-1]["mark"]:
                    yield flush(rows)
                    rows, held = [], 0
                rows.append(r)
                held += len(r["bytes"])
        if rows:
            yield flush(rows)

    return run


def _hashed(contents: list[bytes], n: np.ndarray, size: int):
    """Strings of concatenated contents in order of their two hashes, then position: h1, h2, order, first of each group."""
    data = np.frombuffer(b"".join(contents), dtype=np.uint8)
    lengths = n + size - 1
    at = np.repeat(np.cumsum(lengths) - lengths - (np.cumsum(n) - n), n) + np.arange(n.sum())
    h1, h2 = (_hash(_sums(data, salt), at, at + size) for salt in (np.uint64(0), SECOND))
    order = np.lexsort((at, h2, h1))
    h1, h2 = h1[order], h2[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
    return h1, h2, order, np.flatnonzero(new)


ASK = "unit long, bucket int, keys binary, second binary, counts binary, key_id binary, key_mark binary, start binary, n binary"


def _ask(size: int, buckets: int):
    """Regions of crowded marks, in units: a row with the regions (bucket -1), and their distinct strings by bucket of the hash.

    A string that thousands of regions share is one entry a unit, with its number (up to 2) and its first place.
    """

    def unit(name, rows):
        rows.sort(key=lambda r: (r["key_id"], r["key_mark"], r["start"]))
        ids, marks, starts, n, times = (np.array([r[c] for r in rows], dtype=np.int64) for c in ("key_id", "key_mark", "start", "n", "times"))
        contents = [r["bytes"] for r in rows]
        h1, h2, order, first = _hashed(contents, n, size)
        total = np.minimum(np.add.reduceat(np.minimum(np.repeat(times, n), 2)[order], first), 2).astype(np.uint8)
        region = np.repeat(np.arange(len(rows)), n)[order[first]]
        inside = order[first] - (np.cumsum(n) - n)[region]
        h1, h2, place = h1[first], h2[first], (ids[region], marks[region], starts[region] + inside)
        out = [(name, -1, _zip(np.frombuffer(b"".join(contents), np.uint8)), None, None, *map(_zip, (ids, marks, starts, n)))]
        cut = [0, *np.searchsorted(h1, _bucket_edges(buckets)), len(h1)]
        for b in range(buckets):
            if cut[b + 1] > cut[b]:
                s = slice(cut[b], cut[b + 1])
                out.append((name, b, _gaps(h1[s]), _zip(h2[s]), _zip(total[s]), *[_zip(x[s]) for x in place], None))
        kinds = (pa.int64(), pa.int32(), *[pa.binary()] * 7)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], [c.split()[0] for c in ASK.split(", ")])

    def run(batches):
        part, number, rows, held = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            for r in batch.to_pylist():
                if held >= 2 * BLOCK:
                    yield unit(part * (1 << 24) + number, rows)
                    rows, held, number = [], 0, number + 1
                rows.append(r)
                held += len(r["bytes"])
        if rows:
            yield unit(part * (1 << 24) + number, rows)

    return run


def _answer(table: pa.Table) -> pa.Table:
    """For each asked string: 0 if it is alone, 1 if repeated and first in the asking unit, 2 if repeated and first elsewhere."""
    rows = table.to_pylist()
    h1 = np.concatenate([_ungaps(r["keys"]) for r in rows])
    h2 = np.concatenate([_unzip(r["second"], np.uint64) for r in rows])
    times = np.concatenate([_unzip(r["counts"], np.uint8) for r in rows]).astype(np.int64)
    place = [np.concatenate([_unzip(r[c], np.int64) for r in rows]) for c in ("start", "key_mark", "key_id")]
    order = np.lexsort((*place, h2, h1))
    x, y = h1[order], h2[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1])
    first = np.flatnonzero(new)
    again = np.repeat(np.add.reduceat(times[order], first) > 1, np.diff(first, append=len(order)))
    code = np.empty(len(order), dtype=np.uint8)
    code[order] = np.where(again, np.where(new, 1, 2), 0)
    ends = np.cumsum([len(_unzip(r["counts"], np.uint8)) for r in rows])
    out = [(r["unit"], r["bucket"], _zip(c)) for r, c in zip(rows, np.split(code, ends[:-1]))]
    kinds = (pa.int64(), pa.int32(), pa.binary())
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["unit", "bucket", "codes"])


def _cover(keep: str, size: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        unit = left.to_pylist()[0]
        ids, marks, starts, n = (_unzip(unit[c], np.int64) for c in ("key_id", "key_mark", "start", "n"))
        _, _, order, first = _hashed([_unzip(unit["keys"], np.uint8).tobytes()], n, size)
        codes = np.concatenate([_unzip(r["codes"], np.uint8) for r in sorted(right.to_pylist(), key=lambda r: r["bucket"])])
        flags = np.zeros(len(order), dtype=bool)
        flags[order] = np.repeat(codes > 0, np.diff(first, append=len(order)))
        if keep == "first":
            flags[order[first[codes == 1]]] = False
        out, lo = [], 0
        for k in range(len(n)):
            for start, count in zip(*_runs(flags[lo : lo + n[k]])):
                out.append((ids[k], marks[k], starts[k] + start, count))
            lo += n[k]
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out) if out else [[]] * 4)], ["key_id", "key_mark", "start", "n"])

    return run


def repeated_spans(docs: DataFrame, keep: str = "none", size: int = SIZE) -> DataFrame:
    """KEYS, start, n: runs of string starts to cover; `docs` has KEYS and text."""
    found = pin(_find(docs, size))
    again = (
        found.groupBy("mark")
        .agg(
            F.count("*").alias("times"), ((F.min("content") != F.max("content")) | F.max("twice")).alias("mixed")
        )
        .where("times > 1 OR mixed")
        .drop("times")
    )
    common = pin(found.join(again, "mark"))
    unpin(found)
    place = F.struct("key_id", "key_mark", "start")
    contents = common.groupBy("mark", "content").agg(
        F.count("*").alias("times"), F.min(place).alias("first"), F.first("n").alias("n"), F.first("mixed").alias("mixed")
    )
    contents = pin(contents)
    whole = common.join(contents.where("times > 1").select("mark", "content", "first"), ["mark", "content"])
    if keep == "first":
        whole = whole.where(place != F.col("first"))
    whole = whole.select("key_id", "key_mark", "start", "n")

    different = contents.where("mixed").select("mark", "times", "n", "first.*")
    sizes = different.groupBy("mark").agg(F.count("*").alias("many"))
    different = different.join(sizes, "mark")
    wanted = different.groupBy("key_id", "key_mark").agg(F.collect_list(F.struct("start", "n", "mark", "times", "many")).alias("places"))

    def cut(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                text = column_bytes(batch.column(2).slice(row, 1))[0]
                places = batch.column(3)[row].as_py()
                cols = [[p[c] for p in places] for c in ("start", "n", "mark", "times", "many")]
                parts = [text[s : s + n + size - 1] for s, n in zip(cols[0], cols[1])]
                keys = [[batch.column(c)[row].as_py()] * len(places) for c in (0, 1)]
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(c, pa.int64()) for c in (*keys, *cols)], pa.array(parts, pa.binary())],
                    ["key_id", "key_mark", "start", "n", "mark", "times", "many", "bytes"],
                )

    once = docs.join(wanted, ["key_id", "key_mark"]).select("key_id", "key_mark", "text", "places")
    cutting = once.mapInArrow(cut, f"{KEYS}, start long, n long, mark long, times long, many long, bytes binary")
    cutting = pin(cutting)
    few = cutting.where(F.col("many") <= BUCKET).repartition("mark").sortWithinPartitions("mark")
    in_few = few.mapInArrow(_match(keep, size), f"{KEYS}, start long, n long")
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    asks = pin(cutting.where(F.col("many") > BUCKET).mapInArrow(_ask(size, buckets), ASK))
    answers = asks.where("bucket >= 0").groupBy("bucket").applyInArrow(_answer, "unit long, bucket int, codes binary")
    in_many = (
        asks.where("bucket < 0")
        .groupBy("unit")
        .cogroup(answers.groupBy("unit"))
        .applyInArrow(_cover(keep, size), f"{KEYS}, start long, n long")
    )
    return whole.unionByName(in_few).unionByName(in_many)


def dedup(docs: DataFrame, keep: str = "none", size: int = SIZE, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and the kept bytes as `kept`) of every document."""
    keyed = docs.select(
        *row_key(F.col(id_col), F.col(text_col)), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")
    )
    spans = repeated_spans(keyed.select("key_id", "key_mark", "text"), keep, size)
    listed = spans.groupBy("key_id", "key_mark").agg(F.collect_set(F.struct("start", "n")).alias("spans"))

    def run(batches):
        for batch in batches:
            out = []
            texts, places = column_bytes(batch.column(1)), batch.column(2)
            for k, text in enumerate(texts):
                marked = np.zeros(len(text) + 1, dtype=np.int32)
                for p in places[k].as_py() or ():
                    marked[p["start"]] += 1
                    marked[p["start"] + p["n"] + size - 1] -= 1
                gone = np.cumsum(marked)[:-1] > 0
                kept = np.frombuffer(text, dtype=np.uint8)[~gone].tobytes()
                row = (len(text), int(gone.sum()), len(_runs(gone)[0]), hashlib.sha256(kept).hexdigest())
                out.append((*row, kept) if with_text else row)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), *([pa.binary()] if with_text else []))
            cols = list(zip(*out)) if out else [[]] * len(kinds)
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept"] if with_text else [])]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, t) for c, t in zip(cols, kinds)]], names)

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if with_text else "")
    joined = keyed.join(listed, ["key_id", "key_mark"], "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(run, schema)
