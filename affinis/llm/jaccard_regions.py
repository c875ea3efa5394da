"""Similarity join of documents on word shingles in the Jaccard metric space, exact, by pivots and regions.

The distance of two shingle sets is 1 - intersection / union, a metric; documents link at a distance of at most EPS.

Almost all pairs of documents are at distance 1, where pivots tell nothing. So the space is first cut into blocks: a link needs a
common shingle among the rarest of either document (the shortest prefix that any set within EPS must meet), and a
block holds the documents that share one; blocks of the same documents are one. Inside the blocks the metric method runs:

1. Every block has a pivot (a random member). A document belongs to the Voronoi region of the pivot with which it shares
   most blocks; its exact distance to that pivot is taken, and it links to a pivot within EPS. Here and below, a parity sketch
   of two bits a shingle first tells pairs that are certainly apart; whole sets are sent for the others only.
2. Links are contracted to components. Blocks inside one component are done. In the others every member is paired with the
   nearest member (by a bound of the distance) of another component, in parts of at most about CELL members that are dealt anew
   each time, and links are contracted again, as long as many of these pairs are links; a group of near copies of any size becomes one component with about as many tests as it has members.
3. What is left is joined block by block: pairs of different components, in cells of bounded size (a block of m
   documents is dealt over m / CELL parts, and each pair of parts is a cell). Regions do not deal the pairs. The triangle
   inequality keeps pairs with a common pivot in windows of width EPS around their distances to it, sizes and a parity
   signature bound the rest, and what passes is verified on the whole sets.

No pair is lost: one within EPS shares a block, and stays in it until both are in one component or the pair itself was tested.
Copies with equal sets are one node. Which shingles count as rare is told by lists of bounded size (repeated shingles, and used words:
a shingle of common words is likely to be met by chance); any order gives the same result, a good one less work.

Defined cases: a document without words has no set and is alone; fewer than five words are one shingle; a null id is never the
smallest; rows with one id but different texts are different sets; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from affinis.llm.common import fresh, row_key
from affinis.llm.components import components
from affinis.llm.interpolated_lm import _bucket_edges, _gaps, _ungaps, _unzip, _values, _zip
from affinis.llm.textscan import column_bytes, mix, word_hashes
from affinis.session import drop_folder, pin, release_shuffles, scratch_dir, unpin

WORDS, PERCENT = 5, 80
UNIT, CELL, CHUNK, FREQUENT = 6 << 20, 1024, 1 << 16, 1 << 17
SIGNATURE = 8  # longs
PAIRS_A_TASK, ROWS_A_TASK = 5_000, 50_000  # pairs with their sets, rows of blocks: of a task that writes them
SLOTS = 1 << 20  # of the nodes whose sets are wanted, at most as many rows are broadcast
STEP = np.uint64(0x9FB21C651E98DF25)


def _listed(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The value of each wanted key in a sorted list, 0 where it is not listed."""
    if not len(keys):
        return np.zeros(len(wanted), dtype=np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], 0)


def shingle_sets(texts: list[bytes], words: tuple | None = None, width: int = WORDS) -> list:
    """The sorted distinct shingle hashes of each text; with a list of word weights, (hashes, summed weights)."""
    hashes, counts = word_hashes(texts)
    if words:
        sums = np.concatenate([[0], np.cumsum(_listed(*words, hashes))])
        weights = sums[width:] - sums[:-width] if len(hashes) >= width else np.zeros(0, dtype=np.int64)
    ends = np.cumsum(counts)
    rolled = np.zeros(max(0, len(hashes) - width + 1), dtype=np.uint64)
    for k in range(width):
        rolled = rolled * STEP + hashes[k : k + len(rolled)]
    rolled, out = mix(rolled), []
    for begin, end in zip((ends - counts).tolist(), ends.tolist()):
        if end - begin >= width:
            own = slice(begin, end - width + 1)
            if words:
                found, first = np.unique(rolled[own], return_index=True)
                out.append((found, weights[own][first]))
            else:
                out.append(np.unique(rolled[own]))
        elif end > begin:
            whole = np.uint64(end - begin)
            for h in hashes[begin:end]:
                whole = mix(np.array([whole], dtype=np.uint64) * STEP + h)[0]
            out.append(np.array([whole], dtype=np.uint64))
        else:
            out.append(np.empty(0, np.uint64))
        if words and not isinstance(out[-1], tuple):
            out[-1] = (out[-1], np.zeros(len(out[-1]), dtype=np.int64))
    return out


def node_of(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def signature(shingles: np.ndarray) -> np.ndarray:
    """Parity of the shingles in each of 64 * SIGNATURE slots: its Hamming distance never exceeds the set difference."""
    slots = np.bincount((shingles >> np.uint64(20)).astype(np.int64) % (64 * SIGNATURE), minlength=64 * SIGNATURE)
    return np.packbits((slots & 1).astype(np.uint8)).view(np.uint64)


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Parity as in `signature`, in a power of two of slots, two a shingle at least; its halves xored are that of half the slots."""
    slots = 1 << max((64 * SIGNATURE - 1).bit_length(), (2 * len(shingles) - 1).bit_length())
    counts = np.bincount((shingles >> np.uint64(20)).astype(np.int64) % slots, minlength=slots)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.uint64)


def sketches_apart(x: np.ndarray, y: np.ndarray) -> int:
    """A lower bound of the size of the set difference."""
    if len(x) < len(y):
        x, y = y, x
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def prefix_length(n: int) -> int:
    return n - (-(-PERCENT * n // 100)) + 1


def _batches(batches, text_at: int, limit: int = 4 << 20):
    """(first row, texts, batch) of stretches of at most `limit` bytes, or of one text."""
    for batch in batches:
        texts, lo, held = column_bytes(batch.column(text_at)), 0, 0
        for k, t in enumerate(texts):
            held += len(t)
            if held >= limit or k == len(texts) - 1:
                yield lo, texts[lo : k + 1], batch
                lo, held = k + 1, 0


def frequent(docs: DataFrame) -> tuple[tuple, tuple]:
    """The most repeated shingles with their counts, and the most used words with a weight (about 8 log2 of the count).

    Both are counted from what occurs twice in one stretch of a task, over all documents, and hold FREQUENT entries at most.
    """

    def run(batches):
        for _, texts, _ in _batches(batches, 0):
            for kind, found in ((0, np.concatenate(shingle_sets(texts))), (1, word_hashes(texts)[0])):
                keys, n = np.unique(found, return_counts=True)
                many = n > 1 + kind
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(many.sum(), kind, np.int32)), pa.array(keys[many].view(np.int64)), pa.array(n[many])], ["kind", "key", "n"]
                )

    counts = docs.select("text").mapInArrow(run, "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n"))
    counts, out = pin(counts.where("n > 3")), []
    for kind in (0, 1):
        top = counts.where(F.col("kind") == kind).orderBy(F.desc("n"), "key").limit(FREQUENT).toPandas()
        keys, n = top["key"].to_numpy(np.int64).view(np.uint64), top["n"].to_numpy(np.int64)
        order = np.argsort(keys)
        out.append((keys[order], n[order] if kind == 0 else np.round(8 * np.log2(n[order])).astype(np.int64)))
    unpin(counts)
    return tuple(out)


def _prefixes(docs: DataFrame, buckets: int) -> tuple[DataFrame, DataFrame, DataFrame, str]:
    """Documents (keys, doc_id, node, n), units with their prefixes, and what they ask the buckets."""
    spark = docs.sparkSession
    listed = spark.sparkContext.broadcast(frequent(docs))  # bounded by FREQUENT

    def run(batches):
        part, number, edges = TaskContext.get().partitionId(), 0, _bucket_edges(buckets)
        often, words = listed.value
        rows, pre, size = [], [], 0

        def unit():
            name = part * (1 << 24) + number
            keys = np.concatenate(pre) if pre else np.empty(0, np.uint64)
            owner = np.repeat(np.arange(len(pre)), [len(p) for p in pre])
            order = np.argsort(keys, kind="stable")
            asked, times = np.unique(keys, return_counts=True)
            cut = [0, *np.searchsorted(asked, edges), len(asked)]
            out = [("docs", name, -1, None, None, *r) for r in rows]
            out.append(("units", name, -1, _gaps(keys[order]), _zip(owner[order].astype(np.uint32)), *[None] * 6))
            for b in range(buckets):
                if cut[b + 1] > cut[b]:
                    s = slice(cut[b], cut[b + 1])
                    out.append(("asks", name, b, _gaps(asked[s]), _zip(np.minimum(times[s], 2).astype(np.uint8)), *[None] * 6))
            kinds = (pa.string(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64())
            for lo in range(0, len(out), 1024):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out[lo : lo + 1024]), kinds)],
                    ["kind", "unit", "bucket", "keys", "counts", "at", "key_id", "key_mark", "doc_id", "node", "n"],
                )

        for lo, texts, batch in _batches(batches, 3):
            ids = [batch.column(c).slice(lo, len(texts)).to_pylist() for c in range(3)]
            for k, (s, weight) in enumerate(shingle_sets(texts, words)):
                if rows and size + len(texts[k]) > UNIT:
                    yield from unit()
                    rows, pre, size, number = [], [], 0, number + 1
                rare = s[np.lexsort((s, weight, _listed(*often, s)))[: prefix_length(len(s))]] if len(s) else s
                rows.append((len(rows), *[c[k] for c in ids], node_of(s) if len(s) else None, len(s)))
                pre.append(rare)
                size += len(texts[k])
        if rows:
            yield from unit()

    schema = "kind string, unit long, bucket int, keys binary, counts binary, at long, key_id long, key_mark long, doc_id long, node binary, n long"
    folder = scratch_dir(spark, "jaccard")
    docs.select("key_id", "key_mark", "doc_id", "text").mapInArrow(run, schema).write.partitionBy("kind").parquet(folder)
    own = schema.removeprefix("kind string, ")
    found = _values(spark, folder, "kind")
    parts = [spark.read.schema(own).parquet(f"{folder}/kind={k}") if k in found else spark.createDataFrame([], own) for k in ("docs", "units", "asks")]
    return *parts, folder


def _answer(table: pa.Table) -> pa.Table:
    """Which of the asked shingles occur twice or more, for each unit in the order it asked."""
    keys = [_ungaps(k.as_py()) for k in table["keys"]]
    times = [_unzip(c.as_py(), np.uint8) for c in table["counts"]]
    known, where = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(where, weights=np.concatenate(times), minlength=len(known)) > 1
    ends = np.cumsum([len(k) for k in keys])
    rows = [(u, b, _zip(x.astype(np.uint8))) for u, b, x in zip(table["unit"].to_pylist(), table["bucket"].to_pylist(), np.split(total[where], ends[:-1]))]
    kinds = (pa.int64(), pa.int32(), pa.binary())
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["unit", "bucket", "counts"])


def _shared(left: pa.Table, right: pa.Table) -> pa.Table:
    """shingle, unit, at of the prefix shingles of a unit that some other document has too."""
    unit = left.to_pylist()[0]
    keys, owner = _ungaps(unit["keys"]), _unzip(unit["counts"], np.uint32)
    asked = np.unique(keys)
    answers = sorted(right.to_pylist(), key=lambda r: r["bucket"])
    again = np.concatenate([_unzip(r["counts"], np.uint8) for r in answers]).astype(bool) if answers else np.zeros(len(asked), bool)
    hit = again[np.searchsorted(asked, keys)] if len(keys) else np.zeros(0, bool)
    return pa.Table.from_arrays(
        [pa.array(keys[hit].view(np.int64)), pa.array(np.full(hit.sum(), unit["unit"], np.int64)), pa.array(owner[hit].astype(np.int64))],
        ["shingle", "unit", "at"],
    )


def _blocks(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """members (all documents), and blocks: shingle, node, n, of nodes that share a prefix shingle with another node."""
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    members, units, asks, folder = _prefixes(docs, buckets)
    answers = asks.groupBy("bucket").applyInArrow(_answer, "unit long, bucket int, counts binary")
    shared = (
        units.groupBy("unit").cogroup(answers.groupBy("unit")).applyInArrow(_shared, "shingle long, unit long, at long")
    )
    own = members.select("unit", "at", "node", "n")
    blocks = shared.join(own, ["unit", "at"]).groupBy("shingle", "node").agg(F.first("n").alias("n"))
    blocks = pin(blocks)
    sizes = blocks.groupBy("shingle").agg(
        F.count("*").alias("m"), F.min("n").alias("least"), F.max("n").alias("most"),
        *(F.bit_xor(F.xxhash64(F.lit(seed), "node")).alias(f"x{seed}") for seed in (0, 1)),
    )
    # Two sets whose sizes differ by more than a link allows need no block.
    worth = sizes.where((F.col("m") > 2) | (F.col("m") == 2) & (100 * F.col("least") >= PERCENT * F.col("most")))
    # Near copies share many rare shingles: blocks of the same members (told by 128 bits) are one.
    open_ = worth.groupBy("m", "x0", "x1").agg(F.min("shingle").alias("shingle")).select("shingle")
    kept = pin(blocks.join(open_, "shingle"))
    members = pin(members.select("key_id", "key_mark", "doc_id", "node", "n"))
    drop_folder(docs.sparkSession, folder)
    unpin(blocks)
    return members, kept


def _pivots(blocks: DataFrame) -> DataFrame:
    """node, pivot: the pivot with which a node shares most blocks, and so its region; the pivot of a block is a random member."""
    order = F.struct(F.xxhash64("node").alias("draw"), "node")
    drawn = blocks.groupBy("shingle").agg(F.min(order).alias("p")).select("shingle", F.col("p.node").alias("pivot"))
    votes = blocks.join(drawn, "shingle").where("node <> pivot").groupBy("node", "pivot").agg(F.count("*").alias("votes"))
    return votes.groupBy("node").agg(F.max(F.struct("votes", "pivot")).alias("b")).select("node", F.col("b.pivot").alias("pivot"))


def _sets(docs: DataFrame, members: DataFrame, blocks: DataFrame) -> DataFrame:
    """node, pivot, n, shingles (sorted, packed), signature, sketch of the nodes in blocks; one document each is read again."""
    regions = pin(_pivots(blocks))
    first = members.groupBy("node").agg(F.min(F.struct("key_id", "key_mark")).alias("k"))
    wanted = (
        blocks.select("node").distinct().join(first, "node").join(regions, "node", "left").select("k.key_id", "k.key_mark", "pivot")
    )

    def run(batches):
        for lo, texts, batch in _batches(batches, 0):
            sets = shingle_sets(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([node_of(s) for s in sets], pa.binary()),
                    batch.column(1).slice(lo, len(texts)),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_gaps(s) if len(s) else b"" for s in sets], pa.binary()),
                    pa.array([signature(s).tobytes() for s in sets], pa.binary()),
                    pa.array([sketch(s).tobytes() for s in sets], pa.binary()),
                ],
                ["node", "pivot", "n", "shingles", "signature", "sketch"],
            )

    # Rows with equal id and text are one document; one of them is read.
    texts = docs.join(wanted, ["key_id", "key_mark"]).select("text", "pivot")
    sets = pin(texts.mapInArrow(run, "node binary, pivot binary, n long, shingles binary, signature binary, sketch binary"))
    unpin(regions)
    return sets


def _measured(joined: DataFrame) -> DataFrame:
    """u, v, common, total (sizes of intersection and union) of rows u, v, a, b with packed sets a and b."""

    def run(batches):
        for batch in batches:
            common, total = [], []
            for a, b in zip(batch.column(2), batch.column(3)):
                x, y = _ungaps(a.as_py()), _ungaps(b.as_py())
                where = np.searchsorted(y, x)
                where[where == len(y)] = 0
                both = int((y[where] == x).sum())
                common.append(both)
                total.append(len(x) + len(y) - both)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(common, pa.int64()), pa.array(total, pa.int64())], ["u", "v", "common", "total"])

    return joined.select("u", "v", "a", "b").mapInArrow(run, "u binary, v binary, common long, total long")


def _sketched(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """u, v, close of pairs: false where sizes or sketches show that they do not link."""

    def run(batches):
        for batch in batches:
            m, n, a, b = (batch.column(c).to_pylist() for c in range(2, 6))
            close = [
                100 * min(i, j) >= PERCENT * max(i, j)
                and (100 + PERCENT) * sketches_apart(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) <= (100 - PERCENT) * (i + j)
                for i, j, x, y in zip(m, n, a, b)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(close, pa.bool_())], ["u", "v", "close"])

    side = lambda c, n, s: sets.select(F.col("node").alias(c), F.col("n").alias(n), F.col("sketch").alias(s))
    joined = pairs.select("u", "v").join(side("u", "m", "a"), "u").join(side("v", "n", "b"), "v")
    return joined.select("u", "v", "m", "n", "a", "b").mapInArrow(run, "u binary, v binary, close boolean")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """u, v, common, total of pairs, written; null where their sketches show that they do not link. Few sets but those of the others are sent."""
    tasks = -(-(pairs.count() + sets.count()) // PAIRS_A_TASK)
    told = pin(_sketched(pairs, sets), tasks)
    close = told.where("close").select("u", "v")
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(SLOTS))
    wanted = close.select(F.explode(F.array("u", "v")).alias("node")).select(slot("node").alias("slot")).distinct()
    some = sets.join(F.broadcast(wanted), slot("node") == F.col("slot"), "left_semi")
    side = lambda c, s: some.select(F.col("node").alias(c), F.col("shingles").alias(s))
    exact = _measured(close.join(side("u", "a"), "u").join(side("v", "b"), "v"))
    none = F.lit(None).cast("long")
    apart = told.where("NOT close").select("u", "v", none.alias("common"), none.alias("total"))
    out = pin(exact.unionByName(apart), tasks)
    unpin(told)
    return out


def _to_pivots(sets: DataFrame) -> DataFrame:
    """Every node against the pivot of its region."""
    return _verified(sets.where("pivot IS NOT NULL").select(F.col("node").alias("u"), F.col("pivot").alias("v")), sets)


def _distances(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Written pairs of nodes against each other."""
    return _verified(pairs, sets)


def _cells(blocks: DataFrame, known: DataFrame, sets: DataFrame, deal: int = 0) -> DataFrame:
    """Rows of the open blocks, dealt to cells of bounded size so that any two members of a block meet in one of them.

    Cells of one part (i = j) hold each row once; another `deal` puts other members into a part.
    """
    sizes = blocks.groupBy("shingle").agg(F.count("*").alias("m"))
    rows = (
        blocks.join(sizes, "shingle")
        .join(sets.select("node", "signature"), "node")
        .join(known, "node", "left")
        .withColumn("parts", F.greatest(F.lit(1), F.ceil(F.col("m") / CELL)).cast("int"))
        .withColumn("part", F.pmod(F.xxhash64("node", "shingle", F.lit(deal)), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select(
            "shingle", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part",
            "node", "n", "root", "signature", F.coalesce("pivot", "node").alias("pivot"), F.coalesce("near", F.lit(0.0)).alias("near"),
        )
    )
    return rows.repartition("shingle", "i", "j").sortWithinPartitions("shingle", "i", "j", "part")


def _partners(table: pa.Table):
    """(a, b, apart): rows of whole cells whose sets no bound keeps from a link, in bounded chunks; apart is a bound of their distance."""
    shingle, i, j, part, n = (table[c].to_numpy() for c in ("shingle", "i", "j", "part", "n"))
    near, (root, pivot) = table["near"].to_numpy(), (_longs(table[c], 2) for c in ("root", "pivot"))
    sig, rows = _longs(table["signature"], SIGNATURE), np.arange(len(n))
    fresh_cell = np.concatenate([[True], (shingle[1:] != shingle[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])])
    starts = np.flatnonzero(fresh_cell)
    cell = np.cumsum(fresh_cell) - 1
    ends = np.append(starts[1:], len(n))[cell]
    # A cell of two parts holds the first part's rows before the second's.
    first = np.add.reduceat((part == i).astype(np.int64), starts)[cell]
    begin = np.where(i == j, rows + 1, np.where(part == i, starts[cell] + first, ends))
    counts = ends - begin
    upto = np.concatenate([[0], np.cumsum(counts)])
    lo = 0
    while lo < len(n):
        hi = max(lo + 1, int(np.searchsorted(upto, upto[lo] + CHUNK, side="right")) - 1)
        a = np.repeat(rows[lo:hi], counts[lo:hi])
        b = np.arange(len(a)) - np.repeat(upto[lo:hi] - upto[lo], counts[lo:hi]) + begin[a]
        lo = hi
        for test in (
            lambda a, b: (root[a] != root[b]).any(axis=1),
            lambda a, b: 100 * np.minimum(n[a], n[b]) >= PERCENT * np.maximum(n[a], n[b]),
            # Windows around a common pivot; a member without one is its own.
            lambda a, b: (pivot[a] != pivot[b]).any(axis=1) | (np.abs(near[a] - near[b]) <= 1 - PERCENT / 100 + 1e-9),
        ):
            good = test(a, b)
            a, b = a[good], b[good]
        apart = np.bitwise_count(sig[a] ^ sig[b]).sum(axis=1, dtype=np.int64)
        good = (100 + PERCENT) * apart <= (100 - PERCENT) * (n[a] + n[b])
        yield a[good], b[good], apart[good] / (n[a[good]] + n[b[good]])


def _longs(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint64).reshape(-1, width)


def _whole_cells(batches):
    """Tables that hold each cell whole."""
    held = []
    for batch in batches:
        held.append(batch)
        last = [batch.column(c)[-1].as_py() if batch.num_rows else None for c in ("shingle", "i", "j")]
        first = [held[0].column(c)[0].as_py() if held[0].num_rows else None for c in ("shingle", "i", "j")]
        if batch.num_rows and last != first:
            table = pa.Table.from_batches(held)
            same = np.logical_and.reduce([table[c].to_numpy() == v for c, v in zip(("shingle", "i", "j"), last)])
            cut = int(np.argmax(same))
            yield table.slice(0, cut)
            held = table.slice(cut).combine_chunks().to_batches()
    if sum(b.num_rows for b in held):
        yield pa.Table.from_batches(held)


def _nearest(cells: DataFrame) -> DataFrame:
    """Pairs (u, v): every open node with the nearest member, by signature, of another component in its cells; a row a member and cell."""

    def run(batches):
        for table in _whole_cells(batches):
            node = table["node"].combine_chunks()
            least, other = np.full(len(node), np.inf), np.zeros(len(node), dtype=np.int64)
            for a, b, apart in _partners(table):
                both = [np.concatenate(x) for x in ((a, b), (b, a), (apart, apart))]
                order = np.lexsort((both[2], both[0]))
                own, at = np.unique(both[0][order], return_index=True)
                at = order[at]
                less = both[2][at] < least[own]
                least[own[less]], other[own[less]] = both[2][at[less]], both[1][at[less]]
            own = np.flatnonzero(least < np.inf)
            yield pa.RecordBatch.from_arrays([node.take(own), node.take(other[own]), pa.array(least[own])], ["u", "v", "apart"])

    found = cells.mapInArrow(run, "u binary, v binary, apart double")
    nearest = found.groupBy("u").agg(F.min(F.struct("apart", "v")).alias("b")).select("u", F.col("b.v").alias("v"))
    return _sides(nearest).distinct()


def _all_pairs(cells: DataFrame) -> DataFrame:
    """Pairs (u, v) of different components that share an open block and that no bound rules out, each once."""

    def run(batches):
        for table in _whole_cells(batches):
            node = table["node"].combine_chunks()
            for a, b, _ in _partners(table):
                yield pa.RecordBatch.from_arrays([node.take(a), node.take(b)], ["u", "v"])

    return _sides(cells.mapInArrow(run, "u binary, v binary")).distinct()


def _sides(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))


def _open(blocks: DataFrame, roots: DataFrame, tested: DataFrame, tasks: int) -> DataFrame:
    """Blocks with their members' current roots, without those inside one component and those of one pair that was tested."""
    now = blocks.select("shingle", "node", "n").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    spread = now.groupBy("shingle").agg(
        (F.min("root") != F.max("root")).alias("mixed"), F.count("*").alias("m"), F.min("node").alias("lo"), F.max("node").alias("hi")
    )
    pairs = tested.select(F.least("u", "v").alias("lo"), F.greatest("u", "v").alias("hi"), F.lit(True).alias("done")).distinct()
    spread = spread.where("mixed").join(pairs, ["lo", "hi"], "left").where("m > 2 OR done IS NULL")
    return pin(now.join(spread.select("shingle"), "shingle"), tasks)


def similar_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(members: key_id, key_mark, doc_id, node, n; roots: node, root of every node that links with another)."""
    keyed = docs.select(
        *row_key(F.col(id_col), F.col(text_col)), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")
    )
    spark = docs.sparkSession
    linked = F.col("common") * 100 >= F.col("total") * PERCENT
    members, blocks = _blocks(keyed)
    release_shuffles(spark)
    sets = _sets(keyed, members, blocks)
    release_shuffles(spark)
    nodes, tasks = sets.count(), -(-blocks.count() // ROWS_A_TASK)  # no later table of nodes or blocks has more rows

    def contract(roots: DataFrame | None, measured: DataFrame) -> DataFrame:
        """Roots after the links among measured pairs."""
        edges = measured.where(linked).select("u", "v")
        if roots is not None:
            edges = edges.unionByName(roots.select(F.col("node").alias("u"), F.col("root").alias("v")))
        after = components(edges, measured.count() + nodes)
        if roots is not None:
            unpin(roots)
        return after

    tested = [_to_pivots(sets)]
    release_shuffles(spark)
    known = tested[0].where("total IS NOT NULL").select(F.col("u").alias("node"), F.col("v").alias("pivot"), (1 - F.col("common") / F.col("total")).alias("near"))
    roots = contract(None, tested[0])
    left = _open(blocks, roots, tested[0], tasks)
    unpin(blocks)
    # Nearest members are linked as long as a quarter of the pairs tested are links; so a group of near copies is contracted
    # by about as many pairs as it has members, before all pairs of different components are asked for.
    linking = True
    while linking:
        pairs = pin(_nearest(_cells(left, known, sets, len(tested)).where("i = j")), tasks)
        release_shuffles(spark)
        tested.append(_distances(pairs, sets))
        release_shuffles(spark)
        roots = contract(roots, tested[-1])
        before, left = left, _open(left, roots, tested[-1], tasks)
        unpin(before, pairs)
        tries, hits = tested[-1].agg(F.count("*"), F.count_if(linked)).first()
        linking = 4 * hits > tries
    done = _sides(reduce(DataFrame.unionByName, [t.select("u", "v") for t in tested])).distinct()
    pairs = pin(_all_pairs(_cells(left, known, sets)).join(done, ["u", "v"], "left_anti"))
    release_shuffles(spark)
    more = _distances(pairs, sets)
    roots = contract(roots, more)
    unpin(sets, pairs, more, left, *tested)
    release_shuffles(spark)
    return members, roots


def link_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable by links) of every document."""
    members, roots = similar_components(docs, id_col, text_col)
    placed = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    placed = pin(placed.select("doc_id", "n", "root"))
    least = placed.where("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("least"))
    return placed.join(least, "root", "left").select(
        F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id")
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with the smallest id of each component (of equal ids, one row); columns as they are."""
    members, roots = similar_components(docs, id_col, text_col)
    placed = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key_mark")
    placed = pin(placed.withColumn("place", order).select("key_id", "key_mark", "root", "place"))
    first = placed.where("root IS NOT NULL").groupBy("root").agg(F.min("place").alias("first"))
    a, b = fresh("key_id", docs), fresh("key_mark", docs)
    others = placed.join(first, "root").where("place <> first").select(F.col("key_id").alias(a), F.col("key_mark").alias(b)).distinct()
    keys = row_key(F.col(id_col), F.col(text_col))
    left = docs.withColumns({a: keys[0], b: keys[1]}).join(others, [a, b], "left_anti")
    return left.dropDuplicates([a, b]).select(docs.columns)
