"""Best-scoring candidates per query vector, computed in bounded tiles and only where a better one can lie.

Candidates are divided into cells around centres drawn from a sample of fixed size; a cell knows its radius and its largest norm.
What a query can score at most in a cell follows from these alone:

- Cauchy-Schwarz: no more than |q| times the largest norm, so cells of small norms fall away;
- the ball around the centre: no more than q.c + |q| r;
- the triangle inequality: every candidate is at least |q - c| - r away, and q.x = (|q|^2 + |x|^2 - |q - x|^2) / 2;
- the plane halfway to the centre a nearest to the query: candidates of c lie behind it, at least (|q - c|^2 - |q - a|^2) / 2|c - a| away.

A first pass scores each query in its most promising cell and gives the place to beat, the n-th best found there; a second pass sends
the query only to cells whose bound reaches it. Bounds carry a slack far above rounding errors, and ties are kept, so results are those
of all pairs. Every (block of a cell, part of its queries) tile is one key of a cogroup, scored as one small matrix product, and only its
best `n` per query leave the task as one row, in the second pass only those that come before the place to beat. No side is collected or
broadcast, and no pair of rows is materialised; centres, radii and norms of at most `MAX_CELLS` cells travel with the tasks. What a pass
has written is removed once the next has read it.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinis.session import pin, release_shuffles, unpin

SLICE_ROWS = 4_096
BLOCK_ROWS = 32_768
CHUNK_ROWS = 256  # query rows scored at once inside a task
CHUNK_BOUNDS = 1 << 16  # bounds of queries and cells found at once, few enough for a core's cache
GROUPED = 64  # columns whose largest score stands for them, at most
DIRECT_PAIRS = 1 << 30  # up to so many pairs scoring them all takes less time than finding cells
CELL_ROWS = 256  # fewer candidates are not worth a cell of their own
FINE_CELLS, MAX_CELLS = 64, 4_096  # least and most cells of many candidates; between them twice the square root of their number
SAMPLED = 8_192  # candidates from which centres are drawn, at most

_TILE_SCHEMA = "query_id BIGINT, items ARRAY<BIGINT>, scores ARRAY<DOUBLE>"
_PLACE = np.dtype([("score", np.float64), ("item", np.int64)])  # the place to beat: what comes after it is not wanted


def _best(
    scores: np.ndarray, n: int, digits: int | None, items: np.ndarray, places: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, score) of the n largest finite scores per row, rounded to `digits`; ties go to the lower column.

    The n-th largest of the maxima of column groups is reached by n scores at least, so only what reaches it is ranked, and of what
    just equals it the first n. `places` has the place to beat for each row; `items`, ascending, are the ids of the columns.
    """
    rows, columns = scores.shape
    size = min(GROUPED, columns // (4 * n))
    floor = np.full(rows, -np.inf)
    if size:
        groups = columns // size
        even = scores[:, : groups * size].reshape(rows, size, groups).max(axis=1)
        floor = np.partition(even, groups - n, axis=1)[:, groups - n]
        if digits is not None:
            floor = np.round(floor, digits) + 0.0
    if places is not None:
        floor = np.maximum(floor, places["score"])
    least = floor if digits is None else floor - 10.0**-digits  # whatever may round to the floor
    at, column = np.nonzero(scores >= least[:, None])
    value = scores[at, column]
    if digits is not None:
        value = np.round(value, digits) + 0.0  # no negative zero
    wanted = np.isfinite(value) & (value >= floor[at])
    if places is not None:
        wanted &= (value > places["score"][at]) | (items[column] < places["item"][at])
    at, column, value = at[wanted], column[wanted], value[wanted]
    equal = value == floor[at]
    count = np.concatenate([[0], np.cumsum(equal)])
    wanted = ~equal | (count[1:] - count[np.searchsorted(at, np.arange(rows))][at] <= n)
    at, column, value = at[wanted], column[wanted], value[wanted]
    order = np.lexsort((column, -value, at))
    at, column, value = at[order], column[order], value[order]
    place = np.arange(len(at)) - np.searchsorted(at, at)
    return at[place < n], column[place < n], value[place < n]


def _lists(ids: np.ndarray, rows: np.ndarray, items: np.ndarray, scores: np.ndarray) -> pa.Table:
    """One row for each of the `ids` that occurs in `rows`, ascending: its items and their scores."""
    starts = np.flatnonzero(np.diff(rows, prepend=-1))
    cuts = pa.array(np.append(starts, len(rows)), pa.int32())
    found = {"items": pa.array(items, pa.int64()), "scores": pa.array(scores, pa.float64())}
    lists = {name: pa.ListArray.from_arrays(cuts, values) for name, values in found.items()}
    return pa.table({"query_id": pa.array(ids[rows[starts]], pa.int64()), **lists})


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Vectors of one width as rows of a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1)


def _unpacked(packs: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, ascending, and vectors of packed rows, and the places to beat where the packs have any."""
    ids = np.concatenate([np.frombuffer(x.as_buffer(), np.int64) for x in packs["ids"]])
    flat = np.concatenate([np.frombuffer(x.as_buffer(), np.float64) for x in packs["vectors"]])
    order = np.argsort(ids, kind="stable")
    places = np.zeros(0, _PLACE)
    if "places" in packs.column_names:
        places = np.concatenate([np.frombuffer(x.as_buffer(), _PLACE) for x in packs["places"]])
    return ids[order], flat.reshape(len(ids), -1)[order], places[order] if len(places) else places


def _tile_scorer(n: int, digits: int | None, skip_same: bool):
    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        is_pack = pc.is_valid(left["ids"])
        packs, masked = left.filter(is_pack), left.filter(pc.invert(is_pack))
        none = np.zeros(0, np.int64)
        out = [_lists(none, none, none, none)]
        if not len(packs) or not len(right):
            return out[0]
        ids, queries, places = _unpacked(packs)
        items, candidates, _ = _unpacked(right)

        # Rows without a pack name the pairs of this tile to leave out.
        mask_query, mask_item = masked["query_id"].to_numpy(), masked["item_id"].to_numpy()
        here = np.isin(mask_query, ids) & np.isin(mask_item, items)
        mask_rows, mask_cols = np.searchsorted(ids, mask_query[here]), np.searchsorted(items, mask_item[here])
        if skip_same:
            same = np.flatnonzero(np.isin(ids, items))
            mask_rows = np.concatenate([mask_rows, same])
            mask_cols = np.concatenate([mask_cols, np.searchsorted(items, ids[same])])

        for start in range(0, len(ids), CHUNK_ROWS):
            stop = min(start + CHUNK_ROWS, len(ids))
            scores = queries[start:stop] @ candidates.T
            inside = (mask_rows >= start) & (mask_rows < stop)
            scores[mask_rows[inside] - start, mask_cols[inside]] = -np.inf
            rows, cols, values = _best(scores, n, digits, items, places[start:stop] if len(places) else None)
            out.append(_lists(ids[start:stop], rows, items[cols], values))
        return pa.concat_tables(out)

    return score


@dataclass
class Cells:
    """What is known of each cell: its centre, radius, largest norm and number of candidates. A candidate is in the cell of its
    nearest centre."""

    centres: np.ndarray
    radius: np.ndarray
    norm: np.ndarray
    rows: np.ndarray

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """(query, cell): a number that no score of the query in the cell exceeds."""
        lengths = np.linalg.norm(queries, axis=1)[:, None]
        squares = (self.centres**2).sum(axis=1)
        reach = lengths + self.norm
        scale = lengths + self.norm.max() + 2 * math.sqrt(squares.max())
        square = self._squares(queries, lengths**2, squares)
        home = np.argmin(square, axis=1)
        least = square[np.arange(len(home)), home][:, None]
        apart = np.maximum(self._squares(self.centres[home], squares[home, None], squares), (1e-5 * scale) ** 2)
        behind = (square - least) / np.sqrt(apart, out=apart)
        behind *= 0.5
        behind -= 1e-6 * scale
        gap = np.sqrt(np.maximum(square, 0.0, out=square), out=square)
        gap -= self.radius
        gap -= 1e-6 * reach
        np.maximum(gap, behind, out=gap)
        np.maximum(gap, 0.0, out=gap)
        near = lengths**2 + self.norm**2
        near -= np.square(gap, out=gap)
        near *= 0.5
        ball = np.hstack([queries, lengths]) @ np.hstack([self.centres, self.radius[:, None]]).T  # q.c + |q| r
        np.minimum(near, ball, out=near)
        np.minimum(near, lengths * self.norm, out=near)
        near += 1e-9 * np.square(reach, out=reach)
        return near

    def _squares(self, rows: np.ndarray, own: np.ndarray, squares: np.ndarray) -> np.ndarray:
        """(row, cell): the square of the distance from the centre, by one product; `own` and `squares` are those of the lengths."""
        ones = np.ones_like(own)
        return np.hstack([rows, own, ones]) @ np.hstack([-2 * self.centres, np.ones((len(squares), 1)), squares[:, None]]).T

    def home(self, bounds: np.ndarray, n: int) -> np.ndarray:
        """(query, cell): the cells of highest bound that together hold more than `n` candidates."""
        out = np.zeros(bounds.shape, dtype=bool)
        best = np.argmax(bounds, axis=1)
        out[np.arange(len(best)), best] = True
        few = np.flatnonzero(self.rows[best] <= n)
        if len(few):
            out[few] = self._several(bounds[few], n)
        return out

    def _several(self, bounds: np.ndarray, n: int) -> np.ndarray:
        # So many cells hold more than `n` whichever they are; only these are put in order.
        enough = int(np.searchsorted(np.cumsum(np.sort(self.rows)), n, side="right")) + 1
        if 4 * enough < bounds.shape[1]:
            order = np.sort(np.argpartition(-bounds, enough - 1, axis=1)[:, :enough], axis=1)
            order = np.take_along_axis(order, np.argsort(-np.take_along_axis(bounds, order, axis=1), axis=1, kind="stable"), axis=1)
        else:
            order = np.argsort(-bounds, axis=1, kind="stable")
        held = np.cumsum(self.rows[order], axis=1)
        first = np.concatenate([np.zeros((len(order), 1), dtype=held.dtype), held[:, :-1]], axis=1)
        out = np.zeros(bounds.shape, dtype=bool)
        np.put_along_axis(out, order, first <= n, axis=1)
        return out


def _centres(sample: np.ndarray, count: int) -> np.ndarray:
    """`count` means of a sample at most, some of them dropped where the sample has fewer different vectors."""
    centres = np.unique(sample, axis=0)
    draw = np.random.default_rng(7)
    centres = centres[np.sort(draw.choice(len(centres), min(count, len(centres)), replace=False))]
    for _ in range(8):
        nearest = _nearest(sample, centres)
        rows = np.bincount(nearest, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        centres = sums[rows > 0] / rows[rows > 0, None]
    return centres


def _nearest(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres**2).sum(axis=1)[None, :] / 2 - vectors @ centres.T, axis=1)


def _in_cells(candidates: DataFrame, count: int) -> tuple[DataFrame, Cells]:
    """Candidates with their cell, written once, and the cells; `unpin` removes what is written."""
    sample = candidates.orderBy(F.xxhash64("item_id"), "item_id").limit(min(SAMPLED, 16 * count)).collect()
    centres = _centres(np.array([r["vector"] for r in sample], dtype=np.float64), count)

    def place(batches):
        for batch in batches:
            vectors = _matrix(batch["vector"])
            cell = np.concatenate([_nearest(vectors[k : k + 4_096], centres) for k in range(0, len(vectors), 4_096)] or [[]])
            cell = cell.astype(np.int32)
            away, norm = np.linalg.norm(vectors - centres[cell], axis=1), np.linalg.norm(vectors, axis=1)
            yield pa.RecordBatch.from_pydict(
                {"cell": cell, "item_id": batch["item_id"], "vector": batch["vector"], "away": away, "norm": norm}
            )

    schema = "cell INT, item_id BIGINT, vector ARRAY<DOUBLE>, away DOUBLE, norm DOUBLE"
    placed = pin(candidates.select("item_id", "vector").mapInArrow(place, schema))
    stats = placed.groupBy("cell").agg(F.max("away").alias("away"), F.max("norm").alias("norm"), F.count(F.lit(1)).alias("n"))
    rows = stats.collect()  # a row a cell
    radius, norm, held = np.zeros(len(centres)), np.zeros(len(centres)), np.zeros(len(centres), dtype=np.int64)
    for r in rows:
        radius[r["cell"]], norm[r["cell"]], held[r["cell"]] = r["away"], r["norm"], r["n"]
    return placed, Cells(centres, radius, norm, held)


@dataclass
class _Deal:
    """Into how many blocks the candidates of a cell are dealt, and into how many parts its queries."""

    blocks: np.ndarray
    parts: np.ndarray
    tasks: int

    @staticmethod
    def of(rows: np.ndarray, visits: np.ndarray, slice_rows: int, block_rows: int, parallel: int) -> _Deal:
        blocks = np.maximum(1, -(-rows // block_rows))
        target = max(CHUNK_ROWS, min(slice_rows, math.ceil(int((visits * blocks).sum()) / parallel)))
        parts = -(-visits // target)
        return _Deal(blocks, parts, max(1, min(int((blocks * parts).sum()), parallel)))

    def table(self, spark) -> DataFrame:
        cells = [(c, int(b), int(p)) for c, (b, p) in enumerate(zip(self.blocks, self.parts)) if p]
        return spark.createDataFrame(cells, "cell INT, blocks INT, parts INT")


_PACK_SCHEMA = "cell INT, bucket INT, ids BINARY, vectors BINARY"


def _packed(rows: np.ndarray, cells: np.ndarray, buckets: np.ndarray, **columns: np.ndarray) -> pa.RecordBatch:
    """One row for each (cell, bucket) of a batch: the bytes that each of `columns` has for those of `rows` that go there."""
    order = np.lexsort((buckets, cells))
    rows, cells, buckets = rows[order], cells[order], buckets[order]
    cuts = np.flatnonzero((np.diff(cells, prepend=-1) != 0) | (np.diff(buckets, prepend=-1) != 0))
    groups = np.split(rows, cuts[1:]) if len(cuts) else []
    packs = {name: pa.array([values[g].tobytes() for g in groups], pa.binary()) for name, values in columns.items()}
    return pa.RecordBatch.from_pydict(
        {"cell": pa.array(cells[cuts], pa.int32()), "bucket": pa.array(buckets[cuts], pa.int32()), **packs}
    )


def _bucket_of(mix: np.ndarray, count: np.ndarray) -> np.ndarray:
    return np.mod(mix, np.maximum(count, 1))


def _ids(column) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64)


def _pairs(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, value) of the elements of a column of arrays."""
    sizes = np.diff(column.offsets.to_numpy())
    return np.repeat(np.arange(len(column)), sizes), np.asarray(column.flatten(), dtype=np.int64)


def _places(batch: pa.RecordBatch) -> np.ndarray:
    """The place to beat of each query: its n-th best so far, or one that everything comes before."""
    places = np.empty(len(batch), _PLACE)
    places["score"] = np.nan_to_num(batch["score"].to_numpy(zero_copy_only=False).astype(np.float64), nan=-np.inf, neginf=-np.inf)
    places["item"] = pc.fill_null(batch["item"], np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)
    return places


def _asking(queries: DataFrame, choose, n_cells: int) -> DataFrame:
    """Queries and the cells that `choose(vectors, places to beat, cells asked before)` marks for them, if any; written once."""
    again = "cells" in queries.columns
    size = max(1, CHUNK_BOUNDS // n_cells)
    names = ["query_id", "vector", "cells", *(["score", "item"] if again else [])]
    schema = "query_id BIGINT, vector ARRAY<DOUBLE>, cells ARRAY<INT>" + (", score DOUBLE, item BIGINT" if again else "")

    def ask(batches):
        for batch in batches:
            if not len(batch):
                continue
            vectors = _matrix(batch["vector"])
            places = _places(batch) if again else np.zeros(len(batch), _PLACE)
            row, cell = _pairs(batch["cells"]) if again else (np.zeros(0, np.int64), np.zeros(0, np.int64))
            rows, cells = [], []
            for k in range(0, len(vectors), size):
                inside = slice(*np.searchsorted(row, [k, k + size]))
                r, c = np.nonzero(choose(vectors[k : k + size], places[k : k + size], (row[inside] - k, cell[inside])))
                rows.append(r + k)
                cells.append(c)
            rows, cells = np.concatenate(rows), np.concatenate(cells)
            starts = np.flatnonzero(np.diff(rows, prepend=-1))
            lists = pa.ListArray.from_arrays(pa.array(np.append(starts, len(rows)), pa.int32()), pa.array(cells, pa.int32()))
            kept = batch.take(pa.array(rows[starts]))
            yield pa.RecordBatch.from_pydict({c: lists if c == "cells" else kept[c] for c in names})

    return pin(queries.select(*(c for c in names if c in queries.columns)).mapInArrow(ask, schema))


def _visits(asked: DataFrame, n_cells: int) -> np.ndarray:
    """How many queries go to each cell."""
    out = np.zeros(n_cells, dtype=np.int64)
    for r in asked.select(F.explode("cells").alias("cell")).groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect():  # a row a cell
        out[r["cell"]] = r["n"]
    return out


def _query_packs(asked: DataFrame, deal: _Deal) -> DataFrame:
    again = "score" in asked.columns

    def pack(batches):
        for batch in batches:
            if not len(batch):
                continue
            rows, cells = _pairs(batch["cells"])
            part = _bucket_of(_ids(batch["mix"])[rows], deal.parts[cells])
            places = _places(batch) if again else np.zeros((len(batch), 0))
            yield _packed(rows, cells, part, ids=_ids(batch["query_id"]), vectors=_matrix(batch["vector"]), places=places)

    return asked.select("*", F.xxhash64("query_id").alias("mix")).mapInArrow(pack, _PACK_SCHEMA + ", places BINARY")


def _candidate_packs(placed: DataFrame, deal: _Deal) -> DataFrame:
    def pack(batches):
        for batch in batches:
            cells = batch["cell"].to_numpy().astype(np.int64)
            rows = np.flatnonzero(deal.parts[cells])  # candidates of cells that nobody visits stay
            block = _bucket_of(_ids(batch["mix"])[rows], deal.blocks[cells[rows]])
            yield _packed(rows, cells[rows], block, ids=_ids(batch["item_id"]), vectors=_matrix(batch["vector"]))

    return placed.select("cell", "item_id", "vector", F.xxhash64("item_id").alias("mix")).mapInArrow(pack, _PACK_SCHEMA)


def _every(count: str):
    return F.explode(F.sequence(F.lit(0), F.col(count) - 1))


def _tiles(left: DataFrame, right: DataFrame, tasks: int, scorer) -> DataFrame:
    """Left and right rows of one (cell, block, part) meet; few bytes but much work a tile, so the task count is fixed."""
    keys = ["cell", "block", "part"]
    return (
        left.repartition(tasks, *keys)
        .groupBy(*keys)
        .cogroup(right.repartition(tasks, *keys).groupBy(*keys))
        .applyInArrow(scorer, _TILE_SCHEMA)
    )


def _scored(query_packs: DataFrame, candidate_packs: DataFrame, masked: DataFrame | None, deal: _Deal, scorer) -> DataFrame:
    dealt = F.broadcast(deal.table(query_packs.sparkSession))  # a row a cell
    absent = F.lit(None).cast("binary")
    left = query_packs.join(dealt, "cell").select(
        "cell",
        _every("blocks").alias("block"),
        F.col("bucket").alias("part"),
        F.lit(None).cast("long").alias("query_id"),
        F.lit(None).cast("long").alias("item_id"),
        "ids",
        "vectors",
        "places",
    )
    if masked is not None:
        if len(deal.blocks) == 1:  # a join on one known cell would have no key
            placed = masked.withColumns({"blocks": F.lit(int(deal.blocks[0])), "parts": F.lit(max(1, int(deal.parts[0])))})
        else:
            placed = masked.join(dealt, "cell")
        left = left.unionByName(
            placed.select(
                "cell",
                F.pmod(F.xxhash64("item_id"), "blocks").cast("int").alias("block"),
                F.pmod(F.xxhash64("query_id"), "parts").cast("int").alias("part"),
                "query_id",
                "item_id",
                absent.alias("ids"),
                absent.alias("vectors"),
                absent.alias("places"),
            )
        )
    right = candidate_packs.join(dealt, "cell").select(
        "cell", F.col("bucket").alias("block"), _every("parts").alias("part"), "ids", "vectors"
    )
    return _tiles(left, right, deal.tasks, scorer)


def top_candidates(
    queries: DataFrame,
    candidates: DataFrame,
    n: int,
    excluded: DataFrame | None = None,
    digits: int | None = None,
    slice_rows: int = SLICE_ROWS,
    block_rows: int = BLOCK_ROWS,
    cell_rows: int = CELL_ROWS,
    direct_pairs: int = DIRECT_PAIRS,
    skip_same: bool = False,
) -> DataFrame:
    """(query_id, item_id, score, rank) of the n best candidates per query.

    `queries` is (query_id, vector), `candidates` (item_id, vector), both unique by id, of one width, and read more than once:
    give written tables. `excluded` is (query_id, item_id); `skip_same` leaves out the candidate with the query's own id. Scores
    are dot products, rounded to `digits` when given; equal scores rank by item_id.
    """
    asked, total = queries.count(), candidates.count()
    parallel = int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    scorer = _tile_scorer(n, digits, skip_same)
    count = min(MAX_CELLS, max(math.ceil(total / block_rows), min(max(FINE_CELLS, 2 * math.isqrt(total)), total // cell_rows)))
    if asked * total <= direct_pairs and total <= block_rows:
        count = 1
    if count <= 1:  # one cell holds all: every query goes there
        whole = F.lit(0).alias("cell")
        deal = _Deal.of(np.array([total]), np.array([asked]), slice_rows, block_rows, parallel)

        packs = _query_packs(queries.select("query_id", "vector", F.array(F.lit(0)).alias("cells")), deal)
        masked = None if excluded is None else excluded.select(whole, "query_id", "item_id")
        return _ranked(_scored(packs, _candidate_packs(candidates.select(whole, "item_id", "vector"), deal), masked, deal, scorer), n)

    placed, cells = _in_cells(candidates, count)
    masked = None
    if excluded is not None:
        masked = pin(excluded.select("query_id", "item_id").join(placed.select("item_id", "cell"), "item_id"))

    def at_home(vectors, places, before):
        return cells.home(cells.bounds(vectors), n)

    def still_open(vectors, places, before):
        bounds = cells.bounds(vectors)
        least = places["score"] if digits is None else places["score"] - 0.51 * 10.0**-digits  # whatever may round to it
        chosen = (bounds >= least[:, None]) & (cells.rows > 0)
        chosen[before] = False
        return chosen

    def visit(asked: DataFrame) -> DataFrame:
        deal = _Deal.of(cells.rows, _visits(asked, len(cells.rows)), slice_rows, block_rows, parallel)
        found = pin(_scored(_query_packs(asked, deal), _candidate_packs(placed, deal), masked, deal, scorer))
        release_shuffles(queries.sparkSession)
        return found

    asked = _asking(queries, at_home, len(cells.rows))
    first = visit(asked)
    place = F.get(F.array_sort(F.flatten(F.collect_list(_ordered()))), F.lit(n - 1))
    to_beat = first.groupBy("query_id").agg(place.alias("place"))
    scores = to_beat.select("query_id", (-F.col("place.away")).alias("score"), F.col("place.item_id").alias("item"))
    again = _asking(asked.join(scores, "query_id", "left"), still_open, len(cells.rows))
    unpin(asked)
    second = visit(again)
    unpin(again, placed, *([] if masked is None else [masked]))
    return _ranked(first.unionByName(second), n)


def _ordered():
    """The found of a row as (away, item_id), which sorts as they rank."""
    return F.transform("items", lambda item, k: F.struct((-F.get("scores", k)).alias("away"), item.alias("item_id")))


def _ranked(found: DataFrame, n: int) -> DataFrame:
    near = F.slice(F.array_sort(F.flatten(F.collect_list(_ordered()))), 1, n)
    return (
        found.groupBy("query_id")
        .agg(near.alias("near"))
        .select("query_id", F.posexplode("near").alias("at", "x"))
        .select(
            "query_id",
            F.col("x.item_id").alias("item_id"),
            (F.lit(0.0) - F.col("x.away")).alias("score"),
            (F.col("at") + 1).cast("long").alias("rank"),
        )
    )
