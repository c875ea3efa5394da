"""Documents that hold a benchmark item, found by edit distance.

A document is contaminated by an item if some part of it is within PERCENT of the item's length in edits. Texts are compared
as UTF-8 bytes with A-Z lowered and white space runs as one space; distances count bytes.

1. Windows: an item is cut into parts of at most WALKED bytes, as walks over longer strings seldom keep in step. If the item
   is there, a part of it is there with at most PERCENT of the part's own length in edits. Of a part cut into edits + 1 pieces one
   must survive that, so only places where a piece occurs can start a match; each gives the part-sized window at the place it
   implies. All but the item's edits of all its pieces survive, and the starts of the item that they imply differ by no more than
   these edits; windows without so many pieces in a band of that width go. Neither loses anything: a piece that survives is off its
   place by no more than the edits before it, which the walks and the exact check allow for.
2. The CGK embedding walks a window with random steps (one bit for each step and byte) and writes the byte under it; walks over
   similar strings fall into step again after an edit, so edit distance becomes Hamming distance.
3. Bit sampling: a window is a candidate if, in one of WALKS * TABLES samples of SAMPLES positions, it agrees with the part, and
   its Hamming distance over all sampled positions is not that of unrelated text. The numbers give a recall of RECALL or more
   at the largest allowed distance, for items of any length (measured in the tests); exact copies always pass.
4. The item is verified around each candidate by exact edit distance (bit-parallel, free ends in the document).

Documents are read once for each block of items, and nothing is shuffled; a block is bounded by BLOCK_BYTES and is the only
thing broadcast. A benchmark of many blocks is read through the driver, block by block, and takes as many scans of the documents.
The walks' tables and buffers are bounded by WALKED, and what is held of a long item by its pieces.

Defined cases: null and empty documents and items match nothing; items of the same text are reported each; repeated rows are
reported as often as they occur; an empty table gives no rows; other columns are kept where documents are returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinis.llm.textscan import BYTE_VALUES, LOWERED, column_bytes, mix, powers

PERCENT, RECALL = 10, 0.95
PIECE = 9
WALKED = 160
WALKS, TABLES, SAMPLES = 6, 8, 4
# Chance agreement of unrelated text is about 0.08 of the places; at the largest distance it is mostly over 0.3.
CLOSE, REACH = 0.2, 1.8
BLOCK_BYTES = 4 << 20
LIMIT = 1 << 20
# Hits of pieces held at a time before equal places are made one.
HITS = 1 << 20
FILTER_BITS = 20


def normal(text: bytes) -> bytes:
    return b" ".join(text.translate(LOWERED).split())


class Items:
    """A block of items: their parts, the pieces of these by length, and the parts' embeddings at the sampled positions."""

    def __init__(self, rows: list[tuple[int, bytes]]):
        self.ids = [i for i, _ in rows]
        self.texts = [t for _, t in rows]
        self.lengths = np.array([len(t) for t in self.texts], dtype=np.int64)
        self.edits = self.lengths * PERCENT // 100
        # Item, place in it, and length of each part.
        parts = [(k, *span) for k, n in enumerate(self.lengths.tolist()) for span in _cuts(n, -(-n // WALKED))]
        self.owner, self.offset, self.part_lengths = np.array(parts, dtype=np.int64).reshape(-1, 3).T
        # Pieces of an item that must survive in one place.
        self.least = -self.edits
        pieces: dict[int, list[tuple[int, int, int]]] = {}
        for part, (k, begin, n) in enumerate(parts):
            text = self.texts[k][begin : begin + n]
            cuts = _cuts(n, n * PERCENT // 100 + 1)
            q = min(PIECE, n // len(cuts))
            hashes = gram_hashes(np.frombuffer(text, np.uint8), q)
            for at, _ in cuts:
                pieces.setdefault(q, []).append((int(hashes[at]), part, at))
            self.least[k] += len(cuts)
        self.pieces = {}
        for q, found in pieces.items():
            found.sort()
            h = np.array([f[0] for f in found], dtype=np.uint64)
            sieve = np.zeros(1 << FILTER_BITS, dtype=bool)
            sieve[h >> np.uint64(64 - FILTER_BITS)] = True
            self.pieces[q] = (h, np.array([f[1] for f in found]), np.array([f[2] for f in found]), sieve)
        data = np.frombuffer(b"".join(self.texts) + b"\0", dtype=np.uint8)
        base = np.cumsum(self.lengths) - self.lengths
        self.samples = embed(data, base[self.owner] + self.offset, self.part_lengths)


def _cuts(n: int, parts: int) -> list[tuple[int, int]]:
    """Place and length of the almost equal parts of n bytes."""
    edges = [j * n // parts for j in range(parts + 1)]
    return [(lo, hi - lo) for lo, hi in zip(edges, edges[1:])]


def gram_hashes(data: np.ndarray, q: int) -> np.ndarray:
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(BYTE_VALUES[data] * up[:-1], out=total[1:])
    n = max(0, len(data) - q + 1)
    return mix((total[q : q + n] - total[:n]) * down[:n])


_draw = np.random.default_rng(77)
STEPS: list[np.ndarray] = []
# Sampled places, as shares of the walk's length; a walk needs about two steps a byte.
PLACES = _draw.random((WALKS, TABLES * SAMPLES))


def _steps(n: int) -> list[np.ndarray]:
    """Random bits of each walk, for at least n steps and every byte."""
    if not STEPS or len(STEPS[0]) < n:
        size = 1 << max(10, (n - 1).bit_length())
        STEPS[:] = [np.random.default_rng([5, w]).integers(0, 2, (size, 256), dtype=np.int64) for w in range(WALKS)]
    return STEPS


def embed(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Sampled bytes of the CGK embeddings of data[start : start + length]: (windows, WALKS, TABLES * SAMPLES).

    Samples end after REACH steps a byte, where few walks have left their window; those read what follows it.
    """
    out = np.zeros((len(start), WALKS, TABLES * SAMPLES), dtype=np.uint8)
    order = np.argsort(length, kind="stable")
    data = np.concatenate([data, np.zeros(int(REACH * length.max(initial=0)) + 2, dtype=np.uint8)])
    for lo in range(0, len(order), 8192):
        rows = order[lo : lo + 8192]
        n = length[rows]
        steps = int(REACH * n.max(initial=0)) + 1
        for w, bits in enumerate(_steps(steps)):
            wanted = np.floor(PLACES[w][None, :] * (REACH * n)[:, None]).astype(np.int64)
            written = np.empty((steps, len(rows)), dtype=np.uint8)
            at, step = start[rows].astype(np.int64), np.empty(len(rows), dtype=np.int64)
            for j in range(steps):
                np.take(data, at, out=written[j], mode="clip")
                np.take(bits[j], written[j], out=step, mode="clip")
                at += step
            out[rows, w] = written[wanted.T, np.arange(len(rows))].T
    return out


def agree(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether two embeddings collide in one of the tables, and agree in CLOSE of all sampled places."""
    same = (a == b).reshape(len(a), WALKS * TABLES, SAMPLES)
    hit = same.all(axis=2).any(axis=1)
    hit[hit] = same[hit].mean(axis=(1, 2)) >= CLOSE
    return hit


def edit_distance_within(item: bytes, text: bytes) -> int:
    """Smallest number of edits that make `item` a part of `text` (bit-parallel, one step a byte)."""
    m = len(item)
    mask, top = (1 << m) - 1, 1 << (m - 1)
    where: dict[int, int] = {}
    for k, c in enumerate(item):
        where[c] = where.get(c, 0) | 1 << k
    up, down, score, best = mask, 0, m, m
    for c in text:
        eq = where.get(c, 0)
        xv = eq | down
        xh = (((eq & up) + up) ^ up) | eq
        plus, minus = down | ~(xh | up) & mask, up & xh
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        best = min(best, score)
        plus, minus = plus << 1 & mask, minus << 1 & mask
        up, down = minus | ~(xv | plus) & mask, plus & xv
    return best


def _windows(items: Items, data: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, part, start, pieces) of the distinct part-sized windows, in order; first: where each document begins in data.

    The start is the one implied by the pieces, and may lie before the document.
    """
    found = []
    for q, (keys, part, offset, sieve) in items.pieces.items():
        h = gram_hashes(data, q)
        at = np.flatnonzero(sieve[h >> np.uint64(64 - FILTER_BITS)])
        lo, hi = np.searchsorted(keys, h[at]), np.searchsorted(keys, h[at], side="right")
        at, lo, n = at[hi > lo], lo[hi > lo], (hi - lo)[hi > lo]
        cuts = np.flatnonzero(np.diff(np.cumsum(n) // HITS)) + 1
        for at, lo, n in zip(*[np.split(x, cuts) for x in (at, lo, n)]):
            which = np.arange(n.sum()) + np.repeat(lo - (np.cumsum(n) - n), n)
            at = np.repeat(at, n)
            doc = np.searchsorted(first, at, side="right") - 1
            found.append(_distinct(doc, part[which], at - offset[which], np.ones(len(at), dtype=np.int64)))
    if not found:
        return tuple(np.empty((4, 0), dtype=np.int64))
    return _distinct(*[np.concatenate(c) for c in zip(*found)])


def _distinct(doc, part, start, pieces):
    """Rows with the same document, part and start made one, in order, their pieces added up."""
    order = np.lexsort((start, part, doc))
    doc, part, start, pieces = doc[order], part[order], start[order], pieces[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (part[1:] != part[:-1]) | (start[1:] != start[:-1])
    return doc[new], part[new], start[new], np.add.reduceat(pieces, np.flatnonzero(new)) if len(doc) else pieces


def _banded(items: Items, doc, part, start, pieces) -> np.ndarray:
    """Whether a window is in a band, as wide as its item's edits, with as many of the item's pieces as must survive."""
    item, start = items.owner[part], start - items.offset[part]
    order = np.lexsort((start, item, doc))
    doc, item, start = doc[order], item[order], start[order]
    pair = np.zeros(len(doc), dtype=np.int64)
    pair[1:] = np.cumsum((doc[1:] != doc[:-1]) | (item[1:] != item[:-1]))
    edits, low = items.edits[item], start.min(initial=0)
    key = pair * int(start.max(initial=0) - low + edits.max(initial=0) + 1) + start - low
    total = np.concatenate([[0], np.cumsum(pieces[order])])
    # Bands that begin at a window, then windows with such a band no more than its width before them.
    begins = total[np.searchsorted(key, key + edits, side="right")] - total[np.searchsorted(key, key)] >= items.least[item]
    bands = np.concatenate([[0], np.cumsum(begins)])
    keep = np.empty(len(doc), dtype=bool)
    keep[order] = bands[np.searchsorted(key, key, side="right")] > bands[np.searchsorted(key, key - edits)]
    return keep


def _walked(items: Items, data, first, lengths, doc, part, start) -> np.ndarray:
    """Whether the walks take a window for a candidate."""
    start = np.maximum(start, first[doc])
    keep = np.zeros(len(doc), dtype=bool)
    for lo in range(0, len(doc), 1 << 16):
        s = slice(lo, lo + (1 << 16))
        length = np.minimum(items.part_lengths[part[s]], (first + lengths)[doc[s]] - start[s])
        # The walk is that of the part's length; what the document lacks reads as zero.
        keep[s] = agree(_embed_as(data, start[s], length, items.part_lengths[part[s]]), items.samples[part[s]])
    return keep


def _places(items: Items, doc, part, start):
    """(document, item, from, to) where the items of some windows are to be verified; places of one item that overlap are one."""
    item, start = items.owner[part], start - items.offset[part]
    order = np.lexsort((start, item, doc))
    doc, item, start = doc[order], item[order], start[order]
    slack = 2 * items.edits[item] + 12
    lo, hi = start - slack, start + items.lengths[item] + slack
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (lo[1:] > hi[:-1])
    last = np.ones(len(doc), dtype=bool)
    last[:-1] = new[1:]
    return doc[new], item[new], lo[new], hi[last]


def matches(items: Items, texts: list[bytes]) -> Iterator[tuple[int, int, int]]:
    """(document number, item number, distance) for the items found in some texts."""
    plain = [normal(t) for t in texts]
    joined = b"\n".join(plain) + b"\n"
    data = np.frombuffer(joined, dtype=np.uint8)
    lengths = np.array([len(t) for t in plain], dtype=np.int64)
    first = np.cumsum(lengths + 1) - (lengths + 1)
    doc, part, start, pieces = _windows(items, data, first)
    keep = _banded(items, doc, part, start, pieces)
    doc, part, start = doc[keep], part[keep], start[keep]
    keep = _walked(items, data, first, lengths, doc, part, start)
    best: dict[tuple[int, int], int] = {}
    for d, i, lo, hi in zip(*[c.tolist() for c in _places(items, doc[keep], part[keep], start[keep])]):
        if best.get((d, i)) == 0:
            continue
        edits = int(items.edits[i])
        text = joined[max(lo, int(first[d])) : min(hi, int(first[d] + lengths[d]))]
        distance = edit_distance_within(items.texts[i], text)
        if distance <= edits and distance < best.get((d, i), edits + 1):
            best[d, i] = distance
    yield from ((d, i, x) for (d, i), x in sorted(best.items()))


def _embed_as(data, start, length, walked):
    """embed(), with the walk laid out for `walked` bytes and zeros after `length`."""
    short = length < walked
    if not short.any():
        return embed(data, start, walked)
    # Few windows reach beyond their document: give each a padded copy of its own.
    extra, at = [data], len(data)
    start = start.copy()
    for k in np.flatnonzero(short):
        own = np.zeros(int(walked[k]), dtype=np.uint8)
        own[: int(length[k])] = data[start[k] : start[k] + length[k]]
        extra.append(own)
        start[k], at = at, at + len(own)
    return embed(np.concatenate(extra), start, walked)


def item_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> Iterator[Items]:
    """The items in blocks of at most BLOCK_BYTES (or one item), in order of their ids, empty ones left out."""
    rows, size = [], 0
    for r in benchmark.select(F.col(id_col).cast("long"), F.col(text_col)).orderBy(id_col, text_col).toLocalIterator():
        text = normal((r[1] or "").encode())
        if not text:
            continue
        if rows and size + len(text) > BLOCK_BYTES:
            yield Items(rows)
            rows, size = [], 0
        rows.append((r[0], text))
        size += len(text)
    if rows:
        yield Items(rows)


def _scan(batch, column: int, items: Items) -> Iterator[tuple[int, int, int]]:
    texts, lo, held = column_bytes(batch.column(column)), 0, 0
    for k, t in enumerate(texts):
        held += len(t)
        if held >= LIMIT or k == len(texts) - 1:
            for d, i, x in matches(items, texts[lo : k + 1]):
                yield lo + d, i, x
            lo, held = k + 1, 0


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, item_id, distance: every document and item that match."""
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    schema = "doc_id long, item_id long, distance long"
    out = docs.sparkSession.createDataFrame([], schema)
    for items in item_blocks(benchmark):
        held = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches, held=held):
            for batch in batches:
                found = list(_scan(batch, 1, held.value))
                ids = batch.column(0).take(pa.array([f[0] for f in found], pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array([held.value.ids[f[1]] for f in found], pa.int64()), pa.array([f[2] for f in found], pa.int64())],
                    ["doc_id", "item_id", "distance"],
                )

        out = out.unionByName(slim.mapInArrow(run, schema))
    return out


def without_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents in which no item was found, with all their columns."""
    at = docs.columns.index(text_col)
    for items in item_blocks(benchmark):
        held = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches, held=held):
            for batch in batches:
                good = np.ones(batch.num_rows, dtype=bool)
                good[[f[0] for f in _scan(batch, at, held.value)]] = False
                yield batch.filter(pa.array(good))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
