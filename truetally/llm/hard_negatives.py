"""Operator 12: hard negatives by blocked exact products and mergeable heaps.

Components are quantised to integers, so that scores (inner products) are
exact. Rows are packed into tiles of at most ``TILE`` rows; the anchors' tiles
meet the tiles of all rows in an equi-join on tile numbers, and each pair of
tiles is multiplied by Strassen's recursion on int64 blocks: quadrants padded
with zeros, seven products instead of eight, exact additions (modulo 2**64,
which leaves every score that fits in 64 bits right).

Two passes. The first keeps a positive heap per anchor: its best rows of the
same label. The second keeps a window heap per anchor and positive: the best
rows of other labels whose score lies between ``low`` and ``high`` percent of
the positive's. A heap holds distinct (score, id) entries in order (higher
scores first, ties by smaller id), is cut to its size as entries come, and
heaps merge by union: tasks merge theirs over all tiles they see, and a ranking
that is cut before its shuffle merges the tasks'.

Memory of a task: a batch of tile pairs and heaps of ``HELD`` entries; beyond
that heaps are handed on early. The anchors' tiles are broadcast while their
counted bytes are below ``BROADCAST_BYTES``; beyond it tiles of all rows are
dealt by (anchor tile, salt), so no key holds more than ``PER_SALT`` of them.

Defined cases: rows without an id, label or vector, or with a null or
non-finite component take no part; a shorter vector counts as extended by zeros;
rows that agree in score and id are one entry of a heap; repeated anchor rows
(id, label and vector) count once; anchors with one id and differing vectors are
each mined; a row with the anchor's id is never its positive. Components and
products must fit: OverflowError if a tile pair's scores could exceed 2**60.
Labels are integers. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from truetally.llm.common import arrow_column, on_workers, written, written_counting

TILE, LEAF = 256, 32
POSITIVES, NEGATIVES, LOW, HIGH, SCALE = 5, 10, 30, 90, 256
BROADCAST_BYTES, PER_SALT, HELD = 32 << 20, 64, 2_000_000
_NEVER = -(1 << 62)


# --- exact products

def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b`` of int64 matrices, exact modulo 2**64."""
    levels = 0
    while min(*a.shape, b.shape[1]) >> (levels + 1) >= LEAF:
        levels += 1
    block = 1 << levels
    padded = [np.pad(x, [(0, -n % block) for n in x.shape]) for x in (a, b)]
    return _product(*padded, levels)[:a.shape[0], :b.shape[1]]


def _product(a: np.ndarray, b: np.ndarray, levels: int) -> np.ndarray:
    if not levels:
        return a @ b
    m, k, n = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:m, :k], a[:m, k:], a[m:, :k], a[m:, k:]
    b11, b12, b21, b22 = b[:k, :n], b[:k, n:], b[k:, :n], b[k:, n:]
    p1 = _product(a11 + a22, b11 + b22, levels - 1)
    p2 = _product(a21 + a22, b11, levels - 1)
    p3 = _product(a11, b12 - b22, levels - 1)
    p4 = _product(a22, b21 - b11, levels - 1)
    p5 = _product(a11 + a12, b22, levels - 1)
    p6 = _product(a21 - a11, b11 + b12, levels - 1)
    p7 = _product(a12 - a22, b21 + b22, levels - 1)
    out = np.empty((2 * m, 2 * n), np.int64)
    out[:m, :n], out[:m, n:] = p1 + p4 - p5 + p7, p3 + p5
    out[m:, :n], out[m:, n:] = p2 + p4, p1 - p2 + p3 + p6
    return out


def quantised(vectors: pa.ListArray, scale: int) -> np.ndarray:
    """floor(scale * x) of each component, rows of equal width (shorter ones extended by zeros)."""
    size = np.array(vectors.value_lengths().to_numpy(zero_copy_only=False), np.int64)
    flat = np.floor(scale * vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    if len(flat) and np.abs(flat).max() >= 2.0 ** 31:
        raise OverflowError("a component doesn't fit in 32 bits after scaling")
    width = int(size.max(initial=1))
    out = np.zeros((len(size), width), np.int64)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


# --- tiles

_TILE = "ids binary, labels binary, width int, cells binary"


def _pack(ids: np.ndarray, labels: np.ndarray, cells: np.ndarray) -> list:
    by = np.argsort(ids, kind="stable")  # so that equal scores come in order of the ids
    return [ids[by].tobytes(), labels[by].tobytes(), cells.shape[1], cells[by].astype(np.int32).tobytes()]


def _unpack(ids, labels, width, cells) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return (np.frombuffer(ids.as_buffer(), np.int64), np.frombuffer(labels.as_buffer(), np.int64),
            np.frombuffer(cells.as_buffer(), np.int32).reshape(-1, width.as_py()).astype(np.int64))


def tile_batches(batches: Iterator[pa.RecordBatch], scale: int) -> Iterator[pa.RecordBatch]:
    """Tiles of the rows of a task."""
    for batch in batches:
        ids, labels = (arrow_column(batch, x).to_numpy(zero_copy_only=False) for x in ("_id", "_label"))
        vectors = arrow_column(batch, "_vec")
        for i in range(0, batch.num_rows, TILE):
            row = _pack(ids[i:i + TILE], labels[i:i + TILE], quantised(vectors.slice(i, TILE), scale))
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in
                                              zip(row, (pa.binary(), pa.binary(), pa.int32(), pa.binary()), strict=True)],
                                             names=["ids", "labels", "width", "cells"])


def anchor_tile_batches(batches: Iterator[pa.RecordBatch], scale: int) -> Iterator[pa.RecordBatch]:
    """Tiles of anchors, one per tile number or a few where a number has more than ``TILE``; rows come sorted by it."""
    for batch in batches:
        tiles = arrow_column(batch, "_tile").to_numpy()
        cuts = np.flatnonzero(np.diff(tiles)) + 1
        for a, b in zip(np.r_[0, cuts], np.r_[cuts, len(tiles)], strict=True):
            part = batch.slice(a, b - a)
            for packed in tile_batches(iter([part]), scale):
                yield pa.RecordBatch.from_arrays([pa.array([tiles[a]], pa.int64()), *packed.columns],
                                                 names=["tile", *packed.schema.names])


def _scores(batch: pa.RecordBatch, k: int) -> tuple[np.ndarray, ...]:
    """(anchor ids, anchor labels, row ids, row labels, scores) of a pair of tiles."""
    a_ids, a_labels, a = _unpack(*(arrow_column(batch, f"a_{x}")[k] for x in ("ids", "labels", "width", "cells")))
    ids, labels, c = _unpack(*(arrow_column(batch, x)[k] for x in ("ids", "labels", "width", "cells")))
    width = max(a.shape[1], c.shape[1])
    if float(np.abs(a).max(initial=0)) * float(np.abs(c).max(initial=0)) * width >= 2.0 ** 60:
        raise OverflowError("scores of these vectors may not fit in 64 bits")
    a, c = (np.pad(x, [(0, 0), (0, width - x.shape[1])]) for x in (a, c))
    return a_ids, a_labels, ids, labels, strassen(a, np.ascontiguousarray(c.T))


# --- heaps

class Heaps:
    """Bounded heaps of many groups: distinct (score, id) entries, the first ``size`` of each group."""

    def __init__(self, size: int):
        self.size, self.cut_at = size, 1 << 18
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = 0

    def push(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        self.parts.append((group, score, ids))
        self.held += len(group)
        if self.held >= self.cut_at:
            self.cut()
            self.cut_at = max(self.cut_at, 2 * self.held)

    def cut(self) -> None:
        if not self.parts:
            return
        group, score, ids = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        by = np.lexsort((ids, -score, group))
        group, score, ids = group[by], score[by], ids[by]
        fresh = np.r_[True, (group[1:] != group[:-1]) | (score[1:] != score[:-1]) | (ids[1:] != ids[:-1])]
        group, score, ids = group[fresh], score[fresh], ids[fresh]
        head = np.r_[True, group[1:] != group[:-1]]
        at = np.arange(len(group))
        keep = at - np.maximum.accumulate(np.where(head, at, 0)) < self.size
        self.parts = [(group[keep], score[keep], ids[keep])]
        self.held = int(keep.sum())

    def out(self) -> Iterator[pa.RecordBatch]:
        self.cut()
        for group, score, ids in self.parts:
            for i in range(0, len(group), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(x[i:i + (1 << 16)]) for x in (group, score, ids)],
                                                 names=["slot", "score", "id"])
        self.parts, self.held = [], 0


_HEAP = "slot long, score long, id long"


def positive_batches(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Positive heaps: slot is the anchor's number."""
    heaps = Heaps(size)
    for batch in batches:
        number = arrow_column(batch, "number").to_numpy()
        for k in range(batch.num_rows):
            a_ids, a_labels, ids, labels, s = _scores(batch, k)
            out = (a_labels[:, None] != labels) | (a_ids[:, None] == ids)
            s = np.where(out, _NEVER, s)
            # more than ``size`` entries may be repeated rows, which the heap merges
            rows, at = _first(s, size, ids)
            heaps.push(number[k] * TILE + rows, s[rows, at], ids[at])
        if heaps.held > HELD:
            yield from heaps.out()
    yield from heaps.out()


def _first(s: np.ndarray, size: int, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the first ``size`` distinct entries of each row; columns are in order of ids."""
    by = np.argsort(-s, axis=1, kind="stable")
    if len(ids) > 1 and (ids[1:] == ids[:-1]).any():
        sorted_s = np.take_along_axis(s, by, 1)
        sorted_i = ids[by]
        fresh = np.ones(by.shape, bool)
        fresh[:, 1:] = (sorted_s[:, 1:] != sorted_s[:, :-1]) | (sorted_i[:, 1:] != sorted_i[:, :-1])
        keep = fresh & (np.cumsum(fresh, axis=1) <= size)
    else:
        keep = np.zeros(by.shape, bool)
        keep[:, :size] = True
    row, place = np.nonzero(keep)
    at = by[row, place]
    some = s[row, at] != _NEVER
    return row[some], at[some]


def negative_batches(batches: Iterator[pa.RecordBatch], size: int, positives: int, low: int, high: int) -> Iterator[pa.RecordBatch]:
    """Window heaps: slot is the anchor's number times ``positives`` and the positive's place from 0."""
    heaps = Heaps(size)
    for batch in batches:
        number = arrow_column(batch, "number").to_numpy()
        lists = arrow_column(batch, "wanted")
        for k in range(batch.num_rows):
            _, a_labels, ids, labels, s = _scores(batch, k)
            wanted = lists[k].values
            slot, score = (wanted.field(x).to_numpy(zero_copy_only=False) for x in ("slot", "score"))
            row = slot // positives - number[k] * TILE
            other = a_labels[row][:, None] != labels
            from_, to = -(-low * score // 100), high * score // 100
            window = np.where(other & (s[row] >= from_[:, None]) & (s[row] <= to[:, None]), s[row], _NEVER)
            hit = (window != _NEVER).any(axis=1)
            if hit.any():
                rows, at = _first(window[hit], size, ids)
                heaps.push(slot[hit][rows], window[hit][rows, at], ids[at])
        if heaps.held > HELD:
            yield from heaps.out()
    yield from heaps.out()


def merged(heaps: DataFrame, size: int) -> DataFrame:
    """Heaps of tasks merged: (slot, rank, score, id)."""
    order = Window.partitionBy("slot").orderBy(F.col("score").desc(), "id")
    return heaps.withColumn("rank", F.dense_rank().over(order)).where(F.col("rank") <= size).distinct()


def hard_negatives(rows: DataFrame, anchor: Column, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                   positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
                   scale: int = SCALE) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows chosen by ``anchor``.

    An anchor's positives are its first ``positives`` other rows of its label;
    for each, the first ``negatives`` rows of other labels with
    ``low * positive_score <= 100 * negative_score <= high * positive_score``.
    """
    spark = on_workers(rows.sparkSession)
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    full = (rows.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vec_col).isNotNull())
            .where(F.forall(vec_col, number)))
    shape = [F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("long").alias("_label"), F.col(vec_col).alias("_vec")]
    chosen, n_anchors = written_counting(full.where(anchor).select(*shape).distinct(), "anchors")
    n_tiles = max(1, -(-n_anchors // (TILE // 2)))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = (chosen.withColumn("_tile", F.pmod(F.xxhash64("_id", "_vec"), F.lit(n_tiles)))
             .repartition(min(parts, n_tiles), "_tile").sortWithinPartitions("_tile", "_id"))
    packed = written(dealt.mapInArrow(lambda b: anchor_tile_batches(b, scale), f"tile long, {_TILE}"), "anchor-tiles")
    # a number for every tile: those of one tile number are told apart by their place in it
    place = F.row_number().over(Window.partitionBy("tile").orderBy("ids", "labels", "cells"))
    tiles = written(packed.withColumn("number", (place - 1) * F.lit(n_tiles) + F.col("tile")).select(
        "tile", "number", *[F.col(x).alias(f"a_{x}") for x in ("ids", "labels", "width", "cells")]), "anchor-tiles")
    all_tiles, n_all = written_counting(full.select(*shape).mapInArrow(lambda b: tile_batches(b, scale), _TILE), "row-tiles")
    size = tiles.agg(F.sum(F.length("a_cells") + F.length("a_ids") * 2)).first()[0] or 0
    salts = 1 if size <= BROADCAST_BYTES else max(1, -(-n_all // PER_SALT))

    def meet(side: DataFrame) -> DataFrame:
        each = (all_tiles.withColumn("tile", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_tiles - 1).cast("long"))))
                .withColumn("salt", F.pmod(F.xxhash64("ids", "cells"), F.lit(salts))))
        side = side.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
        return each.join(F.broadcast(side) if salts == 1 else side, ["tile", "salt"])

    found = merged(meet(tiles).mapInArrow(lambda b: positive_batches(b, positives), _HEAP), positives)
    best = written(found.select((F.col("slot") * positives + F.col("rank") - 1).alias("slot"), F.col("id").alias("positive_id"),
                                "score"), "positives")
    wanted = best.groupBy(F.floor(F.col("slot") / (positives * TILE)).alias("number")).agg(
        F.collect_list(F.struct("slot", "score")).alias("wanted"))  # at most TILE * positives
    heaps = meet(tiles.join(wanted, "number")).mapInArrow(
        lambda b: negative_batches(b, negatives, positives, low, high), _HEAP)
    names = written(tiles.mapInArrow(anchor_names, "anchor long, anchor_id long"), "anchor-names")
    return (merged(heaps, negatives).withColumnsRenamed({"id": "negative_id", "score": "negative_score"})
            .join(best.withColumnRenamed("score", "positive_score"), "slot")
            .withColumn("anchor", F.floor(F.col("slot") / positives)).join(names, "anchor")
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score",
                    "negative_score"))


def anchor_names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(anchor's number, its id) from the anchors' tiles."""
    for batch in batches:
        for number, ids in zip(arrow_column(batch, "number").to_pylist(), arrow_column(batch, "a_ids"), strict=True):
            ids = np.frombuffer(ids.as_buffer(), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(number * TILE + np.arange(len(ids))), pa.array(ids)],
                                             names=["anchor", "anchor_id"])
