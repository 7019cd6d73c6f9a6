"""Operator 9: MinHash near-duplicates with an LSH forest.

A document is its set of distinct 5-word shingles; documents are linked when
the Jaccard similarity of their sets is at least 0.75, and near-duplicate
groups are the connected components of the links.

* Documents with one and the same set are one class; everything below works on
  classes, so exact copies cost nothing more.
* Each of the ``TREES`` trees of the forest is an order of the classes: sorted
  by range over a path of ``DEPTH`` MinHash values. A region is a run of this
  order with a common prefix. The depth adapts to each region: it is the
  shortest prefix, of ``SHALLOW`` values or more, that at most ``REGION``
  classes share, or the whole path.
* Candidates are each class's neighbour with the longest common prefix in its
  region, and the region's least class; of both kinds the one is compared that
  most trees (weighed by the depth) agree on. Confirmed links give components,
  which absorb almost all regions.
* The rest is exact: two classes with similarity 0.75 share a prefix of
  ``SHALLOW`` = 2 values in no tree with a probability of 2e-6. So the regions
  at this depth that still hold several components are compared inside, on long
  signatures: first each class with its best match
  in another component, which unites most of what belongs together; then every
  remaining pair across components that can reach 0.75. Regions with
  more than ``REGION`` classes are split into blocks, whose pairs go to
  different tasks. A pair that shares several regions is reported in one.
* Every candidate is confirmed on the full shingle sets.

Defined cases: null or blank text has an empty set and is linked with nothing;
a text of fewer than five words is one shingle; rows that repeat id and text
belong to one class; a component's id is its smallest document id; documents
with a null id count in groups but don't name them.

Shingles and sets are held as 64-bit hashes; classes are told apart by a
64-bit hash over the whole set.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from truetally.llm import kernels as K
from truetally.llm.common import (arrow_column, doc_chunks, giving_back, on_workers, small_batches, string_buffers,
                                  text_key, written)
from truetally.llm.components import components

SHINGLE, SHARE = 5, 75
TREES, DEPTH, SHALLOW = 16, 5, 2
REGION = 1024
#: Bytes of a path.
STEP = 2 * DEPTH
#: Values (one byte each) of the long signatures, and the agreement that a pair with similarity 0.75 falls short of
#: with a probability of 3e-5 (4 standard deviations of 0.019).
LONG, AGREE = 512, 0.673

_rng = np.random.default_rng(977)
_XOR = _rng.integers(0, 1 << 63, LONG, dtype=np.uint64)
_MUL = _rng.integers(0, 1 << 63, LONG, dtype=np.uint64) | K.U(1)


def shingles(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of each document, offsets of the documents in them)."""
    starts, ends, first = K.words(buf, off)
    units = K.word_hashes(buf, starts, ends, lower=True)
    n = np.diff(first)
    pre = K.unit_prefix(units)
    count = np.where(n >= SHINGLE, n - SHINGLE + 1, (n > 0).astype(np.int64))
    begin = np.concatenate([[0], np.cumsum(count)])
    out = np.empty(int(begin[-1]), np.uint64)
    long_ = n >= SHINGLE
    if long_.any():
        at = K.ranges(first[:-1][long_], count[long_])
        out[K.ranges(begin[:-1][long_], count[long_])] = K.unit_slices(pre, at, at + SHINGLE)
    short = (n > 0) & ~long_
    out[begin[:-1][short]] = K.unit_slices(pre, first[:-1][short], first[1:][short])
    for i, j in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True):
        out[i:j].sort()
    new = np.ones(len(out), bool)
    new[1:] = out[1:] != out[:-1]
    new[begin[:-1][count > 0]] = True
    return out[new], np.concatenate([[0], np.cumsum(new)])[begin]


def min_hashes(h: np.ndarray, head: np.ndarray, count: int) -> np.ndarray:
    """(count, sets): the first ``count`` MinHash values of each set; ``head``: where the (non-empty) sets begin."""
    low = np.empty((count, len(head)), np.uint64)
    for p in range(count):
        low[p] = np.minimum.reduceat((h ^ _XOR[p]) * _MUL[p], head)
    return K.mix(low)


_SIGNED = "key long, id long, n long, class long, shallow array<long>, paths array<binary>"


def sign_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Class, set size, shallow region keys and paths (two bytes a value) of each document."""
    for batch in batches:
        buf, off = string_buffers(arrow_column(batch, "_text"))
        rows = batch.num_rows
        n = np.zeros(rows, np.int64)
        cls = np.zeros(rows, np.uint64)
        shallow = np.zeros((rows, TREES), np.uint64)
        paths = np.zeros((rows, TREES, DEPTH), ">u2")
        for i, j in doc_chunks(off):
            h, at = shingles(buf[off[i]:off[j]], off[i:j + 1] - off[i])
            size = np.diff(at)
            n[i:j] = size
            some = np.flatnonzero(size)
            if not len(some):
                continue
            head = at[:-1][some]
            cls[i + some] = K.mix(np.add.reduceat(K.mix(h), head) ^ K.mix(size[some].astype(np.uint64)))
            low = min_hashes(h, head, TREES * DEPTH)
            paths[i + some] = (low >> K.U(48)).astype(">u2").reshape(TREES, DEPTH, -1).transpose(2, 0, 1)
            for t in range(TREES):
                key = np.full(len(some), t + 1, np.uint64)
                for d in range(SHALLOW):
                    key = K.mix(key ^ low[t * DEPTH + d]) + K.U(t)
                shallow[i + some, t] = key
        per_row = pa.array(np.arange(0, rows * TREES + 1, TREES, dtype=np.int32))
        cuts = pa.py_buffer(np.arange(0, rows * TREES * STEP + 1, STEP, dtype=np.int32))
        flat = pa.Array.from_buffers(pa.binary(), rows * TREES, [None, cuts, pa.py_buffer(paths.tobytes())])
        yield pa.RecordBatch.from_arrays(
            [arrow_column(batch, "_key"), arrow_column(batch, "_id"), pa.array(n), pa.array(cls.view(np.int64)),
             pa.ListArray.from_arrays(per_row, pa.array(shallow.view(np.int64).ravel())),
             pa.ListArray.from_arrays(per_row, flat)],
            names=["key", "id", "n", "class", "shallow", "paths"])


_NEAR = "class long, other long, kind int, depth int"


def neighbour_batches(batches: Iterator[pa.RecordBatch], region: int, rows: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    """Candidates of each class in the trees' orders; rows come sorted by tree, path and class.

    Kind 0: the least class of its region; kind 1: the neighbour with the
    longest common prefix there (of two, the one before). ``depth`` is the
    prefix known to be shared. Holds ``rows`` rows and as many on both sides as
    tell whether a region has more than ``region`` classes; a region that is cut
    by the range partitioning counts as two.
    """
    cls, head = np.zeros(0, np.int64), np.zeros(0, np.int64)  # head: first, so least, class with the same whole path
    path = np.zeros((0, 1 + DEPTH), np.int32)

    def solve(lo: int, hi: int) -> pa.RecordBatch:
        n = len(cls)
        at = np.arange(n)
        same = np.full(n + 1, -1)  # values shared with the row before; -1: another tree
        same[1:n] = np.logical_and.accumulate(path[1:] == path[:-1], axis=1).sum(axis=1) - 1
        depth, hub = np.zeros(n, np.int64), cls.copy()
        for d in range(SHALLOW, DEPTH + 1):
            starts = np.flatnonzero(same[:-1] < d)
            size = np.diff(np.r_[starts, n])
            fits = np.repeat((size <= region) | (d == DEPTH), size) & (depth == 0)
            least = head if d == DEPTH else np.repeat(np.minimum.reduceat(cls, starts), size)
            depth[fits], hub[fits] = d, least[fits]
        before = same[:-1] >= same[1:]
        best = np.where(before, same[:-1], same[1:])
        beside = cls[np.where(before, at - 1, (at + 1) % n)]
        mine = (at >= lo) & (at < hi)
        to_hub, to_near = np.flatnonzero(mine & (hub != cls)), np.flatnonzero(mine & (best >= depth))
        both = np.r_[to_hub, to_near]
        return pa.RecordBatch.from_arrays(
            [pa.array(cls[both]), pa.array(np.r_[hub[to_hub], beside[to_near]]),
             pa.array(np.repeat([0, 1], [len(to_hub), len(to_near)]).astype(np.int32)),
             pa.array(np.r_[depth[to_hub], best[to_near]].astype(np.int32))], names=["class", "other", "kind", "depth"])

    done = 0
    for batch in itertools.chain(batches, [None]):
        if batch is not None and batch.num_rows:
            values = string_buffers(arrow_column(batch, "path"))[0].reshape(-1, STEP).view(">u2")
            new = arrow_column(batch, "class").to_numpy()
            path = np.concatenate([path, np.column_stack([arrow_column(batch, "tree").to_numpy(), values]).astype(np.int32)])
            old, cls = len(cls), np.concatenate([cls, new])
            begins = np.r_[True, (path[1:] != path[:-1]).any(axis=1)][old:]
            first = np.maximum.accumulate(np.where(begins, np.arange(len(new)), -1))
            head = np.concatenate([head, np.where(first >= 0, new[first], head[-1] if old else 0)])
        end = len(cls) if batch is None else len(cls) - region - 1
        if end - done >= (1 if batch is None else rows):
            yield solve(done, end)
            cut = max(0, end - region - 1)
            cls, head, path, done = cls[cut:], head[cut:], path[cut:], end - cut


def neighbours(forest: DataFrame, region: int) -> DataFrame:
    """Pairs (a, b) to compare first: each class with the best candidate of each kind."""
    parts = int(forest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    near = (forest.select("class", "tree", "path").repartitionByRange(parts, "tree", "path", "class")
            .sortWithinPartitions("tree", "path", "class").mapInArrow(lambda b: neighbour_batches(b, region), _NEAR))
    votes = near.groupBy("class", "other", "kind").agg(F.sum("depth").alias("votes"))
    best = votes.groupBy("class", "kind").agg(F.max_by("other", F.struct("votes", "other")).alias("other"))
    return best.select(F.least("class", "other").alias("a"), F.greatest("class", "other").alias("b")).distinct()


def set_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingle set (sorted 64-bit hashes) and long signature; of neighbouring rows of one class, the first."""
    last = None
    for batch in batches:
        cls = arrow_column(batch, "class").to_numpy()
        fresh = np.r_[cls[:1] != last, cls[1:] != cls[:-1]]
        last = cls[-1] if len(cls) else last
        batch = batch.filter(pa.array(fresh))
        buf, off = string_buffers(arrow_column(batch, "_text"))
        sets: list[bytes] = []
        sigs: list[bytes] = []
        for i, j in doc_chunks(off):
            h, at = shingles(buf[off[i]:off[j]], off[i:j + 1] - off[i])
            sets += [h[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
            # only documents with shingles take part
            sigs += [x.tobytes() for x in (min_hashes(h, at[:-1], LONG) >> K.U(56)).astype(np.uint8).T]
        yield pa.RecordBatch.from_arrays([arrow_column(batch, "class"), pa.array(sets, pa.binary()),
                                          pa.array(sigs, pa.binary())], names=["class", "shingles", "sig"])


def confirm_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose full sets are similar enough."""
    for batch in batches:
        keep = []
        for x, y in zip(arrow_column(batch, "set_a"), arrow_column(batch, "set_b"), strict=True):
            x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
            both = len(x) + len(y) - len(np.union1d(x, y))
            keep.append(100 * both >= SHARE * (len(x) + len(y) - both))
        mask = pa.array(keep, pa.bool_())
        yield pa.RecordBatch.from_arrays([arrow_column(batch, c).filter(mask) for c in ("a", "b")], names=["a", "b"])


def confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Exact check of candidate pairs (a, b) on the full shingle sets."""
    a = sets.select(F.col("class").alias("a"), F.col("shingles").alias("set_a"))
    b = sets.select(F.col("class").alias("b"), F.col("shingles").alias("set_b"))
    return written(pairs.join(a, "a").join(b, "b").mapInArrow(lambda b: giving_back(confirm_batches(b)), "a long, b long"), "links")


_PAIRS = "a long, b long"


def region_batches(batches: Iterator[pa.RecordBatch], every: bool) -> Iterator[pa.RecordBatch]:
    """Pairs across components inside each region whose signatures agree enough; rows come sorted by region.

    With ``every`` all of them, each in the first tree whose region the two
    share; else only each class's best one. Holds one Arrow batch and one
    region (or pair of blocks) at a time.
    """

    def solve(t: pa.Table) -> pa.RecordBatch:
        region, tree, cls, comp, side = (t[x].to_numpy() for x in ("region", "tree", "class", "root", "side"))
        sig = np.frombuffer(b"".join(t["sig"].to_pylist()), np.uint8).reshape(-1, LONG)
        keys = t["shallow"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, TREES) if every else None
        cuts = np.flatnonzero(np.diff(region)) + 1
        out_a, out_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i, j in zip(np.r_[0, cuts], np.r_[cuts, len(region)], strict=True):
            crossed = side[i] >= 0  # a pair of different blocks: only pairs between them
            for k in range(i, j if not every else j - 1):
                rest = np.arange(k + 1 if every else i, j)
                ok = comp[rest] != comp[k]
                if crossed:
                    ok &= side[rest] != side[k]
                who = rest[ok]
                if not len(who):
                    continue
                agree = (sig[who] == sig[k]).mean(axis=1)
                if every:
                    who = who[agree >= AGREE]
                    first = (keys[who] == keys[k]).argmax(axis=1)
                    who = who[first == tree[k]]
                else:
                    best = int(agree.argmax())
                    who = who[best:best + 1] if agree[best] >= AGREE else who[:0]
                out_a.append(np.full(len(who), cls[k]))
                out_b.append(cls[who])
        a, b = np.concatenate(out_a), np.concatenate(out_b)
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    held: pa.Table | None = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        t = pa.concat_tables([held, t]) if held is not None else t
        region = t["region"].to_numpy()
        if not len(region):
            continue
        cut = int(np.searchsorted(region, region[-1], side="left"))
        if cut:
            yield solve(t.slice(0, cut))
        held = t.slice(cut)
    if held is not None and len(held):
        yield solve(held)


def crossing_pairs(forest: DataFrame, signatures: DataFrame, roots: DataFrame, region: int, every: bool) -> DataFrame:
    """Candidate pairs of different components that share a region."""
    spark = forest.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    labelled = written(forest.join(roots.withColumnRenamed("node", "class"), "class", "left")
                       .withColumn("root", F.coalesce("root", "class")), "labelled")
    mixed = written(labelled.groupBy("shallow").agg(F.min("root").alias("r0"), F.max("root").alias("r1"),
                                                    F.count(F.lit(1)).alias("size"))
                    .where("r0 <> r1").select("shallow", F.ceil(F.col("size") / region).cast("int").alias("blocks")),
                    "mixed-regions")
    # blocks meet pairwise: (i, i) has no sides, (i, j) has two
    rows = (labelled.join(mixed, "shallow")
            .withColumn("own", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select(F.xxhash64("shallow", F.least("own", "other"), F.greatest("own", "other")).alias("region"), "tree",
                    "class", "root", F.when(F.col("own") == F.col("other"), F.lit(-1)).otherwise(F.col("own")).alias("side")))
    return (rows.join(signatures, "class").repartition(parts, "region").sortWithinPartitions("region")
            .mapInArrow(lambda b: region_batches(b, every), _PAIRS).distinct())


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", region: int = REGION) -> DataFrame:
    """Per document row: (_key, id, n_shingles, component_id)."""
    small_batches(on_workers(docs.sparkSession))
    keyed = docs.select(text_key(id_col, text_col).alias("_key"), F.col(id_col).cast("long").alias("_id"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    signed = written(keyed.mapInArrow(lambda b: giving_back(sign_batches(b)), _SIGNED), "signed")
    classes = written(signed.where("n > 0").groupBy("class")
                      .agg(F.min("id").alias("id"), F.first("key").alias("key"), F.first("shallow").alias("shallow"),
                           F.first("paths").alias("paths")), "classes")
    rows = (classes.select("class", F.posexplode(F.arrays_zip("shallow", "paths")).alias("tree", "t"))
            .select("class", "tree", "t.shallow", F.col("t.paths").alias("path")))
    shared = written(rows.groupBy("shallow").agg(F.min("class").alias("low"), F.max("class").alias("high"))
                     .where("low <> high").select("shallow"), "regions")
    forest = written(rows.join(shared, "shallow"), "forest")
    members = written(forest.select("class").distinct().join(classes.select("class", "key", "shallow"), "class"), "members")
    sets = written(keyed.select("_key", "_text")
                   .join(members.select("class", F.col("key").alias("_key")).hint("merge"), "_key")
                   .select("class", "_text")
                   .mapInArrow(lambda b: giving_back(set_batches(b)), "class long, shingles binary, sig binary"), "sets")
    shingle_sets = sets.select("class", "shingles")
    links = confirm(neighbours(forest, region), shingle_sets)
    roots = components(links)
    forest = forest.select("class", "tree", "shallow")
    signatures = sets.select("class", "sig").join(members.select("class", "shallow"), "class")
    # best matches first, which leaves little; then all that remain
    for every in (False, True):
        more = confirm(crossing_pairs(forest, signatures if every else signatures.drop("shallow"), roots, region, every),
                       shingle_sets)
        roots = components(more, known=roots)
    owner = classes.select("class", "id").join(roots.withColumnRenamed("node", "class"), "class", "left") \
        .withColumn("root", F.coalesce("root", "class"))
    least = owner.groupBy("root").agg(F.min("id").alias("component_id"))
    named = written(owner.join(least, "root").select("class", "component_id"), "groups")
    return (signed.select("key", "id", "n", F.when(F.col("n") > 0, F.col("class")).alias("class"))
            .join(named, "class", "left")
            .select(F.col("key").alias("_key"), F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The columns of the registered query: one row per document."""
    return near_groups(docs, id_col, text_col).select(
        id_col, "n_shingles", "component_id", F.col(id_col).eqNullSafe(F.col("component_id")).alias("kept"))
