"""Operator 5: substring dedup with a logarithmic family of suffix arrays.

Finds all strings of ``window`` bytes that start anywhere else too and removes
the bytes they cover.

The arrays are sparse: of each window's suffixes one is sampled, the leftmost
of its ``HEAD``-byte grams with the smallest hash, so equal windows sample
suffixes at equal places. An entry is a suffix's head (compared as unsigned
bytes) with a hash of its whole context, from the first to the last window
that sampled it. A level is a table of entries in order of head and context,
range-partitioned, so the level is one sorted array over all its files.

New batches become suffix arrays and are merged geometrically: a batch takes
along the levels 0, 1, .. that exist without a gap, and the merged array
becomes the next level. One linear pass over the merged order finds the runs
of entries with a common head, the only candidates for long matches; runs that
reach a partition's edge count as candidates. Larger levels are neither sorted
nor written again: an entry is written once for each level it rises, so a
logarithmic number of times. One aggregation of the levels by head finds the
entries that are alone with their head in their level and not in the family.

Candidates whose contexts are equal match over their whole context. Those that
share a head and differ are compared window by window within their head, and
the first and last window that repeat bound the match.

Defined cases: null text has no bytes; texts shorter than a window lose
nothing; windows may start inside a character, as the contract counts bytes,
so kept bytes need not be valid UTF-8 and stay binary; rows that repeat id and
text count as occurrences of their own; further columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from truetally.llm import kernels as K
from truetally.llm.common import arrow_column, doc_chunks, on_workers, pack_batches, runs_of, scratch, string_buffers, text_key, unpack, written
from truetally.llm.repeats import HOT_SEED, MERGED, _spans, by_document, settle, span_mask

WINDOW, HEAD, BATCHES = 200, 16, 3

#: A place packs the first window (from bit 10), the distance of the last window from it (8 bits) and the number of
#: occurrences up to 2.
_ENTRIES = "h0 long, h1 long, ctx long, key long, place long, spans binary"
_LEVEL = "h0 long, h1 long, ctx long, key long, place long, met boolean"


def entry_batches(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Sampled suffixes of each batch; those whose contexts repeat within it are merged, their spans given by document."""
    for batch in runs_of(batches, "_text", MERGED):
        keys = arrow_column(batch, "_key").to_numpy(zero_copy_only=False)
        buf, off = string_buffers(arrow_column(batch, "_text"))
        found = []
        for i, j in doc_chunks(off):
            b, first = buf[off[i]:off[j]], off[i:j + 1] - off[i]
            if len(b) < window:
                continue
            pre = K.byte_prefix(b)
            at, lo, hi = K.anchors(K.byte_grams(pre, HEAD), first, HEAD, window)
            if not len(at):
                continue
            doc = np.searchsorted(first, lo, side="right") - 1
            ctx = K.byte_slices(pre, lo, hi + window)
            ctx = K.mix(ctx + (at - lo).astype(np.uint64) * K.U(0x9E3779B97F4A7C15))
            head = b[at[:, None] + np.arange(HEAD)].view(">u8").astype(np.uint64) ^ K.U(1 << 63)
            found.append((head[:, 0], head[:, 1], ctx, i + doc, lo - first[doc], hi - lo))
        if not found:
            continue
        h0, h1, ctx, doc, lo, more = (np.concatenate(x) for x in zip(*found, strict=True))
        inverse, counts = K.group_min_max(K.mix(K.mix(h0) + h1) ^ ctx)
        many = counts[inverse] > 1
        _, one = np.unique(inverse, return_index=True)
        place = lo[one] << 10 | more[one] << 2 | np.minimum(counts[inverse[one]], 2)
        d, a, e = doc[many], lo[many], (lo + more + window)[many]
        cuts = np.flatnonzero(np.diff(d)) + 1
        groups = [x for x in zip(np.split(d, cuts), np.split(a, cuts), np.split(e, cuts), strict=True) if len(x[0])]
        owner = keys[np.array([x[0][0] for x in groups], np.int64)] if groups else np.zeros(0, np.int64)
        m = len(groups)
        full = lambda x: pa.concat_arrays([pa.array(x), pa.nulls(m, pa.int64())])
        yield pa.RecordBatch.from_arrays(
            [full(h0[one].view(np.int64)), full(h1[one].view(np.int64)), full(ctx[one].view(np.int64)),
             pa.concat_arrays([pa.array(keys[doc[one]]), pa.array(owner)]), full(place),
             pa.concat_arrays([pa.nulls(len(one), pa.binary()), pa.array([_spans(x[1], x[2]) for x in groups], pa.binary())])],
            names=["h0", "h1", "ctx", "key", "place", "spans"])


def scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Marks entries that share their head with a neighbour in the sorted order, and those of edge runs.

    Holds one Arrow batch: an entry's mark depends on its neighbours alone.
    """
    held: pa.RecordBatch | None = None
    before = None  # head of the entry before the held batch

    def marked(batch: pa.RecordBatch, prev, nxt, last: bool) -> pa.RecordBatch:
        h0, h1 = (arrow_column(batch, x).to_numpy() for x in ("h0", "h1"))
        same = (h0[1:] == h0[:-1]) & (h1[1:] == h1[:-1])
        met = np.zeros(len(h0), bool)
        met[1:] |= same
        met[:-1] |= same
        met[0] |= prev is None or prev == (h0[0], h1[0])
        met[-1] |= last or nxt == (h0[-1], h1[-1])
        return pa.RecordBatch.from_arrays([*(arrow_column(batch, x) for x in ("h0", "h1", "ctx", "key", "place")),
                                           pa.array(met)], names=["h0", "h1", "ctx", "key", "place", "met"])

    for batch in batches:
        if not batch.num_rows:
            continue
        head = (arrow_column(batch, "h0")[0].as_py(), arrow_column(batch, "h1")[0].as_py())
        if held is not None:
            yield marked(held, before, head, False)
            before = (arrow_column(held, "h0")[-1].as_py(), arrow_column(held, "h1")[-1].as_py())
        held = batch
    if held is not None:
        yield marked(held, before, None, True)


class SuffixFamily:
    """A family of suffix-array levels in a folder of the shared file system."""

    def __init__(self, spark: SparkSession):
        self.spark = on_workers(spark)
        self.levels: dict[int, DataFrame] = {}

    def add(self, entries: DataFrame) -> int:
        """Add a batch of entries; returns the rank of the level that holds it.

        The batch merges with the levels 0 .. r-1 into level r, the first one
        free. Larger levels are left alone.
        """
        rank = 0
        merged = entries.select("h0", "h1", "ctx", "key", "place")
        while rank in self.levels:
            merged = merged.unionByName(self.levels[rank].drop("met"))
            rank += 1
        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        path = scratch(self.spark, f"suffix-level-{rank}")
        (merged.repartitionByRange(parts, "h0", "h1", "ctx").sortWithinPartitions("h0", "h1", "ctx")
         .mapInArrow(scan_batches, _LEVEL).write.option("compression", "zstd").parquet(path))
        for r in range(rank):
            del self.levels[r]
        self.levels[rank] = self.spark.read.schema(_LEVEL).parquet(path)
        return rank

    def candidates(self) -> DataFrame:
        """Entries of all levels that share their head with another entry of any level, each once."""
        levels = [self.levels[r] for r in sorted(self.levels)]
        union = lambda frames: functools.reduce(DataFrame.unionByName, frames)
        met = union([x.where("met") for x in levels])
        if len(levels) == 1:
            return met
        # a head's entries that aren't met are one a level at most, so what a group gathers is bounded by the levels
        each = union([x.select("h0", "h1", F.lit(i).alias("level"), F.when(~F.col("met"), F.struct("ctx", "key", "place")).alias("e"))
                      for i, x in enumerate(levels)])
        alone = (each.groupBy("h0", "h1").agg(F.min("level").alias("low"), F.max("level").alias("high"), F.collect_list("e").alias("es"))
                 .where("low < high").select("h0", "h1", F.inline("es")).withColumn("met", F.lit(False)))
        return met.unionByName(written(alone, "suffix-shared"))


_CONTEXTS = "seed long, ctx long, n int, key long, at int, hot boolean, grams binary"


def context_batches(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """The bytes of each context to extend."""
    for batch in runs_of(batches, "_packed", 1 << 18):
        texts = arrow_column(batch, "_packed")
        reps = arrow_column(batch, "_reps")
        flat = reps.flatten()
        col = {f.name: flat.field(k) for k, f in enumerate(flat.type)}
        at, lo, hi = (col[x].to_numpy(zero_copy_only=False).astype(np.int64) for x in ("at", "lo", "hi"))
        counts = np.array(reps.value_lengths().to_numpy(zero_copy_only=False), np.int64)
        end = at + lo + hi + window
        contexts, k = [], 0
        for text, n in zip(texts, counts, strict=True):
            raw = unpack(text.as_buffer())
            contexts += [raw[at[x]:end[x]] for x in range(k, k + n)]
            k += n
        key = np.repeat(arrow_column(batch, "_key").to_numpy(zero_copy_only=False), counts)
        yield pa.RecordBatch.from_arrays([col["seed"], col["ctx"], col["n"], pa.array(key), col["at"], col["hot"],
                                          pa.array(contexts, pa.binary())],
                                         names=["seed", "ctx", "n", "key", "at", "hot", "grams"])


def context_grams(window: int):
    """Window hashes of a column of contexts."""

    def grams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        buf, off = string_buffers(column)
        n = np.maximum(np.diff(off) - window + 1, 0)
        out = [np.zeros(0, np.uint64)]
        for i, j in doc_chunks(off):
            pre = K.byte_prefix(buf[off[i]:off[j]])
            at = K.ranges(off[i:j] - off[i], n[i:j])
            out.append(K.byte_slices(pre, at, at + window))
        return np.concatenate(out), np.concatenate([[0], np.cumsum(n)])

    return grams


def kept_batches(batches: Iterator[pa.RecordBatch], id_col: str) -> Iterator[pa.RecordBatch]:
    for batch in runs_of(batches, "_packed", 1 << 20):
        pairs, blobs = arrow_column(batch, "_pairs"), arrow_column(batch, "_spans")
        n_bytes, n_removed, n_spans, kept = [], [], [], []
        for i, text in enumerate(arrow_column(batch, "_packed")):
            doc = np.frombuffer(unpack(text.as_buffer()), np.uint8)
            gone = span_mask(len(doc), pairs[i].as_py(), blobs[i].as_py())
            n_bytes.append(len(doc))
            n_removed.append(int(gone.sum()))
            n_spans.append(int((gone[1:] & ~gone[:-1]).sum()) + int(gone[:1].sum()))
            kept.append(doc[~gone].tobytes())
        yield pa.RecordBatch.from_arrays([arrow_column(batch, "_id"), pa.array(n_bytes, pa.int64()),
                                          pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()),
                                          pa.array(kept, pa.binary())],
                                         names=[id_col, "n_bytes", "n_removed", "n_spans", "kept"])


def remove_repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                          batches: int = BATCHES, hot_seed: int = HOT_SEED) -> DataFrame:
    """Per document: (id, n_bytes, n_removed, n_spans, kept binary).

    ``batches``: the documents enter the family in so many batches, dealt by
    hash. ``window``: from HEAD to HEAD + 254.
    """
    if not HEAD <= window <= HEAD + 254:
        raise ValueError(f"window must lie between {HEAD} and {HEAD + 254}")
    spark = docs.sparkSession
    family = SuffixFamily(spark)
    keyed = docs.select(text_key(id_col, text_col).alias("_key"), F.col(id_col).cast("long").alias("_id"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    local = []
    for b in range(batches):
        part = keyed.where(F.pmod("_key", F.lit(batches)) == b).select("_key", "_text")
        entries = part.mapInArrow(lambda x: entry_batches(x, window), _ENTRIES)
        family.add(entries.where(F.col("spans").isNull()))
        local.append(entries.where(F.col("spans").isNotNull()).select("key", "spans"))
    bits = lambda shift, mask: F.shiftright("place", shift).bitwiseAND(F.lit(mask)).cast("int")
    seeded = family.candidates().select(F.xxhash64("h0", "h1").alias("seed"), "ctx", bits(0, 3).alias("n"), "key",
                                        F.shiftright("place", 10).cast("int").alias("at"), F.lit(0).alias("lo"),
                                        bits(2, 255).alias("hi"))
    packed = keyed.mapInArrow(pack_batches, "_key long, _id long, _packed binary")
    spans = settle(packed, seeded, lambda x: context_batches(x, window), context_grams(window), window, hot_seed)
    merged = local[0]
    for x in local[1:]:
        merged = merged.unionByName(x)
    return packed.join(by_document(spans, merged), "_key", "left").mapInArrow(
        lambda x: kept_batches(x, id_col), f"{id_col} long, n_bytes long, n_removed long, n_spans long, kept binary")


def repeat_digests(docs: DataFrame) -> DataFrame:
    """The digest columns of the registered query."""
    out = remove_repeated_bytes(docs)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
