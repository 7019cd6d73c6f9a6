"""Operator 2: substring dedup by seed and extend.

Finds all word sequences of ``window`` words that stand anywhere else too and
removes the words they cover.

Seed. Each document's windows are winnowed: a window's anchor is the leftmost
of its ``seed``-word grams with the smallest hash, so equal windows have equal
anchors at equal places. Anchors are joined on their gram's hash.

Extend. An anchor's *context* runs from the first to the last of the windows
that chose it, the farthest that a repeat seen through this anchor can extend
to the left and right. Where contexts are equal the extension succeeds whole.
Contexts that share the seed and differ are extended window by window against
the others of their seed, and the first and the last window that repeat bound
the repeat. The union of what repeats is the set of maximal repeats.

Scale. Rows that agree in seed and context are merged within each Arrow batch
before any shuffle, so exact copies and common passages cost a row per batch.
Seeds with more than ``hot_seed`` differing contexts (a phrase that a third of
all documents share) take a second path, which spreads their windows over all
tasks by hash. Nothing is compared pairwise, and nothing is capped.

Across batches identity rests on pairs of 64-bit hashes (seed and context, seed
and window); within one batch, on their 64-bit mixture.

Defined cases: null text has no words; documents with fewer words than a window
lose nothing; rows that repeat id and text count as occurrences of their own;
texts are never cut; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from truetally.llm import kernels as K
from truetally.llm.common import arrow_column, doc_chunks, on_workers, pack_batches, runs_of, string_buffers, text_key, unpack, written

WINDOW, SEED, HOT_SEED = 35, 10, 4096
#: Bytes of text whose repeated anchors are merged before they are handed on.
MERGED = 8 << 20

_ANCHORS = ("seed long, ctx long, n int, key long, at int, lo int, hi int, spans binary")


def word_units(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, first word of each document and the total)."""
    starts, ends, first = K.words(buf, off)
    return K.word_hashes(buf, starts, ends), first


def _spans(at: np.ndarray, end: np.ndarray) -> bytes:
    """Sorted, merged [start, end) pairs as 32-bit integers."""
    order = np.argsort(at, kind="stable")
    s, e = at[order], np.maximum.accumulate(end[order])
    new = np.ones(len(s), bool)
    new[1:] = s[1:] > e[:-1]
    head = np.flatnonzero(new)
    last = np.append(head[1:], len(s)) - 1
    return np.stack([s[head], e[last]], 1).astype("<i4").tobytes()


def anchor_batches(batches: Iterator[pa.RecordBatch], window: int, seed: int) -> Iterator[pa.RecordBatch]:
    """Anchors of each run of documents; those that repeat within it are merged and their spans given by document."""
    for batch in runs_of(batches, "_text", MERGED):
        keys = arrow_column(batch, "_key").to_numpy(zero_copy_only=False)
        buf, off = string_buffers(arrow_column(batch, "_text"))
        found = []
        for i, j in doc_chunks(off):
            units, first = word_units(buf[off[i]:off[j]], off[i:j + 1] - off[i])
            pre = K.unit_prefix(units)
            grams = K.unit_grams(pre, seed)
            at, lo, hi = K.anchors(grams, first, seed, window)
            if not len(at):
                continue
            doc = np.searchsorted(first, lo, side="right") - 1
            ctx = K.unit_slices(pre, lo, hi + window)
            # the place of the anchor in its context belongs to the identity
            ctx = K.mix(ctx + (at - lo).astype(np.uint64) * K.U(0x9E3779B97F4A7C15))
            base = first[doc]
            found.append((grams[at], ctx, i + doc, lo - base, at - lo, hi - at))
        if not found:
            continue
        g, ctx, doc, lo, left, right = (np.concatenate(x) for x in zip(*found, strict=True))
        inverse, counts = K.group_min_max(g ^ K.mix(ctx))
        many = counts[inverse] > 1
        _, first_of = np.unique(inverse, return_index=True)
        n = np.minimum(counts[inverse[first_of]], 2).astype(np.int32)
        rows = len(first_of)
        # spans of the merged ones, a row per document
        d, a, e = doc[many], lo[many], (lo + left + right + window)[many]
        cuts = np.flatnonzero(np.diff(d)) + 1
        groups = [x for x in zip(np.split(d, cuts), np.split(a, cuts), np.split(e, cuts), strict=True) if len(x[0])]
        merged = [_spans(x[1], x[2]) for x in groups]
        owner = keys[np.array([x[0][0] for x in groups], np.int64)] if groups else np.zeros(0, np.int64)
        m = len(merged)
        pick = lambda x, kind: pa.concat_arrays([pa.array(x[first_of].astype(kind)), pa.nulls(m, pa.from_numpy_dtype(kind))])
        yield pa.RecordBatch.from_arrays([
            pa.concat_arrays([pa.array(g[first_of].view(np.int64)), pa.nulls(m, pa.int64())]),
            pa.concat_arrays([pa.array(ctx[first_of].view(np.int64)), pa.nulls(m, pa.int64())]),
            pa.concat_arrays([pa.array(n), pa.nulls(m, pa.int32())]),
            pa.concat_arrays([pa.array(keys[doc[first_of]]), pa.array(owner)]),
            pick(lo, np.int32), pick(left, np.int32), pick(right, np.int32),
            pa.concat_arrays([pa.nulls(rows, pa.binary()), pa.array(merged, pa.binary())])],
            names=["seed", "ctx", "n", "key", "at", "lo", "hi", "spans"])


_CONTEXTS = "seed long, ctx long, n int, key long, at int, hot boolean, grams binary"


def context_batches(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """For each document with contexts to extend: the hashes of the windows of each."""
    for batch in runs_of(batches, "_packed", 1 << 18):
        texts = [unpack(x.as_buffer()) for x in arrow_column(batch, "_packed")]
        buf = np.frombuffer(b"".join(texts), np.uint8)
        off = np.concatenate([[0], np.cumsum([len(x) for x in texts])]).astype(np.int64)
        reps = arrow_column(batch, "_reps")
        flat = reps.flatten()
        col = {f.name: flat.field(k) for k, f in enumerate(flat.type)}
        at, lo, hi = (col[x].to_numpy(zero_copy_only=False).astype(np.int64) for x in ("at", "lo", "hi"))
        counts = np.array(reps.value_lengths().to_numpy(zero_copy_only=False), np.int64)
        of = np.concatenate([[0], np.cumsum(counts)])
        blobs: list[bytes] = []
        for i, j in doc_chunks(off):
            units, first = word_units(buf[off[i]:off[j]], off[i:j + 1] - off[i])
            pre = K.unit_prefix(units)
            grams = K.unit_grams(pre, window)
            r = np.arange(of[i], of[j])
            doc = np.searchsorted(of, r, side="right") - 1 - i
            begin, size = first[doc] + at[r], lo[r] + hi[r] + 1
            picked = grams[K.ranges(begin, size)].tobytes()
            ends = np.cumsum(size) * 8
            blobs += [picked[e - 8 * s:e] for e, s in zip(ends.tolist(), size.tolist(), strict=True)]
        key = np.repeat(arrow_column(batch, "_key").to_numpy(zero_copy_only=False), counts)
        yield pa.RecordBatch.from_arrays([col["seed"], col["ctx"], col["n"], pa.array(key), col["at"], col["hot"],
                                          pa.array(blobs, pa.binary())],
                                         names=["seed", "ctx", "n", "key", "at", "hot", "grams"])


_FOUND = "key long, s int, e int"


def extend_batches(batches: Iterator[pa.RecordBatch], window: int, grams_of) -> Iterator[pa.RecordBatch]:
    """Extend the contexts of each seed against each other; rows come sorted by seed.

    Holds one Arrow batch and the contexts of one seed, of which there are at
    most ``hot_seed``.
    """

    def solve(t: pa.Table) -> pa.RecordBatch:
        seed, n, key, at = (t[x].to_numpy() for x in ("seed", "n", "key", "at"))
        h, off = grams_of(t["grams"].combine_chunks() if t["grams"].num_chunks != 1 else t["grams"].chunk(0))
        size = np.diff(off)
        row = np.repeat(np.arange(len(seed)), size)
        place = np.arange(len(h)) - np.repeat(off[:-1], size)
        inverse, _ = K.group_min_max(h ^ K.mix(seed.view(np.uint64)[row]))
        total = np.bincount(inverse, weights=n[row])
        hit = (total[inverse] > 1) & (n[row] == 1)
        row, place = row[hit], place[hit]
        head = np.flatnonzero(np.diff(row, prepend=-1))
        last = np.append(head[1:], len(row)) - 1 if len(row) else head
        who = row[head]
        return pa.RecordBatch.from_arrays([pa.array(key[who]), pa.array((at[who] + place[head]).astype(np.int32)),
                                           pa.array((at[who] + place[last] + window).astype(np.int32))],
                                          names=["key", "s", "e"])

    held: pa.Table | None = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        t = pa.concat_tables([held, t]) if held is not None else t
        seed = t["seed"].to_numpy()
        if not len(seed):
            continue
        cut = int(np.searchsorted(seed, seed[-1], side="left"))
        if cut:
            yield solve(t.slice(0, cut))
        held = t.slice(cut)
    if held is not None and len(held):
        yield solve(held)


def settle(keyed: DataFrame, seeded: DataFrame, contexts_of, grams_of, window: int, hot_seed: int) -> DataFrame:
    """Spans (key, s, e) of repeats seen through anchors that share their seed with others.

    ``seeded``: (seed, ctx, n, key, at, lo, hi) of those anchors. ``contexts_of``
    turns Arrow batches of documents with the contexts to extend into rows of
    ``_CONTEXTS``; ``grams_of`` gives the window hashes of such rows.
    """
    spark = keyed.sparkSession
    shared = written(seeded.groupBy("seed").agg(F.sum("n").alias("total"), F.min("ctx").alias("c0"),
                                                F.max("ctx").alias("c1"))
                     .where("total > 1")
                     .select("seed", (F.col("c0") != F.col("c1")).alias("mixed"),
                             (F.col("total") > hot_seed).alias("hot")), "shared-seeds")
    joined = written(seeded.join(shared, "seed"), "seeded")
    end = F.col("at") + F.col("lo") + F.col("hi") + window
    whole = joined.where("not mixed").select("key", F.col("at").alias("s"), end.alias("e"))
    by_context = Window.partitionBy("seed", "ctx")
    mixed = written(joined.where("mixed").drop("mixed")
                    .withColumns({"total": F.sum("n").over(by_context),
                                  "rank": F.row_number().over(by_context.orderBy("key", "at"))}), "contexts")
    equal = mixed.where("total > 1").select("key", F.col("at").alias("s"), end.alias("e"))
    reps = (mixed.where("rank = 1").groupBy(F.col("key").alias("_key"))
            .agg(F.collect_list(F.struct("seed", "ctx", F.least("total", F.lit(2)).cast("int").alias("n"), "at", "lo",
                                         "hi", "hot")).alias("_reps")))
    contexts = keyed.join(reps, "_key").mapInArrow(contexts_of, _CONTEXTS)
    hot = not mixed.where("rank = 1 and hot").isEmpty()
    if hot:  # two ways need them, and the texts move once
        contexts = written(contexts, "extended")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spans = (whole.unionByName(equal)
             .unionByName(contexts.where("not hot").repartition(parts, "seed").sortWithinPartitions("seed")
                          .mapInArrow(lambda b: extend_batches(b, window, grams_of), _FOUND)))
    return spans.unionByName(hot_windows(contexts.where("hot"), window, grams_of)) if hot else spans


def covered_words(docs: DataFrame, window: int, seed: int, hot_seed: int) -> tuple[DataFrame, DataFrame]:
    """(keyed documents, packed; spans of covered words by document key)."""
    found = written(docs.select("_key", "_text").mapInArrow(lambda b: anchor_batches(b, window, seed), _ANCHORS),
                    "anchors")
    packed = docs.mapInArrow(pack_batches, "_key long, _id long, _packed binary")
    spans = settle(packed, found.where(F.col("spans").isNull()).drop("spans"),
                   lambda b: context_batches(b, window), word_grams, window, hot_seed)
    return packed, by_document(spans, found.where(F.col("spans").isNotNull()))


def by_document(spans: DataFrame, local: DataFrame) -> DataFrame:
    """(_key, _pairs, _spans): all spans of a document in one row."""
    pairs = spans.groupBy("key").agg(F.collect_list(F.struct("s", "e")).alias("_pairs"))
    blobs = local.groupBy("key").agg(F.collect_list("spans").alias("_spans"))
    return pairs.join(blobs, "key", "full").withColumnRenamed("key", "_key")


def word_grams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(window hashes, offsets of the rows in them) of a column of packed hashes."""
    buf, off = string_buffers(column)
    return np.frombuffer(buf.tobytes(), np.uint64), off // 8


def hot_windows(contexts: DataFrame, window: int, grams_of) -> DataFrame:
    """The extension of contexts whose seed is very common, with their windows spread by hash."""
    unpack = "seed long, ctx long, n int, key long, at int, gram long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, off = grams_of(arrow_column(batch, "grams"))
            size = np.diff(off)
            row = np.repeat(np.arange(len(size)), size)
            place = np.arange(len(row)) - np.repeat(off[:-1], size)
            pick = lambda x: arrow_column(batch, x).to_numpy(zero_copy_only=False)[row]
            yield pa.RecordBatch.from_arrays(
                [pa.array(pick("seed")), pa.array(pick("ctx")), pa.array(pick("n")), pa.array(pick("key")),
                 pa.array((pick("at") + place).astype(np.int32)), pa.array(h.view(np.int64))],
                names=["seed", "ctx", "n", "key", "at", "gram"])

    each = written(contexts.drop("hot").mapInArrow(run, unpack), "hot-windows")
    common = written(each.groupBy("seed", "gram").agg(F.sum("n").alias("total")).where("total > 1").drop("total"),
                     "hot-grams")
    return (each.where("n = 1").join(common, ["seed", "gram"])
            .groupBy("seed", "ctx", "key").agg(F.min("at").alias("s"), (F.max("at") + window).alias("e"))
            .select("key", "s", "e"))


def span_mask(n: int, pairs, blobs) -> np.ndarray:
    """Which of n units are covered by the pairs of a row."""
    step = np.zeros(n + 1, np.int32)
    if pairs:
        p = np.array([(x["s"], x["e"]) for x in pairs], np.int64)
        np.add.at(step, p[:, 0], 1)
        np.add.at(step, p[:, 1], -1)
    for blob in blobs or ():
        p = np.frombuffer(blob, "<i4").reshape(-1, 2)
        np.add.at(step, p[:, 0], 1)
        np.add.at(step, p[:, 1], -1)
    return np.cumsum(step[:-1]) > 0


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   seed: int = SEED, hot_seed: int = HOT_SEED) -> DataFrame:
    """Per document: (id, n_words, n_removed, kept): the kept words joined by one space."""
    if not 1 <= seed <= window:
        raise ValueError("a seed is at most as long as the window")
    on_workers(docs.sparkSession)
    schema = f"{id_col} long, n_words long, n_removed long, kept string"
    keyed, spans = covered_words(
        docs.select(text_key(id_col, text_col).alias("_key"), F.col(id_col).cast("long").alias("_id"),
                    F.coalesce(F.col(text_col), F.lit("")).alias("_text")), window, seed, hot_seed)
    return keyed.join(spans, "_key", "left").mapInArrow(lambda b: kept_words(b, id_col), schema)


def kept_words(batches: Iterator[pa.RecordBatch], id_col: str) -> Iterator[pa.RecordBatch]:
    for batch in runs_of(batches, "_packed", 1 << 20):
        pairs, blobs = arrow_column(batch, "_pairs"), arrow_column(batch, "_spans")
        n_words, n_removed, kept = [], [], []
        for i, text in enumerate(arrow_column(batch, "_packed")):
            doc = np.frombuffer(unpack(text.as_buffer()), np.uint8)
            starts, ends, _ = K.words(doc, np.array([0, len(doc)]))
            gone = span_mask(len(starts), pairs[i].as_py(), blobs[i].as_py())
            n_words.append(len(starts))
            n_removed.append(int(gone.sum()))
            s, e = starts[~gone], ends[~gone]
            # every word with the byte behind it, which becomes the space
            size = e - s + 1
            joined = np.append(doc, 0x20).astype(np.uint8)[K.ranges(s, size)]
            joined[np.cumsum(size) - 1] = 0x20
            kept.append(joined[:-1].tobytes().decode())
        yield pa.RecordBatch.from_arrays([arrow_column(batch, "_id"), pa.array(n_words, pa.int64()),
                                          pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())],
                                         names=[id_col, "n_words", "n_removed", "kept"])


def repeat_digests(docs: DataFrame) -> DataFrame:
    """The digest columns of the registered query."""
    out = remove_repeats(docs)
    return out.select("doc_id", "n_words", "n_removed",
                      F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))

