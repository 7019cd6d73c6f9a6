"""Operator 13: periodic runs by maximal-pair enumeration.

A run is a stretch of words with smallest period ``q`` (words ``q`` apart are
identical) of at least ``max(min_length, min_exponent * q)`` words that neither
neighbour extends. A run of ``length`` words that begins at ``start`` is the
maximal pair of the positions ``start`` and ``start + q``: what follows both is
identical for ``length - q`` words and no further, and the words before them
differ. So runs are the maximal pairs whose distance is small against their
common length, and nothing is extended.

* Suffixes of one document are sorted by prefix doubling on exact word numbers
  (a dictionary of the words' bytes, no hashes); the ranks of all doublings
  give the longest common prefixes (LCP) of neighbours.
* A bottom-up pass over the tree of LCP intervals keeps for every interval its
  positions in order, with the class of each: the word to its left. Where two
  children of an interval meet, each position of the smaller child looks up its
  neighbours among the larger child's; those of another class, near enough, are
  maximal pairs. Intervals of a single class meet without a look-up.
  Neighbours suffice: the next place where the first ``length - q`` words of a
  run recur is ``q`` further on. Pairs at a multiple of ``q`` describe the same
  stretch; the smallest distance of a stretch counts.
* Subtrees in which no two positions are near enough for their deepest interval
  are passed over.

Every document is worked on whole inside one task; nothing is shuffled. Working
memory is the text's words times the number of doublings.

Defined cases: null or blank text has no words and no run; repeated rows give
repeated rows; texts are never cut; further columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from truetally.llm import kernels as K
from truetally.llm.common import arrow_column, doc_chunks, on_workers, string_buffers

MIN_LENGTH, MIN_EXPONENT = 6, 4


def word_numbers(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number for each word, the same for the same bytes."""
    size = ends - starts
    if not len(size):
        return np.zeros(0, np.int64)
    data = buf[K.ranges(starts, size)]
    off = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(off.tobytes()), pa.py_buffer(data.tobytes())])
    return words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _dense(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of keys below each key, size of each key's group)."""
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    head = np.flatnonzero(np.r_[True, s[1:] != s[:-1]]) if len(s) else np.zeros(0, np.int64)
    size = np.diff(np.r_[head, len(s)])
    rank, count = np.empty(len(s), np.int64), np.empty(len(s), np.int64)
    rank[order] = np.repeat(head, size)
    count[order] = np.repeat(size, size)
    return rank, count


def suffixes(numbers: np.ndarray, first: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted suffixes that share ``least`` words or more with another one of their document, and the LCP of each
    with the one before it (0 where that is less than ``least``)."""
    n = len(numbers)
    end = np.repeat(first[1:], np.diff(first))  # of each word's document
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    rank, count = _dense(doc * (int(numbers.max()) + 1) + numbers)
    levels = [rank]
    span = 1
    live = np.flatnonzero(count > 1)
    while len(live):
        beyond = live + span >= end[live]
        after = np.where(beyond, -1, rank[np.minimum(live + span, n - 1)])
        order = np.lexsort((after, rank[live]))
        who, r, a = live[order], rank[live][order], after[order]
        old = np.r_[True, r[1:] != r[:-1]]
        new = old | np.r_[True, a[1:] != a[:-1]]
        at = np.arange(len(who))
        head = np.flatnonzero(new)
        size = np.diff(np.r_[head, len(who)])
        rank = rank.copy()
        rank[who] = r + np.repeat(head, size) - np.maximum.accumulate(np.where(old, at, 0))
        levels.append(rank)
        live = who[np.repeat(size, size) > 1]
        span *= 2
    order = np.argsort(rank, kind="stable")
    a, b = order[:-1], order[1:]
    lcp = np.zeros(len(a), np.int64)
    pairs = np.flatnonzero(levels[0][a] == levels[0][b])
    a, b = a[pairs], b[pairs]
    common = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        x, y = a + common, b + common
        inside = (x < end[a]) & (y < end[b])
        same = inside & (levels[k][np.minimum(x, n - 1)] == levels[k][np.minimum(y, n - 1)])
        common[same] += 1 << k
    lcp[pairs] = common
    lcp[lcp < least] = 0
    keep = np.r_[False, lcp > 0] | np.r_[lcp > 0, False]
    return order[keep], np.r_[0, lcp][keep]


def _meet(large: list, small: list, common: int, left: list, exponent: int, shortest: int, out: list) -> list:
    """Join two children (positions, class) of an interval with ``common`` words; adds (start, end, period) to ``out``."""
    if len(large[0]) < len(small[0]):
        large, small = small, large
    starts, mine = large
    if mine is None or mine != small[1]:
        reach = common // (exponent - 1)
        for i in small[0]:
            k = bisect_left(starts, i)
            if k < len(starts) and starts[k] - i <= reach and left[starts[k]] != left[i] and common + starts[k] - i >= shortest:
                out.append((i, starts[k] + common, starts[k] - i))
            if k and i - starts[k - 1] <= reach and left[starts[k - 1]] != left[i] and common + i - starts[k - 1] >= shortest:
                out.append((starts[k - 1], i + common, i - starts[k - 1]))
        large[1] = None
    if len(small[0]) * 8 < len(starts):
        for i in small[0]:
            insort(starts, i)
    else:
        starts += small[0]
        starts.sort()
    return large


def tree_pairs(order: np.ndarray, lcp: np.ndarray, left: list, exponent: int, shortest: int) -> list[tuple[int, int, int]]:
    """Maximal pairs (start, end, distance) of a forest of LCP intervals, each tree behind an LCP of 0."""
    out: list[tuple[int, int, int]] = []
    stack: list = []
    last = None
    for i, common in zip(order.tolist(), lcp.tolist(), strict=True):
        while stack and stack[-1][0] > common:
            depth, node = stack.pop()
            last = _meet(node, last, depth, left, exponent, shortest, out)
        if common and stack and stack[-1][0] == common:
            stack[-1][1] = _meet(stack[-1][1], last, common, left, exponent, shortest, out)
        elif common:
            stack.append([common, last])
        last = [[i], left[i]]
    while stack:
        depth, node = stack.pop()
        last = _meet(node, last, depth, left, exponent, shortest, out)
    return out


def near_trees(order: np.ndarray, lcp: np.ndarray, exponent: int) -> np.ndarray:
    """Which suffixes stand in a tree with two positions near enough for its deepest interval."""
    if not len(order):
        return np.zeros(0, bool)
    head = np.flatnonzero(lcp == 0)
    tree = np.cumsum(lcp == 0) - 1
    deepest = np.maximum.reduceat(lcp, head)
    by_place = np.lexsort((order, tree))
    gap = np.diff(order[by_place], prepend=-1 << 40)
    gap[head] = 1 << 40  # the first of a tree; trees keep their places in this order
    return (np.minimum.reduceat(gap, head) * (exponent - 1) <= deepest)[tree]


def find_runs(numbers: np.ndarray, first: np.ndarray, shortest: int = MIN_LENGTH,
              exponent: int = MIN_EXPONENT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs of some documents, by document, start and period; starts count from the
    first word of all."""
    none = np.zeros(0, np.int64)
    if not len(numbers):
        return none, none, none
    order, lcp = suffixes(numbers, first, exponent - 1)  # a run's two positions share exponent - 1 periods
    near = near_trees(order, lcp, exponent)
    order, lcp = order[near], lcp[near]
    before = np.empty(len(numbers), np.int64)
    before[1:] = numbers[:-1]
    before[first[:-1][np.diff(first) > 0]] = -1
    found = tree_pairs(order, lcp, before.tolist(), exponent, shortest) if len(order) else []
    if not found:
        return none, none, none
    start, end, period = np.array(found, np.int64).T
    by = np.lexsort((period, end, start))
    start, end, period = start[by], end[by], period[by]
    smallest = np.r_[True, (start[1:] != start[:-1]) | (end[1:] != end[:-1])]
    start, end, period = start[smallest], end[smallest], period[smallest]
    by = np.lexsort((period, start))
    return start[by], (end - start)[by], period[by]


def run_batches(batches: Iterator[pa.RecordBatch], id_col: str, shortest: int, exponent: int) -> Iterator[pa.RecordBatch]:
    """The runs of each document and the text that is left when each is collapsed to its first period."""
    for batch in batches:
        buf_all, off_all = string_buffers(arrow_column(batch, "_text"))
        ids = arrow_column(batch, "_id")
        for i, j in doc_chunks(off_all):
            buf, off = buf_all[off_all[i]:off_all[j]], off_all[i:j + 1] - off_all[i]
            starts, ends, first = K.words(buf, off)
            at, length, period = find_runs(word_numbers(buf, starts, ends), first, shortest, exponent)
            step = np.zeros(len(starts) + 1, np.int64)
            np.add.at(step, at + period, 1)
            np.add.at(step, at + length, -1)
            gone = np.cumsum(step[:-1]) > 0
            # kept words, each with a space behind it
            size = np.where(gone, 0, ends - starts + 1)
            spaced = np.append(buf, 0x20).astype(np.uint8)[K.ranges(starts, size)]
            total = np.concatenate([[0], np.cumsum(size)])
            spaced[total[1:][~gone] - 1] = 0x20
            of = np.searchsorted(at, first)  # runs of each document
            runs, kept = [], []
            for d in range(j - i):
                a, b = of[d], of[d + 1]
                rows = zip((at[a:b] - first[d]).tolist(), length[a:b].tolist(), period[a:b].tolist(), strict=True)
                runs.append([{"start": x, "length": y, "period": z} for x, y, z in rows])
                kept.append(spaced[total[first[d]]:max(total[first[d]], total[first[d + 1]] - 1)].tobytes())
            yield pa.RecordBatch.from_arrays(
                [ids.slice(i, j - i), pa.array(np.diff(first)), pa.array(runs, _RUNS), pa.array(kept, pa.binary())],
                names=[id_col, "n_words", "runs", "collapsed"])


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
                  min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """Per document: (id, n_words, runs array of (start, length, period), collapsed binary).

    ``runs`` are in order of start and period; ``collapsed`` has the words that
    no run contains behind its first period, joined by one space.
    """
    if min_exponent < 3 or min_length < 2:
        raise ValueError("runs have an exponent of 3 and two words at least")
    on_workers(docs.sparkSession)
    return (docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
            .mapInArrow(lambda b: run_batches(b, id_col, min_length, min_exponent),
                        f"{id_col} long, n_words long, runs array<struct<start: long, length: long, period: long>>, "
                        "collapsed binary"))


def run_digests(docs: DataFrame) -> DataFrame:
    """The digest columns of the registered query."""
    runs = F.col("runs")
    line = lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))
    text = F.concat(F.array_join(F.transform(runs, line), "\n"), F.when(F.size(runs) > 0, "\n").otherwise(""))
    stronger = lambda a, r: (F.when(a["period"].isNull() | (r["length"] * a["period"] > a["length"] * r["period"]), r)
                             .otherwise(a))
    none = F.lit(None).cast("struct<start: long, length: long, period: long>")
    out = periodic_runs(docs).withColumn("best", F.aggregate(runs, none, stronger))
    return out.select("doc_id", F.size(runs).cast("long").alias("n_runs"), F.col("best.start").alias("start"),
                      F.col("best.length").alias("length"), F.col("best.period").alias("period"),
                      F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
                      F.sha2(text.cast("binary"), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
