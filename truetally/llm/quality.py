"""Operator 3: quality rules by robust multivariate outliers.

Every document gets a vector of text statistics. Documents that fail the base
rule go; the others are judged within their language and source by a minimum
covariance determinant (MCD) estimate of centre and scatter: a document whose
Mahalanobis distance from its group's centre is beyond a high quantile of the
chi-squared distribution is an outlier.

The MCD runs on all documents, as Spark jobs: each concentration step is one
aggregation of counts, sums and cross products per group and distance bin, from
which the closest ``SHARE`` of a group, its half, gives the next centre and
scatter. The bin that crosses the share is taken whole when that adds at most
``SLACK`` of the group, else by the part that is missing, so equal copies don't
enter all at once. Two starts, one from medians and absolute deviations and one
from the classical estimate, are carried side by side; the smaller determinant
wins. The final centre and scatter are those of all documents within the
``REWEIGHT`` quantile of that estimate, again made consistent for a Gaussian
group. Junk may thus be up to some two fifths of a group. Nothing grows with a
group but the sums, so a source with a third of all documents is as cheap as
any other.

A small ridge (``FLOOR``) is added to each scatter: symbols, repeated lines and
repeated windows are often zero in most of a group, and many copies of one
document may not make their group's scatter vanish. Where a statistic is
constant, the ridge alone says how far a document may lie (``REJECT`` gives 4.5
standard deviations): some 1 % of symbols, 4 repeated lines, 29 % of words in
repeated windows. Groups with fewer than ``MIN_GROUP`` judged
documents are pooled by language, and what is left over all languages; where that
is still too small, these documents are judged against all documents.

Defined cases: null text has no words, so it fails the base rule; null
languages and sources are groups of their own; rows that repeat id and text
get equal verdicts; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from truetally.llm import kernels as K
from truetally.llm.common import (arrow_column, doc_chunks, giving_back, on_workers, small_batches, small_side,
                                  string_buffers, text_key, written)

#: The characters that count as symbols.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
SHARE = 0.5
#: Share of a group by which a whole bin may exceed SHARE.
SLACK = 0.1
#: Quantile of the documents that the reweighted estimate takes.
REWEIGHT = 0.975
MIN_GROUP = 50
#: Pool of all judged documents, for those whose groups are too small together, too.
ALL = "all"
#: Smallest standard deviations of: log words, log word length, log symbol share, log duplicate lines, log repeat share.
FLOOR = (0.2, 0.05, 0.15, 0.35, 0.3)
#: Share of clean documents of a Gaussian group that may be rejected.
REJECT = 1e-3
STEPS = 8
BINS_PER_E = 16
P = len(FLOOR)
GROUP_ROWS = 200_000

BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
_symbol = np.zeros(256, bool)
_symbol[[ord(c) for c in SYMBOLS]] = True


def text_statistics(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """(documents, 5): words, their code points, symbols, repeated lines, words in repeated 3-word windows."""
    docs = len(off) - 1
    starts, ends, first = K.words(buf, off)
    n_words = np.diff(first)
    total = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[off])
    word_chars = total(~K.SPACE[buf] & ((buf & 0xC0) != 0x80))
    n_symbols = total(_symbol[buf])
    # lines that hold a word
    newline = np.flatnonzero(buf == 10) + 1
    begin = np.unique(np.concatenate([off[:-1], newline]))
    begin = begin[begin < len(buf)]
    end = np.append(begin[1:], len(buf)) if len(begin) else begin
    end = end - (buf[end - 1] == 10) if len(begin) else end
    filled = np.searchsorted(starts, begin) < np.searchsorted(starts, end)
    begin, end = begin[filled], end[filled]
    doc = np.searchsorted(off, begin, side="right") - 1
    lines = np.bincount(doc, minlength=docs)
    hashes = K.long_slices(K.byte_slices(K.byte_prefix(buf), begin, end), buf, begin, end)
    inverse, counts = K.group_min_max(K.mix(hashes ^ K.mix(doc.astype(np.uint64))))
    owner = np.zeros(len(counts), np.int64)
    owner[inverse] = doc
    distinct = np.bincount(owner, minlength=docs)
    # 3-word windows met twice or more in one document
    units = K.word_hashes(buf, starts, ends)
    win = np.flatnonzero(K.valid_windows(first, 3)[:max(len(units) - 2, 0)])
    doc = np.searchsorted(first, win, side="right") - 1
    grams = K.unit_grams(K.unit_prefix(units), 3)[win] if len(win) else np.zeros(0, np.uint64)
    inverse, counts = K.group_min_max(K.mix(grams ^ K.mix(doc.astype(np.uint64))))
    again = win[counts[inverse] > 1] if len(win) else win
    step = np.zeros(len(units) + 1, np.int64)
    step[again] += 1
    np.add.at(step, again + 3, -1)
    covered = np.concatenate([[0], np.cumsum(np.cumsum(step[:-1]) > 0)])
    return np.stack([n_words, word_chars, n_symbols, lines - distinct, np.diff(covered[first])], 1)


def statistics_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        buf, off = string_buffers(arrow_column(batch, "_text"))
        found = [np.zeros((0, 5), np.int64)]
        found += [text_statistics(buf[off[i]:off[j]], off[i:j + 1] - off[i]) for i, j in doc_chunks(off)]
        table = np.concatenate(found).astype(np.int64)
        names = ["_key", "_id", "_lang", "_site"]
        yield pa.RecordBatch.from_arrays([*(arrow_column(batch, x) for x in names),
                                          *(pa.array(np.ascontiguousarray(table[:, k])) for k in range(5))],
                                         names=[*names, *(x.split()[0] for x in BASE.split(", "))])


def vector() -> list[Column]:
    """The transformed statistics, from the base columns."""
    n, chars = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    return [F.log(n.cast("double")), F.log(chars / n), F.log1p(100.0 * F.col("n_symbols") / chars),
            F.log1p(F.col("n_dup_lines").cast("double")), F.log1p(10.0 * F.col("n_repeat_words") / n)]


def chi2_cdf(x: float, k: int) -> float:
    """Chi-squared distribution function by the series of the incomplete gamma function."""
    if x <= 0:
        return 0.0
    a, z = k / 2, x / 2
    term = total = 1 / a
    n = 0
    while term > total * 1e-17:
        n += 1
        term *= z / (a + n)
        total += term
    return min(1.0, total * math.exp(-z + a * math.log(z) - math.lgamma(a)))


def chi2_quantile(p: float, k: int) -> float:
    lo, hi = 0.0, 1000.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_cdf(mid, k) < p else (lo, mid)
    return hi


def scatter_scale(share: float = SHARE) -> float:
    """Factor that makes the scatter of the closest ``share`` consistent for a Gaussian group."""
    return share / chi2_cdf(chi2_quantile(share, P), P + 2)


_PAIRS = [(i, j) for i in range(P) for j in range(i, P)]
_PARAMETERS = ("pool string, start int, n long, logdet double, "
               + ", ".join(f"m{i} double" for i in range(P)) + ", "
               + ", ".join(f"q{i}{j} double" for i, j in _PAIRS))


def _parameters(pool: str, start: int, n: int, mean: np.ndarray, cov: np.ndarray) -> list:
    sigma = cov + np.diag(np.square(FLOOR))
    inverse = np.linalg.inv(sigma)
    return [pool, start, n, float(np.linalg.slogdet(sigma)[1]), *map(float, mean),
            *(float(inverse[i, j]) for i, j in _PAIRS)]


def _frame(rows: list) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[x.split()[0] for x in _PARAMETERS.split(", ")])


def _concentrate(part: pd.DataFrame) -> pd.DataFrame:
    """The next centre and scatter of one pool and start, from its binned sums (a bounded number of rows)."""
    part = part.sort_values("bin")
    n = int(part["c"].sum())
    before = part["c"].cumsum() - part["c"]
    h = math.ceil(SHARE * n)
    near = part[before < h].drop(columns=["pool", "start", "bin"]).astype(float)
    if near["c"].sum() > h + SLACK * n:
        near.iloc[-1] *= (h - before.iloc[len(near) - 1]) / near["c"].iloc[-1]
    c = float(near["c"].sum())
    mean = np.array([near[f"s{i}"].sum() for i in range(P)]) / c
    cov = np.zeros((P, P))
    for i, j in _PAIRS:
        cov[i, j] = cov[j, i] = near[f"s{i}{j}"].sum() / c - mean[i] * mean[j]
    return _frame([_parameters(part["pool"].iloc[0], int(part["start"].iloc[0]), n, mean, cov * scatter_scale())])


def _reweighted_parameters(part: pd.DataFrame) -> pd.DataFrame:
    x = part.iloc[0]
    mean = np.array([x[f"s{i}"] for i in range(P)]) / x["c"]
    cov = np.zeros((P, P))
    for i, j in _PAIRS:
        cov[i, j] = cov[j, i] = x[f"s{i}{j}"] / x["c"] - mean[i] * mean[j]
    return _frame([_parameters(x["pool"], 0, int(x["n"]), mean, cov * scatter_scale(REWEIGHT))])


def _first_parameters(part: pd.DataFrame) -> pd.DataFrame:
    x = part.iloc[0]
    mean = np.array([x[f"s{i}"] for i in range(P)]) / x["c"]
    cov = np.zeros((P, P))
    for i, j in _PAIRS:
        cov[i, j] = cov[j, i] = x[f"s{i}{j}"] / x["c"] - mean[i] * mean[j]
    median = np.array([x[f"h{i}"] for i in range(P)])
    spread = np.array([x[f"d{i}"] for i in range(P)]) * 1.4826
    return _frame([_parameters(x["pool"], 0, int(x["c"]), median, np.diag(np.square(spread))),
                   _parameters(x["pool"], 1, int(x["c"]), mean, cov)])


def _sums() -> list[Column]:
    return [F.count(F.lit(1)).alias("c"), *(F.sum(f"x{i}").alias(f"s{i}") for i in range(P)),
            *(F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"s{i}{j}") for i, j in _PAIRS)]


def distance() -> Column:
    """Squared Mahalanobis distance of x from the joined parameters."""
    d = [F.col(f"x{i}") - F.col(f"m{i}") for i in range(P)]
    terms = [(1.0 if i == j else 2.0) * d[i] * d[j] * F.col(f"q{i}{j}") for i, j in _PAIRS]
    return F.greatest(sum(terms[1:], terms[0]), F.lit(0.0))


def pooled(stats: DataFrame) -> DataFrame:
    """``stats`` of documents that pass the base rule, with the pool in which each is judged."""
    passed = stats.where("not base_failed")
    lang, site = F.coalesce(F.concat(F.lit("="), "_lang"), F.lit("")), F.coalesce(F.concat(F.lit("="), "_site"), F.lit(""))
    sizes = (passed.groupBy("_lang", "_site").agg(F.count(F.lit(1)).alias("a"))
             .withColumn("small", F.when(F.col("a") < MIN_GROUP, F.col("a")).otherwise(0)))
    by_lang = sizes.groupBy("_lang").agg(F.sum("small").alias("b"))
    rest = by_lang.agg(F.sum(F.when(F.col("b") < MIN_GROUP, F.col("b")).otherwise(0)).alias("r"))
    pools = (sizes.join(by_lang, sizes["_lang"].eqNullSafe(by_lang["_lang"])).drop(by_lang["_lang"]).crossJoin(F.broadcast(rest))
             .withColumn("pool", F.when(F.col("a") >= MIN_GROUP, F.concat(F.lit("s"), F.length(lang), lang, site))
                         .when(F.col("b") >= MIN_GROUP, F.concat(F.lit("l"), lang))
                         .when(F.col("r") >= MIN_GROUP, F.lit("rest")).otherwise(F.lit(ALL)))
             .select(F.col("_lang").alias("_l"), F.col("_site").alias("_s"), "pool"))
    pools = small_side(written(pools, "pools"), GROUP_ROWS)
    return passed.join(pools, F.col("_lang").eqNullSafe(F.col("_l")) & F.col("_site").eqNullSafe(F.col("_s"))).drop("_l", "_s")


def fit(points: DataFrame) -> DataFrame:
    """MCD parameters of each pool from (pool, x0 ..)."""
    centre = points.groupBy("pool").agg(*(F.percentile_approx(f"x{i}", 0.5, 10_000).alias(f"h{i}") for i in range(P)))
    centre = small_side(written(centre, "medians"), GROUP_ROWS)
    wide = points.join(centre, "pool")
    first = (wide.groupBy("pool").agg(*_sums(), *(F.first(f"h{i}").alias(f"h{i}") for i in range(P)),
                                      *(F.percentile_approx(F.abs(F.col(f"x{i}") - F.col(f"h{i}")), 0.5, 10_000)
                                        .alias(f"d{i}") for i in range(P)))
             .groupBy("pool").applyInPandas(_first_parameters, _PARAMETERS))
    now = written(first, "mcd")
    for _ in range(STEPS):
        near = points.join(small_side(now.drop("n", "logdet"), GROUP_ROWS), "pool")
        bins = F.floor(F.log(distance() + 1e-9) * BINS_PER_E)
        sums = near.withColumn("bin", bins).groupBy("pool", "start", "bin").agg(*_sums())
        now = written(sums.groupBy("pool", "start").applyInPandas(_concentrate, _PARAMETERS), "mcd")
    best = now.groupBy("pool").agg(F.min_by(F.struct(*now.columns), F.struct("logdet", "start")).alias("b"))
    return written(best.select("b.*").drop("start"), "mcd")


def reweighted(points: DataFrame, fitted: DataFrame) -> DataFrame:
    """Centre and scatter of the points within the ``REWEIGHT`` quantile of the MCD, in the columns of ``fitted``."""
    near = points.join(small_side(fitted, GROUP_ROWS), "pool").where(distance() <= chi2_quantile(REWEIGHT, P))
    sums = near.groupBy("pool").agg(F.first("n").alias("n"), *_sums())
    return written(sums.groupBy("pool").applyInPandas(_reweighted_parameters, _PARAMETERS).drop("start"), "reweighted")


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          site_col: str = "source") -> DataFrame:
    """(_key, id, base statistics, base_failed, distance, kept) of every document row."""
    small_batches(on_workers(docs.sparkSession))
    fields = docs.select(text_key(id_col, text_col).alias("_key"), F.col(id_col).cast("long").alias("_id"),
                         F.col(lang_col).cast("string").alias("_lang"), F.col(site_col).cast("string").alias("_site"),
                         F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    stats = fields.mapInArrow(lambda b: giving_back(statistics_batches(b)), "_key long, _id long, _lang string, _site string, " + BASE)
    stats = written(stats.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                                     | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))), "statistics")
    points = pooled(stats).withColumns({f"x{i}": x for i, x in enumerate(vector())})
    points = written(points, "points")
    values = [f"x{i}" for i in range(P)]
    own = points.where(F.col("pool") != ALL).select("pool", *values)
    if not points.where(F.col("pool") == ALL).isEmpty():  # the few that no pool takes are judged against all documents
        own = own.unionByName(points.select(F.lit(ALL).alias("pool"), *values))
    fitted = reweighted(own, fit(own))
    limit = chi2_quantile(1 - REJECT, P)
    judged = (points.join(small_side(fitted.withColumnRenamed("n", "pool_n"), GROUP_ROWS), "pool", "left")
              .withColumn("distance", distance())
              .withColumn("kept", F.coalesce(F.col("distance") <= limit, F.lit(True))))
    columns = ["_key", F.col("_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
               "base_failed"]
    return (judged.select(*columns, "distance", "kept")
            .unionByName(stats.where("base_failed").select(*columns, F.lit(None).cast("double").alias("distance"),
                                                           F.lit(False).alias("kept"))))
