"""Operator 4: benchmark decontamination by spaced-seed hashing.

Texts and benchmark items are sequences of lower-case tokens (runs of letters
and digits). At every position fixed masks read some of the next tokens and
ignore the others, so a substituted word that falls on an ignored place leaves
the hash intact. A sieve of fixed size over the tokens at the masks' common
ends skips positions that can't match any item. Seeds of the texts are joined with seeds of the items; each hit
names an item and a diagonal (text position minus item position). On every
such diagonal the overlap is verified over the whole item: a matched token
scores 1, a substituted one -1, and the best run must score ``MIN_SCORE`` or, in
a short item, ``MIN_SHARE`` of its tokens: what the whole item scores with one
token in five substituted. Items shorter than a mask are sought whole, by one
hash, if they have ``MIN_ITEM`` tokens.

DataFrame functions only. The items' seeds are broadcast when their counted
rows fit ``SEED_ROWS``; else the same join is shuffled.

Defined cases: null texts have no tokens; items of fewer than ``MIN_ITEM`` tokens
are never reported, as ordinary speech has them; an overlap is found if it has, anywhere, a
window of 8 tokens whose ends match, with at most two substitutions between (of
three, some); repeated items are reported each; rows that repeat id and text
give one row per item; empty tables give an empty result; further columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from truetally.llm.common import small_side, text_key, written

#: Token places that each mask reads. All masks read the first and the last place, on which positions are sifted; of the
#: places between, any two are ignored by some mask.
MASKS = ((0, 1, 3, 4, 7), (0, 2, 3, 6, 7), (0, 1, 5, 6, 7), (0, 4, 5, 6, 7), (0, 1, 2, 4, 7), (0, 2, 3, 5, 7))
SPAN = 8
MIN_SCORE, MIN_SHARE, MIN_ITEM = 10, 0.6, 3
SEED_ROWS = 500_000
#: Cells of the sieve: a fixed size, whatever the number of items.
SIEVE = 1 << 16


def token_hashes(text: Column) -> Column:
    """Hashes of the tokens, in order."""
    tokens = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", -1), lambda t: t != "")
    return F.transform(tokens, lambda t: F.xxhash64(t))


def positions(hashes: Column) -> Column:
    """Positions at which the masks fit."""
    return F.when(F.size(hashes) >= SPAN, F.sequence(F.lit(0), F.size(hashes) - SPAN)) \
        .otherwise(F.array().cast("array<int>"))


def cell(token: Column) -> Column:
    return F.pmod(token, F.lit(SIEVE)).cast("int")


def seeds(hashes: Column, at: Column) -> Column:
    """array<struct<at, seed>>: the seeds of all masks at some positions."""
    return F.flatten(F.transform(at, lambda i: F.array(*(
        F.struct(i.alias("at"), F.xxhash64(F.lit(k), *(F.get(hashes, i + p) for p in m)).alias("seed"))
        for k, m in enumerate(MASKS)))))


def needed(tokens: Column, min_score: int) -> Column:
    """Score that an overlap with an item of so many tokens must reach."""
    return F.when(tokens < SPAN, tokens).otherwise(F.least(F.lit(min_score), F.ceil(tokens * MIN_SHARE).cast("int")))


def whole(hashes: Column, at: Column, tokens: int) -> Column:
    """array<struct<at, seed>>: hashes of all ``tokens`` tokens at some positions."""
    return F.transform(at, lambda i: F.struct(
        i.alias("at"), F.xxhash64(F.lit(-tokens), *(F.get(hashes, i + p) for p in range(tokens))).alias("seed")))


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
          item_text_col: str = "text", min_score: int = MIN_SCORE) -> DataFrame:
    """One row per document and item that overlap: (_key, id, item, score, item_tokens)."""
    known = written(items.select(F.col(item_col).alias("_item"), token_hashes(F.col(item_text_col)).alias("_g")), "items")
    n = F.size("_g")
    short = [r.n for r in known.where(n.between(MIN_ITEM, SPAN - 1)).select(n.alias("n")).distinct().collect()]  # SPAN at most
    first = F.array(F.lit(0))
    own = seeds(F.col("_g"), positions(F.col("_g")))
    for k in short:
        own = F.when(n == k, whole(F.col("_g"), first, k)).otherwise(own)
    item_seeds = written(known.select("_item", F.explode(own).alias("_s"))
                         .select("_item", F.col("_s.at").alias("_at"), F.col("_s.seed").alias("_seed")).distinct(), "item-seeds")
    # the sieve: which cells hold a token with which some item's window begins or ends; one row of fixed size
    ends = known.where(n >= MIN_ITEM).select("_g", F.explode(F.when(n < SPAN, first).otherwise(positions(F.col("_g")))).alias("i")) \
        .select(F.explode(F.array(F.get("_g", F.col("i")), F.get("_g", F.least(F.col("i") + SPAN, n) - 1))).alias("t"))
    cells = ends.select(cell(F.col("t")).alias("c")).distinct().agg(F.sort_array(F.collect_list("c")).alias("_cells"))
    sieve = written(cells.select(F.transform(
        F.split(F.array_join(F.transform(F.sequence(F.lit(0), F.size("_cells")), lambda j: F.concat(
            F.repeat(F.lit("0"), F.coalesce(F.get("_cells", j), F.lit(SIEVE))
                     - F.when(j > 0, F.get("_cells", j - 1)).otherwise(F.lit(-1)) - 1), F.lit("1"))), ""), ""),
        lambda c: c == "1").alias("_sieve")), "sieve")
    def sifted(tokens: int) -> Column:
        at = F.when(F.size("_h") >= tokens, F.sequence(F.lit(0), F.size("_h") - tokens)).otherwise(F.array().cast("array<int>"))
        return F.filter(at, lambda i: F.get("_sieve", cell(F.get("_h", i))) & F.get("_sieve", cell(F.get("_h", i + tokens - 1))))

    found_at = {k: f"_at{k}" for k in (SPAN, *short)}
    every = F.concat(seeds(F.col("_h"), F.col(found_at[SPAN])), *(whole(F.col("_h"), F.col(found_at[k]), k) for k in short))
    text_seeds = (docs.select(text_key(id_col, text_col).alias("_key"), token_hashes(F.col(text_col)).alias("_h"))
                  .crossJoin(F.broadcast(sieve))
                  .select("_key", "_h", *(sifted(k).alias(c) for k, c in found_at.items()))
                  .select("_key", F.explode(every).alias("_s"))
                  .select("_key", F.col("_s.at").alias("_p"), F.col("_s.seed").alias("_seed")))
    hits = (text_seeds.join(small_side(item_seeds, SEED_ROWS), "_seed")
            .select("_key", F.struct("_item", (F.col("_p") - F.col("_at")).cast("int").alias("_d")).alias("_hit"))
            .groupBy("_key").agg(F.collect_set("_hit").alias("_hits")))
    hits = written(hits, "seed-hits")
    found = (docs.select(text_key(id_col, text_col).alias("_key"), F.col(id_col).cast("long").alias("_id"),
                         F.col(text_col).alias("_text"))
             .join(hits, "_key")
             .select("_key", "_id", token_hashes(F.col("_text")).alias("_h"), F.explode("_hits").alias("_hit"))
             .select("_key", "_id", "_h", "_hit._item", "_hit._d")
             .join(small_side(known, SEED_ROWS // 50), "_item"))
    low = F.greatest(F.lit(0), -F.col("_d"))
    high = F.least(F.size("_g"), F.size("_h") - F.col("_d")) - 1
    state = F.struct(F.lit(0).alias("run"), F.lit(0).alias("best"))

    def step(a, j):
        run = F.greatest(F.lit(0), a["run"] + F.when(F.get("_g", j) == F.get("_h", j + F.col("_d")), 1).otherwise(-1))
        return F.struct(run.alias("run"), F.greatest(a["best"], run).alias("best"))

    score = F.aggregate(F.sequence(low, high), state, step, lambda a: a["best"])
    return (found.select("_key", "_id", "_item", score.alias("_score"), F.size("_g").alias("_n"))
            .groupBy("_key", "_id", "_item").agg(F.max("_score").alias("score"), F.max("_n").alias("item_tokens"))
            .where(F.col("score") >= needed(F.col("item_tokens"), min_score))
            .select("_key", F.col("_id").alias(id_col), F.col("_item").alias(item_col), "score", "item_tokens"))
