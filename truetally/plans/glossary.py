"""Glossary resolution over a question/conversation log.

Every name and synonym of the semantic model (bounded, ~200 terms) is
looked up in each text: texts are normalised and split into words, and an index
of the terms' first words decides where n-grams are built at all (linear in text
length, whole texts). A text that uses a bare OTD / on-time-delivery term without an inbound or outbound qualifier is
flagged as needing clarification.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from truetally.plans.semantic import SemanticModel

NORMALISE_RE = r"[^a-z0-9&]+"


def normalise_text(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(c), NORMALISE_RE, " "))


def glossary_terms_df(spark, model: SemanticModel | None = None) -> DataFrame:
    g = (model or SemanticModel()).glossary(spark)
    return g.withColumn("term", normalise_text(F.col("term"))).filter(F.length("term") > 0).distinct()


def term_index(terms: DataFrame) -> tuple[dict[str, list[int]], list[str]]:
    """(first word -> numbers of words of the terms that begin with it, all terms). The terms are the names and
    synonyms that a model declares; they become part of the plan."""
    names = sorted(r.term for r in terms.select("term").distinct().collect())
    sizes: dict[str, set[int]] = {}
    for term in names:
        words = term.split(" ")
        sizes.setdefault(words[0], set()).add(len(words))
    return {w: sorted(n) for w, n in sorted(sizes.items())}, names


def match_terms(texts: DataFrame, id_cols: list[str], text_col: str, terms: DataFrame) -> DataFrame:
    """(ids..., term, kind, target, hits) for every glossary term in each text.

    A word that begins no term is passed over by one look-up; only at the other
    words are candidates built, of the lengths that terms with this first word
    have, and only those that are terms leave the text's row. So the rows
    that are counted and joined are the hits themselves. Both look-ups are
    against hashed sets of literals."""
    sizes, names = term_index(terms)
    if not names:
        return texts.limit(0).select(*id_cols).crossJoin(terms.limit(0)).withColumn("hits", F.lit(0).cast("long"))
    words = F.col("_w")
    at = F.filter(F.sequence(F.lit(1), F.size(words)), lambda i: F.element_at(words, i).isin(*sizes))
    lengths = F.create_map(*[x for w, n in sizes.items() for x in (F.lit(w), F.array(*[F.lit(k) for k in n]))])
    # terms that would run past the text's end come out shorter, and may be other terms: those count at their own length
    grams = lambda i: F.transform(
        F.filter(lengths[F.element_at(words, i)], lambda n: i + n - 1 <= F.size(words)),
        lambda n: F.array_join(F.slice(words, i, n), " "))
    t = texts.select(*id_cols, F.split(normalise_text(F.col(text_col)), " ").alias("_w"))
    # exploded at once: a projection in between would be merged with that of the words, and split the text for each word
    hits = t.select(*id_cols, F.explode(F.filter(F.flatten(F.transform(at, grams)), lambda g: g.isin(*names))).alias("term"))
    counted = hits.groupBy(*id_cols, "term").agg(F.count(F.lit(1)).alias("hits"))
    return counted.join(terms, "term")


def clarification_flags(matches: DataFrame, id_cols: list[str]) -> DataFrame:
    """needs_clarification: an ambiguous OTD term and no supplier/customer OTD metric term."""
    return matches.groupBy(*id_cols).agg(
        (F.max(F.col("kind") == "ambiguous") &
         ~F.max((F.col("kind") == "metric") & F.col("target").isin("supplier_otd", "customer_otd")))
        .alias("needs_clarification"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("kind") == "metric", F.col("target")))), ",")
        .alias("metrics"))
