"""Registered queries of the operators, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary() -> str:
    """Path of the vocabulary file that the contracts name."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every text; digests of ids and of the decoded bytes."""
    from truetally.llm.bpe import encode_documents
    return encode_documents(_table(spark, sf_dir, "documents"), vocabulary())


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Remove every word of a 35-word sequence that stands anywhere else too."""
    from truetally.llm.repeats import repeat_digests
    return repeat_digests(_table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base statistics of every document and the verdict of the robust outlier rule."""
    from truetally.llm.quality import judge
    return judge(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of a document and a benchmark item that overlap, substitutions tolerated."""
    from truetally.llm.decontaminate import leaks
    return leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).select(
        "doc_id", "item_id", "score", "item_tokens")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Remove every byte of a 200-byte string that starts anywhere else too."""
    from truetally.llm.suffix_levels import repeat_digests
    return repeat_digests(_table(spark, sf_dir, "documents"))


#: Key of the registered query; a real run passes its own.
DEMO_KEY = "demonstration key"


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with personal data under format-preserving pseudonyms."""
    from truetally.llm.pii import pseudonymise
    return pseudonymise(_table(spark, sf_dir, "documents"), DEMO_KEY).select(
        "doc_id", F.col("_n_replaced").alias("n_replaced"), "text")


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rebuild all conversations and one of control strings from a log of messages, deltas, edits and regenerations,
    and format them; digests are read back from the output."""
    from truetally.llm.chat import conversation_digests, log_of_turns
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "<|im_end|><|im_start|>assistant ok"
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    return conversation_digests(log_of_turns(turns.unionByName(extra)))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write a WARC record per page with a two-level index, and read the archives back."""
    from truetally.llm.warc import archive_pages
    return archive_pages(_table(spark, sf_dir, "pages"))


def op9_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents at a similarity of 0.75."""
    from truetally.llm.near_dup import near_duplicates
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Remove cross-site boilerplate lines; counts and a digest of each kept text."""
    from truetally.llm.line_dedup import remove_boilerplate
    out = remove_boilerplate(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_removed").alias("n_removed"),
                      F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


#: Weights that the sources take in turn.
TURNS = (5, 2, 1)


def op11_curriculum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mix all documents: sources in order weigh 5, 2, 1 in turn; every other source's weight rises, the others' fall."""
    from truetally.llm.curriculum import assign_positions, by_position, ranked
    docs = _table(spark, sf_dir, "documents")
    sources = ranked(docs.select("source").distinct(), F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in TURNS]), (F.col("rank") % len(TURNS) + 1).cast("int"))
    knot = lambda t, part: F.struct(F.lit(t).alias("t"), (part * weight).alias("w"))
    rising, falling = (F.array(knot(0.0, a), knot(1.0, b)) for a, b in ((0.5, 1.5), (1.5, 0.5)))
    schedules = sources.select("source", F.when(F.col("rank") % 2 == 0, rising).otherwise(falling).alias("knots"))
    return by_position(assign_positions(docs, schedules)).select(
        "doc_id", "size", "source_size", "target", "taken", "position")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth row of the embeddings; labels of every seventh are shifted first."""
    from truetally.llm.hard_negatives import hard_negatives
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = _table(spark, sf_dir, "embeddings").withColumn("label", shifted)
    return hard_negatives(rows, F.col("vec_id") % 100 == 0)


def planted_periods(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in a tenth of the documents the words from some place on repeat with some period."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    n = F.size("_w").cast("long")
    cut = docs.select("doc_id", "text", h.alias("_h"), F.when(h % 10 == 0, words).alias("_w"))
    a = F.col("_g") % n
    cut = (cut.withColumn("_g", F.floor(F.col("_h") / 10)).withColumn("_a", F.when(n > 0, a))
           .withColumn("_p", F.floor((n - F.col("_a")) / (3 + F.col("_g") % 8)) + 1))
    block = F.slice("_w", F.col("_a").cast("int") + 1, F.col("_p").cast("int"))
    again = F.flatten(F.array_repeat(block, F.ceil((n - F.col("_a")) / F.col("_p")).cast("int")))
    planted = F.slice(F.concat(F.slice("_w", F.lit(1), F.col("_a").cast("int")), again), F.lit(1), n.cast("int"))
    return cut.select("doc_id", F.when(F.col("_a").isNotNull(), F.array_join(planted, " ")).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every text, a tenth of them with planted periods."""
    from truetally.llm.runs import run_digests
    return run_digests(planted_periods(_table(spark, sf_dir, "documents")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_byte_bpe, op2_substring_dedup, op3_quality, op4_decontaminate, op5_suffix_dedup, op6_pii, op7_chat, op8_warc, op9_near_dup, op10_line_dedup, op11_curriculum,
                                     op12_hard_negatives, op13_periodic_runs)}


OP8_SQL = """
with p as (
  select page_id, coalesce(html, '') as html from pages
), d as (
  select page_id, octet_length(encode(html)) as payload_bytes, sha1(encode(html)) as payload_digest from p
), k as (
  select payload_digest, max(page_id) as keeper from d where payload_bytes >= 1000 group by payload_digest
)
select d.page_id, d.payload_bytes, d.payload_digest,
       case when k.keeper is null or k.keeper = d.page_id then 'response' else 'revisit' end as record_type,
       case when k.keeper <> d.page_id then k.keeper end as refers_to
from d left join k using (payload_digest)
"""

OP7_SQL = r"""
with said as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all
  select -1, t, r, '<|im_end|><|im_start|>assistant ok' from (values (0, 'user'), (1, 'assistant')) as v(t, r)
), sized as (
  select *, replace(replace(text, chr(9243), chr(9243) || '0'), '<|', '<' || chr(9243) || '1|') as body,
         replace(replace(replace(role, chr(9243), chr(9243) || '0'), '<|', '<' || chr(9243) || '1|'),
                 chr(10), chr(9243) || '2') as head
  from said
)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
       cast(sum(length('<|im_start|>') + length(head) + 1 + length(body) + length('<|im_end|>') + 1) as bigint) as formatted_chars
from sized group by conv_id
"""

OP10_SQL = r"""
with split_up as (
  select doc_id, coalesce(source, '') as site, text, string_split(text, chr(10)) as lines from documents
), each as (
  select doc_id, site, unnest(lines) as line from split_up
), spread as (
  select line, min(doc_id) as first_doc from each where trim(line, ' ') <> ''
  group by line having count(distinct site) >= 5
), cut as (
  select d.doc_id, d.text, generate_subscripts(d.lines, 1) as i, unnest(d.lines) as line from split_up d
), marked as (
  select c.doc_id, c.text, c.i, c.line, s.first_doc is not null and s.first_doc is distinct from c.doc_id as gone
  from cut c left join spread s on c.line = s.line
), kept as (
  select doc_id, text, count(*) as n_lines, cast(sum(gone::int) as bigint) as n_removed,
         string_agg(line, chr(10) order by i) filter (where not gone) as kept
  from (select distinct * from marked) group by doc_id, text
)
select d.doc_id, coalesce(k.n_lines, 0) as n_lines, coalesce(k.n_removed, 0) as n_removed,
       sha256(coalesce(k.kept, '')) as kept_sha256
from documents d left join kept k on d.doc_id is not distinct from k.doc_id and d.text is not distinct from k.text
"""


OP11_SQL = r"""
with d as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as size from documents
), s as (
  select source, cast(sum(size) as bigint) as source_size,
         row_number() over (order by source nulls last) - 1 as place from d group by source
), w as (
  select *, cast([5, 2, 1][place % 3 + 1] as double) as weight, 2 * cast(source_size as double) as cap from s
), by_cap as (  -- sources are capped in order of cap / weight
  select *, coalesce(sum(cap) over before, 0) as capped, sum(weight) over rest as free from w
  window before as (order by cap / weight, source nulls last rows between unbounded preceding and 1 preceding),
         rest as (order by cap / weight, source nulls last rows between current row and unbounded following)
), level as (
  select max((1.5 * total - capped) / free) as height from by_cap, (select sum(source_size) as total from w)
), t as (
  select w.*, least(cap, weight * height) as target from w, level
), stream as (
  select d.*, t.source_size, t.target, t.weight, t.place,
         coalesce(sum(size) over (partition by d.source order by md5(cast(doc_id as varchar))[:15], doc_id, size
                                  rows between unbounded preceding and 1 preceding), 0) as start
  from d join t on d.source is not distinct from t.source
), visit as (
  select *, least(size, cast(floor(target) as bigint) - start) as first_words,
         least(size, cast(floor(target) as bigint) - start - source_size) as second_words,
         case when place % 2 = 0 then 0.5 else 1.5 end * weight as w0,
         case when place % 2 = 0 then 1.5 else 0.5 end * weight as w1,
         cast(case when first_words > 0 then start end as double) / target * weight as demand
  from stream
)
select doc_id, cast(size as bigint) as size, source_size, target,
       cast(greatest(first_words, 0) + greatest(second_words, 0) as bigint) as taken,
       2 * demand / (w0 + sqrt(w0 * w0 + 2 * (w1 - w0) * demand)) as position
from visit
"""

OP12_SQL = """
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         [floor(256 * cast(x as double)) for x in embedding] as vec
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len([x for x in embedding if x is null or isnan(x) or isinf(x)]) = 0
), pair as (
  select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same,
         cast(list_dot_product(a.vec, b.vec) as bigint) as score
  from (select * from v where vec_id % 100 = 0) a, v b
), positive as (
  select *, row_number() over (partition by anchor_id order by score desc, other_id) as place
  from pair where same and other_id <> anchor_id
), negative as (
  select p.anchor_id, p.other_id as positive_id, n.other_id as negative_id, p.score as positive_score, n.score as negative_score,
         cast(row_number() over (partition by p.anchor_id, p.other_id order by n.score desc, n.other_id) as integer) as rank
  from positive p join pair n on p.anchor_id = n.anchor_id and not n.same
   and 30 * p.score <= 100 * n.score and 100 * n.score <= 90 * p.score
  where p.place <= 5
)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from negative where rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {"op7_chat": OP7_SQL, "op8_warc": OP8_SQL, "op10_line_dedup": OP10_SQL, "op11_curriculum": OP11_SQL,
            "op12_hard_negatives": OP12_SQL}
