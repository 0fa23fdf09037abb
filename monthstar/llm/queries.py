"""Queries of the operators on the given tables, each over whole tables and whole texts."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthstar.llm import (
    bpe,
    contamination,
    embeddings,
    language,
    negatives,
    pages,
    pii,
    quality,
    repeats,
    secrets,
    simhash,
    wavelet,
    whitening,
)
from monthstar.llm.tables import held_out, shared_folder, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its name, with its SQL where there is one."""

    def add(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql.strip()
        return function

    return add


OP1_SQL = """
with recursive good as (
  select vec_id, cast(embedding as double[]) as v from embeddings
  where embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
link as (
  select a.vec_id as a, b.vec_id as b from good a, good b
  where a.vec_id <> b.vec_id and len(a.v) = len(b.v) and list_cosine_similarity(a.v, b.v) >= 0.9),
reach as (
  select a as vec_id, b as other from link
  union
  select r.vec_id, l.b from reach r join link l on r.other = l.a),
smallest as (select vec_id, min(other) as other from reach group by vec_id),
counted as (select a as vec_id, count(*) as n from link group by a)
select e.vec_id, cast(coalesce(n, 0) as bigint) as n_links,
  least(e.vec_id, coalesce(other, e.vec_id)) as component_id,
  e.vec_id = least(e.vec_id, coalesce(other, e.vec_id)) as kept
from embeddings e left join smallest s on e.vec_id = s.vec_id left join counted c on e.vec_id = c.vec_id
"""


@query(OP1_SQL)
def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


@query()
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    trees = quality.learn(docs, table(spark, sf_dir, "labels"), ~held_out())
    return quality.scores(docs, trees).select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= quality.GOOD).cast("int").alias("predicted"),
    )


@query()
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    coded = bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    ids = F.col("ids")
    return coded.select(
        "doc_id",
        F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", ids.cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(bpe.decode(ids, ranks), 256).alias("decoded_sha256"),
    )


OP4_SQL = r"""
with item as (
  select item_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark where text is not null),
sized as (select item_id, w, least(13, len(w)) as size from item where len(w) > 0),
item_window as (
  select distinct item_id, size, array_to_string(w[i:i + size - 1], ' ') as win
  from (select item_id, w, size, unnest(range(1, len(w) - size + 2)) as i from sized)),
doc as (
  select doc_id, case when text is null then [] else regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') end as w
  from documents),
doc_window as (
  select doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') as win
  from (select doc_id, w, size, unnest(range(1, len(w) - size + 2)) as i
        from doc, (select distinct size from item_window) s where len(w) >= size)),
found as (select doc_id, item_id, d.size, i from doc_window d join item_window b on d.size = b.size and d.win = b.win),
hit as (
  select doc_id, count(distinct p) as n_hit
  from (select doc_id, unnest(range(i, i + size)) as p from found) group by doc_id),
items as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as names
  from (select distinct doc_id, cast(item_id as varchar) as item from found) group by doc_id)
select doc.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
  cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(names, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from doc left join hit on doc.doc_id = hit.doc_id left join items on doc.doc_id = items.doc_id
"""


@query(OP4_SQL)
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), unnamed=True
    )
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda total, hit: total + (hit["end"] - hit["first"]))
    return found.withColumn("n_hit", n_hit).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        contamination.contaminated(F.col("n_words"), F.col("n_hit")).alias("contaminated"),
    )


@query()
def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    profiles = language.learn(docs.where(~held_out()))
    return language.identify(docs, profiles).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score"
    )


@query()
def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(table(spark, sf_dir, "pages"))


OP7_SQL = r"""
with doc as (
  select doc_id, case when text is null then [] else regexp_extract_all(text, '[^\x20\x09-\x0D]+') end as w
  from documents),
win as (
  select doc_id, i, array_to_string(w[i:i + 34], ' ') as win
  from (select doc_id, w, unnest(range(1, len(w) - 33)) as i from doc where len(w) >= 35)),
often as (select win from win group by win having count(*) > 1),
gone as (
  select distinct doc_id, unnest(range(i, i + 35)) as p from win where win in (select win from often)),
word as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as p from doc),
kept as (
  select doc_id, string_agg(word, ' ' order by p) as text, count(*) as n
  from word anti join gone using (doc_id, p) group by doc_id)
select doc.doc_id, cast(len(w) as bigint) as n_words, cast(len(w) - coalesce(n, 0) as bigint) as n_removed,
  sha256(coalesce(kept.text, '')) as kept_sha256
from doc left join kept on doc.doc_id = kept.doc_id
"""


@query(OP7_SQL)
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.covered(table(spark, sf_dir, "documents"))
    return repeats.without_repeats(found).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )


@query()
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return groups.select(
        "doc_id",
        F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def spans_text(spans: str):
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def _count(spans: str, kind: str):
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


@query()
def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )
    return found.select(
        "doc_id",
        *[_count("base", kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2(spans_text("base").cast("binary"), 256).alias("base_sha256"),
        spans_text("spans").alias("spans"),
    )


@query()
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.detect(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *[_count("base", kind).alias(f"n_{kind}") for kind in ("email", "ip", "card", "phone")],
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2(spans_text("base").cast("binary"), 256).alias("base_sha256"),
        spans_text("spans").alias("spans"),
    )


@query()
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings")).withColumn(
        "deviation", whitening.as_long("deviation")
    )


@query()
def op12_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/monthstar-llm-{uuid.uuid4().hex}/tokens"
    wavelet.write(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return wavelet.read(spark, path).select(
        F.col("id").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


OP13_SQL = """
with picked as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * cast(x as double))) as x
  from embeddings
  where vec_id is not null and label is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
scored as (
  select a.vec_id as anchor_id, r.vec_id, a.label = r.label as alike,
    cast(list_inner_product(a.x, r.x) as bigint) as score
  from picked a join picked r on a.vec_id <> r.vec_id and len(a.x) = len(r.x)
  where a.vec_id % 50 = 0),
positive as (
  select anchor_id, vec_id as positive_id, score as positive_score
  from scored where alike
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5),
negative as (
  select p.anchor_id, positive_id, positive_score, vec_id as negative_id, score as negative_score,
    row_number() over (partition by p.anchor_id, positive_id order by score desc, vec_id) as rank
  from positive p join scored s on p.anchor_id = s.anchor_id
  where not alike and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score)
select anchor_id, positive_id, cast(rank as integer) as rank, negative_id, positive_score, negative_score
from negative where rank <= 3
"""


@query(OP13_SQL)
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(vectors.withColumn("label", moved), F.col("vec_id") % 50 == 0)
