"""The registered queries of this folder's operators, over the whole of their tables, with production parameters."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenantferry.llm import cuckoo, kdtree, lattice, merkle, mixing, pii, repair, repetition, secrets, simhash, sql, token_trees, topk, toxicity
from tenantferry.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

#: Vocabulary files of public tokenizers; every node has them at this path.
TOKENIZERS = os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers")
PIECES = f"{TOKENIZERS}/piece_bpe_32k.model"
RANKS = f"{TOKENIZERS}/byte_bpe_50k.tiktoken"
#: Fixed value: the pattern that splits texts before the merges of the rank file.
PRE_TOKENS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SHARDS = 16
#: Targets are the shares there are to this power, made equal to one again: it flattens the mixture somewhat.
FLATTEN = 0.8


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if oracle:
            ORACLE[fn.__name__] = oracle
        return fn
    return add


def held_out() -> F.Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 1


@query()
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels").filter(~held_out()))
    return toxicity.score_documents(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")


@query()
def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.scan(docs, secrets.trained(docs))


@query()
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query()
def op4_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.quality(table(spark, sf_dir, "documents"))


def sample_edits() -> F.Column:
    """Three edits for each text: words put in at a third, a deletion in the middle, and a change of the last word's end."""
    n = F.length(F.coalesce(F.col("text"), F.lit("")))
    third, half = F.floor(n / 3), F.floor(n / 2)
    rows = [(third, F.lit(0), F.lit(" put in, 42 words'll do")), (half, F.lit(17), F.lit("")), (n - 3, F.lit(2), F.lit("ly."))]
    return F.array(*(F.struct(p.cast("long").alias("pos"), d.cast("long").alias("deleted"), t.alias("inserted")) for p, d, t in rows))


@query()
def op5_token_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    counted = token_trees.counts(docs, sample_edits(), RANKS, PRE_TOKENS)
    return counted.withColumn("text_crc32", F.crc32(F.col("text").cast("binary"))).drop("text")


@query()
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixing.by_source_language_topic(docs, FLATTEN).select("doc_id", "__mix.*")


@query("""
with usable as (
    select vec_id, row_number() over () as r, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
    from embeddings
    where embedding is not null and len(embedding) > 0
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
    select q.vec_id as query_id, q.r, c.vec_id, c.r as other, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::bigint as score
    from usable q join usable c on q.r <> c.r and len(q.v) = len(c.v)
    where q.vec_id % 50 = 0
), ranked as (
    select *, row_number() over (partition by r order by score desc, vec_id, other) as rank from scored
)
select query_id, rank::int as rank, vec_id, score from ranked where rank <= 5
""")
def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


@query()
def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.documents(table(spark, sf_dir, "documents"), pii.train_on(pii.sample_table(spark)))


@query()
def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.counted(table(spark, sf_dir, "documents"), lattice.load(PIECES))


@query()
def op10_kdtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = kdtree.documents(table(spark, sf_dir, "documents"), SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


@query(sql.REPAIR)
def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.conversations(table(spark, sf_dir, "conversations"))


@query(sql.DEDUP)
def op12_cuckoo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cuckoo.documents(table(spark, sf_dir, "documents"))


@query(sql.MERKLE)
def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    proofs = merkle.documents(table(spark, sf_dir, "documents"))
    return proofs.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
