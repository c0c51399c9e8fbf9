"""The operators of this package as queries over the driver's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from batchlake.llm import binary, bpe, centroids, chat, html, merkle, mixing, packing, pii, quality, secrets, simhash, sql, topk
from batchlake.llm.arrow import span_count, span_text

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Path of a public vocabulary file; the files are not part of this repository."""
    import public_tokenizers

    return public_tokenizers.path(name)


def query(f):
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op1_quality_rules(spark, sf):
    docs = table(spark, sf, "documents")
    return quality.judge(docs, quality.fit_model(docs, table(spark, sf, "labels")))


@query
def op2_topk_search(spark, sf):
    return topk.top_k(table(spark, sf, "embeddings"))


#: A conversation whose texts hold the template's own marks.
_TRAP = r"\### Assistant: </turn> ok"


@query
def op3_chat_reply_trees(spark, sf):
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    trap = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise(chat.ASSISTANT).alias("role"),
        F.lit(_TRAP).alias("text"),
    )
    formatted = chat.conversations(chat.linear(turns.unionByName(trap)))
    lines = F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return (
        formatted.withColumn("read", chat.read_back(F.col("formatted")))
        .withColumn("trained", chat.trained_text(F.col("formatted"), F.col("loss")))
        .select(
            F.col("tree").alias("conv_id"),
            F.size("read").cast("bigint").alias("n_turns"),
            F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
            F.char_length("trained").cast("bigint").alias("loss_chars"),
            F.sha2("trained", 256).alias("loss_sha256"),
            F.char_length("formatted").cast("bigint").alias("formatted_chars"),
        )
    )


ORACLES["op2_topk_search"] = sql.TOPK
ORACLES["op3_chat_reply_trees"] = sql.CHAT

#: Sources to domains, target weights by path, and the budget of the mix. Weights are relative to
#: their siblings; what is not named weighs 1.
DOMAIN = "CASE WHEN source = 'src0' THEN 'crawl' WHEN length(source) = 4 THEN 'books' ELSE 'forums' END"
WEIGHTS = {
    ("crawl",): 2,
    ("books",): 3,
    ("forums",): 5,
    ("crawl", "en"): 6,
    ("books", "en"): 4,
    ("books", "de"): 2,
    ("forums", "en"): 5,
    ("forums", "en", "src12"): 3,
}
SHARE, EPOCHS, SEED = (4, 5), 2, 11


@query
def op4_hierarchical_mix(spark, sf):
    levels = {"domain": F.expr(DOMAIN), "lang": F.col("lang"), "source": F.col("source")}
    docs = table(spark, sf, "documents")
    chosen = mixing.mix(docs, levels, WEIGHTS, SHARE, EPOCHS, SEED)
    return chosen.select(
        "row.doc_id",
        *[F.col("leaf")[k].alias(name) for k, name in enumerate(levels)],
        "tokens",
        "epoch",
    )


ORACLES["op4_hierarchical_mix"] = sql.mixing(DOMAIN, WEIGHTS, SHARE, EPOCHS, SEED)


def _digest(found: DataFrame, kinds: list[str], base: Column) -> DataFrame:
    """Counts and a digest of the base spans, and all spans as text."""
    return found.select(
        "doc_id",
        *[span_count(base, k).alias(f"n_{k}") for k in kinds],
        F.sha2(span_text(base), 256).alias("base_sha256"),
        span_text(F.col("spans")).alias("spans"),
    )


def personal_digest(docs: DataFrame) -> DataFrame:
    """Spans that the CRF adds have the kinds of the base, so their origin tells them apart."""
    return _digest(pii.find_personal(docs), pii.KINDS, F.filter("spans", lambda s: s["base"]))


def secret_digest(docs: DataFrame) -> DataFrame:
    kinds = [rule.kind for rule in secrets.BASE]
    return _digest(secrets.find_secrets(docs), kinds, F.filter("spans", lambda s: s["kind"].isin(*kinds)))


@query
def op5_personal_data(spark, sf):
    return personal_digest(table(spark, sf, "documents"))


@query
def op6_secret_automaton(spark, sf):
    return secret_digest(table(spark, sf, "documents"))


@query
def op7_simhash_dedup(spark, sf):
    return simhash.near_duplicates(table(spark, sf, "documents"))


@query
def op8_arrow_sequences(spark, sf):
    return binary.round_trip(table(spark, sf, "documents"), vocabulary(), end=0)


@query
def op9_packing(spark, sf):
    return packing.pack(table(spark, sf, "documents"), vocabulary(), end=1)


@query
def op10_main_text(spark, sf):
    return html.extract(table(spark, sf, "pages"))


@query
def op11_recursive_bpe(spark, sf):
    import public_tokenizers

    ranks = vocabulary("byte_bpe_multi_50k.tiktoken")
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, ranks, public_tokenizers.PATTERN).select(
        "doc_id",
        F.shiftright(F.octet_length("ids"), 2).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def manifest_rows(docs: DataFrame, span: int = merkle.SPAN) -> DataFrame:
    """Leaves, roots and proofs, and what the proofs give for rows some of which were tampered with."""
    fields = [docs[c] for c in ("doc_id", "source", "lang", "n_chars", "text")]
    tampered = [*fields[:3], docs["n_chars"].cast("decimal(38,0)") + 1, fields[4]]
    altered = F.pmod(F.crc32(docs["doc_id"].cast("string")), F.lit(7)) == 0
    leaves = docs.select(
        "doc_id",
        "lang",
        merkle.leaf_digest(*fields).alias("leaf"),
        F.when(altered, merkle.leaf_digest(*tampered)).alias("tampered"),
    )
    proofs = merkle.Manifest(merkle.place(leaves, "lang", "doc_id"), span).proofs()
    checked = merkle.verify(proofs.withColumn("seen", F.coalesce("tampered", "leaf")), "seen")
    return checked.select(
        "doc_id",
        "leaf",
        "subroot",
        F.col("top").alias("root"),
        F.sha2("path", 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("top")).alias("verified"),
    )


@query
def op12_merkle_manifest(spark, sf):
    return manifest_rows(table(spark, sf, "documents"))


@query
def op13_drift_clusters(spark, sf):
    return centroids.with_inertia(centroids.cluster(table(spark, sf, "embeddings")))


ORACLES["op12_merkle_manifest"] = sql.MERKLE
ORACLES["op13_drift_clusters"] = sql.clusters(8, 10, 64)
