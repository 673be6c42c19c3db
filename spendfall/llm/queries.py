"""The operators over the given tables, one query each, as their contracts ask."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendfall.llm.byte_bpe import Coder, decode, encode
from spendfall.llm.chat_format import format_chat, read_back
from spendfall.llm.cover_tree import near_embeddings
from spendfall.llm.exact_topk import exact_topk, scaled
from spendfall.llm.license_scan import license_scan
from spendfall.llm.line_dedup import line_dedup
from spendfall.llm.merkle import fold, leaf_digest, manifest, proof_digest
from spendfall.llm.near_duplicates import near_duplicates
from spendfall.llm.oracle import ORACLE
from spendfall.llm.packing import pack
from spendfall.llm.prefix_trie import end_digests, prefix_trie, turn_rows, with_shared_starts
from spendfall.llm.quality_rules import quality_rules
from spendfall.llm.toxicity import fit, score
from spendfall.llm.url_filter import Rule, judge_urls, page_edges

#: The rules for hosts and paths, and the rows that nothing is learned from.
RULES = [
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
]
HELD_OUT = "crc32(cast(cast(doc_id as string) as binary)) % 4 = 2"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Probability that a document is toxic, from the learning part of the labels."""
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    model = fit(docs, _table(spark, folder, "labels"), learn=f"not ({HELD_OUT})")
    scored = score(docs, model)
    return scored.select("doc_id", F.expr(HELD_OUT).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op2_exact_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The five best other vectors of every fiftieth vector."""
    vectors = _table(spark, folder, "embeddings").select("vec_id", scaled(F.col("embedding")).alias("vector"))
    return exact_topk(vectors.where("vec_id % 50 = 0"), vectors, "vec_id", "vector", 5)


def op3_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Licences that whole documents, or single lines of them, are."""
    found = license_scan(_table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "text_digest", "license", F.array_join("line_licenses", ",").alias("line_licenses"))


def op4_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Rule and verdict for every page's URL."""
    pages = _table(spark, folder, "pages")
    return judge_urls(pages.select("page_id", "url"), page_edges(pages), RULES).select("page_id", "host", "path", "rule", "verdict")


def _coder() -> Coder:
    import public_tokenizers

    return Coder.load(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op5_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of all conversations, and one whose texts are control strings, read back from the formatted turns."""
    coder = _coder()
    turns = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")], turns.schema)
    return read_back(format_chat(turns.union(extra), coder), coder)


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Base counts and the verdict of the distances to each language's histograms."""
    return quality_rules(_table(spark, folder, "documents").select("doc_id", "text", "lang")).drop("text", "lang")


def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Documents less passages of 50 words or more that stand in an earlier one, or further up."""
    cleaned = line_dedup(_table(spark, folder, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "n_words", "n_deleted", "runs", F.sha2("text", 256).alias("text_sha256"))


def op8_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every text and the bytes they decode to."""
    coder = _coder()
    coded = encode(_table(spark, folder, "documents").select("doc_id", "text"), coder)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(decode(F.col("ids"), coder), 256).alias("decoded_sha256"),
    )


def op9_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of documents that share 85 % of their three-word shingles."""
    return near_duplicates(_table(spark, folder, "documents"), width=3, percent=85)


def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every word of every document placed in a training sequence."""
    return pack(_table(spark, folder, "documents"))


def op11_near_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    """Links and groups of vectors that point the same way under one label."""
    return near_embeddings(_table(spark, folder, "embeddings"))


def tampered_manifest(docs: DataFrame) -> DataFrame:
    """Proofs of all documents, and the roots that they give for documents of which some lost their line feeds."""
    fields = [F.col(name) for name in ("doc_id", "source", "lang", "n_chars")]
    text, lost = F.col("text"), F.replace("text", F.lit("\n"), F.lit(""))
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    leaves = docs.select("doc_id", "source", leaf_digest(*fields, text).alias("leaf"), leaf_digest(*fields, F.when(tampered, lost).otherwise(text)).alias("other"))
    proven = manifest(leaves, "source", "doc_id", carried=["other"])
    folded = proven.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"), fold(F.col("other"), F.col("proof")).alias("folded_root"))
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Leaf, roots and proof of every document, verified after tampering with some."""
    return tampered_manifest(_table(spark, folder, "documents"))


def rebuilt_trie(conversations: DataFrame) -> DataFrame:
    """The trie of all conversations after shared starts, with digests of those that end at each node."""
    nodes, ends = prefix_trie(*with_shared_starts(turn_rows(conversations)))
    digests = nodes.join(end_digests(ends), ["conv_id", "depth"], "left")
    return digests.withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)))


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Nodes of the trie of all conversations."""
    return rebuilt_trie(_table(spark, folder, "conversations"))


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_toxicity": op1_toxicity,
        "op2_exact_topk": op2_exact_topk,
        "op3_license_scan": op3_license_scan,
        "op4_url_filter": op4_url_filter,
        "op5_chat_format": op5_chat_format,
        "op6_quality_rules": op6_quality_rules,
        "op7_line_dedup": op7_line_dedup,
        "op8_byte_bpe": op8_byte_bpe,
        "op9_near_duplicates": op9_near_duplicates,
        "op10_packing": op10_packing,
        "op11_near_embeddings": op11_near_embeddings,
        "op12_merkle_manifest": op12_merkle_manifest,
        "op13_prefix_trie": op13_prefix_trie,
    }


def llm_oracle() -> dict[str, str]:
    return dict(ORACLE)
