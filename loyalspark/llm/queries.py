"""The dealt queries: thin wrappers that apply each operator to its whole table."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontaminate, exact_dedup, html_extract, merkle, minhash, prefix_trie, product_quantiser, quality, secret_scan, suffix_dedup, token_counts, url_filter
from .common import MAX_BROADCAST_IDS, join_small, shared_dir, ship, stage, table

URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), url_filter.rule_frame(spark, URL_RULES))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.encode_decode(table(spark, sf_dir, "documents"), TOKENIZER)
    return out.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                      F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = html_extract.extract(table(spark, sf_dir, "pages"))
    return out.withColumn("n_chars", F.char_length("text").cast("long"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] < 3)

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["name"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, secret_scan.KINDS), F.sha2(secret_scan.digest(base), 256).alias("base_sha256"),
                        secret_scan.digest(F.col("spans")).alias("spans"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_classes(table(spark, sf_dir, "documents")).drop("sha")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        decontaminate.contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches over all documents: every document is inserted under two
    tokenizer versions; exact copies, all but the largest id, are deleted; the
    remaining counts of the first version are revised, digit by digit. The
    revision is committed twice, which changes nothing."""
    docs = table(spark, sf_dir, "documents")
    counters = {"n0": token_counts.words, "n1": token_counts.words_and_digits, "n2": token_counts.pieces}
    counted = stage(spark, token_counts.count_tokens(exact_dedup.digests(docs, more=("source", "lang", "text")), counters), "counted")
    counted = exact_dedup.with_groups(counted)
    first = F.col("id").eqNullSafe(F.col("keep_id"))
    counted = stage(spark, counted.withColumn("row", F.monotonically_increasing_id()), "counted")
    # rows may repeat an id or have none: of those of one text, one stays
    rivals = stage(spark, counted.filter(first).groupBy(*exact_dedup.KEY).agg(F.max("row").alias("stays"), F.count("*").alias("n"))
                   .filter("n > 1").drop("n"), "rivals")
    counted = join_small(counted, rivals, exact_dedup.KEY, "left", MAX_BROADCAST_IDS)
    counted = stage(spark, counted.withColumn("kept", first & (F.col("row") == F.coalesce("stays", "row"))), "counted")
    both = {"words-1": F.col("n0"), "pieces-1": F.col("n2")}
    rollup = token_counts.Rollup(spark, f"{shared_dir(spark)}/llm/rollup-{uuid.uuid4().hex}")
    rollup.commit("insert", token_counts.inserts(counted, both))
    rollup.commit("delete", token_counts.deletes(counted.filter(~F.col("kept")), both))
    revised = token_counts.revisions(counted.filter("kept"), {"words-1": F.col("n0")}, {"words-1": F.col("n1")})
    rollup.commit("revise", revised)
    rollup.compact()
    rollup.commit("revise", revised)
    return rollup.totals()


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.repeated_bytes(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


#: Columns of ``documents`` that a leaf holds.
LEAF = ["doc_id", "source", "lang", "n_chars", "text"]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def crc32_of(col: str):
    """Unsigned CRC-32 of a number written in decimal."""
    return F.crc32(F.col(col).cast("string").cast("binary"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations, each rebuilt with up to three first
    turns of the conversation that its id, less its rest by 20, names."""
    turns = stage(spark, prefix_trie.turn_rows(table(spark, sf_dir, "conversations")), "turns")
    turns = stage(spark, prefix_trie.in_order(turns), "turns")
    convs = turns.filter("rank = 0").select("conv_id", (F.col("conv_id") - F.col("conv_id") % 20).alias("base"),
                                            (crc32_of("conv_id") % 4).alias("h"))
    starts = turns.filter("rank < 3 and conv_id % 20 = 0").select(F.col("conv_id").alias("base"), "rank", "t1", "t2", "tokens")
    none = F.lit(0).cast("long")
    # a base has three such turns and twenty conversations at most
    taken = convs.join(starts, "base").filter(F.col("rank") < F.col("h")).select("conv_id", (F.col("rank") - 3).alias("place"), "t1", "t2", "tokens")
    own = turns.filter(F.col("rank") >= crc32_of("conv_id") % 4).select("conv_id", F.col("rank").alias("place"), "t1", "t2", "tokens")
    themselves = convs.select("conv_id", F.lit(None).cast("long").alias("place"), none.alias("t1"), none.alias("t2"), none.alias("tokens"))
    return prefix_trie.prefix_trie(stage(spark, themselves.unionAll(taken).unionAll(own), "rebuilt"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all documents by source. Each witness is then held
    against its row, every fifth of which (by checksum of the id) has been
    tampered with: text in lower case. A null id is not tampered with."""
    docs = table(spark, sf_dir, "documents").select(*LEAF)
    changed = merkle.leaf(*[F.translate("text", _UPPER, _LOWER) if c == "text" else F.col(c) for c in LEAF])
    leaf = merkle.leaf(*map(F.col, LEAF))
    rows = stage(spark, docs.select("doc_id", "source", leaf.alias("leaf"), F.when(
        F.coalesce(crc32_of("doc_id") % 5 == 0, F.lit(False)), changed).otherwise(leaf).alias("shown")), "leaves")
    out = merkle.manifest(rows, "source", "doc_id", "leaf")
    out = out.withColumn("folded_root", merkle.fold(F.col("shown"), F.col("witness")))
    return out.select("doc_id", "leaf", "subroot", "root", F.sha2(merkle.proof(F.col("witness")), 256).alias("proof_sha256"),
                      "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op13_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return product_quantiser.near_vectors(table(spark, sf_dir, "embeddings"))


def _ready(query):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)
    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run


QUERIES = {
    "op1_url_filters": op1_url_filters,
    "op2_bpe": op2_bpe,
    "op3_html_extraction": op3_html_extraction,
    "op4_secret_scan": op4_secret_scan,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_minhash_near_dedup": op7_minhash_near_dedup,
    "op8_decontamination": op8_decontamination,
    "op9_token_counts": op9_token_counts,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_embedding_near_dedup": op13_embedding_near_dedup,
}
QUERIES = {name: _ready(query) for name, query in QUERIES.items()}
