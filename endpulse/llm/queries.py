"""The queries, with production parameters, over their whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from endpulse.llm import (
    alignment, ann_tree, chat, decontamination, license_scan, line_dedup, minhash, mixing, oracles, packing,
    prefix_trie, substring_dedup, token_files, toxicity,
)

#: Parts of the mixture for each source; '*' stands for all sources not named.
TARGET_WEIGHTS = {"src0": 30, "src1": 10, "src2": 10, "src3": 5, "src4": 5, "*": 40}
#: Words that a single repeated line, or a pair of lines, holds at least.
SHORT_WORDS = 20


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def piece_tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def word_tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark, sf_dir):
    docs, items = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return decontamination.contaminated(docs, items).drop(decontamination.KEY)


def op2_line_dedup(spark, sf_dir):
    done = line_dedup.dedup_lines(_table(spark, sf_dir, "documents"), min_words=SHORT_WORDS)
    return done.select(
        "doc_id", "n_lines", F.size("deleted_lines").cast("long").alias("n_deleted"),
        F.concat_ws(",", F.transform("deleted_lines", lambda x: x.cast("string"))).alias("deleted_lines"),
        F.sha2("text", 256).alias("text_sha256"))


def op3_toxicity(spark, sf_dir):
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    done = toxicity.scored(docs.select("doc_id", "text"), labels)
    return done.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op4_minhash(spark, sf_dir):
    return minhash.near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_ann_tree(spark, sf_dir):
    vectors = ann_tree.usable(_table(spark, sf_dir, "embeddings"))
    return ann_tree.search(vectors, vectors.where("vec_id % 20 = 0"))


def op6_chat(spark, sf_dir):
    told = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", told), (-1, 1, "assistant", told)],
                                  "conv_id bigint, turn bigint, role string, text string")
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionAll(extra)
    return chat.read_back(chat.formatted(chat.linear_tree(rows))).drop("path")


def op7_token_files(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_files.read_documents(token_files.write_shards(docs, tokenizer_path()))


def op8_license_scan(spark, sf_dir):
    done = license_scan.scanned(_table(spark, sf_dir, "documents").select("doc_id", "text"), wrapped=True)
    return done.withColumns({c: F.concat_ws(",", c) for c in ("base_labels", "labels")})


def op9_substring_dedup(spark, sf_dir):
    spans = substring_dedup.repeated_spans(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return spans.select("doc_id", "first_doc_id", "start", "n_bytes", "n_words", "kept",
                        F.size("later").cast("long").alias("n_later_chunks"))


def op10_mixing(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.scheduled(docs, mixing.split_rest(docs, TARGET_WEIGHTS), each=True)


def op11_alignment(spark, sf_dir):
    return alignment.aligned(_table(spark, sf_dir, "documents"), tokenizer_path(), piece_tokenizer_path())


def op12_prefix_trie(spark, sf_dir):
    return prefix_trie.trie(_table(spark, sf_dir, "conversations"))


def op13_packing(spark, sf_dir):
    return packing.packed(_table(spark, sf_dir, "documents"), word_tokenizer_path()).drop("n_loss")


QUERIES = {
    f.__name__: f for f in (
        op1_decontamination, op2_line_dedup, op3_toxicity, op4_minhash, op5_ann_tree, op6_chat,
        op7_token_files, op8_license_scan, op9_substring_dedup, op10_mixing,
        op11_alignment, op12_prefix_trie, op13_packing)
}

ORACLES = {
    "op1_decontamination": oracles.op1,
    "op2_line_dedup": oracles.op2(SHORT_WORDS),
    "op6_chat": oracles.op6,
    "op8_license_scan": oracles.op8,
    "op10_mixing": oracles.op10(TARGET_WEIGHTS),
    "op12_prefix_trie": oracles.op12,
}
