"""The registered queries of this subpackage: name -> (query, SQL or None)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from chunkgate.llm import chat, codes, counts, mixing, neardup_texts, neardup_vectors, packing, quality, substrings, toxicity, value_codes, warc, whitening
from chunkgate.session import scratch_dir
from chunkgate.sources.tables import stored

WORD_VOCABULARY, WORD_END = "word_bpe_49k.json", 2
BYTE_VOCABULARY, BYTE_END = "byte_bpe_50k.json", 1

#: Branches of a reply tree that become conversations.
BRANCHES = 4


def table(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_substring_dedup(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "text")
    return substrings.remove_repeats(documents, with_text=False)


def op2_token_codes(spark, sf):
    files = codes.write_files(table(spark, sf, "documents"), scratch_dir(spark, "codes"), public_tokenizers.path(WORD_VOCABULARY), WORD_END)
    return codes.read_documents(files).select("doc_id", "start", "n_tokens", "ids_crc32")


def op3_mixing(spark, sf):
    return mixing.taken_words(mixing.mix(table(spark, sf, "documents")))


def op4_packing(spark, sf):
    return packing.pack(table(spark, sf, "documents"), public_tokenizers.path(BYTE_VOCABULARY), BYTE_END)


def op5_vector_dedup(spark, sf):
    return neardup_vectors.link_vectors(table(spark, sf, "embeddings"))


def op6_quality(spark, sf):
    documents = table(spark, sf, "documents")
    return quality.judge_quality(documents, quality.fit_quality(documents, table(spark, sf, "labels")), columns=["doc_id"])


def op7_chat(spark, sf):
    planted = spark.createDataFrame([(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    replies = chat.linear_replies(turns.unionByName(planted))
    chosen = chat.best_paths(chat.root_paths(replies), replies, keep=BRANCHES)
    return chat.digests(chat.format_paths(chosen)).withColumnRenamed("tree", "conv_id")


def op8_edited_counts(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "text")
    vocabulary = public_tokenizers.path(BYTE_VOCABULARY)
    trees = stored(counts.build_trees(documents, vocabulary), "count-trees")
    size = F.length("text")
    # Three edits for each document, made from it: a swap near its start, words put in, a piece taken out.
    edits = documents.where("text is not null").select(
        counts.row_key().alias("key"),
        F.explode(F.array(*[
            F.struct(F.lit(k).alias("seq"), at.cast("long").alias("pos"), F.lit(gone).cast("long").alias("removed"), put.alias("inserted"))
            for k, at, gone, put in (
                (1, F.floor(size / 7), 3, F.reverse(F.expr("substring(text, cast(floor(length(text) / 7) as int) + 1, 3)"))),
                (2, F.floor(size / 2), 0, F.concat(F.lit(" "), F.substring("text", 1, 24), F.lit(" 42 "))),
                (3, F.floor(size * 4 / 5), 17, F.lit("")),
            )
        ])).alias("e"),
    ).select("key", "e.*")
    edited = counts.apply_edits(documents, trees, edits, vocabulary)
    return edited.select("doc_id", "n_tokens_before", "n_tokens", "n_chars", "n_reencoded")


def op9_near_duplicates(spark, sf):
    return neardup_texts.near_duplicates(table(spark, sf, "documents"))


def op10_toxicity(spark, sf):
    documents = table(spark, sf, "documents")
    return toxicity.score_toxicity(documents, toxicity.fit_toxicity(documents, table(spark, sf, "labels")))


def op11_whitening(spark, sf):
    return whitening.whiten(table(spark, sf, "embeddings")).withColumn("deviation", F.expr("try_cast(deviation as bigint)"))


def op12_value_codes(spark, sf):
    coded, book = value_codes.compress(table(spark, sf, "embeddings"))
    return value_codes.with_label_error(coded).select("vec_id", "code", "error", "label_error", F.lit(value_codes.codebooks_digest(book)).alias("codebooks_sha256"))


def op13_warc(spark, sf):
    pages = table(spark, sf, "pages")
    archives, path = warc.write_archives(pages, scratch_dir(spark, "warc")), scratch_dir(spark, "warc-index")
    warc.write_index(archives, path)
    places = warc.look_up(warc.open_index(spark, path), pages.select(warc.capture_key("url").alias("key")))
    return warc.read_records(archives, places, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


QUERIES = {
    "op1_substring_dedup": (op1_substring_dedup, None),
    "op2_token_codes": (op2_token_codes, None),
    "op3_mixing": (op3_mixing, None),
    "op4_packing": (op4_packing, None),
    "op5_vector_dedup": (op5_vector_dedup, None),
    "op6_quality": (op6_quality, None),
    "op7_chat": (op7_chat, None),
    "op8_edited_counts": (op8_edited_counts, None),
    "op9_near_duplicates": (op9_near_duplicates, None),
    "op10_toxicity": (op10_toxicity, None),
    "op11_whitening": (op11_whitening, None),
    "op12_value_codes": (op12_value_codes, None),
    "op13_warc": (op13_warc, None),
}
