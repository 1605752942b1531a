"""The registered queries of the numbered operators: ``(spark, sf_dir) -> DataFrame``.

Each applies its operator to the whole table and derives the contract's columns.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cabline.llm import (alignment, bwt_dedup, decontam, feistel, filter_audit, hamming,
                         html_blocks, lbl, packing, quality, surrogates, tokens,
                         url_reputation, varbyte)
from cabline.llm._common import scratch, table

#: (verdict, host, path)
URL_RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"),
             ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: the key of the surrogates; a deployment passes its own secret
PII_KEY = "surrogates-1"
TOKEN_FILE_END, PACKING_END = 2, 1
#: the number that ends a url's path
PAGE_NUMBER = r"(?s)^[^?#]*/(\d{1,18})(?:\.[A-Za-z]+)?(?:[?#].*)?$"
#: fixes the shuffle of op11
SHUFFLE_KEY, SHARDS = "shuffle-1", 8
#: op8's contract; stages on five-word shingles take hamming.PERCENT
NEAR_PERCENT = 85


def op1_token_files(spark, sf_dir):
    path = scratch(spark, "token-files")
    varbyte.write_token_files(table(spark, sf_dir, "documents"), path, tokens.word_bpe_path(),
                              TOKEN_FILE_END)
    return varbyte.read_token_files(spark, path, digest=True)


def packed(docs):
    pieces = packing.pack_documents(docs, tokens.word_bpe_path(), PACKING_END)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op2_harmonic_packing(spark, sf_dir):
    return packed(table(spark, sf_dir, "documents"))


def op3_quality_rules(spark, sf_dir):
    return quality.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_html_blocks(spark, sf_dir):
    return html_blocks.extract_main_text(table(spark, sf_dir, "pages"))


def op5_lbl_scores(spark, sf_dir):
    return lbl.score_texts(table(spark, sf_dir, "documents"))


def op6_surrogates(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.replace_pii(docs, PII_KEY, count_col="n_replaced")


def op7_decontamination(spark, sf_dir):
    found = decontam.find_contamination(table(spark, sf_dir, "documents"),
                                        table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        "contaminated")


def op8_near_duplicates(spark, sf_dir):
    return hamming.near_duplicates(table(spark, sf_dir, "documents"), NEAR_PERCENT)


def op9_repeated_passages(spark, sf_dir):
    return bwt_dedup.remove_repeats(table(spark, sf_dir, "documents"), digest=True)


def page_documents(pages):
    """(page_id, doc_id): a page shows the document whose number ends its url's path.

    Nothing in the tables says so; the evidence: in sf0.1 a page's title begins in the text of
    that document for 2,460 of 2,500 pages, in the text of the document of its own id for 26."""
    number = F.regexp_extract("url", PAGE_NUMBER, 1)
    return pages.select("page_id", F.when(number != "", number).cast("long").alias("doc_id")).where(
        F.col("doc_id").isNotNull())


def op10_url_reputation(spark, sf_dir):
    # bad is low quality or toxic
    outcome = ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")
    labels = table(spark, sf_dir, "labels").select("doc_id", outcome.alias("bad"))
    pages = table(spark, sf_dir, "pages")
    labels = page_documents(pages).join(labels, "doc_id").select("page_id", "bad")
    judged = url_reputation.judge_urls(pages, labels, URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op11_feistel_shards(spark, sf_dir):
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"))
    placed = feistel.shard_rows(rows, SHARDS, SHUFFLE_KEY)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                         "slot", F.lit(None).cast("int").alias("grown_shard"))


def op12_token_alignment(spark, sf_dir):
    return alignment.align_tokenizers(table(spark, sf_dir, "documents"),
                                      tokens.byte_bpe_path(), tokens.piece_bpe_path(), digest=True)


def op13_filter_audit(spark, sf_dir):
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {f.__name__: f for f in (
    op1_token_files, op2_harmonic_packing, op3_quality_rules, op4_html_blocks, op5_lbl_scores,
    op6_surrogates, op7_decontamination, op8_near_duplicates, op9_repeated_passages,
    op10_url_reputation, op11_feistel_shards, op12_token_alignment, op13_filter_audit)}
