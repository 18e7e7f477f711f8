"""The registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickbasin.llm import (
    chat_windows,
    fingerprints,
    html_extract,
    lexical,
    nearest,
    ngram_join,
    oracles,
    packing,
    pii,
    quality_cnn,
    quality_trees,
    toxicity,
    unigram,
    vector_codes,
)
from clickbasin.llm.support import fold, labelled_sample, stored, table

# Folds and threshold of the two scoring queries.
TOXIC_FOLDS, TOXIC_HELD_OUT = 3, 1
QUALITY_FOLDS, QUALITY_HELD_OUT = 4, 2
CERTAIN = 0.7


def _scored(docs: DataFrame, score, folds: int, held_out: int) -> DataFrame:
    rows = docs.select("doc_id", score(F.col("text")).alias("score"))
    return rows.select(
        "doc_id",
        (fold(F.col("doc_id"), folds) == held_out).alias("held_out"),
        "score",
        (F.col("score") >= CERTAIN).cast("int").alias("predicted"),
    )


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; see ``toxicity``."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    sample = labelled_sample(docs, labels, "toxic", TOXIC_FOLDS, TOXIC_HELD_OUT, toxicity.SAMPLE_ROWS)
    lexicon = toxicity.learn(sample)
    return _scored(docs, lambda text: toxicity.toxicity(lexicon, text), TOXIC_FOLDS, TOXIC_HELD_OUT)


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text; see ``fingerprints``."""
    return fingerprints.with_edits(table(spark, sf_dir, "documents"))


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page; see ``html_extract``."""
    pages = table(spark, sf_dir, "pages")
    extractor = html_extract.train(pages)
    rows = pages.select("page_id", "url", html_extract.main_text(extractor, F.col("html")).alias("text"))
    return rows.withColumn("n_chars", F.length("text").cast("long"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; see ``quality_cnn``."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    sample = labelled_sample(docs, labels, "quality", QUALITY_FOLDS, QUALITY_HELD_OUT, quality_cnn.SAMPLE_ROWS)
    net = quality_cnn.train(sample)
    return _scored(docs, lambda text: quality_cnn.quality(net, text), QUALITY_FOLDS, QUALITY_HELD_OUT)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as sequences of tokens; see ``packing``."""
    docs = table(spark, sf_dir, "documents")
    return packing.packed_documents(docs, public_tokenizers.path("byte_bpe_50k.json")).drop("ids")


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of links of every document; see ``ngram_join``."""
    return ngram_join.classes(table(spark, sf_dir, "documents"))


def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest vectors of every twentieth vector; see ``nearest``."""
    return nearest.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def _conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts hold the template's own strings."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = F.lit("\\### Assistant: </turn> ok")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    return given.unionByName(
        spark.range(2).select(F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), text.alias("text"))
    )


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation in windows, read back from what was formatted; see ``chat_windows``."""
    rows = chat_windows.windows(_conversations(spark, sf_dir))
    turn = lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    new = F.expr("slice(turns, n_repeated + 1, greatest(n_turns - n_repeated, 0))")
    rows = rows.withColumn("turns", chat_windows.turns_in(F.col("formatted"))).select(
        "conv_id",
        F.struct(
            "segment",
            "window",
            F.size(new).cast("bigint").alias("n"),
            F.array_join(F.transform(new, turn), "").alias("turns"),
            F.array_join(chat_windows.loss_texts(F.col("formatted"), F.col("loss")), "").alias("loss"),
            F.length("formatted").cast("bigint").alias("chars"),
        ).alias("w"),
    )
    rows = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("w")).alias("w"))
    total = lambda name: F.aggregate("w", F.lit(0).cast("bigint"), lambda n, w: n + w[name])
    joined = lambda name: F.array_join(F.transform("w", lambda w: w[name]), "")
    return rows.select(
        "conv_id",
        total("n").alias("n_turns"),
        F.sha2(joined("turns"), 256).alias("turns_sha256"),
        F.length(joined("loss")).cast("bigint").alias("loss_chars"),
        F.sha2(joined("loss"), 256).alias("loss_sha256"),
        total("chars").alias("formatted_chars"),
        F.size("w").cast("bigint").alias("n_windows"),
    )


def op9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as pieces, and whether they decode to it again; see ``unigram``."""
    docs = table(spark, sf_dir, "documents")
    shared = spark.sparkContext.broadcast(unigram.encoder(public_tokenizers.path("piece_bpe_32k.model")))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("ids", unigram.pieces(shared, F.col("text")))
    rows = rows.withColumn("decoded", unigram.decoded(shared, F.col("ids")))
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_pieces"),
        "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.col("decoded") == F.col("text")).alias("round_trip"),
    )


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document; see ``pii``."""
    rows = pii.with_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = pii.of_kinds(F.col("spans"), pii.BASE)
    return rows.select(
        "doc_id",
        *[F.size(pii.of_kinds(F.col("spans"), (kind,))).cast("long").alias(f"n_{kind.name}") for kind in pii.BASE],
        F.sha2(pii.listed(base), 256).alias("base_sha256"),
        pii.listed(F.col("spans")).alias("spans"),
        F.array_join(F.transform("spans", lambda s: s["score"].cast("string")), ",").alias("scores"),
    )


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every document and whether it is kept; see ``quality_trees``."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    sample = labelled_sample(docs, labels, "quality", QUALITY_FOLDS, QUALITY_HELD_OUT, quality_trees.SAMPLE_ROWS)
    return quality_trees.judged(docs, quality_trees.train(sample))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of every vector; see ``vector_codes``."""
    return vector_codes.compressed(table(spark, sf_dir, "embeddings"))


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that rank highest for each benchmark item; see ``lexical``."""
    index = stored(lexical.build(table(spark, sf_dir, "documents")), "lexical-index")
    return lexical.search(index, table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_toxicity": op1_toxicity,
        "op2_packing": op2_packing,
        "op3_fingerprints": op3_fingerprints,
        "op4_html": op4_html,
        "op5_quality": op5_quality,
        "op6_ngram_join": op6_ngram_join,
        "op7_nearest": op7_nearest,
        "op8_chat": op8_chat,
        "op9_pieces": op9_pieces,
        "op10_pii": op10_pii,
        "op11_quality_rules": op11_quality_rules,
        "op12_vector_codes": op12_vector_codes,
        "op13_lexical": op13_lexical,
    }


def oracle_sql() -> dict[str, str]:
    """SQL for those that it can express; the others train, sketch, search or tokenize."""
    return {"op6_ngram_join": oracles.NGRAM_JOIN, "op8_chat": oracles.CHAT, "op12_vector_codes": oracles.VECTOR_CODES, "op13_lexical": oracles.LEXICAL}
