"""Registered queries of the subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.llm import alignment, imatch, jpeg, licenses, linedup, minhash, mixing, packing, quality, suffixdup, toxicity, warc, whitening

TOKENIZER = "word_bpe_49k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    """A vocabulary file; its place is a parameter of the operators."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_mixing_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.rates(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    found = warc.captures(pages, warc.build(pages), payloads=False)
    # a response's digest is that of the bytes read back
    return found.select("page_id", "payload_bytes", F.coalesce("read_digest", "payload_digest").alias("payload_digest"), "record_type", "refers_to")


def op3_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op4_media_jpeg(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = jpeg.features(jpeg.media_column(_table(spark, sf_dir, "documents")))
    feature = F.format_string("%dx%d:%s:%s", "width", "height", "average_hash", "difference_hash")
    return got.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", feature.alias("feature"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    docs = docs.withColumn("n_lines", F.size(F.split(F.coalesce("text", F.lit("")), "\n")).cast("long"))
    kept = linedup.drop_boilerplate(docs, count_col="n_dropped")
    return kept.select("doc_id", "n_lines", F.col("n_dropped").cast("long").alias("n_dropped"), F.md5(F.coalesce("text", F.lit(""))).alias("kept_md5"))


def op6_toxicity_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.edited_fingerprints(_table(spark, sf_dir, "documents"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return licenses.scan(docs, licenses.train(docs))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), tokenizer_path())


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixdup.remove_repeats(_table(spark, sf_dir, "documents")).drop("kept")


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def op13_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


QUERIES = {f.__name__: f for f in (op1_mixing_rates, op2_warc_index, op3_minhash_neardup, op4_media_jpeg, op5_line_dedup, op6_toxicity_mil, op7_imatch, op8_license_scan, op9_best_fit_packing, op10_suffix_dedup, op11_token_alignment, op12_embedding_whitening, op13_compression_quality)}
ORACLES: dict[str, str] = {"op2_warc_index": warc.ORACLE_SQL, "op5_line_dedup": linedup.ORACLE_SQL}
