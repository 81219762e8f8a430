"""The training-data operators as registered queries over the given tables.

Each query applies its operator, with production parameters, to the whole
table and derives its digest columns from the operator's output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import compression_quality, conversation_repair, license_templates, mixing, pivot_index, quality_rules, toxicity_fm
from .common import id_crc32, table
from .packing import pack_documents
from .pii_crf import pii_spans
from .sentence_pieces import encode_documents
from .simhash import fingerprint_hex, simhash_groups
from .suffix_dedup import remove_repeats
from .word_runs import word_runs


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents")).drop("rejected_by")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), length=400)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def piece_model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op3_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def _held_out(spark: SparkSession, sf_dir: str, divisor: int, rest: int):
    """The documents and labels, and whether an id is held out of learning."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return docs, labels, F.coalesce(id_crc32() % divisor == rest, F.lit(False))


def op4_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels, held_out = _held_out(spark, sf_dir, 4, 2)
    scored = compression_quality.compression_quality(docs, labels, "quality", usable=~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op5_license_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_templates.license_scan(table(spark, sf_dir, "documents")).drop("matches")


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("source")


def op7_pivot_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_index.embedding_groups(table(spark, sf_dir, "embeddings"), threshold=0.93)


def op8_toxicity_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels, held_out = _held_out(spark, sf_dir, 3, 1)
    scored = toxicity_fm.toxicity(docs, labels, "toxic", usable=~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op9_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_spans(table(spark, sf_dir, "documents")).drop("masked")


def op10_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_groups(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return groups.select("doc_id", fingerprint_hex("fp").alias("fingerprint"), "component_id")


def run_digests(docs: DataFrame) -> DataFrame:
    """The runs of damaged documents, the greatest one and the digests."""
    found = word_runs(docs, damage=True)
    at = F.col("best") + 1
    lines = F.transform(F.arrays_zip("starts", "lengths", "periods"),
                        lambda r: F.concat(r["starts"], F.lit(","), r["lengths"], F.lit(","), r["periods"], F.lit("\n")))
    start, length, period = (F.try_element_at(c, at) for c in ("starts", "lengths", "periods"))
    return found.select("doc_id", F.size("starts").cast("long").alias("n_runs"), start.alias("start"),
                        length.alias("length"), period.alias("period"),
                        F.expr("1000 * try_element_at(lengths, best + 1) div try_element_at(periods, best + 1)").alias(
                            "exponent_milli"),
                        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
                        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op11_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(table(spark, sf_dir, "documents"))


def repair_digests(conversations: DataFrame) -> DataFrame:
    """Every conversation with the report and digest of its repair."""
    given = conversation_repair.rows_of(conversations)
    rows = conversation_repair.damage(given)
    report = conversation_repair.repair_report(rows)
    digests = conversation_repair.text_digests(conversation_repair.repaired_rows(rows, report))
    out = given.select("conv_id").distinct()
    for part in (report.withColumnRenamed("conv_id", "_id"), digests.withColumnRenamed("conv_id", "_id")):
        out = out.join(part, out["conv_id"].eqNullSafe(part["_id"]), "left").drop("_id")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return out.select("conv_id", *[F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in counts],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_digests(table(spark, sf_dir, "conversations"))


def op13_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode_documents(table(spark, sf_dir, "documents"), piece_model_path())
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                          F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and name[2].isdigit()}


def oracle_sql() -> dict[str, str]:
    return {"op1_quality_rules": quality_rules.oracle_sql(), "op5_license_templates": license_templates.oracle_sql(),
            "op6_source_mix": mixing.oracle_sql(), "op7_pivot_index": pivot_index.oracle_sql()}
