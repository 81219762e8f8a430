"""A document pipeline: toxic documents go, one document of each group of near
duplicates stays, personal data is masked, sources are mixed to target weights,
and the texts are packed into training sequences.

Each stage calls one operator of ``ledgerlens.llm``; its result is written as
Parquet and read again as the next stage's documents.  All stages but the last
keep the columns of documents.

Rows are told apart by a row number (``numbered``), never by their id.

Defined cases: rows of one id with different texts are documents of their own;
near copies go whatever their ids, null ones too; null texts stay null and count
as empty; documents without words pass the mix once; an empty table gives an
empty result; extra columns are carried along up to the mix.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import mixing, toxicity_fm
from ledgerlens.llm.common import bound_batches, id_crc32, materialize, table
from ledgerlens.llm.packing import pack_documents
from ledgerlens.llm.pii_crf import mask_documents
from ledgerlens.llm.queries import tokenizer_path
from ledgerlens.llm.simhash import simhash_groups


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine does not reject."""
    bound_batches(spark)
    usable = F.coalesce(id_crc32() % 3 != 1, F.lit(True))
    model = toxicity_fm.train(docs, table(spark, sf_dir, "labels"), "toxic", usable)
    return toxicity_fm.drop_toxic(docs, model)


FILE_ROWS = 40   # bits of a row's number for its place in its file


def numbered(docs: DataFrame) -> DataFrame:
    """The rows with a number of their own, ``_row``, that stays: of a Parquet
    table by file and place in it, so that its texts need no copy.  Rows that have
    no such place, or share one, are written down with a number."""
    spark = docs.sparkSession
    try:
        place = docs.metadataColumn("_metadata")
        per_file = (docs.select(place["file_path"].alias("_file"), place["row_index"].alias("_at")).groupBy("_file")
                    .agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("_at").alias("places")).collect())
    except AnalysisException:
        per_file = None
    if per_file is None or any(r["rows"] != r["places"] for r in per_file):
        return materialize(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    # one row a file
    files = spark.createDataFrame([(f, n << FILE_ROWS) for n, f in enumerate(sorted(r["_file"] for r in per_file))],
                                  "_file string, _first long")
    return (docs.select("*", place["file_path"].alias("_path"), place["row_index"].alias("_at"))
            .join(F.broadcast(files), F.col("_path") == F.col("_file"))
            .withColumn("_row", F.col("_first") + F.col("_at")).select(*docs.columns, "_row"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the smallest id,
    null ids last, and the first of its rows."""
    bound_batches(spark)
    rows = numbered(docs)
    groups = simhash_groups(rows, shingle=4, max_bits=4, id_col="_row")
    ids = rows.select("_row", "doc_id").withColumnsRenamed({"_row": "row", "doc_id": "id"})
    first = F.min(F.struct(F.col("id").isNull(), "id", "row"))["row"].alias("_row")
    keep = groups.join(ids, groups["doc_id"] == ids["row"]).groupBy("component_id").agg(first)
    return rows.join(keep.select("_row"), "_row", "left_semi").select(*docs.columns)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked."""
    bound_batches(spark)
    return mask_documents(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document once for each turn in which the mix takes at least half of
    its words, in the order of the schedule's slots."""
    bound_batches(spark)
    rows = numbered(docs)
    copies = mixing.copies(rows, "_row").withColumnsRenamed({n: f"_{n}" for n in ("key", "slot", "turn", "at")})
    return (rows.join(copies, F.col("_row") == F.col("_key"))
            .orderBy("_slot", "_turn", "_at", "_row").select(*docs.columns))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens with their sequences and offsets."""
    bound_batches(spark)
    return pack_documents(docs, tokenizer_path())


STAGES = [("toxicity", drop_toxic), ("simhash near-dedup", near_dedup), ("pii", mask_personal_data),
          ("source mix", mix_sources), ("packing", pack_sequences)]
ORACLE_SQL = None  # no stage but the mix has a SQL form; tested against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
