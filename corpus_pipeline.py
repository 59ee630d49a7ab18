"""The corpus pipeline: stages that each call one operator and hand documents on.

Every stage gets all that its predecessor kept, as a DataFrame read from Parquet, and all but the last return the columns
of documents. Documents whose language is rejected go; one document of each near-duplicate group stays; secrets are
replaced in the texts; sources are interleaved in proportion to the square roots of their sizes (all documents stay, in
the order of the mix), and each row's slot and position in the mix are written beside the documents, whose columns and
readers need not keep them; the last stage gives the SentencePiece ids of each text, whether they decode to it, and that
slot and position, found again by the row itself.

Cases: a null or empty text, and one without a letter, has no language and goes in the first stage. Null langs and sources stay null;
rows without a doc_id, and rows that share one, go on as they are, but for near copies, of which the smallest doc_id stays. Equal
rows are mixed each for itself. Very long texts are whole in every stage. An empty table gives no rows. Extra columns go along up to
the last stage, whatever their names; n_chars, where it is there, follows a text from which a secret was taken.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from comarca.files import delete
from comarca.llm import language_id, minhash_dedup, mixing, secret_ledger
from comarca.llm.common import new_path
from comarca.llm.sentencepiece_bpe import encode_documents


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language_id.fit(docs)
    return language_id.identify(docs, model, into="__language").where(~F.col("__language.rejected")).drop("__language")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash_dedup.deduplicated(docs, size=5, percent=80)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = secret_ledger.scan_documents(docs, new_path(spark, "secret_ledger"), into="__spans")
    clean = found.withColumn("text", secret_ledger.redacted(F.col("text"), F.col("__spans")))
    if "n_chars" in docs.columns:
        n = F.length("text").cast(docs.schema["n_chars"].dataType)
        clean = clean.withColumn("n_chars", F.when(F.size("__spans") > 0, n).otherwise(F.col("n_chars")))
    return clean.select(*[F.col(f"`{c}`") for c in docs.columns])


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mixing.write_positions(docs)
    return mixing.in_mix_order(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    def encoded(rows: DataFrame) -> DataFrame:
        found = encode_documents(rows.select("doc_id", "lang", "source", "text", "__a", "__b"), public_tokenizers.path("piece_bpe_32k.model"))
        same = F.col("pieces.decoded") == F.coalesce("text", F.lit(""))
        return found.select("doc_id", "lang", "source", F.size("pieces.ids").cast("long").alias("n_tokens"), F.col("pieces.ids").alias("ids"), same.alias("decodes"), "__a", "__b")

    return mixing.with_positions(docs, encoded)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", languages),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secrets),
    ("mixing", mixture),
    ("sentencepiece", pieces),
]
#: Language models, MinHash links and token ids have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, read from its written table. A stage's table is deleted as soon as the next one is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = new_path(spark, f"stage_{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            delete(spark, before)
        before = path
    return docs
