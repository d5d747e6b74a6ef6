"""From raw documents to encoded training text: language, copies, near copies, mix of sources, sampled segmentations."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.llm.exact_dedup import drop_exact
from lodestrata.llm.language_id import UNKNOWN, language, profiles
from lodestrata.llm.minhash_dedup import drop_near
from lodestrata.llm.mixing import take
from lodestrata.llm.segmentations import encode_samples
from lodestrata.llm.shared import documents, stored

#: A text whose n-grams agree less than this with every learned language is rejected, as is one without a letter.
LANGUAGE_AT_LEAST = 0.1
TOKENIZER = "piece_bpe_32k.model"
SAMPLES = 2


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the documents declare; profiles come from all of them.

    Null and empty texts, and those without a letter, go; very long texts are read whole; repeated rows stay or go together. Where no
    document declares a language all go. An empty table gives an empty one, further columns of any names are kept.
    """
    learned = stored(profiles(docs), "profiles")
    found = docs.withColumn("__found", language(learned))
    return found.where((F.col("__found.lang_pred") != UNKNOWN) & (F.col("__found.score") >= LANGUAGE_AT_LEAST)).select(*docs.columns)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal text but for white space, the one with the smallest id; one row of it, if rows repeat.

    A null id stays only where no other has its text. Empty tables and further columns as above.
    """
    return drop_exact(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by 80 % of their five-word shingles, the one with the smallest id.

    Documents with a null id, or without words, stay. Empty tables and further columns as above.
    """
    return drop_near(docs, size=5, percent=80)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix of sources takes them; null sources are one source.

    Texts without words weigh nothing. Repeated rows count each. Empty tables and further columns as above.
    """
    return take(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations of every document as token ids; a document taken twice comes twice.

    An empty text has one segmentation, without tokens; an empty table gives no rows; further columns are not read.
    """
    return encode_samples(docs, public_tokenizers.path(TOKENIZER), k=SAMPLES)


STAGES = [
    ("language ID", known_language),
    ("exact dedup", without_copies),
    ("MinHash near-dedup", without_near_copies),
    ("mixing sources", mixed),
    ("SentencePiece sampling", encoded),
]

#: SQL expresses neither the language profiles nor the sampled segmentations; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.split()[0].lower())
    return docs
