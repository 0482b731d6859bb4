"""From raw documents to packed training sequences, in five stages.

Each stage takes what the one before kept, as a table with the columns of `documents`; the last one
returns pieces of packed sequences. Training data and corpus statistics of the classifier come from
the raw tables, so that it has seen the documents that earlier stages reject.

Nulls, repeats and empty tables are handled as each operator's module says. A document all of whose
lines stand in earlier ones goes with its last word; texts that had none from the start stay. Of a group of near duplicates that of the smallest (doc_id, hash of the text) stays, once,
even if the table repeats it; different texts that share a doc_id are different documents; documents
without words or without a doc_id all stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saltmarsh.llm import (
    op3_ngram_jaccard,
    op5_line_dedup,
    op7_quality_classifier,
    op9_packing,
    op10_quality_ledger,
)
from saltmarsh.llm.common import durable, fresh, ids_side, seen, side_of, table, work
from saltmarsh.llm.setjoin import text_key

#: The policy of the quality rules that is applied.
POLICY = op10_quality_ledger.IN_FORCE


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail no rule of the policy."""
    # What else a row has is kept in one column, so that no name of theirs meets one of the ledger's; the text passes once.
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(F.lit(0).alias("text"), *others).alias("row"), "text")
    measured = op10_quality_ledger.measure(rows, keep=("row",), text_as="kept_text")
    kept = op10_quality_ledger.ledger(measured).where(~op10_quality_ledger.rejected(POLICY))
    return kept.select([F.col("kept_text").alias("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score of at least the operator's threshold."""
    raw = table(spark, sf_dir, "documents")
    vectors = op7_quality_classifier.word_vectors(raw)
    net = op7_quality_classifier.train(raw, table(spark, sf_dir, "labels"), vectors)
    name = fresh(docs.columns, "_score")
    scored = op7_quality_classifier.score(docs, vectors, net, name=name)
    return scored.where(F.col(name) >= op7_quality_classifier.THRESHOLD).drop(name)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier line repeats; those of which no word is left go."""
    name = fresh(docs.columns, "_removed")
    cut = op5_line_dedup.dedup(docs, counted=name)
    return cut.where((F.col(name) == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]")).drop(name)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that of the smallest (doc_id, hash of text)."""
    rows = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    linked = durable(op3_ngram_jaccard.linked_texts(rows).where("n_shingles > 0"))
    own = F.struct("doc_id", "doc_key")
    later = linked.where(own != F.col("least")).select("doc_id", "doc_key").distinct()
    twice = linked.where(own == F.col("least")).groupBy("doc_id", "doc_key").count().where("count > 1").select("doc_id", "doc_key")
    number, key = fresh(docs.columns, "_number"), fresh(docs.columns, "_key")
    keyed = docs.withColumn(number, F.col("doc_id").cast("long")).withColumn(key, text_key())
    on = lambda ids: (F.col(f"`{number}`") == ids["doc_id"]) & (F.col(f"`{key}`") == ids["doc_key"])
    late, repeated = ids_side(later), durable(twice)
    kept = keyed.join(late, on(late), "left_anti")
    if seen(repeated):
        # Rows equal in doc_id and text: the one whose columns have the smallest hash.
        again = side_of(repeated)
        hashed = [F.col(f"`{f.name}`") for f in docs.schema.fields if not isinstance(f.dataType, T.MapType | T.VariantType)]
        whole = F.struct(*[F.col(f"`{c}`") for c in keyed.columns])
        once = kept.join(again, on(again), "left_semi").groupBy(number, key).agg(F.min_by(whole, F.xxhash64(*hashed)).alias("r")).select("r.*")
        kept = kept.join(again, on(again), "left_anti").unionByName(once)
    return kept.drop(number, key)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 tokens."""
    return op9_packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("packing", packing),
]

#: The network and the tokeniser can't be put in SQL; tests/llm holds the stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what they store is in the folder `pipeline`, which `common.clear` removes."""
    with work("pipeline"):
        docs = table(spark, sf_dir, "documents")
        for n, (_, stage) in enumerate(STAGES):
            docs = stage(spark, docs, sf_dir)
            if n < len(STAGES) - 1:
                docs = durable(docs)
        return docs
