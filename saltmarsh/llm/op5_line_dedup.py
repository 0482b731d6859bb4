"""Line deduplication by an exact set-similarity join on line tokens.

A line is the set of its distinct words (lower-cased A-Z). Two lines are similar when the Jaccard
similarity of their sets is 3/4 or more. A line is removed if an earlier line, by (doc_id, line
number), is similar; whether that line was itself removed doesn't matter, so the result has no order
of work in it. Lines with a word all take part, however short.

Tokens are ordered by rarity; prefix, length, positional and suffix filters (`setjoin`) leave the pairs
whose Jaccard similarity is verified, once per pair. Lines of equal sets are one class, whose first line
stands for it; the others go at once. Of each key a class is first tried against the earliest class
that passes the filters there, and only if that doesn't remove it against all others. So a large group
of near copies costs its size, not its square, and no link is lost.

Defined results: null and empty texts have no lines that take part and come back unchanged; so do
rows without a doc_id. Rows sharing doc_id and text lose the same lines; rows sharing a doc_id but
not a text are ordered by a hash of the text. A text keeps its other lines and the breaks between
them; one that loses all lines comes back empty. Other columns pass unchanged, whatever their names,
but `n_chars` (if there) is counted anew and a column of the name given for the number of removed lines
is replaced. doc_id is a long. An empty table comes back empty. A text takes time in proportion to its
length; one text has to fit a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saltmarsh.llm import setjoin
from saltmarsh.llm.common import durable, fresh, ids_side, seen, side_of, slices, table
from saltmarsh.llm.setjoin import AT, PAIR, fitting

SPEC = setjoin.Spec(lines=True, words=1)


def _later(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """(k1, k2, doc_id, doc_key, line): the later class of each pair that is similar enough, and its first line."""
    similar = setjoin.checked(pairs, classes, docs, SPEC)
    later = F.col("at") > F.col("other")
    rows = similar.select(F.when(later, F.col("k1")).otherwise(F.col("j1")).alias("k1"), F.when(later, F.col("k2")).otherwise(F.col("j2")).alias("k2"), F.greatest("at", "other").alias("at"))
    return durable(rows.dropDuplicates(["k1", "k2"]).select("k1", "k2", "at.*"))


def _crowded(found: DataFrame, classes: DataFrame, docs: DataFrame, gone: DataFrame, more: DataFrame) -> DataFrame:
    """Classes that crowded keys or `more` pairs remove, beside those gone already."""
    fields = ("at", "k1", "k2", "n", "place", "sig")
    entries = durable(setjoin.crowd_entries(found))
    left = durable(entries.join(side_of(gone).select("k1", "k2"), ["k1", "k2"], "left_anti"))
    if not seen(left):
        return gone.union(_later(more, classes, docs))
    entries = durable(entries.join(ids_side(left.select("gram").distinct()), "gram", "left_semi"))
    entries = durable(classes.join(side_of(entries), ["k1", "k2"]))
    left = durable(entries.join(side_of(gone).select("k1", "k2"), ["k1", "k2"], "left_anti"))
    pivots = durable(entries.groupBy("gram").agg(F.min(F.struct(*fields)).alias("e"), F.min(F.struct("place", *(f for f in fields if f != "place"))).alias("c")))
    either = pivots.select("gram", F.explode(F.array_distinct(F.array(*[F.struct(*[F.col(f"{p}.{f}").alias(f) for f in fields]) for p in "ec"]))).alias("p")).select("gram", "p.*")
    # The `more` go with them: each round reads the texts.
    tried = durable(fitting(left, either, "y_at < x_at", SPEC).union(more).distinct())
    gone = durable(gone.union(_later(tried, classes, docs)))
    left = durable(left.join(side_of(gone).select("k1", "k2"), ["k1", "k2"], "left_anti"))
    rest = fitting(left, entries, "y_at < x_at", SPEC).join(side_of(tried), PAIR, "left_anti")
    return gone.union(_later(durable(rest), classes, docs))


def later_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, doc_key, line) of the lines to remove."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
    found = setjoin.join_sets(docs, SPEC)
    classes = setjoin.classes_of(found)
    tried = setjoin.earliest(found)
    gone = _later(tried, classes, docs)
    # Of two that can't be told apart in time, (k1, k2) may be the earlier one. So only the class that is gone counts.
    rest = found.where("kind in ('pair', 'more')").select(*PAIR).join(side_of(gone).select("k1", "k2"), ["k1", "k2"], "left_anti")
    more = durable(rest.join(side_of(tried), PAIR, "left_anti").distinct())
    if seen(found, "crowd"):
        gone = _crowded(found, classes, docs, gone, more)
    elif seen(more):
        gone = gone.union(_later(more, classes, docs))
    return found.where("kind = 'same'").select(*AT).union(gone.select(*AT))


def remove_lines(docs: DataFrame, lines: DataFrame, counted: str | None = "n_removed") -> DataFrame:
    """docs with the given lines cut out of their texts, n_chars (if there) counted anew, and their number as `counted`."""
    docs = docs.drop(counted) if counted else docs
    own, cut = fresh(docs.columns, "own"), fresh(docs.columns, "cut")
    lists = lines.groupBy(F.col("doc_id").alias("_doc"), F.col("doc_key").alias("_key")).agg(F.collect_set("line").alias(cut))
    keyed = docs.withColumn(own, setjoin.text_key())
    # The lists are small beside the texts: a hash of them spares sorting the texts.
    joined = keyed.join(lists.hint("shuffle_hash"), (keyed["doc_id"] == lists["_doc"]) & (keyed[own] == lists["_key"]), "left").select(*[keyed[f"`{c}`"] for c in docs.columns], lists[cut])
    names = docs.columns
    schema = T.StructType([*docs.schema.fields, *([T.StructField(counted, T.IntegerType())] if counted else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", setjoin.TEXT):
                texts, cuts = batch.column("text").to_pylist(), batch.column(cut)
                columns = dict(zip(names, batch.columns, strict=False))
                n = pa.compute.fill_null(pa.compute.list_value_length(cuts), 0).cast(pa.int32())
                changed = np.flatnonzero(n.to_numpy(zero_copy_only=False))
                for k in changed:
                    gone = set(cuts[int(k)].as_py())
                    texts[k] = "\n".join(x for i, x in enumerate(texts[k].split("\n")) if i not in gone)
                columns["text"] = pa.array(texts, pa.string())
                if "n_chars" in columns:
                    kind = columns["n_chars"].type
                    columns["n_chars"] = pa.compute.if_else(pa.compute.greater(n, 0), pa.compute.utf8_length(columns["text"]).cast(kind), columns["n_chars"])
                if counted:
                    columns[counted] = n
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return joined.mapInArrow(run, schema)


def dedup(docs: DataFrame, counted: str | None = "n_removed") -> DataFrame:
    """docs without later similar lines, and the number of those that went."""
    return remove_lines(docs, durable(later_lines(docs)), counted)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_removed", "n_chars", F.size(F.split("text", "\n", -1)).alias("n_lines"), F.sha2(F.encode("text", "utf-8"), 256).alias("text_sha256"))
