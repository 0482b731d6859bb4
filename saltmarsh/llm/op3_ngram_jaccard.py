"""N-gram Jaccard join of documents: every link between different texts, and its components.

Documents are sets of five-word shingles, joined on the rarest of them (`setjoin`): prefix, length,
positional and suffix filters leave the pairs that are verified, each once. Equal sets are one class
from the start. Of each key a class is first verified against the earliest other one that passes the
filters, and what links is one component. Then only pairs of different components that share a key are
left, and are verified too. So a group of near copies costs its size, not its square, and no link
between components is lost.

Defined results: texts that are null, empty or of white space have no shingles and are alone; so are
rows without a doc_id, whose component is null. Rows sharing a doc_id are one document: what either
links to, both do. doc_id is a long. Extra columns don't pass. An empty table gives no rows. A text takes
time in proportion to its length; one text has to fit a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from saltmarsh.llm import setjoin
from saltmarsh.llm.common import durable, ids_side, seen, side_of, slices, table
from saltmarsh.llm.components import components
from saltmarsh.llm.setjoin import PAIR, fitting

SPEC = setjoin.Spec()


def _node(at: str) -> Column:
    """The document that stands for a class: its doc_id, and the hash of its text, as doc_ids may stand for several texts."""
    return F.struct(F.col(f"{at}.doc_id").alias("doc_id"), F.col(f"{at}.doc_key").alias("doc_key"))


def _unordered(pairs: DataFrame) -> DataFrame:
    swap = F.struct("k1", "k2") > F.struct(F.col("j1").alias("k1"), F.col("j2").alias("k2"))
    return pairs.select(*[F.when(swap, F.col(b)).otherwise(F.col(a)).alias(a) for a, b in zip(PAIR, ("j1", "j2", "k1", "k2"), strict=True)]).distinct()


def _links(pairs: DataFrame, classes: DataFrame, docs: DataFrame, spec: setjoin.Spec) -> DataFrame:
    """Links (a, b) of the nodes that stand for the classes of pairs, where they are similar enough."""
    return durable(setjoin.checked(pairs, classes, docs, spec).select(_node("at").alias("a"), _node("other").alias("b")))


def _joined(place: DataFrame, links: DataFrame) -> DataFrame:
    """place (id, component) after further links, of which there are few: only components move."""
    if not seen(links):
        return place
    name = lambda c: place.select(F.col("id").alias(c), F.col("component").alias(f"{c}c"))
    named = links.join(name("a"), "a", "left").join(name("b"), "b", "left").select(F.coalesce("ac", "a").alias("a"), F.coalesce("bc", "b").alias("b"))
    moves = components(named)
    if not seen(moves):
        return place
    moved = place.join(moves.select(F.col("id").alias("component"), F.col("component").alias("to")), "component", "left").select("id", F.coalesce("to", "component").alias("component"))
    return durable(moved.union(moves.join(place, "id", "left_anti").select("id", "component")))


def _labels(place: DataFrame, classes: DataFrame) -> DataFrame:
    """(k1, k2, c): the component of each class that is linked, stored."""
    return durable(classes.join(place, _node("at") == F.col("id")).select("k1", "k2", F.col("component").alias("c")))


def _apart(pairs: DataFrame, label: DataFrame) -> DataFrame:
    """Those pairs whose classes are in different components so far."""
    side = side_of(label)
    one = pairs.join(side, ["k1", "k2"], "left").withColumnRenamed("c", "c1")
    two = one.join(side.select(F.col("k1").alias("j1"), F.col("k2").alias("j2"), F.col("c").alias("c2")), ["j1", "j2"], "left")
    return two.where("c1 is null or c2 is null or c1 <> c2").select(*PAIR)


def _crowded(found: DataFrame, classes: DataFrame, docs: DataFrame, place: DataFrame, spec: setjoin.Spec) -> DataFrame:
    """place after the links that crowded keys add."""
    whole = durable(classes.select("k1", "k2", _node("at").alias("own")).join(ids_side(setjoin.crowd_entries(found)), ["k1", "k2"]))

    def mixed(place: DataFrame) -> DataFrame:
        """Entries of keys in which several components meet, with their components."""
        named = durable(whole.join(side_of(place), F.col("own") == F.col("id"), "left").select("gram", "k1", "k2", "n", "place", "sig", F.coalesce("component", "own").alias("c")))
        grams = named.groupBy("gram").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("gram")
        return durable(named.join(ids_side(grams), "gram", "left_semi"))

    rest = mixed(place)
    if not seen(rest):
        return place
    pivots = durable(rest.groupBy("gram").agg(F.min(F.struct("place", "k1", "k2", "n", "sig", "c")).alias("p")).select("gram", "p.*"))
    tried = durable(_unordered(fitting(rest, pivots, "x_c <> y_c", spec)))
    links = _links(tried, classes, docs, spec)
    if seen(links):
        place = _joined(place, links)
        rest = mixed(place)
    left = durable(_unordered(fitting(rest, rest, "x_c < y_c", spec)).join(side_of(tried), PAIR, "left_anti"))
    return _joined(place, _links(left, classes, docs, spec))


def _alone(docs: DataFrame, spec: setjoin.Spec) -> DataFrame:
    """Rows without a doc_id: their number of shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rare = np.zeros(setjoin.BUCKETS, dtype=np.uint8)
        for whole in batches:
            for batch in slices(whole, "text"):
                sets = setjoin.sets_of(batch.column("text"), spec, rare)
                n = np.zeros(batch.num_rows, dtype=np.int64)
                n[sets.row] = sets.n
                yield pa.RecordBatch.from_arrays([pa.array(n)], names=["n_shingles"])

    return docs.where("doc_id is null").select("text").mapInArrow(run, "n_shingles long")


def _same_document(found: DataFrame, classes: DataFrame) -> DataFrame | None:
    """Links of the classes of rows that share a doc_id but not a text."""
    members = found.where("kind in ('first', 'same') and n > 0").select("doc_id", "k1", "k2")
    several = durable(members.groupBy("doc_id").agg(F.min("k1").alias("lo"), F.max("k1").alias("hi")).where("lo <> hi").select("doc_id"))
    if not seen(several):
        return None
    of_doc = members.join(side_of(several), "doc_id").join(classes, ["k1", "k2"]).select("doc_id", _node("at").alias("b"))
    least = of_doc.groupBy("doc_id").agg(F.min("b").alias("a"))
    return of_doc.join(least, "doc_id").select("a", "b")


def linked_texts(docs: DataFrame, spec: setjoin.Spec = SPEC, one_document: bool = False) -> DataFrame:
    """doc_id, doc_key (hash of the text), n_shingles and `least`, the smallest (doc_id, doc_key) reachable by links, of each row with a doc_id.

    one_document: rows that share a doc_id are one document, whatever their texts. docs: doc_id long, text; no null doc_id.
    """
    found = setjoin.join_sets(docs, spec)
    classes = setjoin.classes_of(found)
    tried = setjoin.earliest(found)
    links = _links(tried, classes, docs, spec)
    twice = _same_document(found, classes) if one_document else None
    place = components(links if twice is None else links.union(twice))
    rest = found.where("kind in ('pair', 'more')").select(*PAIR).join(side_of(tried), PAIR, "left_anti")
    more = durable(_unordered(_apart(rest, _labels(place, classes))))
    if seen(more):
        place = _joined(place, _links(more, classes, docs, spec))
    if seen(found, "crowd"):
        place = _crowded(found, classes, docs, place, spec)

    own = F.struct("doc_id", "doc_key")
    side = side_of(place)
    first = found.where("kind = 'first'").select("n", own.alias("own")).join(side, F.col("own") == F.col("id"), "left").select("own", "n", F.coalesce("component", "own").alias("least"))
    same = found.where("kind = 'same' and n > 0").select("n", own.alias("own"), "k1", "k2")
    label = same.select("k1", "k2").distinct().join(classes, ["k1", "k2"]).join(side, _node("at") == F.col("id"), "left").select("k1", "k2", F.coalesce("component", _node("at")).alias("least"))
    same = same.join(ids_side(label), ["k1", "k2"]).select("own", "n", "least")
    wordless = found.where("kind = 'same' and n = 0").select(own.alias("own"), "n", own.alias("least"))
    return first.union(same).union(wordless).select("own.*", F.col("n").cast("long").alias("n_shingles"), "least")


def link_components(docs: DataFrame, spec: setjoin.Spec = SPEC) -> DataFrame:
    """doc_id, n_shingles, component_id: one row per row of docs."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = linked_texts(docs.where("doc_id is not null"), spec, one_document=True).select("doc_id", "n_shingles", F.col("least.doc_id").alias("component_id"))
    nobody = F.lit(None).cast("long")
    return out.union(_alone(docs, spec).select(nobody.alias("doc_id"), "n_shingles", nobody.alias("component_id")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_components(table(spark, sf_dir, "documents"))
