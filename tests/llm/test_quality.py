"""The rule ledger against SQL and the classifier on held-out rows."""

import os

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from saltmarsh.llm import op7_quality_classifier as op7
from saltmarsh.llm import op10_quality_ledger as op10
from saltmarsh.llm.queries import oracle_sql, queries
from tests.llm.helpers import ODD, table

DATA = "/root/testdata/sf0.01"
data = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def ledger_by_sql(frame):
    c = duckdb.connect()
    c.register("documents", frame)
    return c.sql(op10.ORACLE).fetchall()


def test_ledger_of_odd_rows(spark):
    odd = [*ODD, (20, "a b c d e f a b c d e"), (21, "x # * $ % & | < > y"), (22, "AB CD ef GH IJ KL mn OP QR ST UV\n\nAB CD\nAB CD\n \n \n"), (23, "q\n" * 30)]
    docs = table(spark, odd).withColumn("n_words", F.lit("clash")).withColumn("failures", F.lit("clash"))
    got = op10.digest(docs)
    want = ledger_by_sql(pd.DataFrame(odd, columns=["doc_id", "text"]).astype({"doc_id": "Int64"}))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert op10.digest(table(spark, [])).count() == 0


def test_ablations_add_up(spark):
    rows = op10.ledger(op10.measure(table(spark, ODD)))
    flags = [r.failures for r in rows.collect()]
    for version, bits in op10.POLICIES.items():
        m = op10.mask(bits)
        got = {r.rule: (r.failing, r.only_this) for r in op10.ablations(rows, version).collect()}
        assert got == {x.name: (sum(bool(f >> x.bit & 1) for f in flags), sum(f & m == 1 << x.bit for f in flags)) for x in op10.RULES if x.bit in bits}
        assert rows.where(op10.rejected(version)).count() == sum(bool(f & m) for f in flags)


@data
@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_queries_match_their_sql(spark, name):
    c = duckdb.connect()
    for t in ("documents", "pages", "labels"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    df = queries()[name](spark, DATA)
    want = c.sql(oracle_sql()[name])
    order = [want.columns.index(x) for x in df.columns]
    assert sorted(map(tuple, df.collect()), key=repr) == sorted((tuple(r[k] for k in order) for r in want.fetchall()), key=repr)


@data
def test_classifier_on_held_out_rows(spark):
    got = queries()["op7_quality_classifier"](spark, DATA).toPandas()
    labels = pd.read_parquet(f"{DATA}/labels.parquet").merge(got, on="doc_id")
    held = labels[labels.held_out]
    assert len(held) > 50 and (held.predicted == held.quality).mean() > 0.98
    assert got.score.between(0, 1).all() and len(got) == 1000


def test_classifier_of_odd_rows(spark):
    docs = table(spark, ODD)
    labels = spark.createDataFrame([(4, 1), (7, None), (9, 3), (None, 1)], "doc_id long, quality int")
    vectors = op7.word_vectors(docs)
    net = op7.train(docs, labels, vectors)
    out = op7.score(docs.withColumn("score", F.lit("clash")), vectors, net).collect()
    assert len(out) == len(ODD) and all(0 <= r.score <= 1 for r in out)
    assert len({r.score for r in out if r.doc_id == 6}) == 1
    empty = table(spark, [])
    nothing = op7.word_vectors(empty)
    assert not nothing.any() and op7.score(empty, nothing, op7.train(empty, labels, nothing)).count() == 0


def test_word_vectors_by_hand(spark):
    vectors = op7.word_vectors(spark.createDataFrame([("a b",), ("a",)], "text string"))
    import pyarrow as pa

    (a, b), index = op7.tokens(pa.array(["a b"]))[0], op7.index_vectors().astype(float)
    want = index[a] * 4 + index[b]
    assert np.allclose(vectors[a], want / np.linalg.norm(want), atol=1e-6)


def test_temperature_and_gradient():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, op7.FEATURES))
    y = (x[:, 0] + x[:, 1] * x[:, 2] > 0).astype(int)
    net = op7.fit(x, y)
    assert ((net.score(x) > 0.5) == y).mean() > 0.9
    logit = rng.normal(size=5000) * 2
    assert abs(op7.temperature(logit * 3, (rng.random(5000) < 1 / (1 + np.exp(-logit))).astype(int)) - 3) < 0.4


def test_repeats_of_a_labelled_id_do_not_reach_the_driver(spark):
    rows = [(k, f"good words number {k}" if k % 2 else f"bad junk {k} junk") for k in range(1, 30)]
    labels = spark.createDataFrame([(k, k % 2) for k, _ in rows], "doc_id long, quality int")
    docs = table(spark, rows)
    vectors = op7.word_vectors(docs)
    plain = op7.train(docs, labels, vectors)
    again = op7.train(docs.union(docs).union(docs.where("doc_id = 3")), labels, vectors)
    x = op7.score(docs, vectors, plain).orderBy("doc_id").collect()
    y = op7.score(docs, vectors, again).orderBy("doc_id").collect()
    assert [r.score for r in x] == [r.score for r in y]
