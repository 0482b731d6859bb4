"""The stages one after the other, each against its own input."""

import random

from pyspark.sql import functions as F

import corpus_pipeline
from saltmarsh.llm.common import durable
from tests.llm.helpers import ODD, WORD, shingles, similar, table
from tests.llm.test_sets import brute_lines


def corpus():
    r = random.Random(8)
    vocabulary = [f"{a}{b}{c}" for a in "bdfgklmn" for b in "aeiou" for c in ("ra", "to", "ne", "lis")]
    sentence = lambda k: " ".join(r.choices(vocabulary, k=k)) + "."
    clean = [(100 + i, "\n".join(sentence(30) for _ in range(4))) for i in range(40)]
    junk = [(200 + i, " ".join(f"{w}{r.choice(['###', '$$$', '***'])}" for w in r.choices(vocabulary, k=60))) for i in range(20)]
    copies = [(300 + i, clean[i][1]) for i in range(5)]
    near = [(400 + i, clean[i][1].replace(" ", " really ", 1)) for i in range(5)]
    return clean, junk, copies, near


def test_stages(spark, tmp_path):
    clean, junk, copies, near = corpus()
    rows = [*clean, *junk, *copies, *near, *ODD]
    docs = table(spark, rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in clean] + [(i, 0, 0) for i, _ in junk], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = durable(stage(spark, docs, str(tmp_path)))
        seen[name] = (before, docs)
        assert name == "packing" or docs.columns == columns
    ids = {n: {r.doc_id for r in after.collect()} for n, (_, after) in seen.items()}
    good = {i for i, _ in [*clean, *copies, *near]}
    assert good <= ids["quality_rules"] and not ids["quality_rules"] & {i for i, _ in junk}
    assert good <= ids["quality_classifier"]
    before, after = seen["line_dedup"]
    texts = {r.doc_id: r.text for r in before.collect() if r.doc_id is not None}
    want = {i: t for i, t in brute_lines(texts.items()).items() if t == texts[i] or WORD.search(t)}
    assert {r.doc_id: r.text for r in after.collect() if r.doc_id is not None and r.text is not None} == want
    assert len(want) < len(texts)
    before, after = seen["near_duplicates"]
    kept = [(r.doc_id, shingles(r.text)) for r in after.collect()]
    assert not any(similar(a, b) for i, (_, a) in enumerate(kept) for _, b in kept[:i])
    for r in before.collect():
        s = shingles(r.text)
        assert r.doc_id in ids["near_duplicates"] or any(similar(s, o) for _, o in kept)
    assert {r.doc_id for r in docs.collect()} == ids["near_duplicates"]


def test_empty_corpus(spark, tmp_path):
    table(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_equal_documents_give_one_and_names_may_clash(spark, tmp_path):
    clean, junk, _, _ = corpus()
    docs = table(spark, [*clean, *junk, (900, clean[0][1])])
    for name in ("n_words", "failures", "_score", "n_removed", "_removed", "row", "k1", "component_id", "n_shingles"):
        docs = docs.withColumn(name, F.lit(f"own {name}"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i, _ in clean] + [(i, 0, 0) for i, _ in junk], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = durable(stage(spark, docs, str(tmp_path)))
        assert docs.columns == columns, name
    rows = docs.collect()
    assert {r.doc_id for r in rows} == {i for i, _ in clean}
    assert all(r[c] == f"own {c}" for r in rows for c in ("n_words", "failures", "_score", "n_removed"))


def test_different_texts_of_one_id_stay_and_the_winner_is_the_same(spark):
    words = [f"w{i}" for i in range(60)]
    a, b, c = " ".join(words), " ".join(reversed(words)), " ".join(words[:58] + ["x", "y"])
    rows = [(1, a, "en"), (1, b, "de"), (1, a, "fr"), (2, c, "en"), (3, b, "en"), (None, a, "en"), (None, a, "en"), (4, "", "en"), (4, "", "de")]
    keys = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {tuple(sorted((r.doc_id, r.text, r.lang) for r in corpus_pipeline.near_duplicates(spark, keys.repartition(n), "").collect() if r.doc_id)) for n in (1, 3, 5)}
    assert len(got) == 1
    (kept,) = got
    assert [(i, t) for i, t, _ in kept] == sorted([(1, a), (1, b), (4, ""), (4, "")])
    assert corpus_pipeline.near_duplicates(spark, keys, "").where("doc_id is null").count() == 2


def test_stored_tables_of_a_query_can_be_cleared(spark):
    import os

    from saltmarsh.llm import common

    with common.work("a"):
        one = common.durable(spark.range(5), most=F.max("id"))
    with common.work("b"):
        two = common.durable(spark.range(0))
    assert common.seen(one) == 5 and common.seen(one, "most") == 4 and common.seen(two) == 0
    paths = [d.inputFiles()[0].removeprefix("file://").removeprefix("file:") for d in (one, two)]
    assert common.clear(spark, "a") and [os.path.exists(p) for p in paths] == [False, True]
    assert not common.clear(spark, "a")
    assert common.durable(spark.range(3)).count() == 3
