"""Filter interaction audit: what each filter removes in every order in which the filters may be applied.

Five filters judge every text. A text's failures are a mask of bits, and only counts by mask are left
of the corpus: at most 32 rows a part. Orders of the filters are permutations, ranked as they stand in
a dictionary (Lehmer rank, 0 to 119). A mask is removed at the step at which the first of its filters
comes up, so each beginning of an order that ends in its first failing filter stands for one run of
neighbouring ranks. The mask's count is added where that run begins and taken off behind its end; the
running sum over the ranks then is what is removed at that step in every order.

The filters (`measured`, `judged`), on words that are maximal runs of characters other than space and
0x09-0x0D, case-sensitive:

    A  fewer than 100 words
    B  100 * distinct words < 80 * words
    C  100 * characters A-Z > 10 * code points
    D  holds one of # $ % & * |
    E  equal to the text of a smaller doc_id, in the whole table

Equal texts are found by SHA-256. A task counts what it has of a text before anything is shuffled, so a
text that is a third of the corpus arrives once a task.

Defined results: a null text is empty (A fails alone, and E if a smaller doc_id has an empty text). A null
part is the empty string. Rows without a doc_id never fail E, have no label and make nobody else fail E.
Rows that repeat a doc_id are judged one by one; equal doc_ids aren't smaller. Of several labels of a
doc_id any counts. Extra columns are ignored. An empty table gives no rows. Each part has all of
the orders and steps, zeros included.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from saltmarsh.llm.common import table

FILTERS = "ABCDE"
COUNTS = ("n", "good", "toxic")


def words(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def measured(docs: DataFrame, part: str = "lang", text: str = "text") -> DataFrame:
    """doc_id, part, mask of the filters A to D, digest of the text."""
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.coalesce(text, F.lit("")).alias("_text"))
    cut = whole.withColumn("_words", words(F.col("_text")))
    n, distinct = F.size("_words"), F.size(F.array_distinct("_words"))
    upper = F.length(F.regexp_replace("_text", "[^A-Z]+", ""))
    failed = [n < 100, 100 * distinct < 80 * n, 100 * upper > 10 * F.length("_text"), F.col("_text").rlike("[#$%&*|]")]
    mask = sum((F.when(c, F.lit(1 << k)).otherwise(F.lit(0)) for k, c in enumerate(failed)), F.lit(0))
    return cut.select("doc_id", "part", mask.cast("int").alias("mask"), F.unhex(F.sha2(F.encode("_text", "utf-8"), 256)).alias("digest"))


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """rows counted by doc_id, part and text: n, and how many of them are good and toxic."""
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max((F.coalesce("quality", F.lit(0)) == 1).cast("long")).alias("good"), F.max((F.coalesce("toxic", F.lit(0)) == 1).cast("long")).alias("toxic"))
    counted = rows.groupBy("doc_id", "part", "mask", "digest").agg(F.count(F.lit(1)).alias("n"))
    with_id = counted.where("doc_id is not null").join(marks, "doc_id", "left")
    return with_id.select("doc_id", "part", "mask", "digest", "n", *[(F.col("n") * F.coalesce(c, F.lit(0))).alias(c) for c in ("good", "toxic")])


def judged(docs: DataFrame, labels: DataFrame, part: str = "lang", text: str = "text") -> DataFrame:
    """part, mask of all five filters, and the counts of documents, good and toxic ones: at most 32 rows a part."""
    rows = measured(docs, part, text)
    # Of the rows of a text those of its smallest doc_id pass E: `lead` has their counts. Equal texts have equal masks.
    lead = F.struct("doc_id", *COUNTS)
    texts = labelled(rows, labels).groupBy("digest", "part").agg(F.first("mask").alias("mask"), *[F.sum(c).alias(c) for c in COUNTS], F.min(lead).alias("lead"))
    first = F.col("lead.doc_id") == F.min("lead.doc_id").over(Window.partitionBy("digest"))
    passed = [F.when(F.col("first"), F.col(f"lead.{c}")).otherwise(F.lit(0)) for c in COUNTS]
    later = F.col("mask").bitwiseOR(F.lit(1 << FILTERS.index("E")))
    both = F.array(
        F.struct(F.col("mask").alias("mask"), *[p.alias(c) for p, c in zip(passed, COUNTS, strict=True)]),
        F.struct(later.alias("mask"), *[(F.col(c) - p).alias(c) for p, c in zip(passed, COUNTS, strict=True)]),
    )
    split = texts.withColumn("first", first).select("part", F.explode(both).alias("x")).select("part", "x.*")
    nobody = rows.where("doc_id is null").select("part", "mask", F.lit(1).cast("long").alias("n"), *[F.lit(0).cast("long").alias(c) for c in ("good", "toxic")])
    return split.where("n > 0").unionByName(nobody).groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in COUNTS])


def orders(filters: str = FILTERS) -> list[str]:
    """All orders; each one's place is its Lehmer rank."""
    return ["".join(p) for p in permutations(filters)]


def runs(filters: str = FILTERS) -> list[tuple[int, int, int, int]]:
    """(mask, step, first rank, rank behind the last): the orders in which a mask is removed at a step, as intervals.

    There is one for each beginning whose last filter is the mask's first: 840 of five filters.
    """
    out, all_orders = [], orders(filters)
    for step in range(1, len(filters) + 1):
        beginnings = sorted({o[:step] for o in all_orders})
        width = len(all_orders) // len(beginnings)
        for at, start in enumerate(beginnings):
            *passed, last = (1 << filters.index(f) for f in start)
            masks = (m for m in range(1, 1 << len(filters)) if m & last and not m & sum(passed))
            out += [(m, step, at * width, (at + 1) * width) for m in masks]
    return out


def audit(masks: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order and step from counts by part and mask (`judged`)."""
    spark, of = masks.sparkSession, {c: f"{c}_" for c in COUNTS}
    ranks, steps = len(orders(filters)), len(filters)
    # 1,680 ends of intervals, a number that only the number of filters sets.
    ends = spark.createDataFrame([(m, s, at, sign) for m, s, a, z in runs(filters) for at, sign in ((a, 1), (z, -1))], "mask int, step int, rank int, sign int")
    changes = masks.join(F.broadcast(ends), "mask").where(F.col("rank") < ranks).groupBy("part", "step", "rank").agg(*[F.sum(F.col(c) * F.col("sign")).alias(c) for c in COUNTS])
    totals = masks.groupBy("part").agg(
        F.sum("n").alias("total"),
        F.array(*[F.sum(F.when(F.col("mask").bitwiseAND(F.lit(1 << k)) != 0, F.col("n")).otherwise(0)) for k in range(steps)]).alias("fails"),
        F.array(*[F.sum(F.when(F.col("mask") == 1 << k, F.col("n")).otherwise(0)) for k in range(steps)]).alias("alone"),
    )
    spine = totals.select("part", "total", "fails", "alone", F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("step")).withColumn("rank", F.explode(F.sequence(F.lit(0), F.lit(ranks - 1))))
    along = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    removed = spine.join(changes, ["part", "step", "rank"], "left").select("part", "total", "fails", "alone", "step", "rank", *[F.sum(F.coalesce(c, F.lit(0))).over(along).alias(of[c]) for c in COUNTS])
    order = F.element_at(F.array(*[F.lit(o) for o in orders(filters)]), F.col("rank") + 1)
    named = removed.withColumn("filter_order", order).withColumn("filter", F.expr("substring(filter_order, step, 1)"))
    own = lambda c: F.element_at(c, F.instr(F.lit(filters), F.col("filter")))
    upto = Window.partitionBy("part", "rank").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    return named.select(
        "part", "filter_order", F.col("step").cast("int").alias("step"), (F.col("total") - F.sum(of["n"]).over(upto)).alias("kept"), F.col(of["n"]).alias("removed"),
        (own("fails") - F.col(of["n"])).alias("redundant"), own("alone").alias("unique_fails"), F.col(of["good"]).alias("good_lost"), F.col(of["toxic"]).alias("toxic_lost"),
        F.sum(of["n"]).over(Window.partitionBy("part", "filter")).alias("shapley"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


#: By simulation: each mask is taken through each order.
ORACLE = r"""
WITH docs AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
measured AS (SELECT doc_id, part, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM docs),
firsts AS (SELECT t, min(doc_id) AS least FROM docs GROUP BY t),
marks AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
judged AS (
  SELECT part, coalesce(good, FALSE) AS good, coalesce(toxic, FALSE) AS toxic,
    concat(CASE WHEN len(w) < 100 THEN 'A' ELSE '' END, CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END,
      CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' ELSE '' END,
      CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END, CASE WHEN m.doc_id > least THEN 'E' ELSE '' END) AS failed
  FROM measured m JOIN firsts USING (t) LEFT JOIN marks USING (doc_id)),
counts AS (SELECT part, failed, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM judged GROUP BY ALL),
letters(f) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (SELECT concat(a.f, b.f, c.f, d.f, e.f) AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps AS (SELECT filter_order, CAST(s AS INT) AS step, substr(filter_order, CAST(s AS INT), 1) AS f, substr(filter_order, 1, CAST(s AS INT) - 1) AS before FROM orders, range(1, 6) r(s)),
hits AS (
  SELECT part, filter_order, step, f, n, good, toxic, contains(failed, f) AS fails, failed = f AS alone,
    len(list_filter(string_split(before, ''), lambda x: x <> '' AND contains(failed, x))) > 0 AS gone FROM counts, steps),
rows AS (
  SELECT part, filter_order, step, f, CAST(coalesce(sum(n) FILTER (NOT gone AND NOT fails), 0) AS BIGINT) AS kept, CAST(coalesce(sum(n) FILTER (fails AND NOT gone), 0) AS BIGINT) AS removed,
    CAST(coalesce(sum(n) FILTER (fails AND gone), 0) AS BIGINT) AS redundant, CAST(coalesce(sum(n) FILTER (alone), 0) AS BIGINT) AS unique_fails,
    CAST(coalesce(sum(good) FILTER (fails AND NOT gone), 0) AS BIGINT) AS good_lost, CAST(coalesce(sum(toxic) FILTER (fails AND NOT gone), 0) AS BIGINT) AS toxic_lost
  FROM hits GROUP BY part, filter_order, step, f)
SELECT * EXCLUDE (f), CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley FROM rows
"""
