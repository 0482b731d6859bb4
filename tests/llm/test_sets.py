"""Shingle sets, the n-gram Jaccard join and the line deduplication against brute force."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from saltmarsh.llm import op3_ngram_jaccard as op3
from saltmarsh.llm import op5_line_dedup as op5
from saltmarsh.llm import setjoin
from saltmarsh.llm import textarrays as ta
from saltmarsh.llm.components import components
from tests.llm.helpers import ODD, WORD, lower, shingles, similar, table

texts = st.lists(st.one_of(st.none(), st.text(alphabet="aB cé\n\t\u00a0\x0b中", max_size=60)), max_size=8)


@settings(max_examples=60, deadline=None)
@given(texts)
def test_words_and_sets(values):
    column = pa.array(values, pa.string())
    w = ta.words(column, lower=True)
    want = [(i, x.encode()) for i, t in enumerate(values) for x in WORD.findall(lower(t))]
    got = [(int(r), lower(w.raw[s:e].tobytes().decode()).encode()) for r, s, e in zip(w.row, w.start, w.end, strict=True)]
    assert got == want
    assert len(set(w.hash.tolist())) == len({x for _, x in want})
    owner, _ = ta.shingle_sets(w.hash, w.row, 5)
    assert np.bincount(owner, minlength=len(values)).tolist() == [len(shingles(t)) for t in values]


def test_grouped_order_is_lexsort():
    rng = np.random.default_rng(1)
    for spread in (2**63, 2**30, 4):
        for _ in range(50):
            n = int(rng.integers(0, 60))
            group = np.sort(rng.integers(5, 12, n))
            value = rng.integers(0, spread, n, dtype=np.int64).astype(np.uint64)
            rank = rng.integers(0, 3, n).astype(np.uint8)
            for r, keys in ((None, (value, group)), (rank, (value, rank, group))):
                want, got = np.lexsort(keys), ta.grouped_order(group, value, r)
                assert all((k[want] == k[got]).all() for k in keys)


def near_corpus(n=160, seed=4):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    docs = []
    for i in range(n):
        if docs and r.random() < 0.5:
            w = r.choice(docs)[1].split(" ")
            for _ in range(r.randrange(6)):
                w[r.randrange(len(w))] = r.choice(vocabulary)
            docs.append((i, " ".join(w)))
        else:
            docs.append((i, " ".join(r.choices(vocabulary, k=r.choice([3, 6, 40, 90, 200])))))
    return docs


def brute_components(rows):
    ids = [i for i, _ in rows]
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    sets = [shingles(t) for _, t in rows]
    for a in range(len(rows)):
        for b in range(a):
            if similar(sets[a], sets[b]):
                x, y = find(ids[a]), find(ids[b])
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}, {i: len(s) for i, s in zip(ids, sets, strict=True)}


def test_join_against_brute_force(spark):
    rows = near_corpus()
    where, size = brute_components(rows)
    got = op3.link_components(table(spark, rows)).collect()
    assert {r.doc_id: r.component_id for r in got} == where
    assert {r.doc_id: r.n_shingles for r in got} == size
    assert len(set(where.values())) < len(rows)


def test_frequent_tokens_are_spread_over_slots(spark, monkeypatch):
    monkeypatch.setattr(setjoin, "HOT", 5)
    counts = np.zeros(setjoin.BUCKETS, dtype=np.int64)
    counts[3] = 12
    assert setjoin.salts(counts)[3] == 3 and setjoin.salts(counts)[4] == 1
    test_join_of_one_large_group(spark, 40)
    test_lines_against_brute_force(spark)


@pytest.mark.parametrize("crowd", [2, 1000])
def test_crowded_keys_lose_nothing(spark, monkeypatch, crowd):
    monkeypatch.setattr(setjoin, "CROWD", crowd)
    monkeypatch.setattr(setjoin, "PAIRS", 0)
    monkeypatch.setattr(setjoin, "THIN", 50)
    test_join_against_brute_force(spark)
    test_join_of_one_large_group(spark, 40)
    test_lines_against_brute_force(spark)


@pytest.mark.parametrize("long", [6, 10**6])
def test_keys_of_several_tokens_lose_nothing(spark, monkeypatch, long):
    monkeypatch.setattr(setjoin, "FREQUENT", 3)
    monkeypatch.setattr(setjoin, "LONG", long)
    test_join_against_brute_force(spark)
    test_lines_against_brute_force(spark)


def test_join_of_one_large_group(spark, n=150):
    """Near copies of one text, most of which are similar to the original but not to each other."""
    r = random.Random(9)
    base = [f"b{i}" for i in range(120)]
    rows = [(1000, " ".join(base))]
    for i in range(n):
        w = list(base)
        for _ in range(r.choice([1, 2, 3, 5])):
            w[r.randrange(len(w))] = f"x{r.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    where, _ = brute_components(rows)
    assert {x.doc_id: x.component_id for x in op3.link_components(table(spark, rows)).collect()} == where


def test_join_of_odd_rows(spark):
    got = op3.link_components(table(spark, ODD).withColumn("k1", F.lit("clash")).withColumn("n", F.lit(1))).collect()
    assert len(got) == len(ODD)
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    assert all(r.component_id is None for r in got if r.doc_id is None)
    assert by_id[1].n_shingles == by_id[2].n_shingles == by_id[3].n_shingles == 0 and by_id[2].component_id == 2
    assert by_id[4].component_id == by_id[5].component_id == by_id[-5].component_id == -5
    assert by_id[6].component_id == 6 and by_id[9].n_shingles == 29_996


def test_rows_sharing_an_id_are_one_node(spark):
    a, b = " ".join(f"a{i}" for i in range(20)), " ".join(f"b{i}" for i in range(20))
    got = op3.link_components(table(spark, [(1, a), (5, a), (5, b), (9, b)])).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(1, 1), (5, 1), (9, 1)}


def test_empty_tables(spark):
    empty = table(spark, [])
    assert op3.link_components(empty).count() == 0
    assert op5.dedup(empty).count() == 0


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(7, j) for j in range(50, 80)] + [(3, 3)]
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 141)}, **{j: 7 for j in [7, *range(50, 80)]}}


def brute_lines(rows):
    seen, out = [], {}
    for i, t in sorted((x for x in rows if x[0] is not None and x[1] is not None)):
        kept = []
        for line in t.split("\n"):
            s = frozenset(WORD.findall(lower(line)))
            if not any(similar(s, o) for o in seen):
                kept.append(line)
            if s:
                seen.append(s)
        out[i] = "\n".join(kept)
    return out


def line_corpus(seed=2):
    r = random.Random(seed)
    lines = [t for _, t in near_corpus(120, 6)]
    lines += [" ".join(r.choices(["a", "b", "c", "d", "e"], k=r.randrange(1, 7))) for _ in range(60)]
    lines += [" ".join(x if r.random() < 0.93 else f"v{r.randrange(99)}" for x in line.split(" ")) for line in lines]
    return [(i, "\n".join(r.choices([*lines, "", "short one"], k=r.randrange(1, 6)))) for i in range(90)]


def test_lines_against_brute_force(spark):
    rows = line_corpus()
    got = op5.dedup(table(spark, rows)).collect()
    want = brute_lines(rows)
    assert {x.doc_id: x.text for x in got} == want
    assert all(x.n_chars == len(x.text) and x.n_removed == len(dict(rows)[x.doc_id].split("\n")) - len(want[x.doc_id].split("\n")) + (want[x.doc_id] == "" != dict(rows)[x.doc_id]) for x in got if x.text)


def test_near_lines_that_no_shingle_finds(spark):
    line = "one two three four five six seven eight nine ten"
    rows = [(1, line), (2, line.replace("five", "FIFTH")), (3, "two one"), (4, "One Two\n" + line.replace("one", "1").replace("ten", "10"))]
    assert {x.doc_id: x.text for x in op5.dedup(table(spark, rows)).collect()} == {1: line, 2: "", 3: "two one", 4: line.replace("one", "1").replace("ten", "10")}


def test_lines_of_one_large_group(spark):
    """Near copies of two lines in many documents, and one line in all."""
    r = random.Random(3)
    base = [[f"{c}{i}" for i in range(40)] for c in "xy"]
    rows = []
    for i in range(400):
        text = ["the same line everywhere"]
        for b in base:
            w = list(b)
            for _ in range(r.randrange(5)):
                w[r.randrange(40)] = f"z{r.randrange(10**6)}"
            text.append(" ".join(w))
        rows.append((i, "\n".join(text)))
    assert {x.doc_id: x.text for x in op5.dedup(table(spark, rows)).collect()} == brute_lines(rows)


def test_a_long_text_takes_time_in_proportion(spark):
    rows = [(1, "\n".join(f"line {i} has w{i} and v{i} x{i}" for i in range(100_000))), (2, "\n".join(f"line {i} has w{i} and v{i} x{i}" for i in range(0, 200_000, 2)))]
    got = {x.doc_id: x.n_removed for x in op5.dedup(table(spark, rows)).collect()}
    assert got == {1: 0, 2: 50_000}


def test_clashing_names_of_lines(spark):
    df = table(spark, [(1, "a line\na line"), (2, "a line")])
    for name in ("n_removed", "own", "cut", "_doc", "_key", "k1", "at", "line"):
        df = df.withColumn(name, F.lit(name))
    got = op5.dedup(df)
    assert got.columns == [*(c for c in df.columns if c != "n_removed"), "n_removed"]
    assert {x.doc_id: (x.text, x.n_removed, x.own, x.cut, x._doc) for x in got.collect()} == {1: ("a line", 1, "own", "cut", "_doc"), 2: ("", 1, "own", "cut", "_doc")}
    kept = op5.dedup(df, counted=None)
    assert kept.columns == df.columns and {x.n_removed for x in kept.collect()} == {"n_removed"}


def test_lines_of_odd_rows(spark):
    df = table(spark, ODD).withColumn("line", F.lit("clash")).withColumn("_cut_", F.lit(0))
    got = op5.dedup(df)
    assert got.columns == [*df.columns, "n_removed"] and got.count() == len(ODD)
    by_id = {}
    for x in got.collect():
        by_id.setdefault(x.doc_id, []).append(x)
    assert {x.text for x in by_id[None]} == {None, "no id here but five words at least"}
    assert by_id[1][0].text is None and by_id[2][0].text == ""
    assert [x.text for x in by_id[6]] == ["one two three four five"] * 2
    assert by_id[9][0].text == dict(ODD)[9]


def test_query_and_pipeline_drop_repeats_of_short_lines(spark, tmp_path):
    rows = [(1, "Les.\none two\n\nONE two"), (2, "les.\n\nfour words stand here\none three"), (3, "Les."), (4, "two one\na longer line of six words\na longer line of six words")]
    docs = table(spark, rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    want = {1: "Les.\none two\n", 2: "\nfour words stand here\none three", 3: "", 4: "a longer line of six words"}
    # A document of which no word is left goes.
    assert {x.doc_id: x.text for x in corpus_pipeline.line_dedup(spark, docs, str(tmp_path)).collect()} == {i: t for i, t in want.items() if t}
    got = {x.doc_id: (x.n_removed, x.n_chars) for x in op5.query(spark, str(tmp_path)).collect()}
    assert got == {1: (1, len(want[1])), 2: (1, len(want[2])), 3: (1, 0), 4: (2, len(want[4]))}


@pytest.mark.parametrize("spec", [setjoin.Spec(words=1), setjoin.Spec(words=1, num=4, den=5), setjoin.Spec(words=1, num=9, den=10)])
@pytest.mark.parametrize("often", [0.0, 0.5, 1.0])
def test_similar_sets_meet_and_pass_the_filters(spec, often, monkeypatch):
    """Of every similar pair, two entries of one key pass the filters; all of one task, so that nothing else decides."""
    monkeypatch.setattr(setjoin, "PAIRS", 1000)
    rng = np.random.default_rng(5)
    pool = [f"w{i}" for i in range(40)]
    texts = [" ".join(rng.choice(pool, rng.integers(1, 38), replace=False)) for _ in range(40)]
    texts += [" ".join(w for w in t.split(" ") if rng.random() < 0.95) + " w1" for t in texts]
    rare = rng.integers(0, 5, setjoin.BUCKETS).astype(np.uint8)
    sets = setjoin.sets_of(pa.array(texts), spec, rare)
    counts = np.full(setjoin.BUCKETS, 10**6, dtype=np.int64)
    key, own, place, token, _ = setjoin.keys_of(sets, spec, counts, rng.random(setjoin.BUCKETS) < often)
    entries = {"early": own.astype(np.uint32), "line": own.astype(np.uint16), "gram": key & np.uint64(0xFFFFFFFF), "k1": sets.k1[own], "k2": sets.k2[own], "sig": sets.suffix[token], "n": sets.n[own].astype(np.uint16), "place": place.astype(np.uint16)}
    first, more, crowded = setjoin.close_pairs(setjoin.in_order(entries), spec)
    pairs = {tuple(sorted(p)) for found in (first, more) for p in zip(found["k1"].tolist(), found["j1"].tolist(), strict=True)}
    assert not crowded.any()
    words = [frozenset(t.split(" ")) - {""} for t in texts]
    similar_ones = 0
    for a in range(len(texts)):
        for b in range(a):
            both = len(words[a] & words[b])
            if words[a] != words[b] and spec.den * both >= spec.num * (len(words[a]) + len(words[b]) - both):
                similar_ones += 1
                assert tuple(sorted((int(sets.k1[a]), int(sets.k1[b])))) in pairs
    assert similar_ones > 10


def test_keys_of_equal_lower_halves_meet_only_in_their_slot():
    upper = np.arange(1 << 16, dtype=np.uint64)
    slot, gram = setjoin.slot_and_gram(upper << np.uint64(32) | np.uint64(77), 4096)
    assert (gram == 77).all() and np.bincount(slot, minlength=4096).max() < 50
    again, other = setjoin.slot_and_gram(upper, 4096)
    assert len(np.unique(again)) == 1 and len(np.unique(other)) == 1 << 16


@pytest.mark.parametrize("spec", [op3.SPEC, op5.SPEC])
def test_slots_dealt_in_two_steps_find_the_same(spark, spec):
    rng = np.random.default_rng(3)
    rows = [(i, "\n".join(" ".join(rng.choice([f"w{k}" for k in range(30)], 12)) for _ in range(4))) for i in range(40)]
    rows += [(100 + i, t + " tail") for i, t in rows] + ODD
    docs = table(spark, rows).select("doc_id", "text").where("doc_id is not null")
    plain, dealt = (setjoin.join_sets(docs, spec, most).distinct() for most in (setjoin.MOST_SLOTS, 3))
    assert plain.exceptAll(dealt).isEmpty() and dealt.exceptAll(plain).isEmpty() and plain.count() > 40


def test_few_jobs(spark, tmp_path):
    table(spark, [(i, " ".join(f"w{(i * 7 + k * k) % 50}" for k in range(60))) for i in range(200)]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.sparkContext.setJobGroup("op3", "jobs of op3")
    op3.query(spark, str(tmp_path)).collect()
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("op3")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    print(len(jobs))
    assert len(jobs) < 40


def test_a_sending_task_holds_little():
    """Its arrays stay below 90 MB (172 MB before) on 10 MB of lines, of which about a million entries are made."""
    rng = np.random.default_rng(1)
    words = np.array([f"w{i:05}" for i in range(20_000)])
    texts = ["\n".join(" ".join(line) for line in words[rng.integers(0, len(words), (40, 9))]) for _ in range(4000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(4000)), pa.array(texts), pa.array(range(4000))], names=["doc_id", "_text", "doc_key"])
    counts = np.full(setjoin.BUCKETS, 100)
    tables = (setjoin.rarity(counts), setjoin.salts(counts), counts, setjoin.excess(counts) > setjoin.FREQUENT)
    tracemalloc.start()
    sent = [x.nbytes for x in setjoin.dealt(iter([batch]), op5.SPEC, tables, 0, 0, 204, 0)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(sent) > 15_000_000 and peak < 90_000_000


def test_a_class_has_the_time_of_its_first_member():
    """Whichever of its entries is met first, and where other classes of its key lie between them."""
    rng = np.random.default_rng(2)
    k1 = rng.integers(0, 9, 4000).astype(np.uint64)  # all alike in the bits that are sorted by
    e = {"gram": rng.integers(0, 3, 4000).astype(np.uint32), "k1": k1, "k2": k1.astype(np.uint32), "sig": k1, "n": np.full(4000, 7, dtype=np.uint16), "place": np.zeros(4000, dtype=np.uint16)}
    e |= {"early": rng.integers(0, 2**32, 4000).astype(np.uint32), "line": rng.integers(0, 2**16, 4000).astype(np.uint16)}
    got = setjoin.in_order(e)
    assert len(got["k1"]) == 27
    for gram, k, early, line in zip(*(got[c].tolist() for c in ("gram", "k1", "early", "line")), strict=True):
        at = (e["gram"] == gram) & (e["k1"] == k)
        assert (early, line) == min(zip(e["early"][at].tolist(), e["line"][at].tolist(), strict=True))
