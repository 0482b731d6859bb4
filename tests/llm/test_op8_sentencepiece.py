import itertools
import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import functions as F

from saltmarsh.llm import op8_sentencepiece as op8
from tests.llm.helpers import ODD, table
from tests.llm.test_tokens import strings

SP = sentencepiece.SentencePieceProcessor(model_file=op8.model_path())
MODEL = op8.load(op8.model_path())
MORE = [" x", "  x", "\n\n x", "a\n b", "x " * 3, "<s> hi </s>", "w" * 200 + " x", "the " * 20, "     ", "a▁b▁▁c", "\x00", "aaaaaaaaaa aaa"]


MORE += [f"{' ' * k}return x;\n{' ' * k}{w}" for k in range(1, 20) for w in ("if", "}", "é", "▁▁a")]


def test_merging_on_the_spot_equals_the_library():
    given = [*strings(), *MORE]
    units, n = op8.cut_units(pa.array(given), op8.model_path())
    ids = iter([op8.merge_unit(u.replace(" ", op8.MARK), MODEL) for u in units.to_pylist()])
    for t, k in zip(given, n.tolist(), strict=True):
        assert [i for _ in range(k) for i in next(ids)] == SP.encode(t)


def test_indented_units_take_the_lattice():
    assert MODEL.unproven == (op8.MARK * 16,)


def test_lattice_equals_the_library(spark):
    given = [*strings(1500), *MORE]
    got = op8.encode(spark.createDataFrame(list(enumerate(given)), "doc_id long, text string"), chunk_bytes=10_000).collect()
    assert {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in got} == dict(enumerate(map(SP.encode, given)))
    for r in got:
        text = SP.decode(SP.encode(given[r.doc_id]))
        assert r.round_trip and text == given[r.doc_id].replace(op8.MARK, " ")
        assert (r.decoded_bytes, r.decoded_crc32) == (len(text.encode()), zlib.crc32(text.encode()))


def test_odd_rows(spark):
    got = op8.encode(table(spark, ODD).withColumn("chunk", F.lit("clash")).withColumn("ids", F.lit(0))).collect()
    want = [(i, SP.encode(t or "")) for i, t in ODD]
    assert sorted(((r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in got), key=repr) == sorted(want, key=repr)
    assert op8.encode(table(spark, [])).count() == 0


def test_decoding(spark):
    given = [*strings(300), *MORE]
    rows = spark.createDataFrame([(i, SP.encode(t)) for i, t in enumerate(given)], "doc_id long, ids array<int>")
    got = {r.doc_id: r.text for r in op8.decode(rows, MODEL).collect()}
    assert got == {i: SP.decode(SP.encode(t)) for i, t in enumerate(given)}
    assert op8.decode(rows.limit(0), MODEL).count() == 0
    assert op8.decode(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>"), MODEL).first().text == ""


def best_path(unit, pieces, unknown):
    best = None
    for k in range(len(unit)):
        for cut in itertools.combinations(range(1, len(unit)), k):
            parts = [unit[a:b] for a, b in itertools.pairwise((0, *cut, len(unit)))]
            if all(p in pieces or len(p) == 1 for p in parts):
                total = sum(pieces[p][1] if p in pieces else unknown for p in parts)
                best = max(best, total) if best is not None else total
    return best


def test_viterbi_finds_the_best_sum(spark):
    r = random.Random(4)
    names = {"".join(r.choices("abc▁", k=r.randrange(1, 5))) for _ in range(40)} - {"c"}
    pieces = {p: (300 + i, -r.random() * 10) for i, p in enumerate(sorted(names))}
    model = op8.Model(pieces, 0, 4, unigram=True)
    given = sorted({"".join(r.choices("abc", k=r.randrange(1, 10))) for _ in range(60)})
    got = op8.encode_units(spark.createDataFrame([(u,) for u in given], "unit string"), op8.piece_table(spark, model), model).collect()
    unknown = min(s for _, s in pieces.values()) - 10
    score = {i: s for i, s in pieces.values()}
    text = {i: p for p, (i, _) in pieces.items()}
    assert len(got) == len(given)
    for row in got:
        assert abs(sum(score.get(i, unknown) for i in row.ids) - best_path(row.unit, pieces, unknown)) < 1e-9
        assert "".join(text.get(i, chr(i) if i < 256 else "") for i in row.ids) == row.unit


def test_query_leaves_the_session_as_it_was(spark, tmp_path):
    table(spark, [(1, "some text"), (2, None)]).write.parquet(f"{tmp_path}/documents.parquet")
    name = "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"
    before = spark.conf.get(name)
    assert op8.query(spark, str(tmp_path)).count() == 2 and spark.conf.get(name) == before


def test_cutting_and_decoding_take_little_beside_a_text():
    text = "the quick brown fox, and 12 more " * 30_000
    ids = np.tile(np.array(SP.encode(text), "<u4"), 4)
    op8.cut_units(pa.array(["imports and tables"]), op8.model_path())
    op8.decode_ids(ids[:1], np.array([0, 1]), op8.model_path())
    tracemalloc.start()
    try:
        units, n = op8.cut_units(pa.array([text] * 4), op8.model_path())
        assert tracemalloc.get_traced_memory()[1] < 7 * 4 * len(text)
        assert len(set(n.tolist())) == 1 and "".join(units.to_pylist()) == f" {text}" * 4
        del units, n
        tracemalloc.reset_peak()
        assert op8.decode_ids(ids, np.arange(5) * (len(ids) // 4), op8.model_path()) == [text.encode()] * 4
        assert tracemalloc.get_traced_memory()[1] < 10 * 4 * len(text)
    finally:
        tracemalloc.stop()


def test_a_chunk_meets_its_units_and_keeps_no_text():
    given = [(i, t) for i, t in enumerate([*strings(3000), *MORE, "some words " * 200_000])] + [(None, "no id"), (0, ""), (0, "again")]
    codec, path = pa.Codec("zstd"), op8.model_path()
    raw = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*given, strict=True)], schema=op8._BUNDLE).serialize()
    left = pa.table({"size": [raw.size], "blob": pa.array([codec.compress(raw).to_pybytes()], pa.binary())})
    units = [u.replace(" ", op8.MARK) for u in op8.cut_units(pa.array([t for _, t in given]), path)[0].unique().to_pylist()]
    want = [(i, np.array(SP.encode(t), "<u4").tobytes()) for i, t in given]
    for told in (units[::2], []):  # the others are merged where they are met
        ids = pa.array([op8.merge_unit(u, MODEL) for u in told], pa.list_(pa.int16()))
        right = pa.Table.from_batches(pa.table({"unit": pa.array(told, pa.string()), "ids": ids}).to_batches(500), pa.schema([("unit", pa.string()), ("ids", ids.type)]))
        before = pa.total_allocated_bytes()
        got = op8.meet(left, right, path)
        assert list(zip(got["doc_id"].to_pylist(), got["ids"].to_pylist(), strict=True)) == want
        bare = op8.meet(left, right, path, with_ids=False)
        del got
        assert bare.num_rows == len(given) and pa.total_allocated_bytes() - before < raw.size // 4


def test_batches_are_of_some_megabytes_whatever_the_rows(spark):
    long = spark.range(0, 300, 1, 1).select(F.repeat(F.lit("x"), 100_000).alias("text"))
    with op8.roomy(spark):
        got = [r.n for r in long.mapInArrow(lambda batches: (pa.record_batch({"n": [b.nbytes]}) for b in batches), "n long").collect()]
    assert sum(got) >= 30_000_000 and max(got) < 6_000_000
