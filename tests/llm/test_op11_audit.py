from itertools import permutations

from saltmarsh.llm import op11_filter_audit as op

from .helpers import ODD, WORD


def failing(text, doc_id, ids_of):
    text = text or ""
    words = WORD.findall(text)
    out = "A" if len(words) < 100 else ""
    out += "B" if 100 * len(set(words)) < 80 * len(words) else ""
    out += "C" if 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text) else ""
    out += "D" if set(text) & set("#$%&*|") else ""
    return out + ("E" if doc_id is not None and any(i < doc_id for i in ids_of[text]) else "")


def brute(docs, labels):
    ids_of = {}
    for i, t, _ in docs:
        ids_of.setdefault(t or "", []).extend([] if i is None else [i])
    judged = [(lang or "", failing(t, i, ids_of), *(i is not None and any(m[0] == i and m[k] == 1 for m in labels) for k in (1, 2))) for i, t, lang in docs]
    out = {}
    for part in {j[0] for j in judged}:
        rows = {}
        for order in map("".join, permutations("ABCDE")):
            left = [j for j in judged if j[0] == part]
            for step, f in enumerate(order, 1):
                gone = [j for j in left if f in j[1]]
                left = [j for j in left if f not in j[1]]
                fails = [j for j in judged if j[0] == part and f in j[1]]
                rows[order, step] = [len(left), len(gone), len(fails) - len(gone), sum(j[1] == f for j in fails), sum(j[2] for j in gone), sum(j[3] for j in gone)]
        share = {f: sum(rows[o, s][1] for o, s in rows if o[s - 1] == f) for f in "ABCDE"}
        out |= {(part, o, s): (*v, share[o[s - 1]]) for (o, s), v in rows.items()}
    return out


def run(spark, docs, labels):
    d = spark.createDataFrame([(i, t, lang, 7, "x") for i, t, lang in docs], "doc_id long, text string, lang string, mask int, digest string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rows = op.audit(op.judged(d, marks)).collect()
    got = {(r.part, r.filter_order, r.step): tuple(r[c] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")) for r in rows}
    assert len(got) == len(rows)
    return got


def test_audit_equals_simulation(spark):
    text = " ".join(f"word{i}" for i in range(120))
    docs = [(i, t, ["en", "de", None, ""][k % 4]) for k, (i, t) in enumerate(ODD)]
    docs += [(100, text, "en"), (101, text, "en"), (101, text, "en"), (99, text, "fr"), (99, text, "de"), (102, text.upper(), "en"), (103, text + " #", "en"), (104, "same " * 200, "en"), (None, text, "en")]
    labels = [(100, 1, 0), (101, 1, 0), (101, 0, 1), (102, 0, 1), (104, 1, 1), (5, 1, None), (-5, None, 1), (None, 1, 1), (777, 1, 1)]
    assert run(spark, docs, labels) == brute(docs, labels)


def test_empty_table_gives_no_rows_and_runs_tile_the_orders(spark):
    assert run(spark, [], []) == {}
    for mask in range(1, 32):
        ranks = sorted(r for m, _, a, z in op.runs() for r in range(a, z) if m == mask)
        assert ranks == list(range(120))
    assert len(op.runs()) == 840
