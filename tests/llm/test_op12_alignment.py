import hashlib
from collections import Counter

import numpy as np
import pytest

from saltmarsh.llm import op12_alignment as op
from saltmarsh.llm import perfecthash as ph

from .helpers import ODD, table


def brute(texts):
    import sentencepiece
    from tokenizers import Tokenizer

    from saltmarsh.llm.op2_token_counts import byte_alphabet

    a_path, b_path = op.paths()
    a, b = Tokenizer.from_file(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path)
    a.encode_special_tokens = True
    alphabet = byte_alphabet()
    bytes_a = lambda i: bytes(alphabet[c] for c in a.id_to_token(i))
    bytes_b = lambda i: bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    docs, count = [], Counter()
    for text in texts:
        ids = [(a.encode(" " + text, add_special_tokens=False).ids, b.encode(text))] if text else [([], [])]
        (x, y), want = ids[0], (" " + (text or "")).encode()
        if not text or b"".join(map(bytes_a, x)) != want or b"".join(map(bytes_b, y)) != want:
            docs.append(([], [], [], ""))
            continue
        spans = []
        for side, of in ((x, bytes_a), (y, bytes_b)):
            end = np.cumsum([len(of(i)) for i in side]).tolist()
            spans.append(list(zip([0, *end[:-1]], end, side, strict=True)))
        links, j = [], 0
        for s, e, i in spans[0]:
            while spans[1][j][1] <= s:
                j += 1
            k = j
            while k < len(spans[1]) and spans[1][k][0] < e:
                links.append((i, spans[1][k][2]))
                k += 1
        both = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        parts, start = [], 0
        at = [0, 0]
        for end in both:
            part = []
            for n in (0, 1):
                mine = []
                while at[n] < len(spans[n]) and spans[n][at[n]][1] <= end:
                    mine.append(str(spans[n][at[n]][2]))
                    at[n] += 1
                part.append(",".join(mine))
            parts.append("|".join(part))
            start = end
        docs.append((x, y, links, ";".join(parts)))
        count.update(links)
    best = {}
    for (_, y), n in count.items():
        best[y] = max(best.get(y, 0), n)
    return [(len(x), len(y), g.count(";") + 1 if g else 0, len(links), sum(count[p] == best[p[1]] for p in links), sum(count[p] for p in links), hashlib.sha256(g.encode()).hexdigest() if g else "") for x, y, links, g in docs]


MORE = [
    (20, "<|endoftext|> <s> </s> <unk> <0x0A> plain"), (21, "with ▁ inside"), (22, "tabs\tand\r\nbreaks\n\n  two  spaces  \n end "), (23, "\nstarts with a break"), (24, "\x00\x01 controls"), (25, "Ünïcödé ﬁ Å ½ ①"),
    (26, "it's the don't we'll 12345 tests!!! -- (a+b)=c"), (27, " "), (28, "\n"), (29, "   three"), (30, "こんにちは世界 ok ​­"),
]


@pytest.mark.parametrize("pairs", [op.BROADCAST_PAIRS, 60, 0])
def test_alignment_equals_brute_force(spark, pairs):
    rows = [(i, t and t[:20_000]) for i, t in ODD] + MORE
    got = op.alignment(table(spark, rows).withColumnRenamed("source", "row").repartition(3), pairs=pairs).collect()
    want = sorted((str(i), *w) for (i, _), w in zip(rows, brute([t for _, t in rows]), strict=True))
    assert sorted((str(r.doc_id), *(r[c] for c in (*op.RESULT, "groups_sha256"))) for r in got) == want


def test_empty_table(spark):
    assert op.alignment(table(spark, [])).collect() == []


def test_perfect_hash_is_minimal_and_keys_tell_strangers():
    keys = np.unique(np.random.default_rng(1).integers(0, 2**62, 50_000).astype(np.uint64))
    shard = ph.shard_of(keys)
    levels = {int(s): ph.Levels.load(*ph.Levels.build(keys[shard == s]).dump()) for s in np.unique(shard)}
    whole = ph.PerfectHash(levels)
    slots = whole.slots(keys)
    assert sorted(slots.tolist()) == list(range(len(keys)))
    kept = np.empty_like(keys)
    kept[slots] = keys
    others = keys + np.uint64(1)
    others = others[~np.isin(others, keys)]
    at = whole.slots(others)
    assert not np.any((at >= 0) & (kept[at] == others))
    assert len(ph.PerfectHash({}).slots(keys[:5])) == 5
    with pytest.raises(ValueError, match="repeat"):
        ph.Levels.build(np.zeros(2, dtype=np.uint64))
