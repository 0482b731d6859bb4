import base64
import hashlib
import random

from saltmarsh.llm import op1_warc as op1
from tests.llm.helpers import table

PAGES = "page_id long, url string, html string, kind string"


def sha1(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def test_roundtrip_with_odd_pages(spark):
    rows = [(1, "http://a/", "x", "k"), (2, None, None, "k"), (3, "http://a b/\n", "", "k"), (4, "http://é/", "é" * 9000, "k"), (5, "u", "x", "k"), (9, "u", "x", "k"), (9, "u", "x", "k"), (None, "u", "x", "k"), (7, "u", "WARC/1.1\r\n\r\n\r\n", "k")]
    got = sorted((tuple(r)[:5] for r in op1.digest(table(spark, rows, PAGES)).collect()), key=repr)
    want = []
    for page, _, html, _ in rows:
        top = max((p for p, _, h, _ in rows if (h or "") == (html or "") and p is not None), default=None)
        same = sum((h or "") == (html or "") for _, _, h, _ in rows) > 1
        revisit = same and page != top
        want.append((page, len((html or "").encode()), sha1(html), "revisit" if revisit else "response", top if revisit else None))
    assert got == sorted(want, key=repr)
    assert op1.digest(table(spark, [], PAGES)).count() == 0


def archive(n=30):
    r = random.Random(1)
    parts = []
    for i in range(n):
        body = bytes(r.choices(b"abcdefgh \r\n", k=r.randrange(1, 3000)))
        parts.append(op1.record("response", i, f"http://x/{i}", body, op1.sha1(body), None))
    return parts


def pages(found):
    return [int(op1._PAGE.match(x["record_id"])[1]) for x in found if x["kind"] == "record"]


def test_salvage_finds_all_records_around_damage():
    parts = archive()
    places = [sum(map(len, parts[:i])) for i in range(len(parts) + 1)]
    whole = b"".join(parts)
    assert pages(op1.salvage(whole)) == list(range(30))
    r = random.Random(3)
    for _ in range(40):
        data, hit = bytearray(whole), set()
        for _ in range(r.randrange(1, 4)):
            at, n = r.randrange(len(data)), r.randrange(1, 400)
            data[at : at + n] = bytes(r.randrange(256) for _ in range(min(n, len(data) - at)))
            hit |= {i for i in range(30) if places[i] < at + n and at < places[i + 1]}
        found = list(op1.salvage(bytes(data)))
        assert set(range(30)) - hit <= set(pages(found))
        assert [x["offset"] for x in found] == [sum(x["length"] for x in found[:i]) for i in range(len(found))]
        assert sum(x["length"] for x in found) == len(data)
        assert any(x["kind"] == "gap" and x["error"] for x in found) or len(pages(found)) == 30


def test_salvage_of_cut_and_plain_archives(spark):
    import gzip

    parts = archive(5)
    whole = b"".join(parts)
    cut = list(op1.salvage(whole[len(parts[0]) // 2 : -10]))
    assert pages(cut) == [1, 2, 3] and [x["kind"] for x in cut] == ["gap", "record", "record", "record", "gap"]
    plain = b"".join(map(gzip.decompress, parts))
    assert pages(op1.salvage(b"junk" + plain)) == list(range(5))
    changed = plain.replace(b"WARC-Type: response", b"WARC-Type: responsf", 1)
    assert pages(op1.salvage(changed)) == list(range(5))
    body_at = plain.index(b"\r\n\r\n", plain.index(b"HTTP/1.1")) + 5
    broken = plain[:body_at] + b"#" + plain[body_at + 1 :]
    assert pages(op1.salvage(broken)) == [1, 2, 3, 4]
    df = spark.createDataFrame([("a", whole), ("b", b""), ("c", None)], "archive string, content binary")
    got = op1.read_archives(df).collect()
    assert {(r.archive, r.kind) for r in got} == {("a", "record"), ("c", "gap")} and len(got) == 6


def test_members_of_several_records():
    import gzip

    parts = archive(6)
    plain = [gzip.decompress(p) for p in parts]
    broken = plain[4].replace(b"Content-Length", b"Content_Length")
    data = gzip.compress(b"".join(plain[:3])) + b"junk" + gzip.compress(plain[3] + broken + plain[5])
    found = list(op1.salvage(data))
    assert pages(found) == [0, 1, 2, 3, 5]
    assert [x["kind"] for x in found] == ["record"] * 3 + ["gap", "record", "gap", "record"]
    assert sum(x["length"] for x in found) == len(data)


def test_false_openings_cost_one_search_each():
    data = (op1.GZIP + b"WARC/1.x ") * 40_000 + archive(1)[0]
    found = list(op1.salvage(data))
    assert pages(found) == [0] and [x["kind"] for x in found] == ["gap", "record"]


def test_members_that_swell_are_gaps_and_take_little_memory():
    import tracemalloc
    import zlib

    def packed(*parts):
        packer = zlib.compressobj(9, zlib.DEFLATED, 31)
        return b"".join(packer.compress(p) for p in parts) + packer.flush()

    good = op1.record("response", 1, "http://x", b"payload", op1.sha1(b"payload"), None)
    plain = zlib.decompress(good, 31)
    zeros = [bytes(1 << 20)] * 300
    liar = b"WARC/1.1\r\nContent-Length: 99999999999\r\n\r\n"
    for bomb, records in ((packed(*zeros), 0), (packed(plain, *zeros), 1), (packed(liar, *zeros), 0)):
        assert len(bomb) < 400_000
        tracemalloc.start()
        rows = list(op1.salvage(good + bomb + good))
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        kinds = [r["kind"] for r in rows]
        assert kinds.count("record") == 2 + records and "gap" in kinds and rows[-1]["kind"] == "record"
        assert most < 120_000_000
    # A large record that is as long as it says is read whole.
    large = bytes(40_000_000)
    (row,) = op1.salvage(op1.record("response", 2, "http://y", large, op1.sha1(large), None))
    assert row["kind"] == "record" and row["payload_bytes"] == len(large)
