import random

from saltmarsh.llm import op6_url_rules as op6
from tests.llm.helpers import table

PAGES = "page_id long, url string, html string"


def brute(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[: min((path.find(c) for c in "?#" if c in path), default=len(path))]
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if h and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best[2] if best else None, best[3] if best else "allow"


def test_rules_against_brute_force(spark):
    r = random.Random(5)
    hosts = ["com", "a.com", "b.a.com", "c.b.a.com", "xa.com", "net", "a.net", "A.Net", "", "a", "com.", ".com", "a..com", "é.com", "a,com", "com,a.com", "u@a.com", "a.com:80", "example,a.com", "net,a"]
    paths = ["", "/", "/en", "/en/", "/en/x", "/fr/y?q=/en/", "#/en/", "?x://y", "/\n/en/"]
    rules = [(r.choice(hosts[:7]), r.choice(["/", "", "/en", "/en/", "/fr/"]), r.choice(["allow", "block"])) for _ in range(25)]
    unique = {}
    for h, p, v in rules:
        unique[h, p] = min(v, unique.get((h, p), v))
    rows = [(i, f"{r.choice(['http', 'https', 'HTTP', ''])}://{r.choice(hosts)}{r.choice(paths)}", "") for i in range(900)]
    rows += [(1400, None, ""), (1401, "", ""), (1402, "no scheme", ""), (None, "http://a.com/en/", ""), (1403, "http://a.com/en/", ""), (1403, "http://a.com/en/", "")]
    pages = table(spark, rows, PAGES)
    want = sorted([(i, *brute(u, [(h, p, v) for (h, p), v in unique.items()])) for i, u, _ in rows], key=repr)
    rule_rows = [*rules, (None, "/", "block"), ("", "/", "block"), ("com", None, "block"), ("a.com/b", "/", "block")]
    rule_table = spark.createDataFrame(rule_rows, "host string, path string, verdict string")
    for kw in ({}, {"max_rules": 0}):
        got = op6.judge(pages, rule_table, **kw).collect()
        assert sorted(map(tuple, got), key=repr) == want
    assert op6.judge(table(spark, [], PAGES), rule_table).count() == 0
    assert op6.judge(pages, rule_table.limit(0)).where("verdict = 'block'").count() == 0


def test_many_rules_of_one_host_take_time_in_proportion():
    import time

    def took(n):
        paths = [f"/{i // 100}/{i % 100}/" for i in range(n)] + ["/", "/5/", "/5/5", "/5/5/5/5/"]
        rules = op6.by_host([("a.com", p, "block") for p in paths])
        urls = sorted(f"/{i // 100}/{i % 100}/x" for i in range(0, n, 2)) + ["/5/5/5/5/y", "/5/6", "nothing"]
        start = time.perf_counter()
        got = list(op6.sweep([b"com/a/b/"] * len(urls), [u.encode() for u in urls], rules, [0, []]))
        took = time.perf_counter() - start
        assert got[0] == ("a.com/0/0/", "block") and [g[0] for g in got[-3:]] == ["a.com/5/5/5/5/", "a.com/5/", None]
        return took

    took(2000)
    assert took(200_000) < 20 * 20 * max(took(10_000), 0.01) / 10


def test_longest_rule_of_a_host_against_all_of_them():
    r = random.Random(9)
    paths = list({"".join(r.choice("ab/") for _ in range(r.randrange(6))) for _ in range(60)})
    host = op6.HostRules.of(b"com/", [(p.encode(), p, "block") for p in paths])
    for _ in range(500):
        path = "".join(r.choice("ab/") for _ in range(r.randrange(8)))
        want = max((p for p in paths if path.startswith(p)), key=len, default=None)
        n = host.longest(path.encode())
        assert (host.shown[n][0] if n >= 0 else None) == want
