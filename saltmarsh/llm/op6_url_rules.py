"""URL filter: a sort-merge range join of urls with nested host-and-path rules.

A host is written with its labels reversed (`www.example.com` -> `com/example/www/`; no host holds a `/`, as it ends there), so a rule's
host and all its subdomains are one interval of keys, and the intervals of all rules nest or are
disjoint. Urls are range-partitioned and sorted by that key; each task sweeps its sorted urls and
the sorted rules together, pushing a rule where its interval opens and popping it where it closes.
The rules on the stack are those whose hosts fit; the longest whose path begins the url's path wins
(length of host and path together, then of the host, then the smaller verdict, `allow`).

Sorting is by (host key, path, id), so one host with a third of all rows is spread over many tasks.
The sweep's side of rules is broadcast only after its size was checked (`max_rules`, `max_bytes`);
a larger rule table is joined by exploding each host into its parents and an equi-join, which needs
no broadcast and gives the same rows.

Defined results: a null url or one without `://` has an empty host and an empty path and fits no
rule but those of an empty host, of which there are none; it gets the default verdict. Rules with a
null or empty host, one that holds `/`, `?` or `#`, or a null path are ignored; equal rules count once, and where such rules
disagree `allow` wins. Repeated urls and ids are judged row by row. Extra columns don't pass.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from saltmarsh.llm.common import table

RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
DEFAULT = "allow"
#: Ends each label of a key. Hosts are cut where it stands, so none holds it.
END = "/"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def rules_table(spark: SparkSession, rules: tuple[tuple[str, str, str], ...] = RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def url_host(url: Column) -> Column:
    after = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(after, UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    """Labels reversed, each ended by what no host holds: a host's key begins the key of every subdomain."""
    return F.when(host == "", F.lit("")).otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), END), F.lit(END)))


def _clean(rules: DataFrame) -> DataFrame:
    return (
        rules.where("host is not null and host <> '' and path is not null and verdict is not null and not host rlike '[/?#]'")
        .select(F.translate("host", UPPER, LOWER).alias("host"), "path", "verdict")
        .groupBy("host", "path").agg(F.min("verdict").alias("verdict"))
    )


@dataclass
class HostRules:
    """The rules of one host, by path; of each the longest other one that its path begins with, or -1."""

    key: bytes
    paths: list[bytes]
    outer: list[int]
    shown: list[tuple[str, str]]  # host and path, verdict

    @classmethod
    def of(cls, key: bytes, rules: list[tuple[bytes, str, str]]) -> HostRules:
        rules = sorted(rules)
        outer, nest = [], []
        for n, (path, *_) in enumerate(rules):
            while nest and not path.startswith(rules[nest[-1]][0]):
                nest.pop()
            outer.append(nest[-1] if nest else -1)
            nest.append(n)
        return cls(key, [r[0] for r in rules], outer, [(r[1], r[2]) for r in rules])

    def longest(self, path: bytes) -> int:
        """The longest rule that the path begins with, or -1: all that begin it stand around the last one not behind it."""
        at = bisect_right(self.paths, path) - 1
        while at >= 0 and not path.startswith(self.paths[at]):
            at = self.outer[at]
        return at


def by_host(rules: list[tuple[str, str, str]]) -> list[HostRules]:
    """Rules (host, path, verdict), by the host's key."""
    found: dict[bytes, list[tuple[bytes, str, str]]] = {}
    for host, path, verdict in rules:
        found.setdefault((END.join(reversed(host.split("."))) + END).encode(), []).append((path.encode(), host + path, verdict))
    return [HostRules.of(key, found[key]) for key in sorted(found)]


def sweep(keys: list[bytes], paths: list[bytes], rules: list[HostRules], state: list) -> Iterator[tuple[str | None, str | None]]:
    """Judge urls in key order. rules: by key; state: [next host, stack]. The stack holds the hosts whose intervals are open, outermost first."""
    for key, path in zip(keys, paths, strict=True):
        at, stack = state
        while at < len(rules) and rules[at].key <= key:
            while stack and not rules[at].key.startswith(stack[-1].key):
                stack.pop()
            stack.append(rules[at])
            at += 1
        state[0] = at
        while stack and not key.startswith(stack[-1].key):
            stack.pop()
        best = None
        for host in stack:  # one for each label of the url's host at most
            n = host.longest(path)
            if n >= 0 and (best is None or (len(host.shown[n][0]), len(host.key)) > best[0]):
                best = ((len(host.shown[n][0]), len(host.key)), host.shown[n])
        yield best[1] if best else (None, None)


def _swept(urls: DataFrame, rules: list[tuple[str, str, str]], id_col: str) -> DataFrame:
    shared = urls.sparkSession.sparkContext.broadcast(by_host(rules))
    schema = urls.select(id_col, "host", "path").schema.add("rule", "string").add("found", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: list = [0, []]
        for b in batches:
            keys = [x.encode() for x in b.column("_key").to_pylist()]
            paths = [x.encode() for x in b.column("path").to_pylist()]
            got = list(sweep(keys, paths, shared.value, state))
            columns = [b.column(id_col), b.column("host"), b.column("path"), pa.array([x[0] for x in got], pa.string()), pa.array([x[1] for x in got], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[id_col, "host", "path", "rule", "found"])

    keyed = urls.withColumn("_key", host_key(F.col("host")))
    return keyed.repartitionByRange("_key", "path", id_col).sortWithinPartitions("_key", "path", id_col).mapInArrow(run, schema)


def _joined(urls: DataFrame, rules: DataFrame, id_col: str) -> DataFrame:
    """The same without a broadcast: each url meets the rules of its host and the host's parents, by the beginnings of its
    path of just those lengths that rules of that host have. So a url has a row for each length, not for each rule."""
    labels = F.split("host", r"\.", -1)
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    rows = urls.withColumn("_row", F.monotonically_increasing_id())
    lengths = rules.groupBy(F.col("host").alias("_parent")).agg(F.collect_set(F.length("path")).alias("_lengths"))
    spread = rows.select("_row", F.col("path").alias("_path"), F.explode(parents).alias("_parent")).join(lengths, "_parent")
    begun = spread.select("_row", "_parent", "_path", F.explode("_lengths").alias("_n")).where(F.col("_n") <= F.length("_path"))
    begun = begun.select("_row", "_parent", F.expr("left(_path, _n)").alias("_start"))
    fits = (
        begun.join(rules.select(F.col("host").alias("_parent"), F.col("path").alias("_start"), F.col("verdict").alias("_verdict")), ["_parent", "_start"])
        .groupBy("_row")
        .agg(F.max(F.struct(F.length(F.concat("_parent", "_start")).alias("n"), F.length("_parent").alias("h"), F.concat("_parent", "_start").alias("rule"), F.col("_verdict").alias("found"))).alias("b"))
        .select("_row", "b.rule", "b.found")
    )
    return rows.join(fits, "_row", "left").select(id_col, "host", "path", "rule", "found")


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = DEFAULT, max_rules: int = 200_000, max_bytes: int = 32_000_000) -> DataFrame:
    """page_id, host, path, rule (the winning rule's host and path, else null), verdict."""
    urls = pages.select(id_col, url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path"))
    clean = _clean(rules)
    n, size = clean.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("host") * 2 + F.octet_length("path")), F.lit(0))).first()
    if n <= max_rules and size <= max_bytes:
        out = _swept(urls, [tuple(r) for r in clean.collect()], id_col)
    else:
        out = _joined(urls, clean, id_col)
    return out.select(id_col, "host", "path", "rule", F.coalesce("found", F.lit(default)).alias("verdict"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), rules_table(spark))


_VALUES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
ORACLE = f"""
WITH rules(rhost, rpath, verdict) AS (VALUES {_VALUES}),
u AS (
  SELECT row_number() OVER () AS r, page_id,
         translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
  FROM pages),
best AS (
  SELECT r, rhost || rpath AS rule, verdict,
         row_number() OVER (PARTITION BY r ORDER BY length(rhost || rpath) DESC, length(rhost) DESC) AS k
  FROM u JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(verdict, '{DEFAULT}') AS verdict
FROM u LEFT JOIN (SELECT * FROM best WHERE k = 1) b ON u.r = b.r
"""
