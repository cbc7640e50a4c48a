"""URL verdicts from allow and block rules, carried over to aliases of a page.

Method.  A rule names a host and the start of a path; it fits the host and its
subdomains, and the longest rule that fits decides.  Pages that a redirect or a
canonical link ties together are one page under several addresses: distributed
connected components over those links make groups, and an address without a
rule of its own takes its group's verdict, which is allow if any address of
the group is explicitly allowed, else block if any is blocked.  What nothing
decides is allowed.

Hosts are looked up once per distinct host, so a host with a third of all
pages costs one look-up; pages then meet their host's few rules in the row.

Defined results: a null url or one without ``://`` has empty host and path,
fits no rule and is allowed.  Of two rules with one host and path, allow wins.
Rows are judged one by one; null and repeated ids only label them.  A null
html has no links.  Links are read by a parser, so those in comments and scripts
are none, references in them are decoded, ``rel`` is a list of words and
``base`` counts; the first of a kind holds.  Both links of a page are edges.  Other columns are not read.  An empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .components import components
from .words import by_size

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
RULE_SCHEMA = "verdict string, rule_host string, rule_path string"
DEFAULT = "allow"
# Patterns of the SQL twin, which knows plain tags only.
CANONICAL = r"""(?is)<link\b[^>]*\brel\s*=\s*["']?canonical\b[^>]*>"""
REFRESH = r"""(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh\b[^>]*>"""
HREF = r"""(?is)\bhref\s*=\s*["']?([^"'\s>]+)"""
GOES_TO = r"""(?is)\burl\s*=\s*["']?([^"'\s>]+)"""
BATCH_BYTES = 4 << 20
LINK_NAMES = ("moved", "link", "base")
TRACKING = "utm_[a-z]+|gclid|fbclid|ref"


def rest(url: Column) -> Column:
    """What follows the first ``://``; empty for null and for an address without it."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(after: Column) -> Column:
    return F.translate(F.regexp_extract(after, "^[^/?#]*", 0), UPPER, LOWER)


def path_of(after: Column) -> Column:
    return F.regexp_extract(after, "^[^/?#]*([^?#]*)", 1)


def key_of(after: Column) -> Column:
    """The address without scheme, fragment and tracking parameters."""
    query = F.regexp_extract(after, r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_join(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(f"^(?:{TRACKING})=")), "&")
    return F.concat(host_of(after), path_of(after), F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(F.lit("")))


class Links(HTMLParser):
    """Where a page says it has moved to, what it calls its canonical address, and its base."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found = dict.fromkeys(LINK_NAMES, "")

    def keep(self, name: str, to: str | None) -> None:
        self.found[name] = self.found[name] or (to or "").strip()

    def handle_starttag(self, tag, attrs):
        said = {k: v or "" for k, v in reversed(attrs)}
        if tag == "base":
            self.keep("base", said.get("href"))
        elif tag == "link" and "canonical" in said.get("rel", "").lower().split():
            self.keep("link", said.get("href"))
        elif tag == "meta" and said.get("http-equiv", "").strip().lower() == "refresh":
            _, _, goes = said.get("content", "").replace(",", ";", 1).partition(";")
            name, _, to = goes.strip().partition("=")
            if name.strip().lower() == "url":
                self.keep("moved", to.strip().strip("'\""))


def read_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows without ``html``, with the three addresses its tags hold; empty for none."""
    for batch in by_size(batches, "html", BATCH_BYTES):
        found: dict[str, list[str]] = {name: [] for name in LINK_NAMES}
        for page in batch.column("html").to_pylist():
            low = (page or "").lower()
            links = dict.fromkeys(LINK_NAMES, "")
            if "canonical" in low or "http-equiv" in low:
                parser = Links()
                parser.feed(page)
                parser.close()
                links = parser.found
            for name, to in links.items():
                found[name].append(to)
        names = [n for n in batch.schema.names if n != "html"]
        yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [pa.array(found[n], pa.string()) for n in LINK_NAMES], [*names, *LINK_NAMES])


def targets_of() -> Column:
    """The rests of the addresses a page redirects to and names as canonical; empty for none."""
    base = target_of(F.col("base"), F.col("host"), F.col("path"))
    host = F.when(base == "", F.col("host")).otherwise(host_of(base))
    path = F.when(base == "", F.col("path")).otherwise(path_of(base))
    return F.array(*[key_of(target_of(F.col(to), host, path)) for to in ("moved", "link")])


def target_of(to: Column, host: Column, path: Column) -> Column:
    """The rest of the address that a page's link means; empty for none."""
    return (
        F.when(to == "", F.lit(""))
        .when(to.contains("://"), rest(to))
        .when(to.startswith("//"), F.substring(to, F.lit(3), F.length(to)))
        .when(to.startswith("/"), F.concat(host, to))
        .otherwise(F.concat(host, F.regexp_extract(F.when(path == "", F.lit("/")).otherwise(path), "^(?:.*/)?", 0), to))
    )


def host_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """For every host that rules fit, those rules (looked_up, rules)."""
    parts = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    named = hosts.filter("host <> ''").select("host", F.explode(suffixes).alias("suffix"))
    fits = named.join(rules, F.col("suffix") == F.col("rule_host"))
    rule = F.struct((F.length("rule_host") + F.length("rule_path")).alias("size"), (F.col("verdict") == "allow").alias("allow"), "rule_host", "rule_path")
    return fits.groupBy(F.col("host").alias("looked_up")).agg(F.collect_list(rule).alias("rules"))


def ruled(addresses: DataFrame, rules: DataFrame) -> DataFrame:
    """The rows of ``addresses`` (host, path, ...) with ``rule`` and ``ruled`` (allow, block or null)."""
    table = host_rules(addresses.select("host").distinct(), rules)
    best = F.array_max(F.filter(F.col("rules"), lambda r: F.startswith(F.col("path"), r["rule_path"])))
    joined = addresses.join(table, F.col("host") == F.col("looked_up"), "left").withColumn("best", best)
    return joined.withColumns(
        {
            "rule": F.concat("best.rule_host", "best.rule_path"),
            "ruled": F.when(F.col("best.allow"), F.lit("allow")).when(~F.col("best.allow"), F.lit("block")),
        }
    ).drop("best", "rules", "looked_up")


def alias_verdicts(links: DataFrame, rules: DataFrame) -> DataFrame:
    """(alias, carried): the verdict of every address that links tie to others; null if no rule decides."""
    groups = components(links, "key", "target")
    members = groups.unionByName(groups.select(F.col("root").alias("node"), "root").distinct())
    split = members.select("node", "root", host_of(F.col("node")).alias("host"), path_of(F.col("node")).alias("path"))
    known = ruled(split, rules).select("node", "root", "ruled")
    decided = known.groupBy(F.col("root").alias("group")).agg(
        F.max(F.when(F.col("ruled") == "allow", 1)).alias("allowed"), F.max(F.when(F.col("ruled") == "block", 1)).alias("blocked")
    )
    verdict = F.when(F.col("allowed") == 1, F.lit("allow")).when(F.col("blocked") == 1, F.lit("block"))
    return known.join(decided, F.col("root") == F.col("group")).select(F.col("node").alias("alias"), verdict.alias("carried"))


def judge(pages: DataFrame, rules: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule and verdict of every page; ``rules`` as in ``RULE_SCHEMA``."""
    rules = pages.sparkSession.createDataFrame(list(RULES), RULE_SCHEMA) if rules is None else rules
    after = pages.select(F.col("page_id"), "html", rest(F.col("url")).alias("after"))
    placed = after.select("page_id", "html", host_of(F.col("after")).alias("host"), path_of(F.col("after")).alias("path"), key_of(F.col("after")).alias("key"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in placed.drop("html").schema.fields)
    linked = placed.mapInArrow(read_links, f"{kinds}, moved string, link string, base string")
    known = materialize(linked.select("page_id", "host", "path", "key", targets_of().alias("targets")), "addresses")
    links = known.select("key", F.explode("targets").alias("target")).filter("key <> '' and target <> '' and key <> target").distinct()
    carried = alias_verdicts(links, rules)
    own = ruled(known, rules)
    joined = own.join(carried, F.col("key") == F.col("alias"), "left")
    return joined.select("page_id", "host", "path", "rule", F.coalesce("ruled", "carried", F.lit(DEFAULT)).alias("verdict"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page with its rule and verdict."""
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def oracle() -> str:
    rows = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)
    host = "translate(regexp_extract({0}, '^[^/?#]*'), '" + UPPER + "', '" + LOWER + "')"
    path = "regexp_extract({0}, '^[^/?#]*([^?#]*)', 1)"
    key = (
        f"concat({host}, {path}, CASE WHEN len(list_filter(string_split(regexp_extract({{0}}, '^[^?#]*\\?([^#]*)', 1), '&'), lambda p: p <> '' AND NOT regexp_matches(p, '^(?:{TRACKING})='))) > 0 "
        f"THEN concat('?', array_to_string(list_filter(string_split(regexp_extract({{0}}, '^[^?#]*\\?([^#]*)', 1), '&'), lambda p: p <> '' AND NOT regexp_matches(p, '^(?:{TRACKING})=')), '&')) ELSE '' END)"
    )
    after = "CASE WHEN strpos({0}, '://') > 0 THEN substr({0}, strpos({0}, '://') + 3) ELSE '' END"
    quoted = {n: p.replace("'", "''") for n, p in (("canonical", CANONICAL), ("refresh", REFRESH), ("href", HREF), ("goes", GOES_TO))}
    fit = "SELECT {0}, arg_max(r.host || r.path, length(r.host || r.path) * 2 + CASE r.verdict WHEN 'allow' THEN 1 ELSE 0 END) AS rule, arg_max(r.verdict, length(r.host || r.path) * 2 + CASE r.verdict WHEN 'allow' THEN 1 ELSE 0 END) AS ruled FROM {1} x JOIN rules r ON (x.host = r.host OR ends_with(x.host, '.' || r.host)) AND starts_with(x.path, r.path) GROUP BY {0}"
    return f"""
WITH RECURSIVE rules(verdict, host, path) AS (VALUES {rows}),
a AS (SELECT page_id, html, {after.format("url")} AS after FROM pages),
p AS (SELECT page_id, {host.format("after")} AS host, {path.format("after")} AS path, {key.format("after")} AS key,
             unnest([replace(coalesce(regexp_extract(regexp_extract(html, '{quoted["refresh"]}'), '{quoted["goes"]}', 1), ''), '&amp;', '&'),
                     replace(coalesce(regexp_extract(regexp_extract(html, '{quoted["canonical"]}'), '{quoted["href"]}', 1), ''), '&amp;', '&')]) AS goes
      FROM a),
t AS (SELECT *, CASE WHEN goes = '' THEN '' WHEN contains(goes, '://') THEN {after.format("goes")} WHEN starts_with(goes, '//') THEN substr(goes, 3)
                     WHEN starts_with(goes, '/') THEN host || goes
                     ELSE host || regexp_extract(CASE WHEN path = '' THEN '/' ELSE path END, '^(?:.*/)?') || goes END AS there FROM p),
u AS (SELECT page_id, host, path, key, {key.format("there")} AS target FROM t),
links AS (SELECT DISTINCT key AS x, target AS y FROM u WHERE key <> '' AND target <> '' AND key <> target),
ways AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach(x, y) AS (SELECT x, x FROM ways UNION SELECT reach.x, ways.y FROM reach JOIN ways ON reach.y = ways.x),
ends AS (SELECT DISTINCT y, {host.format("y")} AS host, {path.format("y")} AS path FROM reach),
known AS ({fit.format("x.y", "ends")}),
carried AS (SELECT reach.x AS alias, CASE WHEN max(CASE WHEN ruled = 'allow' THEN 1 END) = 1 THEN 'allow' WHEN max(CASE WHEN ruled = 'block' THEN 1 END) = 1 THEN 'block' END AS carried
            FROM reach LEFT JOIN known ON reach.y = known.y GROUP BY reach.x),
places AS (SELECT DISTINCT host, path FROM u),
best AS (SELECT host, path, rule, ruled FROM (SELECT x.host, x.path, r.host || r.path AS rule, r.verdict AS ruled,
           row_number() OVER (PARTITION BY x.host, x.path ORDER BY length(r.host || r.path) DESC, r.verdict) AS n
         FROM places x JOIN rules r ON (x.host = r.host OR ends_with(x.host, '.' || r.host)) AND starts_with(x.path, r.path)) WHERE n = 1)
SELECT u.page_id, u.host, u.path, best.rule, coalesce(best.ruled, carried.carried, '{DEFAULT}') AS verdict
FROM (SELECT DISTINCT page_id, host, path, key FROM u) u LEFT JOIN best ON u.host = best.host AND u.path = best.path LEFT JOIN carried ON u.key = carried.alias"""
