"""URL verdicts by a path-template tree: rules first, then the smoothed labelled purity of each url's template.

Each host has a tree of path segments. Numbers and long hexadecimal runs become wildcards by their
form. Then the tree is settled from its root down, a level at a time for all hosts: the branches of a
node are grouped by what most of their urls lead to (the next segment and the label), each is
compared with the rest of its group by the total variation of next segments and labels, and those
within the sampling bound merge into one wildcard; the others keep their own segment. Labels are the
verdicts of rules and, if given, a column of known ones. A template's purity is its share of blocked
urls, smoothed by that of the node above, its host, its domain and all urls; unlabelled urls speak
for a template by a fraction. Only expressions, aggregations and joins of the distinct paths are used.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop_written, fresh, written

#: Parameters of the tree, which ORACLE_SQL repeats.
LEVELS = 4  # segments that are settled one by one; what follows them is one last segment
ALPHA = 0.05  # of the bound on two samples of one distribution
UNLABELLED = 0.5  # of an allowed url
STRENGTH = 2.0  # urls that the node above is worth

#: The rules of the registered query.
RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


def url_host(url: Column) -> Column:
    """What follows the first '://' up to '/', '?', '#' or the end, A-Z in lower case; empty without '://' and for null."""
    host = F.regexp_extract(_rest(url), r"^[^/?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def url_path(url: Column) -> Column:
    """What follows the host up to '?', '#' or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def longest_rule(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule that fits: its host is the url's or a domain above it, and the path starts with the rule's; else null.

    Rules are tried one by one, so they should be some hundreds at most.
    """
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        of, _, start = rule.partition("/")
        fits = ((host == of) | host.endswith(f".{of}")) & path.startswith(f"/{start}")
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def path_shape(path: Column) -> Column:
    """The path with runs of 16 or more hexadecimal digits as {h} and other runs of digits as {n}."""
    return F.regexp_replace(F.regexp_replace(path, r"[0-9a-fA-F]{16,}", "{h}"), r"[0-9]+", "{n}")


def _purity(blocked: Column, allowed: Column, n: Column, above: Column) -> Column:
    return (blocked + STRENGTH * above) / (blocked + allowed + UNLABELLED * (n - blocked - allowed) + STRENGTH)


def _with_purity(paths: DataFrame, *keys: str) -> DataFrame:
    """purity becomes that of the urls with the same keys, smoothed by the purity so far."""
    sums = paths.groupBy(*keys).agg(*[F.sum(c).alias(f"_{c}") for c in ("blocked", "allowed", "n")])
    smoothed = _purity(F.col("_blocked"), F.col("_allowed"), F.col("_n"), F.col("purity"))
    return paths.join(sums, list(keys)).withColumn("purity", smoothed).drop("_blocked", "_allowed", "_n")


def _settled(paths: DataFrame, level: int) -> DataFrame:
    """The templates of paths with more than `level` segments, one segment longer, and their purities."""
    token, after = F.get("segments", F.lit(level)), F.get("segments", F.lit(level + 1))
    live = paths.withColumn("token", token).withColumn("next", F.coalesce(after, F.lit("$")))
    node, branch = ["host", "template"], ["host", "template", "token"]
    # urls by what they lead to
    unlabelled = F.col("n") - F.col("blocked") - F.col("allowed")
    kinds = F.array(*[F.struct(F.lit(k).alias("label"), c.alias("urls")) for k, c in (("block", F.col("blocked")), ("allow", F.col("allowed")), ("none", unlabelled))])
    leads = live.where("token is not null").select(*branch, "next", F.inline(kinds)).where("urls > 0").groupBy(*branch, "next", "label").agg(F.sum("urls").alias("urls"))
    most = F.max(F.struct("urls", "next", "label"))
    branches = leads.groupBy(*branch).agg(F.sum("urls").alias("own"), most.alias("most")).select(*branch, "own", F.concat_ws("|", "most.next", "most.label").alias("mode"))
    leads = leads.join(branches, branch)
    group = [*node, "mode"]
    whole = leads.groupBy(*group, "next", "label").agg(F.sum("urls").alias("all_lead"))
    groups = whole.groupBy(*group).agg(F.sum("all_lead").alias("all"), F.count("*").alias("kinds"))
    # total variation between a branch and the rest of its group
    rest = F.col("all") - F.col("own")
    there = (F.col("all_lead") - F.col("urls")) / rest
    shared = leads.join(whole, [*group, "next", "label"]).join(groups, group).where("all > own")
    apart = (F.sum(F.abs(F.col("urls") / F.col("own") - there)) + 1 - F.sum(there)) / 2
    bound = F.sqrt((F.col("kinds") * math.log(2) + math.log(1 / ALPHA)) / 2) * (1 / F.sqrt("own") + 1 / F.sqrt(rest))
    alike = shared.groupBy(*branch, "mode", "own", "all", "kinds").agg(apart.alias("apart")).where(F.col("apart") <= bound).select(*branch, F.concat(F.lit("*["), "mode", F.lit("]")).alias("merged"))
    grown = F.concat("template", F.lit("/"), F.coalesce("merged", "token"))
    longer = live.where("token is not null").join(alike, branch, "left").withColumn("template", grown).drop("token", "next", "merged")
    return _with_purity(longer, *node)


def path_templates(urls: DataFrame) -> DataFrame:
    """(host, shape, template, purity) of every distinct host and shape of urls with columns host, shape and label (block, allow, null)."""
    spark = urls.sparkSession
    labels = [F.count(F.when(F.col("label") == v, 1)).alias(k) for k, v in (("blocked", "block"), ("allowed", "allow"))]
    paths = urls.groupBy("host", "shape").agg(F.count("*").alias("n"), *labels)
    split = F.split(F.regexp_replace("shape", "^/", ""), "/", LEVELS + 1)
    domain = F.regexp_extract("host", r"[^.]*\.?[^.]*$", 0)
    paths = paths.withColumn("segments", F.when(F.col("shape") == "", F.array().cast("array<string>")).otherwise(split)).withColumn("template", F.lit(""))
    paths, path = written(paths.withColumn("domain", domain).withColumn("purity", F.lit(0.5)), "paths")
    total = paths.agg(*[F.sum(c).alias(f"_{c}") for c in ("blocked", "allowed", "n")])
    smoothed = _purity(F.col("_blocked"), F.col("_allowed"), F.col("_n"), F.lit(0.5))
    one = total.select(F.coalesce(smoothed, F.lit(0.5)).alias("purity"))  # a row
    placed = _with_purity(_with_purity(paths.drop("purity").crossJoin(F.broadcast(one)), "domain"), "host")
    for level in range(LEVELS + 1):
        deep = F.size("segments") > level
        placed, next_path = written(placed.where(~deep).unionByName(_settled(placed.where(deep), level)), "templates")
        drop_written(spark, path)
        path = next_path
    return placed.select("host", "shape", "template", "purity")


def judge_urls(pages: DataFrame, rules: dict[str, str], key: str = "page_id", url: str = "url", label: str | None = None) -> DataFrame:
    """Every row with host, path, rule, verdict, template and purity.

    The verdict is that of the longest rule that fits. Where none does, a url whose template has a
    purity of one half or more is blocked, all others are allowed. Labels are the rules' verdicts; of
    urls without a rule, those of the column `label`, if one is named ('block' or 'allow', else
    unlabelled). Null urls and those without '://' have an empty host and path, and share one template.
    Repeated rows are judged alike and count again; an empty table gives no rows.
    """
    parsed = pages.select(F.col(key).alias("key"), url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"), *([F.col(label).alias("known")] if label else []))
    rows = parsed.withColumn("rule", longest_rule(F.col("host"), F.col("path"), rules))
    ruled = F.create_map(*[F.lit(x) for item in rules.items() for x in item])[F.col("rule")] if rules else F.lit(None).cast("string")
    rows = rows.withColumn("ruled", ruled).withColumn("shape", path_shape(F.col("path")))
    known = F.when(F.col("known").isin("block", "allow"), F.col("known")) if label else F.lit(None).cast("string")
    templates = path_templates(rows.select("host", "shape", F.coalesce("ruled", known).alias("label")))
    judged = F.when(F.col("purity") >= 0.5, "block").otherwise("allow")
    return rows.join(templates, ["host", "shape"]).select(F.col("key").alias(key), "host", "path", "rule", F.coalesce("ruled", judged).alias("verdict"), "template", "purity")


def _oracle_sql() -> str:
    """The same tree as SQL, a block of tables for each level."""
    keys, branch = "host, template", "host, template, token"
    smooth = f"(b + {STRENGTH} * purity) / (b + a + {UNLABELLED} * (m - b - a) + {STRENGTH})"
    sums = "sum(blocked) AS b, sum(allowed) AS a, sum(n) AS m"
    sql = rf"""
WITH cut AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parsed AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
fits AS (
  SELECT *, CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule FROM parsed),
rows AS (
  SELECT *, CASE rule WHEN 'net/' THEN 'block' WHEN 'example.com/de/' THEN 'block' WHEN 'example.net/en/' THEN 'allow' WHEN 'org/fr/' THEN 'allow' END AS ruled,
    regexp_replace(regexp_replace(path, '[0-9a-fA-F]{{16,}}', '{{h}}', 'g'), '[0-9]+', '{{n}}', 'g') AS shape FROM fits),
paths AS (
  SELECT host, shape, count(*) AS n, count(*) FILTER (ruled = 'block') AS blocked, count(*) FILTER (ruled = 'allow') AS allowed FROM rows GROUP BY ALL),
split AS (
  SELECT *, regexp_extract(host, '[^.]*\.?[^.]*$') AS domain, CASE WHEN shape = '' THEN [] ELSE string_split(regexp_replace(shape, '^/', ''), '/') END AS pieces FROM paths),
segmented AS (SELECT *, CASE WHEN len(pieces) > {LEVELS} THEN list_append(pieces[1:{LEVELS}], array_to_string(pieces[{LEVELS + 1}:], '/')) ELSE pieces END AS segments FROM split),
at_all AS (SELECT p.*, {smooth.replace('purity', '0.5')} AS purity FROM segmented p, (SELECT {sums} FROM segmented)),
at_domain AS (SELECT p.* EXCLUDE purity, {smooth} AS purity FROM at_all p JOIN (SELECT domain, {sums} FROM at_all GROUP BY ALL) USING (domain)),
t0 AS (SELECT p.* EXCLUDE purity, '' AS template, {smooth} AS purity FROM at_domain p JOIN (SELECT host, {sums} FROM at_domain GROUP BY ALL) USING (host)),
"""
    for k in range(LEVELS + 1):
        sql += f"""
live{k} AS (SELECT *, segments[{k + 1}] AS token, coalesce(segments[{k + 2}], '$') AS next FROM t{k} WHERE len(segments) > {k}),
lead{k} AS (
  SELECT {branch}, next, label, sum(urls) AS urls FROM (
    SELECT {branch}, next, 'block' AS label, blocked AS urls FROM live{k} UNION ALL SELECT {branch}, next, 'allow' AS label, allowed AS urls FROM live{k}
    UNION ALL SELECT {branch}, next, 'none' AS label, n - blocked - allowed AS urls FROM live{k}) WHERE urls > 0 GROUP BY ALL),
mode{k} AS (
  SELECT {branch}, next || '|' || label AS mode, sum(urls) OVER (PARTITION BY {branch}) AS own FROM lead{k}
  QUALIFY row_number() OVER (PARTITION BY {branch} ORDER BY urls DESC, next DESC, label DESC) = 1),
led{k} AS (SELECT l.*, m.mode, m.own FROM lead{k} l JOIN mode{k} m USING ({branch})),
whole{k} AS (SELECT {keys}, mode, next, label, sum(urls) AS all_lead FROM led{k} GROUP BY ALL),
grouped{k} AS (SELECT {keys}, mode, sum(all_lead) AS total, count(*) AS kinds FROM whole{k} GROUP BY ALL),
apart{k} AS (
  SELECT {branch}, mode, own, total, kinds, (sum(abs(urls / own - (all_lead - urls) / (total - own))) + 1 - sum((all_lead - urls) / (total - own))) / 2 AS apart
  FROM led{k} JOIN whole{k} USING ({keys}, mode, next, label) JOIN grouped{k} USING ({keys}, mode) WHERE total > own GROUP BY ALL),
alike{k} AS (
  SELECT {branch}, '*[' || mode || ']' AS merged FROM apart{k}
  WHERE apart <= sqrt((kinds * ln(2) + ln(1 / {ALPHA})) / 2) * (1 / sqrt(own) + 1 / sqrt(total - own))),
grown{k} AS (SELECT p.* EXCLUDE (template, token, next), p.template || '/' || coalesce(a.merged, p.token) AS template FROM live{k} p LEFT JOIN alike{k} a USING ({branch})),
t{k + 1} AS (
  SELECT host, shape, n, blocked, allowed, domain, segments, template, purity FROM t{k} WHERE len(segments) <= {k} UNION ALL
  SELECT host, shape, n, blocked, allowed, domain, segments, template, {smooth} AS purity FROM grown{k} JOIN (SELECT {keys}, {sums} FROM grown{k} GROUP BY ALL) USING ({keys})){"," if k < LEVELS else ""}"""
    return sql + f"""
SELECT page_id, r.host, path, rule, coalesce(ruled, CASE WHEN purity >= 0.5 THEN 'block' ELSE 'allow' END) AS verdict, template
FROM rows r JOIN t{LEVELS + 1} USING (host, shape)
"""


ORACLE_SQL = _oracle_sql()
