"""URL filter: host and path rules first, then a tree of path templates with labelled purity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.shared import materialize

#: Fixed rules of the query: (action, host, path).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: Levels of the tree; what a path has from the last one on is one segment, kept by its own value.
DEPTH = 16
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]], part: int | None = None) -> Column:
    """The longest fitting rule's text, host followed by path (part None), or its field `part`; null if none fits."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == rule[1]) | host.endswith("." + rule[1])) & path.startswith(rule[2])
        found = F.when(fits, F.lit(rule[1] + rule[2] if part is None else rule[part])).otherwise(found)
    return found


def _typed(path: Column) -> Column:
    """The path's segments with numbers and long hexadecimal ids typed, joined."""
    parts = F.filter(F.split(path, "/"), lambda s: s != "")
    return F.array_join(F.transform(parts, lambda s: F.when(s.rlike(r"(?i)^[0-9a-f-]{16,}$"), "<id>").otherwise(F.regexp_replace(s, "[0-9]+", "<n>"))), "/")


def generalise(paths: DataFrame, least_seen: int, many: int, z: float) -> DataFrame:
    """Add `template` to (host, raw, segments, n, labelled, bad): the path with alike or variable segments as *.

    Level by level from the root, the children of a node (host, template so far) become * if the position
    varies (at least `many` values seen fewer than three times on average), if they are seen fewer than
    `least_seen` times, or if their labelled share isn't told apart from their siblings' by a two-proportion
    test at `z`. Typed segments stay. Siblings are counted by an aggregate and joined back, so a host with
    very many paths is no group in one task.
    """
    tree = paths.withColumn("template", F.lit(""))
    levels = paths.agg(F.max(F.size("segments"))).first()[0] or 0  # DEPTH at most
    for level in range(levels):
        here = tree.withColumn("child", F.get(F.col("segments"), F.lit(level)))
        children = here.filter("child is not null").groupBy("host", "template", "child").agg(
            F.sum("n").alias("n"), F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad")
        )
        around = children.groupBy("host", "template").agg(
            F.count("*").alias("values"), F.sum("n").alias("seen"), F.sum("labelled").alias("all_labelled"), F.sum("bad").alias("all_bad")
        )
        n1, n2 = F.col("labelled"), F.col("all_labelled") - F.col("labelled")
        pooled = F.col("all_bad") / F.col("all_labelled")
        gap = F.abs(F.col("bad") / n1 - (F.col("all_bad") - F.col("bad")) / n2)
        alike = F.when((n1 > 0) & (n2 > 0), gap <= z * F.sqrt(pooled * (1 - pooled) * (1 / n1 + 1 / n2))).otherwise(n1 == 0)
        varies = (F.col("values") >= many) & (F.col("seen") < 3 * F.col("values"))
        star = ~F.col("child").contains("<") & (varies | (F.col("n") < least_seen) | ((F.col("values") > 1) & alike))
        named = children.join(around, ["host", "template"]).select(
            "host", "template", "child", F.when(star, "*").otherwise(F.col("child")).alias("name")
        )
        tree = here.join(named, ["host", "template", "child"], "left").withColumn(
            "template", F.when(F.col("name").isNull(), F.col("template")).otherwise(F.concat("template", F.lit("/"), "name"))
        ).drop("child", "name")
        tree = materialize(tree, "url-level")  # each level reads the last one twice
    return tree


def judge_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    labels: DataFrame | None = None,
    least_seen: int = 3,
    many: int = 20,
    z: float = 1.96,
    prior: float = 4.0,
    reject: float = 0.7,
) -> DataFrame:
    """Verdict of every page url: (page_id, host, path, rule, verdict, template, bad_share).

    A url that a rule fits gets the longest one's action. These urls, and those of `labels` (url, bad 0/1)
    if given, are the labelled examples of the method, which judges the others: per host, paths form a tree
    whose variable or alike branches are merged to wildcards (see `generalise`); a template's share of
    labelled bad urls, smoothed with `prior` pseudo-counts towards its host's share and that towards the
    share of all, rejects it from `reject` up.

    Null url or one without "://": empty host and path, judged as any other. Null page_id and repeated rows are kept, and count
    each time; other columns are ignored. Ties: of two rules of one length the later one by action, host and path holds. A very long
    url is judged whole: its segments from the 16th on are one, by their own value. An empty table gives no rows.
    """
    base = pages.select("page_id", F.col("url").cast("string").alias("url")).withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    host, path = F.col("host"), F.col("path")
    judged = base.select(
        "page_id", "host", "path", rule_of(host, path, rules).alias("rule"), rule_of(host, path, rules, 0).alias("action"),
        _typed(path).alias("raw"),
    )
    known = judged.select("host", "raw", F.when(F.col("action") == "block", 1).when(F.col("action") == "allow", 0).alias("bad"))
    if labels is not None:
        given = labels.select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), F.col("bad").cast("int").alias("bad"))
        known = known.union(given.select("host", _typed(path), "bad"))
    paths = materialize(
        known.groupBy("host", "raw")
        .agg(F.count("*").alias("n"), F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
        .withColumn("segments", F.when(F.col("raw") == "", F.array().cast("array<string>")).otherwise(F.split("raw", "/", DEPTH))),
        "url-paths",
    )
    tree = generalise(paths, least_seen, many, z).select("host", "raw", "template", "labelled", "bad")
    everywhere = paths.agg(F.coalesce(F.sum("bad") / F.sum("labelled"), F.lit(0.5)).alias("all_share"))
    hosts = (
        paths.groupBy("host").agg(F.sum("bad").alias("host_bad"), F.sum("labelled").alias("host_labelled"))
        .crossJoin(everywhere)  # one row
        .select("host", ((F.col("host_bad") + prior * F.col("all_share")) / (F.col("host_labelled") + prior)).alias("host_share"))
    )
    shares = (
        tree.groupBy("host", "template").agg(F.sum("bad").alias("bad"), F.sum("labelled").alias("labelled"))
        .join(hosts, "host")
        .select("host", "template", ((F.col("bad") + prior * F.col("host_share")) / (F.col("labelled") + prior)).alias("bad_share"))
    )
    by_path = tree.select("host", "raw", "template").join(shares, ["host", "template"])
    method = F.when(F.col("bad_share") >= reject, "block").otherwise("allow")
    return judged.join(by_path, ["host", "raw"], "left").select(
        "page_id", "host", "path", "rule", F.coalesce("action", method).alias("verdict"), "template", "bad_share"
    )


def oracle(least_seen: int = 3, many: int = 20, z: float = 1.96, prior: float = 4.0, reject: float = 0.7) -> str:
    """DuckDB SQL of `judge_urls` with RULES on pages; every level of the tree is a step."""
    fits = lambda r: f"(host = '{r[1]}' OR ends_with(host, '.{r[1]}')) AND starts_with(path, '{r[2]}')"
    longest = sorted(RULES, key=lambda r: (-len(r[1] + r[2]), r))
    rule = " ".join(f"WHEN {fits(r)} THEN '{r[1]}{r[2]}'" for r in longest)
    action = " ".join(f"WHEN {fits(r)} THEN '{r[0]}'" for r in longest)
    sql = rf"""
WITH b AS (
  SELECT page_id, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
p AS (SELECT *, list_filter(string_split(path, '/'), lambda s: s <> '') AS parts FROM b),
j AS (
  SELECT page_id, host, path, CASE {rule} END AS rule, CASE {action} END AS action, array_to_string(list_transform(parts,
    lambda s: CASE WHEN regexp_matches(s, '(?i)^[0-9a-f-]{{16,}}$') THEN '<id>' ELSE regexp_replace(s, '[0-9]+', '<n>', 'g') END), '/') AS raw
  FROM p),
t0 AS (
  SELECT host, raw, CASE WHEN raw = '' THEN [] WHEN len(string_split(raw, '/')) < {DEPTH} THEN string_split(raw, '/')
    ELSE string_split(raw, '/')[1:{DEPTH - 1}] || [array_to_string(string_split(raw, '/')[{DEPTH}:], '/')] END AS segments, count(*) AS n, count(action) AS labelled,
    count(*) FILTER (action = 'block') AS bad, '' AS template FROM j GROUP BY host, raw)"""
    for k in range(DEPTH):
        sql += f""",
h{k} AS (SELECT *, segments[{k + 1}] AS child FROM t{k}),
c{k} AS (SELECT host, template, child, sum(n)::BIGINT AS n, sum(labelled)::BIGINT AS l, sum(bad)::BIGINT AS b FROM h{k} WHERE child IS NOT NULL GROUP BY ALL),
a{k} AS (SELECT host, template, count(*) AS v, sum(n)::BIGINT AS seen, sum(l)::BIGINT AS al, sum(b)::BIGINT AS ab FROM c{k} GROUP BY ALL),
n{k} AS (
  SELECT host, template, child, CASE WHEN NOT contains(child, '<') AND ((v >= {many} AND seen < 3 * v) OR n < {least_seen} OR (v > 1 AND
    CASE WHEN l > 0 AND al - l > 0 THEN abs(b / l - (ab - b) / (al - l)) <= {z}::DOUBLE * sqrt(ab / al * (1 - ab / al) * (1 / l + 1 / (al - l))) ELSE l = 0 END))
    THEN '*' ELSE child END AS name FROM c{k} JOIN a{k} USING (host, template)),
t{k + 1} AS MATERIALIZED (
  SELECT h.host, h.raw, h.segments, h.n, h.labelled, h.bad, CASE WHEN name IS NULL THEN h.template ELSE h.template || '/' || name END AS template
  FROM h{k} h LEFT JOIN n{k} x ON x.host = h.host AND x.template = h.template AND x.child = h.child)"""
    return sql + f""",
hs AS (
  SELECT host, (sum(bad) + {prior}::DOUBLE * (SELECT coalesce(sum(bad) / sum(labelled), 0.5) FROM t0)) / (sum(labelled) + {prior}::DOUBLE) AS host_share FROM t0 GROUP BY host),
s AS (
  SELECT t.host, template, (sum(bad) + {prior}::DOUBLE * host_share) / (sum(labelled) + {prior}::DOUBLE) AS bad_share
  FROM t{DEPTH} t JOIN hs ON hs.host = t.host GROUP BY t.host, template, host_share)
SELECT page_id, j.host, path, rule, coalesce(action, CASE WHEN bad_share >= {reject} THEN 'block' ELSE 'allow' END) AS verdict, t.template, bad_share
FROM j JOIN t{DEPTH} t ON t.host = j.host AND t.raw = j.raw JOIN s ON s.host = t.host AND s.template = t.template
"""
