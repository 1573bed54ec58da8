"""URL filters by a tree of path templates, in DataFrame functions only.

Rules (host suffix and path prefix) decide first, the longest winning. What they decide also serves as labels for the
pages that no rule fits. Per host, paths become a tree of templates: numbers, long identifiers and slugs collapse, and a
node with too many children makes them one wildcard. Counts are summed from the leaves up, and siblings whose share of
blocked pages does not differ from their parent's beyond chance, those without labels included, are merged into one
branch. A template's purity is its share of blocked pages among the labelled ones, smoothed towards that of the branch
above it, this one's towards the next, up to the host, its domain and all pages; a template is rejected when it is high.

Scale: rows are aggregated to templates with counts before anything else, so the tree is built from one row per host
and shape; each level is written, so plans don't grow with the depth; joins are keyed by host and branch or template
and left to the optimizer's size checks and skew handling.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.llm._shared import scratch, table, written

#: (verdict, host, path): a rule holds for the host and its subdomains where the path starts with the rule's.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
DEPTH = 4
FANOUT = 20
#: Standard errors within which a branch counts as like its parent.
NEAR = 1.96
REJECT = 0.8
#: Pages of the branch above that a template's own are smoothed with.
SMOOTH = 4.0
#: Shapes of variable segments, tried in this order on each.
SHAPES = (("^[0-9a-fA-F-]{16,}\\z", "{id}"), ("^[^-_.]+([-_][^-_.]+){2,}", "{slug}"), ("[0-9]+", "0"))
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPLIT = "(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _SPLIT, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _SPLIT, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """Struct rule, verdict of the longest rule that fits; null where none does. Meant for up to hundreds of rules."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, on, prefix in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == on) | host.endswith("." + on)) & path.startswith(prefix)
        found = F.when(fits, F.struct(F.lit(on + prefix).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def shape_of(path: Column) -> Column:
    """The path without its leading slash, each segment shaped."""

    def shaped(segment: Column) -> Column:
        for pattern, name in SHAPES:
            segment = F.regexp_replace(segment, pattern, name)
        return segment

    return F.array_join(F.transform(F.split(F.regexp_replace(path, "^/", ""), "/"), shaped), "/")


def domain_of(host: Column) -> Column:
    return F.substring_index(host, ".", -2)


def _tree(counts: DataFrame, depth: int, fanout: int) -> DataFrame:
    """counts(host, shape, n, bad) with names: the segments of its path in the tree, what lies deeper joined to the last."""
    tree = counts.withColumn("segments", F.split("shape", "/", depth)).withColumn("names", F.array().cast("array<string>"))
    for level in range(depth):
        segment = F.get("segments", F.lit(level))
        children = tree.groupBy("host", "names").agg(F.count_distinct(segment).alias("children"))
        name = F.when(F.col("children") > fanout, F.lit("*")).otherwise(segment)
        names = F.when(segment.isNull(), F.col("names")).otherwise(F.concat("names", F.array(name)))
        tree = written(tree.join(children, ["host", "names"]).select("host", "shape", "n", "bad", "segments", names.alias("names")), "url-tree")
    return tree.drop("segments")


def _branches(leaves: DataFrame, path: str) -> DataFrame:
    """leaves with level and branch: the beginnings of the path (an array), from level 0, the host."""
    beginnings = F.transform(F.sequence(F.lit(0), F.size(path)), lambda i: F.struct(i.alias("level"), F.slice(path, 1, i).alias("branch")))
    return leaves.select("*", F.explode(beginnings).alias("b")).select("*", "b.level", "b.branch").drop("b")


def _summed(leaves: DataFrame, path: str) -> DataFrame:
    return _branches(leaves, path).groupBy("host", "level", "branch").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))


def _merged(tree: DataFrame, near: float) -> DataFrame:
    """The tree with template: its names, those of branches that are like their parents being wildcards."""
    sums = written(_summed(tree, "names"), "url-sums")
    above = sums.select("host", (F.col("level") + 1).alias("level"), F.col("branch").alias("above"), F.col("n").alias("above_n"), F.col("bad").alias("above_bad"))
    share = F.try_divide("above_bad", "above_n")
    within = F.abs(F.try_divide("bad", "n") - share) <= near * F.sqrt(F.try_divide(share * (1 - share), F.col("n")))
    own = sums.filter("level > 0").withColumn("above", F.slice("branch", 1, F.col("level") - 1))
    alike = own.join(above, ["host", "level", "above"]).select("host", "level", "branch", ((F.col("n") == 0) | within).alias("alike"))
    steps = _branches(tree.select("host", "shape", "names"), "names").filter("level > 0").join(alike, ["host", "level", "branch"])
    step = F.struct("level", F.when(F.col("alike"), F.lit("*")).otherwise(F.get("names", F.col("level") - 1)).alias("name"))
    # depth rows of one leaf
    templates = steps.groupBy("host", "shape").agg(F.sort_array(F.collect_list(step)).alias("steps"))
    return written(tree.join(templates, ["host", "shape"]).select("host", "shape", "n", "bad", F.col("steps.name").alias("template")), "url-merged")


def templates(labelled: DataFrame, depth: int = DEPTH, fanout: int = FANOUT, near: float = NEAR, reject: float = REJECT, smooth: float = SMOOTH) -> DataFrame:
    """labelled(host, shape, blocked) -> host, shape, template, purity, template_verdict; blocked is null where unlabelled."""
    counts = labelled.groupBy("host", "shape").agg(F.count("blocked").alias("n"), F.coalesce(F.sum(F.col("blocked").cast("long")), F.lit(0)).alias("bad"))
    leaves = _merged(_tree(written(counts, "url-counts"), depth, fanout), near)
    sums = written(_summed(leaves, "template"), "url-branches")
    pages = leaves.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("all_n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("all_bad"))
    domains = leaves.groupBy(domain_of(F.col("host")).alias("domain")).agg(F.sum("n").alias("domain_n"), F.sum("bad").alias("domain_bad"))
    # one row, then one per domain
    priors = domains.crossJoin(pages).select("domain", ((F.col("domain_bad") + smooth * ((F.col("all_bad") + 1) / (F.col("all_n") + 2))) / (F.col("domain_n") + smooth)).alias("prior"))
    each = _branches(leaves.select("host", "template").distinct(), "template").join(sums, ["host", "level", "branch"])
    found = each.groupBy("host", "template").agg(F.sort_array(F.collect_list(F.struct("level", "n", "bad"))).alias("path"))
    known = found.withColumn("domain", domain_of(F.col("host"))).join(written(priors, "url-priors"), "domain")
    purity = F.aggregate("path", F.col("prior"), lambda above, b: (b["bad"] + smooth * above) / (b["n"] + smooth))
    judged = known.select("host", "template", purity.alias("purity"))
    verdict = F.when(F.col("purity") >= reject, F.lit("block")).otherwise(F.lit("allow"))
    shown = F.concat(F.lit("/"), F.array_join("template", "/"))
    return leaves.join(judged, ["host", "template"]).select("host", "shape", shown.alias("template"), "purity", verdict.alias("template_verdict"))


def filter_urls(pages: DataFrame, rules=RULES, **tree) -> DataFrame:
    """pages(page_id, url) -> page_id, host, path, rule, verdict, template, purity: one row per row of pages.

    A null url or one without :// has an empty host and path and is judged like any other template. Repeated rows
    stay repeated; extra columns are ignored; an empty table gives an empty result.
    """
    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    ruled = parts.withColumn("ruled", rule_of(F.col("host"), F.col("path"), rules)).withColumn("shape", shape_of(F.col("path")))
    ruled = written(ruled.select("page_id", "host", "path", "shape", "ruled.rule", F.col("ruled.verdict").alias("rule_verdict")), "url-pages")
    with scratch(pages.sparkSession):
        labelled = ruled.select("host", "shape", (F.col("rule_verdict") == "block").alias("blocked"))
        judged = written(templates(labelled, **tree), "url-templates", keep=True)
    verdict = F.coalesce("rule_verdict", "template_verdict").alias("verdict")
    return ruled.join(judged, ["host", "shape"]).select("page_id", "host", "path", "rule", verdict, "template", "purity")


def op8_urls(spark, sf_dir: str) -> DataFrame:
    """Every page's host, path, rule and verdict."""
    return filter_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict", "template")


def _tree_sql(rules=RULES, depth: int = DEPTH, fanout: int = FANOUT, near: float = NEAR, reject: float = REJECT, smooth: float = SMOOTH) -> str:
    """The same result in DuckDB SQL: columns and windows per level instead of arrays, groups and joins."""
    ordered = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    when = lambda pick: " ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{pick(v, h, p)}'" for v, h, p in ordered)
    shaped = "x"
    for pattern, name in SHAPES:
        shaped = f"regexp_replace({shaped}, '{pattern}', '{name}', 'g')"
    segments = ", ".join(f"CASE WHEN len(parts) > {i} THEN {f'parts[{i + 1}]' if i < depth - 1 else f'array_to_string(parts[{i + 1}:], chr(47))'} END AS s{i}" for i in range(depth))
    keys = ", ".join(f"s{i}" for i in range(depth))
    steps, names, wild = [], "", ""
    for i in range(depth):
        up, names = f"host{names}", f"{names}, n{i}"
        steps.append(f"c{i} AS (SELECT {', '.join(['host', *(f'n{j}' for j in range(i))])}, count(DISTINCT s{i}) AS children FROM t{i} GROUP BY ALL)")
        same = " AND ".join(["t.host = c.host", *(f"t.n{j} IS NOT DISTINCT FROM c.n{j}" for j in range(i))])
        steps.append(f"t{i + 1} AS (SELECT t.*, CASE WHEN s{i} IS NOT NULL THEN CASE WHEN children > {fanout} THEN '*' ELSE s{i} END END AS n{i} FROM t{i} t JOIN c{i} c ON {same})")
        total = f"sum(n) OVER (PARTITION BY {up})"
        share = f"(sum(bad) OVER (PARTITION BY {up}) / nullif({total}, 0))"
        mine = f"sum(n) OVER (PARTITION BY host{names})"
        alike = f"coalesce({mine} = 0 OR abs(sum(bad) OVER (PARTITION BY host{names}) / nullif({mine}, 0) - {share}) <= {near} * sqrt({share} * (1 - {share}) / nullif({mine}, 0)), false)"
        wild += f", CASE WHEN n{i} IS NOT NULL THEN CASE WHEN {alike} THEN '*' ELSE n{i} END END AS w{i}"
    levels, purity = "", "prior"
    for i in range(depth + 1):
        by = ", ".join(["host", *(f"w{j}" for j in range(i))])
        levels += f", sum(n) OVER (PARTITION BY {by}) AS n_{i}, sum(bad) OVER (PARTITION BY {by}) AS bad_{i}"
        step = f"((bad_{i} + {smooth}::DOUBLE * {purity}) / (n_{i} + {smooth}::DOUBLE))"
        purity = step if not i else f"CASE WHEN w{i - 1} IS NULL THEN {purity} ELSE {step} END"
    same = " AND ".join(f"r.s{i} IS NOT DISTINCT FROM j.s{i}" for i in range(depth))
    template = "'/' || " + " || ".join(["coalesce(w0, '')", *(f"coalesce('/' || w{i}, '')" for i in range(1, depth))])
    return f"""
WITH u AS (SELECT page_id, coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), '') AS raw, coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
p AS (SELECT page_id, translate(raw, '{_UPPER}', '{_LOWER}') AS host, path, list_transform(string_split(regexp_replace(path, '^/', ''), '/'), lambda x: {shaped}) AS parts FROM u),
r AS (SELECT page_id, host, path, CASE {when(lambda v, h, p: h + p)} END AS rule, CASE {when(lambda v, h, p: v)} END AS rule_verdict, {segments} FROM p),
t0 AS (SELECT host, {keys}, count(rule_verdict)::DOUBLE AS n, (count(*) FILTER (WHERE rule_verdict = 'block'))::DOUBLE AS bad FROM r GROUP BY host, {keys}),
{", ".join(steps)},
merged AS (SELECT *{wild} FROM t{depth}),
totals AS (SELECT *, array_to_string(string_split(host, '.')[-2:], '.') AS domain, sum(n) OVER () AS all_n, sum(bad) OVER () AS all_bad{levels} FROM merged),
priors AS (SELECT *, (sum(bad) OVER (PARTITION BY domain) + {smooth}::DOUBLE * ((all_bad + 1) / (all_n + 2))) / (sum(n) OVER (PARTITION BY domain) + {smooth}::DOUBLE) AS prior FROM totals),
j AS (SELECT host, {keys}, {template} AS template, CASE WHEN {purity} >= {reject} THEN 'block' ELSE 'allow' END AS verdict FROM priors)
SELECT r.page_id, r.host, r.path, r.rule, coalesce(r.rule_verdict, j.verdict) AS verdict, j.template FROM r JOIN j ON r.host = j.host AND {same}
"""


OP8_SQL = _tree_sql()
