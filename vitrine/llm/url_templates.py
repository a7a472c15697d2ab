"""URL filter by a tree of path templates per host, in DataFrame functions only.

Explicit rules decide first. For the other urls the pages that rules did decide are labels of a
template tree: per host, path segments become templates (digits are generalised, a node with too
many rarely seen children gets one wildcard child), sibling branches whose labelled block share
does not differ from their siblings' by more than two standard errors are merged, and a template
is rejected when its labelled purity, smoothed by its parent and by the same template on all
hosts, speaks for blocking.

Pages are counted per (host, path template) first, combined on the map side, so a host with a
third of all pages is a few rows; the tree works on these counts, level by level as stage tables.

Rows: a url that is null or has no "://" has an empty host and path and is judged like others;
repeated rows get the same verdict; an empty table gives an empty result; further columns are not
read. Paths deeper than ``LEVELS`` segments share the template of their first segments and "**".
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..stages import stage
from .common import same, text_or_empty

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = "(?s)^.*?://([^/?#]*)([^?#]*)"
LEVELS = 4
#: A node with more children than this, and fewer pages than VISITS for each, is generalised.
CHILDREN, VISITS = 20, 5
#: Weight of the prior share, in pages.
SMOOTHING = 5
#: Smoothed block share above which a template is rejected.
REJECT = 0.5

#: (host, path, verdict); the query's rules.
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(url, PARTS, 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, PARTS, 2)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]], what: int | None = None) -> Column:
    """The longest rule that fits, as text, or its part ``what``; null where none fits."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == rule[0]) | host.endswith("." + rule[0])) & path.startswith(rule[1])
        found = F.when(fits, F.lit(rule[0] + rule[1] if what is None else rule[what])).otherwise(found)
    return found


def segments(path: Column) -> Column:
    """Path segments with every run of digits generalised."""
    return F.split(F.regexp_replace(F.substring(path, 2, 2**31 - 1), "[0-9]+", "{n}"), "/")


def template_tree(counts: DataFrame) -> DataFrame:
    """``counts`` (host, segments, pages, labelled, blocked) with ``parent`` and ``template``."""
    rows = counts.withColumns({"parent": F.lit(""), "template": F.lit("")})
    for k in range(LEVELS):
        rows = rows.withColumn("segment", F.get("segments", F.lit(k)))
        children = rows.filter("segment IS NOT NULL").groupBy("host", "template", "segment").agg(F.sum("pages").alias("pages"))
        nodes = children.groupBy("host", "template").agg(F.count("*").alias("children"), F.sum("pages").alias("visits"))
        wide = nodes.filter((F.col("children") > CHILDREN) & (F.col("visits") < VISITS * F.col("children"))).select("host", "template", F.lit(True).alias("wide"))
        rows = rows.join(wide, ["host", "template"], "left")
        step = F.concat_ws("/", "template", F.when(F.coalesce("wide", F.lit(False)), F.lit("*")).otherwise(F.col("segment")))
        rows = rows.withColumns(
            {
                "parent": F.when(F.col("segment").isNull(), F.col("parent")).otherwise(F.col("template")),
                "template": F.when(F.col("segment").isNull(), F.col("template")).otherwise(step),
            }
        )
        rows = stage(rows.select(*counts.columns, "parent", "template"), "tree-level")
    deeper = F.size("segments") > LEVELS
    return rows.withColumns(
        {
            "parent": F.when(deeper, F.col("template")).otherwise(F.col("parent")),
            "template": F.when(deeper, F.concat("template", F.lit("/**"))).otherwise(F.col("template")),
        }
    )


def judge_templates(tree: DataFrame) -> DataFrame:
    """(host, template, parent, branch, share, rejected) for every template of the tree."""
    sums = [F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked")]
    leaves = stage(tree.groupBy("host", "parent", "template").agg(*sums), "templates")
    parents = leaves.groupBy("host", "parent").agg(F.sum("labelled").alias("p_labelled"), F.sum("blocked").alias("p_blocked"))
    anywhere = leaves.groupBy("template").agg(F.sum("labelled").alias("t_labelled"), F.sum("blocked").alias("t_blocked"))
    whole = leaves.agg(*sums).first()
    overall = ((whole["blocked"] or 0) + 1) / ((whole["labelled"] or 0) + 2)

    rows = leaves.join(parents, ["host", "parent"]).join(anywhere, "template")
    gap = F.col("blocked") * F.col("p_labelled") - F.col("p_blocked") * F.col("labelled")
    noise = 4.0 * F.col("p_blocked") * (F.col("p_labelled") - F.col("p_blocked")) * F.col("labelled")
    alike = gap.cast("double") * gap <= noise
    rows = rows.withColumns(
        {
            "branch": F.when(alike, F.concat("parent", F.lit("/~"))).otherwise(F.col("template")),
            "anywhere": (F.col("t_blocked") + SMOOTHING * F.lit(overall)) / (F.col("t_labelled") + SMOOTHING),
        }
    )
    branches = rows.groupBy("host", "parent", "branch").agg(F.sum("labelled").alias("b_labelled"), F.sum("blocked").alias("b_blocked"))
    rows = rows.join(branches, ["host", "parent", "branch"])
    above = (F.col("p_blocked") + SMOOTHING * F.col("anywhere")) / (F.col("p_labelled") + SMOOTHING)
    share = (F.col("b_blocked") + SMOOTHING * above) / (F.col("b_labelled") + SMOOTHING)
    rows = rows.withColumn("share", share)
    return rows.select("host", "template", "parent", "branch", "share", (F.col("share") > REJECT).alias("rejected"))


def filter_urls(pages: DataFrame, rules: list[tuple[str, str, str]], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per page: id_col, host, path, rule, verdict, template, branch."""
    url = text_or_empty(url_col)
    rows = pages.select(F.col(id_col), host_of(url).alias("host"), path_of(url).alias("path"))
    rows = rows.withColumns(
        {
            "rule": rule_of(F.col("host"), F.col("path"), rules),
            "ruled": rule_of(F.col("host"), F.col("path"), rules, 2),
            "segments": segments(F.col("path")),
        }
    )
    counts = rows.groupBy("host", "segments").agg(
        F.count("*").alias("pages"), F.count("ruled").alias("labelled"), F.count(F.when(F.col("ruled") == "block", 1)).alias("blocked")
    )
    tree = stage(template_tree(stage(counts, "paths")), "tree")
    judged = tree.join(judge_templates(tree), ["host", "parent", "template"])
    judged = judged.select(F.col("host").alias("t_host"), F.col("segments").alias("t_segments"), "template", "branch", "rejected")
    found = rows.join(judged, same(rows, judged, [("host", "t_host"), ("segments", "t_segments")]))
    verdict = F.coalesce("ruled", F.when(F.col("rejected"), F.lit("block")).otherwise(F.lit("allow")))
    return found.select(id_col, "host", "path", "rule", verdict.alias("verdict"), "template", "branch")


def oracle() -> str:
    """DuckDB SQL for the query's rows."""
    ordered = sorted(RULES, key=lambda r: -len(r[0] + r[1]))
    fits = [f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN " for h, p, _ in ordered]
    rule = "CASE " + " ".join(f + f"'{h}{p}'" for f, (h, p, _) in zip(fits, ordered, strict=True)) + " END"
    ruled = "CASE " + " ".join(f + f"'{v}'" for f, (_, _, v) in zip(fits, ordered, strict=True)) + " END"
    steps = [
        f"""a AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '{PARTS}', 1), '{UPPER}', '{LOWER}') AS host,
            regexp_extract(coalesce(url, ''), '{PARTS}', 2) AS path FROM pages)""",
        f"b AS (SELECT *, {rule} AS rule, {ruled} AS ruled, string_split(regexp_replace(substr(path, 2), '[0-9]+', '{{n}}', 'g'), '/') AS segments FROM a)",
        """l0 AS (SELECT host, segments, count(*) AS pages, count(ruled) AS labelled, count(*) FILTER (ruled = 'block') AS blocked,
            '' AS parent, '' AS template FROM b GROUP BY host, segments)""",
    ]
    for k in range(1, LEVELS + 1):
        steps.append(
            f"""n{k} AS (SELECT host, template FROM (SELECT host, template, segments[{k}] AS s, sum(pages) AS pages FROM l{k - 1}
            WHERE len(segments) >= {k} GROUP BY ALL) GROUP BY host, template HAVING count(*) > {CHILDREN} AND sum(pages) < {VISITS} * count(*))"""
        )
        steps.append(
            f"""l{k} AS (SELECT l.host, segments, pages, labelled, blocked,
            CASE WHEN len(segments) < {k} THEN parent ELSE l.template END AS parent, CASE WHEN len(segments) < {k} THEN l.template
            ELSE l.template || '/' || CASE WHEN n.host IS NULL THEN segments[{k}] ELSE '*' END END AS template
            FROM l{k - 1} l LEFT JOIN n{k} n ON l.host = n.host AND l.template = n.template)"""
        )
    steps += [
        f"""tree AS (SELECT host, segments, labelled, blocked, CASE WHEN len(segments) > {LEVELS} THEN template ELSE parent END AS parent,
            CASE WHEN len(segments) > {LEVELS} THEN template || '/**' ELSE template END AS template FROM l{LEVELS})""",
        "leaves AS (SELECT host, parent, template, sum(labelled) AS labelled, sum(blocked) AS blocked FROM tree GROUP BY ALL)",
        """siblings AS (SELECT *, sum(labelled) OVER (PARTITION BY host, parent) AS pl, sum(blocked) OVER (PARTITION BY host, parent) AS pb,
            sum(labelled) OVER (PARTITION BY template) AS tl, sum(blocked) OVER (PARTITION BY template) AS tb,
            (sum(blocked) OVER () + 1) / (sum(labelled) OVER () + 2) AS overall FROM leaves)""",
        """branched AS (SELECT *, CASE WHEN (blocked * pl - pb * labelled)::DOUBLE * (blocked * pl - pb * labelled) <= 4.0::DOUBLE * pb * (pl - pb) * labelled
            THEN parent || '/~' ELSE template END AS branch FROM siblings)""",
        f"""shares AS (SELECT *, (sum(blocked) OVER w + {SMOOTHING} * ((pb + {SMOOTHING} * ((tb + {SMOOTHING} * overall) / (tl + {SMOOTHING}))) / (pl + {SMOOTHING})))
            / (sum(labelled) OVER w + {SMOOTHING}) AS share FROM branched WINDOW w AS (PARTITION BY host, parent, branch))""",
    ]
    return (
        "WITH " + ",\n".join(steps) + f"\nSELECT page_id, b.host, path, rule, coalesce(ruled, CASE WHEN share > {REJECT} THEN 'block' ELSE 'allow' END) AS verdict"
        " FROM b JOIN tree t ON b.host = t.host AND b.segments = t.segments"
        " JOIN shares s ON s.host = t.host AND s.parent = t.parent AND s.template = t.template"
    )
