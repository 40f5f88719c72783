"""URL filters by rules of hosts and paths, and by a tree of path templates for each host.

A path's segments lead down the tree of its host. Variable segments become
wildcards: those with digits at once, others if they hold less than a share of
the pages that come by. Branches of one node whose labels, and whose segments
further down, may come from one distribution are merged. Each template's share
of rejected among labelled pages is smoothed by that of the node above, up to
the share of the whole table, and the template is rejected above a threshold.

Pages are first counted by host and segments with digits replaced; the tree is
grown level by level over this table, by aggregates and joins. Only the branches
of one node meet in a task, whose number the share bounds.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, ship
from tidemark.llm.components import stored

DEPTH = 6  # levels of the tree; what lies deeper is one segment
LITERAL = 0.02  # share of a node's pages that a segment needs to stay as it is
LONGEST = 64  # characters of such a segment
SMOOTHING = 5.0  # labelled pages that the node above counts as
REJECTED = 0.75  # smoothed share of rejected pages from which a template is rejected
# Branches are alike below the 0.001 point of chi-squared, or if it is this small a pair of pages.
NORMAL_POINT = 3.09
EFFECT = 0.01

# "?" cannot occur in a path, so wildcards differ from all segments.
REST = "?**"
WILDCARDS = ("?n", "?n.*", "?x", "?x.*", "?w", "?w.*")
AFTER = ("end", REST, *WILDCARDS, "literal")
EXTENSION = r"\.[A-Za-z0-9]{1,5}\z"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What follows the first ``://`` up to ``/ ? #``, A-Z in lower case, and then up to ``? #``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return ascii_lower(F.coalesce(host, F.lit(""))), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[str]) -> Column:
    """The longest of the rules ``host/path`` that fits; null if none does.

    A rule fits its host and all subdomains if the path starts with its own. Of
    rules of equal length the one with the longer host wins. Rules are part of
    the plan, so they should be some hundreds at most.
    """
    found = F.lit(None).cast("string")
    for rule in sorted(set(rules), key=lambda r: (len(r), r.index("/"), r)):
        name, start = rule[: rule.index("/")], rule[rule.index("/") :]
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(start)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def segments(path: Column, depth: int = DEPTH) -> Column:
    """The segments of a path, those with digits as wildcards; a last slash does not count."""
    inner = F.regexp_replace(F.regexp_replace(path, "^/", ""), r"/\z", "")
    parts = F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, "/"))

    def general(part: Column) -> Column:
        stem = F.regexp_replace(part, EXTENSION, "")
        kind = (
            F.when(stem.rlike(r"^[0-9]+\z"), "?n")
            .when(stem.rlike("[0-9]"), "?x")
            .when(F.length(part) > LONGEST, "?w")
        )
        return F.coalesce(F.concat(kind, _tail(part)), part)

    listed = F.transform(F.slice(parts, 1, depth), general)
    deep = F.concat(F.slice(listed, 1, depth - 1), F.array(F.lit(REST)))
    return F.when(F.size(parts) > depth, deep).otherwise(listed)


def _tail(part: Column) -> Column:
    return F.when(part.rlike(EXTENSION), ".*").otherwise("")


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two rows of counts may come from one distribution (test of homogeneity)."""
    both = a + b
    a, b, both = a[both > 0], b[both > 0], both[both > 0]
    if len(both) < 2 or not a.sum() or not b.sum():
        return True
    pages = both.sum()
    wanted_a, wanted_b = both * (a.sum() / pages), both * (b.sum() / pages)
    square = ((a - wanted_a) ** 2 / wanted_a).sum() + ((b - wanted_b) ** 2 / wanted_b).sum()
    df = len(both) - 1
    limit = df * (1 - 2 / (9 * df) + NORMAL_POINT * (2 / (9 * df)) ** 0.5) ** 3
    return bool(square <= limit or square <= EFFECT * pages)


def _merged(pdf: pd.DataFrame) -> pd.DataFrame:
    """The branches of one node, from the most frequent on: each joins the first one alike."""
    pdf = pdf.sort_values(["n", "general"], ascending=[False, True])
    labels = np.stack([pdf["good"], pdf["bad"], pdf["n"] - pdf["good"] - pdf["bad"]], axis=1).astype(float)
    shapes = pdf[[f"after_{i}" for i in range(len(AFTER))]].to_numpy(float)
    groups: list[list] = []
    for row, name in enumerate(pdf["general"]):
        for group in groups:
            if alike(group[1], labels[row]) and alike(group[2], shapes[row]):
                group[0].append(name)
                group[1], group[2] = group[1] + labels[row], group[2] + shapes[row]
                break
        else:
            groups.append([[name], labels[row], shapes[row]])
    above = pdf["purity"].iloc[0]
    made = [
        (
            name,
            names[0] if len(names) == 1 else f"({'|'.join(sorted(names))})",
            (own[1] + SMOOTHING * above) / (own[0] + own[1] + SMOOTHING),
        )
        for names, own, _ in groups
        for name in names
    ]
    out = pd.DataFrame(made, columns=["general", "branch", "smoothed"])
    out.insert(0, "host", pdf["host"].iloc[0])
    out.insert(1, "node", pdf["node"].iloc[0])
    return out


def _step(counted: DataFrame, level: int, literal: float) -> DataFrame:
    """The table one level further down; rows whose path has ended stay where they are."""
    following = (
        F.when(F.size("segs") == level + 1, "end")
        .when(F.col("segs")[level + 1].startswith("?"), F.col("segs")[level + 1])
        .otherwise("literal")
    )
    going = counted.filter(F.size("segs") > level).withColumn("seg", F.col("segs")[level])
    sums = [F.sum(c).alias(c) for c in ("n", "good", "bad")]
    after = [
        F.sum(F.when(following == name, F.col("n")).otherwise(0)).alias(f"after_{i}")
        for i, name in enumerate(AFTER)
    ]
    purity = F.max("purity").alias("purity")
    kinds = stored(going.groupBy("host", "node", "seg").agg(*sums, *after, purity), "kinds")
    totals = kinds.groupBy("host", "node").agg(F.sum("n").alias("total"))
    frequent = F.col("seg").startswith("?") | (F.col("n") >= F.lit(literal) * F.col("total"))
    general = F.when(frequent, F.col("seg")).otherwise(F.concat(F.lit("?w"), _tail(F.col("seg"))))
    named = kinds.join(totals, ["host", "node"]).withColumn("general", general).drop("total")
    again = [F.sum(f"after_{i}").alias(f"after_{i}") for i in range(len(AFTER))]
    branches = named.groupBy("host", "node", "general").agg(*sums, *again, purity)
    schema = "host string, node string, general string, branch string, smoothed double"
    merged = branches.groupBy("host", "node").applyInPandas(_merged, schema)
    steps = named.select("host", "node", "seg", "general").join(merged, ["host", "node", "general"])
    steps = stored(steps.drop("general"), "steps")
    rows = counted.withColumn("seg", F.get("segs", F.lit(level)))
    return stored(
        rows.join(steps, ["host", "node", "seg"], "left").select(
            "host",
            "key",
            "segs",
            "n",
            "good",
            "bad",
            F.coalesce(F.concat("node", F.lit("/"), "branch"), "node").alias("node"),
            F.coalesce("smoothed", "purity").alias("purity"),
        ),
        "level",
    )


def fit_templates(
    df: DataFrame,
    host: Column,
    path: Column,
    label: Column,
    *,
    depth: int = DEPTH,
    literal: float = LITERAL,
) -> DataFrame:
    """Columns host, key, template, purity: the leaf of each host and path with digits replaced.

    ``label`` is 1 for a page to reject, 0 for one to keep, null if not known;
    all pages count. Without a label every purity is 0.5; an empty table gives
    no rows. ``template_key`` of a path finds its row.
    """
    ship(df.sparkSession.sparkContext.applicationId)
    segs = segments(path, depth)
    known = df.select(host.alias("host"), segs.alias("segs"), label.alias("label"))
    counted = known.groupBy("host", "segs").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.col("label") == 0, 1)).alias("good"),
        F.count(F.when(F.col("label") == 1, 1)).alias("bad"),
    )
    counted = stored(counted.withColumn("key", template_key(F.col("segs"))), "paths")
    everything = counted.agg(F.sum("good"), F.sum("bad"), F.max(F.size("segs"))).first()
    good, bad, levels = (x or 0 for x in everything)
    share = (bad + 1) / (good + bad + 2)
    hosts = counted.groupBy("host").agg(F.sum("good").alias("g"), F.sum("bad").alias("b"))
    purity = (F.col("b") + SMOOTHING * share) / (F.col("g") + F.col("b") + SMOOTHING)
    hosts = hosts.select("host", purity.alias("purity"))
    now = counted.join(hosts, "host").withColumn("node", F.lit(""))
    now = stored(now, "level")
    for level in range(levels):
        now = _step(now, level, literal)
    return now.select("host", "key", F.col("node").alias("template"), "purity")


def template_key(segs: Column) -> Column:
    """One text for the segments of a path."""
    return F.concat(F.when(F.size(segs) > 0, "/").otherwise(""), F.array_join(segs, "/"))


def judge_urls(
    df: DataFrame,
    rules: dict[str, str],
    *,
    id_column: str = "page_id",
    url_column: str = "url",
    rejected: float = REJECTED,
    depth: int = DEPTH,
    literal: float = LITERAL,
) -> DataFrame:
    """Columns id, host, path, rule, verdict, template, purity of every row.

    ``rules`` gives allow or block for texts ``host/path``; see ``rule_of``. The
    pages that a rule fits are the labelled ones, from which the templates are
    judged; all other pages get the verdict of their template. Null urls and
    those without ``://`` have an empty host and path, and are judged as such.
    Repeated rows and ids each stay; urls of any length are taken whole; an
    empty table gives no rows. Other columns are not read.
    """
    for rule, verdict in rules.items():
        if verdict not in ("allow", "block") or not re.match(r"[^/?#]*/[^?#]*$", rule):
            raise ValueError(f"{rule!r}: {verdict!r} is no rule")
    host, path = host_and_path(F.col(f"`{url_column}`"))
    pages = df.select(F.col(f"`{id_column}`").alias("tm_page"), host.alias("host"), path.alias("path"))
    rule = rule_of(F.col("host"), F.col("path"), list(rules))
    blocked = [r for r, verdict in rules.items() if verdict == "block"]
    label = F.when(F.col("rule").isNotNull(), F.col("rule").isin(blocked).cast("int"))
    pages = pages.withColumn("rule", rule)
    tree = fit_templates(pages, F.col("host"), F.col("path"), label, depth=depth, literal=literal)
    keyed = pages.withColumn("key", template_key(segments(F.col("path"), depth)))
    by_template = F.when(F.col("purity") >= rejected, 1).otherwise(0)
    verdict = F.when(F.coalesce(label, by_template) == 1, "block").otherwise("allow")
    return keyed.join(tree, ["host", "key"]).select(
        F.col("tm_page").alias(id_column),
        "host",
        "path",
        "rule",
        verdict.alias("verdict"),
        "template",
        "purity",
    )
