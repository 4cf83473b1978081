"""URL filter: host and path rules, and a path-template tree for what no rule decides. DataFrame functions only.

The tree, per host and level by level: a path segment stays as it is if it has at least ``support``
pages; all others become ``*``. There is no limit to the named branches of a parent. A branch merges
with the largest of its parent's branches that is
labelled alike (both have no labelled pages, or mostly good, mixed, or mostly bad ones) if the shapes
of what follows (digits, letters, marks) are spread alike, up to ``spread`` in total variation.
The tree grows a level as long as some branch has ``support`` pages with a further segment (``depth``
can end it sooner); what is longer ends in ``**``. A merged branch is named by its segments, or with
more than ``NAMES`` of them by its largest and their number.

Pages that a rule decides are the labelled ones. A template's purity is the share of blocked pages
among its labelled ones, smoothed with ``weight`` pages, half of them blocked, so that a template
needs evidence; templates above ``limit`` are rejected, and their other pages blocked.

Pages of one host and path are worked on as one row with a count; a host with a great share of the
pages is pre-aggregated like any other, and only counts are shuffled.

Defined results: a null URL, or one without ``://``, has an empty host and path; such pages are a host
of their own. Equal rows get equal results. Other columns are returned unchanged; the new columns
replace any of the same name. An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.llm.stage import carried, dropped, staged

NAMES = 20  # segments that a merged branch's name lists

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    rest = F.get(F.split(url, "://", 2), F.lit(1))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: dict[str, str]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict. A rule is a host, which stands for its subdomains too, and the begin of a path."""
    name = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        own, _, prefix = rule.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith("/" + prefix)
        name, verdict = F.when(fits, rule).otherwise(name), F.when(fits, rules[rule]).otherwise(verdict)
    return name, verdict


def _shape(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, r"[0-9]+", "0"), r"[^0-9/._-]+", "a")


def _level(t: DataFrame, k: int, support: int, spread: float) -> DataFrame:
    """``t`` with the template one segment longer."""
    here = t.where(F.size("segments") > k).withColumn("segment", F.get("segments", F.lit(k)))
    kids = here.groupBy("host", "template", "segment").agg(*(F.sum(c).alias(c) for c in ("n", "labelled", "bad")))
    named = staged(kids.where(F.col("n") >= support)
                   .withColumn("band", F.when(F.col("labelled") > 0, F.round(F.col("bad") / F.col("labelled") * 2)).otherwise(-1.0)), "named")
    chief = named.groupBy("host", "template", "band").agg(F.max_by("segment", F.struct("n", "segment")).alias("chief"))
    tail = _shape(F.array_join(F.slice("segments", k + 2, F.greatest(F.size("segments"), F.lit(1))), "/"))
    shapes = (here.join(named.select("host", "template", "segment"), ["host", "template", "segment"])
              .groupBy("host", "template", "segment", tail.alias("shape")).agg(F.sum("n").alias("count"))
              .join(named, ["host", "template", "segment"]).select("host", "template", "band", "segment", "shape", (F.col("count") / F.col("n")).alias("part")))
    shapes = staged(shapes, "shapes")
    of_chief = (shapes.join(chief, ["host", "template", "band"]).where(F.col("segment") == F.col("chief"))
                .select("host", "template", "band", "shape", F.col("part").alias("chief_part")))
    common = shapes.join(of_chief, ["host", "template", "band", "shape"]).groupBy("host", "template", "segment").agg(F.sum(F.least("part", "chief_part")).alias("common"))
    alike = F.coalesce("common", F.lit(0.0)) >= 1 - spread
    branch = (named.join(chief, ["host", "template", "band"]).join(common, ["host", "template", "segment"], "left")
              .select("host", "template", "segment", F.when(alike, F.col("chief")).otherwise(F.col("segment")).alias("with")))
    branch = staged(branch, "branches")
    sizes = branch.groupBy("host", "template", "with").agg(F.count(F.lit(1)).alias("m"))
    spelled = (branch.join(sizes.where(F.col("m") <= NAMES), ["host", "template", "with"]).groupBy("host", "template", "with")
               .agg(F.array_join(F.sort_array(F.collect_set("segment")), "|").alias("name")))
    names = sizes.join(spelled, ["host", "template", "with"], "left").select(
        "host", "template", "with", "m", F.coalesce("name", F.concat("with", F.lit("|+"), (F.col("m") - 1).cast("string"))).alias("name"))
    branch = branch.join(names, ["host", "template", "with"]).select(
        "host", "template", "segment", F.when(F.col("m") > 1, F.concat(F.lit("{"), "name", F.lit("}"))).otherwise(F.col("name")).alias("name"))
    branch = staged(branch, "branches")  # so that Spark can split the pages of a great host in the join
    longer = t.withColumn("segment", F.get("segments", F.lit(k))).join(branch, ["host", "template", "segment"], "left")
    step = F.when(F.col("segment").isNull(), "").otherwise(F.concat(F.lit("/"), F.coalesce("name", F.lit("*"))))
    return longer.withColumn("template", F.concat("template", step)).select(*t.columns)


def _grows(t: DataFrame, k: int, support: int) -> bool:
    """Whether some branch has ``support`` pages with a segment after ``k``."""
    deeper = t.where(F.size("segments") > k).groupBy("host", "template").agg(F.sum("n").alias("n"))
    return not deeper.where(F.col("n") >= support).isEmpty()


def filter_urls(pages: DataFrame, rules: dict[str, str], url_col: str = "url", depth: int | None = None, support: int = 5,
                spread: float = 0.2, weight: float = 10.0, limit: float = 0.8) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``template``, ``purity`` and ``verdict`` (the rule's, else the template's).
    ``rules``: ``host/path-begin`` to ``allow`` or ``block``. Jobs run when it is called."""
    new = ("host", "path", "rule", "template", "purity", "verdict")
    names, others = carried(pages, new)
    host, path = host_and_path(F.col(f"`{url_col}`"))
    base = pages.select(others, host.alias("host"), path.alias("path"))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    paths = base.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n")).withColumn("verdict", verdict)
    t = paths.select("host", "path", "n", F.when(F.col("verdict").isNotNull(), F.col("n")).otherwise(0).alias("labelled"),
                     F.when(F.col("verdict") == "block", F.col("n")).otherwise(0).alias("bad"),
                     F.filter(F.split("path", "/"), lambda s: s != "").alias("segments"), F.lit("").alias("template"))
    t = staged(t, "paths")
    k = 0
    while (depth is None or k < depth) and _grows(t, k, support):
        longer = staged(_level(t, k, support, spread), "templates")
        dropped(t)
        t, k = longer, k + 1
    t = t.withColumn("template", F.when(F.size("segments") > k, F.concat("template", F.lit("/**"))).otherwise(F.col("template")))
    pure = t.groupBy("host", "template").agg(((F.sum("bad") + weight / 2) / (F.sum("labelled") + weight)).alias("purity"))
    pure = staged(pure, "purity")  # as above
    judged = t.join(pure, ["host", "template"]).select("host", "path", "template", "purity")
    out = base.withColumns({"rule": name, "by_rule": verdict}).join(judged, ["host", "path"], "left")
    by_tree = F.when(F.col("purity") > limit, "block").otherwise("allow")
    return out.select(*(F.col(f"others.`{c}`").alias(c) for c in names), "host", "path", "rule", "template", "purity", F.coalesce("by_rule", by_tree).alias("verdict"))
