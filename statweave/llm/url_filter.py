"""URL filter: listed rules first, then a path-template tree with smoothed purity.

Native: only DataFrame expressions, aggregations and joins.

The tree is built per host. A path is cut at ``/``; segments that look variable
(numbers, hex, UUIDs, mixed letters and digits) become class wildcards at once, which
leaves few different *skeletons* per host; everything after that works on one row per
(host, skeleton), so a hot host is pre-aggregated in the scan's tasks. Then, level by
level, siblings fall into groups (mostly blocked, mostly allowed, without labels), so that a
branch without labels never shares a template with labelled ones that have support. Inside its group
a branch becomes a wildcard when neither its labelled block rate nor the shares of what
follows it differ from its siblings' by more than a Hoeffding bound, or when it has little support; a
branch of little support and no labels joins the largest group. A wildcard is ``*`` and the name of its group, so groups stay apart on all
hosts. A branch grows as long as its prefix has support and segments; the depth comes from the data,
and a prefix without support keeps the rest of its skeleton as it is.

Labels are the verdicts of the rules. A template's purity is its labelled block rate,
smoothed towards the rate of the same template on all hosts, which is itself smoothed
towards the overall rate; a template with a purity of ``threshold`` or more is blocked, if
any of its URLs on any host has a label.

Defined cases: a null URL or one without ``://`` has empty host and path, no rule and the
verdict of the template of the empty path on the empty host. Repeated rows are judged
alike. An empty table gives no rows. Of rules of equal length the later one in the order of
their patterns holds; of equally large groups the first by name. URLs of any length are parsed
whole. Columns other than the id and the URL are not read, so theirs may have any name.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statweave.llm.base import Renamed, ascii_lower
from statweave.plans.staging import stage_table


@dataclass(frozen=True)
class Rule:
    """``pattern`` is host and path, such as ``example.com/en/``."""

    pattern: str
    verdict: str

    @property
    def host(self) -> str:
        return self.pattern.partition("/")[0]

    @property
    def path(self) -> str:
        return "".join(self.pattern.partition("/")[1:])


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#``; path: then up to ``?``, ``#``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = ascii_lower(F.regexp_extract(rest, r"^([^/?#]*+)", 1))
    path = F.regexp_extract(rest, r"^[^/?#]*+([^?#]*+)", 1)
    return host, path


def rule_of(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """The longest fitting rule's pattern and verdict; null where none fits."""
    pattern, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.pattern), r.pattern)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        pattern = F.when(fits, rule.pattern).otherwise(pattern)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return pattern, verdict


def segment_class(segment: Column) -> Column:
    """A wildcard for a segment that varies by its form; other segments stay."""
    ending = F.regexp_extract(segment, r"(\.[A-Za-z][A-Za-z0-9]{0,4})$", 1)
    stem = F.substring(segment, F.lit(1), F.length(segment) - F.length(ending))
    form = (
        F.when(stem.rlike(r"^[0-9]+$"), "{num}")
        .when(stem.rlike(r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"), "{uuid}")
        .when(stem.rlike(r"^[0-9a-fA-F]{8,}$"), "{hex}")
        .when(stem.rlike(r"[0-9].*[0-9]") | (F.length(stem) > 40), "{mix}")
    )
    return F.when(form.isNull(), segment).otherwise(F.concat(form, ending))


def skeleton_of(path: Column) -> Column:
    """The classed segments."""
    return F.transform(F.split(F.regexp_replace(path, "^/", ""), "/"), segment_class)


def template_table(skeletons: DataFrame, support: int, delta: float) -> DataFrame:
    """(host, skeleton) → template, from rows host, skeleton, n, labelled, blocked.

    A level reads its nodes twice, so each level's tables are staged; plans stay short.
    """
    node, done, level = skeletons.withColumn("prefix", F.array().cast("array<string>")), None, 0
    while True:
        judged = _steps(node, level, support, delta)
        grown = stage_table(
            node.withColumn("here", F.coalesce(F.get("skeleton", F.lit(level)), F.lit("")))
            .join(judged, ["host", "prefix", "here"])
            .withColumn("prefix", F.concat("prefix", F.array("step")))
            .drop("here", "step")
        )
        sizes = grown.groupBy("host", "prefix").agg(F.sum("n").alias("size"))
        level += 1
        open_ = (F.col("size") >= support) & (F.size("skeleton") > level)
        marked = stage_table(grown.join(sizes, ["host", "prefix"]).withColumn("open", open_).drop("size"))
        rest = F.slice("skeleton", F.lit(level + 1), F.size("skeleton"))
        closed = marked.where("NOT open").drop("open").withColumn("prefix", F.concat("prefix", rest))
        done = closed if done is None else done.unionByName(closed)
        node = marked.where("open").drop("open")
        if node.isEmpty():
            return done.withColumn("template", F.rtrim(F.concat_ws("/", "prefix"), F.lit("/"))).drop("prefix")


def _steps(node: DataFrame, level: int, support: int, delta: float) -> DataFrame:
    """host, prefix, here and the template's ``step`` of every branch of one level."""
    here = F.coalesce(F.get("skeleton", F.lit(level)), F.lit(""))
    after = F.get("skeleton", F.lit(level + 1))
    kind = F.when(after.isNull(), "end").when(after.rlike(r"^\{"), "var").otherwise("word")
    parts = ("n", "labelled", "blocked", "end", "var", "word")
    group = F.when(F.col("labelled") == 0, "none").when(2 * F.col("blocked") >= F.col("labelled"), "block").otherwise("allow")
    branch = stage_table(
        node.withColumns({"here": here, "kind": kind})
        .groupBy("host", "prefix", "here")
        .agg(
            *[F.sum(c).alias(c) for c in ("n", "labelled", "blocked")],
            *[F.sum(F.when(F.col("kind") == k, F.col("n")).otherwise(0)).alias(k) for k in ("end", "var", "word")],
        )
        .withColumn("group", F.when((F.col("n") >= support) | (F.col("labelled") > 0), group))
    )
    pool = branch.groupBy("host", "prefix", "group").agg(*[F.sum(c).alias(f"all_{c}") for c in parts], F.count("*").alias("branches"))
    largest = pool.groupBy("host", "prefix").agg(
        F.min(F.when(F.col("group").isNotNull(), F.struct((-F.col("all_n")).alias("n"), "group")))["group"].alias("main"),
        F.sum("branches").alias("siblings"),
    )

    def near(part: str, whole: str) -> Column:
        """The branch's share differs from its group's others by less than the bound."""
        mine, others = F.col(whole), F.col(f"all_{whole}") - F.col(whole)
        bound = F.lit(delta) * (1 / F.sqrt(mine) + 1 / F.sqrt(others))
        gap = F.abs(F.col(part) / mine - (F.col(f"all_{part}") - F.col(part)) / others)
        return F.when((mine > 0) & (others > 0), gap < bound).otherwise(True)

    alike = near("blocked", "labelled") & near("end", "n") & near("var", "n") & near("word", "n") & (F.col("branches") > 1)
    literal = F.col("here").rlike(r"^\{") | (F.col("here") == "") | (F.col("siblings") == 1)
    wild = F.concat(F.lit("*"), F.coalesce("group", "main", F.lit("none")))
    step = F.when(literal, F.col("here")).when((F.col("n") < support) | alike, wild).otherwise(F.col("here"))
    pools = pool.withColumnRenamed("group", "_group")
    same = (F.col("b.host") == F.col("p.host")) & (F.col("b.prefix") == F.col("p.prefix")) & F.col("b.group").eqNullSafe(F.col("p._group"))
    joined = branch.alias("b").join(pools.alias("p"), same).select("b.*", "p.branches", *[f"p.all_{c}" for c in parts])
    return joined.join(largest, ["host", "prefix"]).select("host", "prefix", "here", step.alias("step"))


def judge_urls(
    pages: DataFrame,
    rules: list[Rule],
    url: str = "url",
    key: str = "page_id",
    support: int = 5,
    confidence: float = 0.95,
    weight: float = 4.0,
    threshold: float = 0.8,
) -> DataFrame:
    """key, host, path, rule, template, purity, verdict of every row of ``pages``."""
    host, path = host_and_path(F.col(url))
    parsed = pages.select(F.col(key).alias("_key"), host.alias("host"), path.alias("path"))
    pattern, listed = rule_of(F.col("host"), F.col("path"), rules)
    ruled = parsed.withColumns({"rule": pattern, "listed": listed, "skeleton": skeleton_of(F.col("path"))})
    skeletons = stage_table(
        ruled.groupBy("host", "skeleton").agg(
            F.count("*").alias("n"),
            F.count("listed").alias("labelled"),
            F.count(F.when(F.col("listed") == "block", 1)).alias("blocked"),
        )
    )
    delta = math.sqrt(math.log(2 / (1 - confidence)) / 2)
    templates = template_table(skeletons, support, delta)
    by_host = templates.groupBy("host", "template").agg(
        F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked")
    )
    by_template = by_host.groupBy("template").agg(F.sum("labelled").alias("t_labelled"), F.sum("blocked").alias("t_blocked"))
    overall = by_host.agg(F.sum("labelled"), F.sum("blocked")).first()

    def smoothed(blocked: Column, labelled: Column, prior: Column) -> Column:
        return (blocked + weight * prior) / (labelled + weight)

    rate = smoothed(F.lit(overall[1] or 0), F.lit(overall[0] or 0), F.lit(0.5))
    shared = by_template.select(
        "template", (F.col("t_labelled") > 0).alias("known"), smoothed(F.col("t_blocked"), F.col("t_labelled"), rate).alias("shared")
    )
    purity = by_host.join(shared, "template").select(
        "host", "template", "known", smoothed(F.col("blocked"), F.col("labelled"), F.col("shared")).alias("purity")
    )
    judged = stage_table(
        templates.select("host", "skeleton", "template").join(purity, ["host", "template"])
    )
    return ruled.join(judged, ["host", "skeleton"], "left").select(
        F.col("_key").alias(key),
        "host",
        "path",
        "rule",
        "template",
        "purity",
        F.coalesce("listed", F.when(F.col("known") & (F.col("purity") >= threshold), "block").otherwise("allow")).alias("verdict"),
    )


def filter_urls(pages: DataFrame, rules: list[Rule], url: str = "url", **options) -> DataFrame:
    """The rows of ``pages`` whose URL is allowed, with their own columns.

    Verdicts are made once per distinct URL; null URLs are judged like the empty one.
    """
    named = pages.select(F.coalesce(F.col(url), F.lit("")).alias("_url")).distinct()
    verdicts = judge_urls(named.withColumn("_id", F.col("_url")), rules, "_url", "_id", **options)
    allowed = verdicts.where(F.col("verdict") == "allow").select(F.col("_id").alias("_allowed"))
    own = Renamed(pages)
    return own.back(own.df.join(allowed, F.coalesce(F.col(own.name(url)), F.lit("")) == F.col("_allowed"), "left_semi"))
