"""URL filters by a tree of path templates per host, in DataFrame operations only."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.sources.workdir import stored

# A segment holds no slash, so this one marks the end of a path.
WILD, END = "*", "/"
# A segment that is plainly variable, and its extension.
VARIABLE = r"^(?:[0-9]+|[0-9a-fA-F]{8,}|[0-9a-fA-F-]{32,})(\.[A-Za-z]{1,5})?\z"
# Levels between two writes: a plan names its input several times a level, and would grow by that factor with each.
_LEVELS = 3
_LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@dataclass(frozen=True)
class Rule:
    """``text`` is host and path, like ``example.org/en/``; the host stands for itself and its subdomains."""

    text: str
    verdict: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return self.text[len(self.host):]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for null and where there is no ``://``."""
    at = F.instr(url, "://")
    after = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(after, r"^([^/?#]*)", 1)
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, *_LOWER), path


def rule_of(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule that fits, else null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):  # a later, longer rule is asked first
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        found = F.when(fits, F.lit(rule.text)).otherwise(found)
    return found


def shape(path: Column) -> Column:
    """Segments of a path; those that are plainly variable (numbers, long hexadecimal, either with an extension) become a wildcard with its extension."""
    segment = F.split(F.regexp_replace(path, r"^/", ""), "/", -1)
    return F.transform(segment, lambda s: F.regexp_replace(s, VARIABLE, "*$1"))


def _generalised(tree: DataFrame, level: int, max_children: int, rare: float) -> DataFrame:
    """One level of the tree: literal segments of a crowded branch that are each rare in it become a wildcard."""
    tree = tree.withColumn("segment", F.when(F.size("segments") > level, F.col("segments")[level]).otherwise(F.lit(END)))
    children = tree.groupBy("host", "prefix", "segment").agg(F.sum("n").alias("n"))
    branches = children.groupBy("host", "prefix").agg(F.count("*").alias("k"), F.sum("n").alias("total"))
    wild = (F.col("segment") != END) & (F.col("k") > max_children) & (F.col("n") < rare * F.col("total"))
    tokens = children.join(branches, ["host", "prefix"]).select(
        "host", "prefix", "segment", F.when(wild, F.lit(WILD)).otherwise(F.col("segment")).alias("token"))
    longer = F.when(F.col("token") == END, F.col("prefix")).otherwise(F.concat("prefix", F.lit("/"), "token"))
    return tree.join(tokens, ["host", "prefix", "segment"]).withColumn("prefix", longer).drop("segment", "token")


def _merged(leaves: DataFrame, level: int, z: float) -> DataFrame:
    """Branches of a node that don't differ in purity become one, ``{*}`` at that depth of the template.

    A branch is compared with its siblings of the same template elsewhere taken together: it stays apart where the
    shares of bad labels differ by over ``z`` standard errors, and is merged otherwise, unlabelled ones too.
    """
    parts = F.split("template", "/", -1)
    named = (leaves.groupBy("host", "template").agg(F.sum("bad").alias("bad"), F.sum("labelled").alias("labelled"))
             .where(F.size(parts) > level)
             .withColumn("sibling", F.concat_ws("/", F.transform(parts, lambda p, i: F.when(i == level, F.lit("{*}")).otherwise(p)))))
    pooled = named.groupBy("host", "sibling").agg(F.sum("bad").alias("all_bad"), F.sum("labelled").alias("all_labelled"), F.count("*").alias("k"))
    both = named.join(pooled.where("k > 1"), ["host", "sibling"])
    rest, rest_bad = F.col("all_labelled") - F.col("labelled"), F.col("all_bad") - F.col("bad")
    share = F.try_divide(F.col("all_bad"), F.col("all_labelled"))
    error = F.sqrt(share * (1 - share) * (F.try_divide(F.lit(1.0), F.col("labelled")) + F.try_divide(F.lit(1.0), rest)))
    apart = F.abs(F.try_divide(F.col("bad"), F.col("labelled")) - F.try_divide(rest_bad, rest)) > z * error
    moved = both.where(~F.coalesce(apart, F.lit(False))).select("host", "template", F.col("sibling").alias("merged"))
    return (leaves.join(moved, ["host", "template"], "left")
            .withColumn("template", F.coalesce("merged", "template")).drop("merged"))


def _grown(shapes: DataFrame, depth: int, max_children: int, rare: float) -> DataFrame:
    """Each shape with its whole template as ``prefix``, level by level as long as paths have company.

    Every few levels the rows are written. A path that is alone on its template has no branch ahead, so the rest of it is taken over as it
    is: passes grow with the depth to which paths branch, not with the longest of them.
    """
    grown, ended, level = shapes.withColumn("prefix", F.lit("")), [], 0
    while True:
        for _ in range(min(_LEVELS, depth - level)):
            grown, level = _generalised(grown, level, max_children, rare), level + 1
        if level >= depth:
            return reduce(DataFrame.unionByName, ended, grown)
        grown = stored(grown, "url-level")
        further = grown.where(F.size("segments") > level)
        company = further.groupBy("host", "prefix").agg(F.count("*").alias("company"))
        further = further.join(company, ["host", "prefix"])
        rest = F.concat_ws("/", "prefix", F.slice("segments", level + 1, F.size("segments")))
        ended += [grown.where(F.size("segments") <= level), further.where("company = 1").withColumn("prefix", rest).drop("company")]
        grown = further.where("company > 1").drop("company")
        depth = grown.agg(F.coalesce(F.max(F.size("segments")), F.lit(0))).first()[0]


def _branching(leaves: DataFrame) -> list[int]:
    """Levels at which two templates of a host and length part, the deepest first: where branches can merge at all.

    Siblings are equal but for one level. Merging goes from the deepest level up, so what is above a level is as it was.
    """
    parts = F.split("template", "/", -1)
    at = F.explode(F.sequence(F.lit(1), F.size("parts") - 1)).alias("level")
    ways = leaves.select("host", parts.alias("parts")).where(F.size("parts") > 1).select("host", "parts", at).select(
        "host", "level", F.size("parts").alias("n"), F.xxhash64(F.slice("parts", F.lit(1), F.col("level"))).alias("above"), F.col("parts")[F.col("level")].alias("part"))
    forks = ways.groupBy("host", "n", "level", "above").agg(F.min("part").alias("least"), F.max("part").alias("most")).where("least <> most")
    return sorted((r["level"] for r in forks.select("level").distinct().collect()), reverse=True)


def tree(shapes: DataFrame, depth: int, max_children: int, rare: float, z: float) -> DataFrame:
    """(host, path, template, bad, labelled) of each shape (host, path, segments, n, bad, labelled); counts are the template's.

    ``depth`` is the greatest number of segments. Templates come level by level to the end of every path; then branches
    merge from the deepest level up, at the levels where any can.
    """
    grown = _grown(shapes, depth, max_children, rare)
    way = stored(grown.select("host", "path", F.col("prefix").alias("leaf"), "bad", "labelled"), "url-tree")
    leaves = way.groupBy("host", "leaf").agg(F.sum("bad").alias("bad"), F.sum("labelled").alias("labelled")).withColumn("template", F.col("leaf"))
    levels = list(range(depth, 0, -1))
    if depth > _LEVELS:
        leaves = stored(leaves, "url-leaves")
        levels = _branching(leaves)
    columns = leaves.columns
    for i, level in enumerate(levels):
        if i and i % _LEVELS == 0:
            leaves = stored(leaves.select(columns), "url-merged")
        leaves = _merged(leaves, level, z)
    leaves = leaves.select("host", "leaf", "template", "bad", "labelled")
    purity = leaves.groupBy("host", "template").agg(F.sum("bad").alias("bad"), F.sum("labelled").alias("labelled"))
    final = leaves.select("host", "leaf", "template").join(purity, ["host", "template"])
    return way.select("host", "path", "leaf").join(final, ["host", "leaf"]).drop("leaf")


def judged(pages: DataFrame, labels: DataFrame, rules: list[Rule], max_children: int = 32,
           rare: float = 0.02, z: float = 1.96, prior: float = 20.0, limit: float = 0.5) -> DataFrame:
    """page_id, url, host, path, rule, template, purity and verdict (allow or block) of every page.

    A page is labelled by the rule that decides it, else by ``labels`` (doc_id, quality, toxic): bad if any of
    its rows has quality 0 or toxic 1. A template's purity is its share of bad labels, smoothed by ``prior`` labels
    of the overall share; from ``limit`` on the template is rejected. A rule's verdict goes before the template's.
    Paths are counted by shape before anything is joined, so a host with a third of all pages is a few rows, and
    joins have one row per key on one side. A null url, or one without ``://``, has empty host and path and a
    template of its own; repeated pages count and are judged each; without labels every template is allowed.
    """
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("page_id")).agg(
        F.max(F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0)).alias("label"))
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", "url", host.alias("host"), path.alias("path")).withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    shapes_of = shape(F.col("path"))
    rows = rows.withColumn("shape", F.concat_ws("/", shapes_of))
    blocked = [r.text for r in rules if r.verdict == "block"]
    by_rule = F.when(F.col("rule").isin(blocked) if blocked else F.lit(False), 1).when(F.col("rule").isNotNull(), 0)
    labelled = rows.join(known, "page_id", "left").withColumn("label", F.coalesce(by_rule, F.col("label")))
    shapes = labelled.groupBy("host", "shape").agg(F.count("*").alias("n"), F.coalesce(F.sum("label"), F.lit(0)).alias("bad"), F.count("label").alias("labelled"))
    shapes = stored(shapes.withColumnRenamed("shape", "path").withColumn("segments", F.split("path", "/", -1)), "url-shapes")
    bad, count, depth = shapes.agg(F.sum("bad"), F.sum("labelled"), F.max(F.size("segments"))).first()
    share = bad / count if count else 0.0
    judged_templates = tree(shapes, depth or 0, max_children, rare, z).select(
        "host", F.col("path").alias("shape"), "template",
        ((F.col("bad") + prior * share) / (F.col("labelled") + prior)).alias("purity"))
    verdict = F.when(by_rule == 1, "block").when(by_rule == 0, "allow").when(F.col("purity") >= limit, "block").otherwise("allow")
    return rows.join(judged_templates, ["host", "shape"]).withColumn("verdict", verdict).select(
        "page_id", "url", "host", "path", "rule", "template", "purity", "verdict")
