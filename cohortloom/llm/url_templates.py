"""URL filters: fixed rules by host and path, and a tree of path templates per host.

DataFrame functions only. The tree grows level by level from the host. At a node, the
segments that many urls share stay as they are and the others become wildcards by
their shape; siblings that cannot be told apart, by their labels and by the share of
urls that end there, become one branch. A branch's share of bad labels is drawn
towards that of the node above, and urls whose template ends up above a share are
rejected.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.llm.common import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Endings of a segment that stay beside its wildcard.
ENDINGS = ("html", "htm", "php", "asp", "aspx", "jsp", "pdf", "txt", "xml", "json")
#: Rows of one key that may meet in a task.
HOT_ROWS = 1_000_000


@dataclass(frozen=True)
class UrlRule:
    """Fits ``host`` and its subdomains where the path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (UrlRule("net", "/", "block"), UrlRule("example.net", "/en/", "allow"),
         UrlRule("example.com", "/de/", "block"), UrlRule("org", "/fr/", "allow"))


@dataclass(frozen=True)
class TreeRules:
    """``support``: a segment with fewer urls is variable; ``branching``: so is one with
    less than 1/branching of its node's urls; ``apart``: squared z of two shares from
    which siblings differ; ``weight``: the node above counts as so many labels;
    ``max_bad``: templates with a larger share are rejected; ``levels``: what stands
    behind so many segments is one more segment."""

    support: int = 5
    branching: int = 20
    apart: float = 3.84
    weight: float = 10.0
    max_bad: float = 0.5
    levels: int = 8


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host, A-Z in lower case, and path; both '' without ``://``."""
    text = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substr(text, at + 3)).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: Sequence[UrlRule]) -> Column:
    """The longest rule that fits as a struct of name and verdict, else null. Of rules of
    one length the last in byte order counts."""
    best = F.lit(None)
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        best = F.when(fits, F.struct(
            F.lit(rule.name).alias("name"), F.lit(rule.verdict).alias("verdict"))).otherwise(best)
    return best.cast("struct<name:string,verdict:string>")


def shape(segment: Column) -> Column:
    """Wildcard of a segment: digits, digits among others, or none, and a known ending."""
    ending = F.regexp_extract(segment, rf"\.({'|'.join(ENDINGS)})\z", 0)
    stem = F.substr(segment, F.lit(1), F.length(segment) - F.length(ending))
    kind = (F.when(segment == "", F.lit("")).when(stem.rlike(r"^[0-9]+\z"), F.lit("{n}"))
            .when(stem.rlike("[0-9]"), F.lit("{x}")).otherwise(F.lit("{w}")))
    return F.concat(kind, ending)


def literal(segment: Column) -> Column:
    """The segment with the signs of templates escaped."""
    for sign, code in (("{", "%7B"), ("}", "%7D"), ("|", "%7C")):
        segment = F.replace(segment, F.lit(sign), F.lit(code))
    return F.concat(F.lit("="), segment)


def spread_join(rows: DataFrame, table: DataFrame, keys: Sequence[str], values: Sequence[str],
                weight: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Left join of rows to a table of one row per key, which knows its number of rows.

    Keys with more than ``hot_rows`` rows, at most rows / hot_rows of them, are sent to
    all tasks; their rows take part in the shuffled join under scattered keys. Keys
    are never null.
    """
    held = F.struct(*values)
    hot = table.where(F.col(weight) > hot_rows).select(*keys, held.alias("_hot"))
    cold = table.where(F.col(weight) <= hot_rows).select(
        *keys, held.alias("_cold"), F.lit(0).cast("long").alias("_salt"))
    salted = rows.join(F.broadcast(hot), list(keys), "left").withColumn(
        "_salt", F.when(F.col("_hot").isNull(), F.lit(0).cast("long"))
        .otherwise(F.xxhash64(*rows.columns).bitwiseOR(F.lit(1))))
    joined = salted.join(cold, [*keys, "_salt"], "left").withColumn(
        "_held", F.coalesce("_hot", "_cold"))
    return joined.select(*(F.col(c) for c in rows.columns if c not in values),
                         *(F.col(f"_held.{v}").alias(v) for v in values))


def drawn_in(bad: Column, labelled: Column, towards: Column, weight: float) -> Column:
    return (bad + F.lit(weight) * towards) / (labelled + F.lit(weight))


def apart(a: Column, n: Column, b: Column, m: Column, limit: float) -> Column:
    """Whether the shares a/n and b/m differ by a squared z above ``limit``; never where
    one has nothing to show. Free of division."""
    a, n, b, m = (x.cast("double") for x in (a, n, b, m))
    both = a + b
    gap = a * m - b * n
    return gap * gap * (n + m) > F.lit(limit) * both * (n + m - both) * n * m


def branches_of(rows: DataFrame, rules: TreeRules, hot_rows: int) -> DataFrame:
    """Per node a map from each kind of segment to its branch: the new node's name and rate.

    ``rows`` stand at the node with their next segment. A node has at most ``branching``
    kept segments and a fixed number of shapes, so the windows over its branches and
    the map are small, however many urls it has.
    """
    sums = [F.sum(c).alias(c) for c in ("n", "labelled", "bad", "ends")]
    kinds = ["host", "node", "branch", "shape"]

    def together(df: DataFrame, keys: Sequence[str]) -> DataFrame:
        return df.groupBy(*keys).agg(*sums, F.max("rate").alias("rate"), F.sum("rows").alias("rows"))

    children = together(rows.withColumn("rows", F.lit(1)), ["host", "node", "segment"])
    # Segments of few urls are variable whatever their node is like, and are put together
    # by their shape before the nodes meet their segments.
    shaped = together(children.withColumns({
        "shape": shape(F.col("segment")),
        "branch": F.when(F.col("n") >= rules.support, literal(F.col("segment")))}), kinds)
    nodes = shaped.groupBy("host", "node").agg(
        F.sum("n").alias("node_n"), F.count(F.lit(1)).alias("_children"))
    sized = spread_join(shaped, nodes, ["host", "node"], ["node_n"], "_children", hot_rows)
    kept = F.col("branch").isNotNull() & (F.col("n") * rules.branching >= F.col("node_n"))
    branches = together(sized.withColumn(
        "branch", F.when(kept, F.col("branch")).otherwise(F.col("shape"))), ["host", "node", "branch"])
    order = Window.partitionBy("host", "node").orderBy(
        drawn_in(F.col("bad"), F.col("labelled"), F.col("rate"), rules.weight),
        F.col("ends") / F.col("n"), "branch")

    def before(name: str) -> Column:
        return F.lag(name).over(order)

    differ = (
        apart(F.col("bad"), F.col("labelled"), before("bad"), before("labelled"), rules.apart)
        | apart(F.col("ends"), F.col("n"), before("ends"), before("n"), rules.apart))
    grouped = branches.withColumn("_new", F.coalesce(differ, F.lit(False)).cast("int"))
    grouped = grouped.withColumn("_group", F.sum("_new").over(order))
    group = Window.partitionBy("host", "node", "_group")
    rate = drawn_in(F.sum("bad").over(group), F.sum("labelled").over(group), F.col("rate"),
                    rules.weight)
    names = F.sort_array(F.collect_list("branch").over(group))
    named = grouped.select(
        "host", "node", "branch", "rows", F.struct(
            F.concat(F.col("node"), F.lit("/"), F.array_join(names, "|")).alias("node"),
            rate.alias("rate")).alias("_to"))
    return named.groupBy("host", "node").agg(
        F.map_from_entries(F.collect_list(F.struct("branch", "_to"))).alias("branches"),
        F.sum("rows").alias("rows"))


def path_templates(urls: DataFrame, rules: TreeRules | None = None, *,
                   hot_rows: int = HOT_ROWS) -> DataFrame:
    """Per distinct (host, path): its template, and the template's rate of bad labels.

    ``urls`` has host, path and bad (1, 0, or null without a label), never null but for
    the last. Equal paths are counted first. The rate of a host is drawn towards that of
    all; without any label all rates are 0. Each level is stored once.
    """
    rules = rules or TreeRules()
    paths = urls.groupBy("host", "path").agg(
        F.count(F.lit(1)).alias("n"), F.count("bad").alias("labelled"),
        F.coalesce(F.sum("bad"), F.lit(0)).cast("long").alias("bad"))
    split = F.split("path", "/")
    deep = F.size(split) > rules.levels + 2
    cut = F.when(deep, F.concat(
        F.slice(split, 2, rules.levels),
        F.array(F.array_join(F.slice(split, rules.levels + 2, F.size(split)), "/")))
    ).otherwise(F.slice(split, 2, rules.levels + 1))
    paths = written(paths.withColumn("segments", cut), "paths")
    overall = paths.agg(F.coalesce(F.try_divide(F.sum("bad"), F.sum("labelled")), F.lit(0.0))
                        .alias("rate"), F.max(F.size("segments")).alias("depth")).first()
    hosts = paths.groupBy("host").agg(
        F.sum("bad").alias("_bad"), F.sum("labelled").alias("_labelled"),
        F.count(F.lit(1)).alias("_rows")).select("host", "_rows", drawn_in(
            F.col("_bad"), F.col("_labelled"), F.lit(overall.rate), rules.weight).alias("rate"))
    rows = spread_join(paths, hosts, ["host"], ["rate"], "_rows", hot_rows).withColumn(
        "node", F.lit(""))
    done = rows.where(F.size("segments") == 0)
    for level in range(overall.depth or 0):
        here = rows.where(F.size("segments") > level).withColumns({
            "segment": F.get("segments", F.lit(level)),
            "ends": F.when(F.size("segments") == level + 1, F.col("n")).otherwise(F.lit(0))})
        moved = spread_join(here, branches_of(here, rules, hot_rows), ["host", "node"],
                            ["branches"], "rows", hot_rows)
        to = F.coalesce(F.try_element_at("branches", literal(F.col("segment"))),
                        F.try_element_at("branches", shape(F.col("segment"))))
        moved = moved.withColumn("_to", to).withColumns(
            {"node": F.col("_to.node"), "rate": F.col("_to.rate")})
        rows = written(moved.select(*rows.columns), "url-level")
        done = done.unionByName(rows.where(F.size("segments") == level + 1))
    return done.select("host", "path", F.col("node").alias("template"), "rate", "n")


def judge_urls(pages: DataFrame, labels: DataFrame, rules: Sequence[UrlRule] = RULES,
               tree: TreeRules | None = None, *, key: str = "page_id", url: str = "url",
               label_key: str = "page_id", bad: str = "bad",
               hot_rows: int = HOT_ROWS) -> DataFrame:
    """Per row of ``pages``: key, host, path, rule, verdict, template and bad_rate.

    A fitting rule decides; else a url is blocked when the smoothed share of bad labels
    of its template is above ``max_bad``. ``labels`` has one ``bad`` of 0 or 1 per key;
    of several the largest counts, and rows without a key or value are left out. Null
    urls, and those without ``://``, have an empty host and path and are judged as
    such. Repeated rows are judged each; an empty table gives no rows; without labels
    everything no rule blocks is allowed. Very long urls are cut at ``levels``
    segments, the rest being one. Other columns are not read.
    """
    tree = tree or TreeRules()
    host, path = url_parts(F.col(url))
    marks = labels.where(F.col(label_key).isNotNull() & F.col(bad).isNotNull()).groupBy(
        F.col(label_key).alias("_label_key")).agg(F.max(bad).alias("_bad"))
    narrow = pages.select(F.col(key).alias("key"), host.alias("host"), path.alias("path"))
    # Rows without a key have no label; they are kept off the join's shuffle.
    marked = narrow.where(F.col("key").isNotNull()).join(
        marks, F.col("key") == F.col("_label_key"), "left").select(
            "key", "host", "path", F.col("_bad").cast("int").alias("bad"))
    marked = marked.unionByName(narrow.where(F.col("key").isNull()).withColumn(
        "bad", F.lit(None).cast("int")))
    marked = written(marked, "urls")
    templates = path_templates(marked, tree, hot_rows=hot_rows)
    judged = spread_join(marked.drop("bad"), templates, ["host", "path"], ["template", "rate"],
                         "n", hot_rows)
    judged = judged.withColumn("_rule", fitting_rule(F.col("host"), F.col("path"), rules))
    verdict = F.when(F.col("rate") > tree.max_bad, F.lit("block")).otherwise(F.lit("allow"))
    return judged.select(
        F.col("key").alias(key), "host", "path", F.col("_rule.name").alias("rule"),
        F.coalesce("_rule.verdict", verdict).alias("verdict"), "template",
        F.col("rate").alias("bad_rate"))
