"""URL verdicts by rules and a path-template tree, in DataFrame operations only.

Rules (host suffix plus path prefix, longest wins) judge first; what they say
also labels the tree.  Per host the different paths form a tree, worked out level
by level to its real depth.  A segment that looks like an id is a wildcard, and
so is one with less than LITERAL_SHARE of its node's URLs where MANY_CHILDREN
or more are as rare; shares of different URLs are counted, so neither repeated
rows nor the size of the crawl change a template.  Branches are merged where they are
statistically alike: labelled siblings that differ in one literal segment, if their
labelled shares do not differ significantly, and with them unlabelled
siblings whose URLs have the same shape (length and share of digits).  A template
is rejected when the smoothed share of the labelled URLs of its merged branch that
are blocked reaches PURITY and the blocked ones spread over what its
wildcards, and the merged segments, stand for; a URL without a rule takes its
template's verdict.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import written

#: A segment with this share of its node's different URLs is never a wildcard; others are where so many are as rare.
LITERAL_SHARE = 0.05
MANY_CHILDREN = 8
#: Segments with at least this part of the rows are joined by a broadcast.
HEAVY = 1000
PSEUDO_ROWS = 4.0
PURITY = 0.9
#: Blocked URLs must reach this share of the values at every wildcard, and so many of them (or all).
SPREAD, SPREAD_VALUES = 0.1, 8
Z = 1.96
WILD = "*"
ID_SEGMENT = r"^(?:[0-9]+(?:\.[A-Za-z]{2,5})?|[0-9]{4}-[0-9]{2}(?:-[0-9]{2})?|(?=[^/]*[0-9])[0-9A-Fa-f]{8,}|[0-9A-Fa-f-]{36})$"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class UrlRule:
    """``text`` is a host and the beginning of a path, like ``example.com/en/``."""

    text: str
    verdict: str

    def fits(self, host: Column, path: Column) -> Column:
        own, slash, begin = self.text.partition("/")
        return ((host == own) | host.endswith("." + own)) & path.startswith(slash + begin)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    host = F.regexp_extract(F.coalesce(_after_scheme(url), F.lit("")), r"^[^/?#]*", 0)
    return F.translate(host, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(_after_scheme(url), F.lit("")), r"^[^/?#]*([^?#]*)", 1)


def rule_of(rules: Sequence[UrlRule], host: Column, path: Column, value: str) -> Column:
    """``text`` or ``verdict`` of the longest rule that fits, else null."""
    out = None
    for rule in sorted(rules, key=lambda r: (-len(r.text), r.text)):
        fits = rule.fits(host, path)
        out = F.when(fits, F.lit(getattr(rule, value))) if out is None else out.when(fits, F.lit(getattr(rule, value)))
    return F.lit(None).cast("string") if out is None else out


def _segments() -> Column:
    return F.filter(F.split("path", "/"), lambda s: s != "")


def _generalised(segment: Column) -> Column:
    return F.when(segment.rlike(ID_SEGMENT), F.lit(WILD)).otherwise(segment)


def with_templates(urls: DataFrame) -> DataFrame:
    """Different ``urls(host, path, ...)`` with ``template``, the path with wildcards.

    One round a level.  A round counts the children of every node (map-side first,
    so a host with very many URLs is no hot task), decides on them, and joins the
    decisions back: only children that become wildcards, or hold a single URL, are met
    by a join, and of the others those with a thousandth of all URLs or more
    are dealt out one by one.  A URL that is alone below its node has its template at
    once, so rounds go on only where URLs share a beginning, however deep.  Each
    round is written, so none repeats the ones before.
    """
    segments = _segments()
    at = written(urls.withColumns({"segments": segments, "template": F.lit("")}), "url-level")
    names, done, level = [*urls.columns, "template"], [], 0
    while True:
        own = F.get("segments", F.lit(level))
        done.append(at.filter(own.isNull()).select(*names))
        rows = at.filter(own.isNotNull()).withColumn("segment", _generalised(own))
        children = written(rows.groupBy("host", "template", "segment").agg(F.count("*").alias("n")), f"url-children-{level}")
        total = children.agg(F.sum("n")).first()[0]
        if not total:
            break
        nodes = children.groupBy("host", "template").agg(F.sum("n").alias("all"))
        shared = children.join(nodes, ["host", "template"]).withColumn(
            "rare", (F.col("segment") != WILD) & (F.col("n") < F.col("all") * LITERAL_SHARE))
        many = shared.groupBy("host", "template").agg((F.count_if("rare") >= MANY_CHILDREN).alias("many"))
        steps = shared.join(many, ["host", "template"]).withColumn("step", F.when(F.col("rare") & F.col("many"), WILD).otherwise(F.col("segment")))
        below = steps.groupBy("host", "template", "step").agg((F.sum("n") == 1).alias("alone"))
        steps = written(steps.join(below, ["host", "template", "step"]).select("host", "template", "segment", "n", "step", "alone"), f"url-steps-{level}")
        plain = (F.col("step") == F.col("segment")) & ~F.col("alone")
        # at most HEAVY children, whose URLs need no decision: they meet nothing and are dealt one by one
        heavy = steps.filter(plain & (F.col("n") >= total / HEAVY)).select(
            F.col("host").alias("hh"), F.col("template").alias("ht"), F.col("segment").alias("hs"))
        decided = steps.filter(~plain).select(F.col("host").alias("h"), F.col("template").alias("t"), F.col("segment").alias("s"), "step", "alone")
        rows = rows.join(F.broadcast(heavy), (F.col("host") == F.col("hh")) & (F.col("template") == F.col("ht")) & (F.col("segment") == F.col("hs")), "left")
        rows = rows.withColumn("dealt", F.when(F.col("hh").isNotNull(), F.concat(F.lit("/"), F.monotonically_increasing_id().cast("string")))
                               .otherwise(F.col("segment")))
        rows = rows.join(decided, (F.col("host") == F.col("h")) & (F.col("template") == F.col("t")) & (F.col("dealt") == F.col("s")), "left")
        rest = F.transform(F.slice("segments", level + 2, F.greatest(F.size("segments") - level - 1, F.lit(0))), _generalised)
        rows = rows.withColumns({"over": F.coalesce("alone", F.lit(False)), "template": F.concat_ws(
            "/", "template", F.coalesce("step", "segment"), F.when(F.coalesce("alone", F.lit(False)) & (F.size(rest) > 0), F.array_join(rest, "/")))})
        at = written(rows.select(*names, "segments", "over"), f"url-level-{level}")
        done.append(at.filter("over").select(*names))
        at, level = at.filter("not over").drop("over"), level + 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def rejected_templates(rows: DataFrame, purity: float = PURITY) -> DataFrame:
    """``(host, template)`` to reject, from ``rows(host, template, bad)``, with a ``path``
    for the shapes of unlabelled branches; ``bad`` is 1, 0 or null (no label).

    Labelled siblings (templates equal but for their last literal segment) are
    ordered by their share; neighbouring shares that do not differ at the Z level are
    merged and pooled.  Each share is tested with its largest template.  A window
    holds a host's different shares, not its templates.  Unlabelled siblings join
    by :func:`like_siblings`.
    """
    shape = [F.avg(F.length("path")).alias("length"), F.avg(F.length(F.regexp_replace("path", "[^0-9]", "")) / F.greatest(F.length("path"), F.lit(1))).alias("digits")] \
        if "path" in rows.columns else []
    every = rows.groupBy("host", "template").agg(
        F.count("bad").cast("double").alias("n"), F.sum("bad").cast("double").alias("bad"), *shape)
    every = written(every, "url-templates")
    leaves = every.filter("n > 0").withColumns({"family": F.regexp_replace("template", r"/[^/*]+((?:/\*)*)$", "/?$1"), "share": F.col("bad") / F.col("n")})
    n, bad = leaves.agg(F.coalesce(F.sum("n"), F.lit(0.0)), F.coalesce(F.sum("bad"), F.lit(0.0))).first()
    base = bad / n if n else 0.0
    steps = leaves.groupBy("host", "family", "share").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.max("n").alias("most"))
    siblings = Window.partitionBy("host", "family").orderBy("share")
    most, last, gap = F.col("most"), F.lag("most").over(siblings), F.col("share") - F.lag("share").over(siblings)
    both = (F.col("share") * most + F.lag("share").over(siblings) * last) / (most + last)
    spread = F.sqrt(both * (1 - both) * (1 / most + 1 / last))
    marked = steps.withColumn("fresh", F.coalesce((gap > spread * Z).cast("int"), F.lit(0)))
    marked = marked.withColumn("branch", F.sum("fresh").over(siblings.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    merged = Window.partitionBy("host", "family", "branch")
    smooth = (F.sum("bad").over(merged) + PSEUDO_ROWS * base) / (F.sum("n").over(merged) + PSEUDO_ROWS)
    high = marked.withColumn("purity", smooth).filter(F.col("purity") >= purity).select("host", "family", "share")
    found = leaves.join(high, ["host", "family", "share"]).select("host", "template")
    return found.unionByName(like_siblings(every, written(found, "url-pure"))) if shape else found


def branches(templates: DataFrame) -> DataFrame:
    """``templates(host, template, n, length, digits)`` once for each branch they may belong to:
    equal but for the first, or the last, literal segment, and of one shape (``shape``:
    length in steps of a half power of two, share of digits in quarters)."""
    first = F.regexp_replace("template", r"^((?:/\*)*)/[^/*]+", "$1/?")
    last = F.regexp_replace("template", r"/[^/*]+((?:/\*)*)$", "/?$1")
    families = F.filter(F.array_distinct(F.array(first, last)), lambda f: f != F.col("template"))
    shape = F.concat_ws("|", F.round(F.log2(F.greatest("length", F.lit(1.0))) * 2).cast("int"), F.round(F.col("digits") * 4).cast("int"))
    return templates.withColumn("shape", shape).withColumn("family", F.explode(families))


def like_siblings(templates: DataFrame, pure: DataFrame) -> DataFrame:
    """Unlabelled templates in a merged branch whose labelled ones are all in ``pure``, if
    these are a SPREAD share of the branch's segments and at least SPREAD_VALUES (or all)."""
    rows = branches(templates.join(pure.withColumn("pure", F.lit(1)), ["host", "template"], "left"))
    whole = rows.groupBy("host", "family", "shape").agg(F.count("*").alias("kinds"), F.count_if(F.col("n") > 0).alias("labelled"), F.count("pure").alias("pure"))
    speaks = (F.col("labelled") == F.col("pure")) & (F.col("pure") >= F.col("kinds") * SPREAD) & (F.col("pure") >= F.least("kinds", F.lit(SPREAD_VALUES)))
    like = whole.filter(speaks & (F.col("kinds") > F.col("pure"))).select("host", "family", "shape")
    return rows.filter("n = 0").join(like, ["host", "family", "shape"]).select("host", "template").distinct()


def lopsided_templates(rows: DataFrame, templates: DataFrame) -> DataFrame:
    """Those of ``templates(host, template)`` whose blocked rows do not speak for
    the rest, from ``rows(host, path, template, bad)``.

    At each wildcard the different values are counted: blocked URLs must have a
    SPREAD share of them, and at least SPREAD_VALUES or all.  Templates without
    an unlabelled URL, or without a labelled one, need no look.
    """
    mixed = (rows.join(templates, ["host", "template"], "left_semi").groupBy("host", "template")
             .agg(F.count("*").alias("n"), F.count("bad").alias("told")).filter("told > 0 and told < n").select("host", "template"))
    steps = F.split(F.substring(F.col("template"), 2, 1 << 30), "/")
    values = F.filter(F.transform(_segments(), lambda v, i: F.struct(
        i.alias("at"), v.alias("value"), (F.get(steps, i) == WILD).alias("wild"))), lambda e: e["wild"])
    held = rows.join(mixed, ["host", "template"], "left_semi").select("host", "template", "bad", F.explode(values).alias("e"))
    kinds = held.groupBy("host", "template", "e.at", "e.value").agg(F.coalesce(F.max("bad"), F.lit(0)).alias("bad"))
    places = kinds.groupBy("host", "template", "at").agg(F.count("*").alias("kinds"), F.sum("bad").alias("bad"))
    few = (F.col("bad") < F.col("kinds") * SPREAD) | (F.col("bad") < F.least("kinds", F.lit(SPREAD_VALUES)))
    return places.filter(few).select("host", "template").distinct()


def judge_urls(pages: DataFrame, rules: Sequence[UrlRule], id_col: str = "page_id", url: str = "url", purity: float = PURITY) -> DataFrame:
    """``(id, host, path, rule, verdict, template)`` for every row of ``pages``.

    Null URLs and URLs without ``://`` have an empty host and path, which no rule
    fits.  The tree holds every different host and path once, so repeated rows
    change no verdict; a URL may be of any length and depth.  An empty
    table gives no rows.  Other columns are not read.
    """
    rows = pages.select(F.col(id_col).alias("id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    host, path = F.col("host"), F.col("path")
    said = rule_of(rules, host, path, "verdict")
    urls = rows.select("host", "path").distinct().withColumn("bad", F.when(said.isNotNull(), (said == "block").cast("int")))
    tree = written(with_templates(urls), "url-tree")
    drop = written(rejected_templates(tree, purity), "url-rejected")
    drop = drop.join(lopsided_templates(tree, drop), ["host", "template"], "left_anti").distinct()
    met = tree.join(drop.withColumn("dropped", F.lit(True)), ["host", "template"], "left").select(
        F.col("host").alias("h"), F.col("path").alias("p"), "template", "dropped")
    rows = rows.join(met, (F.col("host") == F.col("h")) & (F.col("path") == F.col("p"))).drop("h", "p")
    own = F.when(F.col("dropped"), F.lit("block")).otherwise(F.lit("allow"))
    return rows.select("id", "host", "path", rule_of(rules, host, path, "text").alias("rule"), F.coalesce(said, own).alias("verdict"), "template")
