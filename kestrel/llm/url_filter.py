"""URL filters (1): a path-template tree per host, DataFrame functions only.

The urls of a host form a tree of path segments. Level by level, segments that
are variable (numbers, and values that few urls share) become
wildcards, sibling branches whose labelled shares don't differ significantly
merge, and the subtrees go on as one. Shares are smoothed towards a prior: what
the labels of other branches say of a section of the same name at the same
depth, in this host or another, itself smoothed towards the section above. A
template whose smoothed labelled purity is too low is rejected. Explicit rules
come before the tree; the urls that they judge are the labels that the tree
learns from, unless others are given.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

# (verdict, host and path prefix)
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
MIN_SHARE = 0.05       # a value is literal from this share of its branch's urls,
MIN_URLS = 20          # from so many urls,
MIN_LABELS = 3         # or from so many labels on; others are variable
NAMED = 21             # merged children that a template names; of more, the number follows
Z_MERGE = 1.96         # siblings merge unless their shares differ by more standard errors
SMOOTHING = 2.0        # weight of the prior, in labels
NEUTRAL = 0.5          # the prior where no branch has labels
MIN_PURITY = 0.25      # least smoothed share of good labels


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without one."""
    raw = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit(""))
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits (ties: the first given), as struct of ``rule`` and ``verdict``, or null.

    A rule fits its host and all subdomains when the path begins with its path.
    """
    out = None
    for verdict, rule in sorted(rules, key=lambda r: -len(r[1])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        value = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out if out is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def segments(path: Column) -> Column:
    """Path segments with every digit run as ``{n}``."""
    plain = F.regexp_replace(F.regexp_replace(path, "^/", ""), "[0-9]+", "{n}")
    return F.split(plain, "/")


def smoothed(good: Column, labels: Column, prior: Column) -> Column:
    """Share of good labels with ``SMOOTHING`` more of the prior, which gives way to ``NEUTRAL`` as own labels grow."""
    trusted = NEUTRAL + (prior - NEUTRAL) * SMOOTHING / (labels + SMOOTHING)
    return (good + SMOOTHING * trusted) / (labels + SMOOTHING)


def _mean_prior() -> Column:
    """Mean of the column ``prior`` by ``n``, to 0.01; exact sums, so that reruns agree."""
    return F.round(F.sum(F.round(F.col("prior") * 100).cast("long") * F.col("n")) / F.sum("n")) / 100


def template_tree(urls: DataFrame) -> DataFrame:
    """``host, segs, template, good, bad, purity`` of every distinct (host, segments).

    ``urls`` has ``host, segs, label`` (1 good, 0 bad, null unlabelled), a row
    per url. Equal urls are counted before anything is shuffled by branch, and
    every level is written to the shared folder. A child's prior share of good
    labels is that of all other branches' children of its name at its depth,
    smoothed towards its branch's own prior; names without letters or with
    numbers tell nothing and keep the branch's prior, at first ``NEUTRAL``.
    Siblings in order of their smoothed shares merge with the one before unless
    the two shares differ by ``Z_MERGE`` standard errors; branches of which
    neither own nor other labels tell anything merge with each other only.
    Siblings of equal counts, prior (to 0.01) and evidence (to a power of two)
    always merge, so the windows hold one row per different four of them. The
    walk goes on while two paths share a branch; a path that is alone in it is
    completed at once, with the prior of its next segment.
    """
    good, bad = F.sum(F.when(F.col("label") == 1, 1).otherwise(0)), F.sum(F.when(F.col("label") == 0, 1).otherwise(0))
    state = staged(urls.groupBy("host", "segs").agg(F.count(F.lit(1)).alias("n"), good.alias("good"), bad.alias("bad"))
                   .withColumns({"template": F.lit(""), "prior": F.lit(NEUTRAL)}), "templates")

    def prior(good: Column, bad: Column) -> Column:  # what others know of the section, beside the given labels
        other_good, other_bad = F.coalesce(F.col("all_good"), F.lit(0)) - good, F.coalesce(F.col("all_bad"), F.lit(0)) - bad
        known = F.col("all_good").isNotNull() & (other_good + other_bad > 0)
        return F.when(known, F.round((other_good + SMOOTHING * F.col("prior")) / (other_good + other_bad + SMOOTHING), 2)).otherwise(F.col("prior"))

    done, level = [], 0
    while True:
        done.append(state.where(F.size("segs") <= level))
        seg = F.get("segs", F.lit(level))
        here = state.where(F.size("segs") > level).withColumn("seg", seg)
        branch = here.groupBy("host", "template").agg(F.sum("n").alias("all"), F.count(F.lit(1)).alias("paths"))
        told = (here.where((F.col("good") + F.col("bad") > 0) & F.col("seg").rlike(r"\p{L}") & ~F.col("seg").contains("{n}"))
                .groupBy("seg").agg(F.sum("good").alias("all_good"), F.sum("bad").alias("all_bad")))  # one row per name
        here = staged(here.join(branch, ["host", "template"]).join(told, "seg", "left"), "branches")
        left = F.slice("segs", level + 1, F.size("segs"))
        alone = F.concat("template", F.lit("/"), F.array_join(F.transform(left, lambda x: F.when(F.col("n") >= 2, x).otherwise("*")), "/"))
        done.append(here.where("paths = 1").withColumns({"template": alone, "prior": prior(F.col("good"), F.col("bad"))}).select(*state.columns))
        here = here.where("paths > 1")
        if here.isEmpty():
            break
        values = here.groupBy("host", "template", "seg").agg(*[F.sum(c).alias(c) for c in ("n", "good", "bad")], *[
            F.first(c).alias(c) for c in ("all", "all_good", "all_bad")], _mean_prior().alias("prior"))
        literal = (F.col("n") >= 2) & ((F.col("n") >= F.least(MIN_SHARE * F.col("all"), F.lit(MIN_URLS))) | (F.col("good") + F.col("bad") >= MIN_LABELS))
        # a name that others' labels speak of is no variable value
        named = values.withColumn("child", F.when(literal | F.col("all_good").isNotNull(), F.col("seg")).otherwise("*"))
        beside = F.coalesce(F.col("all_good") + F.col("all_bad"), F.lit(0)) - F.col("good") - F.col("bad")
        named = named.withColumns({"prior": prior(F.col("good"), F.col("bad")), "evidence": F.greatest(F.lit(0), beside)})
        named = staged(named.select("host", "template", "seg", "child", "n", "good", "bad", "prior", "evidence"), "children")
        kids = named.groupBy("host", "template", "child").agg(
            F.sum("good").alias("good"), F.sum("bad").alias("bad"), _mean_prior().alias("prior"),
            F.floor(F.log2(F.max("evidence") + F.lit(1))).cast("int").alias("evidence"))  # siblings joined in a wildcard have none
        kids = staged(kids, "siblings")
        like = ["host", "template", "good", "bad", "prior", "evidence"]
        ties = kids.groupBy(*like).agg(F.count(F.lit(1)).alias("kids"))
        ties = ties.withColumn("labels", F.col("good") + F.col("bad"))
        ties = ties.withColumn("share", smoothed(F.col("good"), F.col("labels"), F.col("prior")))
        ties = ties.withColumn("weight", F.col("labels") + F.pow(F.lit(2.0), "evidence") - 1)
        w = Window.partitionBy("host", "template").orderBy((F.col("weight") > 0).cast("int"), "share", "weight", "good", "prior")
        before, weight_before = F.lag("share").over(w), F.lag("weight").over(w)
        error = F.sqrt(F.col("share") * (1 - F.col("share")) / (F.col("weight") + SMOOTHING) + before * (1 - before) / (weight_before + SMOOTHING))
        same = ((F.col("weight") > 0) == (weight_before > 0)) & ((F.col("weight") == 0) | (F.abs(F.col("share") - before) <= Z_MERGE * error))
        ties = ties.withColumn("new", F.when(same, 0).otherwise(1)).withColumn("island", F.sum("new").over(w))
        kids = kids.join(ties.select(*like, "island"), like)
        kids = staged(kids.select("host", "template", "child", "island"), "islands")
        # the smallest names tell islands apart; the limit of the window applies before its shuffle
        first = kids.withColumn("rank", F.row_number().over(Window.partitionBy("host", "template", "island").orderBy("child"))).where(F.col("rank") <= NAMED)
        first = first.groupBy("host", "template", "island").agg(F.array_join(F.sort_array(F.collect_list("child")), "|").alias("name"))
        size = kids.groupBy("host", "template", "island").agg((F.count(F.lit(1)) - NAMED).alias("more"))
        name = F.when(F.col("more") > 0, F.concat("name", F.lit("|+"), "more")).otherwise(F.col("name"))
        islands = first.join(size, ["host", "template", "island"]).select("host", "template", "island", name.alias("name"))
        step = (named.join(kids, ["host", "template", "child"]).join(islands, ["host", "template", "island"])
                .select(F.col("host").alias("_h"), F.col("template").alias("_t"), F.col("seg").alias("_g"), "name", named["prior"].alias("_p")))
        joined = here.join(step, (here["host"] == step["_h"]) & (here["template"] == step["_t"]) & (here["seg"] == step["_g"]))
        state = staged(joined.select("host", "segs", "n", "good", "bad", F.concat("template", F.lit("/"), "name").alias("template"),
                                     F.col("_p").alias("prior")), "templates")
        level += 1
    state = staged(reduce(DataFrame.unionByName, done), "templates")
    pooled = state.groupBy("host", "template").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"),
                                                   _mean_prior().alias("prior"))
    pooled = pooled.withColumn("purity", smoothed(F.col("good"), F.col("good") + F.col("bad"), F.col("prior")))
    return state.select("host", "segs", "template").join(pooled, ["host", "template"])


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, labels: DataFrame | None = None,
               min_purity: float = MIN_PURITY) -> DataFrame:
    """``id, host, path, rule, verdict, template, purity`` of every row.

    ``verdict`` is the rule's, else block where the url's template has a
    smoothed purity below ``min_purity`` and allow elsewhere. ``labels`` (one
    row per id: ``id``, ``label`` 1 or 0) replaces the rules' verdicts as the
    labels of the tree. A url whose template has no labels is judged by the
    prior, what other branches' labels say of its sections. A null url, or one without ``://``, has an empty host
    and path and is judged like the others, in the tree of the empty host.
    Repeated rows count each; an empty table gives an empty result.
    """
    url = F.col("url")
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"))
    rows = rows.select("id", host_of(url).alias("host"), path_of(url).alias("path"))
    rows = rows.withColumn("m", matching_rule(F.col("host"), F.col("path"), rules)).withColumn("segs", segments(F.col("path")))
    if labels is None:
        seen = rows.withColumn("label", F.when(F.col("m.verdict") == "allow", 1).when(F.col("m.verdict") == "block", 0))
    else:
        known = labels.select(F.col("id").cast("long").alias("id"), F.col("label").cast("int").alias("label")).groupBy("id").agg(F.min("label").alias("label"))
        seen = rows.join(known, "id", "left")
    tree = staged(template_tree(seen.select("host", "segs", "label")), "tree")
    out = rows.join(tree, ["host", "segs"])
    verdict = F.coalesce(F.col("m.verdict"), F.when(F.col("purity") < min_purity, "block").otherwise("allow"))
    return out.select("id", "host", "path", F.col("m.rule").alias("rule"), verdict.alias("verdict"), "template", "purity")
