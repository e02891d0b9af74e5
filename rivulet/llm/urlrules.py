"""URL filters: listed rules, and association rules mined for what no list judges.

A URL is a transaction of tokens: its scheme, the words of its host, its top-level domain,
first directory, middle directories, page and extension, its query keys and whether it has
a fragment; digits count as one `#`. Each URL adds a bounded number of them besides the
words of its host. From labelled URLs Spark's FP-growth mines the combinations of tokens
and verdict that are frequent. A combination becomes a rule if it has enough support, if
enough of the URLs that hold its tokens have the verdict, and if no rule on some of its
tokens says the same at least as surely.

Rules match by an inverted index: each is filed under its rarest token, so a URL meets the
rules filed under its own tokens, and what it meets is checked on all tokens. The URLs
that have the same tokens are matched once. Of several rules the surest counts, then the
one of more support, of fewer tokens, and the first by text; a URL that no rule matches is
allowed. Everything here is DataFrame code.

Listed rules go first: a rule fits its host and all subdomains of it, if the path starts
with the rule's; the longest counts, and its verdicts are the labels the query mines from.

Defined cases: a null URL, or one without `://`, has an empty host and path and no tokens,
so it is allowed. Repeated rows and ids are judged one by one. Without labelled URLs no
rule is mined. Other columns are not read.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

from rivulet.functions import text
from rivulet.llm.scratch import Scratch

# Verdict, host and path of the listed rules.
LISTED = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]

SUPPORT = 0.01  # share of the labelled URLs that a rule's tokens and verdict have together
CONFIDENCE = 90  # per cent of the labelled URLs with a rule's tokens that have its verdict
LONGEST = 3  # tokens of a rule
DEFAULT = "allow"
_VERDICT = "verdict="


# --- parts of a URL ----------------------------------------------------------


def _rest(url: Column) -> Column:
    """What follows the first `://`; empty for a URL without."""
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def host(url: Column) -> Column:
    return text.lower_ascii(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1))


def path(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _folded(value: Column) -> Column:
    return F.regexp_replace(text.lower_ascii(value), "[0-9]+", "#")


def _some(prefix: str, value: Column) -> Column:
    """The token, or NULL where there is nothing to say."""
    return F.when(value != "", F.concat(F.lit(prefix), value))


def tokens(url: Column) -> Column:
    """The distinct tokens of a URL, in order."""
    where, way, rest = host(url), path(url), _rest(url)
    labels = F.split(_folded(where), "[.]")
    names = F.flatten(
        F.transform(F.slice(labels, 1, F.greatest(F.size(labels) - 1, F.lit(0))), lambda x: F.split(x, "-"))
    )
    steps = F.filter(F.split(_folded(way), "/"), lambda x: x != "")
    size = F.size(steps)
    page = F.coalesce(F.element_at(steps, F.when(size > 0, -1)), F.lit(""))
    middle = F.array_join(F.slice(steps, 2, F.greatest(size - 2, F.lit(0))), "/")
    asked = F.regexp_extract(rest, r"^[^?#]*[?]([^#]*)", 1)
    keys = F.transform(F.split(_folded(asked), "&"), lambda x: F.substring_index(x, "=", 1))
    found = F.concat(
        F.transform(F.filter(names, lambda x: x != ""), lambda x: F.concat(F.lit("name:"), x)),
        F.array(
            _some("scheme:", F.when(rest != "", _folded(F.substring_index(url, "://", 1)))),
            _some("top:", F.element_at(labels, -1)),
            _some("dir:", F.when(size > 1, F.get(steps, F.lit(0)))),
            _some("mid:", middle),
            _some("page:", F.regexp_extract(page, r"(?s)^(.*?)([.][^.]*)?\z", 1)),
            _some("ext:", F.regexp_extract(page, r"[.]([^.]*)\z", 1)),
            _some("query:", F.array_join(F.array_sort(F.array_distinct(keys)), "&")),
            F.when(F.contains(rest, F.lit("#")), F.lit("fragment")),
        ),
    )
    none = F.array().cast("array<string>")
    return F.coalesce(F.array_sort(F.array_distinct(F.array_compact(found))), none)


def listed(
    url: Column, rules: list[tuple[str, str, str]] = LISTED
) -> tuple[Column, Column]:
    """The listed rule that counts, like `net/`, and its verdict; NULL where none fits.

    The list comes with the call; its length does not grow with the data.
    """
    where, way = host(url), path(url)
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, name, start in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r[1], r[2])):
        fits = ((where == name) | F.endswith(where, F.lit("." + name))) & F.startswith(
            way, F.lit(start)
        )
        rule = F.when(fits, F.lit(name + start)).otherwise(rule)
        verdict = F.when(fits, F.lit(said)).otherwise(verdict)
    return rule, verdict


# --- mining ------------------------------------------------------------------


def mine(
    labelled: DataFrame,
    support: float = SUPPORT,
    confidence: int = CONFIDENCE,
    longest: int = LONGEST,
    scratch: Scratch | None = None,
) -> DataFrame:
    """Rules (items, verdict, together, alone, token) from URLs with a verdict.

    `labelled` has `url` and `verdict`, a text. `together` counts the URLs with the items
    and the verdict, `alone` those with the items; `token` is the rarest item, under which
    the rule is filed.
    """
    scratch = scratch or Scratch()
    spark = labelled.sparkSession
    baskets = labelled.where(F.col("verdict").isNotNull()).select(
        F.concat(tokens(F.col("url")), F.array(F.concat(F.lit(_VERDICT), "verdict"))).alias("items")
    )
    if baskets.isEmpty():
        return spark.createDataFrame([], "items array<string>, verdict string, together long, alone long, token string")
    model = FPGrowth(itemsCol="items", minSupport=support).fit(baskets)
    said = F.filter("items", lambda x: F.startswith(x, F.lit(_VERDICT)))
    itemsets = scratch.write(
        model.freqItemsets.select(
            F.array_sort(F.filter("items", lambda x: ~F.startswith(x, F.lit(_VERDICT)))).alias("items"),
            F.substring(F.get(said, F.lit(0)), len(_VERDICT) + 1, 1 << 30).alias("verdict"),
            "freq",
        ).where(F.size("items").between(1, longest)),
        "urlrules-itemsets",
    )
    alone = itemsets.where(F.col("verdict").isNull()).select("items", F.col("freq").alias("alone"))
    together = itemsets.where(F.col("verdict").isNotNull()).withColumnRenamed("freq", "together")
    sure = scratch.write(
        together.join(alone, "items").where(
            100 * F.col("together") >= confidence * F.col("alone")
        ),
        "urlrules-sure",
    )
    # what each rule says without one of its items, or without two
    shorter = F.expr(
        "filter(transform(sequence(1, shiftleft(1, size(items)) - 2),"
        " bits -> filter(items, (x, i) -> (shiftright(bits, i) & 1) = 1)), s -> size(s) > 0)"
    )
    parts = sure.where(F.size("items") > 1).select(
        "items", "verdict", "together", "alone", F.explode(shorter).alias("part")
    )
    simple = sure.select(
        F.col("items").alias("part"),
        "verdict",
        (F.col("together") / F.col("alone")).alias("without"),
    )
    needless = (
        parts.join(simple, ["part", "verdict"])
        .where(F.col("without") >= F.col("together") / F.col("alone"))
        .select("items", "verdict")
        .distinct()
    )
    rules = sure.join(needless, ["items", "verdict"], "left_anti")
    single = alone.where(F.size("items") == 1).select(
        F.col("items")[0].alias("token"), F.col("alone").alias("seen")
    )
    held = rules.select("*", F.explode("items").alias("token")).join(single, "token")
    filed = held.groupBy("items", "verdict", "together", "alone").agg(
        F.min(F.struct("seen", "token")).alias("rarest")
    )
    return filed.select("items", "verdict", "together", "alone", "rarest.token")


def matched(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """tokens, verdict and rule of the token sets (`tokens`, distinct) that a rule matches."""
    met = (
        sets.select("tokens", F.explode("tokens").alias("token"))
        .join(rules, "token")
        .where(F.forall("items", lambda x: F.array_contains("tokens", x)))
    )
    order = F.struct(
        (-F.col("together") / F.col("alone")).alias("doubt"),
        (-F.col("together")).alias("rarity"),
        F.size("items").alias("size"),
        F.array_join("items", " ").alias("rule"),
        "verdict",
    )
    return met.groupBy("tokens").agg(F.min(order).alias("best")).select(
        "tokens", F.col("best.verdict").alias("mined"), F.col("best.rule").alias("mined_rule")
    )


def judge(
    pages: DataFrame,
    rules: list[tuple[str, str, str]] = LISTED,
    support: float = SUPPORT,
    confidence: int = CONFIDENCE,
    longest: int = LONGEST,
) -> DataFrame:
    """page_id, host, path, rule, verdict, mined_rule of every page.

    The listed rules' verdicts are the labels; what they leave open the mined rules judge.
    """
    scratch = Scratch()
    url = F.col("url")
    rule, verdict = listed(url, rules)
    seen = pages.select(
        "page_id", "url", host(url).alias("host"), path(url).alias("path"),
        rule.alias("rule"), verdict.alias("said"),
    )
    found = mine(
        seen.select("url", F.col("said").alias("verdict")), support, confidence, longest, scratch
    )
    own = F.when(F.col("said").isNull(), tokens(url)).otherwise(F.array().cast("array<string>"))
    open_pages = seen.withColumn("tokens", own)
    sets = open_pages.where(F.size("tokens") > 0).select("tokens").distinct()
    # written, so that its size is known and a small one needs no shuffle of the pages
    best = scratch.write(matched(sets, found), "urlrules-matched")
    return open_pages.join(best, "tokens", "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("said", "mined", F.lit(DEFAULT)).alias("verdict"),
        "mined_rule",
    )
