"""URL filter (operator 5): host and path rules, and gradient-boosted trees on
lexical features for the URLs no rule decides.

Main path: DataFrame functions and ``pyspark.ml`` only.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SAMPLE = 20_000            # bound of the training sample, in distinct labelled URLs
PRIOR = 10.0               # weight of the overall block rate in a suffix rate
FOLDS = 5                  # a labelled URL's suffix rates come from the other folds
NUMERIC = ("url_chars", "host_chars", "path_chars", "depth", "host_labels", "digit_ratio",
           "entropy", "n_params", "query_chars", "symbols")
SUFFIXES = ("tld", "domain", "folder", "extension")


@dataclass(frozen=True)
class Rule:
    """``verdict`` for ``host`` and its subdomains where the path starts with
    ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: The rules of the production query.
RULES = (Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"),
         Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"))


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in
    lower case; empty for a null URL or one without ``://``."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def fits(rule: Rule, host: Column, path: Column) -> Column:
    return ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)


def longest(rules) -> list[Rule]:
    return sorted(rules, key=lambda r: (-len(r.text), r.text))


def first_fit(rules, host: Column, path: Column, value) -> Column:
    """``value(rule)`` of the longest rule that fits, else null."""
    cases = [F.when(fits(r, host, path), F.lit(value(r))) for r in longest(rules)]
    return F.coalesce(*cases, F.lit(None).cast("string"))


def entropy(s: Column) -> Column:
    """Bits per character of the character distribution."""
    counts = F.transform(F.array_distinct(F.split(s, "")),
                         lambda c: F.length(s) - F.length(F.replace(s, c, F.lit(""))))
    n = F.length(s).cast("double")
    return F.when(n > 0, F.aggregate(
        F.filter(counts, lambda c: c > 0), F.lit(0.0),
        lambda a, c: a - (c / n) * F.log2(c / n))).otherwise(F.lit(0.0))


def features(df: DataFrame) -> DataFrame:
    """Lexical features of ``url``, ``host`` and ``path`` (never null)."""
    url = F.coalesce(F.col("url"), F.lit(""))
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    digits = F.length(F.translate(url, "0123456789", ""))
    labels = F.split("host", r"\.")
    folders = F.array_remove(F.split("path", "/"), "")
    last = F.coalesce(F.get(folders, F.size(folders) - 1), F.lit(""))
    return df.withColumns({
        "url_chars": F.length(url), "host_chars": F.length("host"), "path_chars": F.length("path"),
        "depth": F.size(folders),
        "host_labels": F.size(labels),
        "digit_ratio": (F.length(url) - digits) / F.greatest(F.length(url), F.lit(1)),
        "entropy": entropy(url),
        "n_params": F.when(query == "", 0).otherwise(F.size(F.split(query, "&"))),
        "query_chars": F.length(query),
        "symbols": F.length(url) - F.length(F.translate(url, "-_%~=@", "")),
        "tld": F.element_at(labels, -1),
        "domain": F.concat_ws(".", F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2)),
        "folder": F.coalesce(F.get(folders, F.lit(0)), F.lit("")),
        "extension": F.regexp_extract(last, r"\.([A-Za-z0-9]{1,8})$", 1),
    })


def fold(url: Column) -> Column:
    """Fold of a URL, 0 to ``FOLDS - 1``; all rows of a URL share it."""
    return F.pmod(F.xxhash64(F.lit("fold"), url), F.lit(FOLDS)).cast("int")


def suffix_rates(labelled: DataFrame, suffix: str) -> DataFrame:
    """Per suffix, labelled rows (``n``) and blocked rows (``b``) in all and by
    fold, over all labelled URLs."""
    def per_fold(value):
        return F.array(*[F.sum(F.when(F.col("fold") == f, value).otherwise(0.0)) for f in range(FOLDS)])
    return labelled.groupBy(suffix).agg(
        F.struct(per_fold(F.lit(1.0)).alias("ns"), per_fold(F.col("label")).alias("bs"),
                 F.count("*").alias("n"), F.sum("label").alias("b")).alias(f"{suffix}_seen"))


def rate_of(suffix: str, base: float) -> Column:
    """Block rate of the suffix, drawn towards the overall rate ``base``.  A
    labelled row sees the other folds only, so neither its own label nor that
    of its copies is in it; other rows see all."""
    seen = F.col(f"{suffix}_seen")
    own = F.col("label").isNotNull()
    b = seen.b - F.when(own, F.get(seen.bs, F.col("fold"))).otherwise(0.0)
    n = seen.n - F.when(own, F.get(seen.ns, F.col("fold"))).otherwise(0.0)
    return F.coalesce((b + F.lit(PRIOR * base)) / (n + F.lit(PRIOR)), F.lit(base)).alias(f"{suffix}_rate")


def judge(df: DataFrame, rules=RULES, page_id: str = "page_id", url: str = "url",
          sample: int = SAMPLE, trees: int = 20, depth: int = 4, hide: Column | None = None) -> DataFrame:
    """Verdict of every URL: ``page_id, host, path, rule, verdict, score``.

    The longest fitting rule decides; ``rule`` is its text, else null.  URLs
    that a rule decides are the labelled ones; they train boosted trees that
    judge the rest (``score``: probability of block; 1 or 0 where a rule
    decides).  Training takes at most about ``sample`` distinct labelled URLs,
    drawn by the hash of the URL; suffix statistics cover all labelled rows,
    without the fold of the row itself where it is labelled.  Nothing is
    learned from rows where ``hide`` (over ``page_id`` and ``url``) is true:
    their verdict is the rule's and their score the trees'.
    Without labelled URLs the rest is allowed, with labels of one kind only
    the rest gets that kind.  A null URL has an empty host and path and is
    judged by the trees like any other; repeated rows give repeated results,
    an empty table an empty one; other columns of ``df`` are not read.
    """
    base = df.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"))
    parts = base.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    host, path = F.col("host"), F.col("path")
    ruled = parts.withColumns({"rule": first_fit(rules, host, path, lambda r: r.text),
                               "ruled": first_fit(rules, host, path, lambda r: r.verdict)})
    known = F.when(F.col("ruled") == "block", 1.0).when(F.col("ruled") == "allow", 0.0)
    if hide is not None:
        known = F.when(~F.coalesce(hide, F.lit(False)), known)
    rows = saved(features(ruled).withColumns({"label": known, "fold": fold(F.col("url"))}), "urls")
    labelled = rows.where(F.col("label").isNotNull())
    n, blocked, distinct = labelled.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0)),
                                        F.approx_count_distinct("url")).first()
    out = ("page_id", "host", "path", "rule")
    if n == 0 or blocked in (0, n):
        rest = "block" if n and blocked == n else "allow"
        return rows.select(*out, F.coalesce("ruled", F.lit(rest)).alias("verdict"),
                           F.coalesce("label", F.lit(float(rest == "block"))).alias("score"))

    rate = blocked / n
    scored = reduce(lambda d, s: d.join(suffix_rates(labelled, s), s, "left"), SUFFIXES, rows)
    scored = scored.select(*rows.columns, *[rate_of(s, rate) for s in SUFFIXES])
    names = [*NUMERIC, *(f"{s}_rate" for s in SUFFIXES)]
    spread = 1 << 30
    share = min(spread, int(spread * sample / max(1, distinct)) + 1)
    train = (scored.where(F.col("label").isNotNull()
                          & (F.pmod(F.xxhash64("url"), F.lit(spread)) < share))
             .groupBy("url").agg(*[F.first(c).alias(c) for c in [*names, "label"]]))
    train = saved(train, "url_sample")
    assemble = VectorAssembler(inputCols=names, outputCol="features")
    model = GBTClassifier(labelCol="label", maxIter=trees, maxDepth=depth, stepSize=0.2,
                          seed=7).fit(assemble.transform(train).select("features", "label"))
    judged = model.transform(assemble.transform(scored))
    score = vector_to_array("probability")[1]
    return judged.select(
        *out, F.coalesce("ruled", F.when(score > 0.5, "block").otherwise("allow")).alias("verdict"),
        F.coalesce("label", score).alias("score"))


def held_out(df: DataFrame, rules=RULES, page_id: str = "page_id", url: str = "url", **settings) -> DataFrame:
    """How well the trees find verdicts they were not shown: the labelled URLs
    of one fold are hidden, the trees learn from the rest and judge them.  One
    row per verdict: ``verdict, n, correct`` (rows; none without such URLs)."""
    base = df.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"))
    hidden = fold(F.col("url")) == 0
    judged = judge(base, rules, hide=hidden, **settings)
    ids = base.where(hidden).select("page_id").distinct()
    tested = judged.join(ids, "page_id", "left_semi").where(F.col("rule").isNotNull())
    return tested.groupBy("verdict").agg(
        F.count("*").alias("n"), F.count_if((F.col("score") > 0.5) == (F.col("verdict") == "block")).alias("correct"))
