"""URL filter: rules first, gradient-boosted trees on lexical features for the rest.

A rule fits its host and all subdomains of it if the path starts with the rule's; the longest wins.
The URLs that a rule fits are the labelled ones. Trees are boosted on at most ``SAMPLE`` of them,
those of the least hash; the suffix statistics, how many labelled URLs end in a suffix of one or two
labels and which part is blocked, are taken over all of them, for every suffix. For a URL that trains
the trees, they leave out the labelled URLs of its own fold, a hash of the URL: the statistics of a
rare suffix would otherwise tell its own verdict. Suffixes of at least one in ``RARE`` of all
URLs, labelled or not, meet their rows in a broadcast of at most ``RARE`` rows; the rest in a shuffled
join, where no key has more rows than that.

Features: length of URL, host and path; depth of path and host; shares of digits and of signs;
entropy of characters; parameters in the query; the two suffixes' counts and blocked parts.

Nulls: a null URL, or one without ``://``, has an empty host and path, no rule, and is judged by its
features, which are then nearly all zero; null ids pass through. Without labelled URLs, or with one
verdict only among them, the rest is allowed, or gets that verdict. Repeated rows are judged alike. An
empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimtrace.llm.common import written

SAMPLE = 20_000
RARE = 1000
FOLDS = 10
TREES, DEPTH = 20, 4
FEATURES = [
    "url_length", "host_length", "path_length", "path_depth", "host_depth", "digit_ratio", "sign_ratio",
    "entropy", "parameters", "count_1", "blocked_1", "count_2", "blocked_2",
]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host, A-Z lower-cased, and the path; both empty without ``://``."""
    known = F.coalesce(F.instr(url, "://"), F.lit(0)) > 0
    rest = F.substr(url, F.instr(url, "://") + 3)
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.when(known, host).otherwise(""), F.when(known, path).otherwise("")


def rule_and_verdict(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict; null without one."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        own, _, start = text.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith("/" + start)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def _lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    size = F.greatest(F.length(url), F.lit(1))
    signs = F.split(url, "")
    part = F.transform(F.array_distinct(signs), lambda c: F.size(F.filter(signs, lambda x: x == c)) / F.size(signs))
    return {
        "url_length": F.length(url),
        "host_length": F.length(host),
        "path_length": F.length(path),
        "path_depth": F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit(""))),
        "host_depth": F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))),
        "digit_ratio": F.length(F.regexp_replace(url, "[^0-9]", "")) / size,
        "sign_ratio": F.length(F.regexp_replace(url, "[A-Za-z0-9]", "")) / size,
        "entropy": F.when(url == "", 0.0).otherwise(F.aggregate(part, F.lit(0.0), lambda s, p: s - p * F.log2(p))),
        "parameters": F.when(F.contains(url, F.lit("?")), F.size(F.split(F.substring_index(url, "?", -1), "&"))).otherwise(0),
    }


def _fold() -> Column:
    return F.pmod(F.xxhash64("url"), F.lit(FOLDS))


def _out_of_fold(sample: DataFrame, labelled: DataFrame) -> DataFrame:
    """The sample with ``n_1 b_1 n_2 b_2``: the labelled URLs of its suffixes in other folds, and the blocked ones.

    The sample is bounded, and so are its suffixes times the folds.
    """
    sample = sample.withColumn("fold", _fold())
    for level in (1, 2):
        name = f"suffix_{level}"
        known = labelled.join(F.broadcast(sample.select(name).distinct()), name, "left_semi")
        own = known.groupBy(name, _fold().alias("fold")).agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("b"))
        every = own.groupBy(name).agg(F.sum("n").alias("all_n"), F.sum("b").alias("all_b"))
        others = own.join(every, name).select(
            name, "fold", (F.col("all_n") - F.col("n")).alias(f"n_{level}"), (F.col("all_b") - F.col("b")).alias(f"b_{level}")
        )
        sample = sample.join(F.broadcast(others), [name, "fold"], "left")
    return sample


def _met(frame: DataFrame, name: str, stats: DataFrame, least: float) -> DataFrame:
    """The rows with their suffix's statistics; suffixes of ``least`` uses are broadcast, the rest shuffled."""
    hot = F.broadcast(stats.where(F.col("uses") >= least).drop("uses").withColumn("hot", F.lit(True)))
    meets = frame.join(hot, name, "left")
    held = [c for c in stats.columns if c not in (name, "uses")]
    rest = meets.where(F.col("hot").isNull()).drop("hot", *held)
    cold = stats.where(F.col("uses") < least).drop("uses")
    return meets.where("hot").drop("hot").unionByName(rest.join(cold, name, "left"))


def _with_suffixes(rows: DataFrame) -> DataFrame:
    """The rows with ``n_1 b_1 n_2 b_2``: all labelled URLs of their suffixes, and the blocked ones.

    The longer suffix names the shorter one, so only the table of suffixes meets both.
    """
    blocked = F.count(F.when(F.col("says") == "block", 1))
    pairs = rows.groupBy("suffix_2").agg(F.count(F.lit(1)).alias("uses"), F.count("says").alias("n_2"), blocked.alias("b_2"))
    pairs = written(pairs.withColumn("suffix_1", F.substring_index("suffix_2", ".", -1)), "url-suffixes")
    least = max(1.0, (pairs.agg(F.sum("uses")).first()[0] or 0) / RARE)
    ends = pairs.groupBy("suffix_1").agg(F.sum("uses").alias("uses"), F.sum("n_2").alias("n_1"), F.sum("b_2").alias("b_1"))
    both = _met(pairs.withColumnRenamed("uses", "pages"), "suffix_1", ends, least).withColumnRenamed("pages", "uses")
    return _met(rows, "suffix_2", written(both.drop("suffix_1"), "url-statistics"), least)


def _assembled(frame: DataFrame, prior: float) -> DataFrame:
    for level in (1, 2):
        n, b = F.col(f"n_{level}"), F.col(f"b_{level}")
        frame = frame.withColumns({f"count_{level}": F.log1p(n), f"blocked_{level}": (b + 10 * prior) / (n + 10)})
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(frame)


def judge(pages: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per row: ``id, host, path, rule, verdict`` and the model's ``blocked`` probability."""
    given = F.col(url_col).cast("string")
    host, path = host_and_path(given)
    rows = pages.select(F.col(id_col).alias("id"), F.coalesce(given, F.lit("")).alias("url"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_and_verdict(F.col("host"), F.col("path"), rules)
    rows = rows.select("*", rule.alias("rule"), verdict.alias("says"))
    rows = rows.select("*", F.substring_index("host", ".", -1).alias("suffix_1"), F.substring_index("host", ".", -2).alias("suffix_2"))
    rows = written(rows.withColumns(_lexical(F.col("url"), F.col("host"), F.col("path"))), "url-features")
    labelled = rows.where(F.col("says").isNotNull()).withColumn("label", (F.col("says") == "block").cast("double"))
    total = labelled.agg(F.count(F.lit(1)).alias("n"), F.avg("label").alias("mean")).first()
    prior = total.mean or 0.0

    if 0 < prior < 1:
        share = min(1.0, SAMPLE / total.n)
        chosen = labelled.where(F.xxhash64("url", "id") <= int(-(1 << 63) + share * ((1 << 64) - 1) - 1 if share < 1 else (1 << 63) - 1))
        sample = written(chosen.limit(SAMPLE * 2), "url-sample")
        model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, seed=1).fit(_assembled(_out_of_fold(sample, labelled), prior))
        scored = model.transform(_assembled(_with_suffixes(rows), prior)).withColumn("blocked", vector_to_array("probability")[1])
    else:
        scored = rows.withColumn("blocked", F.lit(prior))
    own = F.when(F.col("blocked") > 0.5, "block").otherwise("allow")
    return scored.select(F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("says", own).alias("verdict"), "blocked")
