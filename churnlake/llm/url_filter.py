"""URL filter: rules first, gradient-boosted trees on lexical features for the rest. DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlake.session import stage

ALLOW, BLOCK = "allow", "block"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FEATURES = ["length", "host_length", "labels", "longest_label", "path_length", "depth", "digit_ratio", "entropy",
            "parameters", "query_length", "hyphens", "escapes", "fragment", "domain_rate", "domain_seen", "top_rate", "top_seen"]

#: Parts of the labelled URLs that suffix rates are counted without, one at a time.
FOLDS = 5


@dataclass(frozen=True)
class Rule:
    """``text`` is host, slash, path; it fits the host and its subdomains, on paths that start with ``/`` and the path."""

    verdict: str
    text: str


def host_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case (A-Z only) and path of a URL; both empty if it is null or has no ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def deciding_rule(rules: list[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits (of equally long ones the first listed), else null."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(reversed(rules), key=lambda r: len(r.text)):
        name, _, rest = rule.text.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit("/" + rest))
        text, verdict = F.when(fits, rule.text).otherwise(text), F.when(fits, rule.verdict).otherwise(verdict)
    return text, verdict


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def with_features(urls: DataFrame) -> DataFrame:
    """Add the lexical features to (url, host, path); the suffix statistics come later."""
    url = F.coalesce("url", F.lit(""))
    size = F.greatest(F.length(url), F.lit(1)).cast("double")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    counts = F.transform(F.array_distinct(F.split(url, "")), lambda c: F.length(url) - F.length(F.replace(url, c, F.lit(""))))
    bits = F.aggregate(counts, F.lit(0.0), lambda s, n: s + F.when(n > 0, n * F.log2(n.cast("double"))).otherwise(0.0))
    return urls.withColumns({
        "length": size, "host_length": F.length("host").cast("double"), "labels": _count(F.col("host"), r"\."),
        "longest_label": F.coalesce(F.array_max(F.transform(F.split("host", r"\."), F.length)), F.lit(0)).cast("double"),
        "path_length": F.length("path").cast("double"), "depth": _count(F.col("path"), "/"),
        "digit_ratio": _count(url, "[0-9]") / size, "entropy": F.log2(size) - bits / size,
        "parameters": F.when(query == "", 0.0).otherwise(_count(query, "&") + 1), "query_length": F.length(query).cast("double"),
        "hyphens": _count(url, "-"), "escapes": _count(url, "%"), "fragment": F.contains(url, F.lit("#")).cast("double"),
        "domain": F.substring_index("host", ".", -2), "top": F.substring_index("host", ".", -1)})


def suffix_rates(sample: DataFrame, column: str, prior: float = 0.5, weight: float = 20.0, out_of_fold: bool = False) -> DataFrame:
    """Share of blocked URLs by suffix, drawn towards ``prior``, and how often the suffix was seen. As bounded as the sample.

    With ``out_of_fold``, a row per suffix and ``fold``, counted on the other folds: what a URL's own label did not add to.
    """
    counts = sample.groupBy(column, *["fold"] * out_of_fold).agg(F.sum("label").alias("blocked"), F.count("*").alias("seen"))
    blocked, seen = F.col("blocked"), F.col("seen")
    if out_of_fold:
        suffix = Window.partitionBy(column)
        blocked, seen = F.sum("blocked").over(suffix) - blocked, F.sum("seen").over(suffix) - seen
    return counts.select(column, *["fold"] * out_of_fold, ((blocked + prior * weight) / (seen + weight)).alias(f"{column}_rate"),
                         F.log1p(seen.cast("double")).alias(f"{column}_seen"))


@dataclass(frozen=True)
class UrlModel:
    """Trees and suffix statistics; ``constant`` is the verdict if there was nothing to learn."""

    constant: str | None
    trees: Model | None = None
    rates: tuple[DataFrame, ...] = ()


def _with_rates(urls: DataFrame, rates: tuple[DataFrame, ...]) -> DataFrame:
    for column, table in zip(("domain", "top"), rates):
        keys = [c for c in (column, "fold") if c in table.columns]
        urls = urls.join(F.broadcast(table), keys, "left").fillna({f"{column}_rate": 0.5, f"{column}_seen": 0.0})
    return urls


def train(labelled: DataFrame, rows: int = 20_000, trees: int = 20, depth: int = 4, seed: int = 42) -> UrlModel:
    """Fit on (url, host, path, label): label 1.0 is to be blocked.

    At most about ``rows`` labelled URLs are used, chosen by a hash of the URL (all, if there are
    fewer). With one class only, or none, every URL gets that class, or ``allow``. The trees see suffix
    rates from the other of FOLDS folds of the URLs, so a rate tells them no more than it will of a new URL.
    """
    total = labelled.count()
    share = F.lit(min(1.0, rows / max(1, total)) * (1 << 20))
    chosen = labelled.where(F.pmod(F.xxhash64("url"), F.lit(1 << 20)) < share)
    sample = with_features(chosen.select("url", "host", "path", "label")).withColumn("fold", F.pmod(F.xxhash64(F.lit("fold"), "url"), F.lit(FOLDS)))
    sample = stage(sample.repartition(4, "url").sortWithinPartitions("url"), "urls")
    classes = [r[0] for r in sample.select("label").distinct().collect()]
    if len(classes) < 2:
        return UrlModel(BLOCK if classes == [1.0] else ALLOW)
    rates, others = (tuple(stage(suffix_rates(sample, c, out_of_fold=o), f"{c}-rates") for c in ("domain", "top")) for o in (False, True))
    blocked = sample.where("label = 1").count() / max(1, sample.count())
    weight = F.when(F.col("label") == 1, 0.5 / blocked).otherwise(0.5 / (1 - blocked))  # both classes count alike
    data = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(
        _with_rates(sample, others).withColumn("weight", weight)).select("features", "label", "weight")
    fit = GBTClassifier(labelCol="label", weightCol="weight", maxIter=trees, maxDepth=depth, stepSize=0.2, seed=seed)
    return UrlModel(None, fit.fit(stage(data, "features")), rates)


def scored(urls: DataFrame, model: UrlModel, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of (url, host, path and others), ``rawPrediction`` and ``prediction`` of the trees."""
    ready = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(_with_rates(with_features(urls), model.rates))
    return model.trees.transform(ready.select(*keep, "features"))


def held_out_auc(pages: DataFrame, rules: list[Rule], by: str = "url", url_col: str = "url", **training) -> float | None:
    """Area under the ROC curve of trees fitted without a fifth of the labelled URLs, measured on that fifth.

    The fifth is chosen by a hash of ``by``: of ``url``, or of ``host``, whose hosts the trees have then never seen. None if
    either part lacks a class.
    """
    urls = pages.select(F.col(url_col).cast("string").alias("url"))
    host, path = host_path(F.col("url"))
    urls = urls.withColumns({"host": host, "path": path})
    urls = urls.withColumn("label", (deciding_rule(rules, F.col("host"), F.col("path"))[1] == BLOCK).cast("double")).where("label is not null")
    held = F.pmod(F.xxhash64(F.lit("held"), by), F.lit(5)) == 0
    model = train(urls.where(~held), **training)
    if model.trees is None or urls.where(held).select("label").distinct().count() < 2:
        return None
    return BinaryClassificationEvaluator().evaluate(scored(urls.where(held), model, ["label"]))


def judge(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url", **training) -> DataFrame:
    """Per row: id, host, path, rule (null if none fits), verdict, by_model.

    The URLs that a rule decides are the labelled ones; the trees trained on them judge the others.
    A null URL, or one without ``://``, has empty host and path and is judged by the trees like any other.
    Repeated rows and ids keep their rows; other columns are ignored; an empty table gives an empty result.
    """
    urls = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"))
    host, path = host_path(F.col("url"))
    urls = urls.withColumns({"host": host, "path": path})
    rule, verdict = deciding_rule(rules, F.col("host"), F.col("path"))
    urls = urls.withColumns({"rule": rule, "by_rule": verdict})
    labelled = urls.where("by_rule is not null").withColumn("label", (F.col("by_rule") == BLOCK).cast("double"))
    model = train(labelled, **training)
    if model.trees is None:
        judged = urls.withColumn("by_trees", F.lit(model.constant))
    else:
        judged = scored(urls, model, ["id", "host", "path", "rule", "by_rule"])
        judged = judged.withColumn("by_trees", F.when(F.col("prediction") == 1.0, BLOCK).otherwise(ALLOW))
    return judged.select(F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("by_rule", "by_trees").alias("verdict"),
                         F.col("by_rule").isNull().alias("by_model"))
