"""Block or allow URLs: rules first, else gradient-boosted trees on lexical features.

The trees are Spark's own (`GBTClassifier`); features and rules are column expressions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hoptrail.llm.common import lower_ascii, materialize

ALLOW, BLOCK = "allow", "block"
#: Names of feature columns, none of which a caller's column should have.
FEATURES = [
    f"hoptrail_{name}"
    for name in (
        "url_length host_length path_length depth digit_ratio host_digits hyphens labels entropy "
        "parameters query_length fragment suffix_length suffix_log_pages suffix_log_hosts suffix_depth"
    ).split()
]
_OF_MODEL = ["hoptrail_vector", "hoptrail_prediction", "hoptrail_probability", "hoptrail_raw"]


@dataclass(frozen=True)
class Rule:
    """`text` is a host and a path, such as `example.com/de/`; it holds for subdomains too."""

    verdict: str
    text: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return self.text[len(self.host) :]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What stands after the first `://`: the host with A-Z lower-cased, and the path.

    Both are empty for null and for a URL without `://`.
    """
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return lower_ascii(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, else nulls."""
    text = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        text, verdict = F.when(fits, F.lit(rule.text)).otherwise(text), F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return text, verdict


def _count(text: Column, what: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(what), F.lit("")))


def _entropy(text: Column) -> Column:
    n = F.length(text).cast("double")

    def add(total: Column, c: Column) -> Column:
        p = (n - F.length(F.replace(text, c, F.lit("")))) / n
        return total - p * F.log2(p)

    found = F.aggregate(F.array_distinct(F.split(text, "")), F.lit(0.0), add)
    return F.when(n > 0, found).otherwise(F.lit(0.0))


def features(urls: DataFrame, url: str, suffixes: DataFrame) -> DataFrame:
    """`urls` (with `hoptrail_host`, `hoptrail_path`) and the columns of `FEATURES`."""
    text = F.coalesce(F.col(f"`{url}`"), F.lit(""))
    host, path = F.col("hoptrail_host"), F.col("hoptrail_path")
    query = F.regexp_extract(text, r"\?([^#]*)", 1)
    digits = lambda x: F.length(F.regexp_replace(x, "[^0-9]", ""))
    values = [
        F.length(text),
        F.length(host),
        F.length(path),
        _count(path, "/"),
        digits(text) / F.greatest(F.length(text), F.lit(1)),
        digits(host),
        _count(host, "-"),
        _count(host, ".") + 1,
        _entropy(host),
        F.when(query == "", F.lit(0)).otherwise(_count(query, "&") + 1),
        F.length(query),
        F.contains(text, F.lit("#")),
        F.length("hoptrail_suffix"),
    ]
    joined = urls.join(suffixes, "hoptrail_suffix", "left")
    lexical = {name: value.cast("double") for name, value in zip(FEATURES, values)}
    counted = {name: F.coalesce(F.col(name), F.lit(0.0)) for name in FEATURES[len(values) :]}
    return joined.withColumns(lexical | counted)


def parsed(df: DataFrame, url: str) -> DataFrame:
    host, path = host_and_path(F.col(f"`{url}`"))
    suffix = F.substring_index("hoptrail_host", ".", -1)
    return df.withColumns({"hoptrail_host": host, "hoptrail_path": path}).withColumn("hoptrail_suffix", suffix)


def suffix_statistics(urls: DataFrame) -> DataFrame:
    """Of each last label of a host, over all URLs: pages, hosts and mean path depth."""
    by_host = urls.groupBy("hoptrail_suffix", "hoptrail_host").agg(
        F.count(F.lit(1)).alias("pages"), F.sum(_count(F.col("hoptrail_path"), "/")).alias("depth")
    )
    pages = F.sum("pages")
    return by_host.groupBy("hoptrail_suffix").agg(
        F.log1p(pages).alias("hoptrail_suffix_log_pages"),
        F.log1p(F.count(F.lit(1))).alias("hoptrail_suffix_log_hosts"),
        (F.sum("depth") / pages).alias("hoptrail_suffix_depth"),
    )


def fit(labelled: DataFrame, sample: int = 10_000, rounds: int = 20, depth: int = 4) -> PipelineModel | None:
    """Trees from `FEATURES`, `hoptrail_label` (1 blocks) and `hoptrail_weight`.

    At most about `sample` rows, picked by a hash of the URL, are learnt from. Without rows of
    both labels there is nothing to learn, and no model.
    """
    counts = {r["hoptrail_label"]: r["count"] for r in labelled.groupBy("hoptrail_label").count().collect()}
    if len(counts) < 2:
        return None
    place = F.pmod(F.col("hoptrail_hash"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    picked = labelled.filter(place < min(1.0, sample / sum(counts.values())))
    picked = materialize(picked.select(*FEATURES, "hoptrail_label", "hoptrail_weight"))
    if picked.select("hoptrail_label").distinct().count() < 2:
        return None
    trees = GBTClassifier(
        featuresCol="hoptrail_vector",
        labelCol="hoptrail_label",
        weightCol="hoptrail_weight",
        predictionCol="hoptrail_prediction",
        maxIter=rounds,
        maxDepth=depth,
        seed=7,
    )
    trees = trees.setProbabilityCol("hoptrail_probability").setRawPredictionCol("hoptrail_raw")
    return Pipeline(stages=[VectorAssembler(inputCols=FEATURES, outputCol="hoptrail_vector"), trees]).fit(picked)


def judge(
    df: DataFrame, rules: list[Rule], url: str = "url", unlabelled: float = 0.3, sample: int = 10_000
) -> DataFrame:
    """`df` with host, path, rule, verdict and p_block (null where a rule decides).

    URLs that a rule judges are the labelled ones, with weight 1. Rules name whole suffixes, so
    trees that saw only them would block or allow a suffix as a whole; the other URLs are
    therefore learnt from too, as allowed with weight `unlabelled`. Hosts are dealt to two folds,
    and each fold is judged by trees from the other one, so that no URL is judged by what was
    assumed of it or of its host. Statistics of suffixes are over all URLs. A null URL, or one without `://`, has an empty host and path and is judged
    by the trees like any other. Without labels of both kinds in a fold, what no rule judges in
    the other one is allowed.
    Columns of the result's names are replaced; equal rows stay.
    """
    urls = parsed(df.drop("host", "path", "rule", "verdict", "p_block"), url)
    rule, verdict = rule_of(F.col("hoptrail_host"), F.col("hoptrail_path"), rules)
    suffixes = materialize(suffix_statistics(urls))
    ready = features(urls, url, suffixes).withColumns(
        {"rule": rule, "verdict": verdict, "hoptrail_hash": F.xxhash64(F.col(f"`{url}`"))}
    )
    labelled = ready.withColumns(
        {
            "hoptrail_label": (F.coalesce("verdict", F.lit(ALLOW)) == BLOCK).cast("double"),
            "hoptrail_weight": F.when(F.col("rule").isNull(), F.lit(unlabelled)).otherwise(F.lit(1.0)),
        }
    )
    fold = F.pmod(F.xxhash64("hoptrail_host"), F.lit(2))
    judged = []
    for mine in (0, 1):
        model, rows = fit(labelled.filter(fold != mine), sample), ready.filter(fold == mine)
        chance = F.lit(0.0) if model is None else vector_to_array("hoptrail_probability")[1]
        judged.append((rows if model is None else model.transform(rows)).withColumn("p_block", chance).drop(*_OF_MODEL))
    scored = judged[0].unionByName(judged[1])
    free = F.when(F.col("p_block") >= 0.5, F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    kept = [c for c in df.columns if c not in ("host", "path", "rule", "verdict", "p_block")]
    return scored.select(
        *(F.col(f"`{c}`") for c in kept),
        F.col("hoptrail_host").alias("host"),
        F.col("hoptrail_path").alias("path"),
        "rule",
        F.coalesce("verdict", free).alias("verdict"),
        F.when(F.col("rule").isNull(), F.col("p_block")).alias("p_block"),
    )
