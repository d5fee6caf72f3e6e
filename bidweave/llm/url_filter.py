"""URL filter: rules first, gradient-boosted trees on lexical features for the rest.

The trees learn from urls with a known verdict. Features are taken from the
url's text alone: lengths, depth, digit ratio, entropy, counts of parameters
and host labels, and statistics of the host's suffixes among the labelled urls.
A labelled url's own statistics are those of the other folds, so the trees see
how far such a rate can be trusted for urls that it was not made of.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidweave.llm.common import ascii_lower, staged

FEATURES = [
    "n_url", "n_host", "n_path", "depth", "digits", "entropy", "parameters", "labels", "hyphens",
    "fragment", "secure", "suffix_rate", "suffix_rows", "domain_rate", "domain_rows",
]

#: Parts of the labelled urls; each gets its statistics from the others.
FOLDS = 5


@dataclass(frozen=True)
class Rule:
    """A verdict for a host with its subdomains, below a path."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def parse_rules(lines: list[str]) -> list[Rule]:
    """Rules from lines like ``block example.org/en/1``."""
    found = []
    for line in lines:
        verdict, rule = line.split()
        host, slash, path = rule.partition("/")
        found.append(Rule(host, slash + path, verdict))
    return found


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for a null url or one without ``://``."""
    at = F.instr(url, "://")
    rest = F.expr("''")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(rest)
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return ascii_lower(host), path


def matched(rules: list[Rule], host: Column, path: Column) -> Column:
    """Name of the longest rule that fits, or null. Made for short lists of rules."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        below = (host == rule.host) | host.endswith("." + rule.host)
        found = F.when(below & path.startswith(rule.path), F.lit(rule.name)).otherwise(found)
    return found


def _entropy(text: Column) -> Column:
    size = F.length(text)

    def add(total: Column, char: Column) -> Column:
        share = (size - F.length(F.replace(text, char, F.lit("")))) / size
        return total - share * F.log2(share)

    chars = F.array_distinct(F.split(text, ""))
    chars = F.filter(chars, lambda c: c != "")
    return F.when(size > 0, F.aggregate(chars, F.lit(0.0), add)).otherwise(F.lit(0.0))


def lexical(urls: DataFrame) -> DataFrame:
    """Adds the features that need nothing but ``url``, ``host`` and ``path``."""
    url = F.coalesce("url", F.lit(""))
    size = F.greatest(F.length(url), F.lit(1))
    return urls.withColumns(
        {
            "suffix": F.substring_index("host", ".", -1),
            "domain": F.substring_index("host", ".", -2),
            "n_url": F.length(url).cast("double"),
            "n_host": F.length("host").cast("double"),
            "n_path": F.length("path").cast("double"),
            "depth": F.regexp_count("path", F.lit("/[^/]")).cast("double"),
            "digits": F.regexp_count(url, F.lit("[0-9]")) / size,
            "entropy": _entropy(url),
            "parameters": F.regexp_count(url, F.lit("[?&][^&#]")).cast("double"),
            "labels": F.size(F.split("host", r"\.")).cast("double"),
            "hyphens": F.regexp_count("host", F.lit("-")).cast("double"),
            "fragment": F.contains(url, F.lit("#")).cast("double"),
            "secure": F.startswith(url, F.lit("https")).cast("double"),
        }
    )


@dataclass
class UrlModel:
    """Trees and suffix statistics; without trees every url gets the verdict ``plain``."""

    trees: GBTClassificationModel | None
    statistics: dict[str, DataFrame]
    rate: float
    plain: str = "allow"

    def features(self, urls: DataFrame) -> DataFrame:
        found = lexical(urls)
        for name, table in self.statistics.items():
            found = found.join(table, name, "left").fillna(
                {f"{name}_rate": self.rate, f"{name}_rows": 0.0}
            )
        return found


def _rates(hits: Column, n: Column, name: str, rate: float, weight: float) -> list[Column]:
    smooth = (hits + weight * rate) / (n + weight)
    return [smooth.alias(f"{name}_rate"), F.log1p(n.cast("double")).alias(f"{name}_rows")]


def _counts(urls: DataFrame, keys: list[str]) -> DataFrame:
    return urls.groupBy(*keys).agg(F.sum("label").alias("hits"), F.count("*").alias("n"))


def _statistics(urls: DataFrame, name: str, rate: float, weight: float) -> DataFrame:
    counted = _counts(urls, [name])
    return staged(counted.select(name, *_rates(F.col("hits"), F.col("n"), name, rate, weight)), f"url-{name}")


def _out_of_fold(urls: DataFrame, name: str, rate: float, weight: float) -> DataFrame:
    """The urls with the statistics of ``name`` over the urls of the other folds."""
    own = _counts(urls, [name, "fold"]).withColumnsRenamed({"hits": "own_hits", "n": "own_n"})
    joined = urls.join(_counts(urls, [name]), name).join(own, [name, "fold"])
    hits, n = F.col("hits") - F.col("own_hits"), F.col("n") - F.col("own_n")
    return joined.select(*urls.columns, *_rates(hits, n, name, rate, weight))


def train(
    labelled: DataFrame, rounds: int = 20, depth: int = 4, weight: float = 10.0
) -> UrlModel:
    """Model of (url, label), label 1 for urls to block.

    Learns from all distinct urls with a label. Null urls and labels are left
    out. With labels of one class only, or none, there are no trees.
    """
    host, path = host_and_path(F.col("url"))
    rows = labelled.where(F.col("url").isNotNull() & F.col("label").isNotNull())
    rows = rows.select("url", F.col("label").cast("double").alias("label")).distinct()
    # In the order of hashes, so that sums in the trees do not follow how the rows came.
    rows = rows.orderBy(F.xxhash64("url", "label"), "url", "label")
    fold = F.pmod(F.xxhash64(F.lit(5), "url"), F.lit(FOLDS)).cast("int")
    urls = staged(lexical(rows.withColumns({"host": host, "path": path, "fold": fold})), "url-labelled")
    seen = urls.agg(F.avg("label"), F.min("label"), F.max("label")).first()
    if seen[1] == seen[2]:
        return UrlModel(None, {}, seen[0] or 0.0, "block" if seen[0] else "allow")
    tables = {n: _statistics(urls, n, seen[0], weight) for n in ("suffix", "domain")}
    model = UrlModel(None, tables, seen[0])
    known = urls
    for name in tables:
        known = _out_of_fold(known, name, seen[0], weight)
    ready = staged(_vectors(known).select("features", "label"), "url-features")
    model.trees = GBTClassifier(
        labelCol="label", featuresCol="features", maxIter=rounds, maxDepth=depth, seed=1
    ).fit(ready)
    return model


def _vectors(features: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="keep").transform(
        features
    )


def judge(urls: DataFrame, rules: list[Rule], model: UrlModel) -> DataFrame:
    """(page_id, host, path, rule, verdict, block_score) of every row of ``urls`` (page_id, url).

    The longest rule decides; without one the model does, and ``block_score``
    is its probability (null without trees). Repeated rows stay. A null url has
    an empty host and path and is judged by the model. Other columns are
    ignored, an empty table gives no rows.
    """
    host, path = host_and_path(F.col("url"))
    named = urls.select("page_id", "url", host.alias("host"), path.alias("path"))
    named = named.withColumn("rule", matched(rules, F.col("host"), F.col("path")))
    if model.trees is None:
        scored = named.withColumn("block_score", F.lit(None).cast("double"))
        guess = F.lit(model.plain)
    else:
        scored = model.trees.transform(_vectors(model.features(named)))
        scored = scored.withColumn("block_score", vector_to_array("probability")[1])
        guess = F.when(F.col("block_score") > 0.5, "block").otherwise("allow")
    ruled = F.lit(None).cast("string")
    for rule in rules:
        ruled = F.when(F.col("rule") == rule.name, F.lit(rule.verdict)).otherwise(ruled)
    return scored.select(
        "page_id", "host", "path", "rule", F.coalesce(ruled, guess).alias("verdict"), "block_score"
    )


def labelled_by_rules(urls: DataFrame, rules: list[Rule]) -> DataFrame:
    """(url, label) of the urls that a rule decides: 1 for block."""
    host, path = host_and_path(F.col("url"))
    named = urls.select("url", matched(rules, host, path).alias("rule"))
    blocked = [r.name for r in rules if r.verdict == "block"]
    return named.where(F.col("rule").isNotNull()).select(
        "url", F.col("rule").isin(blocked).cast("double").alias("label")
    )
