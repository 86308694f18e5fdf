"""URL filter: rules, and gradient-boosted trees on lexical features for the rest (operator 11).

URLs that a rule decides are the labelled examples unless others are given.  Trees
are fitted on features of the URL alone: lengths, depth, digit ratio, entropy,
number of parameters, and how often the host's suffix occurs and is blocked.  The
fitted trees become one SQL expression, so that all URLs are judged in the scan of
their table, without Python.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chunklake.llm.common import materialize, table

ALLOW, BLOCK = "allow", "block"
# Host, path and verdict of the rules.
RULES = (("com", "/", ALLOW), ("example.com", "/en/", BLOCK), ("www.example.com", "/en/", ALLOW), ("net", "/es/", BLOCK), ("net", "/fr/", BLOCK))
#: Trees are fitted on so many different labelled URLs at most: those of the least hashes, of
#: one in FOLDS; the suffixes' shares are counted over all other labelled URLs.
EXAMPLES, FOLDS = 8192, 4
TREES, DEPTH, THRESHOLD = 20, 3, 0.5
#: URLs of an even share that are added to each suffix's own.
PRIOR = 10.0
FEATURES = ("url_length", "host_length", "host_labels", "depth", "digit_ratio", "entropy", "parameters", "suffix_count", "suffix_share")


def _after(url: Column) -> Column:
    """What follows the first ://; '' without one."""
    url = F.coalesce(url, F.lit(""))
    return F.when(F.contains(url, F.lit("://")), F.substring(url, F.length(F.substring_index(url, "://", 1)) + 4, F.length(url))).otherwise("")


def host(url: Column) -> Column:
    """What follows :// up to /, ?, # or the end, A to Z in lower case; '' for null or no ://."""
    return F.translate(F.regexp_extract(_after(url), r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    """What follows the host up to ?, # or the end."""
    return F.regexp_extract(_after(url), r"^[^/?#]*([^?#]*)", 1)


def suffix(host: Column) -> Column:
    """The last label of a host."""
    return F.substring_index(host, ".", -1)


def ruled(rules: tuple[tuple[str, str, str], ...] = RULES) -> Column:
    """(rule, verdict) of the longest rule that fits columns ``host`` and ``path``, null if none does.

    ``rules`` is a list short enough to be part of the plan; of rules of one length the lesser comes first.
    """
    found = []
    for h, p, verdict in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[0] + r[1])):
        fits = ((F.col("host") == h) | F.endswith(F.col("host"), F.lit(f".{h}"))) & F.startswith(F.col("path"), F.lit(p))
        found.append(F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.coalesce(*found)


def entropy(text: Column) -> Column:
    """Bits a character.  Characters that are not printable ASCII count as one."""
    plain = F.regexp_replace(text, r"[^\x21-\x7e]", "ÿ")
    share = lambda c: F.try_divide(F.length(plain) - F.length(F.replace(plain, c, F.lit(""))), F.length(plain))
    return F.reduce(F.array_distinct(F.split(plain, "")), F.lit(0.0), lambda bits, c: bits - F.when(c == "", 0.0).otherwise(share(c) * F.log2(share(c))))


def lexical(urls: DataFrame) -> DataFrame:
    """``urls`` (url, host, path) with the features that a URL has by itself, all finite; a null url is empty."""
    url = F.coalesce("url", F.lit(""))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    count = lambda text, part: F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))
    found = {
        "url_length": F.length(url), "host_length": F.length("host"), "host_labels": F.when(F.col("host") != "", count(F.col("host"), ".") + 1).otherwise(0), "depth": F.regexp_count("path", F.lit("[^/]+")),
        "digit_ratio": F.coalesce(F.try_divide(F.length(url) - F.length(F.translate(url, "0123456789", "")), F.length(url)), F.lit(0.0)), "entropy": entropy(url), "parameters": F.when(query != "", count(query, "&") + 1).otherwise(0),
    }
    return urls.withColumns({k: v.cast("double") for k, v in found.items()})


@dataclass
class Model:
    """``suffixes``: (suffix, suffix_count, suffix_share) of the labelled URLs; ``score``: an expression over the features."""

    suffixes: DataFrame
    score: Column

    def features(self, urls: DataFrame) -> DataFrame:
        """``urls`` (url, host, path) with all features; an unknown suffix has count 0 and an even share."""
        known = self.suffixes.withColumnRenamed("suffix", "_suffix")
        joined = lexical(urls).join(known, suffix(F.col("host")) == F.col("_suffix"), "left").drop("_suffix")
        return joined.withColumns({"suffix_count": F.coalesce("suffix_count", F.lit(0.0)), "suffix_share": F.coalesce("suffix_share", F.lit(0.5))})


def _expression(node) -> Column:
    """A fitted tree as nested conditions."""
    if node.subtreeDepth() == 0:
        return F.lit(float(node.prediction()))
    split = node.split()
    return F.when(F.col(FEATURES[split.featureIndex()]) <= float(split.threshold()), _expression(node.leftChild())).otherwise(_expression(node.rightChild()))


def fit(labelled: DataFrame, examples: int = EXAMPLES, trees: int = TREES, depth: int = DEPTH) -> Model:
    """A model of ``labelled`` (url, host, path, blocked boolean).

    Examples are different URLs, at most ``examples`` of them (a documented bound); a URL with both labels counts as blocked.
    Shares of suffixes are taken over all labelled rows that can be no examples, so that they tell
    nothing of an example's own label.  Blocked and allowed URLs weigh the same in all, as how many of
    either have a label says nothing of the URLs that have none.  Where all examples have one label, every URL has
    its score; without any, 0.
    """
    rows = labelled.select("url", "host", "path", F.col("blocked").cast("double").alias("label"), F.xxhash64("url").alias("_h"))
    example = F.pmod("_h", F.lit(FOLDS)) == 0
    # Each task counts its own rows of a suffix first.
    counts = rows.where(~example).groupBy(suffix(F.col("host")).alias("suffix")).agg(F.count("*").alias("n"), F.sum("label").alias("bad"))
    counts = materialize(counts, "suffixes")
    n, bad = (x or 0 for x in counts.agg(F.sum("n"), F.sum("bad")).first())
    worse, better = F.col("bad") * (n / max(2 * bad, 1)), (F.col("n") - F.col("bad")) * (n / max(2 * (n - bad), 1))
    share = (worse + PRIOR / 2) / (worse + better + PRIOR)
    model = Model(counts.select("suffix", F.log1p("n").alias("suffix_count"), share.alias("suffix_share")), F.lit(0.0))
    chosen = rows.where(example).groupBy("_h", "url", "host", "path").agg(F.max("label").alias("label")).orderBy("_h", "url").limit(examples)
    chosen = materialize(model.features(chosen).select("_h", "url", "label", *FEATURES), "examples")
    labels = {r.label: r["count"] for r in chosen.groupBy("label").count().collect()}  # two at most
    if len(labels) < 2:
        model.score = F.lit(next(iter(labels), 0.0))
        return model
    chosen = chosen.withColumn("weight", F.when(F.col("label") == 1, 1.0 / labels[1.0]).otherwise(1.0 / labels[0.0]) * (sum(labels.values()) / 2))
    # A bounded table in one order: the fitted trees are the same each time.
    ordered = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(chosen.coalesce(1).sortWithinPartitions("_h", "url"))
    fitted = GBTClassifier(maxIter=trees, maxDepth=depth, weightCol="weight", seed=11).fit(ordered)
    margin = F.lit(0.0)
    for tree, weight in zip(fitted.trees, fitted.treeWeights, strict=True):
        margin = margin + float(weight) * _expression(tree._call_java("rootNode"))
    model.score = 1.0 / (1.0 + F.exp(-2.0 * margin))
    return model


def judge(urls: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES, labelled: DataFrame | None = None) -> DataFrame:
    """``urls`` (url and other columns) as they are in ``row``, with host, path, rule, verdict and score.

    The verdict is that of the longest rule that fits, otherwise block where the trees' score is 0.5 or more.  Trees are fitted to
    ``labelled`` (url, blocked), or to those of ``urls`` that rules decide.  Repeated rows have one verdict; a null url
    is an empty one, with empty host and path.  ``score`` is null where a rule decides.
    """
    named = lambda df: df.withColumns({"host": host(F.col("url")), "path": path(F.col("url"))})
    rows = named(urls.select("url", F.struct("*").alias("row"))).withColumn("_ruled", ruled(rules))
    if labelled is None:
        known = rows.where(F.col("_ruled").isNotNull() & F.col("url").isNotNull()).select("url", "host", "path", (F.col("_ruled.verdict") == BLOCK).alias("blocked"))
    else:
        known = named(labelled.where("url is not null and blocked is not null").select("url", "blocked"))
    model = fit(known)
    scored = model.features(rows).withColumn("score", F.when(F.col("_ruled").isNull(), model.score))
    verdict = F.coalesce(F.col("_ruled.verdict"), F.when(F.col("score") >= THRESHOLD, BLOCK).otherwise(ALLOW))
    return scored.select("row", "host", "path", F.col("_ruled.rule").alias("rule"), verdict.alias("verdict"), "score")


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages).select("row.page_id", "host", "path", "rule", "verdict", "score")


QUERIES = {"op11_url_filter": op11_url_filter}
ORACLE_SQL: dict[str, str] = {}
