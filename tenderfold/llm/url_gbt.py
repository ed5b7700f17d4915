"""URL filter: host/path rules first, gradient-boosted trees on lexical features for the rest.

Native only: URL parts, rules and features are SQL functions; the trees are
trained by Spark ML's ``GBTClassifier`` on a bounded sample of the URLs that a
rule labels, and scored as plain CASE expressions built from the trained
splits, so the scan of all pages stays inside generated code. The suffix
statistics are counted over all pages: the count over all rows, the rate of
blocked ones over all rows that a rule labels.

Defined results: a NULL url, or one without ``://``, has an empty host and
path, fits no rule and is judged by the trees on its (zero) features. If the
sample holds no labelled URL the verdict of the rest is "allow"; if it holds
one class only, that class. Repeated rows get equal results. An empty
table gives no rows. Other columns pass through unless their names are those
of the results or of the parts and features on the way (``_rest``, ``_query``,
``_ruled``, ``suffix`` and FEATURES), which are left out.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from tenderfold.llm.common import let, staged

TRAIN_ROWS = 20_000      # bound of the training sample (URLs that a rule labels, lowest hashes first)
TREES = 20
DEPTH = 4
SMOOTHING = 2.0          # pseudo-count of the suffix statistics


@dataclass(frozen=True)
class Rule:
    verdict: str         # allow or block
    host: str            # fits this host and its subdomains
    path: str            # the url's path starts with it

    @property
    def name(self) -> str:
        return self.host + self.path


# The rules of the registered query.
RULES = [Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"),
         Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/")]

FEATURES = ["f_length", "f_host_length", "f_path_length", "f_depth", "f_labels", "f_digit_ratio", "f_entropy",
            "f_params", "f_fragment", "f_segment_length", "f_hyphens", "f_suffix_rate", "f_suffix_log_count"]


def with_parts(df: DataFrame, url: str = "url") -> DataFrame:
    """Add host (A-Z lower-cased), path and query text; all empty without ``://``."""
    u = F.coalesce(F.col(url), F.lit(""))
    at = F.instr(u, "://")
    rest = F.when(at > 0, F.substring(u, at + 3, F.length(u))).otherwise(F.lit(""))
    df = df.withColumn("_rest", rest)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return df.withColumns({
        "host": F.translate(F.regexp_extract("_rest", r"^([^/?#]*)", 1), upper, lower),
        "path": F.regexp_extract("_rest", r"^[^/?#]*([^?#]*)", 1),
        "_query": F.regexp_extract("_rest", r"^[^?#]*\?([^#]*)", 1)})


def fits(rule: Rule) -> Column:
    host = F.col("host")
    return ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(F.col("path"), F.lit(rule.path))


def with_rule(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add the longest rule that fits, by name, and its verdict (both NULL without one)."""
    ordered = sorted(rules, key=lambda r: -len(r.name))
    name = verdict = None
    for r in ordered:
        name = F.when(fits(r), r.name) if name is None else name.when(fits(r), r.name)
        verdict = F.when(fits(r), r.verdict) if verdict is None else verdict.when(fits(r), r.verdict)
    none = F.lit(None).cast("string")
    return df.withColumns({"rule": none if name is None else name, "_ruled": none if verdict is None else verdict})


def _count_of(text: Column, chars: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("double")


def _entropy(text: Column) -> Column:
    """Shannon entropy of the characters, in bits: one pass over the sorted run-length of each distinct character."""
    n = F.length(text).cast("double")

    def share(c: Column) -> Column:
        return (F.length(text) - F.length(F.replace(text, c, F.lit("")))) / n

    return F.when(n > 0, F.aggregate(F.array_distinct(F.split(text, "")), F.lit(0.0), lambda acc, c: (
        acc - F.when(c != "", let(share(c), lambda p: p * F.log2(p))).otherwise(0.0)))).otherwise(0.0)


def _suffix() -> Column:
    return F.when(F.col("host") == "", "").otherwise(F.element_at(F.split("host", r"\."), -1))


def with_features(df: DataFrame, url: str = "url") -> DataFrame:
    """Lexical features of the url and its parts (the suffix statistics are joined later)."""
    u, host, path, query = F.coalesce(F.col(url), F.lit("")), F.col("host"), F.col("path"), F.col("_query")
    labels = F.split(host, r"\.")
    depth = F.size(F.filter(F.split(path, "/"), lambda x: x != ""))
    length = F.length(u).cast("double")
    return df.withColumns({
        "suffix": _suffix(),
        "f_length": length, "f_host_length": F.length(host).cast("double"), "f_path_length": F.length(path).cast("double"),
        "f_depth": depth.cast("double"), "f_labels": F.size(labels).cast("double"),
        "f_digit_ratio": F.when(length > 0, _count_of(u, "0123456789") / length).otherwise(0.0),
        "f_entropy": _entropy(u),
        "f_params": F.when(query == "", 0.0).otherwise(_count_of(query, "&") + 1.0),
        "f_fragment": F.contains(u, F.lit("#")).cast("double"),
        "f_segment_length": F.when(depth > 0, F.length(path) / depth).otherwise(0.0).cast("double"),
        "f_hyphens": _count_of(u, "-_")})


def suffix_statistics(parsed: DataFrame) -> DataFrame:
    """Per host suffix: smoothed rate of blocked URLs among all labelled ones, and log count of all pages."""
    g = parsed.groupBy(_suffix().alias("suffix")).agg(
        F.count_if(F.col("_ruled") == "block").alias("blocked"), F.count("_ruled").alias("ruled"), F.count("*").alias("n"))
    return g.select("suffix", ((F.col("blocked") + 0.5 * SMOOTHING) / (F.col("ruled") + SMOOTHING)).alias("f_suffix_rate"),
                    F.log1p(F.col("n").cast("double")).alias("f_suffix_log_count"))


def with_suffix(df: DataFrame, stats: DataFrame) -> DataFrame:
    # no hint: there may be many suffixes, so the join is chosen by their measured size
    return df.join(stats, "suffix", "left")


def _tree_sql(node) -> str:
    if node.getClass().getSimpleName() == "LeafNode":
        return repr(float(node.prediction())) + "D"
    split = node.split()
    return (f"CASE WHEN {FEATURES[split.featureIndex()]} <= {float(split.threshold())!r}D "
            f"THEN {_tree_sql(node.leftChild())} ELSE {_tree_sql(node.rightChild())} END")


def train(sample: DataFrame) -> Column:
    """Probability of "block" as a column expression, from labelled rows with all features."""
    counts = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return F.lit(float(next(iter(counts), 0.0)))
    data = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(sample).select("features", "label")
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=7, checkpointInterval=-1).fit(data)
    terms = [f"{float(w)!r}D * ({_tree_sql(t._java_obj.rootNode())})" for w, t in zip(model.treeWeights, model.trees)]
    return 1.0 / (1.0 + F.exp(-2.0 * F.expr(" + ".join(terms))))


def judge(pages: DataFrame, rules: list[Rule] = RULES, url: str = "url", train_rows: int = TRAIN_ROWS) -> DataFrame:
    """Add host, path, rule, score (probability of "block" by the trees) and verdict to every page."""
    parsed = with_rule(with_parts(pages, url), rules)
    labelled = parsed.where(F.col("rule").isNotNull()).select(
        url, "host", "path", "_query", (F.col("_ruled") == "block").cast("double").alias("label"))
    sample = labelled.orderBy(F.xxhash64(url), url).limit(train_rows)
    sample = staged(with_features(sample, url).select("suffix", *FEATURES[:-2], "label"), "url-sample")
    stats = staged(suffix_statistics(parsed), "url-suffixes")
    score = train(with_suffix(sample, stats))
    out = with_suffix(with_features(parsed, url), stats).withColumn("score", score)
    verdict = F.coalesce(F.col("_ruled"), F.when(F.col("score") >= 0.5, "block").otherwise("allow"))
    return out.withColumn("verdict", verdict).drop("_rest", "_query", "_ruled", "suffix", *FEATURES)
