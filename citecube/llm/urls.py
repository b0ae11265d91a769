"""URL filter: explicit host and path rules first, gradient-boosted trees on
lexical features for the rest.

The trees learn from the URLs that a rule judges.  Features are column
expressions: lengths, depth, digit ratio, character entropy, counts of
parameters and signs, and smoothed allow rates of host suffixes, which are
kept in a fixed number of hashed buckets."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

# The rules of the contract.
RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
         ("net/es/", "block"), ("net/fr/", "block")]
TRAIN_ROWS = 20_000        # about so many labelled URLs are learnt from, chosen by a hash
SUFFIX_BUCKETS = 4096      # rows of each suffix table, whatever the input
PRIOR = 10.0               # weight of the overall allow rate in a suffix's rate
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SUFFIXES = (1, 2)          # host labels from the end
FEATURES = ["n_url", "n_host", "n_path", "depth", "labels", "digits", "entropy", "params", "hyphens", "fragment",
            *[f"rate_{n}" for n in SUFFIXES], *[f"seen_{n}" for n in SUFFIXES]]


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path): host lower-cased (A-Z), both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return (F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER),
            F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def rule_columns(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, null without one."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: len(r[0])):        # longer rules are asked first
        name, slash, tail = text.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(slash + tail))
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def count_of(text: Column, sign: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(sign), F.lit("")))


def entropy(text: Column) -> Column:
    """Bits per character."""
    n = F.length(text).cast("double")
    bits = F.aggregate(F.array_distinct(F.split(text, "")), F.lit(0.0),
                       lambda total, c: total + F.when(c == "", F.lit(0.0)).otherwise(
                           (n - F.length(F.replace(text, c, F.lit("")))) / n
                           * -F.log2((n - F.length(F.replace(text, c, F.lit("")))) / n)))
    return F.when(n > 0, bits).otherwise(F.lit(0.0))


def lexical(pages: DataFrame, id_col: str, url_col: str, rules: list[tuple[str, str]]) -> DataFrame:
    """One row per page with host, path, rule, the rule's verdict and features."""
    host, path = parts(F.col("url"))
    rows = (pages.select(F.col(id_col).alias("id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"))
            .withColumns({"host": host, "path": path}))
    rule, said = rule_columns(F.col("host"), F.col("path"), rules)
    url = F.col("url")
    suffix = lambda n: F.pmod(F.xxhash64(F.lit(n), F.substring_index("host", ".", -n)), F.lit(SUFFIX_BUCKETS))
    return rows.select(
        "id", "host", "path", rule.alias("rule"), said.alias("said"),
        F.length(url).cast("double").alias("n_url"), F.length("host").cast("double").alias("n_host"),
        F.length("path").cast("double").alias("n_path"), count_of(F.col("path"), "/").cast("double").alias("depth"),
        count_of(F.col("host"), ".").cast("double").alias("labels"),
        (F.length(F.regexp_replace(url, "[^0-9]", "")) / F.greatest(F.length(url), F.lit(1))).alias("digits"),
        entropy(url).alias("entropy"), (count_of(url, "&") + count_of(url, "=")).cast("double").alias("params"),
        count_of(url, "-").cast("double").alias("hyphens"), count_of(url, "#").cast("double").alias("fragment"),
        *[suffix(n).alias(f"suffix_{n}") for n in SUFFIXES])


def judge(pages: DataFrame, rules: list[tuple[str, str]] | None = None, id_col: str = "page_id",
          url_col: str = "url", bound: int = TRAIN_ROWS, seed: int = 7) -> DataFrame:
    """(id, host, path, rule, verdict, p_allow) for every row.

    A rule's verdict is final (``p_allow`` null).  Without a fitting rule the
    trees decide at 0.5; where the labelled URLs know one verdict only it is
    given to all, and without any labelled URL all are allowed.  Null URLs and
    URLs without ``://`` have empty parts and are judged by their features.
    Repeated rows are judged each; an empty table gives no rows; extra columns
    of any name are ignored."""
    rows = materialize(lexical(pages, id_col, url_col, RULES if rules is None else rules), "url-features")
    label = (F.col("said") == "allow").cast("double")
    labelled = rows.where("said IS NOT NULL")
    n, allowed = labelled.agg(F.count(F.lit(1)), F.coalesce(F.sum(label), F.lit(0.0))).first()
    base = allowed / n if n else 1.0
    for k in SUFFIXES:                                               # at most SUFFIX_BUCKETS rows each
        rates = (labelled.groupBy(f"suffix_{k}").agg(F.count(F.lit(1)).alias("_n"), F.sum(label).alias("_a"))
                 .select(f"suffix_{k}", ((F.col("_a") + PRIOR * base) / (F.col("_n") + PRIOR)).alias(f"rate_{k}"),
                         F.log1p("_n").alias(f"seen_{k}")))
        rows = rows.join(F.broadcast(rates), f"suffix_{k}", "left").fillna({f"rate_{k}": base, f"seen_{k}": 0.0})
    if n == 0 or allowed in (0, n):
        p = F.lit(float(base))
        judged = rows.withColumn("p_allow", F.when(F.col("said").isNull(), p))
    else:
        ready = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)
        share = min(1.0, bound / n)
        draw = F.pmod(F.xxhash64(F.lit(seed), "id", "host", "path"), F.lit(1 << 20)) < int(share * (1 << 20))
        sample = materialize(ready.where("said IS NOT NULL").where(draw).select("features", label.alias("label"))
                             .coalesce(8), "url-sample")
        model = GBTClassifier(maxIter=12, maxDepth=4, stepSize=0.3, seed=seed, maxMemoryInMB=64).fit(sample)
        judged = (model.transform(ready)
                  .withColumn("p_allow", F.when(F.col("said").isNull(), vector_to_array("probability")[1])))
    verdict = F.coalesce("said", F.when(F.col("p_allow") >= 0.5, "allow").otherwise("block"))
    return judged.select("id", "host", "path", "rule", verdict.alias("verdict"), "p_allow")
