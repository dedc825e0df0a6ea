"""URL filter: rules first, gradient-boosted trees on lexical features for the rest.

A rule is a host and a path prefix; it fits the host and its subdomains, and
the longest fitting rule decides. The URLs that a rule decides are the labelled
ones: all the distinct ones train Spark ML's boosted trees, on length, depth,
digit ratio, entropy, parameter counts and the statistics of the host's suffix
among them. The trees judge every URL without a rule. Only the trees, bounded
by TREES and DEPTH, and the suffix table, no longer than the rules, go to the
driver or are broadcast: the host of a labelled URL ends in that of a rule.

Defined cases: a null url, or one without ``://``, has an empty host and path,
fits no rule and is judged by the trees; with no labelled URL at all every
verdict of the method is ``allow``, with labels of one kind it is that kind;
repeated rows get equal verdicts; extra columns are ignored.
"""

from __future__ import annotations

import string

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditlens.llm.common import materialise

#: (verdict, host, path prefix).
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))
TREES, DEPTH, SEED = 20, 4, 7

FEATURES = ["length", "host_length", "path_length", "depth", "digit_ratio", "entropy", "n_params", "n_labels",
            "n_hyphens", "is_https", "suffix_block_rate", "suffix_count"]


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule's text and verdict, else null."""
    name = verdict = F.lit(None).cast("string")
    for kind, of, prefix in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == of) | host.endswith("." + of)) & path.startswith(prefix)
        name = F.when(fits, F.lit(of + prefix)).otherwise(name)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def _entropy(text: Column) -> Column:
    """Bits per character; all that is not printable ASCII counts as one kind."""
    plain = F.regexp_replace(text, r"[^\x21-\x7E]", " ")
    size = F.length(plain)

    def bits(total: Column, char: Column) -> Column:
        share = (size - F.length(F.replace(plain, char, F.lit("")))) / size
        return total - share * F.log2(share)
    return F.when(size > 0, F.aggregate(F.array_distinct(F.split(plain, "")), F.lit(0.0), bits)).otherwise(0.0)


def _lexical(rows: DataFrame) -> DataFrame:
    url = F.coalesce("url", F.lit(""))
    size = F.length(url)
    count = lambda c, char: F.length(c) - F.length(F.replace(c, F.lit(char), F.lit("")))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    return rows.withColumns({
        "length": size, "host_length": F.length("host"), "path_length": F.length("path"),
        "depth": count(F.col("path"), "/"),
        "digit_ratio": F.when(size > 0, F.length(F.regexp_replace(url, r"[^0-9]", "")) / size).otherwise(0.0),
        "entropy": _entropy(url),
        "n_params": F.when(query == "", 0).otherwise(count(query, "&") + 1),
        "n_labels": F.when(F.col("host") == "", 0).otherwise(count(F.col("host"), ".") + 1),
        "n_hyphens": count(F.col("host"), "-"), "is_https": url.startswith("https://").cast("int"),
        "suffix": F.regexp_extract("host", r"[^.]*$", 0)})


def _with_suffixes(rows: DataFrame, suffixes: DataFrame) -> DataFrame:
    found = _lexical(rows).join(F.broadcast(suffixes), "suffix", "left")
    found = found.withColumn("suffix_block_rate", F.coalesce((F.col("blocked") + 1) / (F.col("seen") + 2), F.lit(0.5)))
    found = found.withColumn("suffix_count", F.log1p(F.coalesce("seen", F.lit(0))))
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(found)


def train(labelled: DataFrame):
    """(url, host, path, verdict) -> (model or None, suffix table, the only label)."""
    once = labelled.groupBy("url").agg(*(F.first(c).alias(c) for c in ("host", "path", "verdict")))
    # sorted, so that reruns meet the same rows in the same order
    known = materialise(once.orderBy(F.xxhash64("url"), "url")
                        .withColumn("label", (F.col("verdict") == "block").cast("double")), "url-labelled")
    suffixes = materialise(_lexical(known).groupBy("suffix").agg(
        F.count(F.lit(1)).alias("seen"), F.sum("label").alias("blocked")), "url-suffixes")
    kinds = [r["verdict"] for r in known.select("verdict").distinct().collect()]
    if len(kinds) < 2:
        return None, suffixes, kinds[0] if kinds else "allow"
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=SEED, stepSize=0.2)
    return trees.fit(_with_suffixes(known, suffixes).select("features", "label")), suffixes, None


def judge(pages: DataFrame, rules=RULES, id_col="page_id", url_col="url") -> DataFrame:
    """One row per input row: page_id, host, path, rule, verdict, block_score
    (the trees' probability, null where a rule decides)."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
    host, path = split_url(F.col("url"))
    rows = rows.withColumns({"host": host, "path": path})
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "verdict": verdict})
    model, suffixes, only = train(rows.where("rule IS NOT NULL").select("url", "host", "path", "verdict"))
    columns = ["page_id", "host", "path", "rule", "verdict", "block_score"]
    if model is None:
        score = F.when(F.col("rule").isNull(), F.lit(float(only == "block")))
        return rows.withColumn("block_score", score).withColumn(
            "verdict", F.coalesce("verdict", F.lit(only))).select(columns)
    scored = model.transform(_with_suffixes(rows.where("rule IS NULL"), suffixes))
    scored = scored.withColumn("block_score", vector_to_array("probability")[1]).withColumn(
        "verdict", F.when(F.col("prediction") > 0.5, "block").otherwise("allow"))
    ruled = rows.where("rule IS NOT NULL").withColumn("block_score", F.lit(None).cast("double"))
    return ruled.select(columns).unionByName(scored.select(columns))
