"""URL filters: fixed host and path rules, and association rules mined from the urls those judge."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
SUPPORT, CONFIDENCE = 0.02, 0.9
INDEX_ROWS = 100_000  # a larger rule index is not broadcast
ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class Rule:
    """Fits ``host`` and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def url_host(url: str = "url") -> Column:
    """After the first :// up to /, ? or #, with A-Z in lower case; empty without :// or url."""
    return F.translate(F.coalesce(F.regexp_extract(F.col(url), PARTS, 1), F.lit("")), UPPER, LOWER)


def url_path(url: str = "url") -> Column:
    """Behind the host up to ? or #; empty without :// or url."""
    return F.coalesce(F.regexp_extract(F.col(url), PARTS, 2), F.lit(""))


def url_tokens(url: str = "url", host: str = "host", path: str = "path") -> Column:
    """The distinct tokens of a url, sorted: scheme, domain labels, words of the path, suffix, query keys, fragment.

    Numbers are left out, so that the number of different token sets stays far below that of urls.
    """
    labels = F.split(F.col(host), r"\.")
    words = F.filter(F.split(F.col(path), "/"), lambda s: s.rlike("^[A-Za-z_-]+$"))
    query = F.regexp_extract(F.col(url), r"(?s)^[^?#]*\?([^#]*)", 1)
    keys = F.filter(F.transform(F.split(query, "&"), lambda p: F.split(p, "=")[0]), lambda k: F.length(k) > 0)
    suffix = F.regexp_extract(F.col(path), r"\.([A-Za-z]{1,8})$", 1)
    named = lambda kind, items: F.transform(items, lambda x: F.concat(F.lit(f"{kind}="), x))
    one = lambda kind, item: F.when(F.length(item) > 0, F.array(F.concat(F.lit(f"{kind}="), item))).otherwise(F.array())
    tokens = F.concat(
        one("scheme", F.lower(F.regexp_extract(F.col(url), r"(?s)^([^:/?#]*)://", 1))),
        named("label", F.filter(labels, lambda s: F.length(s) > 0)), one("top", F.element_at(labels, -1)),
        named("word", words), one("suffix", suffix), named("key", keys),
        F.when(F.instr(F.col(url), "#") > 0, F.array(F.lit("fragment"))).otherwise(F.array()),
    )
    return F.when(F.col(url).isNull(), F.array().cast("array<string>")).otherwise(F.array_sort(F.array_distinct(tokens)))


def fitting_rule(rules: list[Rule], host: str = "host", path: str = "path", value: str = "name") -> Column:
    """The name (or verdict) of the longest rule that fits, else null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = ((F.col(host) == rule.host) | F.col(host).endswith(f".{rule.host}")) & F.col(path).startswith(rule.path)
        found = F.when(fits, F.lit(getattr(rule, value))).otherwise(found)
    return found


def mined(labelled: DataFrame, tokens: str = "tokens", verdict: str = "verdict", support: float = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """Association rules token set -> verdict that reach support and confidence: antecedent, said, confidence, support.

    A rule is pruned if a part of its tokens says the same with no less confidence. No labelled rows give no rules.
    """
    spark = labelled.sparkSession
    said = F.concat(F.lit("verdict="), F.col(verdict))
    baskets = labelled.select(F.array_union(F.col(tokens), F.array(said)).alias("items"))
    if baskets.isEmpty():
        return spark.createDataFrame([], "antecedent array<string>, said string, confidence double, support double")
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(baskets)
    spoken = F.element_at("consequent", 1)
    found = model.associationRules.where(spoken.startswith("verdict=")).select(
        F.array_sort("antecedent").alias("antecedent"), F.substring(spoken, 9, 100).alias("said"), "confidence", "support"
    )
    # A rule minus one token is itself frequent, so looking one level up prunes all levels in turn.
    parents = found.select("said", F.explode("antecedent").alias("t"), "antecedent", "confidence").select(
        "said", "antecedent", F.array_remove("antecedent", F.col("t")).alias("parent"), "confidence"
    )
    known = found.select("said", F.col("antecedent").alias("parent"), F.col("confidence").alias("parent_confidence"))
    needless = parents.join(known, ["said", "parent"]).where("parent_confidence >= confidence").select("said", "antecedent")
    return found.join(needless.distinct(), ["said", "antecedent"], "left_anti").select("antecedent", "said", "confidence", "support")


def matched(token_sets: DataFrame, rules: DataFrame, tokens: str = "tokens") -> DataFrame:
    """Per distinct token set that any rule fits: the tokens, and verdict, confidence and antecedent of its best rule.

    Rules are found through an inverted index: a rule fits where as many of its tokens are looked up as it
    has. The best rule has the highest confidence, then the highest support, then the most tokens, then block before allow.
    """
    numbered = rules.withColumn("n", F.size("antecedent")).withColumn("rule_id", F.xxhash64("antecedent", "said"))
    index = numbered.select(F.explode("antecedent").alias("token"), "rule_id", "n")
    if index.limit(INDEX_ROWS + 1).count() <= INDEX_ROWS:
        index, numbered = F.broadcast(index), F.broadcast(numbered)
    sets = token_sets.select(F.col(tokens).alias("tokens")).distinct()
    hits = sets.select("tokens", F.explode("tokens").alias("token")).join(index, "token")
    whole = hits.groupBy("tokens", "rule_id", "n").agg(F.count("*").alias("found")).where("found = n")
    best = F.max(F.struct("confidence", "support", "n", F.col("said").alias("verdict"), "antecedent")).alias("best")
    return whole.select("tokens", "rule_id").join(numbered, "rule_id").groupBy("tokens").agg(best).select(
        "tokens", "best.verdict", "best.confidence", "best.antecedent"
    )


def filtered(
    pages: DataFrame, rules: list[Rule], page: str = "page_id", url: str = "url", support: float = SUPPORT, confidence: float = CONFIDENCE
) -> DataFrame:
    """Per page: ``page``, host, path, rule, verdict, mined_confidence, mined_tokens.

    Fixed rules decide first. The urls they judge are the labels from which association rules are mined; these judge
    the rest, and what no rule fits is allowed. All pages take part in mining. Null urls and urls
    without :// have empty host and path, hold no token and are allowed; repeated pages each give a row; other columns are dropped.
    """
    parts = pages.select(F.col(page), F.col(url).alias("url")).withColumns({"host": url_host(), "path": url_path()})
    parts = parts.withColumns({"rule": fitting_rule(rules), "given": fitting_rule(rules, value="verdict"), "tokens": url_tokens()})
    learned = mined(parts.where("given IS NOT NULL"), verdict="given", support=support, confidence=confidence)
    judged = matched(parts.where("given IS NULL"), learned).select("tokens", "verdict", "confidence", "antecedent")
    joined = parts.join(judged, "tokens", "left")
    return joined.select(
        page, "host", "path", "rule", F.coalesce("given", "verdict", F.lit(ALLOW)).alias("verdict"),
        F.when(F.col("given").isNull(), F.col("confidence")).alias("mined_confidence"),
        F.when(F.col("given").isNull(), F.col("antecedent")).alias("mined_tokens"),
    )
