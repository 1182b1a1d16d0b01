"""URL filters by association rules, with DataFrame operations only.

Base rules (host, path, verdict) judge the urls they fit: the host itself and its subdomains, if the path starts with the
rule's; the longest wins. The urls so judged are the labels: Spark's FP-growth mines which combinations
of url tokens go along with a verdict. Rules of enough support and confidence are kept unless a rule on fewer of the same
tokens is as confident. They are matched by an inverted index: a rule is listed under its rarest token, a url looks up its
tokens and then must hold all of the rule's. The most confident rule gives the verdict of the urls that
no base rule fits; ``allow`` where none matches. Null urls, or without ``://``: host and path are empty.

The number of rules follows from the least support and not from the number of urls. Tokens that many urls hold together make many itemsets: a shape of url that is more frequent than the least
support, with very many parameters, wants a larger ``min_support``.

Repeated urls count as often as they occur and get one verdict; pages that repeat have a row each. Ties between rules: more tokens, then block, then the tokens' order. An empty table gives no rows.
Only page_id and url are read, whatever other columns are called.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cantora.llm.common import materialize, table

#: (host, path, verdict)
BASE_RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))
MIN_SUPPORT, MIN_CONFIDENCE = 0.01, 0.8
LABEL = "verdict:"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """After the first ``://``: the host up to ``/``, ``?``, ``#`` or the end, and the path up to ``?``, ``#`` or the end."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def base_rule(host: Column, path: Column, rules=BASE_RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, or null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for h, p, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens: labels of the host, the shapes of the path's segments (numbers as #), names in the query."""
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\?([^#]*)", 1)
    tagged = lambda tag, parts, form: F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.concat(F.lit(tag), form(x)))
    return F.array_distinct(
        F.concat(
            tagged("host:", F.split(host, r"\."), lambda x: x),
            tagged("path:", F.split(path, "/"), lambda x: F.regexp_replace(F.lower(x), r"\d+", "#")),
            tagged("query:", F.split(query, "&"), lambda x: F.lower(F.substring_index(x, "=", 1))),
        )
    )


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Rules (tokens, verdict, confidence, support, index_token) from ``labelled`` (tokens, verdict)."""
    baskets = labelled.select(F.array_append("tokens", F.concat(F.lit(LABEL), "verdict")).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)
    rules = model.associationRules.where(F.element_at("consequent", 1).startswith(LABEL) & (F.size("antecedent") > 0))
    rules = rules.where(~F.exists("antecedent", lambda x: x.startswith(LABEL))).select(
        F.array_sort("antecedent").alias("tokens"), F.substring(F.element_at("consequent", 1), len(LABEL) + 1, 1 << 20).alias("verdict"), "confidence", "support"
    )
    rules = materialize(rules)
    # a rule goes if a part of its tokens says the same with no less confidence; such a part holds one of its tokens
    parts = rules.select(F.col("tokens").alias("part"), "verdict", F.col("confidence").alias("part_confidence"), F.element_at("tokens", 1).alias("t"))
    wide = rules.withColumn("t", F.explode("tokens")).join(parts, ["t", "verdict"])
    worse = wide.where((F.size("part") < F.size("tokens")) & (F.size(F.array_except("part", "tokens")) == 0) & (F.col("part_confidence") >= F.col("confidence"))).select("tokens", "verdict").distinct()
    kept = rules.join(worse, ["tokens", "verdict"], "left_anti")
    singles = model.freqItemsets.where(F.size("items") == 1).select(F.element_at("items", 1).alias("t"), "freq")
    indexed = kept.select("*", F.explode("tokens").alias("t")).join(singles, "t").groupBy("tokens", "verdict", "confidence", "support").agg(F.min(F.struct("freq", "t")).alias("rarest"))
    return materialize(indexed.select("tokens", "verdict", "confidence", "support", F.col("rarest.t").alias("index_token")))


def judge(pages: DataFrame, base=BASE_RULES, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """(page_id, host, path, rule, verdict, method_rule, method_confidence) per row of ``pages`` (page_id, url)."""
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    rows = rows.withColumn("base", base_rule(F.col("host"), F.col("path"), base))
    with_tokens = rows.withColumn("tokens", tokens(F.col("url"), F.col("host"), F.col("path")))
    rules = mine(with_tokens.where("base is not null").select("tokens", F.col("base.verdict").alias("verdict")), min_support, min_confidence)
    # each different open url looks its tokens up once
    open_urls = with_tokens.where("base is null and url is not null").groupBy("url").agg(F.first("tokens").alias("url_tokens"))
    hits = open_urls.select("url", "url_tokens", F.explode("url_tokens").alias("index_token")).join(rules, "index_token").where(F.size(F.array_except("tokens", "url_tokens")) == 0)
    # most confident first; then more tokens, then block, then the tokens' order
    best = hits.groupBy("url").agg(F.max(F.struct("confidence", F.size("tokens").alias("n"), "verdict", "tokens")).alias("best"))
    judged = rows.join(best, "url", "left")
    return judged.select(
        "page_id", "host", "path", F.col("base.rule").alias("rule"), F.coalesce("base.verdict", "best.verdict", F.lit("allow")).alias("verdict"),
        F.when(F.col("base").isNull(), F.array_join("best.tokens", " ")).alias("method_rule"), F.when(F.col("base").isNull(), F.col("best.confidence")).alias("method_confidence"),
    )


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict for every url of ``pages``."""
    return judge(table(spark, sf_dir, "pages"))
