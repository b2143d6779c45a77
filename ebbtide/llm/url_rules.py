"""URL filters: fixed rules, and association rules mined from what the fixed rules label.

A fixed rule names a host, which covers its subdomains, and a path prefix; of those that
fit, the longest decides. The URLs that a fixed rule judges are the labels: Spark's
FP-growth mines combinations of up to three URL tokens with a verdict, pruned by support
and confidence, then by redundancy. The remaining rules match through an inverted index: a
rule stands under one of its tokens, and a URL that has this token is tested for the
others. Built-in functions and FP-growth only.

Tokens of a URL: scheme, every host label, neighbouring host labels, path segments with
all digits as ``#``, and the names of query parameters.

Defined results: a null URL or one without ``://`` has an empty host and path and no
tokens and gets the default verdict, as does any URL without a matching rule; of several
matching rules the one of highest confidence, then support, then block before allow,
decides; repeated rows are judged alike; an empty table gives an empty table.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm.shared import ascii_lower, staged, table

ALLOW, BLOCK = "allow", "block"
VERDICT_TOKENS = {"=allow": ALLOW, "=block": BLOCK}


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("org", "/", ALLOW),
    Rule("example.org", "/es/", BLOCK),
    Rule("example.org", "/en/1", BLOCK),
    Rule("com", "/fr/", ALLOW),
    Rule("com", "/de/", BLOCK),
)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fixed_rule(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Name of the longest rule that fits, else null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        own = (host == rule.host) | F.endswith(host, F.lit("." + rule.host))
        found = F.when(own & F.startswith(path, F.lit(rule.path)), rule.name).otherwise(found)
    return found


def verdict_of(rule: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    return F.coalesce(*[F.when(rule == r.name, r.verdict) for r in rules])


def tokens(url: Column, host: Column, path: Column) -> Column:
    """The distinct tokens of a URL; none if it has no ``://``."""
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    pairs = F.zip_with(labels, F.slice(labels, 2, F.greatest(F.size(labels), F.lit(1))), lambda a, b: F.concat_ws(".", a, b))
    segments = F.filter(F.split(path, "/"), lambda x: x != "")
    names = F.split(F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1), "&")
    names = F.filter(F.transform(names, lambda x: F.substring_index(x, "=", 1)), lambda x: x != "")
    general = lambda x: F.regexp_replace(x, "[0-9]+", "#")
    parts = [
        F.array(F.concat(F.lit("scheme:"), F.substring_index(url, "://", 1))),
        F.transform(labels, lambda x: F.concat(F.lit("host:"), x)),
        F.transform(F.filter(pairs, lambda x: x.contains(".")), lambda x: F.concat(F.lit("domain:"), x)),
        F.transform(segments, lambda x: F.concat(F.lit("path:"), general(x))),
        F.transform(names, lambda x: F.concat(F.lit("query:"), general(x))),
    ]
    has = F.coalesce(url.contains("://"), F.lit(False))
    return F.when(has, F.array_distinct(F.concat(*parts))).otherwise(F.array().cast("array<string>"))


def merged_tokens(labelled: DataFrame, least: int) -> DataFrame:
    """Rows ``(item, members)``: tokens of at least ``least`` rows, those that always occur
    together as one item, named by its first member.

    Such tokens have equal counts and equal sums of the hashes of their rows' token sets.
    """
    row = [F.xxhash64("tokens", F.lit(seed)).cast("decimal(20,0)").alias(f"h{seed}") for seed in (1, 2)]
    posted = labelled.select(*row, F.explode("tokens").alias("token"))
    counts = posted.groupBy("token").agg(F.count("*").alias("n"), F.sum("h1").alias("h1"), F.sum("h2").alias("h2"))
    groups = counts.where(F.col("n") >= least).groupBy("n", "h1", "h2").agg(F.array_sort(F.collect_list("token")).alias("members"))
    return groups.select(F.col("members")[0].alias("item"), "members")


def itemised(labelled: DataFrame, groups: DataFrame) -> DataFrame:
    """The baskets: the items of each row's tokens and its verdict."""
    posted = labelled.select("tokens").distinct().withColumn("token", F.explode("tokens"))
    named = groups.select("item", F.explode("members").alias("token"))
    items = posted.join(named, "token").groupBy("tokens").agg(F.collect_set("item").alias("found"))
    verdict = F.array(F.concat(F.lit("="), F.col("verdict")))
    found = F.coalesce("found", F.array().cast("array<string>"))
    return labelled.join(items, "tokens", "left").select(F.concat(found, verdict).alias("items"))


def spelled_out(rules: DataFrame, groups: DataFrame) -> DataFrame:
    """Rules over tokens from rules over items: one for each choice of a member of each."""
    own = [c for c in rules.columns if c != "tokens"]
    parts = rules.select(F.col("tokens").alias("items"), *own, F.posexplode("tokens").alias("pos", "item"))
    listed = parts.join(groups, "item").groupBy("items", *own).agg(F.sort_array(F.collect_list(F.struct("pos", "members"))).alias("parts"))
    empty = F.array(F.array().cast("array<string>"))

    def extended(chosen: Column, part: Column) -> Column:
        return F.flatten(F.transform(chosen, lambda c: F.transform(part["members"], lambda m: F.array_append(c, m))))

    choices = F.explode(F.aggregate("parts", empty, extended)).alias("choice")
    return listed.select(choices, *own).select(F.array_sort("choice").alias("tokens"), *own)


def mine(
    labelled: DataFrame, min_support: float = 0.005, min_confidence: float = 0.8, max_tokens: int = 3
) -> DataFrame:
    """Rules ``(tokens, verdict, confidence, support)`` from rows ``(tokens, verdict)``, of at
    most ``max_tokens`` tokens each.

    ``min_support`` bounds the number of frequent tokens and so of rules, whatever the
    size of the table. A rule goes if another with fewer of its tokens is as confident.
    Tokens that always occur together are one item while mining, as every combination of
    them is as frequent as one of them: a long URL that is repeated costs what a short one does.
    """
    labelled = staged(labelled, "labelled")
    groups = staged(merged_tokens(labelled, math.ceil(min_support * labelled.count())), "items")
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(itemised(labelled, groups))
    rules = model.associationRules.where(
        F.col("consequent")[0].isin(*VERDICT_TOKENS)
        & (F.size("antecedent") <= max_tokens)
        & ~F.exists("antecedent", lambda x: x.isin(*VERDICT_TOKENS))
    ).select(
        F.array_sort("antecedent").alias("tokens"),
        F.expr("substring(consequent[0], 2)").alias("verdict"),
        F.round("confidence", 9).alias("confidence"),
        F.round("support", 9).alias("support"),
    )
    rules = staged(rules, "rules")
    short = rules.select(F.col("tokens").alias("fewer"), F.col("verdict").alias("same"), F.col("confidence").alias("sure"))
    redundant = (
        (F.col("verdict") == F.col("same"))
        & (F.size("fewer") < F.size("tokens"))
        & F.forall("fewer", lambda x: F.array_contains(F.col("tokens"), x))
        & (F.col("sure") >= F.col("confidence"))
    )
    keyed = rules.withColumn("key", F.explode("tokens"))
    left = keyed.join(short.withColumn("key", F.col("fewer")[0]), "key", "left").groupBy(*rules.columns).agg(
        F.coalesce(F.max(redundant), F.lit(False)).alias("redundant")
    ).where("not redundant").drop("redundant")
    return spelled_out(left, groups)


def matched(token_sets: DataFrame, rules: DataFrame, bound: int = 100_000) -> DataFrame:
    """Rows ``(tokens, mined)``: the verdict of the deciding rule for each set of tokens
    that one matches. ``token_sets`` has a column ``tokens`` without repetitions."""
    index = rules.select(
        F.col("tokens").alias("needed"),
        F.col("tokens")[0].alias("key"),
        F.struct("confidence", "support", (F.col("verdict") == BLOCK).alias("blocks")).alias("strength"),
    )
    if index.count() <= bound:
        index = F.broadcast(index)
    posted = token_sets.select("tokens", F.explode("tokens").alias("key"))
    return (
        posted.join(index, "key")
        .where(F.forall("needed", lambda x: F.array_contains(F.col("tokens"), x)))
        .groupBy("tokens")
        .agg(F.max("strength")["blocks"].alias("blocks"))
        .select("tokens", F.when(F.col("blocks"), BLOCK).otherwise(ALLOW).alias("mined"))
    )


def judge(
    pages: DataFrame,
    url: str = "url",
    key: str = "page_id",
    fixed: tuple[Rule, ...] = RULES,
    default: str = ALLOW,
    **options,
) -> DataFrame:
    """Rows ``(<key>, host, path, rule, verdict)``; ``rule`` is null where none is fixed."""
    read = pages.select(F.col(key).alias(key), F.col(url).alias("own_url")).select(
        key, "own_url", host_of(F.col("own_url")).alias("host"), path_of(F.col("own_url")).alias("path")
    )
    read = read.select(
        key,
        "host",
        "path",
        fixed_rule(F.col("host"), F.col("path"), fixed).alias("rule"),
        tokens(F.col("own_url"), F.col("host"), F.col("path")).alias("tokens"),
    )
    labelled = read.where("rule is not null").select("tokens", verdict_of(F.col("rule"), fixed).alias("verdict"))
    rules = mine(labelled, **options)
    # Stored, so that the join is one of plain tables, whose large partitions Spark splits.
    mined = staged(matched(read.where("rule is null").select("tokens").distinct(), rules), "mined")
    return read.join(mined, "tokens", "left").select(
        key,
        "host",
        "path",
        "rule",
        F.coalesce(verdict_of(F.col("rule"), fixed), F.col("mined"), F.lit(default)).alias("verdict"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))
