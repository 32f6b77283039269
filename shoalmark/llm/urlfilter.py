"""URL filtering: explicit host and path rules first, mined association rules for the rest.

FP-growth finds combinations of URL tokens that go together with a block label. Rules with enough
support and confidence are matched through an inverted index: each rule is listed under its rarest
token, so a URL meets only the rules of its own tokens.
"""

from __future__ import annotations

import string

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

_BLOCK = "label=block"


def lower_ascii(col: Column) -> Column:
    return F.translate(col, string.ascii_uppercase, string.ascii_lowercase)


def host_of(url: Column) -> Column:
    """From the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens_of(url: Column) -> Column:
    """Distinct tokens: the parts of the host, path segments, query names; digits are one token."""
    host, path = host_of(url), path_of(url)
    query = F.coalesce(F.regexp_extract(url, r"(?s)\?([^#]*)", 1), F.lit(""))

    def named(prefix: str, parts: Column) -> Column:
        shaped = F.transform(parts, lambda p: F.regexp_replace(p, "[0-9]+", "0"))
        return F.transform(F.filter(shaped, lambda p: p != ""), lambda p: F.concat(F.lit(prefix), p))

    names = F.transform(F.split(query, "&"), lambda q: F.regexp_extract(q, "^([^=]*)", 1))
    return F.array_distinct(
        F.concat(
            named("host:", F.split(host, r"\.")),
            named("path:", F.split(lower_ascii(path), "/")),
            named("query:", F.transform(names, lower_ascii)),
        )
    )


def explicit_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """Rule text and verdict of the longest fitting rule, nulls if none fits.

    ``rules`` are pairs of verdict and ``host/path``. A rule fits its host and all subdomains if the
    path begins with the rule's. Of rules of equal length the first in order of text wins.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: (len(r[1]), [-ord(c) for c in r[1]])):
        at = text.index("/")
        own = (host == text[:at]) | host.endswith("." + text[:at])
        fits = own & path.startswith(text[at:])
        rule = F.when(fits, text).otherwise(rule)
        verdict = F.when(fits, what).otherwise(verdict)
    return rule, verdict


def mine_rules(
    labelled: DataFrame, min_rows: int = 20, min_confidence: float = 0.6, min_lift: float = 1.5
) -> DataFrame:
    """(rule_id, tokens, confidence, lift) mined from rows (url, block boolean).

    A rule says that URLs with all its ``tokens`` are blocked. It needs ``min_rows`` blocked rows,
    and the given confidence and lift. A rule is pruned if a part of its tokens already makes a rule
    of the same or higher confidence. Null URLs and labels teach nothing.
    """
    rows = labelled.where(F.col("url").isNotNull() & F.col("block").isNotNull()).select(
        F.concat(
            tokens_of(F.col("url")),
            F.when(F.col("block"), F.array(F.lit(_BLOCK))).otherwise(F.array().cast("array<string>")),
        ).alias("items")
    )
    total = rows.count()
    schema = "rule_id bigint, tokens array<string>, confidence double, lift double"
    if not total:
        return labelled.sparkSession.createDataFrame([], schema)
    model = FPGrowth(
        itemsCol="items", minSupport=min(1.0, min_rows / total), minConfidence=min_confidence
    ).fit(rows)
    found = (
        model.associationRules.where(F.col("consequent")[0] == _BLOCK)
        .where((F.col("lift") >= min_lift) & (F.round(F.col("support") * total) >= min_rows))
        .select(F.array_sort("antecedent").alias("tokens"), "confidence", "lift")
    )
    small, large = found.alias("s"), found.alias("l")
    # Joined on one token of the smaller rule, so that only rules with a common token meet.
    covered = (
        large.select("*", F.explode("tokens").alias("token"))
        .join(small.select(F.col("tokens").alias("part"), F.col("confidence").alias("pc"),
                           F.col("tokens")[0].alias("token")), "token")
        .where((F.size("part") < F.size("tokens")) & (F.col("pc") >= F.col("confidence")))
        .where(F.size(F.array_except("part", "tokens")) == 0)
        .select("tokens")
    )
    kept = found.join(covered.distinct(), "tokens", "left_anti")
    return kept.select(F.xxhash64("tokens").alias("rule_id"), "tokens", "confidence", "lift")


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, rules) for the distinct URLs on which at least one rule fires, rules in order."""
    tokenised = urls.where(F.col("url").isNotNull()).select("url").distinct().select(
        "url", tokens_of(F.col("url")).alias("url_tokens")
    )
    wanted = rules.select("rule_id", "tokens", F.explode("tokens").alias("token"))
    common = (
        tokenised.select(F.explode("url_tokens").alias("token"))
        .join(wanted.select("token").distinct(), "token", "left_semi")
        .groupBy("token").agg(F.count("*").alias("seen"))
    )
    index = (
        wanted.join(common, "token", "left")
        .groupBy("rule_id", "tokens")
        .agg(F.min(F.struct(F.coalesce("seen", F.lit(0)), "token"))["token"].alias("token"))
    )
    met = tokenised.select("url", "url_tokens", F.explode("url_tokens").alias("token")).join(
        index, "token"
    )
    fired = met.where(F.size(F.array_except("tokens", "url_tokens")) == 0)
    return fired.groupBy("url").agg(F.sort_array(F.collect_set("rule_id")).alias("rules"))


def judge(
    pages: DataFrame, rules: list[tuple[str, str]], mined: DataFrame | None = None
) -> DataFrame:
    """(page_id, host, path, rule, verdict, mined_rules) of every row of ``pages``.

    The explicit rule decides; without one, a URL is blocked if a mined rule fires and else allowed.
    Null URLs, and those without ``://``, have an empty host and path, no tokens and are allowed.
    Repeated rows give repeated results; an empty table gives none; other columns are ignored.
    """
    url = F.col("url")
    rows = pages.select("page_id", "url", host_of(url).alias("host"), path_of(url).alias("path"))
    rule, verdict = explicit_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "said": verdict})
    none = F.array().cast("array<bigint>")
    if mined is None:
        rows = rows.withColumn("rules", none)
    else:
        rows = rows.join(match_rules(pages, mined), "url", "left")
    fired = F.coalesce(F.col("rules"), none)
    return rows.select(
        "page_id", "host", "path", "rule",
        F.coalesce("said", F.when(F.size(fired) > 0, "block").otherwise("allow")).alias("verdict"),
        fired.alias("mined_rules"),
    )
