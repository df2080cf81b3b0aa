"""URL filters: rules, and the likelihood ratio of two character models of variable order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, lower_ascii, materialise, table

#: (host and path, verdict). A rule fits its host and all subdomains where the path starts with the rule's.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
#: A URL whose host has one of these between dots and hyphens is an example of a rejected one; all others of an accepted one.
REJECTED = (
    "ads adserver track tracker spam casino poker slots bets betting pills pharma viagra cialis adult porn xxx sex cams "
    "loans payday warez torrent malware phishing"
).split()
#: Characters of the longest context; weight of the shorter one; characters that any string may hold.
CONTEXT, PRIOR, ALPHABET = 4, 2.0, 256
#: n-grams of the model are seen this often at least.
SEEN = 2
#: Part of the strings that is not learnt from but sets the threshold, and the width of its score bins.
FOLDS, BIN = 5, 0.01
START = "\n"


def parsed(url: Column) -> tuple[Column, Column]:
    """(host, path): after the first ``://`` up to ``/``, ``?``, ``#`` or end, and then up to ``?``, ``#`` or end."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return lower_ascii(F.regexp_extract(rest, "^[^/?#]*", 0)), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def ruled(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The rule and the verdict of the longest rule that fits, else null."""
    fits = F.lit(None).cast("string")
    verdict = F.lit(None).cast("string")
    for rule, says in sorted(rules, key=lambda r: len(r[0])):
        name, slash, rest = rule.partition("/")
        here = ((host == name) | F.endswith(host, F.lit(f".{name}"))) & F.startswith(path, F.lit(slash + rest))
        fits = F.when(here, F.lit(rule)).otherwise(fits)
        verdict = F.when(here, F.lit(says)).otherwise(verdict)
    return fits, verdict


def _grams(strings: DataFrame, keep: list[str], longest: int) -> DataFrame:
    """One row for each character but the start: ``gram``, it and the characters before it, ``longest`` in all."""
    s = F.col("s")
    places = F.sequence(F.lit(2), F.length(s))
    each = F.transform(
        places, lambda i: F.substring(s, F.greatest(i - longest + 1, F.lit(1)), F.least(i, F.lit(longest)))
    )
    return strings.where(F.length(s) > 1).select(*keep, F.explode(each).alias("gram"))


def model(strings: DataFrame, context: int = CONTEXT) -> DataFrame:
    """(gram, value, failed) from (s, rejected, n): log P(rejected) - log P(accepted), in each of the two models.

    ``value`` is that of the gram's last character after the others; ``failed`` that of falling back from the whole gram
    as a context to the one without its first character. A character after a context has its count and the prior times
    its probability after the shorter context, over the context's count and the prior. Counts are of all strings;
    grams of small counts are left to their shorter contexts, whatever the size of the table.
    """
    n = F.col("n")
    longest = context + 1
    whole = (
        _grams(strings, ["rejected", "n"], longest)
        .groupBy("gram")
        .agg(F.sum(F.when(F.col("rejected"), n).otherwise(0)).alias("r"), F.sum(F.when(F.col("rejected"), 0).otherwise(n)).alias("a"))
    )
    # A gram's ends are the grams that are shorter.
    ends = F.explode(F.transform(F.sequence(F.lit(1), F.length("gram")), lambda k: F.substring(F.col("gram"), -k, k)))
    counts = materialise(
        whole.select(ends.alias("gram"), "r", "a").groupBy("gram").agg(F.sum("r").alias("r"), F.sum("a").alias("a")), "url-grams"
    )
    after = counts.groupBy(F.expr("substring(gram, 1, length(gram) - 1)").alias("ctx")).agg(F.sum("r").alias("cr"), F.sum("a").alias("ca"))
    after = materialise(after, "url-contexts")
    share = lambda c, low, all_: (F.col(c) + PRIOR * low) / (F.col(all_) + PRIOR)
    levels, below = [], None
    for k in range(1, longest + 1):
        here = counts.where(F.length("gram") == k).withColumn("ctx", F.expr("substring(gram, 1, length(gram) - 1)")).join(after, "ctx")
        if below is None:
            low_r = low_a = F.lit(1.0 / ALPHABET)
        else:
            here = here.withColumn("end", F.expr("substring(gram, 2)")).join(
                below.select(F.col("gram").alias("end"), F.col("pr").alias("low_r"), F.col("pa").alias("low_a")), "end"
            )
            low_r, low_a = F.col("low_r"), F.col("low_a")
        below = here.select("gram", "r", "a", share("r", low_r, "cr").alias("pr"), share("a", low_a, "ca").alias("pa"))
        below = materialise(below, "url-level")
        levels.append(below)
    full = reduce(DataFrame.union, levels).where((F.col("r") + F.col("a") >= SEEN) | (F.length("gram") == 1))
    fall = F.log((F.coalesce("ca", F.lit(0)) + PRIOR) / (F.coalesce("cr", F.lit(0)) + PRIOR))
    return full.join(after.withColumnRenamed("ctx", "gram"), "gram", "left").select(
        "gram", F.log(F.col("pr") / F.col("pa")).alias("value"), fall.alias("failed")
    )


def scored(strings: DataFrame, grams: DataFrame, context: int = CONTEXT) -> DataFrame:
    """(s, score) of distinct strings: the log-likelihood difference for each character.

    For each character the longest gram of the model that ends at it counts, and what falling back to it costs. That is
    worked out once for each distinct gram of the strings, the short ones first, by joins on keys that only as many grams
    share as there are characters; Spark broadcasts what its size check allows.
    """
    longest = context + 1
    rows = _grams(strings, ["s"], longest)
    ends = F.explode(F.transform(F.sequence(F.lit(1), F.length("gram")), lambda k: F.substring(F.col("gram"), -k, k)))
    own = materialise(rows.select("gram").distinct().select(ends.alias("gram")).distinct(), "url-ends")
    falls = grams.select(F.col("gram").alias("ctx"), "failed")
    levels, below = [], None
    for k in range(1, longest + 1):
        here = own.where(F.length("gram") == k).join(grams.select("gram", "value"), "gram", "left")
        if below is None:
            t = F.coalesce("value", F.lit(0.0))
        else:
            here = here.withColumn("ctx", F.expr("substring(gram, 1, length(gram) - 1)")).join(falls, "ctx", "left")
            here = here.withColumn("end", F.expr("substring(gram, 2)")).join(below.select(F.col("gram").alias("end"), F.col("t").alias("low")), "end")
            t = F.coalesce("value", F.coalesce("failed", F.lit(0.0)) + F.col("low"))
        below = materialise(here.select("gram", t.alias("t")), "url-steps")
        levels.append(below)
    each = rows.join(reduce(DataFrame.union, levels), "gram")
    return each.groupBy("s").agg((F.sum("t") / F.count("*")).alias("score"))


def threshold(judged: DataFrame) -> float | None:
    """The score that parts (score, rejected, n) best: fewest shares of rejected below and of accepted above it.

    Only a histogram of the scores reaches the driver. Without examples of both kinds there is none.
    """
    n = F.col("n")
    bin_ = F.floor(F.least(F.greatest(F.col("score"), F.lit(-20.0)), F.lit(20.0)) / BIN).cast("int")
    rows = judged.groupBy(bin_.alias("b")).agg(
        F.sum(F.when(F.col("rejected"), n).otherwise(0)).alias("r"), F.sum(F.when(F.col("rejected"), 0).otherwise(n)).alias("a")
    )
    bins = sorted((x["b"], x["r"], x["a"]) for x in rows.collect())
    bad, good = sum(r for _, r, _ in bins), sum(a for _, _, a in bins)
    if not bad or not good:
        return None
    missed, wrong, best = 0.0, 1.0, []
    for i, (b, r, a) in enumerate(bins):
        missed, wrong = missed + r / bad, wrong - a / good
        upper = bins[i + 1][0] if i + 1 < len(bins) else b + 1
        best.append((missed + wrong, (b + 1 + upper) / 2 * BIN))
    least = min(x for x, _ in best)
    same = [t for x, t in best if x <= least + 1e-12]
    return same[len(same) // 2]


def judged(pages: DataFrame, rules=RULES, rejected=REJECTED, url: str = "url") -> DataFrame:
    """Add host, path, rule, verdict, score to each row; columns of the input with these names are replaced.

    Where no rule fits, a URL is blocked if its score is above the threshold. Strings are host and path, digits as
    zeros, so pages of one host are few strings. Two models are learnt from four fifths of the strings of examples, the
    threshold from the rest. Null URLs and those without ``://`` have an empty host and path, score zero, and are
    allowed, as all are if there are no examples of either kind. Rows that repeat are judged alike; none is dropped. An
    empty table gives an empty result.
    """
    host, path = parsed(F.col(url))
    own = [F.col(f"`{c}`") for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict", "score")]
    (whole,) = fresh(pages, "_s")
    rows = pages.select(*own, host.alias("host"), path.alias("path"))
    zeros = F.translate(F.concat("host", F.lower("path")), "123456789", "000000000")
    rows = rows.withColumn(whole, F.when(zeros != "", F.concat(F.lit(START), zeros, F.lit(START))))
    seed = F.arrays_overlap(F.split("host", "[.-]"), F.array(*map(F.lit, rejected)))
    strings = materialise(
        rows.where(F.col(whole).isNotNull()).groupBy(F.col(whole).alias("s")).agg(F.count("*").alias("n"), F.bool_or(seed).alias("rejected")),
        "url-strings",
    )
    held = F.pmod(F.xxhash64("s"), F.lit(FOLDS)) == 0
    grams = materialise(model(strings.where(~held)), "url-values")
    scores = materialise(scored(strings, grams).join(strings, "s"), "url-scores")
    limit = threshold(scores.where(held))
    if limit is None:
        limit = threshold(scores)
    fits, verdict = ruled(F.col("host"), F.col("path"), rules)
    score = F.coalesce("score", F.lit(0.0))
    over = (score > limit) if limit is not None else F.lit(False)
    out = rows.join(scores.select(F.col("s").alias(whole), "score"), whole, "left").drop(whole)
    return out.withColumns(
        {
            "rule": fits,
            "verdict": F.coalesce(verdict, F.when(over, F.lit("block")).otherwise(F.lit("allow"))),
            "score": score,
        }
    )


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judged(pages).select("page_id", "host", "path", "rule", "verdict", "score")
