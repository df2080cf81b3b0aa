"""Quality rules: a threshold table compiled into one projection of built-in expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, fresh, split_words, table

#: Words of a window that counts as repeated when the text holds it twice.
WINDOW = 8
SYMBOLS = "[#*$%&|<>]"
MARKS = "[!?]"
#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and a in to is was for that with as on at by an are or from this "
    "der die das und den von zu mit ist ein eine des auf für dem im nicht als "
    "le la les de et un une en à du que qui dans est pour au sur par "
    "el los las y del se por con para es al lo como su"
).split()


@dataclass(frozen=True)
class Rule:
    """``low <= 1000 * part / whole <= high``, in whole numbers, so every engine decides alike."""

    name: str
    part: str
    whole: str
    low: int | None = None
    high: int | None = None

    def broken(self) -> Column:
        part, whole = F.col(self.part) * 1000, F.col(self.whole)
        out = F.lit(False)
        if self.low is not None:
            out = out | (part < whole * self.low)
        if self.high is not None:
            out = out | (part > whole * self.high)
        return out


#: In thousandths: letters in a word, symbols and marks for each word, stop words among words, repeated among lines.
RULES = (
    Rule("word_length", "word_chars", "n_words", 2500, 12000),
    Rule("symbols", "n_symbols", "n_words", None, 100),
    Rule("marks", "n_marks", "n_words", None, 400),
    Rule("stop_words", "n_stop_words", "n_words", 10, None),
    Rule("repeated_lines", "n_dup_lines", "n_lines", None, 500),
)


def _repeated_words(windows: Column, ordered: Column) -> Column:
    """Words in repeated windows, from (hash, place) pairs in order: places whose neighbour has the same hash."""
    last = F.size(ordered) - 1
    alike = lambda i, j: F.get(ordered, i)["h"] == F.get(ordered, j)["h"]
    places = F.array_sort(
        F.transform(
            F.filter(
                F.sequence(F.lit(0), last),
                lambda i: ((i > 0) & alike(i, F.greatest(i - 1, F.lit(0)))) | ((i < last) & alike(i, F.least(i + 1, last))),
            ),
            lambda i: F.get(ordered, i)["at"],
        )
    )
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last"))
    covered = F.aggregate(
        places,
        start,
        lambda done, at: F.struct(
            (done["n"] + F.least(F.lit(WINDOW), at - done["last"])).alias("n"), at.alias("last")
        ),
        lambda done: done["n"],
    )
    return F.when(F.size(ordered) > 0, covered).otherwise(F.lit(0).cast("long"))


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the measures that rules refer to. A null text has no words and no lines.

    Windows are compared by 64-bit hashes; the sort that finds repeated ones is done only for texts that have any.
    Columns of the input that have a measure's name are replaced.
    """
    words, lines, windows, ordered = fresh(docs, "_words", "_lines", "_windows", "_ordered")
    full = F.coalesce(F.col(text), F.lit(""))
    n = F.size(words)
    split = docs.select("*", split_words(F.col(text)).alias(words)).select(
        "*",
        F.filter(F.split(full, "\n"), lambda line: line.rlike(f"[^{SPACE}]")).alias(lines),
        F.when(
            n >= WINDOW,
            F.transform(
                F.sequence(F.lit(1), F.greatest(n - WINDOW + 1, F.lit(1))),
                lambda i: F.xxhash64(F.slice(words, i, WINDOW)),
            ),
        )
        .otherwise(F.array().cast("array<bigint>"))
        .alias(windows),
    )
    sorted_ = split.select(
        "*",
        F.when(
            F.size(F.array_distinct(windows)) < F.size(windows),
            F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("at")))),
        )
        .otherwise(F.array().cast("array<struct<h:bigint,at:int>>"))
        .alias(ordered),
    )
    stops = [*STOP_WORDS, *[w.capitalize() for w in STOP_WORDS]]
    measures = {
        "n_words": n,
        "word_chars": F.length(F.translate(full, " \t\n\x0b\x0c\r", "")),
        "n_symbols": F.regexp_count(full, F.lit(SYMBOLS)),
        "n_marks": F.regexp_count(full, F.lit(MARKS)),
        "n_stop_words": F.size(F.filter(words, lambda w: w.isin(stops))),
        "n_lines": F.size(lines),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        # Always true, but not deterministic: a filter on the verdict stays above this projection, else Spark would
        # write the windows into it again for each of their uses.
        "n_repeat_words": F.when(
            F.monotonically_increasing_id() >= 0, _repeated_words(F.col(windows), F.col(ordered))
        ),
    }
    own = {c for c in docs.columns if c.lower() not in measures}
    return sorted_.select(
        *[F.col(f"`{c}`") for c in docs.columns if c in own],
        *[v.cast("long").alias(k) for k, v in measures.items()],
    )


def judged(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """Add the measures, ``base_failed``, ``broken`` (comma-joined names of broken rules) and ``kept``.

    ``base_failed``: under 20 words, or over 30 % of the words in repeated windows; such rows are not kept, whatever
    the rules say. Null and empty texts have no words and so fail. Every row is judged by itself: rows that repeat get
    the same verdict, and an empty table gives an empty result.
    """
    failed = (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)
    broken = F.concat_ws(",", *[F.when(r.broken(), F.lit(r.name)) for r in rules])
    base = measured(docs, text)
    own = [F.col(f"`{c}`") for c in base.columns if c.lower() not in ("base_failed", "broken", "kept")]
    return base.select(*own, failed.alias("base_failed"), broken.alias("broken")).select(
        "*", (~F.col("base_failed") & (F.col("broken") == "")).alias("kept")
    )


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """The rows that are kept, with the columns of ``docs`` as they were."""
    inner = docs.select(F.struct("*").alias("row"), F.col(text).alias("text"))
    return judged(inner, rules).where("kept").select("row.*")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judged(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_marks",
        "n_stop_words", "n_lines", "broken", "base_failed", "kept",
    )


_IN_SQL = ", ".join(f"'{w}'" for w in [*STOP_WORDS, *[w.capitalize() for w in STOP_WORDS]])


def _broken_sql(rule: Rule) -> str:
    sides = [f"{rule.part} * 1000 < n_words_or_lines * {rule.low}"] if rule.low is not None else []
    if rule.high is not None:
        sides.append(f"{rule.part} * 1000 > n_words_or_lines * {rule.high}")
    return f"CASE WHEN {' OR '.join(sides)} THEN '{rule.name}' END".replace("n_words_or_lines", rule.whole)


OP9_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
s AS (SELECT rid, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
win AS (SELECT rid, unnest(range(1, len(w) - {WINDOW - 2})) AS i, w FROM s WHERE len(w) >= {WINDOW}),
keyed AS (SELECT rid, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS k FROM win),
rep AS (SELECT rid, i FROM keyed QUALIFY count(*) OVER (PARTITION BY rid, k) > 1),
gaps AS (SELECT rid, least({WINDOW}, i - coalesce(lag(i) OVER (PARTITION BY rid ORDER BY i), i - {WINDOW})) AS g FROM rep),
covered AS (SELECT rid, sum(g)::BIGINT AS n FROM gaps GROUP BY rid),
m AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
        len(regexp_extract_all(text, '{SYMBOLS}'))::BIGINT AS n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
        coalesce(n, 0)::BIGINT AS n_repeat_words, len(regexp_extract_all(text, '{MARKS}'))::BIGINT AS n_marks,
        len(list_filter(w, lambda x: x IN ({_IN_SQL})))::BIGINT AS n_stop_words, len(l)::BIGINT AS n_lines
      FROM s LEFT JOIN covered USING (rid)),
f AS (SELECT *, concat_ws(',', {', '.join(_broken_sql(r) for r in RULES)}) AS broken,
        n_words < 20 OR n_repeat_words * 100 > n_words * 30 AS base_failed FROM m)
SELECT *, NOT base_failed AND broken = '' AS kept FROM f
"""
