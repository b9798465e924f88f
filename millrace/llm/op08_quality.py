"""Quality rules: a threshold table compiled into one Spark projection.

All of it is built-in expressions, evaluated row by row in the JVM: no shuffle, no user
function, memory bounded by the longest text.

Cases: a null or empty text has no words and fails the base rule; a text with fewer than
ten words fails it too; repeated rows and null ids are judged like any other; an empty
table gives no rows; only doc_id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import WORD, pick

# Fixed values of the contract.
SYMBOLS = "#*$%&|<>"
WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20

# Frequent function words of the four languages of the corpus.
STOP_WORDS = sorted(
    set(
        "a an and are as at be by for from he in is it not of on or that the this to was with "
        "au avec ce dans de des du elle en est et il la le les ne pas pour par que qui se sur un "
        "une das dem den der des die ein eine er für im in ist mit nicht sich sie und von zu "
        "al con como del el en es la las lo los no para por que se su una uno y".split()
    )
)


class Rule(NamedTuple):
    """A ratio of two counts must lie between low and high in texts of least_words or more."""

    name: str
    numerator: str
    denominator: str
    low: float | None
    high: float | None
    least_words: int


RULES = (
    Rule("mean word length", "word_chars", "n_words", 2.0, 20.0, 10),
    Rule("symbols per word", "n_symbols", "n_words", None, 0.5, 10),
    Rule("stop words per word", "n_stop_words", "n_words", 0.02, None, 80),
    Rule("repeated lines per line", "n_dup_lines", "n_lines", None, 0.5, 10),
)


def compile_rules(rules: tuple[Rule, ...] = RULES) -> Column:
    """One boolean expression over the count columns; an empty table of rules keeps all."""
    verdict = F.lit(True)
    for r in rules:
        num, den = F.col(r.numerator).cast("double"), F.col(r.denominator).cast("double")
        # Products, not quotients: a denominator of 0 needs no case of its own.
        ok = F.lit(True)
        if r.low is not None:
            ok = ok & (num >= F.lit(r.low) * den)
        if r.high is not None:
            ok = ok & (num <= F.lit(r.high) * den)
        verdict = verdict & ((F.col("n_words") < r.least_words) | ok)
    return verdict


def _repeated_words(words: Column, hashes: Column) -> Column:
    """Words inside windows that occur twice or more.

    Different hashes prove different windows, so most texts end there. The others sort
    their windows with the places and add up what the repeated ones cover.
    """
    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - WINDOW),
        lambda i: F.struct(
            F.concat_ws(" ", F.slice(words, i + 1, WINDOW)).alias("w"), i.alias("i")
        ),
    )
    # transform() over a one-element array binds the sorted windows to a name, so that the
    # inner function does not sort them again for each element.
    repeated = F.transform(
        F.array(F.sort_array(windows)),
        lambda s: F.sort_array(
            F.transform(
                F.filter(
                    s,
                    lambda x, i: F.coalesce(F.get(s, i - 1)["w"] == x["w"], F.lit(False))
                    | F.coalesce(F.get(s, i + 1)["w"] == x["w"], F.lit(False)),
                ),
                lambda x: x["i"],
            )
        ),
    )[0]
    covered = F.aggregate(
        repeated,
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda a, i: F.struct(
            (i + WINDOW).alias("end"),
            (a["n"] + F.least(F.lit(WINDOW), i + WINDOW - a["end"])).alias("n"),
        ),
        lambda a: a["n"],
    )
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(covered)


def with_counts(docs: DataFrame) -> DataFrame:
    """doc_id and the counts the rules use."""
    text = F.coalesce("text", F.lit(""))
    words = F.col("words")
    return (
        pick(docs, "doc_id", "text")
        .select("doc_id", text.alias("text"))
        .withColumn("words", F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1)))
        .withColumn(
            "lines", F.filter(F.split("text", "\n"), lambda s: s.rlike(r"[^\x20\x09-\x0D]"))
        )
        .withColumn(
            "hashes",
            F.when(F.size(words) < WINDOW, F.array().cast("array<bigint>")).otherwise(
                F.transform(
                    F.sequence(F.lit(0), F.size(words) - WINDOW),
                    lambda i: F.xxhash64(F.slice(words, i + 1, WINDOW)),
                )
            ),
        )
        .select(
            "doc_id",
            F.size(words).cast("bigint").alias("n_words"),
            F.length(F.translate("text", " \t\n\x0b\x0c\r", "")).cast("bigint").alias("word_chars"),
            (F.length("text") - F.length(F.translate("text", SYMBOLS, "")))
            .cast("bigint")
            .alias("n_symbols"),
            (F.size("lines") - F.size(F.array_distinct("lines")))
            .cast("bigint")
            .alias("n_dup_lines"),
            _repeated_words(words, F.col("hashes")).cast("bigint").alias("n_repeat_words"),
            F.size("lines").cast("bigint").alias("n_lines"),
            F.size(F.filter(words, lambda w: F.lower(w).isin(STOP_WORDS)))
            .cast("bigint")
            .alias("n_stop_words"),
        )
    )


def quality(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """A row per row of docs: the counts, base_failed and kept."""
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    )
    return (
        with_counts(docs)
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & compile_rules(rules))
    )


_SQL_RULES = " AND ".join(
    f"(n_words < {r.least_words} OR ("
    + " AND ".join(
        f"CAST({r.numerator} AS DOUBLE) {op} CAST({bound} AS DOUBLE) * CAST({r.denominator} AS DOUBLE)"
        for op, bound in ((">=", r.low), ("<=", r.high))
        if bound is not None
    )
    + "))"
    for r in RULES
)

QUALITY_SQL = rf"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(text, chr(10)),
                     lambda s: regexp_matches(s, '[^\x20\x09-\x0D]')) AS lines
  FROM t
), windows AS (
  SELECT doc_id, i, array_to_string(words[i + 1:i + 5], ' ') AS win
  FROM (SELECT doc_id, words, unnest(range(len(words) - 4)) AS i FROM w WHERE len(words) >= 5)
), repeated AS (
  SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1
), covered AS (
  SELECT doc_id, count(*) AS n FROM (
    SELECT DISTINCT doc_id, i + k AS p FROM repeated, (SELECT unnest(range(5)) AS k))
  GROUP BY doc_id
), c AS (
  SELECT w.doc_id,
         CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(len(list_filter(words, lambda x: lower(x) IN ({", ".join(f"'{s}'" for s in STOP_WORDS)})))
              AS BIGINT) AS n_stop_words
  FROM w LEFT JOIN covered ON covered.doc_id = w.doc_id
), f AS (
  SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED_PERCENT} * n_words AS base_failed
  FROM c
)
SELECT *, NOT base_failed AND {_SQL_RULES} AS kept FROM f
"""
