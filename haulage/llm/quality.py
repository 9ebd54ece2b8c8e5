"""Quality rules as a short-circuit cascade, on DataFrame functions alone.

Each rule is a condition that rejects a document, built from expressions over the text and its words: a rule owns what it
measures. `ordered` takes a bounded sample of raw texts that pass the base test, runs every rule on it by itself for its
cost (seconds a row, its measures included, beyond reading the row) and its selectivity (share rejected), and orders the
rules by rejection per cost. `cascade` turns the order into one CASE, so a row that the base test or a rule rejects never
pays for what the later rules measure. The order changes the cost, never the verdict. Rules that reject nothing in the
sample come last in the order given: among them no order saves anything. Costs below a microsecond a row count as one.

Measures that a caller wants reported for all rows are computed once, and rules read those columns instead.

Measures of repetition work inside a row: hashes of all 8-word windows are compared as distinct values first, and only
texts in which some window recurs sort their windows by hash to find the places. No row is moved to another task.

Null texts have no words. Texts of any length are measured whole. Repeated rows are judged each by itself. An empty table
gives an empty table; on an empty sample rules keep their given order. Columns beyond the named ones are not read.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed characters of the base measures.
SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8

#: Rows on which rules are tried: at most so many are cached for the trial.
SAMPLE_ROWS = 2_000


#: A rule's cost is the least of so many trials; trials cannot tell costs below LEAST_COST seconds a row.
TRIALS, LEAST_COST = 3, 1e-6


def lines() -> Column:
    return F.filter(F.split("text", "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))


def n_letters(pattern: str) -> Column:
    return F.length(F.regexp_replace("text", pattern, ""))


#: What rules may measure, over the columns text and words. Expressions: they cost where, and only if, they are evaluated.
MEASURES: dict[str, Callable[[], Column]] = {
    "n_words": lambda: F.size("words").cast("long"),
    "word_chars": lambda: F.length(F.translate("text", SPACES, "")).cast("long"),
    "n_symbols": lambda: (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long"),
    "n_lines": lambda: F.size(lines()).cast("long"),
    "n_dup_lines": lambda: (F.size(lines()) - F.size(F.array_distinct(lines()))).cast("long"),
    "n_exclaimed": lambda: F.length("text") - F.length(F.translate("text", "!", "")),
    "n_capitals": lambda: n_letters("[^A-Z]"),
    "n_letters": lambda: n_letters("[^A-Za-z]"),
    "n_echoes": lambda: F.size(F.filter(F.zip_with("words", F.slice("words", 2, F.size("words")), lambda w, v: w == v), lambda x: x)),
}


class Measures(dict):
    """Columns of measures that are there already; any other measure is given as its expression."""

    def __missing__(self, name: str) -> Column:
        return MEASURES[name]()


@dataclass(frozen=True)
class Rule:
    """rejects: a condition over measures by name; a null counts as no rejection."""

    name: str
    rejects: Callable[[Mapping[str, Column]], Column]


#: Thresholds in use for web text, loose enough to leave odd but clean documents alone.
RULES = (
    Rule("symbols", lambda m: 10 * m["n_symbols"] > m["n_words"]),
    Rule("word_length", lambda m: m["word_chars"] > 25 * m["n_words"]),
    Rule("exclaimed", lambda m: 2 * m["n_exclaimed"] > m["n_words"]),
    Rule("shouted", lambda m: (m["n_words"] >= 20) & (5 * m["n_capitals"] > 4 * m["n_letters"])),
    Rule("duplicate_lines", lambda m: 10 * m["n_dup_lines"] > 6 * m["n_lines"]),
    Rule("repeated_word", lambda m: (m["n_words"] >= 20) & (3 * m["n_echoes"] > m["n_words"])),
)


def words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, r"[\x20\x09-\x0D]+", -1)).otherwise(F.array().cast("array<string>"))


def covered(ordered: str) -> Column:
    """Words covered by windows found twice or more; `ordered` names an array of (h, at) sorted by hash."""
    hash_at = lambda i: F.get(ordered, i)["h"]
    twice = F.transform(
        ordered, lambda x, i: F.when((hash_at(i - 1) == x["h"]) | (hash_at(i + 1) == x["h"]), x["at"])
    )
    return F.aggregate(
        F.array_sort(F.filter(twice, lambda at: at.isNotNull())),
        F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda s, at: F.struct((s["n"] + F.least(F.lit(WINDOW), at - s["last"])).alias("n"), at.alias("last")),
    )["n"]


def based(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", report: Sequence[str] = ()) -> DataFrame:
    """id, text, words, n_words, n_repeat_words, base_failed, and the measures to report."""
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    rows = rows.withColumn("words", words(F.col("text")))
    hashed = rows.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    count = F.size("hashes")
    windows = F.when(
        count >= WINDOW,
        F.transform(F.sequence(F.lit(1), F.greatest(count - (WINDOW - 1), F.lit(1))), lambda i: F.xxhash64(F.slice("hashes", i, WINDOW))),
    ).otherwise(F.array().cast("array<long>"))
    again = F.size(F.array_distinct("windows")) < F.size("windows")
    by_hash = F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
    hashed = hashed.withColumn("windows", windows).withColumn("ordered", F.when(again, by_hash))
    found = hashed.select(
        "id",
        "text",
        "words",
        MEASURES["n_words"]().alias("n_words"),
        F.coalesce(covered("ordered"), F.lit(0)).cast("long").alias("n_repeat_words"),
        *[MEASURES[name]().alias(name) for name in report if name != "n_words"],
    )
    return found.withColumn("base_failed", F.expr("n_words < 20 OR 100 * n_repeat_words > 30 * n_words"))


def rejection(rule: Rule, ready: Mapping[str, Column] | None = None) -> Column:
    return F.coalesce(rule.rejects(Measures(ready or {})), F.lit(False))


def ordered(rows: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS) -> list[tuple[Rule, float, float]]:
    """(rule, seconds a row, share rejected) by rejection per cost; rows as `based` gives them, at most sample_rows are tried."""
    # The limit keeps the filter behind it: pushed below, it would measure repetition once more.
    sample = rows.limit(sample_rows).filter(~F.col("base_failed")).select("text", "words").cache()
    try:
        n = sample.count()
        if not n:
            return [(rule, 0.0, 0.0) for rule in rules]

        def tried(condition: Column) -> tuple[float, int]:
            # the row is read whole in every trial; what a condition takes beyond that is its own
            started = time.perf_counter()
            hits = sample.agg(F.count_if(condition), F.sum(F.length("text") + F.size("words"))).first()[0]
            return time.perf_counter() - started, hits

        def least(condition: Column) -> tuple[float, int]:
            tried(condition)  # compiles
            return min(tried(condition) for _ in range(TRIALS))

        bare, _ = least(F.lit(False))
        found = []
        for rule in rules:
            taken, hits = least(rejection(rule))
            found.append((rule, max((taken - bare) / n, LEAST_COST), hits / n))
        return sorted(found, key=lambda x: -x[2] / x[1])  # stable: equal ones keep the order given
    finally:
        sample.unpersist()


def cascade(rules: Sequence[Rule], ready: Mapping[str, Column] | None = None) -> Column:
    """Name of the first rule that rejects the row, null if none does; later rules measure nothing."""
    chain = F
    for rule in rules:
        chain = chain.when(rejection(rule, ready), F.lit(rule.name))
    return chain.otherwise(F.lit(None).cast("string"))


def judged(docs: DataFrame, rules: Sequence[Rule] = RULES, report: Sequence[str] = (), **columns) -> DataFrame:
    """id, text, n_words, n_repeat_words, the measures to report, base_failed, rejected_by (null where base_failed), kept.

    Write the result before filtering it by a verdict: Spark pushes such a filter below the measures, which then repeats them.
    """
    rows = based(docs, report=report, **columns)
    # Twice the rows wanted are drawn before anything is measured; the limit then takes no more than it needs.
    share = min(1.0, 2 * SAMPLE_ROWS / max(docs.count(), 1))
    order = [rule for rule, _, _ in ordered(based(docs.sample(share, 42), **columns), rules)]
    ready = {name: F.col(name) for name in ("n_words", *report)}
    verdict = F.when(~F.col("base_failed"), cascade(order, ready))
    done = rows.withColumn("rejected_by", verdict).drop("words")
    return done.withColumn("kept", ~F.col("base_failed") & F.col("rejected_by").isNull())


def quality_flags(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept."""
    return judged(docs, report=("word_chars", "n_symbols", "n_dup_lines")).select(
        F.col("id").alias("doc_id"),
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
    )
