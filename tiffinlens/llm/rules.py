"""Quality rules as a short-circuit cascade, in DataFrame functions only.

A bounded sample tells what each rule costs and how much it rejects; rules then
stand in one CASE expression by rejection per cost, so a row stops at the first
rule it fails. The order is only about speed: the verdict is the same in any.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .staging import staged

WORD_BREAK = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8
# Rows that costs and selectivities are measured on.
SAMPLE_ROWS = 500
# Times that a rule is evaluated on each row of it to be timed.
REPEATS = 8


@dataclass(frozen=True)
class Rule:
    """``fails`` is true for rows to reject; NULL counts as false."""

    name: str
    fails: Column


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, WORD_BREAK), "")


def with_words(documents: DataFrame, text: str = "text") -> DataFrame:
    """Adds __words, and the counts of the base rules; a NULL text has no words.

    n_repeat_words counts words in windows of eight words found twice or more.
    Windows are compared by 64-bit hashes within one text.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    hashes = F.transform("__words", lambda word: F.xxhash64(word))
    windows = F.when(
        F.col("n_words") >= WINDOW,
        F.transform(
            F.sequence(F.lit(0), F.col("n_words").cast("int") - WINDOW),
            lambda i: F.xxhash64(*[F.get("__hashes", i + k) for k in range(WINDOW)]),
        ),
    )
    repeats = F.size(F.array_distinct("__windows")) < F.size("__windows")
    placed = F.sort_array(F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
    found = F.filter(
        "__placed",
        lambda s, i: F.coalesce(s["h"] == F.get("__placed", i - 1)["h"], F.lit(False))
        | F.coalesce(s["h"] == F.get("__placed", i + 1)["h"], F.lit(False)),
    )
    places = F.sort_array(F.transform(found, lambda s: s["p"]))
    covered = F.aggregate(
        places,
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last")),
        lambda a, p: F.struct(
            (a["n"] + F.least(F.lit(WINDOW), p - a["last"])).cast("long").alias("n"), p.alias("last")
        ),
        lambda a: a["n"],
    )
    return (
        documents.withColumn("__words", words_of(whole))
        .withColumn("__lines", lines)
        .withColumns(
            {
                "n_words": F.size("__words").cast("long"),
                "word_chars": F.aggregate(
                    "__words", F.lit(0).cast("long"), lambda n, word: n + F.length(word)
                ),
                "n_symbols": F.regexp_count(whole, F.lit(SYMBOLS)).cast("long"),
                "__n_lines": F.size("__lines").cast("long"),
                "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
                "__hashes": hashes,
            }
        )
        .drop("__lines")
        .withColumn("__windows", windows)
        .drop("__hashes")
        .withColumn("__placed", F.when(repeats, placed))
        .drop("__windows")
        .withColumn(
            "n_repeat_words", F.when(F.col("__placed").isNotNull(), covered).otherwise(0).cast("long")
        )
        .drop("__placed")
    )


def base_rules() -> list[Rule]:
    return [
        Rule("few_words", F.col("n_words") < 20),
        Rule("repeated", 100 * F.col("n_repeat_words") > 30 * F.col("n_words")),
    ]


def text_rules(text: str = "text") -> list[Rule]:
    """What a text that passes the base rules must still not be."""
    n = F.col("n_words")
    shouted = F.filter("__words", lambda word: (word == F.upper(word)) & (word != F.lower(word)))
    return [
        Rule("symbols", F.col("n_symbols") > 0.1 * n),
        Rule("duplicate_lines", F.col("n_dup_lines") > 0.3 * F.col("__n_lines")),
        Rule("word_length", (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 15 * n)),
        Rule("shouting", F.size(shouted) > 0.5 * n),
        Rule("exclamations", F.regexp_count(text, F.lit("[!?]{2,}")) > 0.1 * n),
    ]


def measured(sample: DataFrame, rules: list[Rule]) -> list[tuple[Rule, float, frozenset[int]]]:
    """Each rule with its seconds on the sample, above those of reading it, and the numbers of the rows it rejects.

    A rule is evaluated REPEATS times per row and the faster of two runs counts, so
    that what starting a job takes does not hide the rule.
    """
    flags = sample.select(
        *[F.coalesce(rule.fails, F.lit(False)).alias(f"r{i}") for i, rule in enumerate(rules)]
    ).collect()  # SAMPLE_ROWS rows at most
    repeated = sample.withColumn("__again", F.explode(F.sequence(F.lit(1), F.lit(REPEATS))))

    def seconds(condition: Column) -> float:
        runs = []
        for _ in range(2):
            started = time.perf_counter()
            repeated.agg(F.count_if(F.coalesce(condition, F.lit(False)))).first()
            runs.append(time.perf_counter() - started)
        return min(runs)

    nothing = seconds(F.size("__words") < 0)
    return [
        (rule, max(seconds(rule.fails) - nothing, 1e-4), frozenset(n for n, row in enumerate(flags) if row[i]))
        for i, rule in enumerate(rules)
    ]


def ordered(sample: DataFrame, rules: list[Rule]) -> list[Rule]:
    """By rejection per cost, the best first: each of the rows that the rules before it leave. Then the cheaper, then names."""
    costs = list(measured(sample, rules))
    gone: frozenset[int] = frozenset()
    out = []
    while costs:
        best = min(costs, key=lambda c: (-len(c[2] - gone) / c[1], c[1], c[0].name))
        costs.remove(best)
        out.append(best[0])
        gone |= best[2]
    return out


def verdict(rules: list[Rule]) -> Column:
    """True for rows that fail no rule; evaluation stops at the first failed rule."""
    first, *rest = rules
    chain = F.when(first.fails, False)
    for rule in rest:
        chain = chain.when(rule.fails, False)
    return chain.otherwise(True)


def apply_rules(documents: DataFrame, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Every row with the base counts, base_failed and kept.

    Empty and NULL texts have no words and fail the base. Repeated rows get equal
    verdicts; other columns pass through. ``sample_rows`` bounds the sample that
    decides the order of rules, nothing else: of its rows those that pass the base,
    the only ones that the cascade sees.
    """
    counted = with_words(documents, text)
    base, rest = base_rules(), text_rules(text)
    failed = base[0].fails
    for rule in base[1:]:
        failed = failed | rule.fails
    # Counts are settled before they are filtered on: a filter on them would be computed below them, again.
    sample = with_words(staged(documents.select(F.col(text)).limit(sample_rows), "sample"), text)
    passing = ordered(staged(sample, "sample-words").where(~failed), rest)
    return (
        counted.withColumn("base_failed", failed)
        .withColumn("kept", F.when(F.col("base_failed"), False).otherwise(verdict(passing)))
        .drop("__words", "__n_lines")
    )
