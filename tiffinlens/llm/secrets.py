"""Secret scans with an incremental ledger of blobs, in DataFrame functions only.

Every version of every file is addressed by the SHA-256 of its content. A pair
of blob and rule version is scanned once, ever; findings belong to the blob and
are joined back to all paths that hold it.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiffinlens.plans.joins import hot_lookup

from .staging import staged


@dataclass(frozen=True)
class SecretRule:
    """A match is dropped unless its ``group`` has ``least`` characters; a changed rule needs a new version."""

    kind: str
    pattern: str
    group: int
    least: int
    version: int = 1

    @property
    def label(self) -> str:
        return f"{self.kind}@{self.version}"


# Kinds, patterns and least lengths, in the order that breaks ties.
# [...]{n,} finds the same spans as [...]+ cut to n characters where a match is a whole run.
RULES = (
    SecretRule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        12,
    ),
    SecretRule("access", r"AKIA[A-Z0-9]{14,}", 0, 18),
    SecretRule("hex", r"[0-9a-f]{16,}", 0, 16),
)


def blob_of(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def _matched(text: Column, rule: SecretRule, group: int) -> Column:
    return F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(group))


def _spans(matches: str, groups: str, text: Column, rule: SecretRule, place: int) -> Column:
    """Spans of one rule: gaps between matches and the matches themselves add up to positions."""
    gaps = F.split(text, rule.pattern, -1)
    lengths = F.arrays_zip(
        F.transform(gaps, F.length).alias("gap"),
        F.transform(matches, F.length).alias("size"),
        F.transform(groups, F.length).alias("group"),
    )
    span = "struct<start:int,place:int,kind:string,end:int>"
    walked = F.aggregate(
        lengths,
        F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{span}>").alias("found")),
        lambda a, m: F.struct(
            (a["at"] + m["gap"] + F.coalesce(m["size"], F.lit(0))).alias("at"),
            F.when(
                m["group"] >= rule.least,
                F.concat(
                    a["found"],
                    F.array(
                        F.struct(
                            (a["at"] + m["gap"]).alias("start"),
                            F.lit(place).alias("place"),
                            F.lit(rule.kind).alias("kind"),
                            (a["at"] + m["gap"] + m["size"]).alias("end"),
                        )
                    ),
                ),
            )
            .otherwise(a["found"])
            .alias("found"),
        ),
        lambda a: a["found"],
    )
    return F.when(F.size(matches) > 0, walked).otherwise(F.array().cast(f"array<{span}>"))


def scan(blobs: DataFrame, rules: tuple[SecretRule, ...] = RULES, todo: str | None = None) -> DataFrame:
    """blob, spans: all spans of each blob that has any, by start, then by the order of rules.

    ``blobs`` has blob and text. ``todo`` names a column with the labels of the
    rules to run on a row; without it all rules run.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    columns: dict[str, Column] = {}
    for i, rule in enumerate(rules):
        for name, group in ((f"__m{i}", 0), (f"__g{i}", rule.group)):
            found = _matched(text, rule, group)
            wanted = F.array_contains(F.col(todo), rule.label) if todo else F.lit(True)
            columns[name] = F.when(wanted, found).otherwise(F.array().cast("array<string>"))
    matched = blobs.withColumns(columns).where(
        reduce(lambda a, b: a | b, [F.size(f"__m{i}") > 0 for i in range(len(rules))])
    )
    spans = F.sort_array(
        F.concat(*[_spans(f"__m{i}", f"__g{i}", text, rule, i) for i, rule in enumerate(rules)])
    )
    return matched.select("blob", spans.alias("spans")).where(F.size("spans") > 0)


def unseen(versions: DataFrame, rules: tuple[SecretRule, ...], ledger: DataFrame | None) -> DataFrame:
    """blob, holder, todo: blobs with rules not yet run on them, and one version that holds each.

    ``versions`` has holder (what tells versions apart) and blob; the ledger has blob and rule.
    """
    blobs = versions.groupBy("blob").agg(F.min("holder").alias("holder"))
    labels = F.array(*[F.lit(rule.label) for rule in rules])
    if ledger is None:
        return blobs.withColumn("todo", labels)
    # At most one label per rule and blob: the list is as short as the rules.
    done = (
        ledger.where(F.col("rule").isin([rule.label for rule in rules]))
        .groupBy("blob")
        .agg(F.collect_set("rule").alias("done"))
    )
    return (
        blobs.join(done, "blob", "left")
        .withColumn("todo", F.array_except(labels, F.coalesce("done", F.array().cast("array<string>"))))
        .where(F.size("todo") > 0)
        .drop("done")
    )


def scan_increment(
    versions: DataFrame,
    ledger: DataFrame | None = None,
    rules: tuple[SecretRule, ...] = RULES,
    path: str = "path",
    version: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """What to append after new versions came in: (ledger rows: blob, rule; findings: blob, spans).

    Only text of one holder per unseen blob is scanned. Repeated rows are one
    blob; a NULL text is the empty blob; a NULL path is a holder like any other.
    """
    holder = F.concat_ws(
        "\x00",
        F.coalesce(F.col(path).cast("string"), F.lit("")),
        F.coalesce(F.col(version).cast("string"), F.lit("")) if version else F.lit(""),
    )
    held = versions.select(holder.alias("holder"), blob_of(F.col("text")).alias("blob"), "text")
    # Written down first: what is left to scan is then data to the planner, and no
    # text is matched before it is known to be of an unseen blob.
    todo = staged(unseen(held.select("holder", "blob"), rules, ledger), "unseen")
    texts = held.join(todo.hint("shuffle_hash"), ["blob", "holder"])
    # A repeated row of the holder finds the same spans again: as few copies as rows repeat.
    findings = scan(texts, rules, "todo").groupBy("blob").agg(F.min("spans").alias("spans"))
    return todo.select("blob", F.explode("todo").alias("rule")), findings


def findings_by_path(versions: DataFrame, findings: DataFrame, path: str = "path") -> DataFrame:
    """path, spans for every row of ``versions``; no spans where nothing was found.

    Findings of one blob from several increments (rules added later) are merged.
    """
    merged = findings.groupBy("blob").agg(
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans")
    )
    empty = F.array().cast("array<struct<start:int,place:int,kind:string,end:int>>")
    held = versions.select(F.col(path), blob_of(F.col("text")).alias("blob"))
    # A blob that very many paths hold is a hot partition that adaptive execution splits.
    return hot_lookup(held, merged, "blob").select(path, F.coalesce("spans", empty).alias("spans"))


def joined_spans(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
