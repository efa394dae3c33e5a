"""Quality classifier: a byte-level convolutional network trained on a bounded sample of labelled rows.

Only the sample reaches the driver; every text is scored where it lies, whole,
in Arrow batches, and nothing is shuffled for that.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .convnet import Network, fit, score

# Bounds of the training sample: rows of each class, and bytes of a text.
SAMPLE_PER_CLASS = 400
SAMPLE_TEXT_BYTES = 100_000


def held_out(doc_id: str = "doc_id"):
    """True where crc32 of the id as text leaves 1 by 3; a NULL id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_sample(
    documents: DataFrame,
    labels: DataFrame,
    per_class: int = SAMPLE_PER_CLASS,
    text_bytes: int = SAMPLE_TEXT_BYTES,
) -> list[tuple[str, int]]:
    """At most ``2 * per_class`` texts with their labels, chosen by a hash of the id; one text to an id.

    Held-out ids, NULL ids or labels, ids with contradicting labels, and texts
    over ``text_bytes`` are left out; no class needs to be present.
    """
    marks = (
        labels.select(F.col("doc_id").alias("id"), F.col("quality").cast("int").alias("mark"))
        .where("id IS NOT NULL AND mark IN (0, 1)")
        .where(~held_out("id"))
        .groupBy("id")
        .agg(F.min("mark").alias("mark"), F.max("mark").alias("other"))
        .where("mark = other")
        .select("id", "mark", F.xxhash64("id").alias("place"))
    )
    # At most per_class rows of each class: a bounded broadcast, and one pass over the texts.
    chosen = [marks.where(F.col("mark") == m).orderBy("place", "id").limit(per_class) for m in (0, 1)]
    rows = (
        documents.select(F.col("doc_id").alias("id"), "text")
        .where(F.octet_length("text") <= text_bytes)
        .join(F.broadcast(chosen[0].unionByName(chosen[1])), "id")
        .groupBy("id", "mark", "place")
        .agg(F.min("text").alias("text"))
        .orderBy("mark", "place", "id")
        .select("text", "mark")
        .collect()
    )
    return [(row.text, row.mark) for row in rows]


def train(documents: DataFrame, labels: DataFrame, **bounds: int) -> Network:
    sample = training_sample(documents, labels, **bounds)
    return fit([text.encode() for text, _ in sample], [mark for _, mark in sample])


def scorer(network: Network):
    """A column function from text to probability; NULL counts as the empty text."""

    @F.pandas_udf("double")
    def probability(texts: pd.Series) -> pd.Series:
        return pd.Series(score(network, [t.encode() if t else b"" for t in texts]), dtype=np.float64)

    return probability


def with_quality(documents: DataFrame, network: Network, column: str = "score") -> DataFrame:
    """Every row with the probability that its text is good, in ``column``.

    Empty and NULL texts get the network's score for no bytes; repeated rows get
    equal scores; other columns pass through and never enter the score.
    """
    return documents.withColumn(column, scorer(network)("text"))
