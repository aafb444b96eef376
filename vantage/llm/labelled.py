"""Bounded labelled samples for the classifiers.

An id that has both labels is not learned from.  Of rows that repeat an id one counts, the one
whose text has the least hash, so a sample holds ``per_class`` rows of each label at most."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vantage.llm.common import materialize


def held_out(id_col: str | Column) -> Column:
    """True for the fifth of the ids that no classifier learns from."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def _learnable(labels: DataFrame, label_col: str, id_col: str) -> DataFrame:
    """(id, label) of the ids that may be learned from, one row each."""
    known = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
             .where(~held_out("id") & F.col("id").isNotNull() & F.col("label").isin(0, 1)))
    return (known.groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("other"))
            .where("label = other").drop("other"))


def label_counts(labels: DataFrame, label_col: str, id_col: str) -> np.ndarray:
    """Learnable ids of label 0 and of label 1."""
    count = _learnable(labels, label_col, id_col).agg(*(F.count_if(F.col("label") == v) for v in (0, 1))).first()
    return np.array(count, float)


def stands_for(labels: DataFrame, label_col: str, id_col: str, per_class: int) -> np.ndarray:
    """Learnable ids that a row of ``labelled_sample`` stands for, by label: 1 up to the cap."""
    return np.maximum(1.0, label_counts(labels, label_col, id_col) / per_class)


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str, text_col: str,
                    per_class: int) -> DataFrame:
    """(id, text, label) of at most ``per_class`` learnable rows of each label, chosen by the
    hash of their id; written once.  The chosen ids are broadcast: they are that many at most."""
    known = _learnable(labels, label_col, id_col)
    chosen = None
    for label in (0, 1):
        some = known.where(F.col("label") == label).orderBy(F.xxhash64("id"), "id").limit(per_class)
        chosen = some if chosen is None else chosen.unionByName(some)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = texts.join(F.broadcast(chosen), "id").groupBy("id", "label").agg(
        F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    return materialize(rows.select("id", "text", "label"), "sample")
