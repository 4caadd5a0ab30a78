"""Upsert by key without a table format that has MERGE: anti-join, then union."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tickbars.operators.bars import last_per_key


def merge_by_key(existing: DataFrame, incoming: DataFrame, key: str = "bar_id", order: str | None = None) -> DataFrame:
    """``existing`` with the rows of ``incoming`` inserted, or replacing the rows of the same key.

    With ``order`` copies of a key inside the batch collapse to the last one first; without it the batch must
    hold each key once. Rows without a key stay out.
    """
    batch = incoming if order is None else last_per_key(incoming, key, order).drop(order)
    batch = batch.where(batch[key].isNotNull()).select(*existing.columns)
    return existing.join(batch.select(key), key, "left_anti").select(*batch.columns).unionByName(batch)
