"""Keys of a cohort that travel to the fact scans, so that only its facts reach the first aggregate."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenura.sources.sinks import cut_lineage

#: Room that a row of a broadcast table takes beside the bytes of its keys.
ROW_BYTES = 64


def small_keys(rows: DataFrame, keys: Sequence[str], most_bytes: int) -> DataFrame | None:
    """The distinct keys of `rows`, written and marked for broadcast; None when they take more than `most_bytes`.

    Keys with a NULL are left out: they join nothing."""
    whole = reduce(Column.__and__, [F.col(c).isNotNull() for c in keys])
    stored = cut_lineage(rows.select(*keys).where(whole).distinct(), "cohort-keys")
    lengths = reduce(Column.__add__, [F.octet_length(F.col(c).cast("string")) for c in keys])
    size = stored.agg(F.sum(lengths.cast("long") + ROW_BYTES)).first()[0] or 0
    return F.broadcast(stored) if size <= most_bytes else None


def among(facts: DataFrame, keys: DataFrame | None) -> DataFrame:
    """Facts of the keys; all facts when there are none to go by, since the join above the aggregate decides anyway."""
    return facts if keys is None else facts.join(keys, keys.columns, "left_semi")
