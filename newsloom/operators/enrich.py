"""Pluggable enrichers: a function over a batch of records whose failure leaves a record as it was."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from newsloom.runtime import ship


def enriched(records: DataFrame, fn: Callable[[dict], str | None], field: str, needs: list[str]) -> DataFrame:
    """``records`` with a text column ``field``: what ``fn`` gives for the columns ``needs`` of each record, null where it
    raises or gives none. Every record comes out, with its other columns unchanged; a column of that name is replaced.
    Enrichers can be chained: each sees what the one before added."""
    ship(records.sparkSession)
    keep = [c for c in records.columns if c != field]

    def run(batches):
        for b in batches:
            out = []
            for row in b.select(needs).to_pylist():
                try:
                    v = fn(row)
                    out.append(None if v is None else str(v))
                except Exception:  # noqa: BLE001 - an enricher may fail in any way
                    out.append(None)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(out, pa.string())], [*keep, field])

    schema = StructType([records.schema[c] for c in keep]).add(field, "string")
    return records.select(*keep, *(c for c in needs if c not in keep)).mapInArrow(run, schema)
