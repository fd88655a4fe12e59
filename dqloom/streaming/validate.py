"""Row-local rules on a stream, and whole rule sets batch by batch.

Rules that look at one row are plain projections and run on a streaming DataFrame as they are. Rules that compare rows
(duplicates, unique values, dependencies) need a bounded set of rows: ``each_batch`` validates every micro-batch in full.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from dqloom.operators.detect import alone
from dqloom.operators.engine import Validation, validate, validate_rows
from dqloom.plans.registry import Registry


def row_local(registry: Registry) -> Registry:
    """The registry without the rules that compare rows or look values up in tables."""
    return Registry(registry.schema, registry.severities, tuple(r for r in registry.rules if alone(r) or r.type == "auto_fix_review"))


def validate_stream(stream: DataFrame, registry: Registry, run_date: dt.date) -> Validation:
    """Valid and quarantined rows of a stream of (record_id, row_no, data columns)."""
    return validate_rows(stream, row_local(registry), run_date)


def each_batch(stream: DataFrame, registry: Registry, run_date: Callable[[], dt.date], sink: Callable[[Validation, int], None]) -> DataStreamWriter:
    """A writer that runs all rules over each micro-batch and hands the result to sink(validation, batch id)."""
    return stream.writeStream.foreachBatch(lambda df, number: sink(validate(df, registry, run_date()), number))
