"""Loan schedules, many loans at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# Fixed value: a schedule stops here when the payment does not cover the interest.
MAX_MONTHS = 1000
BLOCK_ROWS = 100_000

SCHEDULE = "loan_id bigint, month int, paid bigint, principal_paid bigint, interest bigint, remaining bigint"
NAMES = ["loan_id", "month", "paid", "principal_paid", "interest", "remaining"]


def _block(months: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    columns = [np.concatenate(parts) for parts in zip(*months)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=NAMES)


def loan_schedule(loans: DataFrame) -> DataFrame:
    """Monthly rows in cents for loans (loan_id, principal, rate_bp, payment).

    Money is whole cents and the rate hundredths of a percent, so interest
    rounds half up exactly.  A month depends on the one before it, but loans are
    independent: each batch steps through the months with all of its open loans
    at once, and rows leave in blocks, so memory stays flat.
    """

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, left, rate, payment = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            months, rows = [], 0
            for month in range(1, MAX_MONTHS + 1):
                open_ = left > 0
                if not open_.all():
                    ids, left, rate, payment = ids[open_], left[open_], rate[open_], payment[open_]
                if not len(ids):
                    break
                # per month: rate_bp / 10000 / 12 of the principal
                interest = (2 * left * rate + 120_000) // 240_000
                last = left + interest <= payment
                paid = np.where(last, left + interest, payment)
                left = np.where(last, 0, left + interest - paid)
                months.append((ids, np.full(len(ids), month, "int32"), paid, paid - interest, interest, left))
                rows += len(ids)
                if rows >= BLOCK_ROWS:
                    yield _block(months)
                    months, rows = [], 0
            if months:
                yield _block(months)

    return loans.select("loan_id", "principal", "rate_bp", "payment").mapInArrow(step, SCHEDULE)
