"""Stage text to history rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from ordstrata.operators.history import keyed_rows, with_provenance
from ordstrata.schemas import CUSTOMER_COLUMNS, ORDER_COLUMNS, names


def raw_customers(
    stage: DataFrame,
    load_ts: dt.datetime,
    origin: str,
    row_id: Column | None = None,
    more: Sequence[str] = (),
) -> DataFrame:
    """Customers with an id, without the unnamed file columns, plus ``more`` columns and provenance."""
    kept = keyed_rows(stage, "ID").select(*names(CUSTOMER_COLUMNS), *more)
    return with_provenance(kept, load_ts, origin, row_id)


def raw_orders(
    stage: DataFrame,
    load_ts: dt.datetime,
    origin: str,
    row_id: Column | None = None,
    more: Sequence[str] = (),
) -> DataFrame:
    """Order lines with a customer id, plus ``more`` columns and provenance."""
    kept = keyed_rows(stage, "COD_CLIENTE").select(*names(ORDER_COLUMNS), *more)
    return with_provenance(kept, load_ts, origin, row_id)
