"""Sorted pages."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_PAGE_SIZE = 200
DEFAULT_PAGE_SIZE = 50

@dataclass(frozen=True)
class Page:
    """SRT-02: the rows of one page, and the filtered frame the total is counted on."""

    rows: DataFrame
    matching: DataFrame

    def total(self) -> int:
        return self.matching.count()


def check_page(limit: int, offset: int) -> None:
    if not 1 <= limit <= MAX_PAGE_SIZE:
        raise ValueError(f"a page has 1 to {MAX_PAGE_SIZE} rows, not {limit}")
    if offset < 0:
        raise ValueError(f"a page cannot begin at row {offset}")


def page(df: DataFrame, order: Sequence[Column], limit: int = DEFAULT_PAGE_SIZE, offset: int = 0) -> Page:
    check_page(limit, offset)
    return Page(df.orderBy(*order).offset(offset).limit(limit), df)


def page_after(df: DataFrame, columns: Sequence[str], last: Sequence, limit: int = DEFAULT_PAGE_SIZE) -> DataFrame:
    """The page after the row whose ``columns`` are ``last``: a filter and a top-k, however deep the page is.

    The order is ascending, missing values last; the columns together tell rows apart.
    """
    check_page(limit, 0)
    beyond = F.lit(False)
    for column, value in reversed(list(zip(columns, last, strict=True))):
        c = F.col(column)
        later = F.lit(False) if value is None else (c > F.lit(value)) | c.isNull()
        beyond = F.coalesce(later, F.lit(False)) | (c.eqNullSafe(F.lit(value)) & beyond)
    return df.where(beyond).orderBy(*[F.col(c).asc_nulls_last() for c in columns]).limit(limit)
