"""Train / validation / test by position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenmill.operators.ordering import RowOrder

TRAIN, VAL, TEST = "train_set", "val_set", "test_set"


def positional_split(
    df: DataFrame, order_by: str | list[str], train: float = 0.8, val: float = 0.15
) -> DataFrame:
    """Add ``split``: the first rows train, the next validate, all others test.

    Sizes are the truncated products of share and row count.  Only the keys at
    the two cut positions are looked up, so the rows themselves are not moved:
    the label is a comparison of the row's key with two literals.
    """
    order, starts = split_starts(df, order_by, train, val)
    return df.withColumn("split", split_label(order, df, starts))


def split_starts(
    df: DataFrame,
    order_by: str | list[str],
    train: float,
    val: float,
    weight: Column | None = None,
) -> tuple[RowOrder, tuple[int, int]]:
    """Order of the table, cut where the validation and the test rows start, too.

    Where the rows themselves are moved, ``weight`` gives their bytes.
    """
    order = RowOrder.fit(df, order_by, weight=weight)
    n_train, n_val = int(train * order.n_rows), int(val * order.n_rows)
    starts = (n_train, n_train + n_val)
    return order.recut(df, {*order.bases, *starts}), starts


def split_label(order: RowOrder, df: DataFrame, starts: tuple[int, int]) -> Column:
    return (
        F.when(order.before(df, starts[0]), TRAIN)
        .when(order.before(df, starts[1]), VAL)
        .otherwise(TEST)
    )
