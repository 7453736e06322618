"""Carrying a caller's rows through an operator, whatever their columns are called."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROW = "row"


class Carried:
    """A frame as one struct column per row beside the columns an operator works with.

    Columns are told apart by their position, so no name of the caller's, in any
    spelling, meets one of the operator's.
    """

    def __init__(self, docs: DataFrame) -> None:
        self.docs, self.names = docs, docs.columns
        self.places = [f"c{i}" for i in range(len(self.names))]

    def rows(self, **reads: Column) -> DataFrame:
        """`row`, and `reads` as expressions over the caller's columns."""
        if not self.names:
            return self.docs.select(F.struct().alias(ROW), *(
                column.alias(name) for name, column in reads.items()))
        whole = self.docs.select("*", *reads.values()).toDF(*self.places, *reads)
        return whole.select(F.struct(*self.places).alias(ROW), *reads)

    def columns(self, replaced: Iterable[str] = ()) -> list[Column]:
        """The caller's columns, out of `row`, but for those named as in `replaced`."""
        gone = {name.lower() for name in replaced}
        return [F.col(ROW)[place].alias(name) for place, name in
                zip(self.places, self.names, strict=True) if name.lower() not in gone]
