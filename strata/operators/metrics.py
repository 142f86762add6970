"""A small metric layer: named measures and dimensions over one source."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.ranking import top

Condition = Callable[[Mapping[str, Column]], Column]


def _column(expression: str | Column) -> Column:
    return F.expr(expression) if isinstance(expression, str) else expression


def _is_any(expression: Column, chosen: Iterable) -> Column:
    values = list(chosen)
    hit = expression.isin([v for v in values if v is not None])
    return hit | expression.isNull() if None in values else hit


@dataclass(frozen=True)
class MetricView:
    """Source, dataset filter, aggregate measures and row-level dimensions."""

    source: DataFrame
    measures: Mapping[str, str | Column]
    dimensions: Mapping[str, str | Column]
    filter: str | Column | None = None

    def _filtered(
        self,
        facets: Mapping[str, Iterable] | None = None,
        where: Condition | None = None,
    ) -> DataFrame:
        named = {n: _column(e) for n, e in self.dimensions.items()}
        df = self.source
        if self.filter is not None:
            df = df.filter(_column(self.filter))
        for name, chosen in (facets or {}).items():
            df = df.filter(_is_any(named[name], chosen))
        return df if where is None else df.filter(where(named))

    def _named_dimensions(self, names: Sequence[str]) -> list[Column]:
        return [_column(self.dimensions[n]).alias(n) for n in names]

    def query(
        self,
        measures: Sequence[str],
        dimensions: Sequence[str] = (),
        facets: Mapping[str, Iterable] | None = None,
        where: Condition | None = None,
    ) -> DataFrame:
        """Measures per combination of dimensions, or in total.

        ``facets`` keeps rows with one of the chosen values in every facet;
        ``where`` builds a further condition from the dimension columns.
        """
        aggregates = [_column(self.measures[m]).alias(m) for m in measures]
        df = self._filtered(facets, where)
        return df.groupBy(*self._named_dimensions(dimensions)).agg(*aggregates)

    def rows(
        self,
        dimensions: Sequence[str],
        facets: Mapping[str, Iterable] | None = None,
        where: Condition | None = None,
    ) -> DataFrame:
        """Dimension values of every row, not aggregated."""
        return self._filtered(facets, where).select(*self._named_dimensions(dimensions))

    def top_rows(
        self,
        by: str,
        dimensions: Sequence[str],
        n: int = 15,
        facets: Mapping[str, Iterable] | None = None,
    ) -> DataFrame:
        """Rows with the largest value of a dimension; ties by the other columns."""
        ties = [(d, "asc") for d in dimensions if d != by]
        shown = dict.fromkeys([*dimensions, by])
        return top(self.rows(list(shown), facets), [(by, "desc"), *ties], n)

    def top_groups(
        self,
        measure: str,
        dimensions: Sequence[str],
        n: int = 15,
        facets: Mapping[str, Iterable] | None = None,
    ) -> DataFrame:
        """Groups with the largest measure; ties by the dimensions."""
        grouped = self.query([measure], dimensions, facets)
        return top(grouped, [(measure, "desc"), *[(d, "asc") for d in dimensions]], n)

    def facet_counts(
        self, names: Sequence[str], chosen: Mapping[str, Iterable] | None = None
    ) -> DataFrame:
        """Every value of every facet, with the rows that the other facets let through.

        All facets are counted in one pass: a row gives one entry per facet, and
        the entries are reduced per task before they are shuffled.
        """
        chosen = {n: list(v) for n, v in (chosen or {}).items()}
        passes = {
            n: F.coalesce(_is_any(_column(self.dimensions[n]), v), F.lit(False))
            for n, v in chosen.items()
        }

        def entry(name: str) -> Column:
            others = [p for n, p in passes.items() if n != name]
            return F.struct(
                F.lit(name).alias("facet"),
                _column(self.dimensions[name]).cast("string").alias("value"),
                reduce(and_, others, F.lit(True)).alias("counts"),
            )

        return (
            self._filtered()
            .select(F.inline(F.array(*[entry(n) for n in names])))
            .groupBy("facet", "value")
            .agg(F.count_if("counts").alias("matching_rows"))
        )
