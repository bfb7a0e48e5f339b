"""Neighbour access along per-key timelines that stays parallel when one key dominates.

``lag``/``lead``/fill-forward over ``partitionBy(key)`` puts a whole key into one task. If a third of
all rows share a key, that task is a third of the job. A :class:`Timeline` cuts long keys into slices:

* *Cut points* are rows of the input itself, picked by a hash of their key and order columns, then
  reduced to the ``max_cuts`` smallest hashes. The pick is a pure function of the rows, so every branch
  of a plan and every retry sees the same cuts, and the cut table never exceeds ``max_cuts`` rows,
  however large the input - which is what makes broadcasting it safe.
* A row's slice is the number of cut points of its key at or before it (binary search). Keys without a
  cut point are one slice, so ordinary keys pay nothing but the broadcast lookup.
* Windows run per ``(key, slice)``. What crosses a slice boundary is one value per slice, reduced with
  a map-side combinable aggregate (at most ``2 * max_cuts`` rows), shifted along the slices, broadcast
  and merged into the slice's first or last rows.

No row is dropped or capped; slicing only moves task boundaries.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

_SLICE, _SPLIT, _CUTS = "_slice", "_split", "_cuts"


@dataclass(frozen=True)
class Timeline:
    """Rows of ``keys`` ordered by ``order`` (which must be unique within a key)."""

    keys: Sequence[str]
    order: Sequence[str]
    rows_per_slice: int = 1 << 16
    max_cuts: int = 4096

    # -- slicing ---------------------------------------------------------------------------------

    def split(self, df: DataFrame) -> DataFrame:
        """Add the slice columns the other methods rely on. Rows with a null key are not supported."""
        place = F.xxhash64(*self.keys, *self.order)
        cuts = (
            df.select(*self.keys, *self.order)
            .filter(F.pmod(place, F.lit(self.rows_per_slice)) == 0)
            .repartition(*self.order)  # ends the scan's stage, so the broadcast below starts from few rows
            .orderBy(place, *self.order)
            .limit(self.max_cuts)
            .groupBy(*self.keys)
            .agg(F.sort_array(F.collect_list(self._position())).alias(_CUTS))
        )
        strides = [1 << b for b in reversed(range(self.max_cuts.bit_length()))]
        here = self._position()
        rank = F.aggregate(
            F.array(*[F.lit(s) for s in strides]),
            F.lit(0),
            lambda at, stride: F.when(F.get(F.col(_CUTS), at + stride - 1) <= here, at + stride).otherwise(at),
        )
        return (
            df.join(F.broadcast(cuts), list(self.keys), "left")
            .withColumn(_SPLIT, F.col(_CUTS).isNotNull())
            .withColumn(_SLICE, F.when(F.col(_SPLIT), rank).otherwise(F.lit(0)))
            .drop(_CUTS)
        )

    @staticmethod
    def unsplit(df: DataFrame) -> DataFrame:
        return df.drop(_SLICE, _SPLIT)

    # -- neighbours ------------------------------------------------------------------------------

    def previous(self, df: DataFrame, name: str, value: Column) -> DataFrame:
        """``name`` := ``value`` of the row before (null on a key's first row)."""
        w = self._window()
        edges = self._edges(df, {"_edge": F.max_by(value, self._position())})
        carried = edges.withColumn("_edge", F.lag("_edge").over(self._slices()))
        near = df.withColumn(name, F.lag(value).over(w)).withColumn("_border", F.row_number().over(w) == 1)
        return self._merge(near, carried, {name: F.when(F.col("_border"), F.col("_edge")).otherwise(F.col(name))})

    def following(self, df: DataFrame, name: str, value: Column) -> DataFrame:
        """``name`` := ``value`` of the row after (null on a key's last row)."""
        w = self._window()
        edges = self._edges(df, {"_edge": F.min_by(value, self._position())})
        carried = edges.withColumn("_edge", F.lead("_edge").over(self._slices()))
        near = df.withColumn(name, F.lead(value).over(w)).withColumn(
            "_border", F.lead(F.lit(True)).over(w).isNull()
        )
        return self._merge(near, carried, {name: F.when(F.col("_border"), F.col("_edge")).otherwise(F.col(name))})

    def fill_forward(self, df: DataFrame, values: Mapping[str, Column]) -> DataFrame:
        """Each name := the latest non-null value at or before the row."""
        w = self._window().rowsBetween(Window.unboundedPreceding, Window.currentRow)
        before = self._slices().rowsBetween(Window.unboundedPreceding, -1)
        edges = self._edges(df, {
            f"_edge_{n}": F.max_by(v, F.when(v.isNotNull(), self._position())) for n, v in values.items()
        })
        for n in values:
            edges = edges.withColumn(f"_edge_{n}", F.last(f"_edge_{n}", ignorenulls=True).over(before))
        near = df.withColumns({n: F.last(v, ignorenulls=True).over(w) for n, v in values.items()})
        return self._merge(near, edges, {n: F.coalesce(F.col(n), F.col(f"_edge_{n}")) for n in values})

    # -- internals -------------------------------------------------------------------------------

    def _position(self) -> Column:
        return F.struct(*[F.col(c) for c in self.order])

    def _window(self) -> WindowSpec:
        # _split is constant per key; naming it here lets filters on it pass below the window.
        return Window.partitionBy(*self.keys, _SPLIT, _SLICE).orderBy(*self.order)

    def _slices(self) -> WindowSpec:
        return Window.partitionBy(*self.keys).orderBy(_SLICE)

    def _edges(self, df: DataFrame, aggregates: Mapping[str, Column]) -> DataFrame:
        return (
            df.filter(F.col(_SPLIT))
            .groupBy(*self.keys, _SLICE)
            .agg(*[a.alias(n) for n, a in aggregates.items()])
        )

    def _merge(self, near: DataFrame, edges: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
        extra = [c for c in edges.columns if c.startswith("_edge")] + ["_border"]
        # At most one row per slice: bounded by cuts + split keys <= 2 * max_cuts rows.
        joined = near.join(F.broadcast(edges), [*self.keys, _SLICE], "left")
        resolved = {
            n: F.when(F.col(_SPLIT), c).otherwise(F.col(n)) for n, c in columns.items()
        }
        return joined.withColumns(resolved).drop(*extra)
