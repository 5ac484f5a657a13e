"""Ordered computation over data of any length, without a one-partition window.

``lay_out`` range-partitions rows by ``by + order``, sorts each partition and
writes the result once with a partition number and a slot.  Every ordered
operator then works inside a partition and adds a small correction carried
over from earlier partitions.  The correction table holds at most one row per
partition (only a group that began in an earlier partition needs one), so
broadcasting it is bounded by the partition count, whatever the data size.

Because the split points come from the data's own distribution over
``by + order``, one group holding a third of all rows is spread over a third
of the partitions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import column
from tidemark.session import materialise

# a range of at most this many rows is sorted by a bounded top-k
SMALL = 10_000
_ACCURACY = 10_000  # rank error of a quantile sketch is below total / _ACCURACY
_SKETCHED = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)

PART = "_part"
SLOT = "_slot"
# monotonically_increasing_id keeps the partition number above this bit
_PARTITION_SHIFT = 33
_LOCAL_MASK = (1 << _PARTITION_SHIFT) - 1


@dataclass(frozen=True)
class Running:
    """A running aggregate: ``kind`` is sum, min or max; ``exclusive`` leaves out the current row."""

    kind: str
    value: Column
    exclusive: bool = False


_AGGREGATES = {"sum": F.sum, "min": F.min, "max": F.max}


def _combine(kind: str, carried: Column, local: Column) -> Column:
    if kind == "sum":
        return F.coalesce(carried + local, carried, local)
    return F.least(carried, local) if kind == "min" else F.greatest(carried, local)


@dataclass(frozen=True)
class OrderedLayout:
    """Rows laid out in order over ``parts`` partitions; each method returns a wider layout.

    ``placed`` tells that the plan already holds each layout partition in one
    task, so a chain of ordered steps moves the rows only once.
    """

    df: DataFrame
    by: tuple[str, ...]
    order: tuple[str, ...]
    parts: int
    placed: bool = False

    def local_window(self):
        return Window.partitionBy(PART, *self.by).orderBy(SLOT)

    def placed_rows(self) -> DataFrame:
        """Rows with exactly one layout partition per task, which ``local_window`` needs."""
        return self.df if self.placed else self.df.repartitionById(self.parts, PART)

    def join_carried(self, df: DataFrame, carried: DataFrame, fields: Sequence[str]) -> DataFrame:
        """Left-join the at-most-one-row-per-partition table ``carried``."""
        renamed = carried.select(
            F.col(PART).alias("_c_part"),
            *[F.col(b).alias(f"_c_by_{b}") for b in self.by],
            *fields,
        )
        match = F.col(PART) == F.col("_c_part")
        for b in self.by:
            match = match & F.col(b).eqNullSafe(F.col(f"_c_by_{b}"))
        joined = df.join(F.broadcast(renamed), match, "left")
        return joined.drop("_c_part", *[f"_c_by_{b}" for b in self.by])

    def with_running(self, **specs: Running) -> OrderedLayout:
        """Add running aggregates within each ``by`` group."""
        columns = [column(c) for c in self.df.columns]
        upto = {False: Window.currentRow, True: -1}
        local = self.placed_rows().withColumns(
            {
                f"_l_{name}": _AGGREGATES[s.kind](s.value).over(
                    self.local_window().rowsBetween(Window.unboundedPreceding, upto[s.exclusive])
                )
                for name, s in specs.items()
            }
        )
        totals = self.df.groupBy(PART, *self.by).agg(
            *[_AGGREGATES[s.kind](s.value).alias(f"_t_{name}") for name, s in specs.items()]
        )
        across = Window.partitionBy(*self.by).orderBy(PART)
        before = across.rowsBetween(Window.unboundedPreceding, -1)
        carried = (
            totals.withColumn("_began", F.lag(PART).over(across))
            .withColumns(
                {
                    f"_c_{name}": _AGGREGATES[s.kind](F.col(f"_t_{name}")).over(before)
                    for name, s in specs.items()
                }
            )
            .filter(F.col("_began").isNotNull())
        )
        joined = self.join_carried(local, carried, [f"_c_{name}" for name in specs])
        return replace(
            self,
            placed=True,
            df=joined.select(
                *columns,
                *[
                    _combine(s.kind, F.col(f"_c_{name}"), F.col(f"_l_{name}")).alias(name)
                    for name, s in specs.items()
                ],
            ),
        )

    def with_position(self, name: str) -> OrderedLayout:
        """Add the 1-based position of each row within its ``by`` group."""
        if self.by:
            return self.with_running(**{name: Running("sum", F.lit(1).cast("bigint"))})
        sizes = self.df.groupBy(PART).agg(F.count(F.lit(1)).alias("_size"))
        before = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
        offsets = sizes.select(PART, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
        columns = [column(c) for c in self.df.columns]
        joined = self.join_carried(self.df, offsets, ["_offset"])
        local = F.col(SLOT).bitwiseAND(F.lit(_LOCAL_MASK))
        return replace(self, df=joined.select(*columns, (F.col("_offset") + local + 1).alias(name)))

    def _with_neighbour(self, values: dict[str, Column], following: bool) -> OrderedLayout:
        columns = [column(c) for c in self.df.columns]
        step = F.lead if following else F.lag
        window = self.local_window()
        local = self.placed_rows().withColumns(
            {f"_v_{name}": value for name, value in values.items()}
        ).withColumns(
            {
                "_edge": step(SLOT).over(window).isNull(),
                **{f"_l_{name}": step(f"_v_{name}").over(window) for name in values},
            }
        )
        packed = F.struct(*[value.alias(name) for name, value in values.items()])
        across = Window.partitionBy(*self.by).orderBy(PART)
        # the first row of a group in one partition is what the group's rows in
        # the partition before it look ahead to (and the last row, looking back);
        # its slot is found by hashing, and only those rows are fetched
        wanted = (
            self.df.groupBy(PART, *self.by)
            .agg((F.min if following else F.max)(SLOT).alias("_edge_slot"))
            .withColumn("_target", (F.lag if following else F.lead)(PART).over(across))
            .filter(F.col("_target").isNotNull())
            .select("_edge_slot", "_target")
        )
        edges = self.df.join(F.broadcast(wanted), F.col(SLOT) == F.col("_edge_slot")).select(
            F.col("_target").alias(PART), *self.by, packed.alias("_edge_row")
        )
        joined = self.join_carried(local, edges, ["_edge_row"])
        return replace(
            self,
            placed=True,
            df=joined.select(
                *columns,
                *[
                    F.when(F.col("_edge"), F.col("_edge_row")[name])
                    .otherwise(F.col(f"_l_{name}"))
                    .alias(name)
                    for name in values
                ],
            ),
        )

    def with_next(self, **values: Column) -> OrderedLayout:
        """Add each value taken from the following row of the group; null on its last row."""
        return self._with_neighbour(values, following=True)

    def with_previous(self, **values: Column) -> OrderedLayout:
        """Add each value taken from the preceding row of the group; null on its first row."""
        return self._with_neighbour(values, following=False)

    def with_columns(self, **columns: Column) -> OrderedLayout:
        return replace(self, df=self.df.withColumns(columns))

    def frozen(self) -> OrderedLayout:
        """Write the layout, so that a chain of ordered steps does not recompute itself."""
        return replace(self, df=materialise(self.df, "layout"), placed=False)

    def rows(self) -> DataFrame:
        """The rows without the layout's own columns."""
        return self.df.drop(PART, SLOT)


def lay_out(
    df: DataFrame,
    order: Sequence[str],
    by: Sequence[str] = (),
    partitions: int | None = None,
) -> OrderedLayout:
    """Lay ``df`` out by ``by + order``.

    Rows equal on every key are ordered by a hash of the whole row, and rows
    equal throughout by their place in the input, so very many rows with one
    key, or very many copies of one row, still spread over partitions.
    """
    keys = [*map(column, (*by, *order)), "_tie", "_copy"]
    # maps cannot be hashed
    hashed = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    tied = df.withColumn("_tie", F.xxhash64(*map(column, hashed))).withColumn("_copy", F.monotonically_increasing_id())
    # without a given count, adaptive execution merges spark.sql.shuffle.partitions by their bytes
    ranged = tied.repartitionByRange(partitions, *keys) if partitions else tied.repartitionByRange(*keys)
    slotted = (
        ranged.sortWithinPartitions(*keys)
        .drop("_tie", "_copy")
        .withColumn(SLOT, F.monotonically_increasing_id())
        .withColumn(PART, F.shiftright(SLOT, _PARTITION_SHIFT).cast("int"))
    )
    rows = materialise(slotted, "layout")
    parts = partitions or (rows.agg(F.max(PART)).first()[0] or 0) + 1
    return OrderedLayout(rows, tuple(by), tuple(order), parts)


def row_position(df: DataFrame, order: Sequence[str], by: Sequence[str] = (), name: str = "position") -> DataFrame:
    """Add the 1-based position of each row in ``order`` within its ``by`` group."""
    return lay_out(df, order, by).with_position(name).rows()


def _brackets(keys: DataFrame, lead: str, cuts: Sequence[int], total: int) -> list[tuple[Column | None, int, int]]:
    """For each cut a condition on ``lead`` holding that rank, the rows below it and the rows inside it.

    Quantile sketches propose the ranges and exact counts confirm them, in two
    passes that shuffle no rows.  A range that misses its rank is given up.
    """
    everything = [(None, 0, total)] * len(cuts)
    kind = keys.schema[lead].dataType
    if total <= SMALL or not isinstance(kind, _SKETCHED):
        return everything
    margin = 2.0 / _ACCURACY
    wanted = [q for c in cuts for q in (max(0.0, c / total - margin), min(1.0, c / total + margin))]
    sketch = F.percentile_approx(lead, wanted, _ACCURACY).cast("array<string>")
    found = keys.agg(sketch.alias("q")).first()["q"]
    if found is None:
        return everything
    bounds = [F.lit(v).cast(kind) for v in found]
    below = [F.col(lead).isNull() | (F.col(lead) < low) for low in bounds[::2]]
    inside = [(F.col(lead) >= low) & (F.col(lead) <= high) for low, high in zip(bounds[::2], bounds[1::2])]
    counts = keys.agg(
        *[F.count_if(c).alias(f"b{i}") for i, c in enumerate(below)],
        *[F.count_if(c).alias(f"i{i}") for i, c in enumerate(inside)],
    ).first()
    result = []
    for i, cut in enumerate(cuts):
        low, size = counts[f"b{i}"], counts[f"i{i}"]
        holds = low < cut and cut + 1 <= low + size
        result.append((inside[i], low, size) if holds else everything[0])
    return result


def boundary_rows(df: DataFrame, order: Sequence[str], cuts: Sequence[int], total: int) -> dict[int, tuple[Row, Row]]:
    """Order keys, as text, of the rows ranked ``cut`` and ``cut + 1``, for cuts inside 1..total-1.

    Only order keys are read, and only rows near a cut are sorted.  The driver
    receives two rows per cut, or at most ``SMALL`` keys from a small range.
    """
    keys = df.select(*order)
    shown = [F.col(k).cast("string").alias(k) for k in order]
    found = {}
    for cut, (condition, below, size) in zip(cuts, _brackets(keys, order[0], cuts, total)):
        near = keys.filter(condition) if condition is not None else keys
        rank = cut - below
        if size <= SMALL:
            rows = near.orderBy(*order).limit(rank + 1).select(*shown).collect()[-2:]
        else:
            ranked = lay_out(near, order).with_position("_rank").df
            rows = ranked.filter(F.col("_rank").isin(rank, rank + 1)).orderBy("_rank").select(*shown).collect()
        found[cut] = (rows[0], rows[1])
    return found


def key_struct(df: DataFrame, order: Sequence[str], row: Row) -> Column:
    """The keys of ``row`` (as returned by ``boundary_rows``) as a literal struct typed like ``df``."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return F.struct(*[F.lit(row[k]).cast(types[k]).alias(k) for k in order])
