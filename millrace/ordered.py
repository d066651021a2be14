"""Order-sensitive operators over groups of any size.

Spark evaluates a window partition in one task, so a group that holds a third of all
rows would stop the job. ``Ordered`` counts the largest group first:

* every group fits in a task: plain ``Window.partitionBy(key)``, one shuffle;
* some group does not (or there is no key at all): rows are range-partitioned by
  ``(key, order)`` and stored with their segment number. Windows then run inside
  ``(key, segment)``; what crosses a segment border is carried by

  - ``running``: totals per segment, prefix-combined and added back,
  - ``bounded``: copies of the few rows next to the border,
  - ``fold``: exit states handed from segment to segment.

Only the first key of a segment can reach back over its border, so each of these
carries has at most one row per segment, whatever the data size. That is the bound
behind every broadcast in this module.

Put ``bounded`` before ``running`` where both are needed: the rows at the borders are then
added before the shuffle, and both work on the same sorted partitions.

``order_by`` is ascending and has to end with a column that is unique within the key.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from millrace.session import rows_per_task, store

SEG = "_seg"
IDX = "_idx"
OWN = "_own"
CARRY = "_carry"

# Range bounds are sampled on the driver, so the number of segments stays moderate;
# beyond it segments grow, and the window sort spills.
MAX_SEGMENTS = 20_000
MIN_ROWS_PER_SEGMENT = 20_000

# Parallel rounds in which a stateful scan starts segments from guessed states.
GUESS_ROUNDS = 3

_AGG = {
    "sum": F.sum,
    "count": F.count,
    "max": F.max,
    "min": F.min,
    "last": lambda c: F.last(c, ignorenulls=True),
    "first": lambda c: F.first(c, ignorenulls=True),
    "and": F.bool_and,
    "or": F.bool_or,
}


def _combine(kind: str, before: Column, here: Column) -> Column:
    """Join the carried value with the one of this segment; either may be null."""
    if kind == "max":
        return F.greatest(before, here)
    if kind == "min":
        return F.least(before, here)
    if kind == "last":
        return F.coalesce(here, before)
    if kind == "first":
        return F.coalesce(before, here)
    if kind == "and":
        both = before & here
    elif kind == "or":
        both = before | here
    else:
        both = before + here
    return F.when(before.isNull(), here).when(here.isNull(), before).otherwise(both)


@dataclass(frozen=True)
class Jump:
    """How to pass a segment without scanning it again.

    ``add(summary, *inputs)`` collects a small summary of a segment, from ``start``;
    ``apply(state, summary)`` gives the exit state for an entry state, or None where the
    summary does not tell.
    """

    start: tuple
    add: Callable[..., tuple]
    apply: Callable[[tuple, list], tuple | None]


class Ordered:
    """Rows grouped by ``key`` and ordered by ``order_by``; see the module text."""

    def __init__(
        self,
        df: DataFrame,
        key: Sequence[str],
        order_by: Sequence[str],
        sizes: dict[int, int] | None = None,
        stored: DataFrame | None = None,
    ):
        self.rows = df
        self._stored = stored  # the segments as written, while their columns are unchanged
        self.key = list(key)
        self.order_by = list(order_by)
        self._sizes = sizes  # rows per segment; None when groups are not split

    @classmethod
    def of(
        cls,
        df: DataFrame,
        key: str | Sequence[str],
        order_by: str | Sequence[str],
        limit: int | None = None,
        bounded_groups: bool = False,
    ) -> Ordered:
        """Choose the layout. ``bounded_groups`` skips the count where the caller
        knows that no group exceeds the limit (say, keyed by order number)."""
        key = [key] if isinstance(key, str) else list(key)
        order_by = [order_by] if isinstance(order_by, str) else list(order_by)
        if key and bounded_groups:
            return cls(df, key, order_by)
        spark = df.sparkSession
        limit = limit or rows_per_task(spark)
        if key:
            stats = (
                df.groupBy(*key)
                .agg(F.count(F.lit(1)).alias("n"))
                .agg(F.max("n").alias("largest"), F.sum("n").alias("total"))
                .first()
            )
            largest, total = stats["largest"] or 0, stats["total"] or 0
            if largest <= limit:
                return cls(df, key, order_by)
        else:
            total = df.count()
        spread = min(spark.sparkContext.defaultParallelism, total // MIN_ROWS_PER_SEGMENT)
        segments = min(MAX_SEGMENTS, max(2, math.ceil(total / limit), spread))
        # The segment is a function of the range bounds, which are fixed once per
        # shuffle; storing it keeps every later use consistent, also after task retries.
        ranged = store(
            df.repartitionByRange(segments, *key, *order_by)
            .sortWithinPartitions(*key, *order_by)
            .withColumn(SEG, F.spark_partition_id())
            .withColumn(IDX, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))),
            "ordered",
        )
        sizes = {r[SEG]: r["n"] for r in ranged.groupBy(SEG).agg(F.count(F.lit(1)).alias("n")).collect()}
        return cls(ranged, key, order_by, sizes, ranged)

    # -- basics ---------------------------------------------------------------

    @property
    def split(self) -> bool:
        return self._sizes is not None

    @property
    def df(self) -> DataFrame:
        """The rows, without helper columns."""
        return self.rows.drop(SEG, IDX)

    @property
    def groups(self) -> list[str]:
        """The columns that part the rows of windows: the key and, if split, the segment."""
        return self.key + [SEG] if self.split else self.key

    @property
    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.groups).orderBy(*self.order_by)

    def _with(self, df: DataFrame, added: Iterable[str]) -> Ordered:
        """The same layout with further columns."""
        stored = self._stored
        if stored is not None and not set(stored.columns).isdisjoint(added):
            stored = None
        return Ordered(df, self.key, self.order_by, self._sizes, stored)

    def with_columns(self, columns: dict[str, Column]) -> Ordered:
        """Row-local columns."""
        return self._with(self.rows.withColumns(columns), columns)

    def where(self, condition: Column) -> DataFrame:
        return self.rows.where(condition).drop(SEG, IDX)

    # -- running aggregates ---------------------------------------------------

    def running(self, aggs: dict[str, tuple[str, Column | str]], exclusive: bool = False) -> Ordered:
        """Aggregates of all rows up to this one (``exclusive``: up to the one before).

        ``aggs`` maps a new column to ``(kind, column)``; kinds: sum, count, max, min,
        last and first (non-null), and, or. A ``count`` of nothing is 0, others null.
        """
        frame = self.window.rowsBetween(Window.unboundedPreceding, -1 if exclusive else 0)
        local = {name: _AGG[kind](col).over(frame) for name, (kind, col) in aggs.items()}
        if not self.split:
            return self._with(self.rows.withColumns(local), aggs)
        totals = self._segment_totals(aggs)
        carry_frame = Window.partitionBy(*self.key).orderBy(SEG).rowsBetween(Window.unboundedPreceding, -1)
        across = {"count": "sum"}
        carry = totals.select(
            *[F.col(k).alias(f"_c_{k}") for k in self.key],
            F.col(SEG).alias("_c_seg"),
            F.count(F.lit(1)).over(carry_frame).alias("_before"),
            *[
                _AGG[across.get(kind, kind)](F.col(f"_t{i}")).over(carry_frame).alias(f"_c{i}")
                for i, (kind, _) in enumerate(aggs.values())
            ],
        ).where("_before > 0")
        condition = F.col(SEG) == F.col("_c_seg")
        for k in self.key:
            condition = condition & F.col(k).eqNullSafe(F.col(f"_c_{k}"))
        joined = self.rows.withColumns(local).join(F.broadcast(carry), condition, "left")
        combined = joined.withColumns(
            {name: _combine(kind, F.col(f"_c{i}"), F.col(name)) for i, (name, (kind, _)) in enumerate(aggs.items())}
        )
        kept = [F.col(c) for c in self.rows.columns if c not in aggs]
        return self._with(combined.select(*kept, *aggs), aggs)

    def _segment_totals(self, aggs: dict[str, tuple[str, Column | str]]) -> DataFrame:
        """One row per (key, segment); first/last follow the row order, not arrival."""
        position = F.col(IDX)
        exprs = []
        for i, (kind, col) in enumerate(aggs.values()):
            c = F.col(col) if isinstance(col, str) else col
            if kind == "last":
                agg = F.max_by(c, F.when(c.isNotNull(), position))
            elif kind == "first":
                agg = F.min_by(c, F.when(c.isNotNull(), position))
            else:
                agg = _AGG[kind](c)
            exprs.append(agg.alias(f"_t{i}"))
        if self._stored is not None:
            try:  # from the segments as written, if they hold what is aggregated
                return self._stored.groupBy(*self.groups).agg(*exprs)
            except AnalysisException:
                pass
        return self.rows.groupBy(*self.groups).agg(*exprs)

    def position(self, name: str = "pos") -> Ordered:
        """1-based row number within the key."""
        return self.running({name: ("count", F.lit(1))})

    def total(self, aggs: dict[str, tuple[str, Column | str]]) -> Ordered:
        """Aggregates over the whole group, put on each of its rows."""
        if not self.split:
            whole = Window.partitionBy(*self.key)
            return self._with(
                self.rows.withColumns({name: _AGG[kind](col).over(whole) for name, (kind, col) in aggs.items()}), aggs
            )
        across = {"count": "sum"}
        whole = Window.partitionBy(*self.key)
        per_segment = self._segment_totals(aggs).select(
            *[F.col(g).alias(f"_c_{g}") for g in self.groups],
            *[
                _AGG[across.get(kind, kind)](F.col(f"_t{i}")).over(whole).alias(name)
                for i, (name, (kind, _)) in enumerate(aggs.items())
            ],
        )
        condition = F.lit(True)
        for g in self.groups:
            condition = condition & F.col(g).eqNullSafe(F.col(f"_c_{g}"))
        joined = self.rows.drop(*aggs).join(per_segment, condition, "left")
        return self._with(joined.drop(*[f"_c_{g}" for g in self.groups]), aggs)

    # -- bounded frames -------------------------------------------------------

    def bounded(
        self,
        build: Callable[[WindowSpec], dict[str, Column]],
        before: int = 0,
        after: int = 0,
        prepare: Callable[[WindowSpec], dict[str, Column]] | None = None,
    ) -> Ordered:
        """Window columns that look at most ``before`` rows back and ``after`` ahead.

        ``build`` receives the window (no frame set) and returns the new columns.
        ``prepare`` gives helper columns, computed before it over the rows at hand (from
        ``before`` rows ahead of the segment on), for it to take differences of.
        """
        columns, helpers = build(self.window), prepare(self.window) if prepare else {}
        if not self.split:
            rows = self.rows.withColumns(helpers) if helpers else self.rows
            return self._with(rows.withColumns(columns).drop(*helpers), columns)
        rows = self.rows.withColumn(OWN, F.lit(True))
        links = self._halo_links(before, after)
        if links:
            spark = self.rows.sparkSession
            link_df = spark.createDataFrame(links, "_src int, _dst int, _lo long, _hi long")
            # the same bounds as a plain filter, which lets the scan skip most pages
            heads = max([hi for _, _, lo, hi in links if lo == 0], default=-1)
            tails = min([lo for _, _, lo, _ in links if lo > 0], default=None)
            near = F.col(IDX) <= heads if tails is None else (F.col(IDX) <= heads) | (F.col(IDX) >= tails)
            halo = (
                self.rows.where(near).join(
                    F.broadcast(link_df),
                    (F.col(SEG) == F.col("_src")) & F.col(IDX).between(F.col("_lo"), F.col("_hi")),
                )
                .withColumn(SEG, F.col("_dst"))
                .withColumn(OWN, F.lit(False))
                .drop("_src", "_dst", "_lo", "_hi")
            )
            rows = rows.unionByName(halo)
        if helpers:
            rows = rows.withColumns(helpers)
        return self._with(rows.withColumns(columns).where(OWN).drop(OWN, *helpers), columns)

    def _halo_links(self, before: int, after: int) -> list[tuple[int, int, int, int]]:
        """(source segment, target segment, first index, last index) of border rows."""
        order = sorted(self._sizes)
        links = []
        for at, seg in enumerate(order):
            missing = before
            for other in reversed(order[:at]):
                if missing <= 0:
                    break
                size = self._sizes[other]
                links.append((other, seg, max(0, size - missing), size - 1))
                missing -= size
            missing = after
            for other in order[at + 1 :]:
                if missing <= 0:
                    break
                links.append((other, seg, 0, missing - 1))
                missing -= self._sizes[other]
        return links

    # -- stateful scans -------------------------------------------------------

    def fold(
        self,
        inputs: Sequence[str],
        init: tuple,
        step: Callable[..., tuple[tuple, tuple]],
        outputs: Sequence[tuple[str, T.DataType]],
        jump: Jump | None = None,
    ) -> DataFrame:
        """Run ``step(state, *inputs) -> (state, outputs)`` over each group in order.

        For rules that no window expresses, such as "accept if the last accepted row is
        old enough". Rows stream through each task in Arrow batches; only the current
        state is held. ``state`` is a tuple of JSON values of fixed size. ``jump`` helps
        rules with a long memory over hot keys, see ``Jump``.
        """
        schema = T.StructType(
            [f for f in self.df.schema.fields] + [T.StructField(n, t, True) for n, t in outputs]
        )
        if not self.split:
            rows = self.rows.repartition(*self.key).sortWithinPartitions(*self.key, *self.order_by)
            return rows.mapInArrow(_scanner(self.key, inputs, init, step, outputs, None), schema)

        carry = self._entry_states(inputs, init, step, jump)
        rows = self.rows
        if carry is None:
            rows = rows.withColumn(CARRY, F.lit(None).cast("string"))
        else:
            rows = rows.join(F.broadcast(carry), self._on_groups(), "left").drop(
                *[f"_c_{g}" for g in self.groups]
            )
        groups = self.groups
        ordered = rows.repartition(*groups).sortWithinPartitions(*groups, *self.order_by)
        return ordered.mapInArrow(_scanner(groups, inputs, init, step, outputs, CARRY, drop=(SEG, IDX)), schema)

    def _on_groups(self) -> Column:
        condition = F.col(SEG) == F.col(f"_c_{SEG}")
        for k in self.key:
            condition = condition & F.col(k).eqNullSafe(F.col(f"_c_{k}"))
        return condition

    def _entry_states(self, inputs, init, step, jump) -> DataFrame | None:
        """Entry state of every segment that continues a group from the one before.

        All segments are first scanned from a guessed entry state, in parallel. Then each
        chain of segments is walked on the driver, one small value per segment: a known
        exit state, or one that ``jump`` derives, leads on; the first segment without one
        is scanned next, from its now certain entry state. Most rules forget their entry
        state within a segment, so that guesses come true after a round or two; guessing
        ends after ``GUESS_ROUNDS``, which bounds the work for those that never forget.
        """
        spark = self.rows.sparkSession
        groups = self.groups
        spans = (
            self.rows.groupBy(*groups)
            .agg(F.lit(1).alias("_one"))
            .withColumn("_n", F.count("_one").over(Window.partitionBy(*self.key)))
            .where("_n > 1")
            .select(*groups)
        )
        group_type = spans.schema
        pairs = sorted((one_nan(r) for r in spans.collect()), key=lambda p: p[-1])
        if not pairs:
            return None
        chains: dict[tuple, list[tuple]] = {}
        for p in pairs:
            chains.setdefault(p[:-1], []).append(p)
        first = json.dumps(init)
        known: dict[tuple, str] = {}  # (segment, entry state) -> exit state
        guess: dict[tuple, str] = {}  # segment -> exit state of its latest scan
        summaries: dict[tuple, list] = {}
        needed = self.rows.select(*dict.fromkeys([*groups, *self.order_by, *inputs]))
        carry_type = T.StructType(
            [T.StructField(f"_c_{f.name}", f.dataType, True) for f in group_type.fields]
            + [T.StructField(CARRY, T.StringType(), True)]
        )
        text = [T.StructField(n, T.StringType(), True) for n in ("_entry", "_exit", "_summary")]
        exit_type = T.StructType(group_type.fields + text)
        rounds = 0
        while True:
            entry: dict[tuple, str] = {}
            todo: list[tuple] = []
            unresolved = False
            for chain in chains.values():
                state, certain = first, True
                for p in chain:
                    entry[p] = state
                    if p is chain[-1]:
                        break
                    after = known.get((p, state))
                    if after is None and jump is not None and p in summaries:
                        jumped = jump.apply(tuple(json.loads(state)), summaries[p])
                        after = None if jumped is None else json.dumps(jumped)
                    if after is None:
                        if certain or rounds < GUESS_ROUNDS:
                            todo.append((*p, state))
                        unresolved = True
                        if certain and rounds >= GUESS_ROUNDS:
                            break
                        certain = False
                        after = guess.get(p, first)
                    state = after
            if not unresolved:
                return spark.createDataFrame([(*p, s) for p, s in entry.items()], carry_type)
            carry = spark.createDataFrame(todo, carry_type)
            rows = needed.join(F.broadcast(carry), self._on_groups()).drop(*[f"_c_{g}" for g in groups])
            ordered = rows.repartition(*groups).sortWithinPartitions(*groups, *self.order_by)
            exits = ordered.mapInArrow(_exit_scanner(groups, inputs, init, step, exit_type, jump), exit_type)
            for r in exits.collect():
                p = one_nan(r)[:-3]
                known[(p, r["_entry"])] = guess[p] = r["_exit"]
                summaries[p] = json.loads(r["_summary"])
            rounds += 1


_NAN = float("nan")


def one_nan(values: Iterable) -> tuple:
    """The values with the same object for every not-a-number: as in Spark, these then are one key."""
    return tuple([_NAN if v != v else v for v in values])


def _scanner(groups, inputs, init, step, outputs, carry, drop=()):
    """A ``mapInArrow`` function over rows sorted by group and order."""
    names = [n for n, _ in outputs]
    types = [to_arrow_type(t) for _, t in outputs]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, init
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in inputs]
            group_of = map(one_nan, zip(*[batch.column(g).to_pylist() for g in groups]))
            entry = batch.column(carry).to_pylist() if carry else [None] * batch.num_rows
            out: list[tuple] = []
            for group, start, values in zip(group_of, entry, zip(*columns)):
                if group != current:
                    current = group
                    state = tuple(json.loads(start)) if start is not None else init
                state, emitted = step(state, *values)
                out.append(emitted)
            kept = [n for n in batch.schema.names if n not in drop and n != carry]
            new = [pa.array([o[i] for o in out], type=t) for i, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in kept] + new, names=kept + names)

    return scan


def _exit_scanner(groups, inputs, init, step, exit_type, jump):
    """One row per group: its entry state, its exit state and its summary."""
    types = [to_arrow_type(f.dataType) for f in exit_type.fields]
    names = exit_type.names

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, entry, state, summary, done = None, None, init, None, []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in inputs]
            group_of = map(one_nan, zip(*[batch.column(g).to_pylist() for g in groups]))
            for group, start, values in zip(group_of, batch.column(CARRY).to_pylist(), zip(*columns)):
                if group != current:
                    if current is not None:
                        done.append((*current, entry, json.dumps(state), json.dumps(summary)))
                    current, entry, state = group, start, tuple(json.loads(start))
                    summary = jump.start if jump else None
                state, _ = step(state, *values)
                if jump:
                    summary = jump.add(summary, *values)
        if current is not None:
            done.append((*current, entry, json.dumps(state), json.dumps(summary)))
        arrays = [pa.array([d[i] for d in done], type=t) for i, t in enumerate(types)]
        yield pa.RecordBatch.from_arrays(arrays, names=names)

    return scan
