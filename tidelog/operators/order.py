"""Ordered state over a log without an unpartitioned window.

A log is one totally ordered sequence, but a window over all of it would run in
one task, and a window per log file would let one huge file do the same.  So
the log is cut into *slices* of bounded size by arithmetic on the order key,
each slice is reduced to one small row (with map-side combine), a running
value over those rows gives every slice what came before it, and the rows of a
slice only need a window over that slice:

    rows --partial agg--> one row per slice --running value--> carry per slice
    rows --window inside the slice--> join carry on the slice key

The row side is shuffled once, on the slice key; window and join share it.

Bounds: an event takes at least 19 bytes of log, so a slice of 16 MiB of log
offsets holds at most 883,011 events; end offsets are 32-bit in the log, so a
file has at most 256 slices and a bundle of 4,096 files at most 1,048,576 rows
of a few numbers each.  The last running value, the only window without keys,
sees one such row per 4,096 files: 24 for 100 TB in 1 GiB files.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

SLICE_BYTES = 16 * 1024 * 1024
FILES_PER_BUNDLE = 4096
SLICE_ROWS = 1 << 20
SLICES_PER_BUNDLE = 1 << 12


FILE_NO = r"coalesce(try_cast(regexp_extract({0}, '([0-9]+)$', 1) AS BIGINT), -1)"


def file_no(log_file: str = "log_file") -> Column:
    """Number at the end of a log file name; -1 when there is none."""
    return F.expr(FILE_NO.format(log_file))


@dataclass(frozen=True)
class Slices:
    """How a sequence is cut; everything is SQL over the rows.

    ``parts``  integer slice key, outermost first; comparing it compares slices
    ``order``  total order of the rows of one slice
    ``keys``   keys of independent sequences, each starting afresh
    ``bundle`` SQL over ``parts`` that puts neighbouring slices together, so that
               the running value over slices is itself taken in two levels
    """

    parts: Mapping[str, str]
    order: list[str]
    keys: Mapping[str, str] = field(default_factory=dict)
    bundle: str | None = None

    @property
    def names(self) -> list[str]:
        return [*self.keys, *self.parts]

    def tag(self, df: DataFrame) -> DataFrame:
        # Never null: no row is lost in the join, and the optimizer adds no
        # null filters that would keep branches from sharing a shuffle.
        return df.withColumns({
            **{n: F.expr(f"coalesce(CAST({e} AS STRING), '\\0')") for n, e in self.keys.items()},
            **{n: F.expr(f"coalesce(CAST({e} AS BIGINT), -1)") for n, e in self.parts.items()},
        })

    def rank(self) -> Column:
        return F.expr(self.order[0] if len(self.order) == 1 else f"struct({', '.join(self.order)})")


def log_slices(slice_bytes: int = SLICE_BYTES, files: int = FILES_PER_BUNDLE) -> Slices:
    """The whole log as one sequence in (file number, position) order."""
    return Slices(
        parts={"_file": FILE_NO.format("log_file"), "_slice": f"position div {slice_bytes}"},
        order=["position"],
        bundle=f"_file div {files}",
    )


def source_slices(source: str, slice_bytes: int = SLICE_BYTES) -> Slices:
    """The logs of several sources, each in (file number, position) order, as sequences of their own."""
    return Slices(
        keys={"_source": source},
        parts={"_file": FILE_NO.format("log_file"), "_slice": f"position div {slice_bytes}"},
        order=["position"],
    )


def file_slices(slice_bytes: int = SLICE_BYTES) -> Slices:
    """Each log file as its own sequence."""
    return Slices(keys={"_name": "log_file"}, parts={"_slice": f"position div {slice_bytes}"}, order=["position"])


def sequence_slices(column: str, rows: int = SLICE_ROWS, bundle: int = SLICES_PER_BUNDLE) -> Slices:
    """One sequence ordered by a unique integer."""
    return Slices(parts={"_slice": f"{column} div {rows}"}, order=[column], bundle=f"_slice div {bundle}")


def time_slices(keys: list[str], ts: str, seconds: int, tie: list[str] | None = None) -> Slices:
    """Per-key sequences in time order, cut at multiples of ``seconds``."""
    micros = f"unix_micros(CAST({ts} AS TIMESTAMP))"
    return Slices(
        keys={f"_key{i}": k for i, k in enumerate(keys)},
        parts={"_slice": f"{micros} div {seconds * 1000000}"},
        order=[micros, *(tie or [])],
    )


def _before(partition: list[str], order: list[str]) -> Window:
    return Window.partitionBy(*partition).orderBy(*[F.expr(o) for o in order]).rowsBetween(Window.unboundedPreceding, -1)


def _running(window, last, count) -> dict[str, Column]:
    """Last non-null value and total of everything strictly before."""
    return {
        **{n: F.last(n, ignorenulls=True).over(window) for n in last},
        **{n: F.coalesce(F.sum(n).over(window), F.lit(0)) for n in count},
    }


def _slice_carry(summary: DataFrame, slices: Slices, last: list[str], count: list[str]) -> DataFrame:
    """Value of the running state at the start of each slice, as ``_carry_*``, and the counts of whole sequences, as ``_all_*``."""
    parts = list(slices.parts)

    def whole(keys: list[str]) -> list[Column]:
        return [F.sum(n).over(Window.partitionBy(*keys)).alias(f"_all_{n}") for n in count]

    if slices.bundle is None:
        running = _running(_before(list(slices.keys), parts), last, count)
        return summary.select(*slices.names, *[c.alias(f"_carry_{n}") for n, c in running.items()], *whole(list(slices.keys)))

    bundled = summary.withColumn("_bundle", F.expr(f"coalesce({slices.bundle}, -1)"))
    running = _running(_before(["_bundle"], parts), last, count)
    inner = bundled.select("_bundle", *parts, *[c.alias(f"_inner_{n}") for n, c in running.items()])
    place = f"struct({', '.join(parts)})"
    totals = bundled.groupBy("_bundle").agg(
        *[F.expr(f"max_by({n}, if({n} is null, null, {place}))").alias(n) for n in last],
        *[F.sum(n).alias(n) for n in count],
    )
    # One row per bundle: the only window without keys, and it is tiny.
    running = _running(_before([], ["_bundle"]), last, count)
    outer = totals.select("_bundle", *[c.alias(f"_outer_{n}") for n, c in running.items()], *whole([]))
    return inner.join(outer, "_bundle").selectExpr(
        *parts,
        *[f"coalesce(_inner_{n}, _outer_{n}) as _carry_{n}" for n in last],
        *[f"_inner_{n} + _outer_{n} as _carry_{n}" for n in count],
        *[f"_all_{n}" for n in count],
    )


def _summarise(tagged: DataFrame, slices: Slices, fixed: Mapping, text: Mapping, count: Mapping) -> DataFrame:
    """One row per slice: last non-null values and counts.

    Hash aggregation needs fixed-width buffers, so text states are first
    grouping keys (a slice has few distinct ones) and are resolved in a second,
    small aggregate.
    """
    names, rank = slices.names, slices.rank()
    if not text:
        return tagged.groupBy(*names).agg(
            *[F.max_by(e, F.when(e.isNotNull(), rank)).alias(n) for n, e in fixed.items()],
            *[F.count_if(e).alias(n) for n, e in count.items()],
        )
    first = tagged.groupBy(*names, *[e.alias(n) for n, e in text.items()]).agg(
        F.max(rank).alias("_at"),
        *[F.max_by(e, F.when(e.isNotNull(), rank)).alias(n) for n, e in fixed.items()],
        *[F.max(F.when(e.isNotNull(), rank)).alias(f"_at_{n}") for n, e in fixed.items()],
        *[F.count_if(e).alias(n) for n, e in count.items()],
    )
    return first.groupBy(*names).agg(
        *[F.expr(f"max_by({n}, if({n} is null, null, _at))").alias(n) for n in text],
        *[F.expr(f"max_by({n}, _at_{n})").alias(n) for n in fixed],
        *[F.sum(n).alias(n) for n in count],
    )


def with_carry(
    rows: DataFrame,
    slices: Slices,
    last: Mapping[str, Column] | None = None,
    text: Mapping[str, Column] | None = None,
    count: Mapping[str, Column] | None = None,
    initial: Mapping[str, object] | None = None,
    totals: bool = False,
) -> DataFrame:
    """Add state taken over all rows strictly before each row.

    ``last``    name -> fixed-width expression; gives its last non-null value
    ``text``    the same for text expressions with few values per slice
    ``count``   name -> condition; gives how many earlier rows met it
    ``initial`` values that hold before the first row
    ``totals``  add each count over the row's whole sequence too, as ``{name}_total``
    """
    fixed, text, count = dict(last or {}), dict(text or {}), dict(count or {})
    latest = {**fixed, **text}
    tagged = slices.tag(rows)
    summary = _summarise(tagged, slices, fixed, text, count)
    carry = _slice_carry(summary, slices, list(latest), list(count))

    window = _before(slices.names, slices.order)
    local = tagged.withColumns({
        **{n: F.last(e, ignorenulls=True).over(window) for n, e in latest.items()},
        **{n: F.count_if(e).over(window) for n, e in count.items()},
    })
    start = initial or {}
    merged = {
        **{n: F.coalesce(F.col(n), F.col(f"_carry_{n}"), *([F.lit(start[n])] if start.get(n) is not None else []))
           for n in latest},
        **{n: F.expr(f"coalesce({n}, 0) + _carry_{n} + {int(start.get(n, 0))}") for n in count},
    }
    keep = [c for c in rows.columns if c not in merged]
    whole = [F.expr(f"_all_{n} + {int(start.get(n, 0))}").alias(f"{n}_total") for n in count] if totals else []
    return local.join(carry, slices.names).select(*keep, *[c.alias(n) for n, c in merged.items()], *whole)


def in_log_order(ev: DataFrame) -> DataFrame:
    """Events sorted by file number and position (range partitioned)."""
    return ev.orderBy(file_no(), "position")


def event_sequence(ev: DataFrame, slices: Slices | None = None, name: str = "seq_no", start: int = 0, totals: bool = False) -> DataFrame:
    """Number events 1, 2, 3, … in log order; ``start`` continues an earlier run, ``totals`` adds the last number as ``{name}_total``."""
    numbered = with_carry(ev, slices or log_slices(), count={name: F.lit(True)}, initial={name: start}, totals=totals)
    return numbered.withColumn(name, F.col(name) + 1)
