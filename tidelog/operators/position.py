"""Log positions: tracking, high-water mark, resume, checkpoint trail."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, functions as F

from ..schemas import FIRST_POSITION, UNKNOWN_FILE
from .order import Slices, file_no, file_slices, sequence_slices, with_carry


def track_position(
    raw: DataFrame,
    order: str = "seq",
    slices: Slices | None = None,
    start: tuple[str, int] | None = None,
) -> DataFrame:
    """Add ``log_file`` and ``position`` to events in arrival order.

    ``next_pos`` is the end offset an event declares, 0 when it declares none;
    a ROTATE event names the next file and its first position.
    """
    rotate = F.col("kind") == "ROTATE"
    own_file = F.when(rotate, F.when(F.coalesce(F.length("rotate_file"), F.lit(0)) == 0, UNKNOWN_FILE)
                      .otherwise(F.col("rotate_file")))
    own_pos = F.when(rotate, F.col("rotate_pos")).when(F.col("next_pos") > 0, F.col("next_pos"))
    first = {"log_file": start[0], "position": start[1]} if start else None
    carried = with_carry(
        raw, slices or sequence_slices(order),
        last={"position": own_pos}, text={"log_file": own_file}, initial=first,
    )
    return carried.withColumns({
        "log_file": F.coalesce(own_file, F.col("log_file")),
        "position": F.coalesce(own_pos, F.col("position")),
    })


def high_water_mark(ev: DataFrame) -> DataFrame:
    """One row: the last file and position, with its two-line text form."""
    top = ev.agg(F.max(F.struct(file_no().alias("n"), F.col("position").alias("p"), "log_file")).alias("m"))
    return top.select(
        F.col("m.log_file").alias("log_file"),
        F.col("m.p").alias("position"),
        F.concat_ws("\n", "m.log_file", F.col("m.p").cast("string")).alias("text"),
    )


def parse_mark(text: str) -> tuple[str, int]:
    """File and position of the two-line text form."""
    name, position = text.split()[:2]
    return name, int(position)


def after(ev: DataFrame, mark: tuple[str, int]) -> DataFrame:
    """Events strictly after a high-water mark.

    A log that stores the number of its file as a column ``file_no`` is read from there on
    only: the filter reaches the scan, and whole partitions or row groups are skipped.
    """
    log_file, position = mark
    number = int(re.search(r"(\d*)$", log_file).group(1) or -1)
    file = F.col("file_no") if "file_no" in ev.columns else file_no()
    # The first condition alone is one that sources can prune by.
    return ev.where(file >= number).where((file > number) | (F.col("position") > position))


def resume_from(
    ev: DataFrame,
    checkpoint: tuple[str, int] | str | None = None,
    start: tuple[str, int] | None = None,
) -> DataFrame:
    """Events from the saved checkpoint, else the configured start, else the end.

    A checkpoint or start is the end offset of the last event already read.
    With neither, only events that arrive later count, so a finished log
    gives no rows.
    """
    if isinstance(checkpoint, str):
        checkpoint = parse_mark(checkpoint)
    mark = checkpoint or start
    if mark is not None:
        return after(ev, mark)
    return ev.limit(0)


def checkpoint_trail(ev: DataFrame, every_n: int = 0, slices: Slices | None = None) -> DataFrame:
    """Every position that gets saved, with the reason.

    ``rotate``    at the start of each file; restarts the counter
    ``interval``  every ``every_n`` events, 0 meaning each one; the rotation that
                  opened the file is the first event of its count
    ``end``       the last event of the log
    """
    rotate = ev.select("log_file").distinct().select(
        "log_file", F.lit(FIRST_POSITION).cast("bigint").alias("position"), F.lit("rotate").alias("reason"))
    end = high_water_mark(ev).where("log_file is not null").select(
        "log_file", "position", F.lit("end").alias("reason"))
    narrow = ev.select("log_file", "position")
    if every_n > 0:
        counted = with_carry(narrow, slices or file_slices(), count={"_before": F.lit(True)})
        narrow = counted.where((F.col("_before") + 2) % every_n == 0)
    interval = narrow.select("log_file", "position", F.lit("interval").alias("reason"))
    return rotate.unionByName(interval).unionByName(end)
