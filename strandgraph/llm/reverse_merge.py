"""Versions of a dimension from its change rows, by reverse-time resolution.

A client's changes are read from the newest to the oldest.  A null attribute of an update is pending: it waits,
with those of newer updates, until an older row decides it, which is an update with a value, or a delete or insert
with whatever it holds.  A row whose state is that of the row before it in time opens no version; the others are
numbered from the oldest.

A client may hold any share of the rows, so nothing is done by client alone.  Of rows with equal seq, and then with
equal time, the one to keep is a maximum, which tasks take in part before they shuffle.  Time is cut into spans of
``SPAN`` seconds: the scan's group is a client's span, of a row for each of its times, which is at most one a second
in seconds' resolution, and windows over a client see a row for each of its spans.  A span begins with a row that
carries in what older spans leave: for every attribute the newest row that decides it, which is again a maximum.  So
what the scan finds pending at a span's older end that row decides.

Edge cases: rows without a time take no part; identical rows count once.  A null client is a client of its own, a
null seq one seq, less than any; a null change id is less than any, isn't moved and not counted.  Rows of equal seq
and change id are told apart by time, op and attributes, the largest staying.  Ops other than D, I and U set no
state; their change ids are counted.  A balance that is no finite number, or over 9e16, counts as null.  Times are taken to
UTC where they have a zone; versions begin at whole seconds, rounded down.  Changes before a client's first state are
in no version.  An empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import lean, materialise

#: Seconds in a span; at most this many rows of a client, at a second's resolution, are in one group.
SPAN = 86_400
_MICROS = 1_000_000
_ATTRIBUTES = ("source", "segment", "city", "balance_cents")


def micros(at: Column, zoned: bool) -> Column:
    """Microseconds since 1970 in UTC, whatever the session's zone."""
    if zoned:
        return F.unix_micros(at)
    minutes = F.unix_date(F.to_date(at)).cast("long") * 1440 + F.hour(at) * 60 + F.minute(at)
    return minutes * (60 * _MICROS) + (F.date_part(F.lit("SECOND"), at) * _MICROS).cast("long")


def _rows(changes: DataFrame, hours: int) -> DataFrame:
    """The changes with a time: has (a client), client, change_id, seq, op, at and the attributes."""
    balance, zoned = F.col("balance"), changes.schema["valid_at"].dataType.typeName() == "timestamp"
    moved = F.coalesce(F.crc32(F.encode(F.col("change_id").cast("string"), "utf-8")) % 3 == 0, F.lit(False))
    return changes.where("valid_at IS NOT NULL").select(
        F.col("client_id").isNotNull().alias("has"), F.coalesce(F.col("client_id"), F.lit(0)).alias("client"), "change_id", "seq", "op",
        (micros(F.col("valid_at"), zoned) - F.when(moved, F.lit(hours * 3600 * _MICROS)).otherwise(0)).alias("at"),
        "source", "segment", "city", F.when(~F.isnan(balance) & (F.abs(balance) < 9e16), F.floor(100 * balance + 0.5)).alias("balance_cents"),
    )


def _timeline(rows: DataFrame, span: int) -> DataFrame:
    """A row for each client and time, with the change that holds there, if any is kept."""
    known = F.col("op").isin("D", "I", "U")
    latest = F.max(F.struct("change_id", "at", "op", *_ATTRIBUTES)).alias("r")
    kept = rows.where(known).groupBy("has", "client", "seq").agg(latest).select("has", "client", "r.at", F.struct("seq", "r.op", *[f"r.{a}" for a in _ATTRIBUTES]).alias("change"))
    times = rows.select("has", "client", "at", F.lit(None).cast(kept.schema["change"].dataType).alias("change"))
    held = kept.unionByName(times).groupBy("has", "client", "at").agg(F.max("change").alias("change"))
    return held.withColumn("span", F.floor(F.col("at") / F.lit(span * _MICROS)))


def _carried(timeline: DataFrame) -> DataFrame:
    """For each client's span the state that older spans leave: of each attribute what the newest row decides."""
    op = F.col("change.op")
    decides = lambda a: F.max(F.when((op != "U") | F.col(f"change.{a}").isNotNull(), F.struct("at", F.when(op != "D", F.col(f"change.{a}")).alias("value")))).alias(a)
    spans = timeline.groupBy("has", "client", "span").agg(F.max(F.when(op.isNotNull(), F.struct("at", op.alias("op")))).alias("op"), *[decides(a) for a in _ATTRIBUTES])
    older = Window.partitionBy("has", "client").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    return spans.select("has", "client", "span", *[F.last(c, ignorenulls=True).over(older).alias(c) for c in ("op", *_ATTRIBUTES)])


def _next(marked: np.ndarray) -> np.ndarray:
    """The first marked place at or after each; the length where there is none."""
    at = np.where(marked, np.arange(len(marked)), len(marked))
    return np.minimum.accumulate(at[::-1])[::-1]


def _whole_groups(batches):
    """Batches cut behind a group's carried row, which is its last."""
    held = None
    for batch in batches:
        rows = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
        ends = np.flatnonzero(rows["carried"].to_numpy())
        cut = ends[-1] + 1 if len(ends) else 0
        if cut:
            yield rows.slice(0, cut)
        left = rows.slice(cut).combine_chunks().to_batches()
        held = left[0] if left else None


def _scan(batches):
    """Reads each client's span from its newest row to the one that is carried in; gives a row for each of its times:
    the opening of its version, if that is in the span, and of openings the state, the next newer opening and the
    ordinal from the oldest."""
    for rows in _whole_groups(batches):
        n, op = rows.num_rows, rows["op"].combine_chunks()
        carried = rows["carried"].to_numpy()
        is_op = lambda o: pc.fill_null(pc.equal(op, o), False).to_numpy(zero_copy_only=False)
        deletes, updates, known = is_op("D"), is_op("U"), op.is_valid().to_numpy(zero_copy_only=False)
        state = np.flatnonzero(known | carried)  # rows that hold a state, newest first, and the groups' ends
        older = np.minimum(np.arange(len(state)) + 1, len(state) - 1)
        dead, fixed, nothing = deletes[state], carried[state], ~known[state]
        same = (dead == dead[older]) & ~nothing[older]
        resolved = {}
        for name in _ATTRIBUTES:
            column = rows[name].combine_chunks()
            filled = column.is_valid().to_numpy(zero_copy_only=False)[state]
            by = _next(~updates[state] | filled | fixed)  # pending rows wait for this one
            values = column.take(pa.array(state[by], mask=dead[by]))
            before = values.take(pa.array(older))
            both = pc.and_(values.is_null(), before.is_null())
            same &= pc.or_(pc.fill_null(pc.equal(values, before), False), both).to_numpy(zero_copy_only=False)
            place = np.zeros(n, np.int64)
            place[state] = np.arange(len(state))
            unset = np.ones(n, bool)
            unset[state] = False
            resolved[name] = values.take(pa.array(place, mask=unset))
        opens = np.zeros(n, bool)
        opens[state[~same & ~fixed]] = True
        group = np.cumsum(carried) - carried
        start = _next(opens)
        inside = start < n
        inside[inside] = group[start[inside]] == group[inside]
        openings = np.flatnonzero(opens)
        newer = np.full(n, -1)
        newer[openings[1:]] = np.where(group[openings[1:]] == group[openings[:-1]], openings[:-1], -1)
        so_far = np.append(np.cumsum(opens[::-1])[::-1], 0)  # openings from here to the last row
        rank = np.where(opens, so_far[:-1] - so_far[np.searchsorted(group, group, "right")], 0)
        at = pc.fill_null(rows["at"], 0).to_numpy()
        time_of = lambda place, ok: pa.array(at[np.where(ok, place, 0)], mask=~ok)
        made = [rows["has"], rows["client"], rows["span"], rows["at"], time_of(start, inside), time_of(newer, newer >= 0), pa.array(rank), pa.array(opens & deletes), *resolved.values(), rows["seq"]]
        yield from pa.table(made, ["has", "client", "span", "at", "start", "newer", "rank", "is_deleted", *_ATTRIBUTES, "seq"]).filter(pa.array(~carried)).to_batches()


def versions(changes: DataFrame, hours: int = 240, span: int = SPAN) -> DataFrame:
    """client_id, version, valid_from, valid_to, is_deleted, the attributes, first_seq and n_changes."""
    rows = _rows(changes, hours)
    timeline = materialise(_timeline(rows, span), "timeline")
    carried = _carried(timeline)
    body = timeline.select("has", "client", "span", "at", F.lit(False).alias("carried"), "change.seq", "change.op", *[f"change.{a}" for a in _ATTRIBUTES])
    head = carried.select("has", "client", "span", F.lit(None).cast("long").alias("at"), F.lit(True).alias("carried"), F.lit(None).cast(body.schema["seq"].dataType).alias("seq"), "op.op", *[F.col(f"{a}.value").alias(a) for a in _ATTRIBUTES])
    number, text = (body.schema[c].dataType.simpleString() for c in ("client", "city"))
    made = f"has boolean, client {number}, span long, at long, start long, newer long, rank long, is_deleted boolean, source {text}, segment {text}, city {text}, balance_cents long, seq {body.schema['seq'].dataType.simpleString()}"
    ordered = body.unionByName(head).repartition("has", "client", "span").sortWithinPartitions("has", "client", "span", F.desc_nulls_last("at"))
    found = materialise(ordered.mapInArrow(lean(_scan), made), "resolved")

    opens = F.col("rank") > 0
    spans = found.groupBy("has", "client", "span").agg(F.count_if(opens).alias("n"), F.min(F.when(opens, F.col("at"))).alias("oldest"), F.max(F.when(opens, F.col("at"))).alias("newest"))
    up = Window.partitionBy("has", "client").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    down = Window.partitionBy("has", "client").orderBy(F.desc("span")).rowsBetween(Window.unboundedPreceding, -1)
    around = spans.select("has", "client", "span", F.coalesce(F.sum("n").over(up), F.lit(0)).alias("before"), F.last("newest", ignorenulls=True).over(up).alias("since"), F.last("oldest", ignorenulls=True).over(down).alias("until"))
    placed = found.join(around, ["has", "client", "span"])
    seconds = lambda c: F.floor(F.col(c) / _MICROS)

    of = placed.select("has", "client", "at", F.coalesce("start", "since").alias("since")).where("since IS NOT NULL")
    counted = rows.where("change_id IS NOT NULL").select("has", "client", "at", "change_id").join(of, ["has", "client", "at"])
    counted = counted.groupBy("has", "client", "since", "change_id").agg(F.lit(1).alias("one")).groupBy("has", "client", "since").agg(F.count("one").alias("n_changes"))

    out = placed.where(opens).withColumn("to", F.coalesce("newer", "until")).join(counted.withColumnRenamed("since", "at"), ["has", "client", "at"], "left")
    return out.select(
        F.when(F.col("has"), F.col("client")).alias("client_id"), (F.col("before") + F.col("rank")).cast("int").alias("version"), seconds("at").alias("valid_from"), seconds("to").alias("valid_to"), "is_deleted",
        *_ATTRIBUTES, F.col("seq").alias("first_seq"), F.coalesce("n_changes", F.lit(0)).alias("n_changes"),
    )
