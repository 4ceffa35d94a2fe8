"""Mixing sources to target weights by Pfair scheduling.

A source's documents, in an order of a hash, form blocks of ``block`` documents.  A source of weight w (the
weights sum to 1) must get its i-th block (from 0) in a slot no earlier than its release floor(i / w) and
before its deadline ceil((i + 1) / w); each slot goes to the released block with the earliest deadline.  With
one block a slot this keeps every source less than one block away from w times the slots so far.

Weights are exact fractions, a float the decimal number that it prints as, and all slots are computed with
whole numbers, one after the other in one task that holds a few numbers for each source and passes on a row for
each block.  Blocks grow with the corpus so that there are at most about ``SLOTS`` of them, a matter of seconds,
and the schedule is written before it is used, so a lost executor costs no more.  When a source runs out, the others share its weight from then on: no document is dropped or
repeated.  There are at most as many such phases as sources.

Edge cases: a null source is a source of its own; rows that repeat a key are ordered by their content; a
source without a target weight gets the mean weight; sources of weight 0 follow when the others have run out; an
empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Mapping
from fractions import Fraction
from itertools import count, islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import materialise, sized

#: Documents in a block, at least, and slots of a schedule, at most about: a larger corpus has larger blocks.
BLOCK, SLOTS = 16, 4_000_000
#: Rows of the schedule that are passed on at once.
SLOT_ROWS = 8192


def dealt(parts: Mapping) -> Iterator[tuple]:
    """Slot by slot without end, for whole weights: the source with the earliest deadline among released blocks, and
    its block's number, release and deadline.

    A block is released in every slot and every deadline is met, since the shares of all slots sum to 1."""
    names, total = list(parts), sum(parts.values())
    waiting = [(0, k) for k in range(len(names))]  # (release, source)
    ready: list[tuple[int, int, int]] = []
    given = [0] * len(names)
    for slot in count():
        while waiting and waiting[0][0] <= slot:
            _, k = heapq.heappop(waiting)
            s = parts[names[k]]
            heapq.heappush(ready, (-(-(given[k] + 1) * total // s), -s, k))
        deadline, _, k = heapq.heappop(ready)
        assert slot < deadline
        i, s = given[k], parts[names[k]]
        yield names[k], i, i * total // s, deadline
        given[k] += 1
        heapq.heappush(waiting, ((i + 1) * total // s, k))


def schedule(parts: Mapping, slots: int) -> list:
    """The source of each of the first ``slots`` slots."""
    return [n for n, *_ in islice(dealt(parts), slots)]


def plan(blocks: Mapping, weights: Mapping, lacks: Mapping | None = None, block: int = 1) -> Iterator[tuple]:
    """Source, block, slot, release, deadline and documents before it of every block, slot by slot; ``lacks`` says
    by how many documents a source's last block is short."""
    lacks, before = lacks or {}, 0
    left = {n: b for n, b in blocks.items() if b > 0}
    exact = {n: Fraction(str(weights[n])) for n in left}
    if any(w < 0 for w in exact.values()):
        raise ValueError("a weight is negative")
    done, base = dict.fromkeys(left, 0), 0
    while left:
        some = {n: exact[n] for n in left if exact[n]} or dict.fromkeys(left, Fraction(1))
        unit = math.lcm(*(w.denominator for w in some.values()))
        for slot, (n, _, release, deadline) in enumerate(dealt({n: int(w * unit) for n, w in some.items()}), base):
            yield n, done[n], slot, base + release, base + deadline, before
            done[n] += 1
            left[n] -= 1
            before += block - (0 if left[n] else lacks.get(n, 0))
            if not left[n]:  # a phase ends with the slot in which some source gives its last block
                del left[n]
                break
        base = slot + 1


def slots(spark: SparkSession, blocks: Mapping, weights: Mapping, lacks: Mapping, block: int) -> DataFrame:
    """The plan as rows (s, b, slot, release, deadline, before), made by one task."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = plan(blocks, weights, lacks, block)
            while some := list(islice(rows, SLOT_ROWS)):
                s, *numbers = zip(*some)
                yield pa.RecordBatch.from_arrays([pa.array([None if n is None else str(n) for n in s], pa.string()), *[pa.array(x, pa.int64()) for x in numbers]], ["s", "b", "slot", "release", "deadline", "before"])

    return materialise(spark.range(0, 1, 1, 1).mapInArrow(run, "s string, b long, slot long, release long, deadline long, before long"), "mix-slots")


def ranked(docs: DataFrame, source: str, key: str, seed: int, carry: bool) -> DataFrame:
    """doc_id, source, and the document's number in its source, in an order of a hash; ``carry`` keeps the whole row.

    A source is cut into about sqrt(rows) buckets of the hash; numbers are the rows in earlier buckets plus the
    place in the bucket, so no task holds a whole source."""
    rows = docs.select(F.col(key).alias("doc_id"), F.col(source).alias("source"), F.xxhash64(F.col(key), F.lit(seed)).alias("h"), F.xxhash64(*[F.col(c) for c in docs.columns if c != key]).alias("tie"), *([F.struct(*docs.columns).alias("row")] if carry else []))
    total = docs.count()
    buckets = max(1, math.isqrt(total))
    rows = materialise(rows.withColumn("bucket", F.pmod("h", F.lit(buckets))), "mix-rows")
    sizes = rows.groupBy("source", "bucket").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select(F.col("source").alias("s"), F.col("bucket").alias("b"), F.coalesce(before, F.lit(0)).alias("start"))
    place = F.row_number().over(Window.partitionBy("source", "bucket").orderBy("h", "doc_id", "tie")) - 1
    local = rows.withColumn("place", place)
    return local.join(starts, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b"))).select("doc_id", "source", (F.col("start") + F.col("place")).cast("long").alias("number"), *(["row"] if carry else []))


def mix(docs: DataFrame, weights: Mapping | None = None, source: str = "source", key: str = "doc_id", block: int | None = None, power: float = 0.5, seed: int = 7, carry: bool = False) -> DataFrame:
    """Per document: source, number in it, block, slot, release, deadline and mix_position (unique, 0 up).

    weights: targets by source, of any sum; by default the rows of the source to the ``power``.  carry: adds the
    whole row as the struct ``row``."""
    spark = docs.sparkSession
    counts = {r[0]: r[1] for r in docs.groupBy(F.col(source).alias("source")).count().toLocalIterator()}  # a row for each source
    block = block or max(BLOCK, -(-sum(counts.values()) // SLOTS))
    given = dict(weights) if weights else {n: c**power for n, c in counts.items()}
    mean = sum(given.values()) / len(given) if given else 1.0
    target = {n: given.get(n, mean) for n in counts}
    blocks = {n: -(-c // block) for n, c in counts.items()}
    table = slots(spark, blocks, target, {n: blocks[n] * block - c for n, c in counts.items()}, block)
    rows = ranked(docs, source, key, seed, carry).withColumn("block", F.floor(F.col("number") / block).cast("long"))
    out = rows.join(sized(table, sum(blocks.values())), F.col("source").cast("string").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b")))
    return out.withColumn("mix_position", F.col("before") + F.col("number") % block).select("doc_id", "source", "number", "block", "slot", "release", "deadline", "mix_position", *(["row"] if carry else []))
