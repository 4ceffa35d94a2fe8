"""Queries over ordered ranges, on the event stream's tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import buckets, ordered, ranges
from ..sources import store
from ..sources.tables import table
from ..streaming import pairing
from .registry import query

_E = "(SELECT event_id, user_id, event_type, value, CAST(floor(epoch(ts)) AS BIGINT) AS sec, CAST(floor(epoch(ts) / 86400) AS BIGINT) AS day FROM events)"
_SESSIONS = f"""(SELECT user_id, session, min(sec) AS lo, max(sec) AS hi, count(*) AS n FROM (SELECT *, CAST(sum(new) OVER (PARTITION BY user_id ORDER BY sec, event_id) AS BIGINT) AS session FROM
 (SELECT *, CASE WHEN sec - lag(sec) OVER (PARTITION BY user_id ORDER BY sec, event_id) <= 21600 THEN 0 ELSE 1 END AS new FROM {_E})) GROUP BY user_id, session)"""


def events(spark, sf_dir):
    at = F.col("ts").cast("timestamp").cast("double")
    return table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", F.floor(at).alias("sec"), F.floor(at / 86400).alias("day"))


def sessions(spark, sf_dir):
    tagged = ranges.sessions(events(spark, sf_dir), "user_id", "sec", ["sec", "event_id"], 21600)
    return tagged.groupBy("user_id", "session").agg(F.min("sec").alias("lo"), F.max("sec").alias("hi"), F.count("*").alias("n"))


_PAIR = f"""SELECT event_id, state, coalesce(state = 'paired' AND nline <> day, false) AS crosses FROM (SELECT *, CASE WHEN op AND nop = false AND (nline = day OR nfirst) THEN 'paired' WHEN op THEN 'open'
 WHEN NOT coalesce(lop AND (lline = day OR fst), false) THEN 'close' END AS state FROM (SELECT *, lead(op) OVER w AS nop, lag(op) OVER w AS lop, lead(day) OVER w AS nline, lag(day) OVER w AS lline, lead(fst) OVER w AS nfirst FROM
 (SELECT *, event_type = 'view' AS op, row_number() OVER (PARTITION BY user_id, day ORDER BY sec, event_id) = 1 AS fst FROM {_E} WHERE event_type IN ('view', 'click')) WINDOW w AS (PARTITION BY user_id ORDER BY sec, event_id))) WHERE state IS NOT NULL"""


@query(_PAIR)
def range_pairing(spark, sf_dir):
    marks = events(spark, sf_dir).where("event_type IN ('view', 'click')")
    paired = ranges.pair_ranges(marks, ["user_id"], "day", ["sec", "event_id"], F.col("event_type") == "view")
    return paired.select("event_id", "state", F.coalesce("crosses", F.lit(False)).alias("crosses"))


@query(f"""SELECT user_id, session, lo, hi, greatest(0, hi2 - lo2 + 1) AS width FROM (SELECT *, lo + CASE WHEN n % 2 = 0 THEN 1 ELSE 0 END AS lo2, hi - CASE WHEN n % 3 = 0 THEN 1 ELSE 0 END AS hi2 FROM {_SESSIONS} WHERE lo < hi)""")
def range_coverage(spark, sf_dir):
    s = sessions(spark, sf_dir).where("lo < hi")
    _, _, width = ranges.coverage(F.col("lo"), F.col("hi"), F.col("n") % 2 == 0, F.col("n") % 3 == 0)
    return s.select("user_id", "session", "lo", "hi", width.alias("width"))


@query(f"""SELECT day, point, CAST(sum(d) OVER (PARTITION BY day ORDER BY point) AS BIGINT) AS active FROM (SELECT day, point, sum(d) AS d FROM (SELECT lo // 86400 AS day, lo AS point, 1 AS d FROM {_SESSIONS} UNION ALL SELECT lo // 86400, hi + 1, -1 FROM {_SESSIONS}) GROUP BY day, point)""")
def range_flags(spark, sf_dir):
    s = sessions(spark, sf_dir).withColumn("day", F.floor(F.col("lo") / 86400))
    return ranges.active_counts(s, ["day"], "lo", "hi")


@query(f"SELECT s.user_id, s.session, e.event_id FROM {_SESSIONS} s JOIN {_E} e ON e.user_id = s.user_id AND e.sec BETWEEN s.lo AND s.hi WHERE e.event_type = 'purchase'")
def containment_down(spark, sf_dir):
    inner = events(spark, sf_dir).where("event_type = 'purchase'").select("user_id", "event_id", F.col("sec").alias("p_lo"), F.col("sec").alias("p_hi"))
    return ranges.contained(sessions(spark, sf_dir), inner, "user_id").select("user_id", "session", "event_id")


@query(f"SELECT e.event_id, min(s.session) AS session, max(s.n) AS n FROM {_E} e JOIN {_SESSIONS} s ON e.user_id = s.user_id AND e.sec BETWEEN s.lo AND s.hi WHERE e.event_type = 'error' GROUP BY e.event_id")
def containment_up(spark, sf_dir):
    inner = events(spark, sf_dir).where("event_type = 'error'").select("user_id", "event_id", F.col("sec").alias("p_lo"), F.col("sec").alias("p_hi"))
    return ranges.contained(sessions(spark, sf_dir), inner, "user_id").groupBy("event_id").agg(F.min("session").alias("session"), F.max("n").alias("n"))


@query(f"SELECT event_id, CASE WHEN last_type IS NULL THEN 'none' ELSE last_type END AS scope FROM (SELECT event_id, event_type, last_value(CASE WHEN event_type IN ('view', 'signup') THEN event_type END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY sec, event_id ROWS UNBOUNDED PRECEDING) AS last_type FROM {_E})")
def scope_forward_fill(spark, sf_dir):
    mark = F.when(F.col("event_type").isin("view", "signup"), F.col("event_type"))
    return events(spark, sf_dir).select("event_id", F.coalesce(ranges.fill_forward(mark, ["user_id"], ["sec", "event_id"]), F.lit("none")).alias("scope"))


@query(f"SELECT event_id, click FROM (SELECT event_id, event_type, last_value(CASE WHEN event_type = 'click' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY sec, event_id ROWS UNBOUNDED PRECEDING) AS click FROM {_E}) WHERE event_type = 'purchase'")
def asof_latest(spark, sf_dir):
    click = F.when(F.col("event_type") == "click", F.col("event_id"))
    return events(spark, sf_dir).select("event_id", "event_type", ranges.fill_forward(click, ["user_id"], ["sec", "event_id"]).alias("click")).where("event_type = 'purchase'").drop("event_type")


@query(f"SELECT event_id, sec // 3600 AS hour, sec - (sec // 3600) * 3600 AS place FROM {_E}")
def interval_point(spark, sf_dir):
    hour = F.floor(F.col("sec") / 3600)
    return events(spark, sf_dir).select("event_id", hour.alias("hour"), (F.col("sec") - hour * 3600).alias("place"))


@query(f"WITH s AS (SELECT *, lo // 86400 AS day FROM {_SESSIONS}) SELECT a.day, count(*) AS pairs FROM s a JOIN s b ON a.day = b.day AND a.lo <= b.hi AND b.lo <= a.hi AND a.user_id < b.user_id GROUP BY a.day")
def interval_overlap(spark, sf_dir):
    """Pairs of a day that share a point, by a sweep: a start meets all that began before it and haven't ended.  Sessions
    of one user never overlap."""
    s = sessions(spark, sf_dir).withColumn("day", F.floor(F.col("lo") / 86400))
    starts = s.select("day", F.col("lo").alias("at"), F.lit(0).alias("side"), "user_id", F.lit(1).alias("d"))
    ends = s.select("day", F.col("hi").alias("at"), F.lit(1).alias("side"), "user_id", F.lit(-1).alias("d"))
    met = ordered.running_sum(starts.unionByName(ends), ["day"], ["at", "side", "user_id"], "d", "open")
    return met.where("side = 0").groupBy("day").agg(F.sum(F.col("open") - 1).alias("pairs")).where("pairs > 0")


@query(f"SELECT user_id, min(day) AS lo, max(day) AS hi, count(*) AS n FROM (SELECT user_id, day, day - row_number() OVER (PARTITION BY user_id ORDER BY day) AS g FROM (SELECT DISTINCT user_id, day FROM {_E})) GROUP BY user_id, g")
def islands(spark, sf_dir):
    return ranges.islands(events(spark, sf_dir), ["user_id"], "day")


@query(f"""SELECT user_id, min(lo) AS lo, max(hi) AS hi, count(*) AS n FROM (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY lo, hi ROWS UNBOUNDED PRECEDING) AS g FROM (SELECT *, CASE WHEN lo <= max(hi) OVER (PARTITION BY user_id ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1 THEN 0 ELSE 1 END AS s
 FROM (SELECT user_id, lo - 20000 AS lo, hi + 20000 AS hi FROM {_SESSIONS}))) GROUP BY user_id, g""")
def range_set_union(spark, sf_dir):
    wide = sessions(spark, sf_dir).select("user_id", (F.col("lo") - 20000).alias("lo"), (F.col("hi") + 20000).alias("hi"))
    return ranges.union_ranges(wide, ["user_id"], "lo", "hi")


@query(f"SELECT user_id, event_id, coalesce(max(hi) OVER (PARTITION BY user_id ORDER BY lo, hi DESC, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) >= hi, false) AS nested FROM (SELECT user_id, event_id, sec AS lo, sec + CAST(floor(value * 1000) AS BIGINT) AS hi FROM {_E} WHERE value IS NOT NULL)")
def nested_running_max(spark, sf_dir):
    r = events(spark, sf_dir).where("value IS NOT NULL").select("user_id", "event_id", F.col("sec").alias("lo"), (F.col("sec") + F.floor(F.col("value") * 1000)).alias("hi"))
    return ranges.nested(r, ["user_id"], "lo", "hi", "event_id").select("user_id", "event_id", "nested")


@query(f"SELECT event_id, coalesce(last_value(a IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY sec, event_id ROWS UNBOUNDED PRECEDING), first_value(a IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY sec, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS anchor FROM (SELECT *, CASE WHEN event_type = 'purchase' THEN event_id END AS a FROM {_E})")
def forward_backward_anchor(spark, sf_dir):
    a = F.when(F.col("event_type") == "purchase", F.col("event_id"))
    return events(spark, sf_dir).select("event_id", ranges.anchor(a, ["user_id"], ["sec", "event_id"]).alias("anchor"))


@query(f"SELECT event_type, sec // 3600 AS hour, count(*) AS n, count(DISTINCT user_id) AS users FROM {_E} GROUP BY event_type, hour")
def stream_tumbling(spark, sf_dir):
    """The batch form of streaming.events.tumbling."""
    return events(spark, sf_dir).groupBy("event_type", F.floor(F.col("sec") / 3600).alias("hour")).agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("users"))


@query(f"SELECT user_id, lo, hi, n FROM {_SESSIONS}")
def stream_session(spark, sf_dir):
    return sessions(spark, sf_dir).drop("session")


@query(f"SELECT user_id, event_type, day, min(event_id) AS event_id FROM {_E} GROUP BY user_id, event_type, day")
def stream_dedup(spark, sf_dir):
    return events(spark, sf_dir).groupBy("user_id", "event_type", "day").agg(F.min("event_id").alias("event_id"))


@query(f"""WITH r AS (SELECT user_id, event_id, sec AS lo, sec + CAST(floor(value * 1000) AS BIGINT) AS hi FROM {_E} WHERE value IS NOT NULL), p AS (SELECT user_id, event_id, sec + 3000 AS p_lo, sec + 3000 + event_id % 5 * 100 AS p_hi FROM {_E})
SELECT p.user_id, p.event_id, r.event_id AS holder FROM p LEFT JOIN r ON r.user_id = p.user_id AND lo <= p_lo AND p_hi <= hi QUALIFY row_number() OVER (PARTITION BY p.event_id ORDER BY hi - lo, lo DESC, r.event_id) = 1""")
def innermost_container(spark, sf_dir):
    """The narrowest of nested and overlapping ranges that holds each place."""
    e = events(spark, sf_dir)
    held = e.where("value IS NOT NULL").select("user_id", "event_id", F.col("sec").alias("lo"), (F.col("sec") + F.floor(F.col("value") * 1000)).alias("hi"))
    places = e.select("user_id", "event_id", (F.col("sec") + 3000).alias("p_lo"), (F.col("sec") + 3000 + F.col("event_id") % 5 * 100).alias("p_hi"))
    return buckets.innermost(held, places, "user_id", "event_id")


_OPEN = f"""WITH s AS (SELECT user_id, event_id, event_type, CAST(row_number() OVER (PARTITION BY user_id ORDER BY sec, event_id) AS BIGINT) AS slot, 1 + event_id % 4 AS length, count(*) OVER (PARTITION BY user_id) AS total FROM {_E}),
r AS (SELECT event_id, user_id, CASE WHEN event_id % 5 > 0 THEN slot END AS a, event_id % 6 AS ao, CASE WHEN event_id % 7 > 0 THEN greatest(1, least(slot + event_id % 4 - 1, total)) END AS b, event_id % 3 AS bo, event_id % 5 = 0 AND event_id % 2 = 0 AS late, total FROM s WHERE event_type IN ('error', 'click')),
c AS (SELECT r.*, l.length, unnest(range(least(coalesce(a, 1), coalesce(b, r.total)), greatest(coalesce(a, 1), coalesce(b, r.total)) + 1)) AS spot FROM r LEFT JOIN s l ON l.user_id = r.user_id AND l.slot = r.a),
k AS (SELECT *, CASE WHEN coalesce(a, 1) = coalesce(b, total) AND a IS NOT DISTINCT FROM b THEN ao < bo ELSE NOT (coalesce(spot = a, false) AND ao >= length) AND NOT (coalesce(spot = b, false) AND bo <= 0) END AS kept FROM c)"""


@query(f"""{_OPEN} SELECT event_id, min(spot) FILTER (WHERE kept) AS lo, max(spot) FILTER (WHERE kept) AS hi, count(*) FILTER (WHERE kept) AS width, CASE WHEN count(*) FILTER (WHERE kept) = 0 THEN coalesce(any_value(a), any_value(b), 1) END AS anchor,
 CASE WHEN any_value(late) THEN 0 ELSE count(*) FILTER (WHERE kept) END AS strict_width, count(*) FILTER (WHERE kept) > 0 AND any_value(late) AS differs FROM k GROUP BY event_id""")
def range_coverage_open(spark, sf_dir):
    """Coverage of ranges with unknown ends in both modes, and where they differ; the SQL lists every slot."""
    w = Window.partitionBy("user_id")
    s = events(spark, sf_dir).select("user_id", "event_id", "event_type", F.row_number().over(w.orderBy("sec", "event_id")).cast("long").alias("slot"), (1 + F.col("event_id") % 4).alias("length"), F.count("*").over(w).alias("total"))
    n = F.col("event_id")
    end = F.greatest(F.lit(1), F.least(F.col("slot") + n % 4 - 1, F.col("total")))
    r = s.where("event_type IN ('error', 'click')").select("event_id", "user_id", F.when(n % 5 > 0, F.col("slot")).alias("start_sign"), (n % 6).alias("start_offset"), F.when(n % 7 > 0, end).alias("end_sign"), (n % 3).alias("end_offset"), F.when((n % 5 == 0) & (n % 2 == 0), "close").otherwise("none").alias("orphan"))
    parity, strict = (ranges.open_coverage(r, s.select("user_id", "slot", "length"), "user_id", x) for x in (False, True))
    both = parity.join(strict.select(F.col("event_id").alias("_e"), F.col("width").alias("strict_width")), F.col("event_id") == F.col("_e"))
    return both.select("event_id", "lo", "hi", "width", "anchor", "strict_width", (F.col("width") != F.col("strict_width")).alias("differs"))


@query(f"SELECT event_id, state, crosses FROM ({_PAIR})")
def stream_pairing(spark, sf_dir):
    """Range pairing as a stream of three triggers with keyed state and timers."""
    marks = table(spark, sf_dir, "events").where("event_type IN ('view', 'click')")
    at = F.date_trunc("second", F.col("ts").cast("timestamp"))
    found, _, _ = pairing.run(marks.select("user_id", at.alias("ts"), "event_id", F.unix_date(F.to_date("ts")).cast("long").alias("line"), (F.col("event_type") == "view").alias("opens")), 3)
    return found.select("event_id", "state", "crosses")


@query(f"SELECT s.user_id, s.session, e.event_id FROM {_SESSIONS} s JOIN {_E} e ON e.user_id = s.user_id AND e.sec BETWEEN s.lo AND s.hi WHERE e.event_type = 'click'")
def graph_store(spark, sf_dir):
    """Sessions and the clicks in them, from a store of both that is partitioned by type and bucketed by user."""
    words = sessions(spark, sf_dir).select(F.lit("session").alias("otype"), F.col("user_id").alias("doc"), F.col("session").cast("long").alias("node"), F.col("lo").cast("long").alias("lo"), F.col("hi").cast("long").alias("hi"))
    signs = events(spark, sf_dir).select(F.col("event_type").alias("otype"), F.col("user_id").alias("doc"), F.col("event_id").alias("node"), F.col("sec").cast("long").alias("lo"), F.col("sec").cast("long").alias("hi"))
    name = store.save(words.unionByName(signs))
    inner = store.nodes_of(spark, name, "click").select(F.col("doc").alias("d"), F.col("node").alias("event_id"), F.col("lo").alias("at"))
    held = store.nodes_of(spark, name, "session").join(inner, (F.col("doc") == F.col("d")) & F.col("at").between(F.col("lo"), F.col("hi")))
    return held.select(F.col("doc").alias("user_id"), F.col("node").alias("session"), "event_id")
