"""Keyed state with timers: marks out of order, an open mark that is given up, late rows dropped and counted."""

from datetime import datetime, timedelta

from strandgraph.streaming import pairing

T0 = datetime(2024, 1, 1)


def marks(spark, rows):
    """(arrival, user, hours, event, opens)"""
    return spark.createDataFrame([(a, u, T0 + timedelta(hours=h), e, int(h // 24), o) for a, u, h, e, o in rows], "arrival int, user_id long, ts timestamp, event_id long, line long, opens boolean")


def test_order_patience_and_late_rows(spark):
    rows = [
        (0, 1, 10, 101, False), (0, 1, 5, 100, True),  # out of order inside a trigger
        (0, 2, 20, 200, True), (1, 2, 1, 199, False),  # out of order across triggers, within the watermark
        (0, 3, 2, 300, True), (1, 4, 100, 400, True),  # the open mark of 3 is given up when 4 moves the time on
        (2, 3, 99, 301, False),  # and so its end pairs with nothing
        (3, 5, 10, 500, False),  # behind the watermark that the trigger before began with: dropped
        (2, 4, 101, 401, True), (2, 2, 110, 201, False),
    ]
    df = marks(spark, rows)
    found, triggers, dropped = pairing.run(df, 4, late="1 day", patience_days=2, order="arrival")
    assert sorted(map(tuple, found.collect())) == [(1, 100, "paired", False), (2, 199, "close", False), (2, 200, "open", False), (2, 201, "close", False), (3, 300, "open", False), (3, 301, "close", False), (4, 400, "open", False), (4, 401, "open", False)]
    assert triggers >= 5 and dropped == 1
