"""Watermark semantics across two micro-batch runs of one streaming query."""

import datetime as dt
import os
import tempfile


from quarry.streaming import live


def _write(spark, root, name, rows):
    df = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    df.coalesce(1).write.mode("append").parquet(os.path.join(root, "events.parquet"))


def test_late_rows_dropped_and_open_window_withheld(spark):
    root = tempfile.mkdtemp(prefix="quarry-stream-test-")
    t = lambda h, m: dt.datetime(2024, 1, 1, h, m)
    _write(spark, root, "a", [(1, t(9, 5), 1, "view", 1.0, "{}"), (2, t(9, 50), 1, "view", 2.0, "{}"),
                              (3, t(10, 30), 1, "view", 4.0, "{}"), (4, t(11, 30), 1, "view", 8.0, "{}")])
    out = os.path.join(root, "sink")
    q = live.tumbling_mean(live.event_stream(spark, root), "1 hour", ["event_type"], "value")
    first = {r["window_start"]: r["n"] for r in live.run_append(q, "late", out).collect()}
    # watermark after run 1 = 11:30 - 10 min = 11:20: windows [9,10) and [10,11) are final
    assert first == {t(9, 0): 2, t(10, 0): 1}
    _write(spark, root, "b", [(5, t(9, 10), 1, "view", 16.0, "{}"), (6, t(11, 45), 1, "view", 32.0, "{}")])
    q2 = live.tumbling_mean(live.event_stream(spark, root), "1 hour", ["event_type"], "value")
    second = {r["window_start"]: (r["n"], r["mean_value"]) for r in live.run_append(q2, "late", out).collect()}
    # the 09:10 row is later than the watermark: dropped; [11,12) is still open (watermark 11:35)
    assert second == {t(9, 0): (2, 1.5), t(10, 0): (1, 4.0)}


def _batches(spark, root, parts):
    """One file a micro-batch, in order of their modification times."""
    for i, rows in enumerate(parts):
        _write(spark, root, str(i), rows)
        for base, _, files in os.walk(os.path.join(root, "events.parquet")):
            for f in files:
                full = os.path.join(base, f)
                if os.path.getmtime(full) > 2_000_000_000 or f.startswith((".", "_")):
                    continue
                if full not in _batches.seen:
                    _batches.seen.add(full)
                    os.utime(full, (1_000_000_000 + 100 * i, 1_000_000_000 + 100 * i))


_batches.seen = set()


def _events(times, first):
    return [(first + i, t, i % 2, "view", float(first + i), "{}") for i, t in enumerate(times)]


def test_closed_windows_equal_batch_and_leave_the_state(spark):
    root = tempfile.mkdtemp(prefix="quarry-stream-test-")
    t = lambda h, m: dt.datetime(2024, 1, 1, h, m)
    parts = [_events([t(9, 5), t(9, 50), t(9, 58)], 1),
             _events([t(9, 55), t(10, 30), t(10, 41)], 10),    # 9:55 is late, but within the watermark (9:48)
             _events([t(10, 35), t(12, 10), t(12, 10)], 20),   # 10:35 too (10:31)
             _events([t(9, 10), t(12, 25)], 30)]               # 9:10 is too late: every window of it ended by 10:31
    _batches(spark, root, parts)
    kept = [r for p in parts for r in p if r[0] != 30]

    def run(tag, plan):
        out = os.path.join(root, tag)
        res = live.run_closed(live.event_stream(spark, root, files_per_batch=1), plan, tag, out)
        assert len([f for f in os.listdir(os.path.join(out, "_checkpoint", "commits")) if f.isdigit()]) >= 5
        state = spark.read.format("statestore").load(os.path.join(out, "_checkpoint"))
        return res.collect(), state.count()

    hour = lambda x: x.replace(minute=0)
    rows, left = run("tumbling", lambda e: live.tumbling_mean(e, "1 hour", ["event_type"], "value"))
    want = {}
    for r in kept:
        want.setdefault(hour(r[1]), []).append(r[4])
    assert {(r.window_start, r.n, r.mean_value) for r in rows} == {(h, len(v), sum(v) / len(v)) for h, v in want.items()}
    assert len(rows) == len(want) and left == 1  # the marker's window

    rows, left = run("sliding", lambda e: live.sliding_count(e, "1 hour", "15 minutes", ["event_type"]))
    want = {}
    for r in kept:
        q = r[1].replace(minute=r[1].minute // 15 * 15)
        for k in range(4):
            want[q - dt.timedelta(minutes=15 * k)] = want.get(q - dt.timedelta(minutes=15 * k), 0) + 1
    assert {r.window_start: r.n for r in rows} == want and len(rows) == len(want) and left == 4

    rows, left = run("sessions", lambda e: live.sessions(e, "10 minutes", ["user_id"]))
    want = []
    for u in (0, 1):
        times = sorted((r[1], r[4]) for r in kept if r[2] == u)
        for at, v in times:
            if want and want[-1][0] == u and at - want[-1][2] < dt.timedelta(minutes=10):
                want[-1][2], want[-1][3], want[-1][4] = at, want[-1][3] + 1, want[-1][4] + v
            else:
                want.append([u, at, at, 1, v])
    got = sorted((r.user_id, r.session_start, r.session_end, r.n_events, r.total) for r in rows)
    assert got == sorted((u, a, b + dt.timedelta(minutes=10), n, v) for u, a, b, n, v in want)
    assert left == 1
