"""Block-wise order operators against plain Python, with groups from one row to all rows."""

from __future__ import annotations

import datetime as dt
import random

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from ledgerloom.operators import ordered


def _hot_rows(n=600, seed=3):
    rnd = random.Random(seed)
    # one key holds most rows; positions are shuffled
    rows = [("hot" if rnd.random() < 0.7 else f"k{rnd.randrange(40)}", i, rnd.choice([None, -2, 0, 5, 7])) for i in range(n)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("blocks", [1, 2, 7, 64])
def test_running_total_of_a_hot_key(frame, blocks):
    rows = _hot_rows()
    df = frame("k string, pos int, v int", rows)
    got = ordered.running_total(ordered.quantile_blocks(df, ["pos"], blocks), ["k"], ["pos"], {"run": F.col("v")}, "bigint")
    want = pd.DataFrame(rows, columns=["k", "pos", "v"]).sort_values("pos")
    want["run"] = want.v.fillna(0).groupby(want.k).cumsum()
    assert {r.pos: r.run for r in got.collect()} == dict(zip(want.pos, want.run.astype(int)))


def test_row_numbers_when_the_first_order_column_is_constant(frame):
    df = frame("k string, seq int, pos int", [("a", 1, i) for i in range(300)])
    blocked = ordered.quantile_blocks(df, ["seq", "pos"], 16)
    sizes = [r["count"] for r in blocked.groupBy(ordered.BLOCK).count().collect()]
    assert len(sizes) > 8 and max(sizes) < 60
    got = ordered.row_numbers(blocked, ["k"], ["seq", "pos"], "n")
    assert all(r.n == r.pos + 1 for r in got.collect())


def test_blocks_follow_text_and_date_orders(frame):
    rows = [(dt.date(2024, 1, 1 + i % 3), f"doc{i:04d}", None if i % 50 == 0 else i * 0.5) for i in range(200)]
    df = frame("d date, t string, x double", rows)
    for order in (["d", "t"], ["t"], ["x", "t"]):
        blocked = ordered.quantile_blocks(df, order, 10).orderBy(*order).collect()
        numbers = [r[ordered.BLOCK] for r in blocked]
        assert numbers == sorted(numbers) and len(set(numbers)) >= 7


def test_empty_frames_and_wall_clock_orders(frame):
    empty = frame("k string, pos int, v int", [])
    assert ordered.row_numbers(ordered.quantile_blocks(empty, ["pos"]), ["k"], ["pos"], "n").count() == 0
    rows = [(dt.datetime(2024, 1, 1) + dt.timedelta(minutes=37 * i, microseconds=i), i) for i in range(100)]
    blocked = ordered.quantile_blocks(frame("ts timestamp_ntz, pos int", rows), ["ts"], 10).orderBy("pos").collect()
    numbers = [r[ordered.BLOCK] for r in blocked]
    assert numbers == sorted(numbers) and len(set(numbers)) == 10


def test_null_keys_keep_their_rows(frame):
    df = frame("k string, pos int", [(None, 2), (None, 1), ("a", 3)])
    got = ordered.row_numbers(ordered.position_blocks(df, "pos", 2), ["k"], ["pos"], "n")
    assert sorted((r.pos, r.n) for r in got.collect()) == [(1, 1), (2, 2), (3, 1)]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.sampled_from("abc")), min_size=1, max_size=40), st.integers(1, 9))
def test_forward_fill_equals_pandas(frame, values, size):
    rows = [("f", i, v) for i, v in enumerate(values)] + [("g", i, v) for i, v in enumerate(values[1:])]
    df = ordered.position_blocks(frame("source_file string, line_no int, c string", rows), "line_no", size)
    got = ordered.forward_fill(df, ["c"], ["source_file"], ["line_no"])
    want = pd.DataFrame(rows, columns=["f", "n", "c"])
    want["c"] = want.groupby("f").c.ffill()
    expected = {(f, n): (None if pd.isna(c) else c) for f, n, c in want.itertuples(index=False)}
    assert {(r.source_file, r.line_no): r.c for r in got.collect()} == expected


def test_skip_leading_rows(frame):
    df = frame("f string, n int", [("a", i) for i in (5, 7, 9)] + [("b", 1)])
    got = ordered.skip_leading_rows(df, 2, ["f"], ["n"])
    assert [(r.f, r.n) for r in got.collect()] == [("a", 9)]


def test_first_per_key(frame):
    df = frame("k string, n int", [("a", 2), ("a", 1), ("b", 3)])
    assert sorted((r.k, r.n) for r in ordered.first_per_key(df, ["k"], ["n"]).collect()) == [("a", 1), ("b", 3)]


def test_ordered_text_goes_on_in_parts_without_loss(frame):
    words = [f"word{i:03d}" for i in range(200)]
    rows = [("hot", i, w) for i, w in enumerate(words)] + [("cold", 0, "x")]
    random.Random(1).shuffle(rows)
    blocked = ordered.quantile_blocks(frame("k string, n int, w string", rows), ["n"], 8)
    got = ordered.ordered_text(blocked, ["k"], ["n"], "w", ",", "t", part_chars=100).collect()
    parts = sorted((r.part_no, r.t) for r in got if r.k == "hot")
    assert ",".join(t for _, t in parts) == ",".join(words)
    assert len(parts) > 10 and max(len(t) for _, t in parts) < 120
    assert [(r.part_no, r.t) for r in got if r.k == "cold"] == [(0, "x")]


def test_no_window_runs_over_a_whole_key(frame):
    """Rows are only ever windowed by (key, block); over the key alone go block summaries."""
    df = frame("k string, pos int, v int", _hot_rows(50))
    got = ordered.running_total(ordered.quantile_blocks(df, ["pos"], 4), ["k"], ["pos"], {"run": F.col("v")}, "bigint")
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.split("\n") if "Window [" in line]
    assert len(windows) == 2
    assert any(ordered.BLOCK in w.split("], [")[1] for w in windows)
