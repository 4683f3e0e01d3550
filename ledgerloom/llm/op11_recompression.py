"""Periodic runs in texts, found through recompression.

A run is a stretch of consecutive words with smallest period q that no neighbouring word extends and that is at least LEAST words and TIMES periods
long. For each q the word positions are sampled on a harmonic grid: a run's matching places (word = word q further on) are long enough to hold two
neighbouring grid points, so places where both match are the candidates. The texts that hold candidates are compressed by alternating block
compression (repeats of one symbol become one) and pair compression (the alphabet is parted in two, a left symbol with the right one behind it becomes one)
into a run-length grammar, until no symbol occurs twice. A longest common extension climbs the grammar while both places begin a symbol of the next level,
and descends where the symbols differ: at most one symbol or block per level, forwards and backwards. Extending a candidate
exactly gives the whole run; the smallest period of a stretch is the one reported.

All of it is done for many texts side by side in numpy; texts are parted by symbols that occur once, so no extension leaves its text. A text is
one value of one row and is never cut.

Defined results: null and empty texts and texts of fewer than LEAST words have no runs; the words of a text are parted by blanks and the control
characters 9 to 13 only; repeated rows are rows of their own; an empty table gives no rows; other columns are kept by `with_runs` and not read; a
null doc_id is planted nothing by the query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import body, read, small_batches, travels_by_value

LEAST = 24
TIMES = 3
_WORDS = 400_000  # words handled side by side
_POINTS = 400_000  # grid points looked at side by side
_RUN = "struct<start: bigint, length: bigint, period: bigint>"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().split()  # of bytes, split() parts at blanks and characters 9 to 13


class Grammar:
    """Run-length grammar of a sequence of numbers whose first and last occur once; level 0 is the sequence, each further one a compression of the one before."""

    def __init__(self, sequence: np.ndarray):
        symbols = sequence.astype(np.int64)
        self.symbols, self.starts, self.parents, self.blocks = [symbols], [np.empty(0, np.int64)], [], [False]
        fresh, turn = int(symbols.max()) + 1, 0
        while len(pd.unique(symbols)) < len(symbols):
            turn += 1
            fresh = self._compress_blocks(fresh) if turn % 2 else self._compress_pairs(fresh, turn)
            symbols = self.symbols[-1]

    def _add(self, firsts: np.ndarray, keys: np.ndarray, merged: np.ndarray, fresh: int, block: bool) -> int:
        """A level whose symbols begin at firsts; the merged ones get new numbers by their keys."""
        below = self.symbols[-1]
        above = below[firsts]
        codes, distinct = pd.factorize(keys)
        above[merged] = fresh + codes
        begins = np.zeros(len(below), np.int64)
        begins[firsts] = 1
        self.parents.append(np.cumsum(begins) - 1)
        self.symbols.append(above)
        self.starts.append(np.append(firsts, len(below)))
        self.blocks.append(block)
        return fresh + len(distinct)

    def _compress_blocks(self, fresh: int) -> int:
        below = self.symbols[-1]
        firsts = np.flatnonzero(np.append(True, below[1:] != below[:-1]))
        sizes = np.diff(np.append(firsts, len(below)))
        merged = sizes > 1
        if not merged.any():
            return fresh
        return self._add(firsts, below[firsts[merged]] * (len(below) + 1) + sizes[merged], merged, fresh, True)

    def _compress_pairs(self, fresh: int, turn: int) -> int:
        below = self.symbols[-1]
        while True:
            mixed = (below + turn).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
            left = (mixed * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(40)) & np.uint64(1) == 1
            pairs, others = left[:-1] & ~left[1:], ~left[:-1] & left[1:]
            pairs = pairs if pairs.sum() >= others.sum() else others
            if pairs.any():
                break
            turn += 1_000_003  # a parting of the alphabet that leaves all pairs as they are
        inner = np.append(False, pairs)
        firsts = np.flatnonzero(~inner)
        merged = np.append(pairs, False)[firsts]
        begin = firsts[merged]
        return self._add(firsts, below[begin] * fresh + below[begin + 1], merged, fresh, False)

    def extensions(self, i: np.ndarray, j: np.ndarray, forward: bool) -> np.ndarray:
        """How many symbols from places i and j on (backwards: down from them) are the same; i and j differ."""
        way, top = (1 if forward else -1), len(self.symbols) - 1
        p, q = i.astype(np.int64), j.astype(np.int64)
        stop = np.full(len(p), top)
        climbing = np.arange(len(p))
        for level in range(top):
            a, b = p[climbing], q[climbing]
            starts, parents, symbols = self.starts[level + 1], self.parents[level], self.symbols[level]
            above_a, above_b = parents[a], parents[b]
            left_a, left_b = self._left(starts, above_a, a, forward), self._left(starts, above_b, b, forward)
            whole = (left_a == starts[above_a + 1] - starts[above_a]) & (left_b == starts[above_b + 1] - starts[above_b])
            same = symbols[a] == symbols[b]
            taken = np.where(whole | ~same, 0, np.minimum(left_a, left_b))
            ended = ~whole & (~same | (left_a != left_b)) if self.blocks[level + 1] else ~whole & ~same
            if not self.blocks[level + 1]:
                taken = np.minimum(taken, 1)
            p[climbing], q[climbing] = a + way * taken, b + way * taken
            stop[climbing[ended]] = level
            climbing = climbing[~ended]
            p[climbing], q[climbing] = parents[p[climbing]], parents[q[climbing]]
        for level in range(top, 0, -1):
            falling = np.flatnonzero(stop >= level)
            starts, symbols = self.starts[level], self.symbols[level - 1]
            above_a, above_b = p[falling], q[falling]
            a, b = (starts[above_a], starts[above_b]) if forward else (starts[above_a + 1] - 1, starts[above_b + 1] - 1)
            taken = np.minimum(starts[above_a + 1] - starts[above_a], starts[above_b + 1] - starts[above_b]) if self.blocks[level] else 1
            taken = np.where(symbols[a] == symbols[b], taken, 0)
            p[falling], q[falling] = a + way * taken, b + way * taken
        return way * (p - i)

    @staticmethod
    def _left(starts: np.ndarray, above: np.ndarray, at: np.ndarray, forward: bool) -> np.ndarray:
        return starts[above + 1] - at if forward else at - starts[above] + 1


def _candidates(ids: np.ndarray, text_no: np.ndarray, ends: np.ndarray, sizes: np.ndarray, least: int, times: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, period, grid step) where two neighbouring grid points match; the texts stand from long to short."""
    most = int(sizes[0]) // times if len(sizes) and sizes[0] >= least else 0
    periods = np.arange(1, most + 1)
    steps = np.maximum(least - periods, (times - 1) * periods) // 2
    texts = np.searchsorted(-sizes, -np.maximum(least, times * periods), side="right")  # so many are long enough
    points = np.maximum(ends[np.maximum(texts, 1) - 1] - periods - 1, 0) // steps
    points[texts == 0] = 0
    sums = np.cumsum(points)
    found = []
    at = 0
    while at < most:
        upto = max(int(np.searchsorted(sums, (sums[at - 1] if at else 0) + _POINTS, side="right")), at + 1)
        many = points[at:upto]
        q, g = np.repeat(periods[at:upto], many), np.repeat(steps[at:upto], many)
        x = (np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)) * g
        hit = np.flatnonzero(ids[x] == ids[x + q])
        x, q, g = x[hit], q[hit], g[hit]
        last = np.minimum(x + g + q, len(ids) - 1)
        hit = (ids[last - q] == ids[last]) & (text_no[x] == text_no[last]) & (last == x + g + q)
        found.append((x[hit], q[hit], g[hit]))
        at = upto
    if not found:
        return (np.empty(0, np.int64),) * 3
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))  # type: ignore[return-value]


def _extended(grammar: Grammar, x: np.ndarray, q: np.ndarray, g: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of the stretches around candidates; of candidates in a row that one stretch holds, the first is extended."""
    chain = np.cumsum(np.append(True, (q[1:] != q[:-1]) | (x[1:] != x[:-1] + g[1:]))) - 1 if len(x) else x
    out = []
    while len(x):
        first = np.append(True, chain[1:] != chain[:-1])
        a, p = x[first], q[first]
        ahead = grammar.extensions(a, a + p, True)
        behind = grammar.extensions(a - 1, a + p - 1, False)
        out.append((a - behind, a + ahead + p, p))
        reached = np.repeat(a + ahead, np.diff(np.append(np.flatnonzero(first), len(x))))
        on = x >= reached
        on &= ~first
        x, q, chain = x[on], q[on], chain[on]
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))  # type: ignore[return-value]


def find_runs(texts: list[list[bytes]], least: int = LEAST, times: int = TIMES) -> list[np.ndarray]:
    """For each text its runs as rows of (start, length, period), by start, then period."""
    none = np.empty((0, 3), np.int64)
    out = [none] * len(texts)
    long = sorted((k for k in range(len(texts)) if len(texts[k]) >= least), key=lambda k: -len(texts[k]))
    begin = 0
    while begin < len(long):
        end, words = begin, 0
        while end < len(long) and (end == begin or words + len(texts[long[end]]) <= _WORDS):
            words += len(texts[long[end]])
            end += 1
        _find(texts, long[begin:end], out, least, times)
        begin = end
    return out


def _sequence(ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts' words with a symbol that occurs once before each and behind the last; the texts' numbers; where their words begin."""
    text_no = np.repeat(np.arange(len(sizes)), sizes)
    begins = np.cumsum(sizes) - sizes + 1 + np.arange(len(sizes))
    top = int(ids.max()) + 1
    whole = np.full(len(ids) + len(sizes) + 1, -1, np.int64)
    places = np.arange(len(ids)) + text_no + 1
    whole[places] = ids
    number = np.full(len(whole), -1, np.int64)
    number[places] = text_no
    marks = np.flatnonzero(number < 0)
    whole[marks] = top + np.arange(len(marks))
    return whole, number, begins


def _find(texts: list[list[bytes]], chosen: list[int], out: list[np.ndarray], least: int, times: int) -> None:
    flat = pa.array([w for k in chosen for w in texts[k]], pa.binary())
    ids = flat.dictionary_encode().indices.to_numpy().astype(np.int64)
    sizes = np.array([len(texts[k]) for k in chosen])
    sequence, number, begins = _sequence(ids, sizes)
    x, q, g = _candidates(sequence, number, begins + sizes, sizes, least, times)
    if not len(x):
        return
    # the grammar is built for the texts that hold candidates
    holding = np.unique(number[x])
    kept = np.isin(np.repeat(np.arange(len(sizes)), sizes), holding)
    chosen = [chosen[k] for k in holding]
    moved = np.zeros(len(sizes), np.int64)
    old = begins[holding]
    sequence, _, begins = _sequence(ids[kept], sizes[holding])
    moved[holding] = begins - old
    x = x + moved[number[x]]
    start, stop, period = _extended(Grammar(sequence), x, q, g)
    run = stop - start >= np.maximum(least, times * period)
    start, stop, period = start[run], stop[run], period[run]
    order = np.lexsort((period, stop, start))
    start, stop, period = start[order], stop[order], period[order]
    fresh = np.append(True, (start[1:] != start[:-1]) | (stop[1:] != stop[:-1])) if len(start) else np.empty(0, bool)
    start, stop, period = start[fresh], stop[fresh], period[fresh]
    text = np.searchsorted(begins, start, side="right") - 1
    rows = np.stack([start - begins[text], stop - start, period], axis=1) if len(start) else np.empty((0, 3), np.int64)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 0], text))]
    cuts = np.searchsorted(np.sort(text), np.arange(len(chosen) + 1))
    for k, a, b in zip(chosen, cuts, cuts[1:], strict=False):
        out[k] = rows[a:b]


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words joined by blanks, without those that a run holds behind its first period."""
    if len(runs):
        change = np.zeros(len(words) + 1, np.int64)
        np.add.at(change, runs[:, 0] + runs[:, 2], 1)
        np.add.at(change, runs[:, 0] + runs[:, 1], -1)
        kept = np.cumsum(change[:-1]) == 0
        words = [w for w, k in zip(words, kept.tolist(), strict=True) if k]
    return b" ".join(words)


def runs_of(text: Column, least: int = LEAST, times: int = TIMES) -> Column:
    """struct of runs (start, length, period in words, by start, then period) and collapsed, the text's words without their repeats."""

    @F.arrow_udf(f"struct<runs: array<{_RUN}>, collapsed: string>")
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            texts = [words_of(t) for t in batch.to_pylist()]
            runs = find_runs(texts, least, times)
            rows = np.concatenate(runs) if runs else np.empty((0, 3), np.int64)
            offsets = np.cumsum([0, *map(len, runs)])
            spans = pa.StructArray.from_arrays([pa.array(rows[:, c]) for c in range(3)], ["start", "length", "period"])
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans)
            left = pa.array([collapsed(w, r) for w, r in zip(texts, runs, strict=True)], pa.binary()).cast(pa.string())
            yield pa.StructArray.from_arrays([lists, left], ["runs", "collapsed"])

    return found(text)


def with_runs(docs: DataFrame, text: str = "text", out: str = "periodic", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """docs with the column out: runs_of the text."""
    small_batches(docs.sparkSession)
    return docs.withColumn(out, runs_of(body(text), least, times))


def highest(runs: Column) -> Column:
    """The run with the greatest length / period, of equals the first; null without runs."""
    more = lambda best, r: F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best)
    return F.reduce(runs, F.lit(None).cast(_RUN), more)


def planted(text: Column, number: Column) -> Column:
    """The text with a repeat from one of its words on, as the number says; unchanged where it is null."""

    @F.arrow_udf("string")
    def plant(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, numbers in batches:
            out = []
            for t, g in zip(texts.to_pylist(), numbers.to_pylist(), strict=True):
                words = words_of(t) if g is not None else []
                if words:
                    n = len(words)
                    a = g % n
                    p = 1 + (n - a) // (3 + g % 8)
                    t = b" ".join(words[:a] + [words[a + i % p] for i in range(n - a)]).decode()
                out.append(t)
            yield pa.array(out, pa.string())

    return plant(text, number)


def op11_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    number = F.when(h % 10 == 0, F.floor(h / 10).cast("bigint"))
    found = with_runs(docs.select("doc_id", planted(body(), number).alias("text")))
    runs = found.select("doc_id", F.col("periodic.runs").alias("runs"), F.col("periodic.collapsed").alias("collapsed")).withColumn("best", highest(F.col("runs")))
    line = lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))
    return runs.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


travels_by_value(__name__)
