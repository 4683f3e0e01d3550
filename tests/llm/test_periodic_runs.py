"""Periodic runs against a search of all periods."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import op11_recompression as op11

SF = "/root/testdata/sf0.001"


def brute(words, least=24, times=3):
    """(start, length, period) of all runs, by start, then period."""
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids, found = np.array([number[w] for w in words]), {}
    for q in range(1, len(words) // times + 1):
        edges = np.diff(np.concatenate(([0], (ids[:-q] == ids[q:]).astype(int), [0])))
        for s, e in zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist(), strict=True):
            if e - s + q >= max(least, times * q):
                found.setdefault((s, e + q), q)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = brute(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else None
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, sha(lines), sha(kept))


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_query_of_the_table(spark):
    import __spark_entry__ as entry

    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = entry.queries()["op11_recompression"](spark, SF)
    assert [f.dataType.simpleString() for f in got.schema.fields] == ["bigint"] * 6 + ["string"] * 2
    want = sorted(expected(d.doc_id, d.text) for d in docs)
    assert sorted(tuple(r[c] for c in COLUMNS) for r in got.collect()) == want
    assert sum(w[1] > 0 for w in want) > 5


@pytest.mark.parametrize("seed", range(40))
def test_runs_are_those_of_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(10):
        texts = []
        for _ in range(rng.randint(1, 6)):
            k = rng.randint(1, 4)
            words = [b"%d" % rng.randint(0, k) for _ in range(rng.randint(0, 120))]
            for _ in range(rng.randint(0, 3)):
                unit = [b"%d" % rng.randint(0, k) for _ in range(rng.randint(1, 12))]
                at = rng.randint(0, len(words))
                words[at:at] = unit * rng.randint(2, 20) + unit[: rng.randint(0, len(unit))]
            texts.append(words)
        least, times = rng.choice([(24, 3), (6, 3), (4, 2)])
        for words, runs in zip(texts, op11.find_runs(texts, least, times), strict=True):
            assert [tuple(r) for r in runs.tolist()] == brute(words, least, times)


def test_extensions_both_ways():
    rng = random.Random(3)
    words = [9] + [rng.randint(0, 1) for _ in range(400)] + [8]
    grammar = op11.Grammar(np.array(words))
    assert len(np.unique(grammar.symbols[-1])) == len(grammar.symbols[-1])
    i, j = np.array([(a, b) for a in range(1, 401, 3) for b in range(a + 1, 401, 5)]).T
    ahead, behind = grammar.extensions(i, j, True), grammar.extensions(i, j, False)
    for a, b, x, y in zip(i.tolist(), j.tolist(), ahead.tolist(), behind.tolist(), strict=True):
        assert words[a : a + x] == words[b : b + x] and words[a + x] != words[b + x]
        assert words[a - y + 1 : a + 1] == words[b - y + 1 : b + 1] and words[a - y] != words[b - y]


def test_odd_rows(spark, frame):
    run = "a b c " * 10
    rows = [(1, None, "x"), (2, "", "x"), (3, " \t\n", "x"), (4, run, "x"), (4, run, "x"), (None, run + "z", "x"), (5, "w\u00a0x " * 30, "x"), (6, "y " * 23, "x"), (7, "y " * 24, "x")]
    docs = frame("doc_id long, text string, periodic string", rows).withColumnRenamed("periodic", "own")
    got = op11.with_runs(docs).select("doc_id", "own", F.transform("periodic.runs", lambda r: F.array(r["start"], r["length"], r["period"])).alias("runs"), "periodic.collapsed").collect()
    found = sorted(((r.doc_id or 0, r.runs, r.collapsed) for r in got), key=str)
    assert all(r.own == "x" for r in got)
    none = [(k, [], "") for k in (1, 2, 3)]
    want = [(0, [[0, 30, 3]], "a b c z"), *none, *[(4, [[0, 30, 3]], "a b c")] * 2, (5, [[0, 30, 1]], "w\u00a0x"), (6, [], " ".join(["y"] * 23)), (7, [[0, 24, 1]], "y")]
    assert found == sorted(want, key=str)
    assert op11.with_runs(docs.limit(0)).count() == 0


def test_very_long_text(spark, frame):
    words = [f"w{i % 7_001}" for i in range(150_000)] + ["end"] + ["same"] * 100_000
    rows = op11.with_runs(frame("doc_id long, text string", [(1, " ".join(words))])).select("periodic.runs", F.length("periodic.collapsed").alias("n")).collect()
    assert [tuple(r) for r in rows[0].runs] == [(0, 150_000, 7_001), (150_001, 100_000, 1)]
    assert rows[0].n == len(" ".join([*words[:7_001], "end", "same"]))
