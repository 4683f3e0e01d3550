"""Hard negatives and SimHash classes against all pairs."""

from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerloom.llm import op12_gnat_negatives as op12
from ledgerloom.llm import op13_popcount_simhash as op13
from ledgerloom.llm.components import components

SF = "/root/testdata/sf0.001"


# hard negatives


def brute_negatives(rows, every=50, positives=5, negatives=3):
    out = []
    for vec_id, label, ints in rows:
        if vec_id % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(ints, other, strict=False)), i, x) for i, x, other in rows if i != vec_id)
        same = [(i, -s) for s, i, x in scored if x == label][:positives]
        for positive, score in same:
            fit = [(i, -s) for s, i, x in scored if x != label and 50 * score <= -100 * s <= 95 * score][:negatives]
            out += [(vec_id, positive, rank + 1, i, score, s) for rank, (i, s) in enumerate(fit)]
    return sorted(out)


def clustered(seed, many, width, centres=6, spread=20, labels=3):
    """(vec_id, label, ints) around a few centres, every tenth one repeating a vector under another id."""
    rng = random.Random(seed)
    middles = [[rng.randint(-100, 100) for _ in range(width)] for _ in range(centres)]
    rows = []
    for i in range(many):
        ints = [x + rng.randint(-spread, spread) for x in rng.choice(middles)]
        rows.append((i * 2, rng.randrange(labels), rows[-1][2] if rows and i % 10 == 0 else ints))
    return rows


@pytest.mark.parametrize("seed,many,width,spread", [(0, 600, 4, 20), (1, 400, 3, 3), (2, 500, 16, 90), (3, 12, 2, 5)])
def test_negatives_are_those_of_brute_force(spark, frame, seed, many, width, spread):
    rows = clustered(seed, many, width, spread=spread)
    index = op12.Index.built(frame("vec_id long, label long, ints array<long>", rows), fanout=4, depth=3, per_leaf=16, per_block=16)
    if many > 100:
        assert index.tree.leaves > 8 and index.blocks.count() > index.tree.leaves / 2
    got = op12.hard_negatives(index.rows.where(F.col("vec_id") % 50 == 0), index).collect()
    assert sorted(tuple(r) for r in got) == brute_negatives(rows)


def test_packed_rows_are_read_a_few_at_once(spark, frame, monkeypatch):
    # a packed block or batch of anchors is a row of up to a megabyte: thousands at once do not fit
    name, held, write = "spark.sql.parquet.columnarReaderBatchSize", [], op12.materialise

    def seen(df, label, **options):
        if label == "gnat-found":
            held.append(int(spark.conf.get(name)))
        return write(df, label, **options)

    monkeypatch.setattr(op12, "materialise", seen)
    before = spark.conf.get(name)
    rows = clustered(7, 500, 6, spread=40)
    index = op12.Index.built(frame("vec_id long, label long, ints array<long>", rows), fanout=4, depth=2, per_leaf=16, per_block=4)
    # leaves of several blocks, crews of several blocks, and a leaf's blocks in more than one crew
    crews = {(r["leaf"], r["part"]): r["crew"] for r in index.blocks.select("crew", "leaf", "part").collect()}
    assert max(part for _, part in crews) > 2 and len(set(crews.values())) < len(crews) and max(map(len, index.crews.values())) > 1
    assert all(crew in index.crews[leaf] for (leaf, _), crew in crews.items())
    got = op12.hard_negatives(index.rows.where(F.col("vec_id") % 50 == 0), index).collect()
    assert sorted(tuple(r) for r in got) == brute_negatives(rows)
    assert held and max(held) * op12.ANCHORS * 64 * 8 < 1 << 26
    assert spark.conf.get(name) == before


def test_leaves_are_eliminated(frame):
    rows = clustered(5, 800, 6, centres=12, spread=4)
    index = op12.Index.built(frame("vec_id long, label long, ints array<long>", rows), fanout=4, depth=3, per_leaf=16, per_block=64)
    vectors = np.array([r[2] for r in rows], np.int64)
    leaf, _ = index.tree.descend(vectors)
    scores = vectors[:40] @ vectors.T
    lows = np.sort(scores, axis=1)[:, -6:-5]
    alive = defaultdict(set)
    for x, at in index.tree.alive(vectors[:40], lows, np.full((40, 1), 1 << 62)):
        for a in at.tolist():
            alive[a].add(x)
    for a in range(40):
        assert {int(leaf[r]) for r in np.flatnonzero(scores[a] >= lows[a, 0])} <= alive[a]
    assert sum(map(len, alive.values())) < 40 * len(set(leaf.tolist())) / 3


def test_odd_vectors(spark, frame):
    rows = [
        (0, 1, [1.0, 1.0], "a"), (1, 1, [1.0], "a"), (2, 2, [0.75, 0.0], "a"), (3, 2, [0.75, 0.0], "a"), (3, 2, [0.75, 0.0], "a"), (4, None, [0.75, 0.0], "a"),
        (5, 2, None, "a"), (6, 2, [float("nan"), 1.0], "a"), (7, 2, [None, 1.0], "a"), (None, 2, [0.75, 0.0], "a"), (8, 2, [float("inf"), 1.0], "a"), (50, 3, [-1.0, 0.0], "a"),
        (9, 3, [0.5, 0.0], "a"), (10, 2, [], "a"),
    ]
    vectors = frame("vec_id long, label int, embedding array<float>, leaf string", rows)
    index = op12.Index.built(op12.quantised(vectors))
    got = op12.hard_negatives(index.rows.where(F.col("vec_id") % 50 == 0), index).collect()
    assert sorted(map(tuple, got)) == [(0, 1, 1, 2, 65536, 49152), (0, 1, 2, 3, 65536, 49152), (0, 1, 3, 3, 65536, 49152)]
    empty = op12.Index.built(op12.quantised(vectors.limit(0)))
    assert op12.hard_negatives(empty.rows, empty).count() == 0


def test_windows_round_inwards(frame):
    rows = frame("score long", [(199,), (200,), (-100,), (0,), (1,), (-7,)])
    got = rows.select(op12._hundredths(F.col("score"), 50, True).alias("low"), op12._hundredths(F.col("score"), 95, False).alias("high")).collect()
    assert [tuple(r) for r in got] == [(100, 189), (100, 190), (-50, -95), (0, 0), (1, 0), (-3, -7)]


# SimHash


def print_of(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 4]), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in hashes) > len(hashes))


def brute_components(prints, distance=4):
    """For each print the least place it is linked with."""
    values = np.array(prints, np.uint64)
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= distance
    label = np.arange(len(values))
    while True:
        least = np.where(near, label[None, :], len(values)).min(axis=1)
        if (least == label).all():
            return label.tolist()
        label = least


def test_simhash_of_the_table(spark):
    import __spark_entry__ as entry

    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    prints = [print_of(d.text) for d in docs]
    want = {(d.doc_id, f"{p:016x}", docs[c].doc_id) for d, p, c in zip(docs, prints, brute_components(prints), strict=True)}
    got = entry.queries()["op13_popcount_simhash"](spark, SF)
    assert {tuple(r) for r in got.select("doc_id", "fingerprint", "component_id").collect()} == want
    assert len({w[2] for w in want}) < len(docs)


def families(seed, bases, members, flips):
    """Distinct signed prints, some of them a few bits off others."""
    rng, out = random.Random(seed), set()
    for _ in range(bases):
        base = rng.getrandbits(64)
        for _ in range(members):
            x = base
            for b in rng.sample(range(64), rng.randint(0, flips)):
                x ^= 1 << b
            out.add(x)
    return sorted(x - (1 << 64) if x >> 63 else x for x in out)


@pytest.mark.parametrize(
    "seed,bases,members,flips,distance,most",
    [(0, 3, 150, 6, 4, 8), (1, 200, 3, 9, 4, 512), (2, 2, 300, 12, 4, 5), (3, 40, 20, 8, 3, 4), (4, 40, 20, 8, 5, 512), (5, 30, 20, 4, 1, 6), (6, 30, 20, 5, 2, 512), (7, 1, 300, 24, 4, 3)],
)
def test_links_keep_all_components(spark, frame, seed, bases, members, flips, distance, most):
    prints = families(seed, bases, members, flips)
    table = frame("print long", [(p,) for p in prints])
    found = {r.node: r.root for r in components(op13.links(table, distance, most)).collect()}
    got = defaultdict(set)
    for p in prints:
        got[found.get(p, p)].add(p)
    want = defaultdict(set)
    for p, c in zip(prints, brute_components([p & (1 << 64) - 1 for p in prints], distance), strict=True):
        want[c].add(p)
    assert {frozenset(g) for g in got.values()} == {frozenset(g) for g in want.values()}


def test_manhattan_is_a_lower_bound(frame):
    prints = families(9, 20, 10, 20)
    points = [r[0] for r in frame("print long", [(p,) for p in prints]).select(op13.embedded(F.col("print"))).collect()]
    for p, v in zip(prints, points, strict=True):
        assert all((v >> 2 * i & 3) == (p >> 2 * i & 3).bit_count() for i in range(32))


def test_odd_texts(spark, frame):
    rows = [(3, None, 1), (1, "", 1), (None, " \n", 1), (7, "One two", 1), (5, "one\ttwo", 1), (5, "one two", 1), (None, "quite another text of words", 1), (9, "ÉTÉ", 1), (10, "été", 1)]
    docs = frame("doc_id long, text string, print int", rows).withColumn("cell", F.lit(0)).withColumn("component_id", F.lit("x"))
    got = sorted(((r.doc_id, r.print & (1 << 64) - 1, r.component_id) for r in op13.classified(docs).collect()), key=str)
    two, lone = print_of("one two"), print_of("quite another text of words")
    want = [(3, 0, 1), (1, 0, 1), (None, 0, 1), (7, two, 5), (5, two, 5), (5, two, 5), (None, lone, None), (9, print_of("ÉTÉ"), 9), (10, print_of("été"), 10)]
    assert got == sorted(want, key=str)
    assert op13.classified(docs.limit(0)).count() == 0


def test_long_text(frame):
    text = " ".join(f"W{i % 977}" for i in range(100_000))
    assert frame("doc_id long, text string", [(1, text)]).select(op13.fingerprint(F.col("text"))).first()[0] & (1 << 64) - 1 == print_of(text)
