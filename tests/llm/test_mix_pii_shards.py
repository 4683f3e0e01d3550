"""Source mixing, personal data, shards and top-k search against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from brute_pii import spans as base_spans
from pyspark.sql import functions as F

from ledgerloom.llm import op1_pareto_mix as op1
from ledgerloom.llm import op2_disclosure as op2
from ledgerloom.llm import op7_shards as op7
from ledgerloom.llm import op8_topk as op8

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def query(spark, name, sf=SF):
    import __spark_entry__ as entry

    return entry.queries()[name](spark, sf)


# mixing


def filled(sizes: dict, weights=(5, 2, 1), most=3):
    """Targets by handing the excess out again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in full]
        left = total - sum(full.values())
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > most * sizes[s]]
        if not over:
            return full | share
        full |= {s: most * sizes[s] for s in over}


@pytest.mark.parametrize("seed", range(5))
def test_targets(frame, seed):
    rng = random.Random(seed)
    sizes = {name: rng.choice([0, rng.randint(1, 50), rng.randint(1, 5000)]) for name in [f"s{i}" for i in range(rng.randint(1, 9))] + [None, "", "é"]}
    got = {r.source: r.target for r in op1.source_targets(frame("source string, source_size long", list(sizes.items()))).collect()}
    want = filled(sizes)
    assert all(abs(got[s] - want[s]) < 1e-6 * max(1, want[s]) for s in sizes)


def test_mix_of_the_table(spark):
    rows = query(spark, "op1_pareto_mix").collect()
    again = query(spark, "op1_pareto_mix").collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    texts = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    sizes, taken = Counter(), Counter()
    for r in rows:
        assert r["size"] == len(WORD.findall(texts[r.doc_id].text or ""))
        assert r.taken % max(r["size"], 1) == 0 and r.taken <= 3 * r["size"]
        sizes[r.source] += r["size"]
        taken[r.source] += r.taken
    want = filled(dict(sizes))
    largest = max(r["size"] for r in rows)
    for r in rows:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * want[r.source] + 1e-6
    assert all(abs(taken[s] - want[s]) <= largest / 2 for s in want)


def test_mix_nulls_ties_and_clashing_names(frame):
    rows = [(1, "a b c", "x", 1), (1, "a b c", "x", 1), (None, None, None, 2), (2, "", "y", 3), (None, "w", None, 4), (3, "a b c", "x", 5)]
    docs = frame("doc_id long, text string, source string, row_id int", rows).withColumn("copies", F.lit("mine")).withColumn("doc", F.lit(0))
    out = op1.mixed(docs)
    assert out.columns == docs.columns
    counts = Counter(r.doc_id for r in out.collect())
    assert counts[2] == 0 and sum(3 * n for k, n in counts.items() if k in (1, 3)) <= 3 * 9
    assert op1.mixed(docs.limit(0)).count() == 0


def test_pareto_inclusion_follows_size(frame):
    """Among many documents each size is drawn about as often as its inclusion probability says."""
    sizes = [10, 20, 40, 80] * 400
    sized = frame("row_id long, doc_id long, source string, size long", [(i, i, "x", s) for i, s in enumerate(sizes)])
    targets = frame("source string, source_size long, target double", [("x", sum(sizes), sum(sizes) * 0.4)])
    drawn = Counter()
    for r in op1.pareto_copies(sized, targets).collect():
        drawn[r["size"]] += r.copies
    c = 0.4 * sum(sizes) / sum(s * s for s in sizes)  # no size reaches certainty
    assert all(abs(drawn[s] / 400 - c * s) < 0.07 for s in (10, 20, 40, 80)), drawn
    assert abs(sum(s * n for s, n in drawn.items()) - 0.4 * sum(sizes)) <= 10


# personal data

ODD = [
    "", "a@b.c d@e", "x a.b@c-d.e.f, _x@y.z%q@r.s", "1.2.3.4.5.6 256.1.1.1 001.2.3.255 1.2.3", "4111 1111 1111 1111 and 4111-1111-1111-1112", "+1 (234) 567-8901 +49 30 1234",
    "4111111111111111@x.yz é 😀 +44 20 7946 0958 😀 10.0.0.1", "a.b_c%d+e-f@g.h.i..j", "+1234567890 4111 1111 1111 1111 9" * 3, "12345678901234567890", "@@@ +-+ ... 1..2.3.4", "x@y.z@w.v",
]


def random_texts(n=300, seed=5):
    rng, parts = random.Random(seed), ["a", "b@", "@c", ".d", ".", "1", "22", "255", "256", "-", " ", "+", "(", ")", "4111 1111 1111 1111", "é", "😀", "%", "_", "\n", "a.b@c.de", "1.2.3.4"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(1, 40))) for _ in range(n)]


def test_base_spans_equal_the_contract(frame):
    texts = ODD + random_texts() + [" ".join(random_texts(400, 9))]
    docs = frame("i int, text string", list(enumerate(texts)))
    got = dict(docs.select("i", op2.written(op2.base_spans(op2.body()))).collect())
    for i, t in enumerate(texts):
        assert got[i] == ",".join(f"{k}:{a}:{b}" for k, a, b in base_spans(t)), t


def test_long_runs_take_linear_time(frame):
    texts = ["a." * 60_000, "1" * 120_000, "1.1." * 30_000, "a@" * 60_000, "+(" * 60_000, "1 " * 60_000]
    docs = frame("i int, text string", list(enumerate(texts)))
    got = dict(docs.select("i", op2.written(op2.base_spans(op2.body()))).collect())
    assert got[0] == got[1] == got[3] == ""
    assert got[2].startswith("ip:0:7,ip:8:15")


def test_table_spans(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = query(spark, "op2_disclosure").collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = base_spans(texts[r.doc_id])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == kind for k, _, _ in want) for kind in ("email", "ip", "card", "phone"))
        assert set(joined.split(",")) <= set(r.spans.split(","))


def test_terms_that_disclose(frame):
    rows = [(i, f"the plain words number {i} of a page about nothing much at all") for i in range(60)]
    rows += [(100, "please write to Zorander at zo@mail.example.com today"), (101, "our Zorander has the address zo@mail.example.com for the page"), (102, "Zorander again, without address")]
    rows += [(103, "the plain words zo2@mail.example.com"), (104, None), (None, "at all +1 234 567 8901")]
    docs = frame("doc_id long, text string", rows).withColumn("spans", F.lit(1)).withColumn("__row", F.lit("own"))
    out = op2.sanitised(docs)
    assert out.columns == docs.columns
    got = {r.doc_id: r.text for r in out.collect()}
    assert got[100] == "please write to  at [EMAIL] today" or got[100] == "please write to [NAME] at [EMAIL] today"
    assert "Zorander" not in got[101] and "zo@" not in got[101] and "the page" in got[101]
    assert got[102] == "Zorander again, without address" and got[5] == rows[5][1]
    assert got[103] == "the plain words [EMAIL]" and got[104] is None and got[None] == "at all [PHONE]"
    assert op2.sanitised(docs.limit(0)).count() == 0


def test_disclosure_values(frame):
    """Counts and quotients against their definition."""
    rows = [(f"w{i % 7} common q{i}", i) for i in range(50)] + [("say kilo hi a@b.cd common end", 100), ("then kilo ho a@b.cd common stop", 101), ("only kilo", 102)]
    docs = frame("text string, doc_id long", rows)
    spotted = docs.select("text", op2.base_spans(op2.body()).alias("found"), F.monotonically_increasing_id().alias("row_id"))
    got = {(r.entity, r.term): r.disclosure for r in op2.disclosing(spotted, docs).collect()}
    total = len(rows)
    want = np.log(2 / 2 * total / 3) / np.log(total / 2)
    assert set(got) == {("email:a@b.cd", "kilo")} and abs(got["email:a@b.cd", "kilo"] - want) < 1e-12


def test_copies_prove_nothing(frame):
    rows = [(i, "name Foobar zo@mail.example.com tail") for i in range(30)] + [(50 + i, f"other text {i}") for i in range(30)]
    out = op2.sanitised(frame("doc_id long, text string", rows))
    assert {r.text for r in out.where("doc_id < 50").collect()} == {"name Foobar [EMAIL] tail"}


def test_overlapping_spans_are_masked_together(frame):
    text = "+4111 1111 1111 1111 x"
    docs = frame("text string", [(text,), ("+1 10.20.30.40 z",)])
    masked = [r[0] for r in docs.select(op2.masked(F.col("text"), op2.base_spans(F.col("text")))).collect()]
    assert all(not re.search("[0-9]", m) for m in masked)


# shards


def test_shards_of_the_table(spark):
    rows = query(spark, "op7_shards").collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    sizes, slots, where = Counter(), defaultdict(list), {}
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "bytes", None)
        sizes[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
        assert where.setdefault(texts[r.doc_id], r.shard) == r.shard
    assert set(sizes) == set(range(8)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(sizes.values()) - min(sizes.values()) < 0.02 * sum(sizes.values()) / 8


@pytest.mark.parametrize("seed", range(30))
def test_differencing(seed):
    rng = random.Random(seed)
    ways, sizes = rng.randint(1, 9), [rng.randint(1, 10 ** rng.randint(1, 6)) for _ in range(rng.randint(0, 200))]
    where = op7.difference(sizes, ways)
    sums = [0] * ways
    for size, way in zip(sizes, where, strict=True):
        sums[way] += size
    assert len(where) == len(sizes) and sum(sums) == sum(sizes)
    assert max(sums) - min(sums) <= max(sizes, default=0)


def test_differencing_two_ways_by_hand():
    # 8 7 6 5 4: 8-7=1, 6-5=1, 4-1=3, 3-1=2
    where = op7.difference([8, 7, 6, 5, 4], 2)
    sums = [sum(s for s, w in zip([8, 7, 6, 5, 4], where, strict=True) if w == k) for k in (0, 1)]
    assert abs(sums[0] - sums[1]) == 2


def test_shards_bundles_nulls_and_empty(frame):
    rng = random.Random(1)
    rows = [(i, "x" * rng.randint(0, 300)) for i in range(500)] + [(None, None), (7, None), (8, ""), (9, "copy" * 900)] + [(600 + i, "copy" * 900) for i in range(3)]
    docs = frame("doc_id long, text string", rows).withColumn("size", F.lit("own"))
    out = op7.shards_of(docs, shards=4, bundles=16).collect()
    assert len(out) == len(rows) and len({r.shard for r in out if r["size"] == 3601}) == 1
    sums = Counter()
    for r in out:
        sums[r.shard] += r["size"]
    assert max(sums.values()) - min(sums.values()) < 0.15 * sum(sums.values()) / 4
    assert op7.shards_of(docs.limit(0)).count() == 0


# top k


def brute_top(vectors, k=20, every=20):
    out = []
    kept = [(i, [int(np.floor(64 * float(x))) for x in v]) for i, v in vectors if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    for q, a in kept:
        if q % every == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b, strict=False)), i) for i, b in kept if i != q)[:k]
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored, 1)]
    return sorted(out)


@pytest.mark.parametrize("slices,seeds,rows", [(1, 1, 7), (2, 2, 50), (3, 1, 1000)])
def test_top_k_equals_brute_force(frame, slices, seeds, rows):
    rng = np.random.default_rng(slices)
    vectors = [(i, [float(x) for x in np.round(rng.normal(size=6), 1)]) for i in range(150)]
    vectors += [(200, None), (None, [1.0] * 6), (202, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (203, [float("nan")] * 6), (204, [float("inf")] + [0.0] * 5), (205, [0.0] * 6), (220, vectors[3][1])]
    table = op8.quantised(frame("vec_id long, embedding array<double>", vectors))
    got = op8.top_k(table.where("vec_id % 20 = 0"), table, k=5, slices=slices, seeds=seeds, per_query_block=3, per_row_block=rows)
    assert sorted(map(tuple, got.select("query_id", "rank", "vec_id", "score").collect())) == brute_top(vectors, 5)


def test_top_k_few_large_and_none(frame):
    vectors = [(0, [3e6, -2e6]), (20, [1e6, 5e6]), (1, [1e6])]
    table = op8.quantised(frame("vec_id long, embedding array<double>", vectors))
    got = op8.top_k(table.where("vec_id % 20 = 0"), table)
    padded = [(i, (v + [0.0])[:2]) for i, v in vectors]
    assert sorted(map(tuple, got.collect())) == brute_top(padded)
    assert op8.top_k(table.limit(0), table.limit(0)).count() == 0
