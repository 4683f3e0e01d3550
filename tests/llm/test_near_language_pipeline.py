"""Near duplicates, sketches, language identification and the pipeline."""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import op4_iblt as op4
from ledgerloom.llm import op6_probminhash as op6
from ledgerloom.llm import op9_language_id as op9
from ledgerloom.llm.components import components

SF = "/root/testdata/sf0.001"


def query(spark, name, sf=SF):
    import __spark_entry__ as entry

    return entry.queries()[name](spark, sf)


# near duplicates


def weighted(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    counts = defaultdict(int)
    for i in range(max(1, len(words) - 4) if words else 0):
        counts[tuple(words[i : i + 5])] += 1
    return dict(counts)


def brute_jaccard(x, y):
    total = 0.0
    keys = set(x) | set(y)
    for k in set(x) & set(y):
        total += 1 / sum(max(x.get(j, 0) / x[k], y.get(j, 0) / y[k]) for j in keys)
    return total


def brute_classes(texts, least=0.8):
    sets = [weighted(t) for t in texts]
    parent = list(range(len(texts)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and len(a.keys() & b.keys()) >= 0.3 * min(len(a), len(b)) and brute_jaccard(a, b) >= least - 1e-12:
                parent[max(find(i), find(j))] = min(find(i), find(j))
    groups = defaultdict(set)
    for i in range(len(texts)):
        groups[find(i)].add(i)
    return {frozenset(g) for g in groups.values()}


def test_classes_of_the_table(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    got = defaultdict(set)
    for r in query(spark, "op6_probminhash").collect():
        got[r.class_id].add(r.doc_id)
    assert {frozenset(g) for g in got.values()} == brute_classes([r.text for r in rows])


def near_copies(seed=0, copies=40, words=60, most=6):
    """Copies of one text with so many edits that only some pairs reach the threshold."""
    rng = random.Random(seed)
    base = [f"w{rng.randint(0, 400)}" for _ in range(words)]
    out = []
    for _ in range(copies):
        text = base[:]
        for _ in range(rng.randint(0, most)):
            text[rng.randrange(len(text))] = f"x{rng.randint(0, 10**6)}"
        out.append(" ".join(text))
    return out


@pytest.mark.parametrize("chunk", [512, 7])
def test_classes_in_a_bucket_of_loose_copies(frame, monkeypatch, chunk):
    monkeypatch.setattr(op6, "CHUNK", chunk)
    texts = near_copies() + near_copies(1, 10, 30, 3) + ["alone here"] * 3 + ["", "", "one two three four five six seven eight nine ten"]
    rows = frame("row_id long, doc_id long, text string", [(i, i, t) for i, t in enumerate(texts)] + [(1000, None, None)])
    got = defaultdict(set)
    for r in op6.classes(rows).where("doc_id is not null").collect():
        got[r.class_id].add(r.doc_id)
    assert {frozenset(g) for g in got.values()} == brute_classes(texts)


def test_exact_similarity_equals_its_definition():
    rng = random.Random(3)
    for _ in range(200):
        x, y = ({rng.randint(0, 12): rng.randint(1, 4) for _ in range(rng.randint(1, 9))} for _ in range(2))
        a, b = (np.array(sorted(v), np.uint64) for v in (x, y))
        got = op6.exact_similarity(a, np.array([x[int(k)] for k in a]), b, np.array([y[int(k)] for k in b]))
        assert abs(got - brute_jaccard(x, y)) < 1e-9


def test_registers_agree_with_the_probability_jaccard():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 300).astype(np.uint64)
    x, y = np.ones(300), np.ones(300)
    x[:60], y[240:] = 3, 2
    both = np.concatenate([np.zeros(300, int), np.ones(300, int)])
    won = op6.registers(both, np.concatenate([base, base]), np.concatenate([x, y]), 2, 4096)
    want = brute_jaccard(dict(enumerate(x)), dict(enumerate(y)))
    assert abs((won[0] == won[1]).mean() - want) < 0.03


def test_deduplicated_keeps_one_and_all_columns(frame):
    rows = [(3, "a b c d e f g", 1), (1, "a b c d e f g", 2), (1, "A  b c\nd e f g", 3), (None, "a b c d e f g", 4), (5, None, 5), (6, "", 6), (None, None, 7), (9, "z", 8)]
    docs = frame("doc_id long, text string, node int", rows).withColumn("row_id", F.lit("own")).withColumn("doc", F.lit(1))
    out = op6.deduplicated(docs)
    assert out.columns == docs.columns
    assert sorted(r.node for r in out.collect()) in ([2, 5, 6, 7, 8], [3, 5, 6, 7, 8])
    assert op6.deduplicated(docs.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_components(frame, seed):
    rng = random.Random(seed)
    edges = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(35)] + [(i, i + 1) for i in range(100, 130)]
    parent = list(range(200))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    want = {(v, find(v)) for a, b in edges if a != b for v in (a, b)}
    got = components(frame("a long, b long", edges)).collect()
    assert {(r.node, r.root) for r in got} == want and len(got) == len(want)


# sketches


def paragraph_set(text):
    return {p.strip(" ") for p in re.findall(op4.PARAGRAPH.replace(r"[^\n]", "[^\\n]"), text) if p.strip(" ")}


def likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def check_sketches(rows, texts):
    for i, r in enumerate(rows):
        own, following = texts[i], texts[(i + 1) % len(texts)]
        edited = own[: len(own) - len(own) // 2] + following[: len(own) // 2]
        assert r.n_chars == len(own) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert abs(r.near_edited - likeness(paragraph_set(own), paragraph_set(edited))) < 1e-12
        assert abs(r.near_next - likeness(paragraph_set(own), paragraph_set(following))) < 1e-12


def test_sketches_of_the_table(spark):
    texts = [r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()]
    rows = sorted(query(spark, "op4_iblt").collect(), key=lambda r: r.doc_id)
    check_sketches(rows, texts)
    prints = {}
    for r, t in zip(rows, texts, strict=True):
        assert prints.setdefault(t, r.fingerprint) == r.fingerprint


def test_sketches_retry_until_the_difference_is_whole(frame):
    rng = random.Random(4)
    line = lambda n: "\n".join(f"line {rng.randint(0, 10**9)}" for _ in range(n))
    texts = [line(n) for n in (0, 1, 3, 30, 300, 3000)] + ["", "same\nsame", "same", line(20_000), "😀é. " * 50]
    docs = frame("doc_id long, text string", list(enumerate(texts)))
    check_sketches(sorted(op4.fingerprints(docs).collect(), key=lambda r: r.doc_id), texts)


def test_difference_names_the_digests(frame):
    docs = frame("a array<long>, b array<long>", [([1 << 40, 2, 3], [3, 4]), ([], []), (None, [5]), ([7], [7])]).select(
        *[F.coalesce(c, F.array().cast("array<long>")).alias(c) for c in ("a", "b")]
    )
    out = op4.with_difference(docs, F.col("a"), F.col("b"), op4.sketch(F.col("a")), op4.sketch(F.col("b")), "apart").collect()
    assert [sorted((d.x, d.n) for d in r.apart) for r in out] == [[(2, 1), (4, -1), (1 << 40, 1)], [], [(5, -1)], []]


def test_sketches_nulls_repeats_one_row_and_none(frame):
    docs = frame("doc_id long, text string, cells int", [(1, "a. b", 0), (1, "a. b", 0), (None, None, 0), (2, "c", 0)])
    rows = sorted(op4.fingerprints(docs).collect(), key=lambda r: (r.doc_id is None, r.doc_id))
    check_sketches(rows, ["a. b", "a. b", "c", ""])
    one = op4.fingerprints(docs.where("doc_id = 2")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert op4.fingerprints(docs.limit(0)).count() == 0


# language


def test_held_out_accuracy(spark):
    import zlib

    rows = {r.doc_id: r for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    got = query(spark, "op9_language_id", "/root/testdata/sf0.01").collect()
    assert len(got) == len(rows)
    right = []
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
        if r.held_out:
            right.append(r.lang_pred == rows[r.doc_id].lang)
    assert len(right) > 100 and np.mean(right) > 0.97


def test_language_of_odd_texts(spark, frame):
    rows = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows += [(1000, None, "en"), (1001, "12 34 --", "en"), (1002, "", None), (None, rows[0][1], "en"), (1003, "é" * 100_000, None)]
    docs = frame("doc_id long, text string, lang string", rows).withColumn("score", F.lit("own")).withColumn("said", F.lit(1))
    got = {r.doc_id: r for r in docs.withColumn("p", op9.language(docs)).select("doc_id", "p.*").collect()}
    assert all(got[k].lang_pred == "und" and got[k].score == 0 for k in (1000, 1001, 1002))
    assert got[None].lang_pred == got[rows[0][0]].lang_pred and got[1003].lang_pred in {r[2] for r in rows}
    kept = op9.accepted(docs)
    assert kept.columns == docs.columns and not {1000, 1001, 1002} & {r.doc_id for r in kept.collect()}
    assert docs.limit(0).withColumn("p", op9.language(docs.limit(0))).count() == 0
    blank = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in blank.withColumn("p", op9.language(blank)).select("p.*").collect()} == {"und"}


def test_all_languages_are_learnt(frame, monkeypatch):
    monkeypatch.setattr(op9, "SAMPLE", 500)
    docs = frame("doc_id long, text string, lang string", [(i, f"word {i}", f"l{i % 100:02}") for i in range(3000)])
    windows, labels, langs = op9.training_windows(docs)
    assert langs == [f"l{i:02}" for i in range(100)]
    assert len(set(labels.tolist())) > 90  # five documents of each, chosen by their hash
    assert 300 < len(windows) < 1000


def test_rejection_follows_the_number_of_languages(frame, monkeypatch):
    docs = frame("doc_id long, text string", [(1, "0.51"), (2, "0.08"), (3, "0.9"), (4, "0.02"), (5, "0.3")])
    kept = {}
    for n in (2, 4, 100):
        monkeypatch.setattr(op9, "_learnt", lambda _, n=n: (F.struct(F.lit("a").alias("lang_pred"), F.col("text").cast("double").alias("score")), n))
        kept[n] = sorted(r.doc_id for r in op9.accepted(docs).collect())
    assert kept == {2: [3], 4: [1, 3, 5], 100: [1, 2, 3, 5]}


def test_windows_cover_whole_texts():
    texts = pa.array(["a" * 600, None, "", "bc"])
    data, spans, owner = op9.text_windows(texts)
    assert owner.tolist() == [0, 0, 0, 3]
    assert [bytes(data[a : min(a + op9.WINDOW, b)]).decode() for a, b in spans.tolist()] == ["a" * 256, "a" * 256, "a" * 88, "bc"]


def test_gradients():
    """The trained network separates two alphabets, and training repeats."""
    rng = np.random.default_rng(0)
    windows = np.concatenate([rng.integers(97, 104, (60, op9.WINDOW)), rng.integers(104, 111, (60, op9.WINDOW))]).astype(np.uint8)
    labels = np.repeat([0, 1], 60)
    one, two = (op9.train(windows, labels, ["a", "b"], epochs=3) for _ in range(2))
    assert (one.probabilities(windows).argmax(axis=1) == labels).all()
    assert (one.kernel == two.kernel).all()


# pipeline


def test_pipeline_stage_by_stage(spark, tmp_path):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    start, names = docs, [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "near_duplicates", "personal_data", "mix", "pack"]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        if name != "pack":
            assert docs.columns == start.columns
        if name in ("language_id", "near_duplicates"):
            assert docs.exceptAll(before).count() == 0
        if name == "near_duplicates":
            groups = brute_classes([r.text for r in before.orderBy("doc_id").collect()])
            assert docs.count() == len(groups)
        if name == "personal_data":
            assert docs.count() == before.count() and docs.where("text rlike '[a-z0-9]@[a-z0-9]+[.]'").count() == 0
        if name == "mix":
            assert docs.select("doc_id").distinct().exceptAll(before.select("doc_id").distinct()).count() == 0
    whole = corpus_pipeline.run(spark, SF)
    assert sorted(map(str, whole.drop("sequence_id", "offset").collect())) == sorted(map(str, docs.drop("sequence_id", "offset").collect()))


def _small_documents(spark, path, rows, extra=()):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(rows, schema)
    for name in extra:
        docs = docs.withColumn(name, F.lit("own"))
    docs.write.parquet(f"{path}/documents.parquet")
    return docs


def test_a_second_run_leaves_the_first_alone(spark):
    import corpus_pipeline

    first = corpus_pipeline.run(spark, SF)
    second = corpus_pipeline.run(spark, SF)
    rows = [sorted(map(str, df.drop("sequence_id", "offset").collect())) for df in (first, second)]
    assert rows[0] == rows[1] and len(rows[0]) > 100


def test_pipeline_of_nothing(spark, tmp_path):
    import corpus_pipeline

    _small_documents(spark, tmp_path, [])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_pipeline_of_odd_rows_and_clashing_columns(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(2)
    speech = {"en": "the quick brown fox jumps over lazy dogs and then some more of them".split(), "de": "über den schnellen fuchs läuft der große faule hund und noch mehr davon".split()}
    rows = [(i, " ".join(rng.choice(speech[lang]) for _ in range(60)), lang, "web" if i % 3 else None, 1) for i, lang in enumerate(["en", "de"] * 20)]
    rows += [(100, None, "en", "web", None), (None, rows[0][1], "en", "web", 1), (101, "", None, None, 0), (102, "12 34 !!", "de", "web", 8), (103, rows[1][1], "de", "web", 1)]
    rows += [(104, "mail anna.bell@mail.example now " + rows[2][1] + " word" * 3000, None, "books", 1)]
    extra = ["row_id", "number", "taken", "size", "print", "class", "class_id", "length", "piece", "start", "doc", "root", "node"]
    docs = _small_documents(spark, tmp_path, rows, extra)
    now = docs
    for name, step in corpus_pipeline.STAGES:
        step(spark, now, str(tmp_path)).write.parquet(str(tmp_path / name))
        now = spark.read.parquet(str(tmp_path / name))
        if name != "pack":
            assert now.columns == docs.columns and now.where("row_id <> 'own' OR taken <> 'own'").count() == 0
    kept = {r.doc_id for r in spark.read.parquet(str(tmp_path / "near_duplicates")).collect()}
    assert kept >= {0, 1, 2, 104} - {0} and not kept & {100, 101, 102} and 103 not in kept
    assert {r.doc_id for r in now.select("doc_id").distinct().collect()} <= kept | {None}
