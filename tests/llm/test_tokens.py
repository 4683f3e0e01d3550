"""Token counts, token ids and packing against the libraries on whole texts."""

from __future__ import annotations

import random
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import op3_token_counts as op3
from ledgerloom.llm import op10_pack as op10
from ledgerloom.llm.token_ids import TokenIds

SF = "/root/testdata/sf0.001"
PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")

ODD = [
    "", " ", "a", "a b", " a  b ", "a\nb", "a \n b\n\nc", "x\ty z w", "it's John's dog's, they'll\nwe're", "<|endoftext|> a <|endoftext|>b\n<|endoftext|>",
    "<s> </s> ▁ ▁▁a ▁", "日本語 テスト かな", "é ́ á\ńx", "ΣΑΣ ΣΑΣ\nİstanbul ǅ", "1 22 333 4444 12,5 %", " a  b", "a\x1cb c\x85 d",
    "a" * 5000, "word " * 3000, "🎉🎉 👩‍👩‍👧 x", "tail ", "\nstart", "a\r\nb c", "..., ,, !!! ?! -- ---",
]


def odd_texts(seed=3, n=200):
    rng, parts = random.Random(seed), [" ", "  ", "\n", "\t", "▁", "'s", "é", "a", "Word", "12", ".", "<s>", "日", " ", "́", "<|endoftext|>"]
    return ODD + ["".join(rng.choice(parts) for _ in range(rng.randint(1, 60))) for _ in range(n)]


def test_counts_of_cut_texts_equal_whole_texts():
    import sentencepiece

    texts = odd_texts()
    whole = [len(x) for x in sentencepiece.SentencePieceProcessor(model_file=PIECES).encode(texts)]
    assert op3.lengths(texts, PIECES, part_chars=3, batch_bytes=10) == whole
    assert op3.lengths(texts, PIECES) == whole


def test_token_counts_columns(spark, frame):
    docs = frame("doc_id long, text string", [(1, "é b"), (None, None), (1, "é b"), (2, "")])
    got = [tuple(r) for r in op3.token_counts(docs, PIECES, limit=2).select("doc_id", "n_bytes", "n_tokens", "over_limit").collect()]
    assert Counter(got) == Counter([(1, 4, 2, False), (1, 4, 2, False), (None, 0, 0, False), (2, 0, 0, False)])
    assert op3.token_counts(docs.limit(0), PIECES).count() == 0


@pytest.mark.parametrize("file,spaces", [(BYTES, True), (WORDS, False)])
def test_ids_equal_the_library_on_whole_texts(file, spaces):
    from tokenizers import Tokenizer

    library, texts = Tokenizer.from_file(file), odd_texts()
    want = [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    ids = TokenIds(file, spaces)
    assert ids.encode(texts) == want
    assert ids.encode(texts) == want  # now from kept words
    assert TokenIds(file, spaces, most_words=3).encode(texts) == want


def test_packing_of_the_table(spark):
    from tokenizers import Tokenizer

    import __spark_entry__ as entry

    got = [r.asDict() for r in entry.queries()["op10_pack"](spark, SF).collect()]
    library, lines = Tokenizer.from_file(BYTES), defaultdict(list)
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in got:
        lines[r["doc_id"]].append(r)
    assert set(lines) == set(texts)
    for doc, rows in lines.items():
        ids = [*library.encode(texts[doc], add_special_tokens=False).ids, 2]
        rows.sort(key=lambda r: r["piece"])
        assert [r["piece"] for r in rows] == list(range(len(rows)))
        at = 0
        for k, r in enumerate(rows):
            assert r["start"] == at and (r["length"] == 1024 or k == 0)
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[at : at + r["length"]], "<u4").tobytes())
            at += r["length"]
        assert at == len(ids)
    check_sequences(got, 1024)
    total = sum(r["length"] for r in got)
    assert len({r["sequence_id"] for r in got}) <= -(-total // 1024) + 1


def check_sequences(rows, capacity):
    places = defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in places.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= capacity


def test_packing_small_and_empty(frame):
    docs = frame("doc_id long, text string", [(1, "a b c d e f g"), (None, None), (1, "a b c d e f g"), (2, ""), (3, "x y")]).withColumn("length", F.lit("own"))
    rows = [r.asDict() for r in op10.pack(docs, BYTES, capacity=3).collect()]
    assert len(rows) == 3 + 3 + 1 + 1 + 1
    check_sequences(rows, 3)
    assert sum(r["length"] for r in rows) == 8 + 8 + 1 + 1 + 3
    assert op10.pack(docs.limit(0), BYTES).count() == 0


def fewest(items, capacity):
    best = [len(items)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for j in range(len(bins)):
            if bins[j] >= items[i] and bins[j] not in bins[:j]:
                place(i + 1, [*bins[:j], bins[j] - items[i], *bins[j + 1 :]])
        place(i + 1, [*bins, capacity - items[i]])

    place(0, [])
    return best[0]


@pytest.mark.parametrize("seed", range(60))
def test_plans_are_as_short_as_brute_force(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 20, 50])
    items = sorted((rng.randint(1, capacity) if rng.random() < 0.5 else rng.randint(capacity // 4 + 1, capacity // 2 + 1) for _ in range(rng.randint(0, 10))), reverse=True)
    solution, used = op10.plan(dict(Counter(items)), capacity, 20_000), Counter()
    for pattern, many in solution:
        assert sum(n * take for n, take in pattern) <= capacity
        for n, take in pattern:
            used[n] += take * many
    assert used == Counter(items)
    assert sum(many for _, many in solution) == fewest(items, capacity)


def cut_sequences(seed, bins, parts, shortest, capacity=1024):
    """Pieces that fill so many sequences to the last place."""
    rng, out = random.Random(seed), Counter()
    while bins:
        cuts = sorted(rng.sample(range(1, capacity), rng.choice(parts) - 1))
        pieces = [b - a for a, b in zip([0, *cuts], [*cuts, capacity], strict=True)]
        if min(pieces) >= shortest:
            out.update(pieces)
            bins -= 1
    return dict(out)


@pytest.mark.parametrize("bins,parts,shortest,lengths", [(500, (2, 3), 60, 658), (3000, (2, 2, 2, 3), 1, 1021)])
def test_default_budget_backtracks_on_many_lengths(bins, parts, shortest, lengths):
    pieces, used = cut_sequences(5, bins, parts, shortest), Counter()
    assert len(pieces) == lengths
    solution = op10.plan(pieces)
    for pattern, many in solution:
        assert many > 0 and sum(n * take for n, take in pattern) <= 1024
        for n, take in pattern:
            used[n] += take * many
    assert used == Counter(pieces)
    assert sum(many for _, many in solution) == bins


def test_columns_stay(frame):
    docs = frame("doc_id long, text string, extra int", [(1, "a", 7)])
    assert op3.token_counts(docs, PIECES).select("extra").first()[0] == 7
    assert docs.select(F.size(op10.pieces_of(F.col("text"), BYTES))).first()[0] == 1


def test_token_counts_of_the_table(spark):
    import sentencepiece

    import __spark_entry__ as entry

    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    sizes = {d.doc_id: len(library.encode(d.text or "")) for d in docs}
    want = sorted((d.doc_id, len((d.text or "").encode()), sizes[d.doc_id], sizes[d.doc_id] > 4096) for d in docs)
    got = entry.queries()["op3_token_counts"](spark, SF).select("doc_id", "n_bytes", "n_tokens", "over_limit").collect()
    assert sorted(map(tuple, got)) == want and any(w[3] for w in want)


def test_very_long_texts_through_spark(frame):
    import sentencepiece
    from tokenizers import Tokenizer

    text = " ".join(f"word{i % 313}, Über" for i in range(60_000))
    docs = frame("doc_id long, text string", [(1, text), (2, "a")])
    counted = {r.doc_id: r.n_tokens for r in op3.token_counts(docs, PIECES).collect()}
    assert counted[1] == len(sentencepiece.SentencePieceProcessor(model_file=PIECES).encode(text))
    ids = [*Tokenizer.from_file(BYTES).encode(text, add_special_tokens=False).ids, op10.END]
    rows = [r.asDict() for r in op10.pack(docs, BYTES).collect()]
    check_sequences(rows, 1024)
    pieces = sorted((r["start"], r["length"], r["ids_crc32"]) for r in rows if r["doc_id"] == 1)
    assert [p[2] for p in pieces] == [zlib.crc32(np.array(ids[s : s + n], "<u4").tobytes()) for s, n, _ in pieces] and sum(p[1] for p in pieces) == len(ids)


@pytest.mark.parametrize("times", [3, 20, 300])
def test_a_plan_ends_whatever_the_counts(times):
    """Counts of all lengths whose greedy plans miss the bound; the work is bounded, not the rows."""
    rng, used = random.Random(times), Counter()
    pieces = {n: 1 + int(times * rng.uniform(0.5, 1.5) * (40 if n == 1024 else 1 + 30 / n**0.5)) for n in range(1, 1025)}
    began = time.process_time()
    solution = op10.plan(pieces)
    assert time.process_time() - began < 30
    for pattern, many in solution:
        assert many > 0 and sum(n * take for n, take in pattern) <= 1024
        for n, take in pattern:
            used[n] += take * many
    assert used == Counter(pieces)
    counts = [0, *(pieces[n] for n in range(1, 1025))]
    assert sum(many for _, many in solution) <= 1.002 * op10.least_sequences(counts, 1024)


def test_signs_behind_words_equal_the_library():
    from tokenizers import Tokenizer

    library, rng = Tokenizer.from_file(WORDS), random.Random(5)
    parts = [" ", " ", "\n", ", ", ". ", ",", ".", "...", "\x02", "'", "'s", "é", "É", "foo", "Word", "7", "½", "²", ")", "<|", "日", "ж", "İ", "\u0301", "\xad", "\x85", "が"]
    for most in (3, 50, 10**6):
        ids = TokenIds(WORDS, False, most_words=most)
        for _ in range(4):
            texts = ["a ,, b., c,. d", "x., . y", "", *("".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(500))]
            assert ids.encode(texts) == [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


def test_a_run_of_letters_is_asked_once_whatever_sign_follows_it():
    ids, asked = TokenIds(WORDS, False), []

    class Model:
        def tokenize(self, word, model=ids.library.model):
            asked.append(word)
            return model.tokenize(word)

    class Library:
        model = Model()

        def __getattr__(self, name, library=ids.library):
            return getattr(library, name)

    ids.library = Library()
    ids.encode(["Foo, foo. foo### (foo)\nFOO bar's"])
    ids.encode(["foo!! foo, -foo-"])
    assert asked == ["foo"]
