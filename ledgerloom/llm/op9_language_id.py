"""Language identification by a small convolutional network over bytes.

Bytes are embedded, filters of several widths slide over a window of WINDOW bytes, each filter's highest value in the window
is kept, and a softmax layer gives the languages' probabilities. The network is trained in numpy on a bounded sample
of labelled rows (about SAMPLE_PER_LANG documents of each language, fewer of each where there are so many languages that this would be
above SAMPLE documents; WINDOWS_PER_DOC windows of each). All languages are learnt. Every text is read whole: all its windows are classified and their probabilities averaged.

Defined results: null text and text without letters are `und` with score 0; rows without lang or doc_id are predicted but
not learned from; ties go to the language that sorts first; equal texts get equal predictions; without any labelled row all
is `und`; an empty table gives no rows. All columns of any names are passed on by `accepted`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import forget_kept, read, small_batches, travels_by_value, whole_row

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 12
EMBEDDING = 8
SAMPLE_PER_LANG = 1000
WINDOWS_PER_DOC = 3
SAMPLE = 64_000
EPOCHS = 8
UNKNOWN = "und"
MARGIN = 1 / 15  # of the way from 1 / n, the score of a network that cannot tell n languages apart, to 1
_BATCH = 64


@dataclass
class Network:
    """Weights; kernel holds all filters side by side, narrow ones padded with zeros to the widest."""

    langs: list[str]
    embedding: np.ndarray
    kernel: np.ndarray
    kernel_bias: np.ndarray
    dense: np.ndarray
    dense_bias: np.ndarray

    def columns(self, windows: np.ndarray) -> np.ndarray:
        """(windows * places, widest * embedding): the embedded bytes under the filters at each place."""
        n, wide = len(windows), max(WIDTHS)
        flat = self.embedding[windows].reshape(n, WINDOW * EMBEDDING)
        view = np.lib.stride_tricks.sliding_window_view(flat, wide * EMBEDDING, axis=1)[:, ::EMBEDDING]
        return view.reshape(n * (WINDOW - wide + 1), wide * EMBEDDING)

    def pooled(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        cols = self.columns(windows)
        seen = (cols @ self.kernel).reshape(len(windows), -1, self.kernel.shape[1])
        return cols, seen, np.maximum(seen.max(axis=1) + self.kernel_bias, 0)

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        out = np.empty((len(windows), len(self.langs)), np.float32)
        for i in range(0, len(windows), _BATCH):
            scores = self.pooled(windows[i : i + _BATCH])[2] @ self.dense + self.dense_bias
            scores = np.exp(scores - scores.max(axis=1, keepdims=True))
            out[i : i + _BATCH] = scores / scores.sum(axis=1, keepdims=True)
        return out


def _mask() -> np.ndarray:
    wide = max(WIDTHS)
    mask = np.zeros((wide, EMBEDDING, len(WIDTHS) * FILTERS), np.float32)
    for i, width in enumerate(WIDTHS):
        mask[:width, :, i * FILTERS : (i + 1) * FILTERS] = 1
    return mask.reshape(wide * EMBEDDING, -1)


def train(windows: np.ndarray, labels: np.ndarray, langs: list[str], epochs: int = EPOCHS, seed: int = 7) -> Network:
    """Adam on the cross entropy; the same input gives the same network."""
    rng, mask = np.random.default_rng(seed), _mask()
    init = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    net = Network(
        langs, rng.standard_normal((256, EMBEDDING)).astype(np.float32) * 0.5, init(*mask.shape) * mask,
        np.zeros(mask.shape[1], np.float32), init(mask.shape[1], len(langs)), np.zeros(len(langs), np.float32),
    )
    names = ("embedding", "kernel", "kernel_bias", "dense", "dense_bias")
    moments = {k: (np.zeros_like(getattr(net, k)), np.zeros_like(getattr(net, k))) for k in names}
    step, places = 0, WINDOW - max(WIDTHS) + 1
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for i in range(0, len(order), 32):
            x, y = windows[order[i : i + 32]], labels[order[i : i + 32]]
            n = len(x)
            # every third window is cut to a random length, as short texts are
            kept = np.where(rng.random(n) < 1 / 3, rng.integers(3, WINDOW, n), WINDOW)
            x = np.where(np.arange(WINDOW) < kept[:, None], x, 0)
            cols, seen, top = net.pooled(x)
            at = seen.argmax(axis=1)  # (n, filters): the place that won
            scores = top @ net.dense + net.dense_bias
            p = np.exp(scores - scores.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(n), y] -= 1
            p /= n
            back = (p @ net.dense.T) * (top > 0)
            won = cols.reshape(n, places, -1)[np.arange(n)[:, None], at]  # (n, filters, widest * embedding)
            grads = {"dense": top.T @ p, "dense_bias": p.sum(axis=0), "kernel_bias": back.sum(axis=0)}
            grads["kernel"] = np.einsum("nf,nfc->cf", back, won) * mask
            below = (back[:, :, None] * net.kernel.T[None]).reshape(n, -1, max(WIDTHS), EMBEDDING)
            ids = x[np.arange(n)[:, None, None], at[:, :, None] + np.arange(max(WIDTHS))]
            grads["embedding"] = np.zeros_like(net.embedding)
            np.add.at(grads["embedding"], ids.ravel(), below.reshape(-1, EMBEDDING))
            step += 1
            for k in names:
                m, v = moments[k]
                m += 0.1 * (grads[k] - m)
                v += 0.001 * (grads[k] ** 2 - v)
                rate = 0.004 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                setattr(net, k, (getattr(net, k) - rate * m / (np.sqrt(v) + 1e-8)).astype(np.float32))
    return net


def held_out(doc_id: Column) -> Column:
    """Rows the network never learns from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_windows(docs: DataFrame, per_lang: int = SAMPLE_PER_LANG, windows: int = WINDOWS_PER_DOC) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """A bounded sample of labelled windows on the driver: documents by a hash of their doc_id, windows spread over the text."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")) & F.col("text").rlike(r"\p{L}"))
    counts = sorted(((r["n"], r["lang"]) for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)  # one row per language
    langs = sorted(lang for _, lang in counts)
    if not langs:
        return np.zeros((0, WINDOW), np.uint8), np.zeros(0, np.int64), langs
    per_lang = min(per_lang, max(1, SAMPLE // len(langs)))
    share = F.element_at(F.create_map(*[F.lit(x) for n, lang in counts for x in (lang, per_lang / n)]), F.col("lang"))
    chance = F.pmod(F.xxhash64(F.lit("language"), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    data = F.encode("text", "UTF-8")
    spare = F.greatest(F.octet_length("text") - WINDOW, F.lit(0))
    starts = [F.floor(spare * i / max(windows - 1, 1)).cast("int") + 1 for i in range(windows)]
    picked = rows.where(chance < share).select("lang", "doc_id", F.posexplode(F.array_distinct(F.array(*[F.substring(data, s, F.lit(WINDOW)) for s in starts]))))
    # repeated doc_ids share their chance, so the bound is put on the rows as well
    sample = picked.orderBy(F.xxhash64("doc_id", "pos"), "lang", "col").limit(2 * per_lang * windows * len(langs)).collect()
    sample.sort(key=lambda r: (r["lang"], r["doc_id"], r["pos"], r["col"]))
    matrix = np.zeros((len(sample), WINDOW), np.uint8)
    for i, r in enumerate(sample):
        matrix[i, : len(r["col"])] = np.frombuffer(bytes(r["col"]), np.uint8)
    number = {lang: i for i, lang in enumerate(langs)}
    return matrix, np.array([number[r["lang"]] for r in sample], np.int64), langs


def text_windows(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, first byte of each window, text of each window); windows follow each other and reach the text's end."""
    texts = pa.compute.fill_null(texts, "").cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    sizes = np.diff(offsets)
    counts = -(-sizes // WINDOW)
    owner = np.repeat(np.arange(len(texts)), counts)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    return data, np.stack([offsets[owner] + WINDOW * place, offsets[owner + 1]], axis=1), owner


def classify(net: Network, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Mean probabilities of each text's windows and the number of windows."""
    data, spans, owner = text_windows(texts)
    sums = np.zeros((len(texts), len(net.langs)))
    padded = np.concatenate([data, np.zeros(WINDOW, np.uint8)])
    for i in range(0, len(owner), 4096):
        part = spans[i : i + 4096]
        at = part[:, :1] + np.arange(WINDOW)
        windows = np.where(at < part[:, 1:], padded[at], 0)
        np.add.at(sums, owner[i : i + 4096], net.probabilities(windows))
    counts = np.bincount(owner, minlength=len(texts))
    return sums / np.maximum(counts, 1)[:, None], counts


def predict(text: Column, net: Network) -> Column:
    """struct(lang_pred, score) for texts that have letters."""

    @F.arrow_udf("lang_pred string, score double")
    def predicted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        forget_kept()
        for batch in batches:
            means, counts = classify(net, batch)
            best = means.argmax(axis=1)
            names = pa.array([net.langs[b] if c else UNKNOWN for b, c in zip(best, counts, strict=True)])
            yield pa.StructArray.from_arrays([names, pa.array(np.clip(means[np.arange(len(best)), best], 0, 1))], ["lang_pred", "score"])

    return predicted(text)


def language(docs: DataFrame) -> Column:
    """struct(lang_pred, score) for docs, learnt from their labelled rows."""
    return _learnt(docs)[0]


def _learnt(docs: DataFrame) -> tuple[Column, int]:
    """The struct of `language` and the number of languages."""
    small_batches(docs.sparkSession)
    windows, labels, langs = training_windows(docs)
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    unknown = F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    if not langs:
        return unknown, 0
    return F.when(letters, predict(F.when(letters, F.col("text")), train(windows, labels, langs))).otherwise(unknown), len(langs)


def least_score(n: int, margin: float = MARGIN) -> float:
    """What a score has to reach among n languages."""
    return 1 / n + margin * (1 - 1 / n) if n else 0.0


def accepted(docs: DataFrame, least: float | None = None) -> DataFrame:
    """docs without the rows whose language is `und` or scored below least, by default least_score of the number of languages."""
    said, n = _learnt(docs)
    rows = docs.select(whole_row(docs), "text").withColumn("said", said)
    return rows.where((F.col("said.lang_pred") != UNKNOWN) & (F.col("said.score") >= (least_score(n) if least is None else least))).select("doc.*")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return docs.withColumn("said", language(docs)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "said.lang_pred", "said.score")


travels_by_value(__name__)
