"""Token counts: texts are encoded in Arrow batches and only the lengths leave the function.

Long texts are cut at single spaces between two characters that are neither space nor the space mark of the
vocabulary. No piece of the vocabulary goes on behind such a place and each part gets the same leading mark that
the space would become, so the counts of the parts add up to the count of the text (checked by a test against
whole texts). Parts are encoded in batches of about BATCH_BYTES, so one long text or many short ones load a
batch alike; a text with no such place stays whole. Equal texts of a batch are encoded once.

Defined results: null text counts as empty (0 bytes, 0 tokens); a null doc_id and repeated rows are counted row by row;
an empty table gives no rows; columns beside the text are not touched.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import body, kept_in_worker, read, small_batches, travels_by_value

PART_CHARS = 16_384
BATCH_BYTES = 1 << 20
LIMIT = 4096
_SAFE = re.compile("(?<=[^ ▁]) (?=[^ ▁])")


def parts(text: str, part_chars: int = PART_CHARS) -> list[str]:
    """text cut at safe places, each part about part_chars long."""
    out, start = [], 0
    while len(text) - start > part_chars:
        cut = _SAFE.search(text, start + part_chars)
        if cut is None:
            break
        out.append(text[start : cut.start()])
        start = cut.end()
    out.append(text[start:])
    return out


def _processor(model: str):
    import sentencepiece

    return kept_in_worker(("sentencepiece", model), lambda: sentencepiece.SentencePieceProcessor(model_file=model))


def lengths(texts: list[str], model: str, part_chars: int = PART_CHARS, batch_bytes: int = BATCH_BYTES) -> list[int]:
    encoder, counts = _processor(model), [0] * len(texts)
    batch, owners, filled = [], [], 0

    def encode() -> None:
        for owner, ids in zip(owners, encoder.encode(batch, num_threads=1), strict=True):
            counts[owner] += len(ids)
        batch.clear()
        owners.clear()

    for i, text in enumerate(texts):
        for part in parts(text, part_chars):
            batch.append(part)
            owners.append(i)
            filled += len(part.encode())
            if filled >= batch_bytes:
                encode()
                filled = 0
    encode()
    return counts


def token_count(text: Column, model: str) -> Column:
    @F.arrow_udf("bigint")
    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            distinct = batch.dictionary_encode()
            counts = pa.array(lengths([x or "" for x in distinct.dictionary.to_pylist()], model), pa.int64())
            yield counts.take(distinct.indices)

    return counted(text)


def token_counts(docs: DataFrame, model: str, limit: int = LIMIT) -> DataFrame:
    """docs with n_bytes, n_tokens and over_limit."""
    small_batches(docs.sparkSession)
    return (
        docs.withColumn("n_bytes", F.octet_length(body()).cast("long"))
        .withColumn("n_tokens", token_count(body(), model))
        .withColumn("over_limit", F.col("n_tokens") > limit)
    )


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts(docs, public_tokenizers.path("piece_bpe_32k.model")).drop("text")


travels_by_value(__name__)
