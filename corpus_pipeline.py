"""Training-text pipeline over the documents: each stage's rows are written and read again as the next one's input.

`run` keeps count of the tables of its own run: those of a stage, and the stage's input, are dropped when its rows have been written. What the last
stage's rows are read from stays, so results of several runs can be read side by side. Stages that are called one by one drop
the working tables of the stage before them, whose rows have been written by then.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import op1_pareto_mix as op1
from ledgerloom.llm import op2_disclosure as op2
from ledgerloom.llm import op6_probminhash as op6
from ledgerloom.llm import op9_language_id as op9
from ledgerloom.llm import op10_pack as op10
from ledgerloom.session import drop_tables, materialise, tracked, tune

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_LEFT: dict[str, list[str]] = {}  # working tables by stage, until the one behind it is called


def stage(before: str | None) -> Callable[[Stage], Stage]:
    """A stage that drops what the stage `before` it has left."""

    def wrap(fn: Stage) -> Stage:
        @wraps(fn)
        def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
            drop_tables(spark, _LEFT.pop(before or "", []))
            with tracked() as paths:
                out = fn(spark, docs, sf_dir)
            _LEFT.setdefault(fn.__name__, []).extend(paths)
            return out

        return run_stage

    return wrap


@stage(None)
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the network can tell."""
    return op9.accepted(docs)


@stage("identify_language")
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return op6.deduplicated(docs)


@stage("drop_near_duplicates")
def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without personal data and the terms that disclose it; n_chars follows the text."""
    clean = op2.sanitised(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long"))


@stage("sanitise")
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    return op1.mixed(docs)


@stage("mix_sources")
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces with their sequences and places."""
    import public_tokenizers

    return op10.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", sanitise),
    ("mix", mix_sources),
    ("pack", pack_sequences),
]

ORACLE_SQL = None  # the network, the sketches and the packing plan are no SQL; tests/llm holds the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, input_tables = tune(spark).read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, step in STAGES[:-1]:
        with tracked() as working:
            rows = step.__wrapped__(spark, docs, sf_dir)
        with tracked() as written:
            docs = materialise(rows, f"pipeline-{name}")
        drop_tables(spark, working + input_tables)
        input_tables = written
    packed = STAGES[-1][1].__wrapped__(spark, docs, sf_dir)  # its pieces are a table by now
    drop_tables(spark, input_tables)
    return packed
