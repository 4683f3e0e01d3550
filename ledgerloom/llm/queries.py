"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from ledgerloom import session
from ledgerloom.llm import op1_pareto_mix as op1
from ledgerloom.llm import op10_pack as op10
from ledgerloom.llm import op11_recompression as op11
from ledgerloom.llm import op12_gnat_negatives as op12
from ledgerloom.llm import op13_popcount_simhash as op13
from ledgerloom.llm import op2_disclosure as op2
from ledgerloom.llm import op3_token_counts as op3
from ledgerloom.llm import op4_iblt as op4
from ledgerloom.llm import op5_range_coder as op5
from ledgerloom.llm import op6_probminhash as op6
from ledgerloom.llm import op7_shards as op7
from ledgerloom.llm import op8_topk as op8
from ledgerloom.llm import op9_language_id as op9

Query = Callable[[SparkSession, str], DataFrame]


def _tuned(fn: Query) -> Query:
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(session.tune(spark), sf_dir)

    return run


QUERIES: dict[str, Query] = {
    fn.__name__: _tuned(fn)
    for fn in (
        op1.op1_pareto_mix,
        op2.op2_disclosure,
        op3.op3_token_counts,
        op4.op4_iblt,
        op5.op5_range_coder,
        op6.op6_probminhash,
        op7.op7_shards,
        op8.op8_topk,
        op9.op9_language_id,
        op10.op10_pack,
        op11.op11_recompression,
        op12.op12_gnat_negatives,
        op13.op13_popcount_simhash,
    )
}

ORACLES: dict[str, str] = {"op1_pareto_mix": op1.SQL, "op8_topk": op8.SQL, "op12_gnat_negatives": op12.SQL}
