"""The queries of this subpackage. Those without SQL need a tokenizer, a hash family, a model or a graph that SQL can't
express, and are tested against brute force, an exact round trip or held-out accuracy instead."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import sql
from .ann import op5_posting_lists
from .ans import op7_token_ans
from .chat import op10_reply_trees
from .embed_dedup import op8_hnsw_dedup
from .minhash import op9_tensored_minhash
from .mixing import op3_temperature_mix
from .packing import op4_best_fit_packing
from .pii import op13_skip_chain_pii
from .quality import op6_factorisation_machine
from .ranked import op11_blas_search
from .repair import op12_re_pair_repair
from .sharding import op2_bounded_ring
from .token_counts import op1_separator_scan


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: q for q in (
        op1_separator_scan, op2_bounded_ring, op3_temperature_mix, op4_best_fit_packing, op5_posting_lists,
        op6_factorisation_machine, op7_token_ans, op8_hnsw_dedup, op9_tensored_minhash, op10_reply_trees,
        op11_blas_search, op12_re_pair_repair, op13_skip_chain_pii)}


SQL: dict[str, str] = {"op11_blas_search": sql.OP11, "op12_re_pair_repair": sql.OP12}
