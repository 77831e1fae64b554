"""Registry of the subpackage's queries and, where SQL can express them, their DuckDB statements."""

from __future__ import annotations

from corpus_pipeline import ORACLE_SQL as PIPELINE_SQL
from corpus_pipeline import run as pipeline

from .bpe import op1_byte_bpe
from .cascade import OP12_SQL, op12_short_circuit_cascade
from .decontam import OP5_SQL, op5_benchmark_decontamination
from .divergence import OP13_SQL, op13_count_cells
from .htmltext import op2_tag_path_ratios
from .linededup import OP9_SQL, op9_line_hashing
from .lm import op3_backoff_automaton
from .mining import OP11_SQL, op11_angular_triangle
from .neardup import op6_order_minhash
from .permindex import op10_permutation_index
from .quality import op7_rule_ensemble
from .sharding import op8_bin_packing_shards
from .tokenbin import op4_bit_packed_ids

QUERIES = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_tag_path_ratios": op2_tag_path_ratios,
    "op3_backoff_automaton": op3_backoff_automaton,
    "op4_bit_packed_ids": op4_bit_packed_ids,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_order_minhash": op6_order_minhash,
    "op7_rule_ensemble": op7_rule_ensemble,
    "op8_bin_packing_shards": op8_bin_packing_shards,
    "op9_line_hashing": op9_line_hashing,
    "op10_permutation_index": op10_permutation_index,
    "op11_angular_triangle": op11_angular_triangle,
    "op12_short_circuit_cascade": op12_short_circuit_cascade,
    "op13_count_cells": op13_count_cells,
    "pipeline": pipeline,
}
ORACLE = {
    "op5_benchmark_decontamination": OP5_SQL,
    "op9_line_hashing": OP9_SQL,
    "op11_angular_triangle": OP11_SQL,
    "op12_short_circuit_cascade": OP12_SQL,
    "op13_count_cells": OP13_SQL,
}
if PIPELINE_SQL:
    ORACLE["pipeline"] = PIPELINE_SQL
