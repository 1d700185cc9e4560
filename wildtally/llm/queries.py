"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wildtally.llm.bpe import op7_bpe_chunks
from wildtally.llm.decontam import OP5_SQL, op5_decontamination
from wildtally.llm.embeddings import op8_lattice_neighbours
from wildtally.llm.langid import op2_language_crf
from wildtally.llm.lattice import op10_lattice_scores
from wildtally.llm.middle import OP12_SQL, op12_fill_in_middle
from wildtally.llm.pieces import op11_piece_rounds
from wildtally.llm.pii import op3_pii_skip_chain
from wildtally.llm.simhash import op9_simhash_pivots
from wildtally.llm.tokenfile import op1_mixed_context_tokens
from wildtally.llm.turns import op13_conversation_repair
from wildtally.llm.urlrules import OP6_SQL, op6_url_automaton
from wildtally.llm.warc import OP4_SQL, op4_warc_index_first


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_mixed_context_tokens": op1_mixed_context_tokens,
        "op2_language_crf": op2_language_crf,
        "op3_pii_skip_chain": op3_pii_skip_chain,
        "op4_warc_index_first": op4_warc_index_first,
        "op5_decontamination": op5_decontamination,
        "op6_url_automaton": op6_url_automaton,
        "op7_bpe_chunks": op7_bpe_chunks,
        "op8_lattice_neighbours": op8_lattice_neighbours,
        "op9_simhash_pivots": op9_simhash_pivots,
        "op10_lattice_scores": op10_lattice_scores,
        "op11_piece_rounds": op11_piece_rounds,
        "op12_fill_in_middle": op12_fill_in_middle,
        "op13_conversation_repair": op13_conversation_repair,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op4_warc_index_first": OP4_SQL,
        "op5_decontamination": OP5_SQL,
        "op6_url_automaton": OP6_SQL,
        "op12_fill_in_middle": OP12_SQL,
    }
