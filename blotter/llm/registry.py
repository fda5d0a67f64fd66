"""The subpackage's registered queries and their DuckDB SQL."""

from __future__ import annotations

from blotter.llm.language import op7_language_id
from blotter.llm.minhash import op1_minhash_near_dedup
from blotter.llm.mixing import OP9_SQL, op9_source_mixing
from blotter.llm.neighbours import OP5_SQL, op5_nearest_neighbours
from blotter.llm.packing import op3_packing
from blotter.llm.phrases import OP11_SQL, op11_phrases
from blotter.llm.prefix_trie import OP13_SQL, op13_prefix_trie
from blotter.llm.quality_rules import op4_quality_rules
from blotter.llm.quality_trees import op6_quality_trees
from blotter.llm.simhash import op12_simhash_near_dedup
from blotter.llm.surrogates import op2_surrogates
from blotter.llm.token_files import op8_token_files
from blotter.llm.toxicity import op10_toxicity

QUERIES = {
    "op1_minhash_near_dedup": op1_minhash_near_dedup,
    "op2_surrogates": op2_surrogates,
    "op3_packing": op3_packing,
    "op4_quality_rules": op4_quality_rules,
    "op5_nearest_neighbours": op5_nearest_neighbours,
    "op6_quality_trees": op6_quality_trees,
    "op7_language_id": op7_language_id,
    "op8_token_files": op8_token_files,
    "op9_source_mixing": op9_source_mixing,
    "op10_toxicity": op10_toxicity,
    "op11_phrases": op11_phrases,
    "op12_simhash_near_dedup": op12_simhash_near_dedup,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLE: dict[str, str] = {
    "op5_nearest_neighbours": OP5_SQL,
    "op9_source_mixing": OP9_SQL,
    "op11_phrases": OP11_SQL,
    "op13_prefix_trie": OP13_SQL,
}


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLE)
