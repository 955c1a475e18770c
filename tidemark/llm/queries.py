"""Registered queries of this subpackage and, where SQL can express them, their DuckDB twins."""

from __future__ import annotations

from . import chosen_path, collocations, decontaminate, idfiles, lattice, packing, prefix_trie, quality, secrets, sharding, toxicity, urlfilter, wordpiece

QUERIES = {
    "op1_lattice": lattice.op1_lattice,
    "op2_count_tokens": wordpiece.op2_count_tokens,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_shard": sharding.op4_shard,
    "op5_decontaminate": decontaminate.op5_decontaminate,
    "op6_secrets": secrets.op6_secrets,
    "op7_id_files": idfiles.op7_id_files,
    "op8_quality": quality.op8_quality,
    "op9_pack": packing.op9_pack,
    "op10_chosen_path": chosen_path.op10_chosen_path,
    "op11_url_filter": urlfilter.op11_url_filter,
    "op12_prefix_trie": prefix_trie.op12_prefix_trie,
    "op13_collocations": collocations.op13_collocations,
    "proximity_search": decontaminate.proximity_search,
}

ORACLES = {
    "op4_shard": sharding.OP4_SQL,
    "op1_lattice": lattice.OP1_SQL,
    "op5_decontaminate": decontaminate.OP5_SQL,
    "op10_chosen_path": chosen_path.OP10_SQL,
    "op11_url_filter": urlfilter.OP11_SQL,
    "op12_prefix_trie": prefix_trie.OP12_SQL,
    "op13_collocations": collocations.OP13_SQL,
    "proximity_search": decontaminate.PROXIMITY_SQL,
}
