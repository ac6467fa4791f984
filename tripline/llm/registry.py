"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from tripline.llm.decontaminate import op10_simhash_decontamination
from tripline.llm.fillmiddle import OP12_SQL, op12_secondary_sort_fim
from tripline.llm.fingerprint import op9_scaled_sketches
from tripline.llm.language import op8_viterbi_language
from tripline.llm.licenses import OP4_SQL, op4_license_digests
from tripline.llm.mixing import op7_splitting_tree_mix
from tripline.llm.ngramjoin import op3_token_group_join
from tripline.llm.prefixtrie import OP11_SQL, op11_parenthesis_trie
from tripline.llm.sharding import op1_feistel_shards
from tripline.llm.suffixdedup import op6_bucket_refinement
from tripline.llm.topk import OP13_SQL, op13_voronoi_topk
from tripline.llm.toxicity import op2_noisy_channel_toxicity
from tripline.llm.urlfilter import OP5_SQL, op5_trie_url_filter

QUERIES = {
    "op1_feistel_shards": op1_feistel_shards,
    "op2_noisy_channel_toxicity": op2_noisy_channel_toxicity,
    "op3_token_group_join": op3_token_group_join,
    "op4_license_digests": op4_license_digests,
    "op5_trie_url_filter": op5_trie_url_filter,
    "op6_bucket_refinement": op6_bucket_refinement,
    "op7_splitting_tree_mix": op7_splitting_tree_mix,
    "op8_viterbi_language": op8_viterbi_language,
    "op9_scaled_sketches": op9_scaled_sketches,
    "op10_simhash_decontamination": op10_simhash_decontamination,
    "op11_parenthesis_trie": op11_parenthesis_trie,
    "op12_secondary_sort_fim": op12_secondary_sort_fim,
    "op13_voronoi_topk": op13_voronoi_topk,
}
SQL = {
    "op4_license_digests": OP4_SQL,
    "op5_trie_url_filter": OP5_SQL,
    "op11_parenthesis_trie": OP11_SQL,
    "op12_secondary_sort_fim": OP12_SQL,
    "op13_voronoi_topk": OP13_SQL,
}
