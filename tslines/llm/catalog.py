"""The registered queries of this package."""

from __future__ import annotations

import corpus_pipeline
from tslines.llm import (bpe, chat, decontaminate, language, merkle, mixing, neighbours, order, runs,
                         simhash, substring, surrogates, toxicity)

QUERIES = {
    "op1_keyed_surrogates": surrogates.op1_keyed_surrogates,
    "op2_nnpu_toxicity": toxicity.op2_nnpu_toxicity,
    "op3_simhash_trie": simhash.op3_simhash_trie,
    "op4_training_order": order.op4_training_order,
    "op5_learned_partitions": neighbours.op5_learned_partitions,
    "op6_benchmark_matches": decontaminate.op6_benchmark_matches,
    "op7_language_mixture": language.op7_language_mixture,
    "op8_chat_round_trip": chat.op8_chat_round_trip,
    "op9_pivotal_mixing": mixing.op9_pivotal_mixing,
    "op10_super_kmers": substring.op10_super_kmers,
    "op11_merkle_climb": merkle.op11_merkle_climb,
    "op12_maximal_pairs": runs.op12_maximal_pairs,
    "op13_pair_index": bpe.op13_pair_index,
    "pipeline": corpus_pipeline.run,
}
ORACLES = {
    "op8_chat_round_trip": chat.CHAT_SQL,
    "op11_merkle_climb": merkle.MERKLE_SQL,
}
