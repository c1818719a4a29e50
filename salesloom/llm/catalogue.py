"""Registered queries of this folder: name, function, SQL (None where SQL cannot state the result)."""

from salesloom.llm import conversation_repair, decontamination, divergence, fingerprints, fixity, language_crf, licenses, maxent_lm, near_dup, packing, secrets, surrogates, toxicity

QUERIES = {
    "op1_secret_forest": (secrets.op1_secret_forest, None),
    "op2_surrogates": (surrogates.op2_surrogates, None),
    "op3_license_dice": (licenses.op3_license_dice, None),
    "op4_crf_language": (language_crf.op4_crf_language, None),
    "op5_maxent_lm": (maxent_lm.op5_maxent_lm, None),
    "op6_column_generation": (packing.op6_column_generation, None),
    "op7_hyperminhash_near_dup": (near_dup.op7_hyperminhash_near_dup, None),
    "op8_merkle_audit": (fixity.op8_merkle_audit, fixity.OP8_SQL),
    "op9_minhash_containment": (decontamination.op9_minhash_containment, decontamination.OP9_SQL),
    "op10_weighted_sampling": (fingerprints.op10_weighted_sampling, None),
    "op11_auction_repair": (conversation_repair.op11_auction_repair, conversation_repair.OP11_SQL),
    "op12_factorization_machine": (toxicity.op12_factorization_machine, None),
    "op13_chunk_divergence": (divergence.op13_chunk_divergence, divergence.OP13_SQL),
}
