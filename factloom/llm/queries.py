"""The registered queries of this subpackage and their SQL, where SQL can express them."""

from . import audit, bpe, codes, embdup, maxent, minhash, mixing, packing, preference, search, sharding, suffixes, toxicity

QUERIES = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_sharding": sharding.op2_sharding,
    "op3_suffixes": suffixes.op3_suffixes,
    "op4_packing": packing.op4_packing,
    "op5_maxent": maxent.op5_maxent,
    "op6_search": search.op6_search,
    "op7_minhash": minhash.op7_minhash,
    "op8_embdup": embdup.op8_embdup,
    "op9_mixing": mixing.op9_mixing,
    "op10_preference": preference.op10_preference,
    "op11_codes": codes.op11_codes,
    "op12_audit": audit.op12_audit,
    "op13_bpe": bpe.op13_bpe,
}

ORACLES = {
    "op3_suffixes": suffixes.SQL,
    "op7_minhash": minhash.SQL,
    "op8_embdup": embdup.SQL,
    "op9_mixing": mixing.SQL,
    "op10_preference": preference.SQL,
    "op11_codes": codes.SQL,
    "op12_audit": audit.SQL,
}
