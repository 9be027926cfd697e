"""The queries of the corpus operators, and the SQL they are checked with where SQL can express them."""

from __future__ import annotations

from . import decontaminate, lempel_ziv, manifest, mixing, neighbours, products, pseudonyms, quality, secrets, simhash, suffixes, toxicity, whitening

QUERIES = {
    "op1_mix_sources": mixing.op1_mix_sources,
    "op2_nearest_neighbours": neighbours.op2_nearest_neighbours,
    "op3_quality": quality.op3_quality,
    "op4_suffix_dedup": suffixes.op4_suffix_dedup,
    "op5_simhash_near_duplicates": simhash.op5_simhash_near_duplicates,
    "op6_decontaminate": decontaminate.op6_decontaminate,
    "op7_lempel_ziv_dedup": lempel_ziv.op7_lempel_ziv_dedup,
    "op8_pseudonyms": pseudonyms.op8_pseudonyms,
    "op9_toxicity": toxicity.op9_toxicity,
    "op10_secret_scan": secrets.op10_secret_scan,
    "op11_merkle_manifest": manifest.op11_merkle_manifest,
    "op12_largest_products": products.op12_largest_products,
    "op13_whitening": whitening.op13_whitening,
}
ORACLES = {
    "op1_mix_sources": mixing.OP1_SQL,
    "op6_decontaminate": decontaminate.OP6_SQL,
    "op11_merkle_manifest": manifest.OP11_SQL,
    "op12_largest_products": products.OP12_SQL,
}
