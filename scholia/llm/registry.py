"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from . import alignment, chat, html, infill, media, mixing, packing, passages, pii, quality, secrets, simhash, toxicity

QUERIES = {
    "op1_mix_curriculum": mixing.op1_mix_curriculum,
    "op2_surrogates": pii.op2_surrogates,
    "op3_site_templates": html.op3_site_templates,
    "op4_preference_format": chat.op4_preference_format,
    "op5_mcd_outliers": quality.op5_mcd_outliers,
    "op6_paragraph_minhash": passages.op6_paragraph_minhash,
    "op7_simhash_popcount": simhash.op7_simhash_popcount,
    "op8_trigram_secrets": secrets.op8_trigram_secrets,
    "op9_avi_shots": media.op9_avi_shots,
    "op10_best_fit_pack": packing.op10_best_fit_pack,
    "op11_toxic_clauses": toxicity.op11_toxic_clauses,
    "op12_token_alignment": alignment.op12_token_alignment,
    "op13_infill": infill.op13_infill,
}
ORACLES = {"op4_preference_format": chat.OP4_SQL, "op13_infill": infill.OP13_SQL}
