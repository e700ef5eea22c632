"""Registered queries of this subpackage and their check SQL."""

from __future__ import annotations

from . import embedding, exact_dedup, langid, licenses, near_dedup, packing, phrases, pieces_bpe, secret_scan, sharding, spelling, toxicity, urls

QUERIES = {
    "op1_sharding": sharding.op1_sharding,
    "op2_langid": langid.op2_langid,
    "op3_near_embeddings": embedding.op3_near_embeddings,
    "op4_license_scan": licenses.op4_license_scan,
    "op5_url_filter": urls.op5_url_filter,
    "op6_piece_dropout": pieces_bpe.op6_piece_dropout,
    "op7_exact_dedup": exact_dedup.op7_exact_dedup,
    "op8_near_dedup": near_dedup.op8_near_dedup,
    "op9_secret_scan": secret_scan.op9_secret_scan,
    "op10_best_fit_packing": packing.op10_best_fit_packing,
    "op11_spelling_variants": spelling.op11_spelling_variants,
    "op12_toxicity": toxicity.op12_toxicity,
    "op13_phrase_collocations": phrases.op13_phrase_collocations,
}

SQL = {"op7_exact_dedup": exact_dedup.OP7_SQL, "op9_secret_scan": secret_scan.check_sql(), "op13_phrase_collocations": phrases.OP13_SQL}
