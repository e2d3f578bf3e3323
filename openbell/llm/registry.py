"""Queries of this package, and their SQL where SQL can express them."""

from openbell.llm import audit, centroids, fingerprints, language, licenses, lines, packing, quality, suffixes, tiling, urls, vptree, warc

QUERIES = {
    "op1_suffix_dedup": suffixes.op1_suffix_dedup,
    "op2_license_scan": licenses.op2_license_scan,
    "op3_url_filter": urls.op3_url_filter,
    "op4_language_id": language.op4_language_id,
    "op5_fingerprints": fingerprints.op5_fingerprints,
    "op6_simhash_near_dedup": vptree.op6_simhash_near_dedup,
    "op7_best_fit_packing": packing.op7_best_fit_packing,
    "op8_decontaminate": tiling.op8_decontaminate,
    "op9_warc": warc.op9_warc,
    "op10_line_dedup": lines.op10_line_dedup,
    "op11_quality_rules": quality.op11_quality_rules,
    "op12_filter_audit": audit.op12_filter_audit,
    "op13_centroids": centroids.op13_centroids,
}

ORACLE = {
    "op1_suffix_dedup": suffixes.ORACLE_SQL,
    "op2_license_scan": licenses.ORACLE_SQL,
    "op9_warc": warc.ORACLE_SQL,
    "op10_line_dedup": lines.ORACLE_SQL,
    "op11_quality_rules": quality.ORACLE_SQL,
    "op12_filter_audit": audit.ORACLE_SQL,
    "op13_centroids": centroids.ORACLE_SQL,
}
