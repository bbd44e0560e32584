"""The registered queries of the subpackage and their DuckDB SQL."""

from __future__ import annotations

from needlens.llm import (centroids, decontaminate, exact_dedup, fim, fuzzy_lines, langid, licenses, mixing, pieces,
                          simhash_dedup, token_files, topk, warc_zip)

QUERIES = {
    "op1_warc_zip": warc_zip.op1_warc_zip,
    "op2_sentencepiece": pieces.op2_sentencepiece,
    "op3_mixing": mixing.op3_mixing,
    "op4_exact_dedup": exact_dedup.op4_exact_dedup,
    "op5_language_id": langid.op5_language_id,
    "op6_license_scan": licenses.op6_license_scan,
    "op7_simhash_dedup": simhash_dedup.op7_simhash_dedup,
    "op8_exact_topk": topk.op8_exact_topk,
    "op9_token_files": token_files.op9_token_files,
    "op10_fuzzy_lines": fuzzy_lines.op10_fuzzy_lines,
    "op11_centroid_clusters": centroids.op11_centroid_clusters,
    "op12_fill_in_middle": fim.op12_fill_in_middle,
    "op13_decontaminate": decontaminate.op13_decontaminate,
}


def oracle_sql() -> dict[str, str]:
    return {"op4_exact_dedup": exact_dedup.OP4_SQL, "op6_license_scan": licenses.op6_sql(),
            "op8_exact_topk": topk.OP8_SQL, "op11_centroid_clusters": centroids.op11_sql(),
            "op12_fill_in_middle": fim.OP12_SQL, "op13_decontaminate": decontaminate.OP13_SQL}
