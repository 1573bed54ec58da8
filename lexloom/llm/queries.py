"""Registry of the training-data queries: name -> function (spark, sf_dir), and name -> DuckDB SQL where there is one."""

from __future__ import annotations

from lexloom.llm import bpe, fingerprint, mixing, pii, quality, simhash, suffixes, token_files, urls, vafile

QUERIES = {
    "op1_simhash": simhash.op1_simhash,
    "op2_mixing": mixing.op2_mixing,
    "op3_token_files": token_files.op3_token_files,
    "op4_top_k": vafile.op4_top_k,
    "op5_suffix_dedup": suffixes.op5_suffix_dedup,
    "op6_bpe": bpe.op6_bpe,
    "op7_fingerprint": fingerprint.op7_fingerprint,
    "op8_urls": urls.op8_urls,
    "op9_pii": pii.op9_pii,
    "op10_quality": quality.op10_quality,
}

ORACLES: dict[str, str] = {
    "op2_mixing": mixing.OP2_SQL,
    "op4_top_k": vafile.OP4_SQL,
    "op8_urls": urls.OP8_SQL,
}
