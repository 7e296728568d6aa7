"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from quire.llm import topk, warczst
from quire.llm.bytebpe import op3_byte_bpe
from quire.llm.decontam import op1_benchmark_simhash
from quire.llm.idfiles import op8_id_files
from quire.llm.katz import op4_katz_lm
from quire.llm.langhd import op2_language_hd
from quire.llm.licenses import op13_license_rules
from quire.llm.simhash import op6_simhash_near_dup
from quire.llm.toxicity import op7_toxicity_weak
from quire.llm.topk import op10_exact_top_k
from quire.llm.turns import op11_conversation_repair
from quire.llm.urltrust import op9_url_trust
from quire.llm.warczst import op5_warc_dictionary
from quire.llm.whiten import op12_embedding_whitening

QUERIES = {
    "op1_benchmark_simhash": op1_benchmark_simhash,
    "op2_language_hd": op2_language_hd,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_katz_lm": op4_katz_lm,
    "op5_warc_dictionary": op5_warc_dictionary,
    "op6_simhash_near_dup": op6_simhash_near_dup,
    "op7_toxicity_weak": op7_toxicity_weak,
    "op8_id_files": op8_id_files,
    "op9_url_trust": op9_url_trust,
    "op10_exact_top_k": op10_exact_top_k,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_license_rules": op13_license_rules,
}

ORACLE = {
    "op5_warc_dictionary": warczst.SQL,
    "op10_exact_top_k": topk.SQL,
}
