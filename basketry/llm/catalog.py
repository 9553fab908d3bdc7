"""Registered queries of the package and their DuckDB SQL."""

from __future__ import annotations

from basketry.llm.bpe import op6_bpe
from basketry.llm.decontamination import OP7_SQL, op7_decontamination
from basketry.llm.divergence import OP12_SQL, op12_divergence
from basketry.llm.jaccardjoin import OP8_SQL, op8_jaccard_join
from basketry.llm.langid import op9_language_id
from basketry.llm.linededup import OP4_SQL, op4_line_dedup
from basketry.llm.lm import op5_lm_score
from basketry.llm.minhash import OP11_SQL, op11_minhash
from basketry.llm.pii import OP3_SQL, op3_pii
from basketry.llm.quality import OP2_SQL, op2_quality
from basketry.llm.secrets import OP1_SQL, op1_secrets
from basketry.llm.sharding import op10_sharding
from basketry.llm.whitening import op13_whitening

QUERIES = {
    "op1_secrets": op1_secrets,
    "op2_quality": op2_quality,
    "op3_pii": op3_pii,
    "op4_line_dedup": op4_line_dedup,
    "op5_lm_score": op5_lm_score,
    "op6_bpe": op6_bpe,
    "op7_decontamination": op7_decontamination,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_language_id": op9_language_id,
    "op10_sharding": op10_sharding,
    "op11_minhash": op11_minhash,
    "op12_divergence": op12_divergence,
    "op13_whitening": op13_whitening,
}

ORACLE_SQL: dict[str, str] = {
    "op1_secrets": OP1_SQL,
    "op2_quality": OP2_SQL,
    "op3_pii": OP3_SQL,
    "op4_line_dedup": OP4_SQL,
    "op7_decontamination": OP7_SQL,
    "op8_jaccard_join": OP8_SQL,
    "op11_minhash": OP11_SQL,
    "op12_divergence": OP12_SQL,
}
