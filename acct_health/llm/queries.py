"""The queries of this subpackage, by name, and their SQL."""

from __future__ import annotations

from acct_health.llm.bpe import op4_bpe
from acct_health.llm.chat import OP2_SQL, op2_chat
from acct_health.llm.collocations import OP12_SQL, op12_collocations
from acct_health.llm.decontamination import op10_decontamination
from acct_health.llm.embeddings import OP1_SQL, op1_embeddings
from acct_health.llm.language import op7_language
from acct_health.llm.lexical_search import OP13_SQL, op13_lexical_search
from acct_health.llm.pii import op8_pii
from acct_health.llm.sharding import op9_sharding
from acct_health.llm.simhash import op6_simhash
from acct_health.llm.suffix_dedup import OP11_SQL, op11_suffix_dedup
from acct_health.llm.token_binary import op3_token_binary
from acct_health.llm.token_counts import op5_token_counts

QUERIES = {
    "op1_embeddings": op1_embeddings,
    "op2_chat": op2_chat,
    "op3_token_binary": op3_token_binary,
    "op4_bpe": op4_bpe,
    "op5_token_counts": op5_token_counts,
    "op6_simhash": op6_simhash,
    "op7_language": op7_language,
    "op8_pii": op8_pii,
    "op9_sharding": op9_sharding,
    "op10_decontamination": op10_decontamination,
    "op11_suffix_dedup": op11_suffix_dedup,
    "op12_collocations": op12_collocations,
    "op13_lexical_search": op13_lexical_search,
}

ORACLE_SQL: dict[str, str] = {
    "op1_embeddings": OP1_SQL,
    "op2_chat": OP2_SQL,
    "op11_suffix_dedup": OP11_SQL,
    "op12_collocations": OP12_SQL,
    "op13_lexical_search": OP13_SQL,
}
