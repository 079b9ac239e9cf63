"""The query of each operator, over its whole table."""

from __future__ import annotations

from clausewise.llm.bpe import op2_bpe
from clausewise.llm.chat import ORACLE as CHAT_ORACLE
from clausewise.llm.chat import op10_chat
from clausewise.llm.decontaminate import op5_decontaminate
from clausewise.llm.line_dedup import op9_line_dedup
from clausewise.llm.merkle import ORACLE as MERKLE_ORACLE
from clausewise.llm.merkle import op12_merkle
from clausewise.llm.near_dedup import op3_near_dedup
from clausewise.llm.pii import op8_pii
from clausewise.llm.prefix_trie import ORACLE as TRIE_ORACLE
from clausewise.llm.prefix_trie import op11_prefix_trie
from clausewise.llm.quality_rules import op7_quality_rules
from clausewise.llm.quality_ranking import op4_quality_ranking
from clausewise.llm.token_files import op6_token_files
from clausewise.llm.toxicity import op1_toxicity
from clausewise.llm.warc import ORACLE as WARC_ORACLE
from clausewise.llm.warc import op13_warc

QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_bpe": op2_bpe,
    "op3_near_dedup": op3_near_dedup,
    "op4_quality_ranking": op4_quality_ranking,
    "op5_decontaminate": op5_decontaminate,
    "op6_token_files": op6_token_files,
    "op7_quality_rules": op7_quality_rules,
    "op8_pii": op8_pii,
    "op9_line_dedup": op9_line_dedup,
    "op10_chat": op10_chat,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_merkle": op12_merkle,
    "op13_warc": op13_warc,
}
ORACLES: dict[str, str] = {
    "op10_chat": CHAT_ORACLE,
    "op11_prefix_trie": TRIE_ORACLE,
    "op12_merkle": MERKLE_ORACLE,
    "op13_warc": WARC_ORACLE,
}
