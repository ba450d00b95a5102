"""The queries of this subpackage, by name, and SQL for those that SQL can express."""

from __future__ import annotations

from tidemill.llm import chat_format, collocations, decontaminate, substring_dedup
from tidemill.llm.bpe import op2_bpe
from tidemill.llm.chat_format import op11_chat
from tidemill.llm.collocations import op13_collocations
from tidemill.llm.decontaminate import op8_decontaminate
from tidemill.llm.language_id import op3_language_id
from tidemill.llm.line_dedup import op1_line_dedup
from tidemill.llm.periodic_runs import op12_runs
from tidemill.llm.secret_scan import op10_secrets
from tidemill.llm.sharding import op6_sharding
from tidemill.llm.simhash_dedup import op5_simhash
from tidemill.llm.substring_dedup import op4_substring
from tidemill.llm.token_counts import op9_token_counts
from tidemill.llm.vector_search import op7_vector_search

QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_bpe": op2_bpe,
    "op3_language_id": op3_language_id,
    "op4_substring": op4_substring,
    "op5_simhash": op5_simhash,
    "op6_sharding": op6_sharding,
    "op7_vector_search": op7_vector_search,
    "op8_decontaminate": op8_decontaminate,
    "op9_token_counts": op9_token_counts,
    "op10_secrets": op10_secrets,
    "op11_chat": op11_chat,
    "op12_runs": op12_runs,
    "op13_collocations": op13_collocations,
}

SQL: dict[str, str] = {
    "op4_substring": substring_dedup.SQL,
    "op8_decontaminate": decontaminate.SQL,
    "op11_chat": chat_format.SQL,
    "op13_collocations": collocations.SQL,
}
