"""The registered queries of this subpackage, one for each operator."""

from __future__ import annotations

from histevents.llm.cap_neardup import op6_cap_neardup
from histevents.llm.decontaminate import op3_decontamination
from histevents.llm.hard_negatives import op13_hard_negatives
from histevents.llm.html_extract import op2_html_extract
from histevents.llm.lexical_search import op11_lexical_search
from histevents.llm.line_dedup import op1_line_dedup
from histevents.llm.mixing import op4_mixing
from histevents.llm.oracles import ORACLE_SQL
from histevents.llm.pii import op10_pii
from histevents.llm.quality import op5_quality
from histevents.llm.simhash import op9_simhash
from histevents.llm.substring_dedup import op8_substring_dedup
from histevents.llm.token_files import op7_token_files
from histevents.llm.warc_archive import op12_warc_archive

QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_html_extract": op2_html_extract,
    "op3_decontamination": op3_decontamination,
    "op4_mixing": op4_mixing,
    "op5_quality": op5_quality,
    "op6_cap_neardup": op6_cap_neardup,
    "op7_token_files": op7_token_files,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_simhash": op9_simhash,
    "op10_pii": op10_pii,
    "op11_lexical_search": op11_lexical_search,
    "op12_warc_archive": op12_warc_archive,
    "op13_hard_negatives": op13_hard_negatives,
}

__all__ = ["ORACLE_SQL", "QUERIES"]
