"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from millrace.llm.decontamination import OP9_SQL, op9_query
from millrace.llm.embedding_pq import op7_query
from millrace.llm.fill_in_middle import OP13_SQL, op13_query
from millrace.llm.license_scan import OP12_SQL, op12_query
from millrace.llm.line_dedup import op8_query
from millrace.llm.ngram_jaccard import op10_query
from millrace.llm.packing import op4_query
from millrace.llm.quality_mil import op1_query
from millrace.llm.secret_forest import op5_query
from millrace.llm.source_divergence import OP11_SQL, op11_query
from millrace.llm.suffix_dedup import op3_query
from millrace.llm.url_rules import OP2_SQL, op2_query
from millrace.llm.warc import OP6_SQL, op6_query

QUERIES = {
    "op1_quality_mil": op1_query,
    "op2_url_rules": op2_query,
    "op3_suffix_dedup": op3_query,
    "op4_packing": op4_query,
    "op5_secret_forest": op5_query,
    "op6_warc": op6_query,
    "op7_embedding_pq": op7_query,
    "op8_line_dedup": op8_query,
    "op9_decontamination": op9_query,
    "op10_ngram_jaccard": op10_query,
    "op11_source_divergence": op11_query,
    "op12_license_scan": op12_query,
    "op13_fill_in_middle": op13_query,
}

SQL = {"op2_url_rules": OP2_SQL, "op6_warc": OP6_SQL, "op9_decontamination": OP9_SQL, "op11_source_divergence": OP11_SQL, "op12_license_scan": OP12_SQL, "op13_fill_in_middle": OP13_SQL}
