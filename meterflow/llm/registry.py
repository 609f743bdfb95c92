"""Registered queries of the subpackage and their DuckDB SQL."""

from __future__ import annotations

from meterflow.llm.alignment import op12_tokenizer_alignment
from meterflow.llm.decontaminate import ORACLE_OP10, op10_benchmark_decontamination
from meterflow.llm.html_text import op9_html_extraction
from meterflow.llm.language_id import op4_language_id
from meterflow.llm.mixing import ORACLE_OP5, op5_source_mixing
from meterflow.llm.ngram_join import ORACLE_OP1, op1_ngram_jaccard_join
from meterflow.llm.packing import op13_best_fit_packing
from meterflow.llm.pq_dedup import ORACLE_OP7, op7_embedding_near_dedup
from meterflow.llm.quality import op2_quality_classifier
from meterflow.llm.suffix_dedup import op3_suffix_array_dedup
from meterflow.llm.toxicity import op6_toxicity
from meterflow.llm.warc import ORACLE_OP8, op8_warc
from meterflow.llm.whitening import op11_embedding_whitening

QUERIES = {f.__name__: f for f in (
    op1_ngram_jaccard_join,
    op2_quality_classifier,
    op3_suffix_array_dedup,
    op4_language_id,
    op5_source_mixing,
    op6_toxicity,
    op7_embedding_near_dedup,
    op8_warc,
    op9_html_extraction,
    op10_benchmark_decontamination,
    op11_embedding_whitening,
    op12_tokenizer_alignment,
    op13_best_fit_packing,
)}

ORACLE: dict[str, str] = {
    "op1_ngram_jaccard_join": ORACLE_OP1,
    "op5_source_mixing": ORACLE_OP5,
    "op7_embedding_near_dedup": ORACLE_OP7,
    "op8_warc": ORACLE_OP8,
    "op10_benchmark_decontamination": ORACLE_OP10,
}
