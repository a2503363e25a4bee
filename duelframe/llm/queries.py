"""The queries of the corpus operators, and SQL for those that SQL can express."""

from __future__ import annotations

from duelframe.llm import collocations, divergence, mixing, rpforest, topk, urlfilter, warc
from duelframe.llm.common import written_out
from duelframe.llm.decontam import op6_decontamination
from duelframe.llm.langid import op10_language_id
from duelframe.llm.quality import op3_quality_classifier
from duelframe.llm.simhash import op9_simhash_near_dedup
from duelframe.llm.tokencount import op5_token_counts
from duelframe.llm.toxicity import op4_toxicity

_EACH = {
    "op1_warc": warc.op1_warc,
    "op2_source_mixing": mixing.op2_source_mixing,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_toxicity": op4_toxicity,
    "op5_token_counts": op5_token_counts,
    "op6_decontamination": op6_decontamination,
    "op7_embedding_near_dedup": rpforest.op7_embedding_near_dedup,
    "op8_url_filters": urlfilter.op8_url_filters,
    "op9_simhash_near_dedup": op9_simhash_near_dedup,
    "op10_language_id": op10_language_id,
    "op11_top_k": topk.op11_top_k,
    "op12_phrase_collocations": collocations.op12_phrase_collocations,
    "op13_source_divergence": divergence.op13_source_divergence,
}
QUERIES = {name: written_out(query) for name, query in _EACH.items()}

ORACLE_SQL = {"op1_warc": warc.SQL, "op2_source_mixing": mixing.SQL, "op7_embedding_near_dedup": rpforest.SQL, "op8_url_filters": urlfilter.SQL, "op11_top_k": topk.SQL, "op12_phrase_collocations": collocations.SQL, "op13_source_divergence": divergence.SQL}
