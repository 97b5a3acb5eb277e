"""Registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from gable.llm.chat import op6_chat_windows
from gable.llm.decontaminate import op1_decontaminate
from gable.llm.divergence import OP12_SQL, op12_source_divergence
from gable.llm.jaccard_join import op9_jaccard_join
from gable.llm.language_model import op7_language_model
from gable.llm.packing import op11_pack_sequences
from gable.llm.pii import op3_pii
from gable.llm.quality_classifier import op2_quality_classifier
from gable.llm.quality_rules import op8_quality_rules
from gable.llm.records import op4_token_records
from gable.llm.repeats import op10_repeated_bytes
from gable.llm.resampling import OP13_SQL, op13_importance_resampling
from gable.llm.sentencepiece_tokens import op5_sentencepiece

QUERIES = {
    f.__name__: f
    for f in (
        op1_decontaminate, op2_quality_classifier, op3_pii, op4_token_records, op5_sentencepiece,
        op6_chat_windows, op7_language_model, op8_quality_rules, op9_jaccard_join, op10_repeated_bytes,
        op11_pack_sequences, op12_source_divergence, op13_importance_resampling,
    )
}

#: Of those that SQL can express; see the tests for the comparisons of the others with brute force.
ORACLE_SQL: dict[str, str] = {"op12_source_divergence": OP12_SQL, "op13_importance_resampling": OP13_SQL}
