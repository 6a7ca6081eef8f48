"""The registered queries of the subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from citeflow.llm.brown_lm import op1_brown_class_lm
from citeflow.llm.conversation_repair import op11_conversation_repair
from citeflow.llm.forced_bpe import op10_forced_boundary_bpe
from citeflow.llm.huffman_ids import op13_huffman_ids
from citeflow.llm.language_id import op2_bayes_language_id
from citeflow.llm.licenses import op3_license_scan
from citeflow.llm.line_templates import op9_log_template_lines
from citeflow.llm.multi_index import op6_inverted_multi_index
from citeflow.llm.oracles import LINES, PARTENUM, PHRASES, REPAIR
from citeflow.llm.packing import op4_best_fit_packing
from citeflow.llm.partenum import op5_partenum_join
from citeflow.llm.phrases import op12_phrase_tiles
from citeflow.llm.suffix_dedup import op7_suffix_array_dedup
from citeflow.llm.syncmers import op8_closed_syncmers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_brown_class_lm": op1_brown_class_lm,
    "op2_bayes_language_id": op2_bayes_language_id,
    "op3_license_scan": op3_license_scan,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_partenum_join": op5_partenum_join,
    "op6_inverted_multi_index": op6_inverted_multi_index,
    "op7_suffix_array_dedup": op7_suffix_array_dedup,
    "op8_closed_syncmers": op8_closed_syncmers,
    "op9_log_template_lines": op9_log_template_lines,
    "op10_forced_boundary_bpe": op10_forced_boundary_bpe,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_phrase_tiles": op12_phrase_tiles,
    "op13_huffman_ids": op13_huffman_ids,
    "pipeline": corpus_pipeline.run,
}
ORACLES: dict[str, str] = {"op5_partenum_join": PARTENUM, "op9_log_template_lines": LINES,
                           "op11_conversation_repair": REPAIR, "op12_phrase_tiles": PHRASES}
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
