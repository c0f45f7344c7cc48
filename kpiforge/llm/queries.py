"""Registry of the training-data queries: each applies its operator, with
production parameters, to its whole table."""

from __future__ import annotations

from kpiforge.llm.ann import op1_multiprobe_lsh
from kpiforge.llm.forest import OP5_SQL, op5_lsh_forest
from kpiforge.llm.golay import op11_golay_simhash
from kpiforge.llm.langid import op2_byte_cnn_language
from kpiforge.llm.linededup import OP9_SQL, op9_line_dedup
from kpiforge.llm.mixing import op4_pfair_mixing
from kpiforge.llm.periods import OP13_SQL, op13_baier_runs
from kpiforge.llm.phrases import OP12_SQL, op12_era_phrases
from kpiforge.llm.pii import op7_information_sanitisation
from kpiforge.llm.sharding import op3_label_propagation
from kpiforge.llm.templates import op6_template_decontamination
from kpiforge.llm.toxicity import op10_toxicity_grammar
from kpiforge.llm.warc import OP8_SQL, op8_seekable_bundles

QUERIES = {f.__name__: f for f in (
    op1_multiprobe_lsh, op2_byte_cnn_language, op3_label_propagation, op4_pfair_mixing, op5_lsh_forest,
    op6_template_decontamination, op7_information_sanitisation, op8_seekable_bundles, op9_line_dedup, op10_toxicity_grammar,
    op11_golay_simhash, op12_era_phrases, op13_baier_runs)}

#: The others cannot be said in SQL; tests compare them with brute force.
ORACLE = {"op5_lsh_forest": OP5_SQL, "op8_seekable_bundles": OP8_SQL, "op9_line_dedup": OP9_SQL,
          "op12_era_phrases": OP12_SQL, "op13_baier_runs": OP13_SQL}
