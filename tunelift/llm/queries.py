"""The registered queries of the training-data operators, and the SQL of those that SQL
can express."""

from __future__ import annotations

from tunelift.llm.chunk_dedup import OP6_SQL, op6_chunk_recipe_dedup
from tunelift.llm.hard_negatives import op11_hard_negatives
from tunelift.llm.imatch import op3_imatch_fingerprints
from tunelift.llm.jaccard import op2_ngram_jaccard_join
from tunelift.llm.langid import op5_compression_langid
from tunelift.llm.line_dedup import op4_fuzzy_line_dedup
from tunelift.llm.mixing import OP7_SQL, op7_water_filling_mix
from tunelift.llm.packing import op1_best_fit_packing
from tunelift.llm.quality import op9_knn_quality
from tunelift.llm.secret_scan import op13_secret_scan
from tunelift.llm.suffix_dedup import op8_suffix_array_dedup
from tunelift.llm.vector_codes import op12_vector_codes
from tunelift.llm.warc import OP10_SQL, op10_warc_dictionary

QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_ngram_jaccard_join": op2_ngram_jaccard_join,
    "op3_imatch_fingerprints": op3_imatch_fingerprints,
    "op4_fuzzy_line_dedup": op4_fuzzy_line_dedup,
    "op5_compression_langid": op5_compression_langid,
    "op6_chunk_recipe_dedup": op6_chunk_recipe_dedup,
    "op7_water_filling_mix": op7_water_filling_mix,
    "op8_suffix_array_dedup": op8_suffix_array_dedup,
    "op9_knn_quality": op9_knn_quality,
    "op10_warc_dictionary": op10_warc_dictionary,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_vector_codes": op12_vector_codes,
    "op13_secret_scan": op13_secret_scan,
}

ORACLES = {
    "op6_chunk_recipe_dedup": OP6_SQL,
    "op7_water_filling_mix": OP7_SQL,
    "op10_warc_dictionary": OP10_SQL,
}
