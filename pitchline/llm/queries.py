"""The registered queries of this subpackage and, where SQL can express one, its SQL."""

from __future__ import annotations

from .ann import op5_ivfpq
from .importance import op4_importance_resampling
from .line_dedup import OP10_SQL, op10_line_dedup
from .mixing import op2_mixing
from .ngram_join import OP1_SQL, op1_ngram_jaccard_join
from .packing import op7_best_fit_packing
from .syncmers import op9_syncmers
from .token_files import op6_token_files
from .toxicity import op3_toxicity
from .warc import OP8_SQL, op8_warc

QUERIES = {
    f.__name__: f
    for f in (
        op1_ngram_jaccard_join,
        op2_mixing,
        op3_toxicity,
        op4_importance_resampling,
        op5_ivfpq,
        op6_token_files,
        op7_best_fit_packing,
        op8_warc,
        op9_syncmers,
        op10_line_dedup,
    )
}
SQL = {"op1_ngram_jaccard_join": OP1_SQL, "op8_warc": OP8_SQL, "op10_line_dedup": OP10_SQL}
