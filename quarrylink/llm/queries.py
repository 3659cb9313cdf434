"""The queries of this subpackage and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from .crf_quality import op10_crf_quality
from .html_extract import op5_html_extract
from .line_dedup import op1_line_dedup
from .mixing import op7_source_mixing
from .ngram_join import op3_ngram_join
from .piece_transducer import op9_piece_transducer
from .quality_rules import ORACLE as OP4_SQL
from .quality_rules import op4_quality_rules
from .secret_scan import op2_secret_scan
from .topk_search import ORACLE as OP6_SQL
from .topk_search import op6_topk_search
from .url_filter import op8_url_filter

QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_secret_scan": op2_secret_scan,
    "op3_ngram_join": op3_ngram_join,
    "op4_quality_rules": op4_quality_rules,
    "op5_html_extract": op5_html_extract,
    "op6_topk_search": op6_topk_search,
    "op7_source_mixing": op7_source_mixing,
    "op8_url_filter": op8_url_filter,
    "op9_piece_transducer": op9_piece_transducer,
    "op10_crf_quality": op10_crf_quality,
}
ORACLES = {
    "op4_quality_rules": OP4_SQL,
    "op6_topk_search": OP6_SQL,
}
