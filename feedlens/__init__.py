"""feedlens: review-feedback analytics expressed as Spark DataFrame plans.

Sub-packages
------------
sources    readers for landing data (JSON reviews, app-store feed pages, store
           exports, CSV / JSON report files) and the writers (sinks)
functions  column expressions: PII masking, date parsing, tokens, lexicons
operators  relational operators over the canonical review table
plans      the registered query catalogue and its DuckDB oracle
streaming  the same operators applied to an incremental landing folder
"""

from feedlens.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
