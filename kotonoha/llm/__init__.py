"""Operators of a training-data pipeline; nothing else in the library imports them."""

from kotonoha.llm.align import align_tokenizers
from kotonoha.llm.binpack import pack_best_fit
from kotonoha.llm.decontaminate import contained_items
from kotonoha.llm.html import extract_pages
from kotonoha.llm.langid import identify
from kotonoha.llm.licenses import scan_licenses
from kotonoha.llm.lines import apply_bitmaps, drop_repeated_lines, keep_bitmaps
from kotonoha.llm.packing import pack_documents
from kotonoha.llm.quality import judge_quality
from kotonoha.llm.sharding import assign_shards
from kotonoha.llm.simhash import near_duplicates
from kotonoha.llm.toxicity import score_toxicity
from kotonoha.llm.vectorcodes import compress_vectors

__all__ = [
    "align_tokenizers",
    "apply_bitmaps",
    "assign_shards",
    "compress_vectors",
    "contained_items",
    "drop_repeated_lines",
    "extract_pages",
    "identify",
    "judge_quality",
    "keep_bitmaps",
    "near_duplicates",
    "pack_best_fit",
    "pack_documents",
    "scan_licenses",
    "score_toxicity",
]
