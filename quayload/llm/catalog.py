"""Every query of the training-data operators, by name."""

from quayload.llm import (  # noqa: F401
    byte_bpe,
    chat_format,
    collocations,
    exact_dedup,
    html_extract,
    merkle,
    ngram_join,
    packing,
    quality_rules,
    substring_dedup,
    suffix_dedup,
    token_output,
    warc,
)
from quayload.llm.registry import LLM_REGISTRY

__all__ = ["LLM_REGISTRY"]
