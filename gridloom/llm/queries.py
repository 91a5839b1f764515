"""All queries of the folder, by name."""

from gridloom.llm import (  # noqa: F401
    q01_shards, q02_tokens, q03_near, q04_toxicity, q05_chat,
    q06_brown, q07_benchmark, q08_lines, q09_quality, q10_packing,
    q11_merkle, q12_suffix, q13_trie)
from gridloom.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
