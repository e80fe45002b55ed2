"""Query over ``conversations``."""

from __future__ import annotations

from formmart.llm.common import read_table
from formmart.llm.registry import register


@register("op13_conversation_trie")
def op13_conversation_trie(spark, sf_dir):
    from formmart.llm.conversation_trie import prefix_trie

    return prefix_trie(read_table(spark, sf_dir, "conversations"), heads=8, every=5)
