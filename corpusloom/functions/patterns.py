"""Split patterns and special tokens (fixed values)."""

from __future__ import annotations

# Results depend on these exact patterns.
GPT2_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
GPT4_PATTERN = (
    r"""'(?i:[sdmt]|ll|ve|re)|[^\r\n\p{L}\p{N}]?+\p{L}+|\p{N}{1,3}"""
    r"""| ?[^\s\p{L}\p{N}]++[\r\n]*|\s*[\r\n]|\s+(?!\S)|\s+"""
)
CHAT_PATTERN = (
    r"""'(?i:[sdmt]|ll|ve|re)|[^\r\n\p{L}\p{N}]?+\p{L}+|\p{N}{1,2}"""
    r"""| ?[^\s\p{L}\p{N}]++[\r\n]*|\s*[\r\n]|\s+(?!\S)|\s+"""
)

# Ids are given out in this order, after the last merge.
CHAT_SPECIALS = (
    "<|bos|>",
    "<|user_start|>",
    "<|user_end|>",
    "<|assistant_start|>",
    "<|assistant_end|>",
    "<|python_start|>",
    "<|python_end|>",
    "<|output_start|>",
    "<|output_end|>",
)
BOS = "<|bos|>"

# The ids are not contiguous.
GPT4_SPECIALS = {
    "<|endoftext|>": 100257,
    "<|fim_prefix|>": 100258,
    "<|fim_middle|>": 100259,
    "<|fim_suffix|>": 100260,
    "<|endofprompt|>": 100276,
}


def java_pattern(pattern: str) -> str:
    """``\\s`` and friends are ASCII-only in Java unless the Unicode flag is set."""
    return "(?U)" + pattern


def quote(literal: str) -> str:
    """``literal`` as a Java regex that matches exactly itself."""
    return r"\Q" + literal.replace(r"\E", r"\E\\E\Q") + r"\E"
