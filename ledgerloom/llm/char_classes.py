"""Letters, numbers and white space as the tokenizers library knows them.

The library's Unicode tables lie between those of Python's ``unicodedata`` (older) and of the ``regex`` package
(newer). Where both agree on a character, so does the library; for the rest it is asked.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import regex
from tokenizers import pre_tokenizers

LETTER, NUMBER, SPACE, WHITE, QUOTE, OTHER = range(6)
_NEWER = (regex.compile(r"\p{L}"), regex.compile(r"\p{N}"))
_WHITE = regex.compile(r"\s")
_SURROGATES = range(0xD800, 0xE000)


def _two_views(char: str) -> tuple[int, int]:
    older = {"L": LETTER, "N": NUMBER}.get(unicodedata.category(char)[0], OTHER)
    newer = LETTER if _NEWER[0].match(char) else NUMBER if _NEWER[1].match(char) else OTHER
    return older, newer


def _ask(char: str) -> int:
    """Class of a character from where the library cuts around it."""
    cuts = [span[0] for _, span in pre_tokenizers.ByteLevel(add_prefix_space=False).pre_tokenize_str(f"a{char}1")]
    return LETTER if 1 not in cuts else NUMBER if 2 not in cuts else OTHER


@lru_cache(maxsize=1 << 16)
def class_of(char: str) -> int:
    if char == " ":
        return SPACE
    if char == "'":
        return QUOTE
    if _WHITE.match(char):
        return WHITE
    older, newer = _two_views(char)
    return older if older == newer else _ask(char)


@lru_cache(maxsize=1)
def newer_characters() -> str:
    """Characters that ``regex`` takes for letters or numbers and the library does not (not assigned yet there)."""
    everything = "".join(chr(c) for c in range(0x80, 0x110000) if c not in _SURROGATES)
    newer = regex.findall(r"[\p{L}\p{N}]", everything)
    return "".join(c for c in newer if _two_views(c)[0] == OTHER and _ask(c) == OTHER)


def as_ranges(chars: str) -> str:
    """Characters as the ranges of a pattern's class."""
    runs: list[list[int]] = []
    for code in sorted(map(ord, chars)):
        if runs and code == runs[-1][1] + 1:
            runs[-1][1] = code
        else:
            runs.append([code, code])
    return "".join(f"\\U{low:08x}-\\U{high:08x}" for low, high in runs)
