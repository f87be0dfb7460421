"""Pre-tokens of the word-level BPE vocabulary, shared by counting and packing.

Texts made only of the characters in ``_PLAIN`` are split with the
vocabulary's own pattern directly: on those characters NFC changes nothing,
lower-casing is one to one, and the classes of the pattern do not depend on a
Unicode version.  Every other text goes through the library's own normaliser
and pre-tokeniser, so both ways give the library's pre-tokens.
"""

from __future__ import annotations

import re

import regex

#: characters for which the direct way is proven equal
_NOT_PLAIN = re.compile("[^\t\n\r -~¡-¬®-ÿŒœ]")
_SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
SPECIAL = ("<|startoftext|>", "<|endoftext|>")


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def plain(text: str) -> bool:
    return _NOT_PLAIN.search(text) is None and "<|" not in text


def chunks_plain(text: str) -> list[str]:
    """Lower-cased pieces of a plain text between white space; no pre-token spans two of them."""
    return text.lower().split()


def split_chunk(chunk: str) -> list[str]:
    """Pre-tokens of such a piece, before the byte alphabet."""
    return _SPLIT.findall(chunk)


def load_tokenizer(path: str):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t
