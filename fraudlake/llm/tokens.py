"""Token ids with the public vocabulary files (loaded once per worker).

The byte-level BPE files come in two forms with the same ids; the rank file
is read by the faster encoder. A text that holds a special-token string goes
through the full tokenizer file, which alone knows special tokens.
"""

from __future__ import annotations

import base64
from functools import lru_cache

#: Fixed value: the special token of the byte-level vocabulary.
SPECIAL = "<|endoftext|>"


def vocabulary(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def ranks_encoder(path: str):
    import public_tokenizers
    import tiktoken
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("vocabulary", pat_str=public_tokenizers.PATTERN,
                             mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=2)
def full_tokenizer(path: str):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


def encode(text: str | None, name: str = "byte_bpe_50k") -> list[int]:
    """Ids of a text without added special tokens; none for a null text."""
    if not text:
        return []
    if name == "byte_bpe_50k" and SPECIAL in text:
        return full_tokenizer(vocabulary(name + ".json")).encode(text, add_special_tokens=False).ids
    return ranks_encoder(vocabulary(name + ".tiktoken")).encode_ordinary(text)
