"""Byte-pair ids of whole texts, by a public vocabulary file named by path."""

from __future__ import annotations

import base64
import re
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

#: The vocabulary of byte_bpe_50k.json as ranks: the same ids of plain text, several times as fast.
VOCABULARY = "byte_bpe_50k.tiktoken"
#: The fast library fails on white space of a million characters; texts with runs of so many take the other.
LONG_RUN = 250_000


@lru_cache(maxsize=2)
def encoder(path: str) -> Callable[[str | None], bytes]:
    """Ids of a text as little-endian unsigned 32-bit bytes; loaded once for each worker process.

    They are those of the vocabulary's JSON file with ``add_special_tokens=False``, where
    an added token inside a text has an id of its own.  Texts without one, which is
    nearly all, take the ranks.
    """
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    encode = tiktoken.Encoding("given", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    other = Tokenizer.from_file(path.removesuffix(".tiktoken") + ".json")  # lies beside the ranks
    added = [token.content for token in other.get_added_tokens_decoder().values()]

    def ids(text: str | None) -> bytes:
        if not text:
            return b""
        marked = any(token in text for token in added)
        if marked or (len(text) >= LONG_RUN and any(m.end() - m.start() >= LONG_RUN for m in re.finditer(r"\s+", text))):
            return np.array(other.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return np.array(encode(text), "<u4").tobytes()

    return ids


def vocabulary_path() -> str:
    """Where the installed public vocabulary lies."""
    return public_tokenizers.path(VOCABULARY)
