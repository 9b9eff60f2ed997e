"""Token ids of whole texts inside Spark tasks, equal to those of the tokenizers library."""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import numpy as np

VOCABULARY = "byte_bpe_50k"
SPECIAL = {"<|endoftext|>": 50256}
#: Texts that are only of these characters, without very long runs, give equal ids in both libraries.
PLAIN = re.compile(r"[\x00-ɏͰ-ϿЀ-џ‐-‧‰-›€ぁ-ゖァ-ヺ一-龥가-힣]*")
LONG = re.compile(r"\S{1500}|\s{1500}")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def encoder(vocabulary_name: str = VOCABULARY):
    """A function from texts to arrays of ids, special strings included as the library reads them.

    The byte-level vocabulary is read as ranks, which is several times faster; other characters than PLAIN ones,
    whose class can differ between Unicode versions, and very long runs go to the tokenizers library itself.
    """
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    lines = open(vocabulary(f"{vocabulary_name}.tiktoken"), "rb").read().splitlines()
    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)
    exact = Tokenizer.from_file(vocabulary(f"{vocabulary_name}.json"))

    def encode(text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, np.uint32)
        if PLAIN.fullmatch(text) and not LONG.search(text):
            return np.array(fast.encode(text, allowed_special="all"), np.uint32)
        return np.array(exact.encode(text, add_special_tokens=False).ids, np.uint32)

    return encode
