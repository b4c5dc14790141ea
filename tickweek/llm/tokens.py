"""Token ids of whole texts by a public byte-level BPE vocabulary.

``byte_bpe_50k.json`` (tokenizers) and ``byte_bpe_50k.tiktoken`` are the same
vocabulary, split pattern and merges. The second library gives the same ids
several times faster; texts with very long unbroken runs, on which its merging
takes time with the square of the run, go through the first.
"""

from __future__ import annotations

import base64

import numpy as np

SEPARATOR = 0  # the id appended to every document
LONG_RUN = 400  # characters without white space
SPECIAL = {"<|endoftext|>": 50256}  # the vocabulary's only special token


class Encoder:
    """Ids of texts as ``Tokenizer.encode(text, add_special_tokens=False)`` gives them; one per Python worker."""

    def __init__(self, path: str | None = None, ranks: str | None = None) -> None:
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(path or public_tokenizers.path("byte_bpe_50k.json"))
        with open(ranks or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
            table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.fast = tiktoken.Encoding(
            "byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens=SPECIAL
        )
        self.special = set(SPECIAL)

    def ids(self, text: str | None) -> np.ndarray:
        """The ids of one text (none for NULL or empty), without the separator."""
        if not text:
            return np.zeros(0, np.uint32)
        if len(max(text.split() or [""], key=len)) > LONG_RUN:
            return np.array(self.exact.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.fast.encode_to_numpy(text, allowed_special=self.special, disallowed_special=())
