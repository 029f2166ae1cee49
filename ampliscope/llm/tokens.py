"""Token ids of whole texts by a public tokenizer, word by word.

The tokenizer lower-cases, drops white space, never joins across it, and what it does
with a word does not depend on the words around it. So a text's ids are the ids of
its words one after the other, and the tokenizers library encodes a word only where
its ids aren't known. Signs at the end of a word are cut off first where the
tokenizer would do so, which leaves fewer distinct words. The table of words is
bounded: the words of the last `MOST_WORDS` new ones stay, and those used since.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterable
from functools import cache

import numpy as np

#: New words after which those not used since are forgotten.
MOST_WORDS = 300_000
VOCABULARY = "word_bpe_49k.json"
#: Signs that end a word; after an ASCII letter or digit they are a token of their own.
ENDING = re.compile(rb"[.,!?;:$%&*#|](?<=[a-z0-9].)[.,!?;:$%&*#|]*(?=[ \t-\r]|$)")
#: Small letters below this are one piece for the model, and no two of them are composed to another.
PLAIN = "\u0250"
#: The characters that stand for bytes in the model's vocabulary, where they aren't those of Latin-1.
OF_BYTES = {b: 256 + i for i, b in enumerate((*range(33), *range(127, 161), 173))}
#: What may start a special token, which is found before lower-casing.
SPECIAL = b"<|"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Words(dict):
    """The ids of words as bytes of little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, most: int = MOST_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.most, self.old = Tokenizer.from_file(path), most, {}
        self.model = self.tokenizer.model

    def __missing__(self, word: bytes) -> bytes:
        packed = self.old.get(word)
        if packed is None:
            text = word.decode()
            if text.isalpha() and text.islower() and max(text) < PLAIN:
                piece = text if text.isascii() else word.decode("latin-1").translate(OF_BYTES)
                ids = [t.id for t in self.model.tokenize(piece)]
            else:
                ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[word] = packed
        return packed


class Encoder:
    def __init__(self, path: str, most: int = MOST_WORDS):
        self.ids_of = Words(path, most).__getitem__

    def __call__(self, texts: Iterable[bytes]) -> Iterable[np.ndarray]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        for text in texts:
            if SPECIAL not in text:
                text = ENDING.sub(rb" \g<0>", text.lower())  # of bytes: A-Z only
            # of bytes: at the six ASCII spaces only
            yield np.frombuffer(b"".join(map(self.ids_of, text.split())), dtype="<u4")


@cache
def encoder(path: str) -> Encoder:
    """One encoder for each Python worker and vocabulary."""
    return Encoder(path)
