"""Subword ids of whole texts with the vocabulary files of public tokenizers."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from tokenizers import Tokenizer

from quarrylens.llm.common import LOWER_BYTES

# A worker keeps this many words with their ids; beyond it starts anew.
WORDS_KEPT = 400_000
# Words encoded in one call.
TOGETHER = 8192


class WordEncoder:
    """Ids of a text as little-endian 32-bit bytes.

    The vocabulary's pre-tokenizer lower-cases, drops white space and never joins characters
    across it, so a text's ids are its words' ids in order.  Words are encoded once, many in one
    call, and looked up afterwards.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        # Lower-casing first makes fewer different words; texts that may name a special token
        # keep their case, as only its exact spelling counts.
        split = [(t if b"<|" in t else t.translate(LOWER_BYTES)).split() if t else [] for t in texts]
        self.learn(split)
        get = self.known.__getitem__
        return [b"".join(map(get, words)) for words in split]

    def learn(self, texts: list[list[bytes]]) -> None:
        """Make sure that ``known`` holds every word of the texts."""
        if len(self.known) > WORDS_KEPT:
            self.known.clear()
        words = list(set().union(*texts).difference(self.known))
        for at in range(0, len(words), TOGETHER):
            some = words[at : at + TOGETHER]
            decoded = [w.decode("utf-8", "replace") for w in some]
            found = self.tokenizer.encode(" ".join(decoded), add_special_tokens=False)
            ids = np.array(found.ids, "<u4").tobytes()
            places = np.fromiter((begin for begin, _ in found.offsets), np.int64, len(found.ids))
            ends = np.cumsum(np.fromiter(map(len, decoded), np.int64, len(some)) + 1)
            cuts = (4 * np.searchsorted(places, ends)).tolist()
            first = 0
            for word, last in zip(some, cuts):
                self.known[word] = ids[first:last]
                first = last


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)
