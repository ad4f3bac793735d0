"""Token ids of whole texts from a tokenizer that never joins words, through a bounded memory of words.

The vocabulary file ``word_bpe_49k.json`` drops white space and splits at it before merging, so a text's ids are the ids of its
blank-separated words in order.  Words met before are looked up; new ones go to the library.
"""

from __future__ import annotations

from array import array

import numpy as np

from stratamart.llm.common import Memory


class WordIds(Memory):
    """The ids of words, as bytes of little-endian uint32."""

    LIMIT = 3 << 17

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.merge = self.tokenizer.model.tokenize
        # Byte-level vocabularies spell printable bytes as themselves and the others, in order, from U+0100 on.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.spelling = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in plain)}

    def make(self, word: str) -> bytes:
        if len(word) > 1 and word[-1] in ".," and word[-2] < "\u0180" and word[-2].lower().isalpha():
            return self[word[:-1]] + self[word[-1]]  # letters and other characters are encoded apart
        if word.isascii() and word.isalpha() and not word.islower():
            return self[word.lower()]
        if word.isalpha() and max(word) < "\u0130":
            # Letters that no normalisation touches but lower case: straight to the merges, with bytes spelled as the vocabulary spells them.
            low = word.lower()
            spelled = low if low.isascii() else low.encode().decode("latin-1").translate(self.spelling)
            return array("I", [t.id for t in self.merge(spelled)]).tobytes()
        return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def encode(self, text: str) -> np.ndarray:
        self.renew()
        # No token and no normalisation reaches across these.
        if text.isascii():
            text = text.lower()  # the vocabulary has no capitals
        words = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        return np.frombuffer(b"".join(map(self.__getitem__, words)), dtype="<u4")
