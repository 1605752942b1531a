"""Token ids of whole texts with a public tokenizer file.

The word BPE drops white space and never joins across it, so a text's ids are
the ids of its white-space separated words in order.  Each worker process keeps
the ids of words it has met.  A new word of Latin-1 letters, with or without
signs after it, is what the tokenizer's normaliser and splitter leave alone (but
for case): its two parts go straight to the tokenizer's model; any other word
goes through the whole tokenizer, and so do texts with special-token strings.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator

import numpy as np

from cabline.llm._common import per_process

CACHED_WORDS = 600_000
_LETTERS_SIGNS = re.compile("([a-zß-öø-ÿ]+)([.,!?;:%#$*&|]*)")
_LATIN_1 = "\u0100"


def byte_signs() -> dict[int, str]:
    """Byte-level alphabet: printable Latin-1 bytes stand for themselves, the others for
    the code points from 256 in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordIds(dict):
    """word -> its ids as little-endian 32-bit integers, for one tokenizer file."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        signs = byte_signs()
        self.spelled = {c: "".join(signs[b] for b in chr(c).encode()) for c in range(256)}

    def _part(self, letters: str) -> bytes:
        if not letters.isascii():
            letters = letters.translate(self.spelled)
        return b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(letters)])

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= CACHED_WORDS:
            self.clear()
        text = word.decode()
        plain = _LETTERS_SIGNS.fullmatch(text.lower()) if max(text) < _LATIN_1 else None
        if plain:
            letters, signs = plain.groups()
            ids = self._part(letters)
            if signs:
                # signs recur: looked up as a word of their own
                ids += self[signs.encode()]
        else:
            ids = self.whole(text)
        self[word] = ids
        return ids

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: bytes) -> bytes:
        if b"<|" in text:
            return self.whole(text.decode())
        return b"".join(map(self.__getitem__, text.lower().split()))


def encode_texts(path: str, texts: Iterable[bytes | None], end_id: int) -> Iterator[bytes]:
    """Per text its ids and ``end_id`` as little-endian 32-bit integers; null is empty."""
    words = per_process(f"word_ids:{path}", lambda: WordIds(path))
    end = np.array([end_id], "<u4").tobytes()
    for text in texts:
        yield words.encode(text or b"") + end


def word_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def piece_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")
