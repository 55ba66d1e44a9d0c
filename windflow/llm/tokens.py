"""Token ids of whole texts by a public tokenizer file, a word at a time.

The word-level tokenizer drops white space and never lets a token cross it, so the ids of a text are
those of its words in order. A worker remembers the ids of the words it has met, in two generations
of bounded size, and calls the tokenizer only for others.
"""

from __future__ import annotations

import os
import unicodedata

# Words a worker remembers in one generation; there are two.
REMEMBERED = 400_000

_coders: dict[str, "Coder"] = {}


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


# Byte-level vocabularies write a byte as a character: printable ones as themselves, others from 256.
_PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_OTHERS = [b for b in range(256) if b not in _PRINTED]
AS_CHARACTER = {b: chr(256 + k) for k, b in enumerate(_OTHERS)}
TAIL = "".join(chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum())
LATIN_END = "\u0250"


class Coder:
    """Little-endian 32-bit ids of texts, without special tokens.

    Words of Latin letters with punctuation behind them, nearly all, are lower-cased and split here;
    any other word passes the tokenizer's own normaliser and splitter.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.mark = os.path.commonprefix(self.special)
        self.packed = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def encode(self, text: bytes) -> bytes:
        words = text.split()
        young = self.young
        try:
            return b"".join([young[w] for w in words])
        except KeyError:
            pass
        old, word_ids = self.old, self._word
        for w in words:
            if w not in young:
                young[w] = old[w] if w in old else word_ids(w)
        ids = b"".join([young[w] for w in words])
        if len(young) > REMEMBERED:
            self.old, self.young = young, {}
        return ids

    def _word(self, word: bytes) -> bytes:
        if self.mark in word and any(s in word for s in self.special):
            ids = self.tokenizer.encode(word.decode(), add_special_tokens=False).ids
            return b"".join([self.packed[i] for i in ids])
        text = word.decode()
        if text.isascii():
            core = text.rstrip(TAIL).lower()
            if core.isalpha():
                tail = text[len(core):]
                return self._part(core) + self._part(tail) if tail else self._part(core)
        elif max(text) < LATIN_END:
            composed = unicodedata.normalize("NFC", text)
            core = composed.rstrip(TAIL)
            tail, core = composed[len(core):], core.lower()
            if core.isalpha():
                core = core.encode().decode("latin-1").translate(AS_CHARACTER)
                return self._part(core) + self._part(tail) if tail else self._part(core)
        whole = self.tokenizer.normalizer.normalize_str(text)
        return b"".join([self._part(p) for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(whole)])

    def _part(self, part: str) -> bytes:
        found = self.parts.get(part)
        if found is None:
            if len(self.parts) > REMEMBERED:
                self.parts.clear()
            packed = self.packed
            found = self.parts[part] = b"".join([packed[t.id] for t in self.tokenizer.model.tokenize(part)])
        return found


def coder(path: str) -> Coder:
    if path not in _coders:
        _coders[path] = Coder(path)
    return _coders[path]
