"""Whole-text encoding with a lower-casing word BPE tokenizer, word by word with a bounded memo.

The tokenizer drops white space and never merges across it, so the ids of a
text are the ids of its white-space separated parts in order. Each different
part is encoded once per worker by the library; a part that is one run of
lower-case letters (the bulk of any text) goes straight to the library's BPE
model, as its normalizer and splitter would leave it unchanged. Everything
else goes through the whole tokenizer.
"""

from __future__ import annotations

import unicodedata

import numpy as np
from tokenizers import Tokenizer

MEMO_ENTRIES = 600_000     # different parts kept per worker; the memo starts anew beyond that
MEMO_PART = 64             # longer parts are encoded but not kept

_WORKER: dict[str, "WordEncoder"] = {}


def _byte_letters() -> list[str]:
    """The printable stand-ins of the 256 bytes in byte-level vocabularies (public GPT-2 rule)."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters, extra = [""] * 256, 0
    for b in range(256):
        if b in shown:
            letters[b] = chr(b)
        else:
            letters[b] = chr(256 + extra)
            extra += 1
    return letters


class WordEncoder:
    """Encode whole texts with a tokenizer file whose splitter drops white space."""

    def __init__(self, path: str):
        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        self.model = self.whole.model
        self.letters = {b: s for b, s in enumerate(_byte_letters())}
        self.width = np.uint16 if self.whole.get_vocab_size() <= 1 << 16 else np.uint32
        self.memo: dict[bytes, bytes] = {}

    def _part(self, part: bytes) -> bytes:
        for n in (2, 1):                      # a word and the comma or stop after it are separate tokens
            if len(part) > n and part[-n:].strip(b".,") == b"" and part[:-n].isalpha():
                return self._of(part[:-n]) + self._of(part[-n:])
        text = part.decode("utf-8", "surrogatepass")
        # letters only, in a form that the normalizer keeps: composed, lower case; sigma's case depends on its place
        low = text.lower() if "Σ" not in text else ""
        if low.isalpha() and low.lower() == low and unicodedata.is_normalized("NFC", low) and (
                text.isascii() or unicodedata.is_normalized("NFC", text)):
            spelled = low if low.isascii() else low.encode().decode("latin-1").translate(self.letters)
            ids = [t.id for t in self.model.tokenize(spelled)]
        else:
            ids = self.whole.encode(text, add_special_tokens=False).ids
        return np.asarray(ids, self.width).tobytes()

    def _of(self, part: bytes) -> bytes:
        got = self.memo.get(part)
        if got is None:
            got = self._part(part)
            if len(part) <= MEMO_PART:
                if len(self.memo) >= MEMO_ENTRIES:
                    self.memo.clear()
                self.memo[part] = got
        return got

    def encode(self, text: str | None) -> np.ndarray:
        """Token ids of a whole text, without special tokens added; NULL is empty."""
        # A-Z are lowered first, as the tokenizer would; its own special strings are lower case and match before that
        parts = (text or "").encode("utf-8", "surrogatepass")
        parts = (parts if b"<|" in parts else parts.lower()).split()
        get = self.memo.get
        ids = [get(p) for p in parts]
        if None in ids:
            ids = [self._of(p) if i is None else i for p, i in zip(parts, ids)]
        return np.frombuffer(b"".join(ids), self.width)


def encoder(path: str) -> WordEncoder:
    """The worker's encoder of one tokenizer file (loaded once, kept between tasks)."""
    if path not in _WORKER:
        _WORKER[path] = WordEncoder(path)
    return _WORKER[path]
