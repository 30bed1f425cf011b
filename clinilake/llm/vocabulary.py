"""Byte-level BPE vocabularies: whole texts to ids and back.

The ids are those of the ``tokenizers`` library for the vocabulary's file.
Most texts go through ``tiktoken``, which merges the same pairs in the same
order several times faster.  That needs a vocabulary whose ids follow the order
of its merges (checked when it is loaded) and a text in which both libraries
cut the same words: Latin characters, long in all versions of Unicode, and no
special token.  All other texts go through ``tokenizers`` itself.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np

#: Characters that are encoded in one call.
STRETCH = 1 << 18

# Fixed value: the words of byte-level BPE, as both libraries define them.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_NOT_LATIN = re.compile("[^\x00-ɏ]")
#: A sure break: no word of the pattern reaches over the place between an ASCII
#: letter and a space, and nothing before it changes what follows.
BREAK = re.compile(rb"[A-Za-z](?= )")
_TEXT_BREAK = re.compile(r"[A-Za-z](?= )")


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies:
    printable Latin-1 bytes stand for themselves, the others for U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


def _merges_follow_ids(file: dict) -> bool:
    """Whether ranks by id give the merges of the file, without other rules."""
    model, words = file["model"], file.get("pre_tokenizer") or {}
    if (file.get("normalizer") or words.get("type") != "ByteLevel" or words.get("add_prefix_space")
            or not words.get("use_regex", True) or model.get("type", "BPE") != "BPE"):
        return False
    if any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix",
                                  "byte_fallback", "ignore_merges")):
        return False
    pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
    ids = [model["vocab"].get(a + b, -1) for a, b in pairs]
    return all(a < b for a, b in zip(ids, ids[1:])) and (not ids or ids[0] >= 256)


class Vocabulary:
    """The ids and bytes of one vocabulary file, for one Python worker."""

    def __init__(self, path: str) -> None:
        self.path = path
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        back = {c: b for b, c in enumerate(byte_letters())}
        self.special = {t["content"]: t["id"] for t in file.get("added_tokens", [])}
        table = [b""] * (1 + max([*file["model"]["vocab"].values(), *self.special.values()]))
        for token, i in file["model"]["vocab"].items():
            table[i] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
        ranks = {b: i for i, b in enumerate(table) if b}
        for content, i in self.special.items():
            table[i] = content.encode()
        self.table = table
        self.lengths = np.array([len(b) for b in table], np.int64)
        self.dtype = np.dtype("<u2") if len(table) <= 1 << 16 else np.dtype("<u4")
        self._fast = None
        if _merges_follow_ids(file):
            import tiktoken
            self._fast = tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _library(self):
        """The ``tokenizers`` library's own tokenizer, loaded where a text needs it."""
        return _tokenizer(self.path)

    def _alike(self, text: str) -> bool:
        return self._fast is not None and not _NOT_LATIN.search(text) and not any(s in text for s in self.special)

    def encode_one(self, text: str) -> np.ndarray:
        """The ids of a whole text; a long one goes in stretches between sure breaks."""
        if self._alike(text):
            parts = [self._fast.encode_to_numpy(t).astype(self.dtype) for t in stretches(text)]
        else:
            parts = [np.array(self._library().encode(t, add_special_tokens=False).ids, self.dtype)
                     for t in stretches(text)]
        return parts[0] if len(parts) == 1 else np.concatenate(parts)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [self.encode_one(t) for t in texts]

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.table.__getitem__, ids.tolist()))


def stretches(text: str) -> list[str]:
    """The text cut at sure breaks into parts of ``STRETCH`` characters and a bit."""
    out, start = [], 0
    while len(text) - start > STRETCH:
        found = _TEXT_BREAK.search(text, start + STRETCH)
        if not found:
            break
        out.append(text[start:found.end()])
        start = found.end()
    out.append(text[start:])
    return out


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer
    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a file, once for each Python worker."""
    return Vocabulary(path)
