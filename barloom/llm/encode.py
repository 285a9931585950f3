"""Token ids of whole texts by a public tokenizer, with the words that recur encoded once."""

from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache

import numpy as np

_LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
#: Letters up to the end, white space or an ASCII mark or digit: one piece to either split pattern.
_STEM = f"[{_LETTER}]+(?=[!-@\\[-`{{-~ \\n]|\\Z)"
#: Letters with a blank before them, a line feed before letters, or a run of blanks and line feeds
#: with the run of other characters behind it.
CHUNK = re.compile(rf" ?{_STEM}|\n(?=[{_LETTER}])|[ \n]*[^ \n]+|[ \n]+")
#: The same for a tokenizer that drops white space.
WORD_CHUNK = re.compile(rf"{_STEM}|[^ \n]+")
STEM = re.compile(f" ?[{_LETTER}]+")
OTHER_SPACE = re.compile(r"[^\S \n]|[\x1c-\x1f\x85]")
LONGEST = 40


def byte_letters():
    """The rule of byte-level vocabularies: bytes that print stand for themselves, others for letters from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in prints]
    return {b: b for b in prints} | {b: 256 + k for k, b in enumerate(others)}


class ChunkEncoder:
    """Encodes texts as the tokenizer encodes them whole, chunk by chunk through a bounded cache.

    A chunk ends before a blank or line feed, or between letters and an ASCII mark or digit. The
    split patterns of the two public JSON tokenizers never match across such a place, and none
    looks behind it, so the ids of a text are those of its chunks one after the other. Only the
    rule for trailing white space looks ahead, which matters where white space of other kinds ends
    a chunk: a text with any is encoded whole. Where the tokenizer drops white space, chunks are
    without it. Chunks of letters are one piece of either pattern and go to the merges directly. A
    text with the string of a special token is encoded whole, where the library gives it the
    token's id; with `plain` such strings are ordinary text.
    """

    def __init__(self, path: str, most: int = 300_000, plain: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder()
        if any(t.normalized or t.lstrip or t.rstrip or t.single_word for t in added.values()):
            raise ValueError(f"{path}: added tokens are looked for as they are spelled")
        # Chunks hold no string of a special token but by lower-casing, which does not make it one.
        self.tokenizer.encode_special_tokens = True
        self.marks = [] if plain else [t.content for t in added.values()]
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        #: Without a normalizer white space and case count.
        self.exact = self.tokenizer.normalizer is None
        self.model, self.letters = self.tokenizer.model, byte_letters()
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.most = most
        self.known, self.older = {}, {}

    def _whole(self, texts, marked=False):
        self.tokenizer.encode_special_tokens = not marked
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array(self.code, x.ids).tobytes() for x in found]

    def _chunks(self, text):
        if not text:
            return []
        return CHUNK.findall(text) if self.exact else WORD_CHUNK.findall(text.lower() if text.isascii() else text)

    def _merge(self, stems):
        """Learn the ids of runs of letters, with or without a blank before them."""
        known, tokenize, code, letters = self.known, self.model.tokenize, self.code, self.letters
        for stem in stems:
            text = stem if self.exact else stem.lower()
            if text.isascii():
                if text[0] == " ":
                    text = "\u0120" + text[1:]
            else:
                text = text.encode("utf-8").decode("latin-1").translate(letters)
            known[stem] = array(code, [t.id for t in tokenize(text)]).tobytes()

    def encode(self, texts) -> list[bytes]:
        """Little-endian ids of each text, two or four bytes each as `dtype` says; null is empty."""
        marked = {i for i, t in enumerate(texts) if t and any(m in t for m in self.marks)}
        chunked = [[] if i in marked else self._chunks(t) for i, t in enumerate(texts)]
        distinct = set().union(*chunked)
        if len(self.known) + len(distinct) > self.most // 2:
            # Two generations: what is met again moves up from the older one.
            self.older, self.known = self.known, {}
        missing = distinct.difference(self.known)
        again = missing.intersection(self.older)
        self.known.update((c, self.older[c]) for c in again)
        missing -= again
        is_stem = STEM.fullmatch
        stems = [c for c in missing if is_stem(c)]
        rests = list(missing.difference(stems))
        odd = {c for c in rests if OTHER_SPACE.search(c)} if self.exact else ()
        self._merge(stems)
        self.known.update(zip(rests, self._whole(rests)))
        get = self.known.__getitem__
        out = []
        for i, (text, chunks) in enumerate(zip(texts, chunked)):
            if i in marked or odd and not odd.isdisjoint(chunks):
                out += self._whole([text], i in marked)
            else:
                out.append(b"".join(map(get, chunks)))
        for c in missing:
            if len(c) > LONGEST or c in odd:
                del self.known[c]
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> ChunkEncoder:
    """One encoder per worker and vocabulary; its cache lives as long as the worker."""
    return ChunkEncoder(path)
