"""Token ids of whole texts with the ``tokenizers`` library, at one library call per batch of new words.

The vocabulary of ``word_bpe_49k.json`` never joins characters across white space: the pre-tokenizer cuts there,
normalisation (NFC, lower case) is local to a chunk, and its special strings hold no blank.  So the ids of a text
are the ids of its blank-separated chunks in order, and each distinct chunk needs encoding once per worker.
"""

from __future__ import annotations

import functools
import os
import re
from itertools import islice

import numpy as np

#: Distinct chunks kept by a worker (about 150 bytes each); later ones are encoded each time they come.
CACHE_CHUNKS = 600_000
#: Longer chunks are not kept.
CACHE_CHARS = 40
#: Bytes of texts taken from an Arrow batch at a time, and characters encoded in one step.
BATCH_BYTES = 2 << 20
STEP_CHARS = 1 << 16
#: Latin letters, then ASCII punctuation other than the apostrophe: one pre-token each; the letters may be lower-cased
#: beforehand.
PLAIN = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-&(-/:-@\[-`{-~]*)")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class ChunkEncoder:
    """Whole texts to ``uint32`` ids, equal to ``Tokenizer.encode(text, add_special_tokens=False).ids``."""

    #: A special string of the vocabulary; used between chunks so that one call encodes many.
    SEPARATOR = "<|endoftext|>"

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.separator = self.tokenizer.token_to_id(self.SEPARATOR)
        self.pack = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        latin = [c for c in map(chr, range(256)) if PLAIN.fullmatch(c)]
        self.spelling = {ord(c): self.tokenizer.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in latin}
        self.known: dict[str, bytes] = {}

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def _split(self, parts: list[str]) -> list[bytes] | None:
        """Ids of each part from one call, a special string between them."""
        ids = self._ids(self.SEPARATOR.join(parts))
        cuts = np.flatnonzero(ids == self.separator)
        if len(cuts) != len(parts) - 1:
            return None
        raw, out, left = ids.tobytes(), [], 0
        for right in [*cuts.tolist(), len(ids)]:
            out.append(raw[4 * left : 4 * right])
            left = right + 1
        return out

    def _any(self, chunks: list[str]) -> dict[str, bytes]:
        """Chunks of any kind, a special string between them."""
        out = {c: self._ids(c).tobytes() for c in chunks if "<|" in c}
        plain = [c for c in chunks if "<|" not in c]
        for at in range(0, len(plain), 4096):
            part = plain[at : at + 4096]
            ids = self._split(part)
            out.update(zip(part, ids or [self._ids(c).tobytes() for c in part], strict=True))
        return out

    def _words(self, words: list[str]) -> dict[str, bytes]:
        """Plain words: each is one pre-token, so the model alone splits it once its bytes are spelled its way."""
        tokenize, spell, pack = self.tokenizer.model.tokenize, self.spelling, self.pack
        return {w: b"".join([pack[t.id] for t in tokenize(w if w.isascii() else w.translate(spell))]) for w in words}

    def _new(self, chunks: set[str]) -> dict[str, bytes]:
        simple, rest = [], []
        for c in chunks:
            m = PLAIN.fullmatch(c)
            (simple.append((c, m[1].lower(), m[2])) if m else rest.append(c))
        known = self.known
        words = {w for _, w, _ in simple if w not in known}
        fresh = self._words(words) | self._any(sorted({t for _, _, t in simple if t not in known} | set(rest)))
        fresh.update((c, (known.get(w) or fresh[w]) + (known[t] if t in known else fresh[t])) for c, w, t in simple)
        return fresh

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian uint32 ids of each text; null counts as empty."""
        out: list[bytes] = []
        at = 0
        while at < len(texts):  # small steps: the chunks of one stay in the processor's cache
            size, upto = 0, at
            while upto < len(texts) and size < STEP_CHARS:
                size += len(texts[upto] or "")
                upto += 1
            out += self._step(texts[at:upto])
            at = upto
        return out

    def _step(self, texts: list[str | None]) -> list[bytes]:
        chunks = [(t or "").replace("\n", " ").split(" ") for t in texts]
        known = self.known
        new = set().union(*chunks).difference(known)
        if not new:
            return [b"".join(map(known.__getitem__, doc)) for doc in chunks]
        fresh = self._new(new)
        room = CACHE_CHUNKS - len(known)
        if room >= len(fresh) and max(map(len, fresh)) <= CACHE_CHARS:
            known.update(fresh)
            return [b"".join(map(known.__getitem__, doc)) for doc in chunks]
        known.update(islice(((c, ids) for c, ids in fresh.items() if len(c) <= CACHE_CHARS), max(0, room)))
        return [b"".join([known[c] if c in known else fresh[c] for c in doc]) for doc in chunks]


@functools.cache
def encoder(path: str) -> ChunkEncoder:
    """One encoder per worker process and file."""
    return ChunkEncoder(path)
