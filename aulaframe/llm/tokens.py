"""Token ids of whole texts by a public vocabulary file.

``Encoder`` gives the ids that the tokenizers library gives for the text. The
pre-tokeniser drops white space, so a text is the sequence of its chunks
between ASCII white space; chunks repeat, and a bounded cache holds their
ids. A chunk of plain Latin letters with a trailing comma or full stop is
looked up by its lower-case letters and goes straight to the library's model;
every other chunk goes through the whole tokenizer. Other vocabularies encode
whole texts.
"""

from __future__ import annotations

import re

import numpy as np

DEFAULT_VOCABULARY = "word_bpe_49k.json"
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,]?)\Z")


def _byte_letters() -> dict[int, str]:
    """The byte alphabet of byte-level vocabularies: printable Latin-1 bytes
    stand for themselves, the others for code points from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}


class Encoder:
    """Ids of texts as little-endian arrays; one per Python worker."""

    CHUNKS, PIECES = 600_000, 600_000  # cached entries: about 100 MB each

    def __init__(self, vocabulary: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import public_tokenizers
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(vocabulary if "/" in vocabulary else public_tokenizers.path(vocabulary))
        self.wide = np.uint16 if self.tok.get_vocab_size() <= 1 << 16 else np.uint32
        self.letters = _byte_letters()
        self.model = self.tok.model
        self.chunks: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.by_chunk = self._white_space_splits()

    def _white_space_splits(self) -> bool:
        probe = "a 'b\tc.d\n<|x|>  E,é "
        return self._plain(probe) == [i for c in probe.split() for i in self._plain(c)] and \
            self._plain("Étre") == [t.id for t in self._model("étre")]

    def _plain(self, text: str) -> list[int]:
        return self.tok.encode(text, add_special_tokens=False).ids

    def _model(self, piece: str):
        return self.model.tokenize(piece.encode().decode("latin-1").translate(self.letters))

    def _piece(self, piece: str) -> bytes:
        got = self.pieces.get(piece)
        if got is None:
            if len(self.pieces) >= self.PIECES:
                self.pieces.clear()
            got = self.pieces[piece] = np.array([t.id for t in self._model(piece)], self.wide).tobytes()
        return got

    def _chunk(self, chunk: bytes) -> bytes:
        text = chunk.decode()
        m = _PLAIN.match(text)
        if m and len(text) < 40:
            got = self._piece(m[1].lower()) + (self._piece(m[2]) if m[2] else b"")
        else:
            got = np.array(self._plain(text), self.wide).tobytes()
        if len(chunk) < 64:
            if len(self.chunks) >= self.CHUNKS:
                self.chunks.clear()
            self.chunks[chunk] = got
        return got

    def encode(self, text: bytes) -> np.ndarray:
        """Ids of one UTF-8 text."""
        if not self.by_chunk:
            return np.array(self._plain(text.decode()), self.wide)
        get, parts = self.chunks.get, text.split()
        found = list(map(get, parts))
        if None in found:
            found = [f if f is not None else get(p) or self._chunk(p) for f, p in zip(found, parts)]
        return np.frombuffer(b"".join(found), self.wide)


_ENCODERS: dict[str, Encoder] = {}


def encoder(vocabulary: str) -> Encoder:
    if vocabulary not in _ENCODERS:
        _ENCODERS[vocabulary] = Encoder(vocabulary)
    return _ENCODERS[vocabulary]
