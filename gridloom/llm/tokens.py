"""Token ids of whole texts by a BPE file with word ends, as bytes of little-endian 32-bit numbers.

White space never lies inside a token of this vocabulary, so a text is cut at ASCII white space and
the ids of each piece between are kept. A piece of common Latin letters is normalised and split here
and merged by a byte-level BPE that holds the same merges, with one byte for the end of a word; any
other piece goes through the tokenizer itself.
"""

from __future__ import annotations

import json
import unicodedata
from itertools import chain

import numpy as np
import regex

#: Pieces in either half of the cache of one worker (some 200 bytes each).
CACHE = 150_000
END = "\x1c"
# Fixed value: how the vocabulary's tokenizer splits words.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
ODD = regex.compile(r"[^\x20-\x7e¡-įĲ-ɏ]")


class Encoder:
    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        vocab, merges = model["model"]["vocab"], model["model"]["merges"]
        special = [t["content"] for t in model["added_tokens"]]
        self.marked = regex.compile("|".join(map(regex.escape, special)) or r"(?!)")
        byte_of = _byte_alphabet()

        def raw(token: str) -> bytes:
            ends = token.endswith("</w>")
            return bytes(byte_of[c] for c in (token[:-4] if ends else token)) + (END.encode() if ends else b"")

        # A byte with the word end joins before anything else; then merges in their order.
        ranks, ids = {}, {}
        for c, b in byte_of.items():
            ranks[bytes([b]) + END.encode()], ids[len(ids)] = len(ids), vocab[c + "</w>"]
        for pair in merges:
            token = "".join(pair) if isinstance(pair, list) else pair.replace(" ", "", 1)
            key = raw(token)
            if key not in ranks:
                ids[len(ranks)] = vocab[token]
                ranks[key] = len(ranks)
        top = len(ranks)
        for c, b in byte_of.items():
            ranks[bytes([b])] = top + b
            ids[top + b] = vocab[c]
        self.ids = np.zeros(max(ids) + 1, np.uint32)
        self.ids[list(ids)] = list(ids.values())
        ends = {i for t, i in vocab.items() if t.endswith("</w>")}
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[list(ends)] = True
        self.bpe = tiktoken.Encoding("words", pat_str=f"[^{END} ]*{END}", mergeable_ranks=ranks, special_tokens={})
        self.recent: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _slow(self, piece: str) -> bytes:
        return np.array(self.tokenizer.encode(piece, add_special_tokens=False).ids, np.uint32).tobytes()

    def _learn(self, pieces: list[bytes]) -> None:
        """Keep the ids of new pieces; all plain ones go through the merges in one call."""
        joined = b" ".join(pieces).decode()
        if ODD.search(joined) or self.marked.search(joined):
            odd = [p for p in pieces if ODD.search(p.decode()) or self.marked.search(p.decode())]
            self.recent.update((p, self._slow(p.decode())) for p in odd)
            pieces = list(set(pieces).difference(odd))
            joined = b" ".join(pieces).decode()
        if not pieces:
            return
        if not joined.isascii():
            joined = unicodedata.normalize("NFC", joined)
        # Words of each piece, each with the end mark; the spaces between pieces stay and match no token.
        marked = WORDS.sub(r"\g<0>" + END, joined.lower())
        ids = self.ids[np.array(self.bpe.encode_ordinary(marked), np.int64)]
        stops = np.flatnonzero(self.ends[ids]) + 1
        raw = np.frombuffer(marked.encode(), np.uint8)
        ends = np.cumsum(raw == ord(END))
        upto = np.append(ends[raw == 32], ends[-1])
        if len(stops) != ends[-1] or len(upto) != len(pieces):  # a mark was lost or doubled: let the tokenizer decide
            self.recent.update((p, self._slow(p.decode())) for p in pieces)
            return
        bounds = (np.concatenate([[0], stops])[np.concatenate([[0], upto])] * 4).tolist()
        data = ids.astype("<u4").tobytes()
        self.recent.update(zip(pieces, map(data.__getitem__, map(slice, bounds, bounds[1:]))))

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        split = [t.split() if t else [] for t in texts]
        if len(self.recent) > CACHE:
            self.recent, self.old = {}, self.recent
        new = set(chain.from_iterable(split)).difference(self.recent)
        # Pieces met again go over from the older half of the cache.
        for piece in new.intersection(self.old):
            self.recent[piece] = self.old[piece]
        self._learn(list(new.difference(self.recent)))
        return [b"".join(map(self.recent.__getitem__, s)) for s in split]


def _byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of byte-level BPE: printable Latin-1 stands for itself, the rest from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}
