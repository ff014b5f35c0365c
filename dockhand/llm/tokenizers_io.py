"""Tokenizers of the alignment and scoring operators, from vocabulary files given by path.

An encoder turns a text into token ids and knows the bytes of every id:

* ``*.json``: a byte-level BPE vocabulary; ids follow merge rank, so the ranks alone encode;
* ``*.model``: a piece model with byte fallback; the model puts one space before a text.

Special tokens are never made: their strings inside a text are plain text.
"""

from __future__ import annotations

import json

import numpy as np

# Fixed value: the byte-level vocabulary's published split pattern.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SPACE = "▁"


def byte_alphabet() -> dict[str, int]:
    """Character to byte of byte-level vocabularies: printable bytes stand for themselves, the others for 256 and on."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class ByteLevelEncoder:
    """Byte-level BPE over ``" " + text``."""

    def __init__(self, data: bytes):
        import tiktoken

        spec = json.loads(data)
        special = {t["content"] for t in spec.get("added_tokens") or [] if t.get("special")}
        alphabet = byte_alphabet()
        ranks = {bytes(alphabet[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
        self.token_bytes = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.token_bytes[i] = token
        self._encoding = tiktoken.Encoding("aligned", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [self._encoding.encode_to_numpy(" " + t, disallowed_special=()).astype(np.int64) for t in texts]


class PieceEncoder:
    """A piece model over a text (the model adds the first space)."""

    def __init__(self, data: bytes):
        import sentencepiece

        self.model = model = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.token_bytes = [
            bytes([int(p[3:5], 16)]) if model.is_byte(i) else
            b"" if model.is_control(i) or model.is_unknown(i) else p.replace(SPACE, " ").encode()
            for i, p in ((i, model.id_to_piece(i)) for i in range(model.vocab_size()))]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.int64) for ids in self.model.encode(texts, num_threads=1)]


def load_encoder(path: str, data: bytes) -> ByteLevelEncoder | PieceEncoder:
    if path.endswith(".json"):
        return ByteLevelEncoder(data)
    if path.endswith(".model"):
        return PieceEncoder(data)
    raise ValueError(f"no encoder for {path}: give a byte-level .json or a piece .model")
