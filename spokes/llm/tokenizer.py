"""Loading the three kinds of tokenizer files inside tasks.

The vocabulary file is read once, on the driver, and travels as a broadcast
(a few MB, fixed by the file); executors need no file of their own.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable

import numpy as np

# The split pattern of byte-level BPE, and its printable stand-ins for bytes.
SPLIT_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# tiktoken's regular expressions give up on a run of about a million white-space characters.
LONG_BLANK = 100_000
BLANK = re.compile(r"\s+")


def _byte_of_char() -> dict[str, int]:
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def byte_level_ranks(spec: dict) -> tuple[dict[bytes, int], dict[str, int]] | None:
    """Ranks and special tokens of a plain byte-level BPE file, or None if the file is of another make.

    A file qualifies when its merges are numbered in order after the 256 bytes
    and nothing but the standard split comes before them; rank order and merge
    order are then the same thing.
    """
    model, pre = spec.get("model") or {}, spec.get("pre_tokenizer") or {}
    if (model.get("type", "BPE") != "BPE" or model.get("dropout") or model.get("continuing_subword_prefix")
            or model.get("end_of_word_suffix") or model.get("byte_fallback") or model.get("ignore_merges")
            or spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space")
            or not pre.get("use_regex", True)):
        return None
    special = {}
    for t in spec.get("added_tokens") or []:
        if not t["special"] or t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]:
            return None
        special[t["content"]] = t["id"]
    vocab, of_char = model["vocab"], _byte_of_char()
    for i, pair in enumerate(model["merges"]):
        a, b = pair.split(" ") if isinstance(pair, str) else pair
        if vocab.get(a + b) != 256 + i:
            return None
    try:
        ranks = {bytes(of_char[c] for c in token): i for token, i in vocab.items() if token not in special}
    except KeyError:
        return None
    return (ranks, special) if sorted(ranks.values()) == list(range(256 + len(model["merges"]))) else None


class Encoder:
    """Token ids of a text as the file's own library gives them, without added special tokens."""

    def __init__(self, kind: str, blob: bytes):
        if kind == "model":
            import sentencepiece

            sp = sentencepiece.SentencePieceProcessor(model_proto=blob)
            self.ids = lambda text: np.asarray(sp.encode(text, num_threads=1), np.uint32)
            return
        spec = json.loads(blob)
        if plain := byte_level_ranks(spec):
            # the same ids as the tokenizers library (tests compare the two over all of
            # Unicode and on random bytes), four times as fast
            import tiktoken

            ranks, special = plain
            enc = tiktoken.Encoding("file", pat_str=SPLIT_PATTERN, mergeable_ranks=ranks, special_tokens=special)
            allowed, slow = set(special), []

            def ids(text: str) -> np.ndarray:
                if not long_blank(text):
                    try:
                        return enc.encode_to_numpy(text, allowed_special=allowed, disallowed_special=())
                    except ValueError:
                        pass
                if not slow:  # most tasks never need it
                    slow.append(_library(blob))
                return slow[0](text)

            self.ids = ids
            return
        self.ids = _library(blob)


def long_blank(text: str) -> bool:
    """Whether the text holds a run of ``LONG_BLANK`` white-space characters or more."""
    return len(text) >= LONG_BLANK and any(m.end() - m.start() >= LONG_BLANK for m in BLANK.finditer(text))


def _library(blob: bytes) -> Callable[[str], np.ndarray]:
    """The tokenizers library's own encoding by a ``.json`` file."""
    from tokenizers import Tokenizer

    tok = Tokenizer.from_str(blob.decode())
    tok.no_truncation()
    tok.no_padding()
    return lambda text: np.asarray(tok.encode(text, add_special_tokens=False).ids, np.uint32)


_LOADED: dict[str, Encoder] = {}


def encoder(kind: str, version: str, blob: bytes) -> Encoder:
    """One encoder per Python worker and file."""
    if version not in _LOADED:
        _LOADED[version] = Encoder(kind, blob)
    return _LOADED[version]


def read_file(path: str) -> tuple[str, str, bytes]:
    """(kind, version digest, bytes) of a tokenizer file."""
    with open(path, "rb") as f:
        blob = f.read()
    kind = path.rsplit(".", 1)[-1]
    if kind not in ("json", "model"):
        raise ValueError(f"{path}: a .json or .model file is needed")
    return kind, hashlib.sha256(kind.encode() + b"\0" + blob).hexdigest(), blob
