"""Ids of whole texts under a byte-level BPE file of the tokenizers library.

Where the file is plain byte-level BPE (no normalizer, no prefix space, the known pattern,
every merge's id in merge order), its vocabulary is loaded as byte ranks and whole texts go
to the rank encoder, which gives the same ids several times faster. Every other file, and
every text the rank encoder refuses, goes to the tokenizers library itself. Nothing is cached
and no text is cut by this module.
"""

from __future__ import annotations

import json

import numpy as np

# Fixed value: the pattern of the byte-level pre-tokenizer.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it prints, else one from 256 on."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(prints)]
    return {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(hidden)}


def token_bytes(vocabulary: dict[str, int], added: dict[str, int]) -> list[bytes]:
    """Bytes of every id; added tokens stand for their own text, missing ids for nothing."""
    letters, out = byte_letters(), [b""] * (max([*vocabulary.values(), *added.values()]) + 1)
    for token, i in vocabulary.items():
        if token not in added:
            out[i] = bytes([letters[c] for c in token])
    for token, i in added.items():
        out[i] = token.encode()
    return out


def _is_plain(spec: dict) -> bool:
    """Whether byte ranks give the ids of this file."""
    model, cut = spec["model"], spec.get("pre_tokenizer") or {}
    wanted = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    if model.get("type", "BPE") != "BPE" or spec.get("normalizer") or any(cut.get(k) != v for k, v in wanted.items()):
        return False
    if any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")):
        return False
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in spec["added_tokens"]):
        return False
    vocabulary, letters = model["vocab"], byte_letters()
    if sorted(vocabulary.get(c, -1) for c in letters) != list(range(256)):
        return False
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    return all(vocabulary.get(a + b) == 256 + i for i, (a, b) in enumerate(pairs))


class WholeTexts:
    """Encoder of whole texts; `plain` takes the strings of special tokens in a text as ordinary text."""

    def __init__(self, path: str, plain: bool = False):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = plain
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.ranks = None
        if _is_plain(spec):
            import tiktoken

            self.bytes = token_bytes(spec["model"]["vocab"], added)
            self.sizes = np.array([len(b) for b in self.bytes], np.int64)
            ranks = {self.bytes[i]: i for token, i in spec["model"]["vocab"].items() if token not in added}
            self.ranks = tiktoken.Encoding("from-file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=added)
        self.special = set() if plain else set(added)

    def ids(self, text: str | None) -> np.ndarray:
        """Ids of one text as unsigned 32-bit integers; a null text has none."""
        if not text:
            return np.empty(0, np.uint32)
        if self.ranks is not None:
            try:
                return self.ranks.encode_to_numpy(text, allowed_special=self.special, disallowed_special=())
            except ValueError:  # a run of white space too long for the rank encoder's pattern
                pass
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)

    def tokens(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, first characters and ends of all tokens; tokens within one character share its span."""
        if not text or self.ranks is None:
            found = self.library.encode(text or "", add_special_tokens=False)
            spans = np.array(found.offsets, np.int64).reshape(-1, 2)
            return np.array(found.ids, np.uint32), spans[:, 0], spans[:, 1]
        ids = self.ids(text)
        ends = np.cumsum(self.sizes[ids])
        starts = ends - self.sizes[ids]
        if not text.isascii():
            raw = np.frombuffer(text.encode(), np.uint8)
            char = np.cumsum((raw & 0xC0) != 0x80) - 1
            starts, ends = char[starts], char[ends - 1] + 1
        return ids, starts, ends
