"""Reading byte-level BPE vocabularies; cached per worker process."""

from __future__ import annotations

import base64
import json
from functools import lru_cache

# Fixed value: the pattern by which byte-level pre-tokenizers split text.
PATTERN = (
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
)


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(4)
def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a rank file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}


@lru_cache(4)
def read_json(path: str) -> tuple[dict[bytes, int], list[tuple[bytes, bytes]], dict[str, int]]:
    """Vocabulary, merges in order and special tokens of a tokenizer file.

    Refuses a file that is not plain byte-level BPE.
    """
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, split = spec["model"], spec["pre_tokenizer"]
    plain = (
        model["type"] == "BPE"
        and spec["normalizer"] is None
        and split["type"] == "ByteLevel"
        and not split["add_prefix_space"]
        and split.get("use_regex", True)
        and not any(model.get(k) for k in ("dropout", "byte_fallback", "ignore_merges", "unk_token"))
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"])
    )
    if not plain:
        raise ValueError(f"{path} is not a plain byte-level BPE tokenizer")
    alphabet = byte_alphabet()

    def raw(token: str) -> bytes:
        return bytes(alphabet[c] for c in token)

    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    vocab = {raw(t): i for t, i in model["vocab"].items() if t not in special}
    pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
    return vocab, [(raw(a), raw(b)) for a, b in pairs], special


def ranks_of_json(path: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """The vocabulary as ranks, where ids follow the order of merges."""
    vocab, merges, special = read_json(path)
    first = len(vocab) - len(merges)
    if any(vocab[a + b] != first + i for i, (a, b) in enumerate(merges)):
        raise ValueError(f"ids of {path} do not follow its merges")
    return vocab, special
