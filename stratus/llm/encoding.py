"""Token ids of whole texts, reusing the ids of parts that were met before."""

from __future__ import annotations

import base64
import json
from array import array
from collections.abc import Callable

import numpy as np
import regex

#: Parts remembered by one worker; beyond that it starts afresh. Affects time only.
REMEMBERED = 1_000_000
#: One dictionary per worker process and vocabulary, shared by the tasks it runs.
_parts: dict[str, dict[str, bytes]] = {}


def remembered(name: str) -> dict[str, bytes]:
    known = _parts.setdefault(name, {})
    if len(known) > REMEMBERED:
        known.clear()
    return known


def byte_bpe(path: str, ranks_path: str | None = None) -> Callable[[str], np.ndarray]:
    """The encoder of a byte-level vocabulary, whose tokens begin at spaces and never reach over one.

    ``path`` is the tokenizer file. ``ranks_path`` names the same vocabulary as ranks, which is the quicker way to the
    same ids. Texts are cut before single spaces between other characters: there the vocabulary's own rule for
    splitting always cuts. Texts with special tokens in them go to the tokenizer whole.
    """
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    if ranks_path:
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        quick = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        encode_part = quick._core_bpe.encode_ordinary
    else:
        def encode_part(part: str) -> list[int]:
            return tokenizer.encode(part, add_special_tokens=False).ids

    def encode(text: str) -> np.ndarray:
        if any(s in text for s in special):
            return np.array(tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
        known = remembered(path)
        first, *parts = text.split(" ")
        new = set(parts).difference(known)
        # A space beside white space belongs to a longer run, which is split by its own rule.
        if first[-1:].isspace() or any(not p or p[0].isspace() or p[-1].isspace() for p in new) or not first:
            return np.array(encode_part(text), np.uint32)
        for part in new:
            known[part] = array("H", encode_part(" " + part)).tobytes()
        ids = array("H", encode_part(first)).tobytes() + b"".join(map(known.__getitem__, parts))
        return np.frombuffer(ids, np.uint16).astype(np.uint32)

    if tokenizer.get_vocab_size() > 1 << 16:
        raise ValueError("ids are kept in 16 bits")
    return encode


#: Fixed value: how the byte-level vocabulary splits a text.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Fixed value: how the vocabulary with word ends splits a text, once it is normalised.
WORD_SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: Texts of these characters only are their own composed form, and lower-casing them looks at one character alone.
PLAIN = regex.compile("[\t-\r -~\u00a1-\u012f\u0131-\u024f]*")
WORD_END = "\x00"


def byte_signs() -> dict[str, int]:
    """The printable signs that byte-level vocabularies write for the 256 bytes."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in shown]
    return {**{chr(b): b for b in shown}, **{chr(256 + k): b for k, b in enumerate(hidden)}}


def word_bpe(path: str) -> tuple[Callable[[str], list[int]], list[str]]:
    """The encoder of a vocabulary with word ends, and its tokens by id.

    The vocabulary's merges become ranks in which a word's end is a byte that no word holds; a last byte joins it before
    any merge. Texts beyond ``PLAIN``, and those with special tokens, go to the tokenizer itself.
    """
    import tiktoken
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    signs, end = byte_signs(), model["end_of_word_suffix"]

    def as_bytes(token: str) -> bytes:
        body = token.removesuffix(end)
        return bytes(signs[c] for c in body) + (b"\0" if body != token else b"")

    ranks = {bytes([b]): b for b in range(256)} | {bytes([b, 0]): 256 + b for b in range(1, 256)}
    for merge in model["merges"]:
        left, right = merge if isinstance(merge, list) else merge.split(" ")
        ranks[as_bytes(left) + as_bytes(right)] = len(ranks) + 256
    ids = {ranks[as_bytes(t)]: i for t, i in model["vocab"].items() if set(t) <= set(signs) and as_bytes(t) in ranks}
    quick = tiktoken.Encoding("ranks", pat_str=r"[^\x00]*\x00", mergeable_ranks=ranks, special_tokens={})
    ranked = quick._core_bpe.encode_ordinary

    def encode(text: str) -> list[int]:
        if PLAIN.fullmatch(text) and not any(s in text for s in special):
            ws = WORD_SPLIT.findall(text.lower())
            return [ids[r] for r in ranked(WORD_END.join(ws) + WORD_END)] if ws else []
        return tokenizer.encode(text, add_special_tokens=False).ids

    size = tokenizer.get_vocab_size(with_added_tokens=True)
    return encode, [tokenizer.id_to_token(i) or "" for i in range(size)]
