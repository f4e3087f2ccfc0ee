"""Token ids of whole texts by a tokenizer file with byte-level BPE.

The pattern that splits text before the merges never joins text across a space that has a non-space
beside it: what comes before such a space ends there and the space starts the next pre-token. A text
may be cut at these spaces and the ids of its pieces laid end to end. A worker encodes a piece once and
remembers its packed ids; most of a corpus is lookups. Added tokens of the file are found in a text first,
as the library does, and what is between them is encoded by pieces.
"""

from __future__ import annotations

import json
import re
from array import array

import regex

UNSAFE = re.compile(r"\s (?=\s|\Z)")
CUT = re.compile(r"(?=(?<=\S) | (?=\S))")
#: Pieces that a worker remembers (some 200 bytes each); as many older ones are kept until the next turn.
MEMO_ENTRIES = 400_000
# Fixed value: the pattern of byte-level pre-tokenizers.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def pieces(text: str) -> list[str]:
    """The text cut at the spaces where no token can reach across."""
    if UNSAFE.search(text):
        return CUT.split(text)
    first, *rest = text.split(" ")
    return [first, *[" " + x for x in rest]]


def _byte_letters() -> dict[int, str]:
    """The letters that stand for bytes in the vocabulary: visible Latin-1 for itself, the rest from 256 on."""
    visible = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(256 + k) for k, b in enumerate(hidden)}


class TokenEncoder:
    """Packed little-endian unsigned 32-bit ids of texts. A null text is empty.

    `pack_text` gives added tokens their ids; to `pack` they are ordinary text.
    """

    def __init__(self, tokenizer_json: str):
        from tokenizers import Tokenizer

        form = json.loads(tokenizer_json)
        before = form["pre_tokenizer"] or {}
        if form["normalizer"] or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex"):
            raise ValueError("only tokenizers with byte-level pre-tokens and no normalizer can be encoded by pieces")
        added = [x for x in form.get("added_tokens") or [] if x["content"]]
        if any(x.get(flag) for x in added for flag in ("single_word", "lstrip", "rstrip")):
            raise ValueError("added tokens that depend on what is beside them cannot be encoded by pieces")
        self.added = {x["content"]: x["id"].to_bytes(4, "little") for x in added}
        #: Patterns of added tokens, the longest first: normalized ones are looked for after the others.
        kinds = [[x["content"] for x in added if bool(x.get("normalized")) is kind] for kind in (False, True)]
        self.cuts = [re.compile("(" + "|".join(map(re.escape, sorted(own, key=len, reverse=True))) + ")") for own in kinds if own]
        self.tokenize = Tokenizer.from_str(tokenizer_json).model.tokenize
        self.split, self.letters = regex.compile(PATTERN).findall, _byte_letters()
        self.space = self.letters[ord(" ")]
        #: Ids of a space and the part, by a part that begins with a non-space. A full generation becomes the
        #: older one, what is still asked for moves on.
        self.spaced: dict[str, bytes] = {}
        self.spaced_before: dict[str, bytes] = {}
        #: Ids of other pre-tokens.
        self.other: dict[str, bytes] = {}

    def _merged(self, pretoken: str) -> bytes:
        letters = pretoken.encode().decode("latin-1").translate(self.letters)
        return array("I", [x.id for x in self.tokenize(letters)]).tobytes()

    def _pretoken(self, pretoken: str) -> bytes:
        if pretoken[0] == " " and pretoken[1:].isalpha():
            return self.spaced.get(pretoken[1:]) or self._spaced(pretoken[1:])
        ids = self.other.get(pretoken)
        if ids is None:
            if len(self.other) >= MEMO_ENTRIES // 4:
                self.other.clear()
            ids = self.other[pretoken] = self._merged(pretoken)
        return ids

    def _piece(self, piece: str) -> bytes:
        return b"".join(map(self._pretoken, self.split(piece)))

    def _spaced(self, part: str) -> bytes:
        ids = self.spaced_before.get(part)
        if ids is None:
            if not part.isalpha():
                ids = self._piece(" " + part)
            elif part.isascii():
                ids = array("I", [x.id for x in self.tokenize(self.space + part)]).tobytes()
            else:
                ids = self._merged(" " + part)
        if len(self.spaced) >= MEMO_ENTRIES:
            self.spaced_before, self.spaced = self.spaced, {}
        self.spaced[part] = ids
        return ids

    def pack(self, text: str | None) -> bytes:
        first, *parts = (text or "").split(" ")
        out = list(map(self.spaced.get, parts))
        if None in out:
            for k, known in enumerate(out):
                if known is None:
                    part = parts[k]
                    if part and not part[0].isspace():
                        out[k] = self.spaced.get(part) or self._spaced(part)
                    else:
                        before = parts[k - 1] if k else first
                        if before[-1:].isspace() or not (before or k == 0):
                            return b"".join(map(self._piece, CUT.split(text)))
                        out[k] = self._piece(" " + part)
        return self._piece(first) + b"".join(out)

    def pack_text(self, text: str | None) -> bytes:
        """Ids as the library gives them for a whole text, added tokens included."""
        if not text or not any(x in text for x in self.added):
            return self.pack(text)
        parts = [(text, False)]
        for cut in self.cuts:
            parts = [(x, done or k % 2 == 1) for own, done in parts for k, x in enumerate([own] if done else cut.split(own))]
        return b"".join(self.added[x] if done else self.pack(x) for x, done in parts)


_encoders: dict[int, TokenEncoder] = {}


def encoder(tokenizer_json: str) -> TokenEncoder:
    """One encoder for each tokenizer in a worker process."""
    key = hash(tokenizer_json)
    if key not in _encoders:
        _encoders[key] = TokenEncoder(tokenizer_json)
    return _encoders[key]


def read_tokenizer(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()
