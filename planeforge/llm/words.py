"""Encoding with the public tokenizers.

For the tokenizer that drops white space a text is cut there, where it begins anew, and every distinct chunk is encoded by
the ``tokenizers`` library once per worker. The ids of a text are the ids of its chunks in order, exactly those of the
library over the whole text (``tests/llm`` compares them). The memory of encoded chunks is bounded: two generations
of ``GENERATION`` chunks, the older of which is dropped when the younger is full.
"""

from __future__ import annotations

import re
from array import array

import numpy as np

#: Chunks kept in each of two generations in a Python worker (about 200 bytes each).
GENERATION = 600_000

#: Two white-space characters in a row, or white space at an end: such texts take the general cut.
_UNEVEN = re.compile(r"\s\s|^\s|\s$")
_SPACE = re.compile(r"\s")
#: ASCII marks, but for those that may begin or end a special token or a contraction.
MARKS = "!\"#$%&()*+,-./:;=?@[\\]^_`{}~"
#: Fixed value: what the byte-level tokenizer takes as one pre-token, without ways back that cannot help.
PRE_TOKENS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s+(?!\S)|\s+"
#: A space before anything but white space begins a pre-token of the byte-level tokenizer.
_BEFORE_WORD = re.compile(r" (?=\S)")


class Memory(dict):
    """chunk -> value, with a bounded number of entries; ``make`` computes a missing value."""

    def __init__(self, make, size: int = GENERATION) -> None:
        super().__init__()
        self.make, self.size, self.old = make, size, {}

    def __missing__(self, key):
        value = self.old.get(key)
        return self.put(key, self.make(key) if value is None else value)

    def put(self, key, value):
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def load(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


def word_chunks(text: str) -> list[str]:
    """Chunks of a text for a tokenizer that drops white space: cut at spaces and line ends."""
    return text.replace("\n", " ").split(" ")


def byte_chunks(text: str) -> list[str]:
    """Chunks of a text for the byte-level tokenizer; together they are the text.

    A space followed by something else than white space always begins a pre-token, and so does a single line end
    between two such characters. Runs of white space stay at the end of the chunk before.
    """
    if not text:
        return []
    if _UNEVEN.search(text):
        first, *rest = _BEFORE_WORD.split(text)
        return [first, *(" " + x for x in rest)] if first else [" " + x for x in rest]
    first, *rest = text.replace("\n", " \n").split(" ")
    return [first, *(x if x[0] == "\n" else " " + x for x in rest)]


class Encoder:
    """Ids of whole texts by a tokenizer that drops white space, as little-endian unsigned 16-bit numbers."""

    def __init__(self, path: str) -> None:
        self.tokenizer = load(path)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("the vocabulary does not fit 16 bits")
        self.memory = Memory(self._ids)

    def _ids(self, chunk: str) -> bytes:
        if not chunk:
            return b""
        return array("H", self.tokenizer.encode(chunk, add_special_tokens=False).ids).tobytes()

    def _plain(self, chunk: str) -> tuple[str, ...]:
        """The chunks that a chunk's ids are put together from."""
        body = chunk.rstrip(MARKS)
        if body and len(body) < len(chunk) and body[-1] < "\u0250" and body[-1].isalpha():
            # A letter and a mark after it never share a pre-token.
            return (*self._plain(body), chunk[len(body) :])
        if chunk.isascii() and "<" not in chunk:
            return (chunk.lower(),)
        return (chunk,)

    def _learn(self, chunks: set[str]) -> None:
        """Encodes unknown chunks, those that cannot run into each other as one text."""
        parts = {c: self._plain(c) for c in chunks if c not in self.memory.old}
        new = [x for x in dict.fromkeys(x for ps in parts.values() for x in ps) if x not in self.memory and x not in self.memory.old]
        apart = [x for x in new if x and not _SPACE.search(x)]
        known = dict.fromkeys(new)
        if apart:
            joint = self.tokenizer.encode(" ".join(apart), add_special_tokens=False)
            sizes = np.fromiter(map(len, apart), np.int64, len(apart)) + 1
            starts = np.array(joint.offsets, np.int64).reshape(-1, 2)[:, 0]
            cuts = np.searchsorted(starts, np.cumsum(sizes) - 1, "left") * 2
            data, at = array("H", joint.ids).tobytes(), 0
            for x, end in zip(apart, cuts.tolist(), strict=True):
                known[x] = data[at:end]
                at = end
        for x, ids in known.items():
            self.memory.put(x, self._ids(x) if ids is None else ids)
        for c, ps in parts.items():
            if ps != (c,):
                self.memory.put(c, b"".join(map(self.memory.__getitem__, ps)))

    def packed(self, text: str | None) -> bytes:
        if not text:
            return b""
        chunks = word_chunks(text)
        found = list(map(self.memory.get, chunks))
        if None not in found:
            return b"".join(found)
        self._learn({c for c, ids in zip(chunks, found, strict=True) if ids is None})
        return b"".join(map(self.memory.__getitem__, chunks))

    def ids(self, text: str | None) -> np.ndarray:
        return np.frombuffer(self.packed(text), "<u2").astype("<u4")


class ByteEncoder:
    """Ids of whole texts by the byte-level tokenizer, as little-endian unsigned 16-bit numbers.

    Vocabulary and merges are those of the tokenizer's own file, applied by the faster of the two installed libraries; a text
    with a special token goes to the other one. Tests hold the ids against it. Nothing is kept between texts.
    """

    def __init__(self, path: str) -> None:
        import tiktoken
        from tokenizers import pre_tokenizers

        self.tokenizer = load(path)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("the vocabulary does not fit 16 bits")
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # The letter that the vocabulary has for each byte: printable bytes are their own, the others follow from 256 on.
        letters, spare = {}, 256
        alphabet = set(pre_tokenizers.ByteLevel.alphabet())
        for byte in range(256):
            own = chr(byte)
            if own not in alphabet:
                own, spare = chr(spare), spare + 1
            letters[own] = byte
        ranks = {bytes(map(letters.__getitem__, token)): rank for token, rank in self.tokenizer.get_vocab(False).items() if token not in self.special}
        self.sizes = {rank: len(token) for token, rank in ranks.items()}
        self.encoding = tiktoken.Encoding("bytes", pat_str=PRE_TOKENS, mergeable_ranks=ranks, special_tokens={})

    def has_special(self, text: str) -> bool:
        return any(s in text for s in self.special)

    def size(self, token: int) -> int:
        """Bytes of text that a token stands for; a special one has none here."""
        return self.sizes.get(token, 0)

    def packed(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.has_special(text):
            return array("H", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        return array("H", self.encoding.encode_ordinary(text)).tobytes()

    def ids(self, text: str | None) -> np.ndarray:
        return np.frombuffer(self.packed(text), "<u2").astype("<u4")


_ENCODERS: dict[tuple[str, bool], Encoder | ByteEncoder] = {}


def encoder(path: str, words: bool) -> Encoder | ByteEncoder:
    """One encoder for each tokenizer in a Python worker, kept from task to task."""
    key = (path, words)
    if key not in _ENCODERS:
        _ENCODERS[key] = (Encoder if words else ByteEncoder)(path)
    return _ENCODERS[key]


def forget() -> None:
    """Frees the encoders' memory in this Python worker, which turns to other work."""
    _ENCODERS.clear()


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
