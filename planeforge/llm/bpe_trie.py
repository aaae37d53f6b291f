"""Operator 5: BPE encoding and decoding by prefix-sharing trie traversal.

The last token of a word's BPE encoding is settled by its prefixes: the encoding of a string is the encoding of the
string before its last token, plus that token, and a token may follow another exactly when the two, encoded together,
stay apart. So the state of a prefix is just its last token and where that begins. Distinct words go into a trie;
a depth-first walk gives every node its state from the states above it, and a prefix that many words share is
worked out once. The end of a word is a child of its own, because the last letter carries an end mark.

Rows: every input row gives one output row, repeated and tied rows too; a null or empty text has no ids and decodes
to an empty text; an empty table gives an empty table. Only the id and text columns are read, so other columns and
their names do not matter. A text is cut at white space and never gathered with others; the memory of encoded words
is bounded (``words.GENERATION``), and a trie lives for about ``PIECE`` characters of text.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import words
from .common import column, documents, small_batches

#: Characters of text that are worked on together.
PIECE = 4_000_000
#: Chunks, and words, kept in each of two generations in a Python worker.
GENERATION = 250_000
#: Letters of a prefix down to which its ids are kept with it; a longer one has a way back to them.
DEEP = 64
_SPACE = re.compile(r"\s")


class Trie:
    """Words as paths of symbols. Node 0 is the root."""

    def __init__(self) -> None:
        self.children: list[dict[str, int]] = [{}]
        self.ends: dict[int, list[str]] = {}  # node of all but the last letter -> words

    def insert(self, word: str) -> None:
        node = 0
        for letter in word[:-1]:
            below = self.children[node]
            if letter not in below:
                below[letter] = len(self.children)
                self.children.append({})
            node = below[letter]
        self.ends.setdefault(node, []).append(word)


class Vocabulary:
    """Tokens and merge ranks of a BPE tokenizer file, and the encoding of words with them."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model = file["model"]
        self.end = model.get("end_of_word_suffix") or ""
        self.ids: dict[str, int] = model["vocab"]
        self.rank = {tuple(m if isinstance(m, list) else m.split(" ")): i for i, m in enumerate(model["merges"])}
        self.packed = {t: i.to_bytes(2, "little") for t, i in self.ids.items()}
        self.tails = {t[k:] for t in self.ids for k in range(len(t))}
        self.widest = max(map(len, self.ids))
        # Tokens that are looked for in the text as it is, before anything else is cut.
        self.special = {x["content"]: x["id"].to_bytes(2, "little") for x in file["added_tokens"]}
        self.apart = words.Memory(self._apart, 300_000)
        self.tokens = [b""] * (1 + max([*self.ids.values(), *(x["id"] for x in file["added_tokens"])]))
        for token, i in [*self.ids.items(), *((x["content"], x["id"]) for x in file["added_tokens"])]:
            self.tokens[i] = token.encode()

    def symbols(self, token: str) -> list[str]:
        if self.end and token.endswith(self.end) and len(token) > len(self.end):
            body = token[: -len(self.end)]
            return [*body[:-1], body[-1] + self.end]
        return [*token]

    def merged(self, parts: list[str]) -> list[str]:
        """Plain BPE: merge the pair of least rank, the leftmost first, while there is one."""
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: (self.rank.get((parts[i], parts[i + 1]), 1 << 30), i))
            if (parts[best], parts[best + 1]) not in self.rank:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return parts

    def _apart(self, pair: tuple[str, str]) -> bool:
        return self.merged([*self.symbols(pair[0]), *self.symbols(pair[1])]) == [*pair]

    def encode(self, distinct: set[str]) -> dict[str, bytes]:
        """word -> ids as unsigned 16-bit numbers, for non-empty words in the tokenizer's byte letters."""
        trie = Trie()
        for word in distinct:
            trie.insert(word)
        size = len(trie.children)
        last: list[str] = [""] * size  # last token of the prefix
        done: list[bytes] = [b""] * size  # ids of the prefix, down to DEEP
        back: dict[int, int] = {}  # below DEEP, the node before the last token
        known, apart, tails, widest = self.packed, self.apart, self.tails, self.widest
        out: dict[str, bytes] = {}
        path: list[int] = [0]
        todo: list[tuple[int, int, str]] = [(0, 0, "")]

        def state(near: str, mark: str, depth: int) -> tuple[str, int]:
            # The text's ends that are tokens, while they are ends of tokens at all; the longest that fits is the one.
            size, fitting, k = len(near), [], 1
            while k <= size and (token := near[size - k :] + mark) in tails:
                if token in known:
                    fitting.append((k, token))
                k += 1
            for k, token in reversed(fitting):
                start = path[depth - k]
                if start == 0 or apart[last[start], token]:
                    return token, start
            raise ValueError(f"no token ends {near!r}")

        # Of a prefix no more than twice the longest token's letters are carried along, and of a deep one the ids are read at its words' ends only.
        while todo:
            node, depth, near = todo.pop()
            del path[depth:]
            path.append(node)
            if node:
                last[node], start = state(near, "", depth)
                if depth <= DEEP:
                    done[node] = done[start] + known[last[node]]
                else:
                    back[node] = start
            for word in trie.ends.get(node, ()):
                token, start = state(near + word[-1], self.end, depth + 1)
                ids = known[token]
                if start in back:
                    ids = [ids]
                    while start in back:
                        ids.append(known[last[start]])
                        start = back[start]
                    ids = b"".join(reversed(ids))
                out[word] = done[start] + ids
            if len(near) > 2 * widest:
                near = near[-widest:]
            todo += [(child, depth + 1, near + letter) for letter, child in trie.children[node].items()]
        return out


class TrieEncoder:
    """Ids of whole texts; cutting and normalising is the tokenizers library's, merging is the trie's."""

    def __init__(self, path: str) -> None:
        from tokenizers import pre_tokenizers

        self.vocabulary = Vocabulary(path)
        self.tokenizer = words.load(path)
        self.special = re.compile("(" + "|".join(map(re.escape, self.vocabulary.special)) + ")" if self.vocabulary.special else r"(?!)")
        # The library's letters for the bytes that Latin letters beyond ASCII are made of.
        letters = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        latin = "".join(map(chr, range(0x80, 0x100)))
        self.letters = dict(zip(latin.encode(), letters.pre_tokenize_str(latin)[0][0], strict=True))
        self.chunks: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.old_chunks: dict[str, bytes] = {}
        self.old_words: dict[str, bytes] = {}

    @staticmethod
    def _unknown(names: set[str], known: dict[str, bytes], old: dict[str, bytes]) -> list[str]:
        """The names in neither generation; those of the older one become known again."""
        missing = [x for x in names if x not in known]
        known |= {x: old[x] for x in missing if x in old}
        return [x for x in missing if x not in old]

    def learn(self, chunks: set[str]) -> None:
        """Encodes the chunks that are not known yet. Of what is known, the generation before the last is forgotten."""
        if len(self.chunks) > GENERATION:
            self.old_chunks, self.chunks = self.chunks, {}
        if len(self.words) > GENERATION:
            self.old_words, self.words = self.words, {}
        self.chunks[""] = b""
        new = self._unknown(chunks, self.chunks, self.old_chunks)
        odd = [c for c in new if _SPACE.search(c) or any(s in c for s in self.vocabulary.special)]
        cut = {c: self._odd(c) for c in odd} | {c: ws for c in new if (ws := self._plain(c))}
        rest = [c for c in new if c not in cut and c not in self.chunks]
        for i in range(0, len(rest), 2000):
            cut |= zip(rest[i : i + 2000], self._words(rest[i : i + 2000]), strict=True)
        distinct = {w for ws in cut.values() for w in ws}
        self.words |= self.vocabulary.special  # no cut word looks like one: marks and letters are never in one word
        self.words |= self.vocabulary.encode(set(self._unknown(distinct, self.words, self.old_words)))
        self.chunks |= {c: b"".join(map(self.words.__getitem__, ws)) for c, ws in cut.items()}

    def _plain(self, chunk: str) -> list[str] | None:
        """The words of a chunk of Latin letters and then marks, which normalising only puts in lower case."""
        body = chunk.rstrip(words.MARKS)
        if body and not (body.isalpha() and (body.isascii() or max(body) < "\u0100")):
            return None
        low = body.lower()
        low = low if low.isascii() else low.encode().decode("latin-1").translate(self.letters)
        return [x for x in (low, chunk[len(body) :]) if x]

    def _odd(self, chunk: str) -> list[str]:
        """The words of a chunk with other white space or with special tokens, which part it and are put in as they are."""
        out = []
        for piece in self.special.split(chunk):
            if piece in self.vocabulary.special:
                out.append(piece)
            elif piece:
                out += [w for w, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(piece))]
        return out

    def _words(self, chunks: list[str]) -> list[list[str]]:
        """The words of each chunk. A space parts chunks: no rule of the tokenizer reaches across it."""
        normal = self.tokenizer.normalizer.normalize_str(" ".join(chunks))
        sizes = [len(x) for x in normal.split(" ")]
        if len(sizes) != len(chunks):  # a chunk that is normalised to white space: one by one
            return [self._odd(c) for c in chunks]
        out, at, end = [[] for _ in chunks], 0, sizes[0]
        for word, (start, _) in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal):
            while start >= end:
                at += 1
                end += 1 + sizes[at]
            out[at].append(word)
        return out

    def packed(self, texts: list[str | None]) -> Iterator[bytes]:
        lists = [words.word_chunks(t) if t else [] for t in texts]
        self.learn(set().union(*lists))
        for chunks in lists:
            yield b"".join(map(self.chunks.__getitem__, chunks))


_KEPT: dict[str, TrieEncoder] = {}


def _encoder(path: str) -> TrieEncoder:
    if path not in _KEPT:
        _KEPT[path] = TrieEncoder(path)
    return _KEPT[path]


def by_size(texts: list[str | None], most: int = PIECE) -> Iterator[slice]:
    """Consecutive slices of about ``most`` characters."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= most:
            yield slice(start, i + 1)
            start, size = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def _encoded(enc: TrieEncoder, batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
    texts = [t if isinstance(t, str) else None for t in batch["text"]]
    for part in by_size(texts):
        ids = [np.frombuffer(x, "<u2").astype("<u4") for x in enc.packed(texts[part])]
        yield pd.DataFrame({"doc_id": batch["doc_id"].iloc[part].array, "n_tokens": [len(x) for x in ids], "ids": [x.tobytes() for x in ids]})


def _decoded(tokens: list[bytes], ids: pd.Series) -> pd.Series:
    return pd.Series([b" ".join(map(tokens.__getitem__, np.frombuffer(x, "<u4").tolist())).decode() for x in ids], dtype=object)


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.select(column(docs, id_col).cast("long").alias("doc_id"), column(docs, text_col).cast("string").alias("text"))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids): the ids of every whole text, as little-endian unsigned 32-bit numbers."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = _encoder(path)
        for batch in batches:
            yield from _encoded(enc, batch)

    return _source(docs, id_col, text_col).mapInPandas(run, "doc_id long, n_tokens long, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` with ``decoded``: token texts joined by spaces, as a tokenizer file without a decoder decodes."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokens = _encoder(path).vocabulary.tokens
        for batch in batches:
            yield _decoded(tokens, batch)

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return encoded.withColumn("decoded", F.pandas_udf(run, "string")("ids"))


def encode_and_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``decode(encode(docs))`` in one Python worker a task: two in a row would both come to hold a vocabulary and its words."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = _encoder(path)
        for batch in batches:
            for part in _encoded(enc, batch):
                yield part.assign(decoded=_decoded(enc.vocabulary.tokens, part["ids"]))

    return _source(docs, id_col, text_col).mapInPandas(run, "doc_id long, n_tokens long, ids binary, decoded string")


def op5_bpe_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = words.public_path("word_bpe_49k.json")
    both = encode_and_decode(documents(spark, sf_dir), path)
    return both.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))
