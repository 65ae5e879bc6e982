"""BPE encoding and decoding with a tokenizer file whose words hold no white space.

The encoding of a word is known from its prefixes: the encoding of a prefix ends in
one token, and that token is the only one that ends there, is what its own string is
encoded to, and stays apart from the last token of the prefix before it. Whether two
tokens stay apart is read off the merges: a merge across the border must come before
the merges that use up its parts.

The words of a slice that are new to a worker make a trie, which is walked depth
first: a node keeps the last token of its prefix, and the longest ending of the
prefix that begins a token, which leads to the tokens that may end here. A prefix
that many words share is worked on once. A word's last symbol carries the end mark
and is a branch of its own. Sorted words are the trie's branches in the order of the
walk, so only the nodes of one path are alive at a time: memory follows the longest
word.

Normalisation and the split into words are the file's own, applied to each different
piece of text. Pieces are cut at ASCII white space and between an ASCII letter and an
ASCII sign or digit: no word reaches across either, and nothing there is composed.
Special tokens standing in a text are found before, as the library does. The pieces a
worker has encoded are kept up to ``KEPT_BYTES`` of their text, then forgotten.

Defined cases: null and empty texts, and texts of white space alone, have no ids and
decode to the empty string; a token id that the file does not have decodes to
nothing; long texts are encoded whole, also as one word; equal texts have equal ids,
and of equally good matches the leftmost merges first, as in the library; repeated
rows stay; a table without rows gives none; an input column with the name of an added
one is replaced.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterable, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .batches import add_columns, utf8

# Bytes of text pieces whose ids a worker keeps.
KEPT_BYTES = 4 << 20
# Pairs of tokens whose verdict a worker keeps.
KEPT_PAIRS = 1 << 17

IDS = T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType(), False))])
DECODED = T.StructType([T.StructField("decoded", T.StringType())])


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Vocabulary:
    """Merges of a file as a tree over tokens, and the trie of its tokens over first symbols."""

    def __init__(self, tokens: dict[str, int], merges: Sequence[Sequence[str]], end: str):
        self.end, self.tokens = end, tokens
        self.parts: dict[int, tuple[int, int]] = {}
        self.rank: dict[int, int] = {}
        self.merge: dict[tuple[int, int], int] = {}
        for rank, (a, b) in enumerate(merges):
            left, right, whole = tokens[a], tokens[b], tokens[a + b]
            if whole in self.parts or max(self.rank.get(left, -1), self.rank.get(right, -1)) >= rank:
                raise ValueError("merges must make each token once, after its parts")
            self.parts[whole], self.rank[whole], self.merge[left, right] = (left, right), rank, rank
        self.apart = functools.lru_cache(KEPT_PAIRS)(self._apart)
        self._grow()

    def _grow(self) -> None:
        """The trie of the tokens, with links from each string to its longest ending that is in the trie too.

        ``ending`` lists for each node the tokens that its string ends in, longest first.
        """
        self.step: list[dict[str, int]] = [{}]
        self.length: dict[int, int] = {}
        own: list[tuple[tuple[int, int], ...]] = [()]
        spelled: dict[int, tuple[str, ...]] = {}
        names = {t: s for s, t in self.tokens.items()}
        for token in chain((t for t in names if t not in self.parts), self.parts):
            if token in self.parts:
                left, right = self.parts[token]
                spelled[token] = spelled[left] + spelled[right]
                # A token that its own string is not encoded to never stands in an encoding.
                if left not in self.length or right not in self.length or not self._apart(left, right, self.rank[token]):
                    continue
            else:
                spelled[token] = (names[token],)
            node = 0
            for symbol in spelled[token]:
                after = self.step[node].get(symbol)
                if after is None:
                    after = self.step[node][symbol] = len(own)
                    self.step.append({})
                    own.append(())
                node = after
            self.length[token] = len(spelled[token])
            own[node] = ((token, self.length[token]),)
        self.spelled = {token: token.to_bytes(4, "little") for token in self.length}
        self.back, self.ending = [0] * len(own), own
        queue = list(self.step[0].values())
        for node in queue:
            self.ending[node] = own[node] + self.ending[self.back[node]]
            for symbol, after in self.step[node].items():
                shorter = self.back[node]
                while shorter and symbol not in self.step[shorter]:
                    shorter = self.back[shorter]
                self.back[after] = self.step[shorter].get(symbol, 0)
                queue.append(after)

    def _apart(self, left: int, right: int, until: float = float("inf")) -> bool:
        """Whether no merge before ``until`` crosses the border of two tokens that stand side by side.

        What stands at the border are the right parts of ``left`` and the left parts of
        ``right``, each until the merge that uses it. Equal pairs merge from the left.
        """
        x, x_used = left, until
        while True:
            y, y_used = right, until
            while True:
                crossing = self.merge.get((x, y))
                if crossing is not None and crossing < x_used and crossing <= y_used:
                    return False
                if y not in self.parts:
                    break
                y, y_used = self.parts[y][0], self.rank[y]
            if x not in self.parts:
                return True
            x, x_used = self.parts[x][1], self.rank[x]

    def encode(self, words: Iterable[str]) -> dict[str, bytes]:
        """The ids of each word as little-endian 32-bit numbers, by one depth-first walk over the trie of all of them."""
        step, back, ending, apart, length_of, end = self.step, self.back, self.ending, self.apart, self.length, self.end
        spelled, out = self.spelled, {"": b""}
        # By depth: the last token of the prefix, and the longest ending of it that is in the vocabulary's trie.
        before, last, nodes = "", [-1], [0]
        for word in sorted(set(words).difference(out)):
            shared, most = 0, min(len(word), len(before)) - 1
            while shared < most and word[shared] == before[shared]:
                shared += 1
            del last[shared + 1 :], nodes[shared + 1 :]
            depth, node = shared, nodes[shared]
            for symbol in (*word[shared:-1], word[-1] + end):
                after = step[node].get(symbol)
                while after is None:
                    node = back[node]
                    after = step[node].get(symbol)
                node = after
                depth += 1
                for token, length in ending[node]:
                    if length == depth or apart(last[depth - length], token):
                        break
                last.append(token)
                nodes.append(node)
            before, ids = word, []
            while depth:
                ids.append(spelled[last[depth]])
                depth -= length_of[last[depth]]
            out[word] = b"".join(ids[::-1])
        return out


class Encoder:
    """A tokenizer file: its own normaliser and word splitter, and the trie walk for the words."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path) as file:
            held = json.load(file)
        model, added = held["model"], held.get("added_tokens") or []
        if model["type"] != "BPE" or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges")):
            raise ValueError(f"{path} is not a plain BPE file")
        if held.get("decoder") is not None or any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] or re.search(r"\s", t["content"]) for t in added):
            raise ValueError(f"{path} has a decoder, or special tokens that reach beyond their string")
        whole = Tokenizer.from_file(path)
        self.normalise = whole.normalizer.normalize_str if whole.normalizer else str
        self.split = whole.pre_tokenizer.pre_tokenize_str
        if [w for w, _ in self.split("a\tb  c ")] != ["a", "b", "c"]:
            raise ValueError(f"the words of {path} hold white space")
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.vocabulary = Vocabulary(model["vocab"], merges, model.get("end_of_word_suffix") or "")
        if [w for w, _ in self.split(self.normalise("aBc-d1e"))] != ["abc", "-", "d", "1", "e"]:
            raise ValueError(f"{path} does not set letters, signs and digits apart")
        self.special = {t["content"].encode(): t["id"] for t in added}
        longest = sorted(map(re.escape, self.special), key=len, reverse=True)
        self.special_at = re.compile(b"(" + b"|".join(longest) + b")") if longest else None
        # What the worker has met: pieces since the last change, and those of the time before.
        self.kept: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.kept_bytes = 0

    def _words(self, piece: bytes) -> list[str]:
        if piece.isalpha():  # of bytes: ASCII letters alone
            return [piece.decode().lower()]
        return [w for w, _ in self.split(self.normalise(piece.decode()))]

    def _pieces(self, text: bytes) -> list[bytes]:
        if self.special_at is None or self.special_at.search(text) is None:
            return cut_apart(text).split()
        parts = self.special_at.split(text)
        return [x for k, part in enumerate(parts) for x in ([part] if k % 2 else cut_apart(part).split())]

    def encode(self, texts: Sequence[bytes]) -> list[np.ndarray]:
        """Ids of texts in UTF-8."""
        if self.kept_bytes > KEPT_BYTES // 2 or not self.kept:
            self.older, self.kept, self.kept_bytes = self.kept, {s: i.to_bytes(4, "little") for s, i in self.special.items()}, 0
        pieces = list(map(self._pieces, texts))
        missing = set(chain.from_iterable(pieces)).difference(self.kept)
        new = {piece: self._words(piece) for piece in missing.difference(self.older)}
        ids = self.vocabulary.encode(chain.from_iterable(new.values()))
        for piece in missing:
            words = new.get(piece)
            if words is None:
                self.kept[piece] = self.older[piece]
            else:
                self.kept[piece] = ids[words[0]] if len(words) == 1 else b"".join(map(ids.__getitem__, words))
            self.kept_bytes += len(piece)
        return [np.frombuffer(b"".join(map(self.kept.__getitem__, own)), "<i4") for own in pieces]


_LETTER = np.array([chr(b).isascii() and chr(b).isalpha() for b in range(256)])
_SIGN = np.array([0x20 < b < 0x7F for b in range(256)]) & ~_LETTER


def cut_apart(text: bytes) -> bytes:
    """``text`` with a space between an ASCII letter and an ASCII sign or digit behind it."""
    data = np.frombuffer(text, np.uint8)
    return np.insert(data, np.flatnonzero(_LETTER[data[:-1]] & _SIGN[data[1:]]) + 1, 0x20).tobytes()


@functools.cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


@functools.cache
def token_names(path: str) -> pa.Array:
    """The string of every id of a file, null where there is none."""
    with open(path) as file:
        held = json.load(file)
    names = {i: s for s, i in held["model"]["vocab"].items()} | {t["id"]: t["content"] for t in held.get("added_tokens") or []}
    return pa.array([names.get(i) for i in range(max(names) + 1)], pa.large_string())


def _offsets(lengths: Iterable[int]) -> pa.Array:
    return pa.array(np.cumsum([0, *lengths]), pa.int32())


def encode(docs: DataFrame, text: str = "text", path: str | None = None, keep: Sequence[str] | None = None) -> DataFrame:
    """``docs`` with ``ids``, the token ids of the whole text."""
    path = path or tokenizer_path()

    def work(texts: pa.Array) -> list[pa.Array]:
        data, offsets = utf8(texts)
        ids = encoder(path).encode([data[a:b].tobytes() for a, b in zip(offsets, offsets[1:])])
        flat = np.concatenate([np.zeros(0, np.int32), *ids])
        return [pa.ListArray.from_arrays(_offsets(map(len, ids)), pa.array(flat), type=pa.list_(pa.field("element", pa.int32(), False)))]

    return add_columns(docs, text, IDS, work, keep)


def decode(encoded: DataFrame, ids: str = "ids", path: str | None = None, keep: Sequence[str] | None = None) -> DataFrame:
    """``encoded`` with ``decoded``: its tokens' strings with a space between them, special ones too."""
    path = path or tokenizer_path()

    def work(lists: pa.Array) -> list[pa.Array]:
        names = token_names(path)
        flat = lists.flatten().cast(pa.int64())
        known = pc.and_kleene(pc.greater_equal(flat, 0), pc.less(flat, len(names)))
        found = names.take(pc.if_else(known, flat, None))
        lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(lists)), lengths)[found.is_valid().to_numpy(zero_copy_only=False)]
        counts = np.bincount(row, minlength=len(lists))
        return [pc.binary_join(pa.LargeListArray.from_arrays(np.cumsum([0, *counts]), found.drop_null()), pa.scalar(" ", pa.large_string())).cast(pa.string())]

    return add_columns(encoded, ids, DECODED, work, keep)
