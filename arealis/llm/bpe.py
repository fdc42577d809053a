"""Byte-pair encoding of whole texts and its exact inverse.

Words are encoded by a prefix-sharing trie: distinct words go into a trie of
bytes, and a depth-first walk gives each node the last token of the encoding of
its prefix. The last token of a prefix is the longest vocabulary entry that
ends there and may follow the last token of what precedes it, so the encoding
of a shared prefix is found once for all words below it.

A text is cut where a space follows a character that is no white space: the
pre-tokenizer always starts a new word there, so the pieces are independent,
and each distinct piece is encoded once per worker.

Defined results: a null text is an empty one (no tokens); a null id stays
null; repeated rows give repeated results; only the id and text columns are
read. Long texts are handled piece by piece, with memory in proportion to the
largest text plus a bounded cache.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from arealis.llm.common import by_bytes, no_collection

#: The split pattern of the byte-level pre-tokenizer (a fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Pieces that a worker keeps, and the longest of them; beyond it only the short ones, which are the frequent ones, stay.
CACHE_PIECES, LONG, SHORT = 1_000_000, 64, 9

_AFTER_SPACE, _CUT = re.compile(r"\s "), re.compile(r"(?<=\S) ")
_ASCII_SPACES = [chr(c) + " " for c in (*range(9, 14), *range(28, 32))]


def plain(text: str, parts: list[str]) -> bool:
    """No space follows white space or begins the text, so that each single space is a cut."""
    if "" in parts:
        return False
    return not any(s in text for s in _ASCII_SPACES) if text.isascii() else not _AFTER_SPACE.search(text)


def byte_symbols() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class TrieEncoder:
    """Byte-level BPE of words by last-token states on a trie."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        to_byte = {c: b for b, c in byte_symbols().items()}
        raw = lambda s: bytes(to_byte[c] for c in s)
        model = spec["model"]
        self.ids = {raw(s): i for s, i in model["vocab"].items()}
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.rank = {(raw(a), raw(b)): k for k, (a, b) in enumerate(merges)}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.tokens = {i: s for s, i in self.ids.items()} | {i: s.encode() for s, i in self.special.items()}
        self.size = {i: len(t) for t, i in self.ids.items()}
        #: For each id: whether merging its own bytes gives it (found when first met).
        self.usable: list[bool | None] = [None] * (max(self.tokens) + 1)
        self.parts = {a + b: (a, b) for a, b in self.rank}
        self.edges: dict[bytes, tuple[list, list]] = {}
        self.follows: dict[int, bool] = {}
        #: Finds all entries that end at each place of a word, the longest first.
        self.finder = ahocorasick.Automaton()
        for token, i in self.ids.items():
            self.finder.add_word(token.decode("latin-1"), (len(token), i))
        self.finder.make_automaton()
        self.words = regex.compile(PATTERN)
        self.specials = re.compile("|".join(map(re.escape, self.special))) if self.special else None

    def _merged(self, word: bytes) -> list[bytes]:
        """Plain merging by rank, for single vocabulary entries only."""
        parts = [word[i : i + 1] for i in range(len(word))]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.rank.get((parts[i], parts[i + 1]), 1 << 60))
            if (parts[best], parts[best + 1]) not in self.rank:
                break
            pair = (parts[best], parts[best + 1])
            out, i = [], 0
            while i < len(parts):
                if i + 1 < len(parts) and (parts[i], parts[i + 1]) == pair:
                    out.append(parts[i] + parts[i + 1])
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        return parts

    def _checked(self, i: int) -> bool:
        self.usable[i] = self._merged(self.tokens[i]) == [self.tokens[i]]
        return self.usable[i]

    def _edge(self, token: bytes) -> tuple[list, list]:
        """What stands at the token's left and right end while it is being merged, each with the rank that replaces it."""
        found = self.edges.get(token)
        if found is None:
            sides = []
            for side in (0, 1):
                steps, part, until = [], token, 1 << 60
                while True:
                    steps.append((part, until))
                    if part not in self.parts:
                        break
                    until = self.rank[self.parts[part]]
                    part = self.parts[part][side]
                sides.append(steps[::-1])
            found = self.edges[token] = (sides[0], sides[1])
        return found

    def may_follow(self, first: bytes, second: bytes) -> bool:
        """Merging the two tokens' bytes together keeps the boundary between them.

        Merges happen in the order of their rank. The boundary goes if the two
        parts beside it may merge before either is replaced; of two equal merges
        the left one comes first.
        """
        left, right = self._edge(first)[1], self._edge(second)[0]
        i = j = 0
        while True:
            (a, a_until), (b, b_until) = left[i], right[j]
            merge = self.rank.get((a, b))
            if merge is not None and merge < a_until and merge <= b_until:
                return False
            if a_until == b_until == 1 << 60:
                return True
            if a_until <= b_until:
                i += 1
            else:
                j += 1

    def _state(self, last: int, token: int, pair: int) -> bool:
        """Whether the token may stand after the last one; kept for the next time."""
        if len(self.follows) > 1_500_000:
            self.follows.clear()
        known = self.follows[pair] = self.may_follow(self.tokens[last], self.tokens[token])
        return known

    def encode_words(self, words: Iterable[str]) -> dict[str, tuple[int, ...]]:
        """Encode distinct words: sorted order is the depth-first order of their trie."""
        out: dict[str, tuple[int, ...]] = {}
        usable, checked, state, known, ends = self.usable, self._checked, self._state, self.follows.get, self.finder.iter
        last = [0]  # of each prefix on the way down, the last token; the token's length leads back to the prefix before it
        before = ""
        for word, text in sorted((w.encode("utf-8", "surrogatepass").decode("latin-1"), w) for w in set(words)):
            same = 0
            for a, b in zip(before, word):
                if a != b:
                    break
                same += 1
            del last[same + 1 :]
            done = same
            for end, (size, token) in ends(word):
                if end < done:
                    continue
                start = end + 1 - size
                if not (usable[token] or usable[token] is None and checked(token)):
                    continue
                if start:
                    pair = last[start] << 32 | token
                    if not (known(pair) if pair in self.follows else state(last[start], token, pair)):
                        continue
                last.append(token)
                done = end + 1
            if done != len(word):
                raise ValueError(f"no token ends at byte {done + 1} of {text!r}")
            ids = []
            while done:
                ids.append(last[done])
                done -= self.size[last[done]]
            out[text] = tuple(reversed(ids))
            before = word
        return out

    def encode_pieces(self, wanted: list[str]) -> list[tuple[int, ...]]:
        """Ids of pieces."""
        find = self.words.findall
        split = [find(p) for p in wanted]
        known = self.encode_words(w for ws in split for w in ws)
        return [known[ws[0]] if len(ws) == 1 else tuple(i for w in ws for i in known[w]) for ws in split]

    def segments(self, text: str) -> list[tuple[str, int | None]]:
        """The text cut at special strings, each with its id, in order."""
        if self.specials is None or not any(s in text for s in self.special):
            return [(text, None)]
        out, at = [], 0
        for m in self.specials.finditer(text):
            out += [(text[at : m.start()], None), (m[0], self.special[m[0]])]
            at = m.end()
        return [*out, (text[at:], None)]


class PieceCache:
    """Values of the pieces of texts, each distinct piece computed once while it is kept.

    ``compute`` gives the values of distinct pieces. The hit path is a split and
    a dictionary lookup for each piece.
    """

    def __init__(self, compute: Callable[[list[str]], Iterable], limit: int = CACHE_PIECES):
        self.compute, self.limit = compute, limit
        self.after: dict[str, object] = {}  # of pieces after a cut, without their space
        self.whole: dict[str, object] = {}  # of all others

    def _fill(self, cache: dict, missing: set[str], head: str) -> dict[str, object]:
        """Put the values of missing pieces into the cache; returns those of pieces that are too long for it."""
        if len(cache) + len(missing) > self.limit:
            short = {p: v for p, v in cache.items() if len(p) < SHORT}
            cache.clear()
            if len(short) < self.limit // 2:
                cache.update(short)
        todo, long = [p for p in missing if p not in cache], {}
        for p, v in zip(todo, self.compute([head + p for p in todo])):
            if len(p) > LONG:
                long[p] = v
            else:
                cache[p] = v
        return long

    def lookup(self, texts: list[str]) -> Iterator[list]:
        """For each text the values of its pieces, in order."""
        met: list[tuple[list[str], list]] = []
        after: set[str] = set()
        whole: set[str] = set()
        get = self.after.get
        for text in texts:
            parts = text.split(" ")
            if not plain(text, parts):
                parts = _CUT.split(text)
            first = parts.pop(0)
            if (value := self.whole.get(first)) is None:
                whole.add(first)
            found = list(map(get, parts))
            if None in found:
                after.update([p for p, v in zip(parts, found) if v is None])
            parts.insert(0, first)
            found.insert(0, value)
            met.append((parts, found))
        # What was found before a cache is emptied is still at hand.
        long = self._fill(self.whole, whole, "") if whole else {}
        rest = self._fill(self.after, after, " ") if after else {}
        for parts, found in met:
            if found[0] is None:
                found[0] = long[parts[0]] if parts[0] in long else self.whole[parts[0]]
            if None in found:
                found = [v if v is not None else rest[p] if p in rest else get(p) for p, v in zip(parts, found)]
            yield found


@lru_cache(maxsize=2)
def encoder(path: str) -> TrieEncoder:
    """One encoder, with its cache, for each worker process."""
    return TrieEncoder(path)


_KEPT: dict[tuple[str, str], PieceCache] = {}


def kept(name: str, path: str, make: Callable[[], PieceCache]) -> PieceCache:
    """The worker's cache of this name, across tasks."""
    if (name, path) not in _KEPT:
        _KEPT[name, path] = make()
    return _KEPT[name, path]


def found_values(texts: list[str], cache: PieceCache, coder: TrieEncoder, of_special: Callable[[int], object]) -> Iterator[list]:
    """Values of the pieces of each text; special strings inside a text stand for themselves."""
    simple = [t for t in texts if t and not any(s in t for s in coder.special)]
    known = cache.lookup(simple)
    for t in texts:
        if not t:
            yield []
        elif not any(s in t for s in coder.special):
            yield next(known)
        else:
            cut = coder.segments(t)
            inner = cache.lookup([part for part, i in cut if i is None and part])
            yield [v for part, i in cut if part for v in ([of_special(i)] if i is not None else next(inner))]


def encode_decode(docs: DataFrame, tokenizer: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """For each document: its id, number of tokens, and digests of its ids and of the text decoded from them."""
    source = docs.select(docs[id_column], docs[text_column])
    kind = dict(source.dtypes)[id_column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer)
        tokens = coder.tokens

        def values(wanted: list[str]) -> Iterator[tuple[str, bytes, int]]:
            for ids in coder.encode_pieces(wanted):
                yield ",".join(map(str, ids)), b"".join([tokens[i] for i in ids]), len(ids)

        cache = kept("encode_decode", tokenizer, lambda: PieceCache(values))
        with no_collection():
            for batch in batches:
                n, ids, decoded = [], [], []
                for texts in by_bytes(batch.column(1)):
                    for found in found_values(texts, cache, coder, lambda i: (str(i), tokens[i], 1)):
                        parts, raw, counts = zip(*found) if found else ((), (), ())
                        n.append(sum(counts))
                        ids.append(hashlib.sha256(",".join(parts).encode()).hexdigest())
                        decoded.append(hashlib.sha256(b"".join(raw).decode("utf-8", "replace").encode()).hexdigest())
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    out = source.mapInArrow(run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("id", id_column)
