"""Token counts with the tokenizers or sentencepiece library, lengths only.

Batches are cut by bytes. For byte-level models long texts are split at safe
boundaries (a space after a character that is no white space, where the
pre-tokenizer always starts a new word; the ends of special strings); distinct
pieces that the worker has not met are encoded once, by the library's model on
their words, and only lengths leave it. Other models count whole texts.

Defined results: a null text counts as empty (0 tokens); a null id stays null;
repeated rows give repeated results; other columns are not read.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from arealis.llm.bpe import PATTERN, PieceCache, byte_symbols
from arealis.llm.common import by_bytes, no_collection


class Library:
    """A tokenizer of the library and, if it is a plain byte-level one, its model for single pieces of text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        before = spec.get("pre_tokenizer") or {}
        added = spec.get("added_tokens", [])
        self.by_pieces = (
            before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and before.get("use_regex", True)
            and spec.get("normalizer") is None and spec["model"].get("type") == "BPE"
            and not any(t.get(k) for t in added for k in ("lstrip", "rstrip", "single_word"))
        )
        self.special = {t["content"]: t["id"] for t in added}
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self._symbols = byte_symbols()
        self._words = regex.compile(PATTERN).findall
        self._space = self._symbols[32]
        self._tokenize = self.tokenizer.model.tokenize

    def whole(self, texts: list[str]) -> Iterator[list[int]]:
        for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False):
            yield e.ids

    def pieces(self, pieces: list[str]) -> Iterator[list[int]]:
        """Ids of pieces without special strings; most are letters behind a space, and perhaps a mark, which need no pattern."""
        words, of_word = self._words, self._of_word
        for p in pieces:
            letters = p[1:]
            if letters.isalpha() and p[0] == " ":
                yield of_word(p)
            elif letters[:-1].isalpha() and p[0] == " " and letters[-1] in ".,":
                yield of_word(p[:-1]) + of_word(p[-1])
            else:
                yield [i for w in words(p) for i in of_word(w)]

    def _of_word(self, word: str) -> list[int]:
        if word.isascii() and word.isprintable():
            raw = word.replace(" ", self._space)
        else:
            raw = word.encode("utf-8", "surrogatepass").decode("latin-1").translate(self._symbols)
        return [t.id for t in self._tokenize(raw)]

    def found(self, texts: list[str], cache: PieceCache, of_special: Callable[[int], object]) -> Iterator[list]:
        """The cache's values of the pieces of each text, special strings by themselves."""
        marked = [bool(t) and any(s in t for s in self.special) for t in texts]
        simple = cache.lookup([t for t, m in zip(texts, marked) if t and not m])
        for t, m in zip(texts, marked):
            if not t:
                yield []
            elif not m:
                yield next(simple)
            else:
                out, at = [], 0
                for c in self.cut.finditer(t):
                    out += [v for part in cache.lookup([t[at : c.start()]]) for v in part] if c.start() > at else []
                    out.append(of_special(self.special[c[0]]))
                    at = c.end()
                yield out + ([v for part in cache.lookup([t[at:]]) for v in part] if at < len(t) else [])


@lru_cache(maxsize=4)
def library(path: str) -> Library:
    return Library(path)


@lru_cache(maxsize=4)
def counter(path: str) -> Callable[[list[str]], list[int]]:
    """Counts tokens of texts, with one model and cache for each worker process."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
    coder = library(path)
    if not coder.by_pieces:
        return lambda texts: [len(ids) for ids in coder.whole(texts)]
    cache = PieceCache(lambda pieces: map(len, coder.pieces(pieces)))
    return lambda texts: [sum(found) for found in coder.found(texts, cache, lambda i: 1)]


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 1024, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The id with bytes, tokens and whether there are more than ``limit`` tokens."""
    source = docs.select(docs[id_column], docs[text_column])
    kind = dict(source.dtypes)[id_column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(tokenizer)
        with no_collection():
            for batch in batches:
                n = [x for texts in by_bytes(batch.column(1)) for x in count(texts)]
                n_bytes = pc.fill_null(pc.binary_length(batch.column(1)), 0).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0), n_bytes, pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())], ["id", "n_bytes", "n_tokens", "over_limit"])

    return source.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long, over_limit boolean").withColumnRenamed("id", id_column)
