"""Token counts of whole texts with bounded memory, for byte-level BPE vocabularies.

A short text is cut at provably stable boundaries and its pieces are counted through a
bounded memory of pieces met before. A huge text is encoded in overlapping chunks:
in each overlap a boundary is sought that both encodings share and that is proven
stable, and the two encodings are spliced there. Where none is found the overlap is
doubled, up to the rest of the text.

Proof of stability: the splitting pattern of these vocabularies never matches across a
step from a non-space character to a space, and looks ahead by one character after
spaces only. So no token spans such a step, what lies before it does not depend on
what follows the space, and what lies after it does not depend on what came before. A
special token's string holds no space, so no such step lies within one.

Defined results: null and empty texts have 0 bytes and 0 tokens; repeated rows and
null ids are counted like any other row; extra columns are ignored.
"""

import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellbulk.llm.common import by_bytes, text_of

CHUNK, OVERLAP, MEMORY = 32_768, 256, 400_000
STEP = re.compile(r"(?<=\S)(?=[ \n\t])")


@lru_cache(maxsize=4)
def loaded(path: str):
    """The tokenizer at ``path``, one per Python worker, without own threads."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class PieceMemory:
    """What a tokenizer makes of pieces of text, remembered in two generations.

    A piece that is met again moves to the young generation; when that is full it becomes
    the old one and the former old one goes, so frequent pieces stay. Each holds at most
    ``memory`` pieces, or those of one call if they are more.
    """

    def __init__(self, tokenizer, memory: int = MEMORY):
        self.tokenizer, self.memory, self.young, self.old = tokenizer, memory, {}, {}

    def value(self, encoded):
        raise NotImplementedError

    def known(self, cut: list[list[str]]) -> dict:
        """A value for every piece in ``cut``."""
        need = set().union(*cut)
        missing = need.difference(self.young)
        if missing and len(self.young) + len(missing) > self.memory:
            self.old, self.young, missing = self.young, {}, need
        seen = [p for p in missing if p in self.old]
        self.young.update(zip(seen, map(self.old.__getitem__, seen)))
        self.young.update(self.fresh(missing.difference(seen)))
        return self.young

    def values(self, distinct: list[str]) -> list:
        """A value for each of ``distinct``; young pieces are looked up once."""
        found = list(map(self.young.get, distinct))
        if missing := [p for p, v in zip(distinct, found) if v is None]:
            known = self.known([missing])
            found = [known[p] if v is None else v for p, v in zip(distinct, found)]
        return found

    def fresh(self, new: set[str]) -> dict:
        found = {}
        for run in by_bytes(new):
            encoded = self.tokenizer.encode_batch_fast(run, add_special_tokens=False)
            found.update(zip(run, map(self.value, encoded)))
        return found


class PieceCounter(PieceMemory):
    """Token counts of short texts."""

    value = staticmethod(len)

    def counts(self, texts: list[str]) -> list[int]:
        cut = [pieces(text) for text in texts]
        known = self.known(cut)
        return [sum(map(known.__getitem__, own)) for own in cut]


def pieces(text: str, mark: str = "\0") -> list[str]:
    """Cut before every space that follows a non-space character."""
    if mark in text:
        return re.split(r"(?<=\S)(?= )", text)
    if re.search(r"\s ", text):
        return re.sub(r"(?<=\S) ", mark + " ", text).split(mark)
    return text.replace(" ", mark + " ").split(mark)


def count_huge(tokenizer, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of ``text``, from overlapping chunks spliced at stable boundaries.

    ``begin`` is the boundary from which the left chunk's tokens count.
    """
    size, total, begin = len(text), 0, 0
    start, end = 0, min(len(text), chunk)
    left = _encode(tokenizer, text[start:end])
    while end < size:
        wide = overlap
        while True:
            after = max(start, end - wide)
            stop = min(size, end + chunk - overlap)
            right = _encode(tokenizer, text[after:stop])
            at = _common(text, left, start, end, right, after, begin)
            if at is not None:
                break
            wide *= 2
            end = min(size, end + wide)
            left = _encode(tokenizer, text[start:end])
            if end == size:
                return total + len(left) - _tokens_before(left, begin - start)
        total += _tokens_before(left, at - start) - _tokens_before(left, begin - start)
        start, end, left, begin = after, stop, right, at
    return total + len(left) - _tokens_before(left, begin - start)


def _encode(tokenizer, text: str):
    return tokenizer.encode_batch([text], add_special_tokens=False)[0]


def _tokens_before(encoded, at: int) -> int:
    """Tokens of a chunk that lie before the stable boundary ``at`` of it."""
    return 0 if at <= 0 else encoded.char_to_token(at)


def _common(text: str, left, start: int, end: int, right, after: int, begin: int) -> int | None:
    """A stable boundary inside the overlap at which both encodings begin a token."""
    for step in STEP.finditer(text, max(after, begin) + 1, end):
        at = step.start()
        if at < end and _begins(left, at - start) and _begins(right, at - after):
            return at
    return None


def _begins(encoded, at: int) -> bool:
    here, before = encoded.char_to_token(at), encoded.char_to_token(at - 1)
    return here is not None and before is not None and here != before


@lru_cache(maxsize=2)
def piece_counter(path: str) -> PieceCounter:
    """One per Python worker, which runs many tasks."""
    return PieceCounter(loaded(path))


def counter(path: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> Callable[[list[str]], np.ndarray]:
    tokenizer, short = loaded(path), piece_counter(path)

    def count(texts: list[str]) -> np.ndarray:
        found = np.zeros(len(texts), np.int64)
        brief = [i for i, t in enumerate(texts) if len(t) <= chunk]
        at = 0
        for run in by_bytes([texts[i] for i in brief]):
            found[brief[at:at + len(run)]] = short.counts(run)
            at += len(run)
        for i, text in enumerate(texts):
            if len(text) > chunk:
                found[i] = count_huge(tokenizer, text, chunk, overlap)
        return found

    return count


def token_counts(docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text",
                 limit: int = 512, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) of every row, in one pass without a shuffle."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = counter(tokenizer_path, chunk, overlap)
        for batch in batches:
            yield pd.DataFrame({"key": batch["key"], "n_bytes": batch["n_bytes"],
                                "n_tokens": count(batch["text"].tolist())})

    rows = docs.select(F.col(key).alias("key"), F.octet_length(text_of(text)).cast("long").alias("n_bytes"),
                       text_of(text).alias("text"))
    counted = rows.mapInPandas(run, f"key {kind}, n_bytes long, n_tokens long")
    return counted.select(F.col("key").alias(key), "n_bytes", "n_tokens",
                          (F.col("n_tokens") > limit).alias("over_limit"))
