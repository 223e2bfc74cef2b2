"""Collocations: frequent phrases of each language, scored by their weakest cut.

Texts are lower-cased (A-Z), cut into pieces at punctuation and line ends, and pieces into
words at spaces and tabs. Every word starts a suffix of up to ``longest`` words of its
piece. Phrases are counted by a multikey quicksort of suffixes:

1. Words are counted, then pairs of frequent words, by their hash. What is frequent goes
   into a bitmap of ``BITS`` bits, so its size does not grow with the corpus: a hash or bit
   that two phrases share costs time, never a phrase. A suffix ends before its first infrequent pair, and one
   without a frequent pair is dropped, as no frequent phrase starts there.
2. Equal suffixes are added up and routed by their leading words: ranges of the order
   (language, words), as even as their number allows, so one leading word may fill many tasks.
3. A task sorts pointers to its suffixes by three-way partitions, word by word, to the
   maximum depth. The weight of an equal partition is a phrase's count; partitions below
   the threshold are abandoned. Phrases at the edge of a range report what the range holds
   of them, and the parts are added up.

Counts of parts are looked up by joins; scores are exact decimals of 38 digits.

Defined results: a null language is ``und``; a null or empty text has no words. Rows that
repeat an id or a text count each time. A huge text is read in pieces of about ``PIECE``
bytes, cut between words, and keeps all its phrases. An empty table gives no rows. Extra
columns are ignored. Ties go to the higher count, then to the phrase that is first by bytes.
"""

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellbulk.llm.common import LOWER, UPPER, by_bytes, text_of
from cellbulk.session import discard, saved

BITS, SEED = 1 << 24, 42
MIX = np.uint64(0x9E3779B97F4A7C15)
PIECE, HELD = 1 << 20, 400_000
RANGE_ROWS = 100_000
BREAK = b"."
_STOPS = ".,;:!?\x0a\x0b\x0c\x0d"
_TABLE = bytes.maketrans(f"{UPPER}{_STOPS}\t".encode(), f"{LOWER}{'.' * len(_STOPS)} ".encode())


def token_runs(texts: list[str], longest: int, piece: int) -> Iterator[tuple[list[bytes], int]]:
    """Words and breaks of texts, and how many of them may start a suffix; the rest
    stands there as context and comes again at the start of the next run."""
    data = "\n".join(texts).encode("utf-8").translate(_TABLE)
    start, kept = 0, []
    while start < len(data):
        stop = data.find(b" ", start + piece)
        stop = len(data) if stop < 0 else stop
        tokens = kept + data[start:stop].replace(BREAK, b" . ").split()
        own = len(tokens) if stop == len(data) else max(0, len(tokens) - longest + 1)
        yield tokens, own
        start, kept = stop, tokens[own:]


class FrequentBits:
    """Membership of hashed frequent phrases; never misses one."""

    def __init__(self, hashes: DataFrame):
        """``hashes``: one column of longs."""
        spot = F.col(hashes.columns[0]).bitwiseAND(BITS - 1) + 1
        found = hashes.select(spot.alias("spot")).groupBy(F.bitmap_bucket_number("spot").alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("spot")).alias("bits")).collect()
        self.last = np.uint64(BITS - 1)
        self.bits = np.zeros(BITS // 8, np.uint8)
        for row in found:
            at = (row.bucket - 1) * len(row.bits)
            self.bits[at:at + len(row.bits)] = np.frombuffer(row.bits, np.uint8)

    def have(self, hashes: np.ndarray) -> np.ndarray:
        spots = hashes & self.last
        return (self.bits[spots >> np.uint64(3)] >> (spots & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def word_hash(lang: Column, word: Column) -> Column:
    return F.xxhash64(F.concat_ws("\0", lang, word))


def tallied(docs: DataFrame, longest: int, named: Callable[[str, list[bytes], int], list[bytes]]) -> DataFrame:
    """(lang, phrase, n): what is ``named`` in runs of tokens, added up per task while memory allows, then by Spark."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, Counter] = {}
        for batch in batches:
            for lang, rows in batch.groupby("lang", sort=False):
                counts = held.setdefault(lang, Counter())
                for texts in by_bytes(rows["text"], PIECE):
                    for tokens, own in token_runs(texts, longest, PIECE):
                        counts.update(named(lang, tokens, own))
                        if sum(map(len, held.values())) > HELD:
                            yield from passed_on(held)
        yield from passed_on(held)

    def passed_on(held: dict[str, Counter]) -> Iterator[pd.DataFrame]:
        for lang, counts in held.items():
            names = list(counts)
            for start in range(0, len(names), 1 << 16):
                part = names[start:start + (1 << 16)]
                yield pd.DataFrame({"lang": lang, "phrase": [p.decode("utf-8") for p in part], "n": [counts[p] for p in part]})
            counts.clear()

    rows = docs.select("lang", "text").mapInPandas(run, "lang string, phrase string, n long")
    return rows.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def _words(lang: str, tokens: list[bytes], own: int) -> list[bytes]:
    """Every word, and for their number an empty one each: no word is empty."""
    words = [t for t in tokens[:own] if t != BREAK]
    return words + [b""] * len(words)


class Links:
    """Neighbouring tokens that may belong to a frequent phrase."""

    def __init__(self, words: FrequentBits, pairs: FrequentBits | None = None):
        self.words, self.pairs, self.most = words, pairs, HELD // 2
        self.known: dict[str, dict[bytes, int]] = {}

    def hashes(self, lang: str, tokens: list[bytes]) -> np.ndarray:
        """The hash of each frequent word; zero for others and for breaks."""
        from xxhash import xxh64_intdigest

        known = self.known.setdefault(lang, {BREAK: 0})
        fresh = [t for t in set(tokens) if t not in known]
        before = lang.encode() + b"\0"
        made = np.fromiter((xxh64_intdigest(before + t, SEED) for t in fresh), np.uint64, len(fresh))
        known.update(zip(fresh, np.where(self.words.have(made), made | np.uint64(1), np.uint64(0)).tolist()))
        found = np.fromiter(map(known.__getitem__, tokens), np.uint64, len(tokens))
        if sum(map(len, self.known.values())) > self.most:
            self.known.clear()
        return found

    def pairs_of(self, lang: str, tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Places where two frequent words of a piece follow each other, and the pairs' hashes."""
        found = self.hashes(lang, tokens)
        at = np.flatnonzero((found[:-1] > 0) & (found[1:] > 0))
        mixed = (found[at] * MIX + found[at + 1]) * MIX
        return at, mixed ^ mixed >> np.uint64(29)

    def suffixes(self, lang: str, tokens: list[bytes], own: int, longest: int) -> list[bytes]:
        at, pairs = self.pairs_of(lang, tokens)
        link = np.zeros(len(tokens) + longest, np.int64)
        link[at] = self.pairs.have(pairs)
        words = np.ones(len(tokens), np.int64)
        for ahead in range(longest - 2, -1, -1):  # 1 + link * (1 + the next link * ...)
            words = 1 + link[ahead:ahead + len(tokens)] * words
        starts = np.flatnonzero(words[:own] > 1)
        return [b" ".join(tokens[i:i + n]) + b" " for i, n in zip(starts.tolist(), words[starts].tolist())]


def pair_counts(docs: DataFrame, longest: int, links: Links) -> DataFrame:
    """(pair, n): how often the pairs of a hash occur. Pairs that share one add up, which
    keeps them all the same."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for batch in batches:
            for lang, rows in batch.groupby("lang", sort=False):
                for texts in by_bytes(rows["text"], PIECE):
                    for tokens, own in token_runs(texts, longest, PIECE):
                        at, pairs = links.pairs_of(lang, tokens)
                        held.append(pairs[at < own])
                        size += len(held[-1])
                        if size > 4 * HELD:
                            yield passed_on(held)
                            held, size = [], 0
        if held:
            yield passed_on(held)

    def passed_on(held: list[np.ndarray]) -> pd.DataFrame:
        pairs, n = np.unique(np.concatenate(held), return_counts=True)
        return pd.DataFrame({"pair": pairs.view(np.int64), "n": n})

    rows = docs.select("lang", "text").mapInPandas(run, "pair long, n long")
    return rows.groupBy("pair").agg(F.sum("n").alias("n"))


def equal_partitions(suffixes: np.ndarray, weight: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """(row, words, count) of every phrase of at least two words and ``least`` weight: the
    first ``words`` numbers of that row of ``suffixes``, where zero ends a suffix."""
    longest = suffixes.shape[1]
    stack = [(np.arange(len(suffixes)), 0)]
    while stack:
        pointers, depth = stack.pop()
        if weight[pointers].sum() < least:
            continue  # abandoned
        word = suffixes[pointers, depth]
        pivot = word[len(word) // 2]
        equal = pointers[word == pivot]
        if len(equal) < len(pointers):
            stack += [(pointers[word < pivot], depth), (pointers[word > pivot], depth)]
        count = int(weight[equal].sum())
        if pivot and count >= least:
            if depth:
                yield int(equal[0]), depth + 1, count
            if depth + 1 < longest:
                stack.append((equal, depth + 1))


def range_counts(rows: pd.DataFrame, least: int, longest: int) -> pd.DataFrame:
    """(lang, phrase, words, n) of one range of suffixes (lang, suffix, n). Each suffix ends
    with a space, so suffixes that start with a phrase stand together in the order."""
    found = []
    edges = [min(zip(rows["lang"], rows["suffix"])), max(zip(rows["lang"], rows["suffix"]))]
    for lang, part in rows.groupby("lang", sort=False):
        split = [s[:-1].split(" ") for s in part["suffix"]]
        numbers: dict[str, int] = {}
        suffixes = np.zeros((len(split), longest), np.int32)
        for i, words in enumerate(split):
            for k, word in enumerate(words):
                suffixes[i, k] = numbers.setdefault(word, len(numbers) + 1)
        weight = part["n"].to_numpy(np.int64)
        edge = set()
        for words in [e[1][:-1].split(" ") for e in edges if e[0] == lang]:
            edge |= {tuple(words[:k]) for k in range(2, len(words) + 1)}
        for words in edge:
            inside = (suffixes[:, :len(words)] == [numbers[w] for w in words]).all(axis=1)
            found.append((lang, " ".join(words), len(words), int(weight[inside].sum())))
        for row, k, n in equal_partitions(suffixes, weight, least):
            if tuple(split[row][:k]) not in edge:
                found.append((lang, " ".join(split[row][:k]), k, n))
    return pd.DataFrame(found, columns=["lang", "phrase", "words", "n"])


def phrase_counts(docs: DataFrame, least: int = 100, longest: int = 5) -> tuple[DataFrame, DataFrame]:
    """Frequent words (lang, phrase, n), where the empty one has the number of all words of
    a language, and frequent phrases of two words and more (lang, phrase, words, n)."""
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), text_of().alias("text"))
    words = saved(tallied(texts, longest, _words).where((F.col("n") >= least) | (F.col("phrase") == "")), "words")
    word_bits = FrequentBits(words.select(word_hash(F.col("lang"), F.col("phrase"))))
    pairs = saved(pair_counts(texts, longest, Links(word_bits)).where(F.col("n") >= least).select("pair"), "pairs")
    chains = Links(word_bits, FrequentBits(pairs))
    discard(pairs)
    routed = saved(tallied(texts, longest, lambda lang, tokens, own: chains.suffixes(lang, tokens, own, longest)).withColumnRenamed("phrase", "suffix"), "suffixes")
    ranges = max(1, -(-routed.count() // RANGE_ROWS))

    def sort(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [batch for batch in batches if len(batch)]
        if held:
            yield range_counts(pd.concat(held, ignore_index=True), least, longest)

    parts = routed.repartitionByRange(ranges, "lang", "suffix").mapInPandas(
        sort, "lang string, phrase string, words int, n long")
    phrases = saved(parts.groupBy("lang", "phrase").agg(F.max("words").alias("words"), F.sum("n").alias("n")).where(
        F.col("n") >= least), "phrases")
    discard(routed)
    return words, phrases


def collocations(docs: DataFrame, least: int = 100, longest: int = 5, most: int = 2000, share: int = 100) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): for each language the first ``most`` phrases
    by the score of their weakest cut, without those of which a longer phrase that holds
    them has at least ``share`` per cent."""
    words, phrases = phrase_counts(docs, least, longest)
    counts = words.unionByName(phrases.drop("words"))
    apart = phrases.withColumn("w", F.split("phrase", " "))

    def some(start, length):
        return F.array_join(F.slice("w", start, length), " ")

    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda k: F.transform(
        F.sequence(F.lit(1), F.col("words") - k + 1), lambda s: some(s, k))))
    longer = apart.where("words > 2").select("lang", F.explode(inner).alias("phrase"), F.col("n").alias("outer")).groupBy(
        "lang", "phrase").agg(F.max("outer").alias("outer"))
    cuts = apart.select("lang", "phrase", F.col("n").alias("a"), "words", "w", F.explode(
        F.sequence(F.lit(1), F.col("words") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", some(F.lit(1), F.col("k")).alias("first"),
        some(F.col("k") + 1, F.col("words") - F.col("k")).alias("rest"))
    whole = words.where("phrase = ''").select("lang", "n")
    scored = cuts.join(counts.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l")), ["lang", "first"]).join(
        counts.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r")), ["lang", "rest"]).join(whole, "lang").withColumn(
        "score", F.expr("cast(1000 as decimal(38, 0)) * a * n div (cast(l as decimal(38, 0)) * r)"))
    weakest = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    kept = weakest.join(longer, ["lang", "phrase"], "left").where(
        F.col("outer").isNull() | (100 * F.col("outer") < share * F.col("a")))
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    return kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"),
        F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
