"""Token ids in binary shards: one zstandard frame per document, one shared dictionary.

Layout below a folder:

``dictionary``  Parquet, one row: the dictionary and its hash (empty for tiny inputs)
``shards``      binary files, in document order within and across part numbers
``index``       Parquet: doc_id, start, n_tokens, ids_crc32, file, offset, length

A shard is a valid zstandard stream. Each document is a skippable frame with its header
(version, bytes per id, id, dictionary hash, token count, frame length) and one frame of
the ids, little-endian. Empty skippable frames stand between documents: they are the
line separator of Spark's text writer, which writes the shards, so that commits,
retries and any store are Spark's business. The index gives the byte range of a
document, and the hash in every header names the dictionary that opens it.

Defined results: null and empty texts hold the end id alone. A null id is stored as
such and sorts first; repeated ids follow each other. Extra columns are ignored.
"""

import hashlib
import json
import re
import struct
import zlib
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellbulk.llm.common import by_bytes, runs_of, text_of
from cellbulk.llm.token_count import MEMORY, PieceMemory, loaded, pieces

HEADER = "<II4sBBxxqQII"
HEADER_BYTES = struct.calcsize(HEADER)
MAGIC, KIND = 0x184D2A51, b"TOK1"
SEPARATOR = struct.pack("<II", 0x184D2A50, 0).decode("ascii")
RUN = 1 << 22  # characters encoded at a time
DICTIONARY_BYTES, DICTIONARY_DOCS, DICTIONARY_DOC_BYTES = 65_536, 1_000, 32_768


class WordEncoder(PieceMemory):
    """Serialised ids of pieces."""

    def __init__(self, tokenizer, memory: int = MEMORY):
        super().__init__(tokenizer, memory)
        self.kind = np.dtype("<u2" if tokenizer.get_vocab_size() <= 1 << 16 else "<u4")

    def value(self, encoded) -> bytes:
        return np.array(encoded.ids, self.kind).tobytes()


class ListedWords(WordEncoder):
    """Serialised ids of clean words, for a vocabulary whose words end in a token that says so.

    New words are encoded as one list with spaces between them, and the ids are cut where a
    word ends, so that no result is made for each word.
    """

    def __init__(self, tokenizer, memory: int):
        super().__init__(tokenizer, memory)
        ends = np.zeros(tokenizer.get_vocab_size(), bool)
        suffix = tokenizer.model.end_of_word_suffix
        ends[[i for token, i in tokenizer.get_vocab().items() if token.endswith(suffix)]] = True
        self.ends = ends

    def fresh(self, new: set[str]) -> dict:
        found = {}
        for run in by_bytes(new):
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(run)], add_special_tokens=False)[0].ids, np.int64)
            stops = (np.flatnonzero(self.ends[ids]) + 1) * self.kind.itemsize
            if len(stops) != len(run):  # a word without such a token, or one that holds a space
                found |= super().fresh(set(run))
                continue
            whole, stops = ids.astype(self.kind).tobytes(), stops.tolist()
            found.update(zip(run, [whole[a:b] for a, b in zip([0, *stops], stops)]))
        return found


class PieceEncoder(WordEncoder):
    """Serialised ids of texts, joined from those of their pieces.

    Pieces begin at spaces that follow a non-space character. Both kinds of vocabulary
    here split there whatever stands around, so ids of pieces join to ids of the text.
    Pieces of plain letters are cut further into the words that a vocabulary with word
    ends splits them into. Then only the words are remembered, which are far fewer, and the
    pieces of a run of texts are made from them anew.
    """

    def __init__(self, tokenizer, memory: int = MEMORY):
        bare = without_splitting(tokenizer)
        super().__init__(tokenizer, memory // 4 if bare else memory)
        self.words = ListedWords(bare, memory // 2) if bare else None

    def encode(self, texts: Sequence[str] | pa.Array) -> Iterator[bytes]:
        if self.words is not None:
            held = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
            for start, stop in runs_of(held, RUN):
                yield from self.gathered(held.slice(start, stop - start))
            return
        for run in by_bytes(texts.to_pylist() if isinstance(texts, pa.Array) else texts):
            cut = [pieces(text) for text in run]
            known = self.known(cut)
            for own in cut:
                yield b"".join(map(known.__getitem__, own))

    def gathered(self, run: pa.Array) -> Iterator[bytes]:
        """Ids of a run of texts, for a vocabulary with word ends: it drops white space, so
        any space or line break parts the text. Arrow splits the run and numbers its
        distinct parts; only those are looked up, and their ids are gathered by number."""
        parts = pc.split_pattern(pc.replace_substring(run.cast(pa.large_string()), "\n", " "), " ")
        numbered = parts.flatten().dictionary_encode()
        ids, upto = picked(*self.of_pieces(numbered.dictionary), numbered.indices.to_numpy())
        stops = upto[parts.offsets.to_numpy()]
        for start, stop in zip(stops[:-1].tolist(), stops[1:].tolist()):
            yield ids[start:stop].tobytes()

    def of_pieces(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids of the pieces, and where those of each piece begin and how many they are."""
        odd = pc.match_substring_regex(distinct, ODD)
        ids, sizes = self.of_plain(distinct.filter(pc.invert(odd)))
        rest, rest_sizes = self.flat(self.values(distinct.filter(odd).to_pylist()))
        held, which = np.empty(len(distinct), np.int64), odd.to_numpy(zero_copy_only=False)
        held[~which], held[which] = sizes, rest_sizes
        begin = np.empty(len(distinct), np.int64)
        begin[~which], begin[which] = np.cumsum(sizes) - sizes, np.cumsum(rest_sizes) - rest_sizes + len(ids)
        return np.concatenate([ids, rest]), begin, held

    def of_plain(self, plain: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of plain pieces in a row, and how many each has: one search cuts them all
        into words, a line break ending each piece."""
        if not len(plain):
            return self.flat([])
        row = "\n".join(plain.to_numpy(zero_copy_only=False).tolist()).lower() + "\n"
        words = pa.array(ENDED.findall(row), pa.large_string()).dictionary_encode()
        distinct, number = words.dictionary.to_numpy(zero_copy_only=False).tolist(), words.indices.to_numpy()
        end = distinct.index("\n")
        values = self.words.values(distinct[:end] + distinct[end + 1:])
        ids, sizes = self.flat([*values[:end], b"", *values[end:]])
        ids, upto = picked(ids, np.cumsum(sizes) - sizes, sizes, number)
        return ids, np.diff(upto[1:][number == end], prepend=0)

    def flat(self, values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.fromiter(map(len, values), np.int64, len(values)) // self.kind.itemsize
        return np.frombuffer(b"".join(values), self.kind), sizes


def picked(ids: np.ndarray, begin: np.ndarray, sizes: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the numbered pieces in that order, and how many there are before each and in all."""
    held = sizes[number]
    upto = np.concatenate([[0], np.cumsum(held)])
    spots = np.repeat((begin[number] - upto[:-1]).astype(np.int32), held)
    spots += np.arange(len(spots), dtype=np.int32)
    return ids[spots], upto


# How the vocabulary with word ends cleans and splits text. For ASCII and
# Latin-1 letters, which are not ODD, ENDED says the same: such text is its own NFC form and
# each letter has one lower-case letter. ENDED takes line breaks, the ends of pieces, too.
CLEANING = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLITTING = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
ODD = r"[^\t -~À-ÖØ-öø-ÿ]|<\|"
ENDED = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[!-/:-@\[-`{-~]+|\n")


def without_splitting(tokenizer):
    """The same model for words already cleaned and parted by spaces; None if it works otherwise."""
    from tokenizers import Tokenizer

    made = json.loads(tokenizer.to_str())
    steps = (made["pre_tokenizer"] or {}).get("pretokenizers", [{}])
    if made["normalizer"] != CLEANING or steps[0].get("pattern") != {"Regex": SPLITTING} or len(steps) != 2:
        return None
    if not made["model"].get("end_of_word_suffix"):
        return None
    parted = {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, steps[1]]}
    return Tokenizer.from_str(json.dumps(made | {"normalizer": None, "pre_tokenizer": parted}))


@lru_cache(maxsize=2)
def piece_encoder(path: str) -> PieceEncoder:
    """One per Python worker, which runs many tasks."""
    return PieceEncoder(loaded(path))


def hash_of(dictionary: bytes) -> int:
    """The first eight bytes of its SHA-256; zero stands for no dictionary."""
    return int.from_bytes(hashlib.sha256(dictionary).digest()[:8], "little") if dictionary else 0


def train_dictionary(docs: DataFrame, tokenizer_path: str, key: str, text: str) -> bytes:
    """Trained on about 1,000 documents of up to 32 KB, taken by the hash of their id.

    The bound is on what the dictionary is fitted to; every document is encoded whole.
    """
    import zstandard

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = piece_encoder(tokenizer_path)
        for batch in batches:
            yield pd.DataFrame({"ids": list(encoder.encode(batch["text"].tolist()))})

    share = 1.0 if (n := docs.count()) <= DICTIONARY_DOCS else DICTIONARY_DOCS / n
    spot = F.pmod(F.xxhash64(key), F.lit(1 << 24)) < int(share * (1 << 24)) + 1
    chosen = docs.where(spot & (F.octet_length(text) <= DICTIONARY_DOC_BYTES)).select(
        text_of(text).alias("text")).limit(2 * DICTIONARY_DOCS)
    samples = [bytes(r.ids) for r in chosen.mapInPandas(run, "ids binary").collect() if len(r.ids) >= 8]
    if len(samples) < 64:  # too few to train on: their own content, in a fixed order, is the dictionary
        return b"".join(sorted(samples))[:DICTIONARY_BYTES]
    return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()


def _opened(dictionary: bytes):
    import zstandard

    return zstandard.ZstdCompressionDict(dictionary) if dictionary else None


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 1, key: str = "doc_id",
                 text: str = "text", order: Sequence[str] | None = None, level: int = 3,
                 docs_per_file: int = 50_000) -> None:
    """Encode every whole text, append ``end_id`` and write the shards in ``order``."""
    import zstandard

    dictionary = train_dictionary(docs, tokenizer_path, key, text)
    docs.sparkSession.createDataFrame(
        [(format(hash_of(dictionary), "016x"), bytearray(dictionary))], "hash string, dictionary binary"
    ).coalesce(1).write.parquet(f"{path}/dictionary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = piece_encoder(tokenizer_path)
        given = _opened(dictionary)
        packer = zstandard.ZstdCompressor(level=level, **({"dict_data": given} if given else {}))
        width, end = encoder.kind.itemsize, np.array([end_id], encoder.kind).tobytes()
        for whole in batches:
            # A run at a time, so that a batch is not held a second and third time.
            for batch in (whole.slice(a, b - a) for a, b in runs_of(whole.column("text"), RUN)):
                keys, nulls = batch.column("key").fill_null(0).to_pylist(), batch.column("key").is_null().to_pylist()
                records = []
                for doc_id, null, ids in zip(keys, nulls, encoder.encode(batch.column("text"))):
                    ids += end
                    frame = packer.compress(ids)
                    records.append(struct.pack(HEADER, MAGIC, HEADER_BYTES - 8, KIND, width, int(null), doc_id,
                                               hash_of_dictionary, len(ids) // width, len(frame)) + frame)
                yield pa.RecordBatch.from_arrays([pa.array(records, pa.binary())], ["value"])

    hash_of_dictionary = hash_of(dictionary)
    keys = list(order or [key])
    rows = docs.select(*[F.col(k).alias(f"_o{i}") for i, k in enumerate(keys)],
                       F.col(key).cast("long").alias("key"), text_of(text).alias("text"))
    sort = [f"_o{i}" for i in range(len(keys))]
    dealt = rows.repartitionByRange(*sort).sortWithinPartitions(*sort, "text").select("key", "text")
    (dealt.mapInArrow(run, "value binary").select(F.col("value").cast("string"))
     .write.option("lineSep", SEPARATOR).option("maxRecordsPerFile", docs_per_file).text(f"{path}/shards"))


def documents_in(content: memoryview) -> Iterator[tuple[int | None, int, int, int, int, int, memoryview]]:
    """(doc id, bytes per id, dictionary hash, tokens, offset, length, frame) of a shard."""
    at = 0
    while at < len(content):
        magic, size = struct.unpack_from("<II", content, at)
        if magic != MAGIC:
            at += 8 + size
            continue
        _, _, kind, width, null, doc_id, used, tokens, length = struct.unpack_from(HEADER, content, at)
        if kind != KIND:
            raise ValueError("not a token shard")
        begin = at + HEADER_BYTES
        yield (None if null else doc_id), width, used, tokens, at, HEADER_BYTES + length, content[begin:begin + length]
        at = begin + length


def opener(dictionary: bytes) -> Callable[[memoryview, int, int, int], np.ndarray]:
    """A function that returns the ids of a frame; it refuses frames of another dictionary."""
    import zstandard

    given, expected = _opened(dictionary), hash_of(dictionary)
    unpacker = zstandard.ZstdDecompressor(**({"dict_data": given} if given else {}))

    def ids(frame: memoryview, width: int, tokens: int, used: int) -> np.ndarray:
        if used != expected:
            raise ValueError(f"needs dictionary {used:016x}, got {expected:016x}")
        found = np.frombuffer(unpacker.decompress(frame, max_output_size=tokens * width), f"<u{width}")
        if len(found) != tokens:
            raise ValueError("the frame does not hold the tokens its header states")
        return found

    return ids


def dictionary_of(spark: SparkSession, path: str) -> bytes:
    return bytes(spark.read.parquet(f"{path}/dictionary").first().dictionary)


INDEX = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()),
                   ("before", pa.int64()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])


def write_index(spark: SparkSession, path: str) -> DataFrame:
    """Read every shard back, decode every document and write the index of the folder."""
    dictionary = dictionary_of(spark, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = opener(dictionary)
        for batch in batches:
            for file, content in zip(batch.column("path"), batch.column("content")):
                rows, before = [], 0
                for doc_id, width, used, tokens, offset, length, frame in documents_in(memoryview(content.as_buffer())):
                    ids = decode(frame, width, tokens, used).astype("<u4")
                    rows.append((doc_id, tokens, zlib.crc32(ids), before, file.as_py(), offset, length))
                    before += tokens
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [()] * len(INDEX), INDEX)], schema=INDEX)

    shards = spark.read.format("binaryFile").load(f"{path}/shards").select("path", "content")
    kinds = "doc_id long, n_tokens long, ids_crc32 long, before long, file string, offset long, length long"
    shards.mapInArrow(run, kinds).write.parquet(f"{path}/documents")
    found = spark.read.parquet(f"{path}/documents")
    starts = file_starts(found.groupBy("file").agg(F.sum("n_tokens").alias("n")))
    indexed = found.join(starts, "file").select(
        "doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32", "file", "offset", "length")
    indexed.write.parquet(f"{path}/index")
    return spark.read.parquet(f"{path}/index")


def file_starts(files: DataFrame) -> DataFrame:
    """(file, start): tokens in all files before it, by part number, in two levels."""
    part = [F.regexp_extract("file", r"part-(\d+)", 1).cast("long"),
            F.coalesce(F.expr(r"try_cast(regexp_extract(file, '-c(\\d+)', 1) as long)"), F.lit(0))]
    numbered = files.withColumns({"part": part[0], "piece": part[1], "band": F.floor(part[0] / 1024)})
    bands = numbered.groupBy("band").agg(F.sum("n").alias("held"))
    ahead = Window.orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    bands = bands.select("band", F.coalesce(F.sum("held").over(ahead), F.lit(0)).alias("ahead"))
    within = Window.partitionBy("band").orderBy("part", "piece").rowsBetween(Window.unboundedPreceding, -1)
    return numbered.withColumn("inside", F.coalesce(F.sum("n").over(within), F.lit(0))).join(bands, "band").select(
        "file", (F.col("ahead") + F.col("inside")).alias("start"))


def read_tokens(spark: SparkSession, path: str, doc_ids: Sequence[int]) -> DataFrame:
    """(doc_id, ids) of a few documents: the index names their shards and byte ranges."""
    dictionary, wanted = dictionary_of(spark, path), [int(i) for i in doc_ids]
    spans = spark.read.parquet(f"{path}/index").where(F.col("doc_id").isin(wanted)).groupBy("file").agg(
        F.collect_list(F.struct("doc_id", "offset", "length")).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = opener(dictionary)
        for batch in batches:
            for spans, content in zip(batch.column("spans").to_pylist(), batch.column("content")):
                whole = memoryview(content.as_buffer())
                for span in spans:
                    cut = whole[span["offset"]:span["offset"] + span["length"]]
                    doc_id, width, used, tokens, _, _, frame = next(documents_in(cut))
                    ids = decode(frame, width, tokens, used)
                    yield pa.RecordBatch.from_pydict({"doc_id": [doc_id], "ids": [ids.tolist()]},
                        pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int64()))]))

    names = [r.file for r in spans.select("file").collect()]  # at most one per wanted id
    if not names:
        return spark.createDataFrame([], "doc_id long, ids array<long>")
    shards = spark.read.format("binaryFile").load(names).select(F.col("path").alias("file"), "content")
    return shards.join(spans, "file").select("spans", "content").mapInArrow(run, "doc_id long, ids array<long>")
