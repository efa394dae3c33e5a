"""Token ids in binary files, compressed by a Re-Pair grammar per shard.

A file holds the ids of whole documents that follow each other by id, cut into
shards of SHARD ids wherever that falls. Little-endian:

    magic, 8 bytes
    u32 documents, u32 shards, u64 range, u64 first position, u64 ids
    per document: i64 id; then u8, 0 if the id is NULL; then u64 position of its end in the file
    per shard: u64 first byte, u64 first position; then the shards as ``repair`` packs them

Positions count ids. A range of document ids is written by one task and may take
several files; the first position is that of the file in its range. Whoever reads
a part of a file finds the shards by their first positions and expands only
symbols that stand for wanted ids.
"""

from __future__ import annotations

import os
import sys
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffinlens.plans.lineage import scratch_path
from tiffinlens.plans.scan import running_sum_before

from . import repair
from .bpe import byte_alphabet
from .flat import lists, starts_of, values_of
from .staging import staged

MAGIC = b"REPAIR01"
HEAD = np.dtype([("documents", "<u4"), ("shards", "<u4"), ("range", "<u8"), ("first", "<u8"), ("ids", "<u8")])
SHARD = 1 << 19
# Ids after which a file ends, at the next document: what bounds memory while writing and reading.
FILE_IDS = 1 << 23
# Characters of the texts encoded at once.
BATCH = 1 << 23


@cache
def _tokenizer(content: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    from tokenizers import Tokenizer

    return Tokenizer.from_str(content)


@cache
def _merges(content: str):
    """(the tokenizer's merges alone, words parted at spaces and made of ``_shown`` bytes; which ids end a word)."""
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import CharDelimiterSplit

    model = _tokenizer(content).model
    out = Tokenizer(model)
    out.pre_tokenizer = CharDelimiterSplit(" ")
    ends = np.zeros(out.get_vocab_size(), bool)
    ends[[i for token, i in out.get_vocab().items() if token.endswith(model.end_of_word_suffix)]] = True
    return out, ends


# The character that the byte-level files have for each byte; a space stays one.
SHOWN = np.array([" " if byte == 32 else char for byte, char in enumerate(byte_alphabet())], "U1").view(np.uint32)


def _shown(text: str) -> str:
    return SHOWN[np.frombuffer(text.encode(), np.uint8)].tobytes().decode(f"utf-32-{sys.byteorder[0]}e")


# Latin, Cyrillic and Greek letters, in lower case and in both: normalising does no more to them than fold case.
LOWER = "a-zß-öø-ÿа-яα-ω"
BOTH = LOWER + "A-ZÀ-ÖØ-ÞА-ЯΑ-ΡΣ-Ω"
# ASCII marks but the apostrophe and the bar.
MARKS = r"!-&(-/:-@\[-`{}~"
# Letters that normalising and splitting leave as they are.
LETTERS = f"^[{LOWER}]+$"
# What the file's pattern parts into runs of letters, runs of marks, and digits: of apostrophes it knows some
# endings, and special tokens have bars.
SIMPLE = f"^[{BOTH}0-9{MARKS}]+$"
RUNS = f"([{BOTH}]+|[0-9]|[{MARKS}]+)"
# Words of them that are handed over at once.
JOINED = 128
# What is not folded first: special tokens, which are told before, and letters that marks are put on in lower case only.
UNFOLDED = r"<\||[HJTWY][^\x00-\x7F]"
# Marks that the file's pattern always parts from a letter before them.
STOPS = f"([{BOTH}])([{MARKS}])"


# Bytes and number of the words whose ids a worker keeps from batch to batch.
KNOWN_BYTES = 1 << 24
KNOWN_WORDS = 1 << 19


@dataclass
class _Known:
    """Distinct words and the ids of each, as ``lists``."""

    words: pa.Array
    ids: pa.LargeBinaryArray


@cache
def _known(content: str) -> list[_Known]:
    """What this worker keeps: one table, which ``_encode_words`` replaces."""
    return [_Known(pa.array([], pa.string()), lists(np.zeros(0, np.uint32), np.zeros(1, np.int64)))]


def _encode_words(words: pa.Array, content: str) -> pa.LargeBinaryArray:
    """The ids of distinct words as ``lists``; those of batches before are looked up.

    When more words are known than may be kept, those of this batch are kept alone if they are not too many.
    """
    known, words = _known(content)[0], words.cast(pa.string())
    place = pc.fill_null(pc.index_in(words, value_set=known.words), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    new = np.flatnonzero(place < 0)
    added = words.take(pa.array(new))
    place[new] = len(known.words) + np.arange(len(new))
    table = pa.concat_arrays([known.ids, _encode_new(added, content)])
    ids = table.take(pa.array(place))

    def kept(size: int, chars: int) -> bool:
        return size <= KNOWN_WORDS and chars <= KNOWN_BYTES

    def chars(some: pa.Array) -> int:
        return pc.sum(pc.binary_length(some)).as_py() or 0

    if kept(len(known.words) + len(new), chars(known.words) + chars(added)):
        _known(content)[0] = _Known(pa.concat_arrays([known.words, added]), table)
    elif kept(len(words), chars(words)):
        _known(content)[0] = _Known(words, ids)
    return ids


def _encode_new(words: pa.Array, content: str) -> pa.LargeBinaryArray:
    """The ids of distinct words as ``lists``; those of LETTERS alone and SIMPLE ones go to the merges at once."""
    plain = pc.match_substring_regex(words, LETTERS).to_numpy(zero_copy_only=False)
    order = np.argsort(~plain, kind="stable")
    plains, others = (words.take(pa.array(some)) for some in np.split(order, [plain.sum()]))
    simple = pc.match_substring_regex(others, SIMPLE).to_numpy(zero_copy_only=False)
    order[len(plains) :] = order[len(plains) :][np.argsort(~simple, kind="stable")]
    # The runs of a simple word are parted by spaces.
    lower = pc.utf8_lower(others.filter(pa.array(simple)).cast(pa.large_string()))
    runs = pc.utf8_rtrim(pc.replace_substring_regex(lower, RUNS, r"\1 "), " ")
    some = plains.to_numpy(zero_copy_only=False).tolist() + runs.to_numpy(zero_copy_only=False).tolist()
    pieces = np.concatenate([np.ones(len(plains), np.int64), 1 + pc.count_substring(runs, " ").to_numpy(zero_copy_only=False)])
    merges, ends = _merges(content)
    joined = [_shown(" ".join(some[at : at + JOINED])) for at in range(0, len(some), JOINED)]
    first = _ids(merges.encode_batch_fast(joined, add_special_tokens=False))
    bounds = np.concatenate([[0], 1 + np.flatnonzero(ends[first])])[starts_of(pieces)]
    rest = others.filter(pa.array(~simple)).to_numpy(zero_copy_only=False).tolist()
    found = _tokenizer(content).encode_batch_fast(rest, add_special_tokens=False)
    sizes = np.fromiter((len(e) for e in found), np.int64, len(found))
    at = np.zeros(len(words), np.int64)
    at[order] = np.arange(len(words))
    every = lists(np.concatenate([first, _ids(found)]), np.concatenate([bounds, bounds[-1] + np.cumsum(sizes)]))
    return every.take(pa.array(at))


def _ids(found: list) -> np.ndarray:
    return np.array(list(chain.from_iterable(e.ids for e in found)), np.uint32)


def encode(texts: pa.Array, content: str) -> tuple[np.ndarray, np.ndarray]:
    """(all ids, ids per text) by a tokenizer file that folds case and drops white space.

    Words between white space are encoded alone, and so are marks behind letters:
    no token and no special token goes over such a place, and normalising does not
    either. Words that come up again are encoded once.
    """
    split = pc.ascii_split_whitespace(texts.fill_null(""))
    words = split.flatten().dictionary_encode()
    # ASCII letters only: what folding does to others, the tokenizer knows.
    known = words.dictionary
    folded = pc.if_else(pc.match_substring_regex(known, UNFOLDED), known, pc.ascii_lower(known))
    parted = pc.ascii_split_whitespace(pc.replace_substring_regex(folded, STOPS, r"\1 \2"))
    parts = parted.flatten().dictionary_encode()
    table = _encode_words(parts.dictionary, content)
    for codes, number in ((parts, parted), (words, split)):
        # The ids of each part of a word, then of each word of a text.
        ids, bounds = values_of(table.take(codes.indices))
        bounds = bounds[starts_of(pc.list_value_length(number).to_numpy(zero_copy_only=False))]
        table = lists(ids, bounds)
    return ids, np.diff(bounds)


@dataclass
class TokenFile:
    """A file taken apart: its documents (None for a NULL id), their ends, and its shards."""

    range: int
    first: int
    documents: list[int | None]
    ends: np.ndarray
    starts: np.ndarray
    bytes_at: np.ndarray
    data: bytes

    def shard(self, number: int) -> repair.Shard:
        return repair.unpack(memoryview(self.data)[int(self.bytes_at[number]) :])

    def between(self, start: int, end: int) -> np.ndarray:
        """The ids at positions ``start`` up to ``end`` of the file."""
        if end <= start:
            return np.zeros(0, np.uint32)
        found = []
        low, high = np.searchsorted(self.starts, [start, end - 1], "right") - 1
        for number in range(low, high + 1):
            begin = int(self.starts[number])
            found.append(repair.ids_between(self.shard(number), max(0, start - begin), min(SHARD, end - begin)))
        return np.concatenate(found)

    def document(self, number: int) -> np.ndarray:
        """The ids of one document, the end id last."""
        return self.between(int(self.ends[number - 1]) if number else 0, int(self.ends[number]))


def make_file(place: int, first: int, documents: list[int | None], lengths: np.ndarray, ids: np.ndarray, base: int) -> bytes:
    shards = [repair.pack(repair.compress(ids[at : at + SHARD], base)) for at in range(0, len(ids), SHARD)]
    head = np.array([(len(documents), len(shards), place, first, len(ids))], HEAD)
    index = [
        np.array([i or 0 for i in documents], "<i8").tobytes(),
        np.array([i is not None for i in documents], "u1").tobytes(),
        np.cumsum(lengths).astype("<u8").tobytes(),
    ]
    front = len(MAGIC) + head.nbytes + sum(map(len, index)) + 16 * len(shards)
    table = np.zeros((len(shards), 2), "<u8")
    table[:, 0] = front + starts_of(np.array([len(s) for s in shards], np.int64))[:-1]
    table[:, 1] = np.arange(len(shards)) * SHARD
    return b"".join([MAGIC, head.tobytes(), *index, table.tobytes(), *shards])


def open_file(data: bytes) -> TokenFile:
    if data[: len(MAGIC)] != MAGIC:
        raise ValueError("not a token file")
    at = len(MAGIC)
    head = np.frombuffer(data, HEAD, 1, at)[0]
    n, at = int(head["documents"]), at + HEAD.itemsize
    numbers = np.frombuffer(data, "<i8", n, at).tolist()
    present = np.frombuffer(data, "u1", n, at + 8 * n)
    ends = np.frombuffer(data, "<u8", n, at + 9 * n).astype(np.int64)
    table = np.frombuffer(data, "<u8", 2 * int(head["shards"]), at + 17 * n).reshape(-1, 2).astype(np.int64)
    documents = [i if p else None for i, p in zip(numbers, present)]
    return TokenFile(int(head["range"]), int(head["first"]), documents, ends, table[:, 1], table[:, 0], data)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array]]:
    """(ids, texts) of up to BATCH characters, or of one longer text."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
        ends, at = np.cumsum(sizes, dtype=np.int64), 0
        while at < batch.num_rows:
            before = int(ends[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + BATCH, "right")))
            yield batch.column("doc_id").slice(at, to - at), batch.column("text").slice(at, to - at)
            at = to


def _writer(shared, base: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, first, size = TaskContext.get().partitionId(), 0, 0
        documents: list[int | None] = []
        lengths: list[np.ndarray] = []
        parts: list[np.ndarray] = []

        def flushed() -> pa.RecordBatch:
            data = make_file(place, first, documents, np.concatenate(lengths), np.concatenate(parts), base)
            return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], names=["file"])

        for numbers, texts in _slices(batches):
            ids, found = encode(texts, shared.value)
            # The end id follows each document.
            parts.append(np.insert(ids, np.cumsum(found), end_id).astype(np.uint32))
            lengths.append(found + 1)
            documents += numbers.to_pylist()
            size += len(parts[-1])
            if size >= FILE_IDS:
                yield flushed()
                first, size = first + size, 0
                documents, lengths, parts = [], [], []
        if documents:
            yield flushed()

    return run


def write(documents: DataFrame, path: str, tokenizer: str, end_id: int) -> None:
    """Writes the ids of ``documents`` (doc_id a whole number, text) in ascending doc_id order under ``path``.

    ``tokenizer`` is a file of the tokenizers library that drops white space, read
    by the driver and broadcast: a vocabulary, so of bounded size. Special tokens
    are not added; ``end_id`` ends each document. NULL texts are empty. Rows of
    NULL doc_id come first, rows of equal doc_id stand in the order of their
    texts' hashes; equal rows are all written. Texts are dealt by ranges of doc_id
    and hash, so a single id of many rows is many tasks' work, too. Executors that
    are lost have their ranges written again: what a file holds does not depend on
    the attempt.
    """
    spark = documents.sparkSession
    with open(tokenizer, encoding="utf-8") as file:
        content = file.read()
    base = max(_tokenizer(content).get_vocab_size(with_added_tokens=True), end_id + 1)
    dealt = documents.select(F.col("doc_id").cast("long").alias("doc_id"), documents["text"].alias("text"))
    order = ["doc_id", "hash", "text"]
    files = (
        dealt.withColumn("hash", F.xxhash64("text"))
        .repartitionByRange("doc_id", "hash")
        .sortWithinPartitions(*order)
        .select("doc_id", "text")
        .mapInArrow(_writer(spark.sparkContext.broadcast(content), base, end_id), "file binary")
    )
    # The text writer puts bytes down as they are; each file is one row, and a line end that no reader asks for.
    files.select(F.col("file").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).text(path)


READ = {"ids_crc32": ("long", pa.int64()), "ids": ("array<int>", pa.list_(pa.int32()))}


def _reader(adds: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                data = content.as_buffer().to_pybytes()
                if data:  # a table without rows leaves an empty file
                    yield from _documents_of(open_file(data), adds)

    return run


def _documents_of(file: TokenFile, adds: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows of the file's documents, shard by shard: at no time more ids than a shard's and a document's."""
    starts = np.concatenate([[0], file.ends[:-1]]).astype(np.int64)
    number, at, left = 0, 0, np.zeros(0, np.uint32)  # left: ids of the document that goes on, before ``at``
    for shard in range(len(file.starts)):
        left = np.concatenate([left, repair.ids_of(file.shard(shard))])
        to = int(np.searchsorted(file.ends, at + len(left), "right"))
        here = slice(number, to)
        bounds = zip((starts[here] - at).tolist(), (file.ends[here] - at).tolist())
        added: dict[str, list] = {a: [] for a in adds}
        for a, b in bounds:
            if "ids_crc32" in adds:
                added["ids_crc32"].append(zlib.crc32(left[a:b].astype("<u4").tobytes()))
            if "ids" in adds:
                added["ids"].append(left[a:b].astype(np.int32))
        if to > number:
            columns = [
                pa.array(file.documents[here], pa.int64()),
                pa.array(np.full(to - number, file.range), pa.int64()),
                pa.array(file.first + starts[here], pa.int64()),
                pa.array(file.ends[here] - starts[here], pa.int64()),
                *[pa.array(added[a], READ[a][1]) for a in adds],
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "range", "first", "n_tokens", *adds])
            done = int(file.ends[to - 1])
            left, at, number = left[done - at :], done, to


def read(spark: SparkSession, path: str, adds: tuple[str, ...] = ("ids",)) -> DataFrame:
    """doc_id, start, n_tokens and ``adds`` (ids, ids_crc32) of every document of the files under ``path``.

    ``start`` is the number of ids of all documents before it: first positions
    count from the range's begin, and what earlier ranges hold is added.
    """
    schema = "doc_id long, range long, first long, n_tokens long" + "".join(f", {a} {READ[a][0]}" for a in adds)
    files = spark.read.format("binaryFile").load(path).select("content")
    rows = staged(files.mapInArrow(_reader(list(adds)), schema), "tokens")
    ranges = rows.groupBy("range").agg(F.sum("n_tokens").alias("__n"))
    before = running_sum_before(ranges, "range", F.col("__n"), "__before").select("range", "__before")
    return rows.join(before, "range").select(
        "doc_id", (F.col("first") + F.col("__before")).alias("start"), "n_tokens", *adds
    )


def round_trip(
    documents: DataFrame, tokenizer: str, end_id: int, adds: tuple[str, ...] = ("ids",), path: str | None = None
) -> DataFrame:
    """What ``read`` gives of the files that ``write`` makes of ``documents``, under ``path`` or in the shared folder."""
    spark = documents.sparkSession
    path = path or scratch_path(spark, "token-files")
    write(documents, path, tokenizer, end_id)
    return read(spark, path, adds)
