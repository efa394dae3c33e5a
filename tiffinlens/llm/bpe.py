"""Byte-level BPE with the tokenizers library over Arrow batches.

Bytes stand for characters of an alphabet in which each byte has one; the rank
file gives the vocabulary, and the merges follow from the ranks. Decoding turns
the ids' characters back into bytes, so a character split over tokens is whole
again once its bytes are together.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Characters encoded at once: what bounds memory for long texts. Texts are cut only where tokens never join.
PIECE = 1 << 16
# Characters of the texts returned in one batch.
BATCH = 1 << 21


def byte_alphabet() -> list[str]:
    """The character of each byte: itself where it prints, else the next from U+0100 on."""
    printing = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, spare = [], 256
    for byte in range(256):
        out.append(chr(byte if byte in printing else spare))
        spare += byte not in printing
    return out


def read_ranks(content: bytes) -> dict[bytes, int]:
    """Lines of base64 and rank."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in content.splitlines() if line)}


def merges_of(ranks: dict[bytes, int]) -> list[tuple[bytes, bytes]]:
    """Every pair of tokens that makes a token, by the rank of what it makes."""
    out = []
    for token in sorted(ranks, key=ranks.__getitem__):
        for cut in range(1, len(token)):
            left, right = token[:cut], token[cut:]
            if left in ranks and right in ranks:
                out.append((left, right))
    return out


@cache
def tokenizer(content: bytes, pattern: str):
    """A tokenizer of the library for a rank file; matches of ``pattern`` are encoded separately."""
    from tokenizers import Regex, Tokenizer
    from tokenizers.models import BPE
    from tokenizers.pre_tokenizers import ByteLevel, Sequence, Split

    ranks, alphabet = read_ranks(content), byte_alphabet()

    def shown(token: bytes) -> str:
        return "".join(alphabet[b] for b in token)

    model = BPE(
        vocab={shown(token): rank for token, rank in ranks.items()},
        merges=[(shown(a), shown(b)) for a, b in merges_of(ranks)],
        ignore_merges=True,
    )
    out = Tokenizer(model)
    out.pre_tokenizer = Sequence(
        [Split(Regex(pattern), "isolated"), ByteLevel(add_prefix_space=False, use_regex=False)]
    )
    return out


@cache
def byte_table(content: bytes) -> dict[int, bytes]:
    return {rank: token for token, rank in read_ranks(content).items()}


def pieces(text: str, size: int = PIECE) -> Iterator[tuple[int, str]]:
    """(start, piece): cut before a space or line end that follows other than white space.

    A match of the pattern never goes on there: only its first character can be
    a space, and a run of white space begins a match.
    """
    start = 0
    while len(text) - start > size:
        at = start + size
        while True:
            found = [p for p in (text.find(" ", at), text.find("\n", at)) if p >= 0]
            if not found:
                at = len(text)
                break
            at = min(found)
            if not text[at - 1].isspace():
                break
            at += 1
        yield start, text[start:at]
        start = at
    if start < len(text):
        yield start, text[start:]


def encode(text: str, content: bytes, pattern: str) -> list[int]:
    run = tokenizer(content, pattern)
    out: list[int] = []
    for _, piece in pieces(text):
        out += run.encode_batch_fast([piece], add_special_tokens=False)[0].ids
    return out


def encode_with_offsets(text: str, content: bytes, pattern: str) -> list[tuple[int, int, int]]:
    """(id, start, end) in characters of the text; tokens within one character share its span."""
    run = tokenizer(content, pattern)
    out = []
    for start, piece in pieces(text):
        found = run.encode(piece, add_special_tokens=False)
        out += [(i, start + a, start + b) for i, (a, b) in zip(found.ids, found.offsets)]
    return out


def decode_bytes(ids: list[int], content: bytes) -> bytes:
    return b"".join(map(byte_table(content).__getitem__, ids))


def decode(ids: list[int], content: bytes) -> str:
    """The ids' text; characters split over tokens are put together, bytes that are none become U+FFFD."""
    reader = codecs.getincrementaldecoder("utf-8")("replace")
    table = byte_table(content)
    return "".join(reader.decode(table[i]) for i in ids) + reader.decode(b"", True)


ENCODED = {
    "ids": pa.list_(pa.int32()),
    "offsets": pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])),
    "ids_sha256": pa.string(),
    "decoded_sha256": pa.string(),
}
SPARK_TYPES = {
    "ids": T.ArrayType(T.IntegerType()),
    "offsets": T.ArrayType(T.StructType().add("start", "integer").add("end", "integer")),
    "ids_sha256": T.StringType(),
    "decoded_sha256": T.StringType(),
}


def _encoder(shared, pattern: str, columns: list[str], adds: list[str]):
    def one(text: str, content: bytes) -> list:
        row: dict = {}
        if "offsets" in adds:
            spans = encode_with_offsets(text, content, pattern)
            ids = [s[0] for s in spans]
            row["offsets"] = [{"start": a, "end": b} for _, a, b in spans]
        else:
            ids = encode(text, content, pattern)
        if "ids" in adds:
            row["ids"] = np.array(ids, np.int32)
        if "ids_sha256" in adds:
            row["ids_sha256"] = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        if "decoded_sha256" in adds:
            row["decoded_sha256"] = hashlib.sha256(decode_bytes(ids, content)).hexdigest()
        return [len(ids), *[row[a] for a in adds]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        content = shared.value
        for batch in batches:
            at, texts = 0, batch.column(batch.num_columns - 1)
            while at < batch.num_rows:
                rows, size, to = [], 0, at
                while to < batch.num_rows and size < BATCH:
                    text = texts[to].as_py() or ""
                    rows.append(one(text, content))
                    size += len(text)
                    to += 1
                kept = [batch.column(i).slice(at, to - at) for i in range(len(columns))]
                added = [pa.array([r[0] for r in rows], pa.int64())]
                added += [pa.array([r[i + 1] for r in rows], ENCODED[a]) for i, a in enumerate(adds)]
                yield pa.RecordBatch.from_arrays(kept + added, names=[*columns, "n_tokens", *adds])
                at = to

    return run


def encoded(
    documents: DataFrame,
    path: str,
    pattern: str,
    columns: list[str] | None = None,
    adds: tuple[str, ...] = ("ids",),
    text: str = "text",
) -> DataFrame:
    """``columns`` of every row, n_tokens, and of ids, offsets, ids_sha256, decoded_sha256 what ``adds`` names.

    ``path`` is a rank file (a vocabulary: of bounded size), read by the driver
    and broadcast, so executors need no copy. NULL is the empty text: no ids.
    Repeated rows give repeated rows. Rows stay in their partitions.
    """
    names = list(columns if columns is not None else [c for c in documents.columns if c != text])
    with open(path, "rb") as file:
        shared = documents.sparkSession.sparkContext.broadcast(file.read())
    schema = T.StructType([documents.schema[c] for c in names]).add("n_tokens", "long")
    for a in adds:
        schema = schema.add(a, SPARK_TYPES[a])
    chosen = documents.select(*names, documents[text].alias("__text"))
    return chosen.mapInArrow(_encoder(shared, pattern, names, list(adds)), schema)
