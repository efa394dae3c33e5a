"""Tokens of two tokenizers over the same bytes, and how often their ids are linked.

Where a token of each ends at the same byte, both cut the text; the tokens between
two such places are a group, and all of a group's tokens of one tokenizer are
linked to all of the other's. Common ends are found by galloping: each end of
the shorter list is looked for in the longer one, in steps that double until it
is passed, then by halving.

Counts of linked id pairs over the corpus come from chunks, runs of documents
encoded together: a chunk numbers its own pairs, so a pair travels once per
chunk and not once per document, and comes back with its count the same way.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator
from functools import cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiffinlens.plans.joins import few

from .bpe import byte_alphabet
from .flat import places, starts_of
from .staging import staged

# Characters of a chunk's texts; one longer text is a chunk of its own.
CHUNK = 1 << 21
# Units that the byte-level tokenizer takes at once.
JOINED = 64
# Units a task remembers.
KEPT = 300_000
# Groups of more links than this are counted by distinct ids, not link by link.
LARGE = 1 << 16


class Side(NamedTuple):
    """A tokenizer: ``encode`` gives all ids of a list of units and how many each unit has; the bytes of each id; their number."""

    encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]
    table: list[bytes]
    sizes: np.ndarray


def _side(encode, table: list[bytes]) -> Side:
    return Side(encode, table, np.array([len(t) for t in table], np.int64))


@cache
def byte_level(content: str) -> Side:
    """A byte-level file of the tokenizers library; special tokens in a text are plain text."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    from tokenizers import Tokenizer

    run = Tokenizer.from_str(content)
    run.encode_special_tokens = True
    byte_of = {c: b for b, c in enumerate(byte_alphabet())}
    table = [b""] * run.get_vocab_size(with_added_tokens=True)
    for token, place in run.get_vocab(with_added_tokens=True).items():
        table[place] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()

    sizes = np.array([len(t) for t in table], np.int64)

    def encode(units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Units are encoded some at a time, as they might stand in a text: none but the last of them ends in white space.

        The tokens have the units' bytes, so each unit's end is the end of a token.
        """
        ended = [i + 1 for i, u in enumerate(units) if not u[-1:].isprintable() or u[-1:].isspace()]
        cuts = sorted({*range(0, len(units), JOINED), *ended, len(units)})
        joined = ["".join(units[a:b]) for a, b in zip(cuts, cuts[1:])]
        ids = _flat_ids([e.ids for e in run.encode_batch_fast(joined, add_special_tokens=False)])
        ends = np.cumsum(np.fromiter((len(u.encode()) for u in units), np.int64, len(units)))
        return ids, np.diff(np.searchsorted(np.cumsum(sizes[ids]), ends, "right"), prepend=0)

    return _side(encode, table)


def _flat_ids(lists: list[list[int]]) -> np.ndarray:
    return np.array(list(chain.from_iterable(lists)), np.int32)


@cache
def pieces(content: bytes) -> Side:
    """A sentencepiece model that puts a space before the text and has no piece with a space after another character."""
    import sentencepiece

    run = sentencepiece.SentencePieceProcessor(model_proto=content)
    table = []
    for place in range(len(run)):
        piece = run.id_to_piece(place)
        table.append(bytes([int(piece[3:5], 16)]) if run.is_byte(place) else piece.replace("▁", " ").encode())
    if any(b" " in token.lstrip(b" ") for token in table):
        raise ValueError("words cannot be encoded alone: a piece goes on over a space")

    def encode(units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = run.encode([u[1:] for u in units], num_threads=1)
        return _flat_ids(ids), np.fromiter(map(len, ids), np.int64, len(ids))

    return _side(encode, table)


def _units(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(units, units per text): each text behind a space, cut before spaces that follow other than white space.

    Neither tokenizer has a token over such a place, so units can be encoded alone.
    """
    split = pc.split_pattern(texts, " ")
    words = split.flatten()
    number = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
    bounds = starts_of(number)
    known = words.dictionary_encode()
    # White space in its widest sense: to leave a place uncut is never wrong.
    spaced = pc.match_substring_regex(known.dictionary, r"(^|[\s\v\p{Z}\p{C}])$").to_numpy(zero_copy_only=False)
    code = known.indices.to_numpy(zero_copy_only=False)
    begins = np.ones(len(words), bool)
    begins[1:] = ~spaced[code[:-1]]
    # A last space alone stays with what is before it: the space that pieces are given would be all of its unit.
    last = bounds[1:] - 1
    begins[last[pc.equal(words, "").to_numpy(zero_copy_only=False)[last]]] = False
    begins[bounds[:-1]] = True
    first = np.flatnonzero(begins)
    size = np.diff(np.append(first, len(words)))
    units = pc.binary_join_element_wise(pa.scalar(""), words.take(pa.array(first)), pa.scalar(" "))
    longer = np.flatnonzero(size > 1)
    if len(longer):
        joined = [" " + " ".join(words.slice(first[i], size[i]).to_pylist()) for i in longer.tolist()]
        mask = np.zeros(len(first), bool)
        mask[longer] = True
        units = pc.replace_with_mask(units, pa.array(mask), pa.array(joined, pa.string()))
    return units, np.diff(starts_of(begins)[bounds])


class Tokens(NamedTuple):
    """Ids of many texts end to end, tokens per text, and the byte at which each ends, counted on from text to text."""

    ids: np.ndarray
    number: np.ndarray
    ends: np.ndarray


def _fitting(units: list[str], found: tuple[np.ndarray, np.ndarray], side: Side) -> np.ndarray:
    """Which units' tokens have the unit's bytes."""
    told = [side.table[i] for i in found[0].tolist()]
    if b"".join(told) == "".join(units).encode():
        return np.ones(len(units), bool)
    ends = starts_of(found[1]).tolist()
    return np.array([b"".join(told[a:b]) == u.encode() for u, a, b in zip(units, ends, ends[1:])], bool)


class Known:
    """Units that a task has met, with both tokenizers' ids, and whether these have the unit's bytes; KEPT of them at most."""

    def __init__(self, sides: tuple[Side, Side]) -> None:
        self.sides = sides
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.fits = np.zeros(0, bool)
        self.ids = [np.zeros(0, np.int32)] * 2
        self.lengths = [np.zeros(0, np.int64)] * 2

    def numbers(self, units: list[str]) -> np.ndarray:
        """The units' places, those not met before encoded now."""
        new = [u for u in units if u not in self.number]
        if len(self.number) + len(new) > KEPT and self.number:
            self._forget()
            new = units
        fits = np.ones(len(new), bool)
        for i, side in enumerate(self.sides):
            ids, lengths = side.encode(new)
            fits &= _fitting(new, (ids, lengths), side)
            self.ids[i] = np.concatenate([self.ids[i], ids])
            self.lengths[i] = np.concatenate([self.lengths[i], lengths])
        self.fits = np.concatenate([self.fits, fits])
        self.number.update(zip(new, range(len(self.number), len(self.number) + len(new))))
        return np.fromiter(map(self.number.__getitem__, units), np.int64, len(units))


def tokens(texts: pa.Array, known: Known) -> tuple[Tokens, Tokens]:
    """Both tokenizers' tokens of each text; none where the text is empty or a side's bytes differ from it."""
    units, number = _units(texts)
    coded = units.dictionary_encode()
    code = known.numbers(coded.dictionary.to_pylist())[coded.indices.to_numpy(zero_copy_only=False)]
    text = np.repeat(np.arange(len(number)), number)
    whole = np.bincount(text, ~known.fits[code], len(number)) == 0
    whole &= pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False) > 0
    kept = whole[text]
    text, code = text[kept], code[kept]
    out = []
    for flat, lengths, side in zip(known.ids, known.lengths, known.sides):
        ids = flat[places(starts_of(lengths)[:-1][code], lengths[code])]
        per_text = np.bincount(text, lengths[code], len(number)).astype(np.int64)
        out.append(Tokens(ids, per_text, np.cumsum(side.sizes[ids])))
    return out[0], out[1]


def gallop(wanted: np.ndarray, sorted_: np.ndarray, low: np.ndarray, high: np.ndarray, guess: np.ndarray) -> np.ndarray:
    """For each wanted value the first place from ``low`` up to ``high`` whose value is not smaller.

    From the guess on, steps double away from it until the value is passed; the
    last step is then halved. All searches go on side by side.
    """
    low, high = low.copy(), high.copy()
    if not len(wanted):
        return low
    at = np.clip(guess, low, high - 1)
    up = sorted_[at] < wanted
    low = np.where(up, at + 1, low)
    high = np.where(up, high, at)
    going, step = np.arange(len(wanted)), 1
    while len(going):
        probe = np.where(up[going], at[going] + step, at[going] - step)
        inside = (probe >= low[going]) & (probe < high[going])
        going, probe = going[inside], probe[inside]
        less = sorted_[probe] < wanted[going]
        low[going[less]] = probe[less] + 1
        high[going[~less]] = probe[~less]
        going = going[less == up[going]]
        step *= 2
    going = np.flatnonzero(low < high)
    while len(going):
        middle = (low[going] + high[going]) >> 1
        less = sorted_[middle] < wanted[going]
        low[going[less]] = middle[less] + 1
        high[going[~less]] = middle[~less]
        going = going[low[going] < high[going]]
    return low


def common_ends(a: Tokens, b: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Places in a and in b of the ends both have, text by text; the shorter list of a text is looked up in the longer."""
    starts = starts_of(a.number), starts_of(b.number)
    out = []
    for few_, many, shorter in ((0, 1, a.number <= b.number), (1, 0, a.number > b.number)):
        side, other = (a, b)[few_], (a, b)[many]
        chosen = np.flatnonzero(shorter & (side.number > 0) & (other.number > 0))
        place = places(starts[few_][chosen], side.number[chosen])
        text = np.repeat(chosen, side.number[chosen])
        low, high = starts[many][text], starts[many][text + 1]
        rank = place - starts[few_][text]
        guess = low + rank * other.number[text] // side.number[text]
        at = gallop(side.ends[place], other.ends, low, high, guess)
        same = (at < high) & (other.ends[np.minimum(at, len(other.ends) - 1)] == side.ends[place])
        pair = place[same], at[same]
        out.append(pair if few_ == 0 else pair[::-1])
    in_a, in_b = (np.concatenate(x) for x in zip(*out))
    order = np.argsort(in_a, kind="stable")
    return in_a[order], in_b[order]


class Groups(NamedTuple):
    """Of each group: its text, where its tokens begin in a and in b, and how many they are."""

    text: np.ndarray
    a: np.ndarray
    a_size: np.ndarray
    b: np.ndarray
    b_size: np.ndarray


def groups(a: Tokens, b: Tokens) -> Groups:
    """The texts' groups: differences of the ranks of common ends are their ranges."""
    in_a, in_b = common_ends(a, b)
    text = np.searchsorted(starts_of(a.number), in_a, "right") - 1
    a_size, b_size = np.diff(in_a, prepend=-1), np.diff(in_b, prepend=-1)
    return Groups(text, in_a + 1 - a_size, a_size, in_b + 1 - b_size, b_size)


def links(a: Tokens, b: Tokens, found: Groups) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, pair, times) of all links; a pair is a's id in the upper and b's in the lower half. Pairs may come again."""
    number = found.a_size * found.b_size
    small = np.flatnonzero(number <= LARGE)
    size, wide = number[small], found.b_size[small]
    inside = np.arange(int(size.sum())) - np.repeat(starts_of(size)[:-1], size)
    wide_ = np.repeat(wide, size)
    left = a.ids[np.repeat(found.a[small], size) + inside // wide_]
    right = b.ids[np.repeat(found.b[small], size) + inside % wide_]
    text, pair, times = [np.repeat(found.text[small], size)], [(left.astype(np.int64) << 32) | right], [np.ones(len(left), np.int64)]
    for g in np.flatnonzero(number > LARGE).tolist():
        ones, n = np.unique(a.ids[found.a[g] : found.a[g] + found.a_size[g]], return_counts=True)
        others, m = np.unique(b.ids[found.b[g] : found.b[g] + found.b_size[g]], return_counts=True)
        pair.append(((ones.astype(np.int64)[:, None] << 32) | others).ravel())
        times.append((n[:, None] * m).ravel())
        text.append(np.full(len(pair[-1]), found.text[g]))
    return np.concatenate(text), np.concatenate(pair), np.concatenate(times)


def written(a: Tokens, b: Tokens, found: Groups, texts: int) -> list[bytes]:
    """Each text's groups, ``a1,a2|b1;a3|b2,b3``."""
    n = len(found.text)
    sizes = np.empty(2 * n, np.int64)
    sizes[0::2], sizes[1::2] = found.a_size, found.b_size
    begins = np.empty(2 * n, np.int64)
    begins[0::2], begins[1::2] = found.a, found.b + len(a.ids)
    ids = np.concatenate([a.ids, b.ids])[places(begins, sizes)]
    # What follows a token: a comma, a bar behind the last of a, a semicolon behind the last of b.
    after = np.zeros(len(ids), np.int32)
    last = np.cumsum(sizes) - 1
    after[last[0::2]], after[last[1::2]] = 1, 2
    code = ids * 3 + after
    known = np.flatnonzero(np.bincount(code))
    shown = np.zeros(int(known.max(initial=-1)) + 1, object)
    shown[known] = [b"%d%s" % (k // 3, (b",", b"|", b";")[k % 3]) for k in known.tolist()]
    parts = shown[code].tolist()
    per_text = np.bincount(found.text, found.a_size + found.b_size, texts).astype(np.int64)
    bounds = starts_of(per_text).tolist()
    return [b"".join(parts[x:y])[:-1] for x, y in zip(bounds, bounds[1:])]


def _packed(numbers: np.ndarray) -> bytes:
    """Whole numbers of 32 bits, compressed with like bytes side by side."""
    planes = numbers.astype("<u4").view("u1").reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    plain = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), "u1")
    planes = plain.reshape(4, len(plain) // 4)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


_CHUNKS = pa.schema(
    [(n, pa.int64()) for n in ("chunk", "place", "doc_id", "n_a", "n_b", "n_groups", "n_links")]
    + [("groups_sha256", pa.string()), ("pairs", pa.binary()), ("times", pa.binary())]
    + [(n, pa.int64()) for n in ("a", "b", "docs")]
)
_CHUNKS_SQL = (
    "chunk long, place long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "pairs binary, times binary, a long, b long, docs long"
)
ROWS = 1 << 14


def _table(rows: int, **columns) -> pa.RecordBatch:
    arrays = []
    for field in _CHUNKS:
        given = columns.get(field.name)
        arrays.append(pa.nulls(rows, field.type) if given is None else pa.array(given, field.type))
    return pa.RecordBatch.from_arrays(arrays, schema=_CHUNKS)


def aligned_chunk(chunk: int, numbers: pa.Array, texts: pa.Array, known: Known) -> Iterator[pa.RecordBatch]:
    """A chunk's rows: one per document, and one per pair that it links, placed from 0."""
    n = len(texts)
    a, b = tokens(texts, known)
    found = groups(a, b)
    text, pair, times = links(a, b, found)
    coded = pa.array(pair).dictionary_encode()
    distinct = coded.dictionary.to_numpy()
    # Each document's pairs, once each.
    key = text * max(1, len(distinct)) + coded.indices.to_numpy(zero_copy_only=False)
    order = np.argsort(key)
    key, times = key[order], times[order]
    first = np.flatnonzero(np.diff(key, prepend=-1))
    times = np.add.reduceat(times, first) if len(first) else times
    key = key[first]
    text, place = key // max(1, len(distinct)), key % max(1, len(distinct))
    bounds = np.searchsorted(text, np.arange(n + 1))
    told = written(a, b, found, n)
    cut = list(zip(bounds.tolist(), bounds[1:].tolist()))
    yield _table(
        n,
        chunk=np.full(n, chunk),
        place=np.full(n, -1),
        doc_id=numbers,
        n_a=a.number,
        n_b=b.number,
        n_groups=np.bincount(found.text, minlength=n),
        n_links=np.bincount(text, times, n).astype(np.int64),
        groups_sha256=[hashlib.sha256(t).hexdigest() if t else "" for t in told],
        # The first place, then the distance to each next one.
        pairs=[_packed(np.diff(place[x:y], prepend=0)) for x, y in cut],
        times=[_packed(times[x:y]) for x, y in cut],
    )
    docs = np.bincount(place, minlength=len(distinct))
    for at in range(0, len(distinct), ROWS):
        some = distinct[at : at + ROWS]
        here = np.arange(at, at + len(some))
        yield _table(
            len(some), chunk=np.full(len(some), chunk), place=here, a=some >> 32, b=some & 0xFFFFFFFF, docs=docs[here]
        )


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array]]:
    """(ids, texts) of about CHUNK characters, gathered over batches."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        bytes_ = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
        ends, at = np.cumsum(bytes_, dtype=np.int64), 0
        while at < batch.num_rows:
            before = int(ends[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + CHUNK - size, "right")))
            held.append(batch.slice(at, to - at))
            size += int(ends[to - 1]) - before
            at = to
            if size >= CHUNK or at < batch.num_rows:
                whole = pa.Table.from_batches(held).combine_chunks()
                yield whole["doc_id"].combine_chunks(), whole["text"].combine_chunks()
                held, size = [], 0
    if held:
        whole = pa.Table.from_batches(held).combine_chunks()
        yield whole["doc_id"].combine_chunks(), whole["text"].combine_chunks()


def _flat(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _aligner(bytes_shared, pieces_shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Known((byte_level(bytes_shared.value), pieces(pieces_shared.value)))
        for number, (numbers, texts) in enumerate(_chunks(batches)):
            chunk = (TaskContext.get().partitionId() << 32) + number
            yield from aligned_chunk(chunk, _flat(numbers), _flat(texts).fill_null(""), known)

    return run


_RESULT = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a chunk come pairs first, by place, then its documents."""
    chunk, counts, best = None, [], []
    for batch in batches:
        chunks = batch.column("chunk").to_numpy()
        is_pair = pc.is_null(batch.column("doc_row")).to_numpy(zero_copy_only=False)
        marks = np.flatnonzero(np.diff(chunks) | np.diff(is_pair.astype(np.int8))) + 1
        for at, to in zip([0, *marks.tolist()], [*marks.tolist(), batch.num_rows]):
            if at == to:
                continue
            if chunks[at] != chunk:
                chunk, counts, best = chunks[at], [], []
            part = batch.slice(at, to - at)
            if is_pair[at]:
                counts.append(part.column("n").to_numpy())
                best.append(part.column("is_best").to_numpy(zero_copy_only=False))
                continue
            if len(counts) > 1:
                counts, best = [np.concatenate(counts)], [np.concatenate(best)]
            sums, tops = [], []
            for pairs, times in zip(part.column("pairs"), part.column("times")):
                place, often = np.cumsum(_unpacked(pairs.as_py())), _unpacked(times.as_py())
                sums.append(int(often @ counts[0][place]) if len(place) else 0)
                tops.append(int(often[best[0][place]].sum()) if len(place) else 0)
            told = {c: part.column(c) for c in _RESULT if c in part.schema.names}
            told |= {"count_sum": pa.array(sums, pa.int64()), "n_best": pa.array(tops, pa.int64())}
            yield pa.RecordBatch.from_arrays([told[c] for c in _RESULT], names=_RESULT)


def alignment(documents: DataFrame, byte_file: str, piece_file: str) -> DataFrame:
    """Groups and links of every row of ``documents`` (doc_id, text) between two tokenizers.

    doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.
    ``byte_file`` (a, which sees a space before the text) and ``piece_file`` (b,
    which adds it) are vocabularies, so of bounded size: read by the driver and
    broadcast. A pair's count is the number of rows that hold it linked, equal rows
    counted each; a link is best if its count is the highest of its a id. NULL and
    empty texts, and those that a tokenizer does not give back byte by byte, have
    no tokens: zeros and an empty string.
    """
    context = documents.sparkSession.sparkContext
    with open(byte_file, encoding="utf-8") as file:
        bytes_content = file.read()
    with open(piece_file, "rb") as file:
        pieces_content = file.read()
    run = _aligner(context.broadcast(bytes_content), context.broadcast(pieces_content))
    chosen = documents.select(documents["doc_id"].cast("long").alias("doc_id"), documents["text"].alias("text"))
    rows = staged(chosen.mapInArrow(run, _CHUNKS_SQL), "aligned")
    pairs = rows.where("place >= 0").select("chunk", "place", "a", "b", "docs")
    counts = staged(pairs.groupBy("a", "b").agg(F.sum("docs").alias("n")), "pairs")
    # One row per id of a at most, of which the vocabulary bounds the number.
    top = few(counts.groupBy("a").agg(F.max("n").alias("top")), len(byte_level(bytes_content).table))
    known = counts.join(top, "a").select("a", "b", "n", (F.col("n") == F.col("top")).alias("is_best"))
    told = pairs.join(known, ["a", "b"]).select("chunk", "place", "n", "is_best")
    plain = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]
    after = F.lit((1 << 63) - 1).alias("place")
    heads = rows.where("place < 0").select("chunk", after, F.lit(True).alias("doc_row"), *plain)
    together = heads.unionByName(told, allowMissingColumns=True)
    schema = ", ".join(f"{c} string" if c == "groups_sha256" else f"{c} long" for c in _RESULT)
    return together.repartition("chunk").sortWithinPartitions("chunk", "place").mapInArrow(_scored, schema)
