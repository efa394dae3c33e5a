"""Alignment of two tokenizers against whole texts encoded by the libraries, group by group and link by link."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tiffinlens.llm import alignment, bpe, queries

SF = "/root/testdata/sf0.001"
BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def sides():
    with open(BYTES, encoding="utf-8") as one, open(PIECES, "rb") as two:
        return alignment.byte_level(one.read()), alignment.pieces(two.read())


@pytest.fixture(scope="module", params=[300_000, 7])
def known(sides, request):
    """What a task remembers, over all texts tried; with little room it forgets now and then."""
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(alignment, "KEPT", request.param)
        yield alignment.Known(sides)


@pytest.fixture(scope="module")
def libraries():
    one = Tokenizer.from_file(BYTES)
    one.encode_special_tokens = True
    return one, sentencepiece.SentencePieceProcessor(model_file=PIECES)


def coded(text, libraries):
    """[(id, bytes)] of both, or two empty lists."""
    one, two = libraries
    if not text:
        return [], []
    byte_of = {c: b for b, c in enumerate(bpe.byte_alphabet())}
    found = one.encode(" " + text, add_special_tokens=False)
    a = [(i, bytes(byte_of[c] for c in t)) for i, t in zip(found.ids, found.tokens)]
    b = []
    for i in two.encode(text):
        piece = two.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if two.is_byte(i) else piece.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    return (a, b) if b"".join(t for _, t in a) == whole == b"".join(t for _, t in b) else ([], [])


def grouped(a, b):
    """[(ids of a, ids of b)] by walking along the bytes."""
    out, left, right, ends_a, ends_b = [], [], [], 0, 0
    b = list(b)
    for i, token in a:
        left.append(i)
        ends_a += len(token)
        while b and ends_b + len(b[0][1]) <= ends_a:
            place, other = b.pop(0)
            right.append(place)
            ends_b += len(other)
        if ends_a == ends_b and right:
            out.append((left, right))
            left, right = [], []
    return out


def brute(rows, libraries):
    per_row = [grouped(*coded(t, libraries)) for _, t in rows]
    linked = [Counter((x, y) for left, right in g for x in left for y in right) for g in per_row]
    count = Counter(pair for c in linked for pair in c)
    top = {}
    for (x, _), n in count.items():
        top[x] = max(n, top.get(x, 0))
    out = []
    for (i, t), g, c in zip(rows, per_row, linked):
        told = ";".join(",".join(map(str, left)) + "|" + ",".join(map(str, right)) for left, right in g)
        out.append((
            i, sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), sum(c.values()),
            sum(n for (x, y), n in c.items() if count[x, y] == top[x]), sum(n * count[p] for p, n in c.items()),
            hashlib.sha256(told.encode()).hexdigest() if g else "",
        ))
    return out


ODD = [
    "", None, " ", "  ", "a", " lead", "trail ", "two  spaces   three", "line\nline\n\n  line \t tab\t end \n",
    "it's we'll <|endoftext|> <s></s> <unk> <0x41>", "▁ under ▁", "漢字 かな カナ 한국어 العربية עברית ไทย", "🙂🙂‍↔️ é é",
    "123456 78,90 3.14 --- === !!! ...", "x" * 3000, "no break wide　ideographic\u0085next", "a\x00b \x1c c",
    "word " * 2000, "ﬁ ﬀ Ⅷ ½ İ ß", "﻿mark", "a  b​ c", "=" * 500 + " " * 300 + "=" * 7,
]


def test_units_encoded_alone_are_whole_texts_encoded(sides, libraries):
    texts = [t or "" for t in ODD]
    found = alignment.tokens(pa.array(texts), alignment.Known(sides))
    for side, tokens in enumerate(found):
        want = [coded(t, libraries)[side] for t in texts]
        assert tokens.number.tolist() == [len(w) for w in want]
        assert tokens.ids.tolist() == [i for w in want for i, _ in w]
    assert found[0].number[texts.index("▁ under ▁")] == 0


@given(st.lists(st.text(" a\nb\t1'.é漢 ", max_size=40), max_size=6))
@settings(max_examples=60, deadline=None)
def test_any_texts(known, libraries, texts):
    a, b = alignment.tokens(pa.array(texts, pa.string()), known)
    found = alignment.groups(a, b)
    want = [grouped(*coded(t, libraries)) for t in texts]
    assert np.bincount(found.text, minlength=len(texts)).tolist() == [len(w) for w in want]
    told = [";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in w).encode() for w in want]
    assert alignment.written(a, b, found, len(texts)) == told


@given(st.lists(st.integers(0, 60), max_size=40), st.lists(st.integers(0, 60), max_size=12), st.randoms())
@settings(max_examples=200, deadline=None)
def test_galloping_finds_places(numbers, wanted, rng):
    line, wanted = np.array(sorted(set(numbers)), np.int64), np.array(wanted, np.int64)
    if not len(line):
        return
    guess = np.array([rng.randrange(len(line)) for _ in wanted], np.int64)
    zero, end = np.zeros(len(wanted), np.int64), np.full(len(wanted), len(line))
    assert alignment.gallop(wanted, line, zero, end, guess).tolist() == np.searchsorted(line, wanted).tolist()


def test_large_groups_are_counted_by_ids(monkeypatch):
    a = alignment.Tokens(np.array([1, 1, 2, 5]), np.array([3, 1]), np.array([1, 2, 9, 12]))
    b = alignment.Tokens(np.array([7, 8, 7, 6]), np.array([3, 1]), np.array([3, 4, 9, 12]))
    found = alignment.groups(a, b)
    assert found.a_size.tolist() == [3, 1] and found.b_size.tolist() == [3, 1]

    def counted():
        out = Counter()
        for t, p, n in zip(*alignment.links(a, b, found)):
            out[int(t), int(p >> 32), int(p & 0xFFFFFFFF)] += int(n)
        return out

    plain = counted()
    assert plain == {(0, 1, 7): 4, (0, 1, 8): 2, (0, 2, 7): 2, (0, 2, 8): 1, (1, 5, 6): 1}
    monkeypatch.setattr(alignment, "LARGE", 0)
    assert counted() == plain


def test_query_equals_brute_force(spark, libraries):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = queries.op13_token_alignment(spark, SF)
    assert got.columns == alignment._RESULT
    assert sorted(map(tuple, got.collect())) == sorted(brute(rows, libraries))


def test_odd_rows_over_chunks(spark, libraries):
    rows = [(i if i % 5 else None, t) for i, t in enumerate(ODD)] + [(1, "twice"), (1, "twice"), (None, "twice")]
    frame = spark.createDataFrame([(*r, "mine", "mine") for r in rows], "doc_id long, text string, chunk string, n string")
    for parts in (1, 7):
        got = alignment.alignment(frame.repartition(parts), BYTES, PIECES)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(brute(rows, libraries), key=str)
    assert alignment.alignment(frame.limit(0), BYTES, PIECES).count() == 0
