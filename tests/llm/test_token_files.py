"""Re-Pair grammars, and token files against the tokenizers library."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tiffinlens.llm import queries, repair, tokenfiles

SF = "/root/testdata/sf0.001"
WORDS = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, hash string, range string"


@given(st.lists(st.integers(0, 5), max_size=300), st.integers(2, 9))
@settings(max_examples=150, deadline=None)
def test_grammar_gives_back_every_range(ids, least):
    ids = np.array(ids, np.int64)
    shard = repair.unpack(repair.pack(repair.compress(ids, 6, least)))
    assert repair.ids_of(shard).tolist() == ids.tolist()
    assert shard.widths().sum() == len(ids)
    for start in range(0, len(ids), 17):
        for end in (start, start + 1, len(ids)):
            assert repair.ids_between(shard, start, end).tolist() == ids[start:end].tolist()


def test_rules_replace_frequent_pairs():
    ids = np.array([1, 2, 3, 9] * 500 + list(range(10, 60)))
    shard = repair.compress(ids, 100)
    assert len(shard.symbols) < 100 and shard.lengths.max() >= 64
    assert len(repair.compress(np.zeros(1 << 16, np.int64), 1).symbols) < 32
    assert len(repair.compress(np.arange(5000), 5000).left) == 0


def test_wide_symbols():
    ids = np.array([70_000, 70_001] * 40)
    shard = repair.unpack(repair.pack(repair.compress(ids, 70_002)))
    assert repair.ids_of(shard).tolist() == ids.tolist()


TEXTS = [
    "", None, " \t\n ", "It's the <|endoftext|>end<|startoftext|> of ＡＢＣ é é ΟΔΟΣ Σ x y\x85z",
    "<|ENDOFTEXT|> A.b.C,, I'M 'S !a;b:c? ABC<|endoftext|>.X İİ",
    "don't  stop 12345 \x1cа\x1f 漢字かな 🙂🙂 ﬁ ŉ İ", "word " * 3000, "über STRASSE straße Öl ñandú приветствие Москва λόγος ÿ ÷ × ŝ", "x" * 5000, "á ́b", "﻿a\x00b",
]


def brute(rows):
    """Rows in file order to (doc_id, start, n_tokens, crc)."""
    run, at, out = Tokenizer.from_file(WORDS), 0, []
    for i, t in rows:
        ids = run.encode(t or "", add_special_tokens=False).ids + [2]
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_words_encoded_alone_are_whole_texts_encoded():
    run = Tokenizer.from_file(WORDS)
    with open(WORDS, encoding="utf-8") as file:
        ids, lengths = tokenfiles.encode(pa.array(TEXTS, pa.string()), file.read())
    want = [run.encode(t or "", add_special_tokens=False).ids for t in TEXTS]
    assert lengths.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


@pytest.mark.parametrize("most", [1 << 19, 25, 3])
def test_words_of_batches_before_are_not_encoded_again(monkeypatch, most):
    """Whatever is kept, the ids are the library's; a word that is kept is encoded once."""
    run, asked = Tokenizer.from_file(WORDS), []
    with open(WORDS, encoding="utf-8") as file:
        content = file.read()
    encode_new = tokenfiles._encode_new
    monkeypatch.setattr(tokenfiles, "_encode_new", lambda words, c: asked.extend(words.to_pylist()) or encode_new(words, c))
    monkeypatch.setattr(tokenfiles, "KNOWN_WORDS", most)
    tokenfiles._known.cache_clear()
    batches = [TEXTS[:4], TEXTS[4:], ["", None], ["the end of it all", "stop the 漢字かな"], TEXTS, [f"word{i} the {i}" for i in range(30)]] * 2
    for texts in batches:
        for kind in (pa.string(), pa.large_string()):
            ids, lengths = tokenfiles.encode(pa.array(texts, kind), content)
            want = [run.encode(t or "", add_special_tokens=False).ids for t in texts]
            assert lengths.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
            assert len(tokenfiles._known(content)[0].words) <= most
    if most > 1000:
        assert len(asked) == len(set(asked))
    tokenfiles._known.cache_clear()


def library(texts):
    run = Tokenizer.from_file(WORDS)
    return [run.encode(t or "", add_special_tokens=False).ids for t in texts]


def encoded(texts):
    with open(WORDS, encoding="utf-8") as file:
        ids, lengths = tokenfiles.encode(pa.array(texts, pa.string()), file.read())
    return [part.tolist() for part in np.split(ids, np.cumsum(lengths)[:-1])]


def test_letters_and_marks_go_to_the_merges_at_once(monkeypatch):
    """Words of known letters, marks and digits cost no run of the whole tokenizer."""
    texts = ["Éourément ééè. Ñosqueco, les&&& L'É", "(949) 555-3739 88.112.68.201 <b>ÄÖ</b> </w> a</w> ПРИВЕТ! ΛΌΓΟΣ ς Σ", "x=1;y+=2 #$%&*~^_`@"]
    whole, asked = tokenfiles._tokenizer, []

    class Asked:
        def __init__(self, content):
            self.run = whole(content)
            self.model = self.run.model

        def encode_batch_fast(self, words, **options):
            asked.extend(words)
            return self.run.encode_batch_fast(words, **options)

    monkeypatch.setattr(tokenfiles, "_tokenizer", Asked)
    tokenfiles._known.cache_clear()
    assert encoded(texts) == library(texts)
    assert sorted(asked) == sorted(["l'É", "ΛΌΓΟΣ"])
    tokenfiles._known.cache_clear()


def test_marks_on_capitals_are_not_put_on_small_letters():
    """The library composes before it folds: there is no capital for some small letters with a mark."""
    marks = ["\u0308", "\u030a", "\u030c", "\u0331", "\u0316\u0308", "\u0301", "\u0307"]
    texts = [before + letter + mark + "x" for letter in "ABHIJTWYhjtwy" for mark in marks for before in ("", "é", "a.", "<|")]
    assert encoded(texts) == library(texts)


def test_every_neighbour_of_a_letter_or_mark():
    some = [chr(i) for i in range(33, 0x3CA)] + ["<|endoftext|>", "'s", "'LL", "\u0338", "ſ", "K", "中", "<|", "|>"]
    texts = [a + b + "r" for a in ["a", "É", "9", "'", "|", "&", "<", "<|endoftext|>", "Я"] for b in some]
    assert encoded(texts) == library(texts)


def plain_rounds(ids, base, least):
    """The grammar as the module says, one pair after the other: (left, right, symbols)."""
    symbols, rules, bar = list(ids), [], None
    while len(symbols) > 1:
        pairs = list(zip(symbols, symbols[1:]))
        counts = Counter(pairs)
        if max(counts.values()) < least:
            break
        bar = max(least, min(max(counts.values()), bar or 1 << 60) // repair.STEP)
        ranked = sorted((p for p in counts if counts[p] >= bar), key=counts.get)
        weight = {p: i + 1 for i, p in enumerate(ranked)}
        heavy = [weight.get(p, 0) for p in pairs] + [0]
        run, open_ = 0, []
        for i, w in enumerate(heavy):
            run = run + 1 if i and w == heavy[i - 1] else 0
            open_.append(w if run % 2 == 0 else 0)
        at = [i for i, w in enumerate(open_[:-1]) if w and open_[i + 1] <= w and (not i or open_[i - 1] <= w)]
        used = Counter(pairs[i] for i in at)
        found = [p for p in dict.fromkeys(pairs) if used[p] >= max(2, least // 2)]
        if not found:
            if bar == least:
                break
            continue
        symbol = {p: base + len(rules) + i for i, p in enumerate(found)}
        rules += found
        at, before = {i for i in at if pairs[i] in symbol}, len(symbols)
        symbols = [symbol[pairs[i]] if i in at else s for i, s in enumerate(symbols) if i - 1 not in at]
        if bar == least and before - len(symbols) < before * repair.GAIN:
            break
    return [p[0] for p in rules], [p[1] for p in rules], symbols


@given(st.lists(st.integers(0, 7), max_size=400), st.integers(2, 9), st.sampled_from([8, 65_500, 65_536, 1 << 20]))
@settings(max_examples=150, deadline=None)
def test_grammar_is_that_of_the_rounds(ids, least, base):
    shard = repair.compress(np.array(ids, np.int64) + base - 8, base, least)
    want = plain_rounds([i + base - 8 for i in ids], base, least)
    assert (shard.left.tolist(), shard.right.tolist(), shard.symbols.tolist()) == want


def test_query_equals_the_library(spark):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    got = sorted(map(tuple, queries.op11_token_files(spark, SF).collect()))
    assert got == brute(rows)


@pytest.fixture
def small_files(monkeypatch):
    """Shards and files of few ids, so that documents go over many. Workers import the module anew: make_file is called here."""
    monkeypatch.setattr(tokenfiles, "SHARD", 64)


def test_documents_over_many_shards(small_files):
    rng = np.random.default_rng(1)
    lengths = np.array([1, 500, 64, 1, 0 + 3, 128, 1000])
    ids = rng.integers(0, 9, lengths.sum())
    numbers = [None, -5, 0, 0, 7, 1 << 40, 9]
    file = tokenfiles.open_file(tokenfiles.make_file(3, 77, numbers, lengths, ids, 10))
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    for k in range(len(lengths)):
        assert file.document(k).tolist() == ids[bounds[k] : bounds[k + 1]].tolist()
    assert (file.documents, file.range, file.first, len(file.starts)) == (numbers, 3, 77, -(-len(ids) // 64))
    found = pa.Table.from_batches(tokenfiles._documents_of(file, ["ids"])).to_pylist()
    assert [f["ids"] for f in found] == [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])]
    assert [f["first"] for f in found] == (77 + bounds[:-1]).tolist()
    with pytest.raises(ValueError, match="not a token file"):
        tokenfiles.open_file(b"something else altogether")


def test_odd_rows(spark):
    rows = [(i // 2 if i != 4 else None, t, "mine", "mine") for i, t in enumerate(TEXTS + TEXTS[3:4] * 2)]
    rows += [(100, f"hot id {i}", None, None) for i in range(200)]
    frame = spark.createDataFrame(rows, DOCS)
    got = tokenfiles.round_trip(frame, WORDS, 2, ("ids", "ids_crc32")).collect()
    got.sort(key=lambda r: r.start)
    assert [r.start for r in got] == [sum(r.n_tokens for r in got[:i]) for i in range(len(got))]
    assert [r.doc_id or -1 for r in got] == sorted(r.doc_id or -1 for r in got) and got[0].doc_id is None
    want = sorted(((i, c[2], c[3]) for i, t, *_ in rows for c in brute([(i, t)])), key=str)
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=str) == want
    assert all(len(r.ids) == r.n_tokens and r.ids[-1] == 2 for r in got)
    assert tokenfiles.round_trip(spark.createDataFrame([], DOCS), WORDS, 2).count() == 0
