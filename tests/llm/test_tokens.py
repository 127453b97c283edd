"""Byte-level BPE and token counts against the public libraries."""

from __future__ import annotations

import random

import numpy as np
import plain
import public_tokenizers
import pytest
from cases import EDGE

from siltstone.llm.bpe import Encoder, PairTable, Tokenizer
from siltstone.llm.token_counts import ENTRIES, Counter, LengthTable, PieceModel, count_tokens, frequent_tokens

RANKS, PIECES = (public_tokenizers.path(n) for n in ("byte_bpe_50k.tiktoken", "piece_bpe_32k.model"))


def read(path):
    with open(path, "rb") as f:
        return f.read()


@pytest.fixture(scope="module")
def encoder():
    return Encoder(read(RANKS), public_tokenizers.PATTERN)


def odd_texts():
    rng = random.Random(5)
    letters = "ab '’streß \n\t\r.,!?0123½Ⅳ一二　​\U0001f642<|endoftext|>▁</s>\x00\x85é"
    made = ["".join(rng.choices(letters, k=rng.randrange(60))) for _ in range(1500)]
    made += ["".join(rng.choices("thertionabc", k=rng.randrange(1, 320))) for _ in range(500)]
    return made + ["a" * 3000, " " * 999 + "x", "'" * 300 + "s", "don't we'll I'M 's", "", " ", "▁", "\n ", "  "]


def encoded(encoder, texts):
    flat, ends = encoder.encode(texts)
    return [flat[a:b].tolist() for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]


def test_ids_are_those_of_the_library(encoder):
    texts, library = odd_texts(), plain.byte_bpe()
    assert encoded(encoder, texts) == [library.encode_ordinary(t) for t in texts]


def test_any_pattern_splits_alike(encoder):
    other = Encoder(read(RANKS), "(?:" + public_tokenizers.PATTERN + ")")
    texts = odd_texts()
    assert encoded(other, texts) == encoded(encoder, texts)


def test_decoding_gives_the_bytes_back(encoder):
    for text in odd_texts()[::50]:
        ids, _ = encoder.encode([text])
        assert encoder.decode(ids.astype(np.int64))[0].tobytes() == text.encode()
    with pytest.raises(ValueError):
        encoder.decode(np.array([60_000]))


def test_pair_table_finds_exactly_what_it_holds():
    rng = np.random.default_rng(1)
    pairs = np.unique(rng.integers(0, 500, (3000, 2)), axis=0)
    table = PairTable(pairs[:, 0] << 32 | pairs[:, 1], np.arange(len(pairs), dtype=np.int32))
    assert (table.get(pairs[:, 0], pairs[:, 1]) == np.arange(len(pairs))).all()
    held = set(map(tuple, pairs.tolist()))
    others = [(a, b) for a in range(0, 500, 7) for b in range(0, 500, 7) if (a, b) not in held]
    a, b = np.array(others).T
    assert (table.get(a, b) == 1 << 30).all()


def test_query_encodes_every_document(query, given):
    rows = query("op1_byte_bpe")
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows} == plain.tokens_of(given())


def test_edge_texts(spark, edge, nothing):
    tokenizer = Tokenizer(spark, RANKS, public_tokenizers.PATTERN)
    columns = edge.select("doc_id", "text")
    rows = tokenizer.decode(tokenizer.encode(columns)).collect()
    library = plain.byte_bpe()
    assert len(rows) == len(EDGE)
    for r in rows:
        assert list(r.ids) == library.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode()
    assert tokenizer.decode(tokenizer.encode(nothing)).collect() == []


def counter_of(words):
    model = PieceModel(read(PIECES))
    return Counter(model, LengthTable.from_parts(*LengthTable.of(words, model.counts(words)).parts()))


def test_counts_are_those_of_the_model():
    library, texts, model = plain.piece_bpe(), odd_texts(), PieceModel(read(PIECES))
    words = sorted({w for t in texts for w in model.words(t)})
    counter = counter_of(words[::2])
    assert counter.totals(texts) == [len(library.encode(t)) for t in texts]
    assert (counter.asked, counter.answered) == (len(words), len(words[::2]))


def test_a_full_cache_changes_nothing(monkeypatch):
    monkeypatch.setattr("siltstone.llm.token_counts.CACHED", 3)
    counter, library = counter_of(["▁a"]), plain.piece_bpe()
    for text in odd_texts()[:200]:
        before = len(counter.cache)
        assert counter.totals([text]) == [len(library.encode(text))]
        assert before <= 3 or len(counter.cache) < before + 30
    assert counter.totals([]) == [] and counter.totals([""]) == [0]


def test_a_table_with_equal_hashes(monkeypatch):
    """Hits are verified by the text: with few hashes for many pre-tokens none is mistaken for another."""
    monkeypatch.setattr("siltstone.llm.token_counts.xxh3_64_intdigest", lambda text: len(text) % 3)
    words = [f"w{i}" for i in range(120)]
    table = LengthTable.of(words, list(range(1, 121)))
    assert table.get([*words, "w120", "", "x"]) == [*range(1, 121), 0, 0, 0]


def test_frequent_tokens_answer_most(spark):
    """Of all pre-tokens of the largest given table, the table answers over nine in ten; their lengths are not all one."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    file = read(PIECES)
    words = frequent_tokens(docs, spark.sparkContext.broadcast(file), "text", ENTRIES)
    model = PieceModel(file)
    sizes = dict(zip(words, model.counts(words), strict=True))
    assert len(words) == len(sizes) <= ENTRIES and sum(n > 1 for n in sizes.values()) > 1000
    occurrences = [w for r in docs.where("doc_id % 7 = 0").select("text").collect() for w in model.words(r.text or "")]
    assert sum(w in sizes for w in occurrences) > 0.9 * len(occurrences)


def test_counts_do_not_depend_on_the_table(edge):
    few, many = (sorted(map(tuple, count_tokens(edge, PIECES, entries=n).collect())) for n in (1, 1000))
    assert few == many


def test_count_query(query, given):
    library = plain.piece_bpe()
    expected = {d: (len(t.encode()), n := len(library.encode(t)), n > 4096) for d, t in given().items()}
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in query("op4_token_counts")} == expected


def test_count_edge_texts(edge, nothing):
    library, rows = plain.piece_bpe(), count_tokens(edge, PIECES).collect()
    expected = [(d, len((t or "").encode()), len(library.encode(t or ""))) for d, t in EDGE]
    assert sorted(r[:3] for r in rows) == sorted(expected)
    assert count_tokens(nothing, PIECES).collect() == []
