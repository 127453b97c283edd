"""Flat files of token ids, against the library."""

from __future__ import annotations

import random
import zlib
from collections import Counter
from itertools import pairwise

import numpy as np
import public_tokenizers
import pytest
import tokenizers
from cases import CLASHING, EDGE

from siltstone.llm import token_files
from siltstone.llm.bpe import Splitter

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


def expected(library, texts: list[tuple], end: int = 0) -> list[tuple]:
    out, start = [], 0
    ids = [np.array([*library.encode(t or "", add_special_tokens=False).ids, end], "<u4") for _, t in texts]
    for (key, _), found in sorted(zip(texts, ids, strict=True), key=lambda x: (x[0][0] is not None, x[0][0] or 0)):
        out.append((key, start, len(found), zlib.crc32(found.tobytes())))
        start += len(found)
    return out


def test_query_by_the_library(query, given, library):
    found = sorted(tuple(r[c] for c in ("doc_id", "start", "n_tokens", "ids_crc32")) for r in query("op13_token_files"))
    assert found == expected(library, list(given().items()))


def test_encoder_by_the_library(library):
    with open(PATH, "rb") as f:
        encoder = token_files.Encoder(f.read())
    assert encoder.split is not None
    rng = random.Random(5)
    signs = ["a", "B", "é", "中", "1", "٣", "'", "'s", "'re", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", " ", "​"]
    signs += ["!", "don't", "\0", "\U0001f642", "<|endoftext|>", "<|", "x" * 70]
    texts = ["".join(rng.choices(signs, k=rng.randrange(30))) for _ in range(3000)]
    for text, ids in zip(texts, encoder(texts), strict=True):
        assert np.frombuffer(ids, encoder.item).tolist() == library.encode(text, add_special_tokens=False).ids, text


SIGNS = ["a", "B", "é", "中", "1", "'", "'s", "'re", "'ll", " ", "  ", "\n", "\u2003", "!", "\0", "\U0001f642", "x" * 70]


def test_texts_are_split_as_one():
    """The matches in a column are those of each text alone, whatever its neighbours are."""
    rng, split = random.Random(7), Splitter()
    for most in (3, 12):
        texts = ["".join(rng.choices(SIGNS, k=rng.randrange(most))) for _ in range(4000)]
        words, seams = split.column(texts)
        words = words.to_pylist()
        assert [words[a + 1 : b] for a, b in pairwise([-1, *seams.tolist()])] == [split(t) for t in texts]
        assert not any(words[k] for k in seams.tolist())


class Counted:
    """The library, and the pre-tokens it was given."""

    def __init__(self, library):
        self.library, self.given = library, Counter()

    def encode(self, words, **options):
        self.given.update(words)
        return self.library.encode(words, **options)

    def encode_batch_fast(self, words, **options):
        self.given.update(words)
        return self.library.encode_batch_fast(words, **options)


def test_frequent_pre_tokens_are_encoded_once(library, monkeypatch):
    """Making room for new pre-tokens forgets neither the frequent ones nor any id, and what is kept has a bound."""
    with open(PATH, "rb") as f:
        encoder = token_files.Encoder(f.read())
    monkeypatch.setattr(token_files, "REMEMBERED", 200)
    monkeypatch.setattr(token_files, "REMEMBERED_IDS", 3000, raising=False)
    encoder.library = Counted(library)
    frequent = [f" frequent{'abcdefghij'[k]}" for k in range(10)]
    for call in range(60):
        rare = [" " + "".join(chr(97 + (call * 40 + k) // 26**d % 26) for d in range(3)) + "rare" for k in range(40)]
        texts = ["".join(frequent + rare), "", f" {'y' * (70 + call)}", "".join(rare[:5])]
        for text, ids in zip(texts, encoder(texts), strict=True):
            assert np.frombuffer(ids, encoder.item).tolist() == library.encode(text, add_special_tokens=False).ids
        assert len(encoder.numbers) <= 300 and len(encoder.ids) <= 6000
    assert max(encoder.library.given[w] for w in frequent) == 1


@pytest.mark.parametrize("end", [0, 50256, 70000])
def test_edge_texts(edge, spark, library, tmp_path, end):
    """Also with end ids that have no zero byte, or need 32 bits; and a null key."""
    rows = edge.unionByName(edge.where("doc_id = 6").selectExpr("null AS doc_id", "text", *CLASHING_NAMES))
    folder = str(tmp_path / "tokens")
    files = token_files.write_tokens(rows, folder, PATH, end=end, text_bytes=4096)
    found = files.read().selectExpr("key", "start", "n_tokens", "crc32(ids)").collect()
    texts = [*EDGE, (None, dict(EDGE)[6])]
    order = sorted(map(tuple, found), key=lambda r: (r[1], r[0] or 0))
    assert order == expected(library, texts, end)
    mapped = token_files.MappedTokens(folder)
    assert len(mapped) == len(texts)
    for number, (_, _, size, crc) in enumerate(order):
        assert len(mapped[number]) == size
        assert zlib.crc32(mapped[number].astype("<u4").tobytes()) == crc


CLASHING_NAMES = [c.split()[0] for c in CLASHING.split(", ")]


def test_nothing(nothing, tmp_path):
    files = token_files.write_tokens(nothing, str(tmp_path / "tokens"), PATH)
    assert files.read().collect() == []
    assert len(token_files.MappedTokens(str(tmp_path / "tokens"))) == 0


def test_one_key_is_split(spark, tmp_path):
    """Rows of one key lie in several files, without gaps."""
    docs = spark.range(4000).selectExpr("7L AS doc_id", "concat('word ', id % 3) AS text")
    files = token_files.write_tokens(docs, str(tmp_path / "tokens"), PATH)
    assert files.layout().count() > 4
    rows = sorted(files.read().selectExpr("start", "n_tokens").collect())
    assert [r.start for r in rows] == list(range(0, 12000, 3)) and all(r.n_tokens == 3 for r in rows)


def test_key_must_be_an_integer(spark, tmp_path):
    docs = spark.createDataFrame([("a", "b")], "doc_id string, text string")
    with pytest.raises(ValueError, match="integer"):
        token_files.write_tokens(docs, str(tmp_path / "tokens"), PATH)
