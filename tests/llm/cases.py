"""Rows that every operator must take."""

from __future__ import annotations

FOLDER = "/root/testdata/sf0.001"

LONG = "lorem ipsum dolor " * 30_000
SENTENCE = "The quick brown fox jumps over the lazy dog near the river bank today"
# Null and empty texts, white space only, very long ones, repeated rows, other scripts, control strings.
EDGE = [
    (1, None),
    (2, ""),
    (3, " \t\n\x0b "),
    (4, LONG),
    (5, "x" * 100_000),
    (6, SENTENCE),
    (7, SENTENCE),
    (8, SENTENCE + "\n" + SENTENCE.upper()),
    (9, SENTENCE),
    (9, SENTENCE),
    (10, "Straße 一二三 naïve \U0001f642 don't we'll 12.5%"),
    (11, "a"),
    (12, "mail a.b@c.de or +49 (30) 1234-5678, 10.0.0.1, 4111 1111 1111 1111"),
    (13, "one\n\ntwo\n"),
]
# Columns that have the names of results and of inner columns.
CLASHING = (
    "n_tokens bigint, ids string, m string, scan string, row string, keys string, result string, shard string, slot string, "
    "id string, class string, n string, sketch string, component_id string, kept string, spans string, size string, "
    "_doc string, doc string, _row string, _text string, items string, runs string, key string, bucket string"
)
