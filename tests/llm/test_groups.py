"""Operators that compare rows with each other: lines, near duplicates, archives, the pipeline."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import plain
import pytest
from cases import EDGE, FOLDER, SENTENCE
from pyspark.sql import functions as F

from siltstone.llm import lines, neardup, warc
from siltstone.llm.components import components
from siltstone.llm.cuckoo import Cuckoo

DOCS = "doc_id bigint, text string"


# ---------------------------------------------------------------- lines


def test_cuckoo_filter_holds_what_it_was_given():
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(0, (1 << 64) - 1, 3500, np.uint64))
    cuckoo = Cuckoo(10)
    cuckoo.insert(keys)
    assert len(cuckoo.stash) == 0 and cuckoo.contains(keys).all()
    again = Cuckoo(data=cuckoo.to_bytes())
    assert again.delete(keys[:1500]).all()
    assert again.contains(keys[1500:]).all()
    others = rng.integers(0, (1 << 64) - 1, 20_000, np.uint64)
    assert again.contains(others).mean() < 0.002
    assert again.contains(keys[:1500]).mean() < 0.01


def test_an_overfull_filter_forgets_nothing():
    keys = np.random.default_rng(1).integers(0, (1 << 64) - 1, 300, np.uint64)
    cuckoo = Cuckoo(6)
    for part in np.array_split(keys, 7):
        cuckoo.insert(part)
    assert len(cuckoo.stash) >= 300 - 256 and cuckoo.contains(keys).all()
    again = Cuckoo(data=cuckoo.to_bytes())
    assert again.delete(keys[:200]).all() and again.contains(keys[200:]).all()
    assert again.contains(keys[:200]).mean() < 0.02
    assert Cuckoo.bits_for(0) >= 1 and 4 << Cuckoo.bits_for(10_000) >= 12_000


def cleaned(index, docs):
    rows = index.clean(docs).select("row.doc_id", "result.n_lines", "result.n_dropped", "result.text").collect()
    return {r[0]: tuple(r[1:]) for r in rows}


def many_lines(spark, seed, ids):
    rng = random.Random(seed)
    pool = [f"{SENTENCE} number {k}" for k in range(25)] + ["short", "", "  " + SENTENCE.upper() + "\t"]
    texts = {i: "\n".join(rng.choices(pool, k=rng.randrange(1, 6))) for i in ids}
    return texts, spark.createDataFrame(list(texts.items()), DOCS)


def test_lines_by_brute_force(spark, given):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    assert cleaned(lines.LineIndex(spark).insert(docs), docs) == plain.clean_lines(given())


def test_documents_come_and_go(spark):
    """After any insertions and deletions the index equals one built from what is left."""
    first, a = many_lines(spark, 1, range(40))
    second, b = many_lines(spark, 2, range(40, 70))
    index = lines.LineIndex(spark, shards=5).insert(a).insert(b)
    everything = first | second
    assert cleaned(index, a.unionByName(b)) == plain.clean_lines(everything)
    gone = list(range(5, 70, 2))
    index.delete(spark.createDataFrame([(i,) for i in [*gone, 999]], "doc_id bigint"))
    left = {d: t for d, t in everything.items() if d not in gone}
    rest = spark.createDataFrame(list(left.items()), DOCS)
    assert cleaned(index, rest) == plain.clean_lines(left)
    fresh = lines.LineIndex(spark, shards=5).insert(rest)
    columns = ["shard", "key", "n_docs", "holder"]
    assert sorted(map(str, index.table("counts").select(columns).collect())) == sorted(
        map(str, fresh.table("counts").select(columns).collect())
    )
    index.insert(spark.createDataFrame([(i, everything[i]) for i in gone], DOCS))
    assert cleaned(index, a.unionByName(b)) == plain.clean_lines(everything)


def test_lines_of_repeated_rows(spark):
    """Rows that share an id are one document, inserted together or one after the other."""

    def docs(*ids):
        return spark.createDataFrame([(i, SENTENCE) for i in ids], DOCS)

    for index in (
        lines.LineIndex(spark, shards=2).insert(docs(6, 9, 9)),
        lines.LineIndex(spark, shards=2).insert(docs(6, 9)).insert(docs(9)),
    ):
        assert {r.doc_id: r.n_dropped for r in index.clean(docs(6, 9, 9)).select("row.doc_id", "result.n_dropped").collect()} == {6: 0, 9: 0}
        index.insert(docs(7, 7))
        assert index.table("counts").select("n_docs", "holder").collect() == [(3, 9)]
        index.delete(docs(9).select("doc_id"))
        assert index.table("counts").select("n_docs", "holder").collect() == [(2, 7)]


def test_line_edge_rows(spark, edge, nothing):
    result = lines.dedup_lines(edge)
    assert result.columns == edge.columns
    rows = {r.doc_id: r.text for r in result.collect()}
    assert result.count() == len(EDGE)
    # The sentence is in 6, 7, 8 and twice in 9: only the largest id keeps it.
    assert (rows[1], rows[2], rows[6], rows[8], rows[9]) == (None, "", "", "", SENTENCE)
    assert rows[4] == dict(EDGE)[4]
    assert lines.dedup_lines(nothing).collect() == []
    unknown = spark.createDataFrame([(None, SENTENCE), (None, SENTENCE), (1, SENTENCE)], DOCS)
    assert sorted((r.doc_id or 0, r.text) for r in lines.dedup_lines(unknown).collect()) == [(0, ""), (0, ""), (1, SENTENCE)]


# ---------------------------------------------------------------- near duplicates


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 130)] + [(7, k) for k in range(8, 40)] + [(3, 3), (41, 40), (40, 41), (9, 8)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert found == dict.fromkeys(range(100, 131), 100) | dict.fromkeys(range(7, 40), 7) | {40: 40, 41: 40}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def result(docs):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(docs).collect()}


def expected(texts):
    return {d: (n, c, c == d) for d, (n, c) in plain.groups(texts).items()}


def test_near_duplicates_by_brute_force(spark, given):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert result(docs) == expected(given())


def test_a_group_of_spread_copies(spark):
    """Many edits of one text: some link with the source, some only with each other, some with nothing."""
    rng = random.Random(6)
    source = [f"word{i}" for i in range(150)]
    texts = {}
    for d in range(260):
        words = source[:]
        for _ in range(rng.choice([0, 1, 2, 3, 4, 6, 9])):
            words[rng.randrange(len(words))] = f"other{rng.randrange(40)}"
        texts[d] = " ".join(words)
    for d in range(260, 330):
        texts[d] = " ".join(rng.choices(["red", "green", "blue"], k=rng.randrange(1, 8)))
    assert result(spark.createDataFrame(list(texts.items()), DOCS)) == expected(texts)


def test_near_duplicate_edge_rows(spark, edge, nothing):
    rows = neardup.near_duplicates(edge).collect()
    assert len(rows) == len(EDGE)
    found = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows}
    assert found == expected(dict(EDGE))
    assert neardup.near_duplicates(nothing).collect() == []
    one = neardup.keep_one(edge)
    assert one.columns == edge.columns
    assert sorted({r.doc_id for r in one.collect()}) == sorted(d for d, x in found.items() if x[2])
    unknown = spark.createDataFrame([(None, SENTENCE), (None, SENTENCE), (1, SENTENCE)], DOCS)
    assert sorted((r.doc_id or 0, r.component_id, r.kept) for r in neardup.near_duplicates(unknown).collect()) == [
        (0, None, True), (0, None, True), (1, 1, True),
    ]


def test_estimates_are_near_the_truth():
    rng = np.random.default_rng(2)
    errors = []
    for n, share in ((30, 0.8), (400, 0.75), (5000, 0.5), (5000, 0.0)):
        for _ in range(20):
            a = np.unique(rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2))
            b = np.unique(np.concatenate((a[: int(len(a) * share)], rng.integers(0, 1 << 63, n - int(n * share), np.uint64) * np.uint64(2))))
            both = len(np.intersect1d(a, b))
            truth = both / (len(a) + len(b) - both)
            agreeing = (neardup.registers(a) == neardup.registers(b)).sum()
            errors.append(neardup.estimate(agreeing, np.array(float(len(a))), np.array(float(len(b)))) - truth)
    assert abs(np.mean(errors)) < 0.02 and np.abs(errors).max() < 0.4


# ---------------------------------------------------------------- archives

PAGES = "page_id bigint, url string, html string, record_key string, segment string"


def test_archives_of_edge_pages(spark, tmp_path):
    body = "<p>WARC/1.1\r\n\r\nhttp://a 0.0.0.0 20240101000000 text/html 5\n" + "é" * 100
    rows = [
        (5, "http://a b/\n", body), (3, "http://a/", body), (9, None, body), (3, "http://a/", body),
        (4, "http://c/", None), (6, "http://c/", ""), (7, "ftp://x", "short"), (8, "http://x", "short"), (None, "http://n/", body),
    ]
    pages = spark.createDataFrame([(*r, "k", "s") for r in rows], PAGES)
    found = warc.archive_pages(pages, str(tmp_path / "w")).collect()
    digest, size = plain.sha(body), len(body.encode())
    got = sorted((int(r.record_key or -1), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found)
    assert got == [
        (-1, size, digest, "response", None),
        (3, size, digest, "response", None),
        (3, size, digest, "response", None),
        (4, 0, plain.sha(""), "response", None),
        (5, size, digest, "revisit", "3"),
        (6, 0, plain.sha(""), "response", None),
        (7, 5, plain.sha("short"), "response", None),
        (8, 5, plain.sha("short"), "response", None),
        (9, size, digest, "revisit", "3"),
    ]
    assert len({r.record_id for r in found}) == len(rows)
    assert warc.archive_pages(pages.limit(0), str(tmp_path / "none")).collect() == []


def test_files_stay_small(spark, tmp_path):
    pages = spark.range(300).selectExpr("id page_id", "concat('http://h/', id) url", "repeat(concat('x', id), 500) html", "'' record_key", "'' segment")
    records = warc.convert(warc.pack_arcs(pages)).withColumn("key_number", __import__("pyspark").sql.functions.col("record_key").cast("bigint"))
    warc.write_warcs(warc.with_revisits(records, warc.repeated_payloads(records)), str(tmp_path / "w"), limit=100_000)
    import glob
    import gzip

    files = glob.glob(f"{tmp_path}/w/**/*.gz", recursive=True)
    assert len(files) > 5
    for f in files:
        with open(f, "rb") as g:
            data = gzip.decompress(g.read())
        assert len(data) < 110_000 and data.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo") and data.endswith(b"\r\n\r\n")
    assert warc.read_warcs(spark, str(tmp_path / "w")).count() == 300


@pytest.mark.parametrize("version", [b"1", b"2"])
def test_arc_versions(version):
    date = "20050102030405"
    content = warc.arc_start("x.arc", version, date)
    blocks = [b"HTTP/1.0 200 OK\r\n\r\nbody\n", b"", b"dns answer\n\n"]
    for k, block in enumerate(blocks):
        content += warc.arc_record(version, f"http://h/{k}", date, block, len(content), "x.arc")
    found = list(warc.arc_records("x.arc", content))
    assert [b for _, _, b in found][1:] == blocks
    assert [h["url"] for h, _, _ in found] == ["filedesc://x.arc", "http://h/0", "http://h/1", "http://h/2"]
    assert warc.warc_date(date) == "2005-01-02T03:04:05Z" and warc.warc_date("200501") == "2005-01-01T00:00:00Z"
    with pytest.raises(ValueError, match="cut off"):
        list(warc.arc_records("x.arc", content[:-8]))
    with pytest.raises(ValueError, match="no header"):
        list(warc.arc_records("x.arc", content + b"http://h/ oops\n"))


# ---------------------------------------------------------------- pipeline


def test_a_changed_block_is_noticed():
    block = b"HTTP/1.1 200 OK\r\n\r\nhello"
    fields = [("WARC-Type", "response"), ("WARC-Block-Digest", "sha256:" + hashlib.sha256(block).hexdigest())]
    content = warc.warc_bytes(fields, block)
    assert [b for _, b in warc.warc_records("x.warc", content * 2)] == [block] * 2
    with pytest.raises(ValueError, match="byte 0 has another digest"):
        list(warc.warc_records("x.warc", content.replace(b"hello", b"jello")))


def test_archives_are_packed_once(spark, tmp_path):
    """Rows come in another order each time they are computed; all readers see one packing, so no reference dangles."""
    many = spark.range(600).select(
        F.col("id").alias("page_id"), F.lit("http://h/").alias("url"), F.repeat(F.lit("same text "), 20).alias("html")
    )
    arcs = warc.stored_arcs(warc.pack_arcs(many.orderBy(F.rand()), "page_id", "url", "html"))
    ids = [{r.record_id for r in warc.convert(arcs, with_payload=p).collect()} for p in (False, True)]
    assert ids[0] == ids[1] and len(ids[0]) == 600


def test_pipeline_by_brute_force(query, given):
    rows = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in query("pipeline")}
    assert rows == plain.pipeline(given(), given("benchmark", "item_id"))
