"""Operators that look at one row at a time, and those that only add numbers to rows."""

from __future__ import annotations

import hashlib
import random
import re
import struct
import zlib

import plain
import pytest
import xxhash
from cases import EDGE, SENTENCE
from pyspark.sql import functions as F

from siltstone.llm import chat, decontaminate, pii, quality, shards


def test_quality_measures_by_brute_force(query, given):
    texts, rows = given(), query("op8_repetition")
    assert len(rows) == len(texts)
    for r in rows:
        expected = plain.repeats(texts[r.doc_id])
        assert {k: r[k] for k in expected} == expected
        assert r.kept == plain.good(texts[r.doc_id])


def test_quality_of_repeats():
    rng = random.Random(2)
    for _ in range(300):
        words = [rng.choice("abcd") * rng.randrange(1, 3) for _ in range(rng.randrange(80))]
        text = "".join(w + rng.choice(" \n\t") for w in words)
        expected = plain.repeats(text)
        assert dict(zip(quality.FIELDS, quality.measure(text), strict=True)) == expected


def test_quality_edge_texts(edge, nothing):
    rows = quality.assess(edge).collect()
    assert sorted(r.doc_id for r in rows) == sorted(d for d, _ in EDGE)
    assert {r.doc_id: r.n_words for r in rows}[1] == 0
    assert not any(r.kept for r in rows)
    assert quality.assess(nothing).collect() == []
    kept = quality.keep_good(edge.withColumn("text", F.lit(" ".join(f"w{i}" for i in range(60)))))
    assert kept.columns == edge.columns and kept.count() == len(EDGE)


def test_quality_rejects_repeats_that_pass_the_base_rule(spark):
    """A passage or a line that stands twice, in less than half of the words; and what lies just below the limits."""

    def unique(tag, n):
        return " ".join(f"{tag}{i:03d}" for i in range(n))

    passage = unique("p", 98)
    texts = {
        1: " ".join([passage, unique("a", 102), passage, unique("b", 102)]),
        2: "\n".join([unique("a", 150), passage, unique("b", 54), passage]),
        3: " ".join([unique("p", 40), unique("a", 300), unique("p", 40), unique("b", 20)]),
        4: unique("a", 400),
        5: " ".join([unique("p", 41), unique("a", 300), unique("p", 41), unique("b", 18)]),
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    rows = {r.doc_id: r for r in quality.assess(docs).collect()}
    assert not any(r.base_failed for r in rows.values())
    assert 100 * rows[1].n_repeat_words == 49 * rows[1].n_words and rows[1].n_dup_lines == 0 and rows[2].n_dup_lines == 1
    assert {d for d, r in rows.items() if r.kept} == {3, 4} and 100 * rows[3].rep10_chars == 10 * rows[3].word_chars
    assert {r.doc_id for r in quality.keep_good(docs).collect()} == {3, 4}


def contaminated(docs, items, **options):
    rows = decontaminate.contamination(docs, items, **options)
    rows = rows.select("doc_id", "n_words", decontaminate.hit_words(F.col("runs")).alias("n"), "items")
    return sorted((r[0], r[1], r[2], list(r[3])) for r in rows.collect())


def test_decontamination_by_brute_force(spark, given):
    docs, items = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "benchmark"))
    expected = sorted((d, *x) for d, x in plain.hits(given(), given("benchmark", "item_id")).items())
    assert contaminated(docs, items) == expected
    # The same in many blocks of items.
    assert contaminated(docs, items, block_bytes=2000) == expected


def test_decontamination_edge_texts(spark, edge, nothing):
    rows = [(1, "the QUICK, brown"), (2, None), (3, "!!"), (4, "one"), (5, " ".join(f"w{i}" for i in range(14))), (6, "one")]
    items = spark.createDataFrame(rows, "item_id bigint, text string")
    expected = sorted((d, *plain.hits({d: t}, dict(rows))[d]) for d, t in EDGE)
    for size in (1 << 20, 3):
        assert contaminated(edge, items, block_bytes=size) == expected
    assert contaminated(nothing, items) == []
    assert all(not x[3] for x in contaminated(edge, items.limit(0)))
    clean = decontaminate.decontaminate(edge, items)
    assert clean.columns == edge.columns
    assert sorted(r.doc_id for r in clean.collect()) == sorted(x[0] for x in expected if not x[3])


def test_decontamination_of_spans(spark):
    items = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(12)))], "item_id bigint, text string")
    text = "Before. W0 w1, w2 w3 w4 w5 w6 w7 w8 w9 w10-w11! After"
    docs = spark.createDataFrame([(1, text), (2, None), (3, "w0 w1")], "doc_id bigint, text string")
    rows = {r.doc_id: r.text for r in decontaminate.decontaminate(docs, items, action="spans").collect()}
    assert rows == {1: "Before. ! After", 2: None, 3: "w0 w1"}
    with pytest.raises(ValueError):
        decontaminate.decontaminate(docs, items, action="other")


def test_base_spans_are_the_stated_patterns(given):
    rng = random.Random(4)
    letters = "ab@@..  --1111222233334444+()%é٣\n"
    texts = ["".join(rng.choices(letters, k=rng.randrange(50))) for _ in range(8000)]
    cards = ["4111 1111 1111 1111", "4111-1111-1111-1111 4111111111111111111", "1.2.3.4.5.6.7.8", "300.1.1.1", "00001.2.3.0255"]
    for text in [*given().values(), *texts, *cards]:
        assert pii.base_spans(text) == plain.base_spans(text), text


def test_pii_query_keeps_base_spans(query, given):
    texts, rows = given(), query("op3_weak_pii")
    assert len(rows) == len(texts)
    for r in rows:
        base = plain.base_spans(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for k, _, _ in base) for x in pii.BASE]
        written = [f"{k}:{a}:{b}" for k, a, b in sorted(base, key=lambda s: (pii.BASE.index(s[0]), s[1]))]
        assert r.base_sha256 == plain.sha(",".join(written))
        spans = r.spans.split(",") if r.spans else []
        assert set(written) <= set(spans)
        order = [(pii.KINDS.index(s.split(":")[0]), int(s.split(":")[1])) for s in spans]
        assert order == sorted(order)


def test_pii_edge_texts(edge, nothing):
    rows = pii.report(edge).collect()
    assert len(rows) == len(EDGE)
    found = {r.doc_id: r for r in rows}[12]
    assert (found.n_email, found.n_ip, found.n_card, found.n_phone) == (1, 1, 1, 1)
    assert found.spans.startswith("email:5:13,")
    assert pii.report(nothing).collect() == []


def test_labelers_are_told_apart(spark):
    """On planted spans the estimated reliabilities and the classifier must find the planted truth."""
    rng = random.Random(9)
    rows = []
    for i in range(600):
        if i % 2:
            text = f"my api key = \"{rng.randbytes(20).hex()}\" ok"
        else:
            text = f"build {rng.choice('ab') * 30}{rng.randrange(10)}/ no"
        rows.append((i, text))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.doc_id: r.spans for r in pii.report(docs).collect()}
    good = sum(("secret" in found[i]) == bool(i % 2) for i in found)
    assert good >= 0.95 * len(found)


def secrets(text):
    return [(a, b) for kind, a, b in pii.candidates(text, pii.base_spans(text)) if kind == "secret"]


@pytest.mark.parametrize("size", [16, 40, 200, 201, 300, 600, 100_000])
def test_secrets_of_any_length(size):
    rng = random.Random(size)
    token = "k" + "".join(rng.choices("abcdefXYZ_/+-", k=size - 2)) + "7"
    for end in ("", "=", "=="):
        text = f"api key = {token}{end} ok"
        assert secrets(text) == [(10, 10 + size + len(end))]
    # Neither letters only, digits only, nor a part of a longer run.
    assert secrets(f"api key = {'k' * size} {'_7' * size}") == []
    assert secrets(f"api key = {token}=== {token}é") == []


def test_secrets_in_short_runs_are_as_before():
    stated = r"(?<![\w/+-])(?=[\w/+-]*[0-9])(?=[0-9_/+-]*[A-Za-z])[A-Za-z0-9_/+-]{16,}={0,2}(?![\w/+=-])"
    rng = random.Random(6)
    for _ in range(5000):
        text = "".join(rng.choices(["ab", "Z", "_", "/", "77", "=", " ", ".", "é", "key", "-"], k=rng.randrange(60)))
        found = [m.span() for m in re.finditer(stated, text)]
        assert [m.span() for m in pii.LOOSE["secret"].finditer(text) if re.search("[0-9]", m[0]) and re.search("[A-Za-z]", m[0])] == found


def test_long_secrets_are_reported(spark):
    rng = random.Random(8)
    sizes = [40, 201, 400]
    rows = [(i, f"my api key = \"{rng.randbytes(sizes[i % 3]).hex()[: sizes[i % 3]]}\" ok") for i in range(60)]
    found = pii.report(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.doc_id: r.spans for r in found} == {i: f"secret:14:{14 + sizes[i % 3]}" for i, _ in rows}


def test_rendezvous_keeps_its_law(query, given):
    texts, rows = given(), query("op9_rendezvous")
    assert len(rows) == len(texts)
    slots = {}
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law) == (len(data) + 8, zlib.crc32(data), "key")
        assert 0 <= r.shard < 24 and r.grown_shard in (r.shard, 24)
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert any(r.grown_shard == 24 for r in rows)


def test_winning_shards_by_every_score(query):
    """The score of each shard from the published hash, in plain Python; the greatest wins, ties go to the higher number."""

    def draws(key):
        first = xxhash.xxh64_intdigest(struct.pack("<q", key), 42)
        return [xxhash.xxh64_intdigest(struct.pack("<q", s), first) >> 11 for s in range(25)]

    for r in query("op9_rendezvous"):
        scores = draws(r.doc_id)
        assert r.shard == max(range(24), key=lambda s: (scores[s], s))
        assert r.grown_shard == max(range(25), key=lambda s: (scores[s], s))


def test_weights_and_moves(spark):
    keys = spark.range(40_000).withColumn("key", F.col("id"))
    shares = [1.0, 2.0, 0.0, 5.0]
    rows = keys.select(
        shards.shard_of(F.col("key"), shares).alias("a"), shards.shard_of(F.col("key"), [1.0, 2.0, 0.0, 5.0, 2.0]).alias("b")
    )
    counts = {r.a: r["count"] for r in rows.groupBy("a").count().collect()}
    assert set(counts) == {0, 1, 3}
    for k in counts:
        assert abs(counts[k] / 40_000 - shares[k] / 8) < 0.02
    moved = rows.where("a != b")
    assert moved.where("b != 4").count() == 0
    assert abs(moved.count() / 40_000 - 0.2) < 0.02
    with pytest.raises(ValueError):
        shards.shard_of(F.col("key"), [0.0])


def test_shards_of_edge_rows(spark, edge, nothing, tmp_path):
    more = edge.unionByName(edge.withColumn("doc_id", F.lit(None).cast("bigint")))
    rows = shards.assign(more, [1.0] * 3, [1.0] * 4).collect()
    assert len(rows) == 2 * len(EDGE)
    assert len({r.shard for r in rows if r.doc_id is None}) == 1
    for s in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    assert shards.assign(nothing, [1.0], [1.0, 1.0]).collect() == []
    with pytest.raises(ValueError, match="a column shard"):
        shards.write_shards(edge, str(tmp_path / "out"), [1.0, 1.0])
    shards.write_shards(edge, str(tmp_path / "out"), [1.0, 1.0], column="part")
    kept = spark.read.parquet(str(tmp_path / "out")).drop("part")
    assert sorted(kept.select(edge.columns).collect(), key=str) == sorted(edge.collect(), key=str)


def test_slots_of_a_hot_key(spark, monkeypatch):
    """Half of all rows are copies of one, a fourth share its key: slots stay gapless, and no task numbers the copies one by one."""
    monkeypatch.setattr(shards, "STRETCH", 7)
    copies = [(5, "same")] * 100 + [(5, f"text {i}") for i in range(50)] + [(i, None) for i in range(50)]
    rows = shards.assign(spark.createDataFrame(copies, "doc_id bigint, text string"), [1.0] * 3, [1.0] * 4).collect()
    assert len(rows) == 200 and sum(r.text_crc32 == zlib.crc32(b"same") for r in rows) == 100
    for s in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))


TURNS = "conv_id bigint, turn bigint, role string, text string, segments string, formatted string"


def read_back(chats):
    rows = chats.select("conv_id", chat.read_turns(F.col("formatted")).alias("t"), chat.loss_text(F.col("segments")).alias("l"), "formatted", "segments")
    out = {}
    for r in rows.collect():
        assert "".join(s.text for s in r.segments) == r.formatted
        out[r.conv_id] = ([(t.role, t.text) for t in r.t], r.l)
    return out


def test_chats_come_back(spark):
    rng = random.Random(3)
    parts = ["<", "|", "\\", "im_start|>", "<|im_end|>", "<|im_sep|>", "</s>", "[INST]", "[/INST]", "\n", "é", "", "%0A", "$1", "[\\INST]"]
    rows, expected = [], {}
    for c in range(60):
        turns = [
            (k, rng.choice(["user", "assistant", "sys\ntem", "<|im_end|>", "%25", ""]), "".join(rng.choices(parts, k=rng.randrange(9))))
            for k in range(rng.randrange(1, 12))
        ]
        expected[c] = ([t[1:] for t in turns], "".join(t[2] for t in turns if t[1] == "assistant"))
        shuffled = turns[:]
        rng.shuffle(shuffled)
        rows += [(c, *t, "x", "y") for t in shuffled]
    assert read_back(chat.format_chats(spark.createDataFrame(rows, TURNS))) == expected


def test_chat_blocks_and_edges(spark):
    rows = [
        (1, 0, "user", "hi", "", ""),
        (1, 1, "assistant", "a", "", ""),
        (1, 2, "assistant", None, "", ""),
        (1, 3, "assistant", "c", "", ""),
        (None, 5, None, None, "", ""),
        (2, None, "assistant", "late", "", ""),
        (2, 1, "user", "b", "", ""),
        (2, 1, "user", "a", "", ""),
        (2, 1, "user", "a", "", ""),
    ]
    chats = chat.format_chats(spark.createDataFrame(rows, TURNS))
    assert chats.where("conv_id = 1").first().formatted == (
        "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\na<|im_sep|><|im_sep|>c<|im_end|>\n"
    )
    back = read_back(chats)
    assert back[1] == ([("user", "hi"), ("assistant", "a"), ("assistant", ""), ("assistant", "c")], "ac")
    assert back[None] == ([("", "")], "")
    assert back[2] == ([("assistant", "late"), ("user", "a"), ("user", "a"), ("user", "b")], "late")
    assert chat.format_chats(spark.createDataFrame([], TURNS)).collect() == []


def test_a_long_conversation(spark):
    turns = spark.range(5000).selectExpr("1L conv_id", "id turn", "if(id % 3 = 0, 'user', 'assistant') role", "concat('t', id) text")
    [(turns_back, loss)] = read_back(chat.format_chats(turns)).values()
    assert turns_back == [("user" if k % 3 == 0 else "assistant", f"t{k}") for k in range(5000)]
    assert loss == "".join(f"t{k}" for k in range(5000) if k % 3)


def test_chat_plan_has_no_python(spark):
    turns = spark.createDataFrame([(1, 0, "user", "x", "", "")], TURNS)
    plan = chat.format_chats(turns)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_sentence_digest():
    assert hashlib.sha256(SENTENCE.encode()).hexdigest() == plain.sha(SENTENCE)
