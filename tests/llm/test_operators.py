"""The training-data operators: edge cases, and plain versions of what they compute."""

import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from strandwise.llm import decontamination, license_scan, near_dedup, packing, pii, quality, sharding, suffix_dedup, token_rollup, warc
from strandwise.llm.common import scratch_path
from strandwise.llm.queries import tokenizer_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, base string"


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(3, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    base, passage = words(rng, 120), words(rng, 70)
    parts = base.split()
    near = " ".join(parts[:60] + ["xxxx"] + parts[61:])
    item = words(rng, 30)
    edited = " ".join(w if i % 7 else "zzz" for i, w in enumerate(item.split()))
    texts = {
        0: None, 1: "", 2: base, 3: near, 4: base, 5: words(rng, 90) + " " + passage + " " + words(rng, 40), 6: words(rng, 50) + " " + passage,
        7: words(rng, 40) + " " + item + " " + words(rng, 40), 8: words(rng, 40) + " " + edited + " " + words(rng, 30), 9: words(rng, 30_000),
        10: "mail a.b@c.example.org or +1 (555) 123-4567 from 10.0.0.1 with 4111 1111 1111 1111 and 300.1.1.1", 11: "one two three",
        12: words(rng, 60) + " Released under CC BY 4.0. All Rights RESERVED. GNU General Public License", 13: "repeat it again " * 40,
    }
    return [(i, t, "en", None if i == 3 else "s", 0, "clash") for i, t in texts.items()] + [(2, base, "en", "s", 0, "clash")], item


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows[0], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_quality(docs, empty, rows):
    got = {r.doc_id: r for r in quality.quality(docs).collect()}
    for i, t, *_ in rows[0]:
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", t or "") if x]
        grams = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        seen = {g for g in grams if grams.count(g) > 1} if len(w) < 1000 else set()
        marked = {k + j for k, g in enumerate(grams) if g in seen for j in range(3)}
        assert (got[i].n_words, got[i].n_repeat_words) == (len(w), len(marked))
    assert not got[0].kept and got[13].base_failed
    assert quality.quality(empty).count() == 0


def test_function_word_rule(spark):
    text = lambda n: " ".join(["the"] * n + [f"w{i}" for i in range(100 - n)])
    docs = spark.createDataFrame([(n, text(n)) for n in range(4)], "doc_id long, text string")
    judged = lambda **given: {r.doc_id: (r.kept, r.failed_rules) for r in quality.quality(docs, **given).collect()}
    poor = (False, "a function word in 50 words")
    assert judged() == {0: poor, 1: poor, 2: (True, ""), 3: (True, "")}
    assert judged(stop_words=["w1", "w2"]) == dict.fromkeys(range(4), (True, ""))
    tags = ["en", "EN-gb", "fr", None, "", "fi", "zh_TW", "est"]
    tagged = spark.createDataFrame([(i, text(0), tag) for i, tag in enumerate(tags)], "doc_id long, text string, lang string")
    kept = lambda **given: [r.kept for r in quality.quality(tagged, **given).orderBy("doc_id").collect()]
    assert kept(lang="lang") == [False] * 5 + [True] * 3 and kept() == [False] * 8
    assert kept(lang="lang", stop_words=["w1"]) == [False] * 8 and kept(lang="lang", stop_words=["w1", "w2"]) == [True] * 8


def test_personal_data(docs, empty, rows):
    model = pii.fit(docs)
    got = {r.doc_id: r for r in pii.find(docs, model).select("doc_id", "base", "added").collect()}
    text = dict((r[0], r[1]) for r in rows[0])[10]
    assert [(x.kind, text[x.s : x.e]) for x in got[10].base] == [("email", "a.b@c.example.org"), ("phone", "+1 (555) 123-4567"), ("ip", "10.0.0.1"), ("card", "4111 1111 1111 1111")]
    clean = {r.doc_id: r.text for r in pii.redact(docs, model).collect()}
    assert clean[10].startswith("mail <EMAIL> or <PHONE> from <IP> with <CARD>") and clean[0] is None and clean[1] == ""
    assert pii.find(empty, pii.fit(empty)).count() == 0


def test_archives(spark):
    pages = [(3, "u", "same"), (1, "u", "same"), (2, None, None), (5, "v", ""), (4, "w", "é" * 60_000 + "WARC/1.1\r\n\r\n"), (6, "w", "x"), (6, "w", "x"), (None, "w", "alone")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = sorted((tuple(r) for r in warc.round_trip(df).collect()), key=repr)
    want = []
    for i, _, html in pages:
        p = (html or "").encode()
        ids = [j for j, _, h in pages if (h or "") == (html or "") and j is not None]
        later = bool(ids) and i != min(ids)
        want.append((i, len(p), warc.digest(p), "revisit" if later else "response", min(ids) if later else None))
    assert got == sorted(want, key=repr)
    assert warc.round_trip(df.limit(0)).count() == 0


def test_near_duplicates(docs, empty):
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(docs).collect()}
    assert got[2] == got[3] == got[4] == 2 and got[0] == got[1] == 0
    assert len({got[i] for i in (5, 6, 7, 8, 9, 10, 11, 12, 13)}) == 9
    assert near_dedup.near_duplicates(empty).count() == 0


def test_sharding(docs, empty):
    got = sharding.shard(docs, 4).collect()
    assert len(got) == docs.count()
    for s in {r.shard for r in got}:
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))
    assert len({r.shard for r in got if r.doc_id in (2, 4)}) == 1
    assert sharding.shard(empty, 4).count() == 0


def test_token_counts(spark, docs, empty):
    labels = spark.createDataFrame([(5, 0, 1), (6, 0, 0), (None, 0, 1)], "doc_id long, quality int, toxic int")
    store = token_rollup.Store(spark, scratch_path(spark, "store"))
    got = token_rollup.maintained(docs, labels, tokenizer_path(), store).where("tokenizer = 'space'").groupBy().sum("documents").first()[0]
    assert got == docs.count() - 1
    again = token_rollup.count_tokens(docs, tokenizer_path()).withColumn("tokenizer", F.lit("again"))
    one = spark.createDataFrame([(1, "a b\nc\na b\n", "en", "s"), (2, "a b\nc\n", "en", "s"), (3, None, "en", "s")], "doc_id long, text string, lang string, source string")
    n = {r.doc_id: (r.tokens, r.line_tokens) for r in token_rollup.count_tokens(one, tokenizer_path()).collect()}
    assert n[1][1] == n[2][1] == n[2][0] < n[1][0] and n[3] == (0, 0)
    assert not store.insert("load", again)
    store = token_rollup.Store(spark, scratch_path(spark, "store"))
    assert token_rollup.maintained(empty, labels, tokenizer_path(), store).count() == 0


def test_repeated_passages(docs, empty, rows):
    got = {r.doc_id: r for r in suffix_dedup.repeated_passages(docs).collect()}
    assert set(got) == {2, 3, 4, 5, 6}
    assert [tuple(x) for x in got[6].spans] == [(50, 120)]
    assert suffix_dedup.repeated_passages(empty).count() == 0


def test_decontamination(spark, docs, empty, rows):
    items = spark.createDataFrame([(1, rows[1]), (2, None), (3, "too short")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.score for r in decontamination.contaminated(docs, items).collect()}
    assert set(got) == {(7, 1), (8, 1)} and got[7, 1] == 1.0 > got[8, 1]
    assert decontamination.contaminated(empty, items).count() == 0
    assert decontamination.contaminated(docs, items.limit(0)).count() == 0


def test_licences(docs, empty):
    got = {r.doc_id: r for r in license_scan.scan(docs).collect()}
    assert got[12].base_labels == "cc-by,gpl,reserved" and got[12].n_base == 3 and got[12].first_word == 62
    assert got[0].n_words == 0 and got[0].labels == "" and got[2].score == 0.0
    assert license_scan.scan(docs).count() == docs.count() and license_scan.scan(empty).count() == 0


def test_packing(docs, empty, rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    odd = ["a <|endoftext|> b<|startoftext|><|endoftext|>C.", "<|endoftext|", "Éa e\u0301 don't\u00a0x\t1,234 \u4e2d\u6587 I\u0307 \ufb01 \u200d x", "\u0301 \n\u0301a", "<|ENDOFTEXT|> \U0001f600!?"]
    given = [r for r in rows[0] if r[0] != 2] + [(100 + i, t) for i, t in enumerate(odd)]
    extra = docs.sparkSession.createDataFrame([(100 + i, t) for i, t in enumerate(odd)], "doc_id long, text string")
    got = packing.pack(docs.where("doc_id <> 2").select("doc_id", "text").unionByName(extra), tokenizer_path()).collect()
    for i, t, *_ in given:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        own = sorted((p for p in got if p.doc_id == i), key=lambda p: p.start)
        assert [p.start for p in own] == [sum(q.length for q in own[:k]) for k in range(len(own))]
        assert sum(p.length for p in own) == len(ids) == own[0].doc_tokens
        for p in own:
            raw = b"".join(x.to_bytes(4, "little") for x in ids[p.start : p.start + p.length])
            assert zlib.crc32(raw) == p.ids_crc32
    for s in {p.sequence_id for p in got}:
        at = 0
        for p in sorted((p for p in got if p.sequence_id == s), key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 2048
    assert packing.pack(empty, tokenizer_path()).count() == 0


def test_near_duplicates_of_a_large_group(spark):
    """Copies of a text that is not the smallest, some so changed that only another copy is near: every plain link is kept."""
    rng = random.Random(8)
    base = words(rng, 100).split()
    texts = []
    for i in range(120):
        w = list(texts[-1]) if i % 3 == 2 else list(base)
        for _ in range(1 + i % 4):
            w[rng.randrange(len(w))] = f"edit{i % 17}"
        texts.append(w)
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id long, text string")).collect()}
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in texts]
    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            assert len(x & y) < 0.8 * len(x | y) or got[i] == got[j]


def test_near_duplicates_of_few_shingles(spark):
    """Sets of up to three shingles that are equal but for weights, or close by their weights."""
    texts = ["word " * 100, "word " * 101, "a b c " * 40, "a b c " * 60, "x y " * 100, "x y " * 100 + "z", "other " * 100]
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got == {0: 0, 1: 0, 2: 2, 3: 2, 4: 4, 5: 4, 6: 6}


def test_near_duplicates_by_plain_sets(spark):
    """Plain Jaccard of 0.8 and more where one text repeats a line so often that its weights differ much."""
    rng = random.Random(11)
    texts = []
    for _ in range(5):
        base, line = words(rng, 204), words(rng, 10)
        texts += [base, base + " " + (line + " ") * 300]
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got == {i: i - i % 2 for i in range(10)}


def all_runs(texts):
    """Spans by all runs of 50 words."""
    held, split = {}, [t.split() for t in texts]
    for i, w in enumerate(split):
        for s in range(len(w) - 49):
            held.setdefault(tuple(w[s : s + 50]), set()).add(i)
    want = {}
    for i, w in enumerate(split):
        for s in range(len(w) - 49):
            if len(held[tuple(w[s : s + 50])]) > 1:
                own = want.setdefault(i, [])
                if own and own[-1][1] >= s:
                    own[-1][1] = s + 50
                else:
                    own.append([s, s + 50])
    return want


def test_repeated_passages_that_end_in_a_frequent_tail(spark):
    rng = random.Random(5)
    tail = words(rng, 45)
    texts = [words(rng, 80) + " " + tail + " " + words(rng, 80) for _ in range(60)]
    for _ in range(12):
        passage = words(rng, 10) + " " + tail
        texts += [words(rng, 60) + " " + passage + " " + words(rng, 60) for _ in range(2)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: [list(x) for x in r.spans] for r in suffix_dedup.repeated_passages(docs).collect()} == all_runs(texts)


def test_repeated_passages_twice_in_a_document(spark):
    rng = random.Random(6)
    block, often = words(rng, 300), words(rng, 300)
    texts = [" ".join([words(rng, 30), block, words(rng, 70), block]), words(rng, 40) + " " + block + " " + words(rng, 20), words(rng, 30) + (" " + often) * 10, words(rng, 25) + " " + often]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in suffix_dedup.repeated_passages(docs).collect()}
    assert {i: [list(x) for x in r.spans] for i, r in got.items()} == all_runs(texts)
    assert (got[0].repeated_words, got[2].repeated_words) == (600, 3000)


def test_pipeline_keeps_documents_without_id(spark, tmp_path):
    """Each is a document of its own: unique ones stay, copies of one with an id go, and of copies among them one stays."""
    import corpus_pipeline

    rng = random.Random(4)
    a, b, c, item = words(rng, 80), words(rng, 80), words(rng, 80), words(rng, 20)
    texts = [(None, a), (None, b), (1, b), (None, c), (None, c), (None, words(rng, 60) + " " + item), (2, words(rng, 70))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in texts], "doc_id long, text string, lang string, source string, n_chars long")
    left = corpus_pipeline.near_duplicates(spark, docs, "")
    assert sorted(map(str, ((r.doc_id, r.text) for r in left.collect()))) == sorted(map(str, [texts[i] for i in (0, 2, 3, 5, 6)]))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    left = corpus_pipeline.decontaminate(spark, docs, str(tmp_path))
    assert sorted(map(str, ((r.doc_id, r.text) for r in left.collect()))) == sorted(map(str, texts[:5] + texts[6:]))


def test_decontamination_of_edited_copies(spark):
    """Every copy that an alignment with the whole document accepts is found: words changed, left out and put in."""
    import numpy as np
    from strandwise.llm.words import hashed_words

    rng = random.Random(9)
    items = [words(rng, n) for n in (4, 5, 8, 16, 16, 20, 30)]
    texts = []
    for i in range(280):
        own = items[i % 7].split()
        kind, out = i % 4, []
        for j, w in enumerate(own):
            change = j % 4 == 3 if i < 28 else rng.random() < (0.15, 0.25, 0.3)[i % 3]
            out += [w] if not change else [["zz"], [], ["zz", w], ["yy", "zz", w]][kind]
        if i >= 252:
            out = [x for w in own for x in (w, "zz")]
        texts.append(words(rng, 30) + " " + " ".join(out) + " " + words(rng, 30))
    hashed = [hashed_words([t])[0] for t in texts]
    want = {}
    for j, item in enumerate(items):
        w = hashed_words([item])[0]
        for i, h in enumerate(hashed):
            score = decontamination.align(w, h, decontamination.PENALTY)[0] / len(w)
            if score >= decontamination.LEAST_SCORE:
                want[i, j] = score
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r.score for r in decontamination.contaminated(docs, spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).collect()}
    assert got == pytest.approx(want) and len(want) > 200


def test_only_texts_with_several_seeds_are_aligned(spark, monkeypatch):
    """Texts with one or two pairs of an item are not shuffled for it; copies are found, also of an item that repeats its pairs."""
    from strandwise.llm.words import hashed_words

    rng = random.Random(21)
    items = [words(rng, 30), " ".join("ab cd ef".split() * 7), " ".join("gh ij".split() * 3)]
    pairs = [(i, *items[0].split()[i : i + 2]) for i in range(29)]
    texts = [f"{words(rng, 40)} {a} {b} {words(rng, 40)}" for _, a, b in pairs]
    chance = len(texts)
    for item in items:
        own = item.split()
        texts += [words(rng, 20) + " " + " ".join(x) + " " + words(rng, 20) for x in (own, [w for i, w in enumerate(own) if i % 5], own[: len(own) * 2 // 3], [x for w in own for x in (w, "zz")])]
    want = {}
    for j, item in enumerate(items):
        w = hashed_words([item])[0]
        for i, text in enumerate(texts):
            score = decontamination.align(w, hashed_words([text])[0], decontamination.PENALTY)[0] / len(w)
            if score >= decontamination.LEAST_SCORE:
                want[i, j] = score
    sent, aligned = [], decontamination.aligned
    monkeypatch.setattr(decontamination, "aligned", lambda rows, *a: sent.append(rows.where("item is not null").count()) or aligned(rows, *a))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r.score for r in decontamination.contaminated(docs, spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).collect()}
    assert got == pytest.approx(want) and {i for i, _ in want} > set(range(chance, chance + 3))
    assert sent[0] < chance // 2 + 12


def test_a_licence_against_commerce_has_a_label_of_its_own(spark):
    texts = ["text licensed under cc by nc 4 0 here", "This work is licensed under a Creative Commons Attribution 4.0 International License."]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.base_labels, set(r.labels.split(","))) for r in license_scan.scan(rows).collect()}
    assert got == {0: ("cc-by", {"cc-by", "cc-by-nc"}), 1: ("", {"cc-by"})}
