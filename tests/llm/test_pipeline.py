"""The pipeline's stages one after the other, each against a plain version on what its predecessor kept."""

import random
import re
import zlib

import pytest

from strandwise.llm import decontamination, near_dedup, pii, quality
from strandwise.llm.common import materialize
from strandwise.llm.queries import tokenizer_path
from strandwise.llm.words import hashed_words

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n):
    """Invented words, every eighth a function word."""
    return " ".join("the" if k % 8 == 3 else "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(3, 8))) for k in range(n))


def plain_quality(text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text or "") if x]
    grams = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
    marked = {k + j for k, g in enumerate(grams) if grams.count(g) > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    chars, symbols = sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or ""))
    stops = sum(x.lower() in quality.STOP_WORDS for x in w)
    if len(w) < 50 or 100 * len(marked) > 50 * len(w):
        return False
    return 2 * len(w) <= chars <= 20 * len(w) and 5 * symbols <= len(w) and 100 * (len(lines) - len(set(lines))) <= 60 * len(lines) and len(w) <= 50 * stops


def plain_classes(texts):
    """Connected texts of a similarity of 0.8 or more by either measure."""
    n, top = len(texts), list(range(len(texts)))
    pairs = [(i, j) for i in range(n) for j in range(i)]
    a, b = (near_dedup.weighted_shingles([texts[p[k]] for p in pairs], 5) for k in (0, 1))
    weighted, plain = near_dedup.similarities(*a, *b, len(pairs))
    for (i, j), x, y in zip(pairs, weighted, plain, strict=True):
        if max(x, y) >= 0.8:
            low, high = sorted((top[i], top[j]))
            top = [low if t == high else t for t in top]
    return top


def corpus():
    rng = random.Random(21)
    item = words(rng, 24)
    texts = [words(rng, rng.randrange(55, 120)) for _ in range(30)]
    texts += [texts[i] for i in range(5)]
    for i in range(5, 12):
        w = texts[i].split()
        w[len(w) // 2] = "edited"
        texts.append(" ".join(w))
    texts += [words(rng, 40) + " " + item + " " + words(rng, 40), words(rng, 40) + " " + item.replace(" ", " zz ", 3) + " " + words(rng, 40)]
    texts += [words(rng, 60) + f" mail a{i}@b.example.org and 10.0.0.{i} " + words(rng, 20) for i in range(6)]
    texts += [None, "", "too short", "same words again " * 40, "# * $ % " * 30 + words(rng, 40)]
    texts += [words(rng, 80).replace(" the ", " "), words(rng, 120).replace(" the ", " ", 12)]
    return [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], item


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rows, item = corpus()
    path = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), rows, item


def test_stages_equal_plain_versions(spark, folder):
    import corpus_pipeline as pipeline

    sf_dir, rows, item = folder
    stage, docs = dict(pipeline.STAGES), spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [n for n, _ in pipeline.STAGES] == ["quality rules", "near duplicates", "decontamination", "personal data", "packing"]

    def kept(name):
        nonlocal docs
        docs = materialize(stage[name](spark, docs, sf_dir), "stage")
        return {r.doc_id: r.text for r in docs.collect()}

    left = kept("quality rules")
    assert left == {i: t for i, t, *_ in rows if plain_quality(t)}
    ids = sorted(left)
    top = plain_classes([left[i] for i in ids])
    want = {i: left[i] for k, i in enumerate(ids) if top[k] == k}
    left = kept("near duplicates")
    assert left == want and len(want) < len(ids)
    own = hashed_words([item])[0]
    score = {i: decontamination.align(own, hashed_words([t])[0], decontamination.PENALTY)[0] / len(own) for i, t in left.items()}
    want = {i: t for i, t in left.items() if score[i] < decontamination.LEAST_SCORE}
    left = kept("decontamination")
    assert left == want and len(want) < len(score)
    want = {i: re.sub(r"10\.0\.0\.[0-9]+", "<IP>", re.sub(r"a[0-9]@b\.example\.org", "<EMAIL>", t)) for i, t in left.items()}
    assert kept("personal data") == want and any("<IP>" in t for t in want.values())
    assert {r.doc_id: r.n_chars for r in docs.collect()} == {i: len(t) for i, t in want.items()}
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    pieces = stage["packing"](spark, docs, sf_dir).collect()
    for i, t in want.items():
        ids = tokenizer.encode(t, add_special_tokens=False).ids + [1]
        got = sorted((p.start, p.length, p.ids_crc32) for p in pieces if p.doc_id == i)
        assert got == [(s, n, zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids[s : s + n]))) for s, n, _ in got] and sum(n for _, n, _ in got) == len(ids)
    whole = pipeline.run(spark, sf_dir).collect()
    assert sorted((p.doc_id, p.start, p.length, p.ids_crc32) for p in whole) == sorted((p.doc_id, p.start, p.length, p.ids_crc32) for p in pieces)


def test_empty_tables_and_extra_columns(spark, tmp_path):
    import corpus_pipeline as pipeline

    rows, item = corpus()
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert pipeline.run(spark, str(tmp_path)).count() == 0
    wide = spark.createDataFrame([(*r, "x", 1, "y") for r in rows[:6]], SCHEMA + ", base string, kept int, class_id string")
    for _, stage in pipeline.STAGES[:-1]:
        out = stage(spark, wide, str(tmp_path))
        assert out.columns == pipeline.COLUMNS and out.count() == 6


def test_model_without_candidates(spark):
    docs = spark.createDataFrame([(1, "plain words only"), (2, None)], "doc_id long, text string")
    assert pii.fit(docs).trees == [] and [r.text for r in pii.redact(docs, pii.fit(docs)).collect()] == ["plain words only", None]
