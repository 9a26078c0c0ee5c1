"""Collocations, source divergence and embedding near duplicates against plain versions."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandwise.llm import collocations, divergence, lattice_dedup
from strandwise.llm.hashed_counts import Summary

DOCS = "doc_id long, text string, lang string, source string, n string, term string, key int"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    vocabulary = ["a", "Of", "the", "É", "éa", "x-y", " ", "z z", "B", "b", "no", "“q”", "0"]
    rows = [(0, None, "en", "s"), (1, "", None, None), (2, "a a a a a a a a", "", ""), (2, "a a a a a a a a", "", ""), (None, "only here", "xx", "s")]
    for i in range(60):
        words = [rng.choice(vocabulary[: 3 + i % 11]) for _ in range(rng.randrange(1, 60))]
        text = "".join(w + rng.choice([" ", "  ", "\t", ". ", "\n", "\r\n", "\x0b", " ", " ", " "]) for w in words)
        rows.append((10 + i, text, rng.choice(["en", "en", "de", None]), rng.choice(["s", "t", "u", None])))
    return [(*r, "clash", "clash", 1) for r in rows]


def plain_collocations(rows, threshold, longest, top):
    n, f = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f.update((lang, *words[i : i + k]) for i in range(len(words) - k + 1))
    found = {p: a for p, a in f.items() if a >= threshold}
    candidates = {p: a for p, a in found.items() if len(p) > 2}
    out = []
    for (lang, *w), a in candidates.items():
        longer = [q for q, b in candidates.items() if q[0] == lang and len(q) > len(w) + 1 and b >= a and any(list(q[i : i + len(w)]) == w for i in range(1, len(q) - len(w) + 1))]
        if not longer:
            cuts = [(1000 * a * n[lang] // (f[(lang, *w[:k])] * f[(lang, *w[k:])]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            out.append((lang, -score, -a, " ".join(w).encode(), f[(lang, *w[:k])], f[(lang, *w[k:])], n[lang]))
    ranked, seen = [], Counter()
    for lang, score, a, phrase, l, r, total in sorted(out):
        seen[lang] += 1
        if seen[lang] <= top:
            ranked.append((lang, seen[lang], phrase.decode(), -a, l, r, total, -score))
    return ranked


@pytest.mark.parametrize("threshold, top", [(3, 2000), (6, 7)])
def test_collocations_equal_plain_counts(spark, texts, threshold, top):
    # So few counters that summaries lose much, and have to be made larger.
    got = collocations.collocations(spark.createDataFrame(texts, DOCS).repartition(3), threshold, top=top, least_capacity=1)
    assert sorted(tuple(r) for r in got.collect()) == sorted(plain_collocations(texts, threshold, 5, top))


def test_summaries_keep_what_is_frequent():
    rng = np.random.default_rng(1)
    for capacity in (3, 10, 40):
        stream = rng.zipf(1.3, 4000) % 200
        true = Counter(stream.tolist())
        merged = Summary(capacity)
        for part in np.array_split(stream, 7):
            own = Summary(capacity)
            for x in part:
                own.put(np.array([x], np.uint64), np.array([1]))
            merged.merge(own)
        merged.settle()
        assert len(merged.hashes) <= capacity and merged.mass == 4000 and merged.lost <= 4000 / (capacity + 1)
        counters = dict(zip(merged.hashes.tolist(), merged.counts.tolist()))
        assert all(counters.get(x, 0) <= n <= counters.get(x, 0) + merged.lost for x, n in true.items())


def plain_audit(rows, least, top):
    held, count, groups = {}, {}, set()
    for i, (_, text, lang, source, *_) in enumerate(rows):
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        for t in re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(LOWER)):
            held.setdefault((lang, t), set()).add(i)
            count.setdefault((lang, source), Counter())[t] += 1
    out = []
    for lang in {g[0] for g in groups}:
        terms = [t for (x, t), d in held.items() if x == lang and len(d) >= least]
        own = {s: count.get((x, s), Counter()) for x, s in groups if x == lang}
        share = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (sum(c[u] for u in terms) + 5 * len(terms)) for t in terms}
        p, q = {s: share(c) for s, c in own.items()}, share(sum(own.values(), Counter()))
        for s in own:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in terms), o.encode()) for o in own if o != s]
            better = [(q[t] - p[s][t], t.encode()) for t in terms if own[s][t] and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(better)[:top])):
                out += [(lang, s, part, item.decode(), -v, i + 1) for i, (v, item) in enumerate(found)]
    return sorted(out)


@pytest.mark.parametrize("least, top, terms, sources", [(3, 50, 1024, 32), (2, 2, 3, 2), (90, 50, 1024, 32)])
def test_divergence_equals_plain_sums(spark, texts, monkeypatch, least, top, terms, sources):
    monkeypatch.setattr(divergence, "TERMS", terms)
    got = divergence.audit(spark.createDataFrame(texts, DOCS).repartition(3), least, top, least_capacity=1)
    assert sorted(tuple(r) for r in got.collect()) == plain_audit(texts, least, top)


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    assert collocations.collocations(none).count() == divergence.audit(none).count() == 0
    assert lattice_dedup.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    silent = spark.createDataFrame([(1, None, None, None, "", "", 0), (2, "", "en", "s", "", "", 0)], DOCS)
    assert collocations.collocations(silent).count() == divergence.audit(silent).count() == 0


def vectors_of(rng, cosines, d=64):
    """Pairs of vectors of the given cosines."""
    out = []
    for c in cosines:
        u, w = (x / np.linalg.norm(x) for x in rng.standard_normal((2, d)))
        w -= (w @ u) * u
        out += [u, c * u + np.sqrt(1 - c * c) * w / np.linalg.norm(w)]
    return out


def plain_links(vectors, threshold):
    u = np.array([v / np.abs(v).max() / np.linalg.norm(v / np.abs(v).max()) for v in vectors])
    hits = u @ u.T >= threshold
    np.fill_diagonal(hits, False)
    return hits


def test_lattice_points_are_nearest():
    rng = np.random.default_rng(2)
    y = rng.standard_normal((300, 8)) * 2
    p = lattice_dedup.nearest_point(y)
    assert len(lattice_dedup.NEIGHBOURS) == 240 and set((lattice_dedup.NEIGHBOURS**2).sum(axis=1)) == {2.0}
    around = p[:, None, :] + lattice_dedup.NEIGHBOURS
    assert (((y - p) ** 2).sum(axis=1)[:, None] <= ((y[:, None, :] - around) ** 2).sum(axis=2) + 1e-12).all()
    whole = np.isclose(p, np.rint(p)).all(axis=1) | np.isclose(p + 0.5, np.rint(p + 0.5)).all(axis=1)
    assert whole.all() and np.allclose(p.sum(axis=1) % 2, 0)


def test_near_vectors_equal_all_pairs(spark):
    rng = np.random.default_rng(3)
    group = rng.standard_normal(64)
    vectors = [group + 0.1 * rng.standard_normal(64) for _ in range(70)] + vectors_of(rng, [0.97, 0.99, 0.9, 0.94, 0.999] * 8)
    vectors += [vectors[0]] * 5 + [3.5 * vectors[1], 1e200 * vectors[2]]
    hits = plain_links(vectors, 0.95)
    rows = [(i, v.tolist(), 7, "x") for i, v in enumerate(vectors)]
    odd = [(900, None, 1, ""), (901, [], 1, ""), (902, [0.0] * 64, 1, ""), (903, [float("nan")] + [1.0] * 63, 1, ""), (904, [None] + [1.0] * 63, 1, ""), (905, [1.0, 2.0], 1, ""), (906, [2.0, 4.0], 1, ""), (907, [float("inf"), 1.0], 1, "")]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, key int, node string").repartition(3)
    for block in (1024, 8):
        got = {r.vec_id: r for r in lattice_dedup.near_vectors(df, tables=10, block=block).collect()}
        assert [got[i].n_links for i in range(len(vectors))] == hits.sum(axis=1).tolist()
        for i in range(len(vectors)):
            linked = {i}
            while more := {int(j) for k in linked for j in np.flatnonzero(hits[k])} - linked:
                linked |= more
            assert got[i].component_id == min(linked) and got[i].kept == (i == min(linked))
        assert all((got[i].n_links, got[i].component_id) == (0, i) for i in (900, 901, 902, 903, 904, 907))
        assert (got[905].n_links, got[906].component_id) == (1, 905)


def test_vectors_without_or_with_equal_ids(spark):
    rows = [(None, [1.0, 0.0, 2.0]), (None, [2.0, 0.0, 4.0]), (4, [0.0, 1.0, 0.0]), (4, [0.0, 1.0, 0.0]), (None, [0.0, 3.0, 0.0]), (8, [1.0, -1.0, 0.0])]
    got = sorted((tuple(r) for r in lattice_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()), key=str)
    assert got == sorted([(None, 1, None, True), (None, 1, None, True), (4, 2, 4, True), (4, 2, 4, True), (None, 2, 4, False), (8, 0, 8, True)], key=str)


def test_recall_near_the_threshold(spark):
    rng = np.random.default_rng(4)
    vectors = vectors_of(rng, [0.951] * 300 + [0.97] * 200)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    got = lattice_dedup.near_vectors(df).agg(F.sum("n_links")).first()[0]
    want = int(plain_links(vectors, 0.95).sum())
    assert 0.97 * want <= got <= want
