"""The training-data operators against plain versions, on broken input and on long texts."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strandwise.llm import decontamination, license_scan, near_dedup, pii, sharding, suffix_dedup, token_rollup, warc
from strandwise.llm.common import scratch_path
from strandwise.llm.queries import tokenizer_path

TEXTS = "doc_id long, text string"


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(3, 8))) for _ in range(n))


# Personal data


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


PLAIN = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(d := re.sub("[^0-9]", "", m)) <= 19 and luhn(d)),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15),
)


def plain_spans(text):
    found = [(m.start(), rank, m.end(), kind) for rank, (kind, p, good) in enumerate(PLAIN) for m in re.finditer(p, text or "") if good(m[0])]
    return sorted(found)


def test_base_spans_equal_plain_patterns(spark):
    rng = random.Random(1)
    pieces = ["a.b@c-d.example.org", "@", ".", "x@y", "+1 (555) 123-4567", "+", "4111 1111 1111 1111", "4111-1111-1111-1112", "10.0.0.1", "300.1.1.1", "1.2.3.4.5.6.7.8", "00255.1.1.001", " ", "-", "(", ")", "7", "12345", "é", "中", "😀", "\n", "word", "_%"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(60))) for _ in range(1500)]
    texts += [None, "", "1" * 5000, "1 " * 5000, "a@" * 3000, "+1" * 3000, "a@b.c" * 500, "1.1." * 2000]
    docs = spark.createDataFrame(list(enumerate(texts)), TEXTS).repartition(8)
    for r in pii.find(docs, pii.Model()).collect():
        assert [tuple(x) for x in r.base] == plain_spans(r.text), r.text


def test_planted_spans_are_learned_and_overlaps_decided(spark):
    """Labels come from words before a span; spans without such a word are found by format, clean look-alikes stay."""
    rng = random.Random(2)
    rows, truth = [], {}
    for i in range(1200):
        parts = [words(rng, 5)]
        for _ in range(4):
            kind = rng.randrange(3)
            if kind == 0:
                parts.append(rng.choice(['token = "', "key: ", "key: ", "ref "]) + "%040x" % rng.getrandbits(160))
                truth.setdefault(i, []).append(parts[-1].split()[-1].strip('"'))
            elif kind == 1:
                parts.append("item" + "ab" * 10 + str(rng.randrange(10)))
            else:
                parts.append("%d.%d.%d.999" % tuple(rng.randrange(300) for _ in range(3)))
            parts.append(words(rng, 6))
        rows.append((i, " ".join(parts)))
    docs = spark.createDataFrame(rows, TEXTS)
    model = pii.fit(docs, precision=0.6)
    assert model.report["secret"][1] > 0.9
    got = {r.doc_id: {r.text[x.s : x.e] for x in r.added} for r in pii.find(docs, model).collect()}
    hit = sum(x in got[i] for i, own in truth.items() for x in own)
    assert hit == sum(map(len, got.values())) and hit > 0.75 * sum(map(len, truth.values()))
    overlapping = pii.Model(constant=1.0, thresholds=dict.fromkeys(pii.MORE, 0.5) | {"card": 0.5})
    spans = pii.find(spark.createDataFrame([(1, "call (555) 123-4567 or 123-45-6789 id 123-45-6789-12 mail a [at] b.c")], TEXTS), overlapping).first().added
    assert all(x.e <= y.s for x, y in zip(spans, spans[1:])) and len(spans) == 4


def test_columns_of_any_name_pass_through_redaction(spark):
    df = spark.createDataFrame([("a@b.org x", "t", "c", "b", 1)], "text string, _t string, _c string, base string, row int")
    out = pii.redact(df, pii.Model())
    assert tuple(out.first()) == ("<EMAIL> x", "t", "c", "b", 1) and out.columns == df.columns


def clocked(make, sizes):
    """Seconds for each size, the first call not counted."""
    make(sizes[0])
    times = []
    for n in sizes:
        began = time.time()
        make(n)
        times.append(time.time() - began)
    return times


def test_work_of_one_text_grows_with_it(spark):
    def spans(n):
        text = " ".join(("a%d@b.example.org", 'token = "a%039x"', "10.0.0.%d", "+1 (555) %07d")[i % 4] % (i % 200) for i in range(n))
        df = spark.createDataFrame([(1, text)], TEXTS)
        assert pii.redact(df, pii.Model(constant=1.0, thresholds={"secret": 0.5})).first().text.count("<") == n

    def licences(n):
        df = spark.createDataFrame([(1, "some word all rights reserved " * (n // 5))], TEXTS)
        assert license_scan.scan(df).first().n_base == n // 5

    for make, sizes in ((spans, (10_000, 40_000)), (licences, (250_000, 1_000_000))):
        small, large = clocked(make, sizes)
        assert large < 6 * small + 3


# Licences


def test_licence_facts_equal_plain_search(spark):
    rng = random.Random(3)
    pieces = ["CC", "by", "cc by", "General Public", "license", "general public license", "ALL rights", "reserved", "all rights reserved", "x", "é", "mit license", "CC BY-NC"]
    texts = [rng.choice([" ", "-", "\n", ". "]).join(rng.choice(pieces) for _ in range(rng.randrange(40))) for _ in range(600)] + [None, "", "cc", "by cc by"]
    docs = spark.createDataFrame(list(enumerate(texts)), TEXTS)
    got = {r.doc_id: r for r in license_scan.scan(docs).collect()}
    for i, t in enumerate(texts):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        places = [(p, label) for phrase, label in license_scan.PHRASES.items() for p in range(len(w)) if w[p : p + len(phrase.split())] == phrase.split()]
        starts, labels = [p for p, _ in places], sorted({x for _, x in places})
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(labels))
        assert set(labels) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1


def test_whole_licences_with_edits(spark):
    rng = random.Random(4)
    rows = []
    for i, (label, text) in enumerate(license_scan.TEMPLATES):
        w = text.split()
        for _ in range(len(w) // 25):
            w[rng.randrange(len(w))] = "edited"
        if len(w) > 60:
            w.insert(30, "inserted")
        rows.append((i, label, words(rng, 200) + " " + " ".join(w) + " " + words(rng, 50)))
    got = license_scan.scan(spark.createDataFrame(rows, "doc_id long, label string, text string")).collect()
    for r in got:
        assert rows[r.doc_id][1] in r.labels.split(",") and r.score >= license_scan.MIN_COVER
        assert any(x.first >= 195 for x in r.spans)


# WARC


def stored(path, members):
    path.mkdir()
    (path / "a.warc.gz").write_bytes(b"".join(members))
    return str(path)


def whole(made):
    return made + b"\x00"


PAGE = "é" * 40_000


def segments(copy="0-1", page=1):
    return [whole(x) for x in warc.response_records(page, "u", PAGE.encode(), copy, 32 << 10, 8 << 10)]


def test_members_of_an_archive_are_all_read(spark, tmp_path):
    members = [whole(x) for i in range(5) for x in warc.response_records(i, "u", b"p%d" % i, "0-1", 1000, 100)]
    assert sorted(r.page_id for r in warc.read_archives(spark, stored(tmp_path / "a", members)).collect()) == list(range(5))
    one = zlib.compressobj(9, zlib.DEFLATED, 31)
    joined = one.compress(b"".join(zlib.decompress(x, 31) for x in members)) + one.flush()
    assert warc.read_archives(spark, stored(tmp_path / "b", [joined])).count() == 5
    got = warc.read_archives(spark, stored(tmp_path / "c", reversed(segments()))).collect()
    assert [(r.page_id, r.payload_bytes, r.payload_digest) for r in got] == [(1, 80_000, warc.digest(PAGE.encode()))]


@pytest.mark.parametrize("broken", ["missing", "repeated", "last missing", "cut", "cut between", "total", "frame", "digest", "no response"])
def test_broken_archives_raise(spark, tmp_path, broken):
    made = segments()
    key = warc.hashlib.sha1(b"x").digest()
    change = lambda x, a, b: zlib.compress(zlib.decompress(x, 31).replace(a, b), 9, 31)
    members = {
        "missing": made[:1] + made[2:],
        "repeated": made + made[1:2],
        "last missing": made[:-1],
        "cut": [b"".join(made)[:-9]],
        "cut between": [zlib.decompress(made[0], 31) and made[0], made[1][:10]],
        "total": made[:-1] + [change(made[-1], b"Total-Length: 8", b"Total-Length: 9")],
        "frame": [change(whole(next(iter(warc.response_records(1, "u", b"abcdef", "c", 1000, 100)))), b"6\r\nabc", b"5\r\nabc")],
        "digest": [change(whole(next(iter(warc.response_records(1, "u", b"abcdef", "c", 1000, 100)))), b"abcdef", b"abcdeg")],
        "no response": [whole(warc.revisit_record(2, "u", key, 1))],
    }[broken]
    with pytest.raises(Exception, match="segments are missing|ends within|chunk|payload|invalid literal"):
        warc.read_archives(spark, stored(tmp_path / "x", members)).collect()


def foreign(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}:{v}\r\n" for k, v in [*fields, ("content-LENGTH", len(block))])
    return zlib.compress(b"WARC/1.0\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n", 6, 31)


def test_archives_of_other_writers(spark, tmp_path):
    """Plain and chunked bodies, trailers, several digests and none, fields in any case, records of other types, foreign ids and revisits."""
    plain, framed = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n", b"HTTP/1.1 200 OK\r\ntransfer-encoding: gzip, Chunked\r\n\r\n"
    body, chunks = b"<p>\xff one</p>", b"4;x=1\r\n<p>\xff\r\n9\r\n one</p>\xe9\r\n"
    whole_body = b"<p>\xff one</p>\xe9"
    response = lambda i, **more: [("WARC-TYPE", "response"), ("warc-record-id", f"<urn:uuid:{i}>"), ("Warc-Target-Uri", f"http://x/{i}"), ("Content-Type", "application/http; msgtype=response"), *[(k.replace("_", "-"), v) for k, v in more.items()]]
    members = [
        foreign([("WARC-Type", "request"), ("WARC-Record-ID", "<urn:uuid:r>")], b"GET / HTTP/1.1\r\n\r\n"),
        foreign(response(1), plain + body),
        foreign(response(2, warc_payload_digest="sha1:" + warc.digest(whole_body).lower()), framed + chunks + b"0\r\nExpires: never\r\nX: y\r\n\r\n"),
        foreign(response(3, WARC_Payload_Digest="sha-256:" + hashlib.sha256(b"").hexdigest()), plain),
        foreign(response(4, WARC_Payload_Digest="sha1:" + warc.digest(chunks + b"0\r\n\r\n")), framed + chunks + b"0\r\n\r\n"),
        foreign(response(5, WARC_Payload_Digest="blake3:zz"), plain + b"5"),
        foreign([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:uuid:6>"), ("Content-Type", "text/dns")], b"20240101\r\nx. A 1.1.1.1"),
        foreign([("WARC-Type", "metadata"), ("WARC-Record-ID", "<urn:uuid:m>")], b"a: b"),
        foreign([("warc-type", "revisit"), ("warc-record-id", "<urn:uuid:7>"), ("WARC-Refers-To", "<urn:uuid:1>")], plain),
        foreign([("warc-type", "revisit"), ("warc-record-id", "<urn:uuid:8>"), ("WARC-Payload-Digest", "sha1:" + warc.digest(whole_body)), ("WARC-Target-URI", "http://x/8")], b""),
    ]
    got = {r.record_id[10:-1]: r for r in warc.read_archives(spark, stored(tmp_path / "a", members)).collect()}
    sizes = {"1": body, "2": whole_body, "3": b"", "4": whole_body, "5": b"5", "6": b"20240101\r\nx. A 1.1.1.1", "7": body, "8": whole_body}
    assert {i: (r.payload_bytes, r.payload_digest) for i, r in got.items()} == {i: (len(b), warc.digest(b)) for i, b in sizes.items()}
    assert all(r.page_id is None and r.refers_to is None for r in got.values())
    assert [got[i].record_type for i in "1278"] == ["response", "response", "revisit", "revisit"] and got["8"].target_uri == "http://x/8"


@pytest.mark.parametrize("broken", ["sha1", "md5", "trailer", "head", "revisit"])
def test_broken_foreign_archives_raise(spark, tmp_path, broken):
    fields = [("WARC-Type", "response"), ("WARC-Record-ID", "<urn:uuid:1>")]
    plain, framed = b"HTTP/1.1 200 OK\r\n\r\n", b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n"
    members = {
        "sha1": foreign([*fields, ("WARC-Payload-Digest", "sha1:" + warc.digest(b"a"))], plain + b"b"),
        "md5": foreign([*fields, ("WARC-Payload-Digest", "md5:" + hashlib.md5(b"a").hexdigest())], plain + b"b"),
        "trailer": foreign(fields, framed + b"1\r\na\r\n0\r\nX: y\r\n\r\nmore"),
        "head": foreign(fields, b"HTTP/1.1 200 OK\r\nX: y"),
        "revisit": foreign([("WARC-Type", "revisit"), ("WARC-Record-ID", "<urn:uuid:2>"), ("WARC-Refers-To", "<urn:uuid:9>")], b""),
    }[broken]
    path = stored(tmp_path / "x", [members])
    with pytest.raises(Exception, match="payload|chunked body|without its end"):
        warc.read_archives(spark, path).collect()
    if broken == "revisit":
        assert [r.payload_bytes for r in warc.read_archives(spark, path, resolve=False).collect()] == [None]


def test_an_archive_over_the_bound_raises(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "MOST_ARCHIVE_BYTES", 100)
    with pytest.raises(ValueError, match="100 are the most"):
        warc.read_archives(spark, stored(tmp_path / "a", segments()))


def test_records_of_written_archives(spark, tmp_path):
    """Each file begins with a warcinfo record, ids are named once but for repeated rows, and what is referred to is there."""
    pages = spark.createDataFrame([(i, f"http://x/{i}", f"page {i % 7}" * (1 + 9000 * (i % 7 == 3))) for i in range(60)], "page_id long, url string, html string")
    warc.write_archives(pages, str(tmp_path / "w"), records_per_file=10)
    ids, refers = Counter(), set()
    for f in (tmp_path / "w").glob("part-*"):
        if data := f.read_bytes():
            records = list(warc.parse(data))
            assert records[0][0]["warc-type"] == "warcinfo" and len(records) <= 10
            ids.update(h["warc-record-id"] for h, _ in records)
            refers |= {h["warc-refers-to"] for h, _ in records if "warc-refers-to" in h}
    assert max(ids.values()) == 1 and len(refers) == 7 and refers <= set(ids)


# Near duplicates


def test_near_duplicate_recall_by_both_similarities(spark):
    """Edited copies in families: all pairs that either similarity links are in one class, and other pairs are not linked."""
    import numpy as np

    rng = random.Random(7)
    texts = []
    for _ in range(25):
        base = words(rng, rng.randrange(20, 150)).split()
        for _ in range(6):
            w = list(base) * rng.choice([1, 1, 1, 2])
            for _ in range(rng.randrange(6)):
                w[rng.randrange(len(w))] = f"e{rng.randrange(40)}"
            texts.append(" ".join(w))
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(spark.createDataFrame(list(enumerate(texts)), TEXTS)).collect()}
    pairs = [(i, j) for i in range(len(texts)) for j in range(i)]
    both = [near_dedup.weighted_shingles([texts[p[k]] for p in pairs], 5) for k in (0, 1)]
    near = np.maximum(*near_dedup.similarities(*both[0], *both[1], len(pairs))) >= 0.8
    links = [p for p, x in zip(pairs, near, strict=True) if x]
    assert len(links) > 60 and all(got[i] == got[j] for i, j in links)
    parent = list(range(len(texts)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in links:
        parent[max(top(i), top(j))] = min(top(i), top(j))
    assert [top(i) for i in range(len(texts))] == [got[i] for i in range(len(texts))]


# Sharding


def test_capacity_is_the_smallest(spark):
    rng = random.Random(9)
    for shards in (1, 3, 7):
        texts = ["x" * rng.randrange(300) for _ in range(90)] + ["y" * 2000] * 3
        got = sharding.shard(spark.createDataFrame(list(enumerate(texts)), TEXTS), shards).collect()
        order, sizes = {}, {}
        for r in got:
            order[r.key] = r.shard
            sizes[r.key] = sizes.get(r.key, 0) + r.size
        groups = [sizes[k] for k in sorted(sizes)]
        assert [order[k] for k in sorted(order)] == sorted(order.values())
        best = {(0, 0): 0}
        upto = [0]
        for g in groups:
            upto.append(upto[-1] + g)
        least = [upto[i] for i in range(len(upto))]
        for _ in range(1, shards):
            least = [min(max(least[j], upto[i] - upto[j]) for j in range(i + 1)) for i in range(len(upto))]
        held = Counter()
        for r in got:
            held[r.shard] += r.size
        assert max(held.values()) == least[-1] and best


# Token counts


def test_totals_equal_a_plain_count(spark):
    from tokenizers import Tokenizer

    rng = random.Random(10)
    texts = [rng.choice(["a b\nc\na b", "don't <|endoftext|> stop", "", None, words(rng, 30), "1,234 É é"]) for _ in range(60)]
    rows = [(i, t, rng.choice(["en", None]), rng.choice(["s", "t"])) for i, t in enumerate(texts)]
    rows.append(rows[5])
    labels = [(i, rng.choice([0, 1]), rng.choice([0, 0, 1])) for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    store = token_rollup.Store(spark, scratch_path(spark, "store"))
    got = {(r.source, r.lang, r.tokenizer): (r.documents, r.tokens) for r in token_rollup.maintained(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), tokenizer_path(), store).collect()}
    tokenizer = Tokenizer.from_file(tokenizer_path())
    toxic, low = {i for i, _, t in labels if t}, {i for i, q, t in labels if not q and not t}
    want = Counter(), Counter()
    for i, t, lang, source in rows:
        if i in toxic:
            continue
        lines = "\n".join(dict.fromkeys((t or "").split("\n"))) if i in low else t or ""
        for name, n in (("word_bpe_49k", len(tokenizer.encode(lines, add_special_tokens=False).ids)), ("space", len((t or "").split()))):
            want[0][source, lang, name] += 1
            want[1][source, lang, name] += n
    assert got == {k: (n, want[1][k]) for k, n in want[0].items()}
    assert store.batches() == ["lines", "load", "toxic"]


def test_a_batch_that_broke_off_is_no_batch(spark):
    store = token_rollup.Store(spark, scratch_path(spark, "store"))
    row = spark.createDataFrame([(1, "s", "en", "t", 5)], "doc_id long, source string, lang string, tokenizer string, tokens long")
    row.withColumn("sign", F.lit(1)).write.parquet(store._place("ledger", "half"))
    assert store.batches() == [] and store.totals().count() == 0
    assert store.delete("gone", row) and store.totals().count() == 0
    assert store.insert("half", row) and store.totals().first().tokens == 5


# Repeated passages


def test_many_copies_in_one_document(spark):
    rng = random.Random(12)
    passage = words(rng, 60)
    texts = [" ".join(x for _ in range(12) for x in (passage, words(rng, 30))), words(rng, 40) + " " + passage, words(rng, 500), passage, passage, None, ""]
    got = {r.doc_id: r for r in suffix_dedup.repeated_passages(spark.createDataFrame(list(enumerate(texts)), TEXTS)).collect()}
    assert (len(got[0].spans), got[0].repeated_words) == (12, 720)
    assert set(got) == {0, 1, 3, 4} and [tuple(x) for x in got[1].spans] == [(40, 100)]


# Decontamination


def test_short_items_match_whole(spark):
    rng = random.Random(13)
    items = spark.createDataFrame([(1, "zeta"), (2, "Zeta, omega"), (3, "zeta omega psi"), (4, "")], "item_id long, text string")
    texts = [words(rng, 20) + " zeta! Omega " + words(rng, 5), "zeta omega (psi)", "omega zeta", words(rng, 50)]
    got = {(r.doc_id, r.item_id): (r.score, r.end_word) for r in decontamination.contaminated(spark.createDataFrame(list(enumerate(texts)), TEXTS), items).collect()}
    assert got == {(0, 1): (1, 21), (0, 2): (1, 22), (1, 1): (1, 1), (1, 2): (1, 2), (1, 3): (1, 3), (2, 1): (1, 2)}


def test_pii_fit_counts_every_document(spark):
    """The report has all held out candidates of 44,000 documents, every copy of them too."""
    n = 44_000
    docs = spark.range(n).selectExpr("id as doc_id", "concat(if(id % 20 = 0, 'see ', 'ssn '), lpad(id % 900 + 100, 3, '0'), '-45-', lpad(id div 2 % 9000 + 1000, 4, '0')) as text")
    model = pii.fit(docs)
    held = docs.where("pmod(xxhash64(text), 2) = 1").count()
    assert held > 20_000 and model.report["id_number"][2] == held
