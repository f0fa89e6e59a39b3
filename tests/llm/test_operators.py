"""Each operator against a plain version, and on nulls, empty and long texts, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyloom.llm import imatch, jpeg, licenses, linedup, minhash, mixing, packing, queries, suffixdup, toxicity, warc

WORDS = "alba nera torre lume vento sasso prato fiume monte cielo notte giorno strada ponte mare isola bosco neve fuoco terra".split()
CLASH = ["key", "cid", "site", "__site", "__dropped", "__post", "__copy", "bucket", "g", "row", "piece", "n", "id", "part"]


def prose(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join(f"{WORDS[i]}{j}" for i, j in zip(rng.integers(0, len(WORDS), n), rng.integers(0, 40, n), strict=True))


@pytest.fixture(scope="module")
def rows():
    long = prose(1, 4000)
    near = prose(2, 300)
    out = [(0, long), (1, near), (2, near.replace("torre", "porta", 1)), (3, near + " coda"), (4, None), (5, ""), (6, "   \n\t "), (7, "solo"), (8, "solo"), (9, "due parole"), (9, "due parole"), (None, "senza numero " + prose(3, 50))]
    out += [(20 + i, prose(100 + i, 30 + 7 * i) + "\nmenu home contatti\n" + prose(200 + i, 20)) for i in range(20)]
    out += [(60, prose(5, 40) + " " + long[500:2500] + " " + prose(6, 40)), (61, "x" * 900), (62, "é" * 300 + "abc" * 100), (63, near)]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    clash = [c for c in CLASH]
    full = [(i, t, ["en", "fr"][k % 2], "src0" if k % 3 else None, len(t or ""), *["clash"] * len(clash)) for k, (i, t) in enumerate(rows)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in clash)
    return spark.createDataFrame(full, schema).repartition(3)


@pytest.fixture(scope="module")
def labels(spark, rows):
    return spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i, _ in rows if i is not None], "doc_id long, quality int, toxic int").distinct()


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


SPLIT = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = SPLIT.findall((text or "").translate(LOWER))
    return frozenset(zip(*[w[i:] for i in range(5)], strict=False)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def near_plainly(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 85 * len(x | y):
                root[find(a)] = find(b)
    groups = collections.defaultdict(list)
    for k in range(len(rows)):
        groups[find(k)].append(rows[k][0])
    least = {g: min((i for i in ids if i is not None), default=None) for g, ids in groups.items()}
    return sorted((repr(rows[k][0]), len(sets[k][1]), repr(least[find(k)])) for k in range(len(rows)))


def test_near_duplicates(spark, docs, rows):
    got = minhash.near_duplicates(docs).collect()
    assert sorted((repr(r.doc_id), r.n_shingles, repr(r.component_id)) for r in got) == near_plainly(rows)
    assert all(r.kept == (r.doc_id is not None and r.doc_id == r.component_id) for r in got)


def test_near_duplicates_in_large_buckets(spark):
    base = prose(9, 160).split()
    rng = np.random.default_rng(0)
    rows = []
    for i in range(150):
        w = list(base)
        for k in rng.integers(0, len(w), rng.integers(0, 9)):
            w[k] = f"altro{rng.integers(0, 999)}"
        rows.append((i, " ".join(w)))
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), minhash.MinHash(group_cap=20))
    assert sorted((repr(r.doc_id), r.n_shingles, repr(r.component_id)) for r in got.collect()) == near_plainly(rows)


def test_every_pair_within_the_distance_shares_a_key():
    p = minhash.MinHash(hashes=12, max_errors=3, chunk_errors=1)
    keys, rng = p.keys(), np.random.default_rng(1)
    for _ in range(500):
        wrong = set(rng.choice(12, 3, replace=False).tolist())
        assert any(not wrong & set(k) for k in keys)


def removed_plainly(texts, n=200):
    count = collections.Counter(b[p : p + n] for b in texts for p in range(len(b) - n + 1))
    for b in texts:
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - n + 1):
            if count[b[p : p + n]] > 1:
                gone[p : p + n] = True
        yield len(b), int(gone.sum()), int((gone & ~np.concatenate([[False], gone[:-1]])[: len(b)]).sum()), hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()


def test_repeated_passages(spark, docs, rows):
    got = suffixdup.remove_repeats(docs, with_kept=True).collect()
    want = sorted((repr(i), *x) for (i, _), x in zip(rows, removed_plainly([(t or "").encode() for _, t in rows]), strict=True))
    assert sorted((repr(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == want
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in got)


def test_passages_in_parts_of_a_long_text(spark, monkeypatch):
    monkeypatch.setattr(suffixdup, "AT_ONCE", 1000)
    texts = [prose(40, 900), prose(41, 200) + prose(40, 900)[1500:4200] + prose(42, 100), "ab" * 3000]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = suffixdup.remove_repeats(frame).orderBy("doc_id").collect()
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got] == list(removed_plainly([t.encode() for t in texts]))


def test_packing(spark, docs, rows):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    t = Tokenizer.from_file(path)
    p = packing.Packing(capacity=256, per_partition=10)
    got = packing.pack_documents(docs, path, p).collect()
    want = []
    for i, text in rows:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        want += [(repr(i), k // 256, k, len(ids[k : k + 256]), zlib.crc32(ids[k : k + 256].tobytes())) for k in range(0, len(ids), 256)]
    assert sorted((repr(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    bins = collections.defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for b in bins.values():
        b.sort()
        assert all(o == sum(n for _, n in b[:k]) for k, (o, _) in enumerate(b)) and sum(n for _, n in b) <= 256
    assert len(bins) <= packing.lower_bound(np.array([r.length for r in got]), 256) + 2


@pytest.mark.parametrize("text", ["Don't  stop-it 12,345 ÀÉÎ œuvre's", "a<|endoftext|>b", "naïvé é  x y", "Ünïcödé ＦＵＬＬ İstanbul ſ ŉ", "\x00\x1c\x1f a\x0bb\x0cc", "🙂👍🏽 日本語 12３", "ΣΑΣ ς", "", " \n "])
def test_ids_are_the_tokenizers(text):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    want = Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(packing._parts(path, 1000).of(text), "<u4").tolist() == want


def test_lower_bounds_hold():
    rng = np.random.default_rng(3)
    for _ in range(50):
        n = rng.integers(1, 65, rng.integers(1, 40))
        _, offset, used = packing.best_fit(n, 64)
        assert -(-n.sum() // 64) <= packing.lower_bound(n, 64) <= used and offset.max() < 64
    assert packing.lower_bound(np.full(7, 33), 64) == 7


def test_media(spark, docs, rows):
    got = sorted(jpeg.features(jpeg.media_column(docs)).collect(), key=lambda r: (repr(r.doc_id), r.n_bytes))
    body = [(repr(i), (t or "").encode()) for i, t in rows]
    want = sorted((i, len(b), (p := b.ljust(max(1, -(-len(b) // 192)) * 192)) and len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-16:])) for i, b in body)
    assert [(repr(r.doc_id), r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in got] == want
    by_text = collections.defaultdict(set)
    for r in got:
        by_text[r.payload_sha256].add((r.media_sha256, r.average_hash, r.difference_hash))
    assert all(len(x) == 1 for x in by_text.values())


def _image(units, quantum, restart, parts, size, rng):
    """A baseline image of random DC values with some AC coefficients; also the DC values of the first component."""
    codes = jpeg._codes([0, 2, 2, 2, 2, 2, 2, 0, 0, 0, 0, 0, 0, 0, 0, 0], list(range(12)))
    symbols = [0x00, 0x01, 0xF0, 0x53, 0x12]
    ac = jpeg._codes([0, 2, 2, 1] + [0] * 12, symbols)
    bits, out, luma, last = "", b"", [], {}

    def put(v):
        size = int(abs(v)).bit_length()
        return size, f"{(v if v >= 0 else v + (1 << size) - 1):0{size}b}" if size else ""

    def code(table, s):
        return f"{table[s][0]:0{table[s][1]}b}"

    def flush(b):
        b += "1" * (-len(b) % 8)
        return b"".join(bytes([int(b[i : i + 8], 2)]) + (b"\0" if b[i : i + 8] == "11111111" else b"") for i in range(0, len(b), 8))

    for u in range(units):
        if restart and u and u % restart == 0:
            out, bits, last = out + flush(bits) + bytes([0xFF, 0xD0 + (u // restart - 1) % 8]), "", {}
        for c, (h, v) in enumerate(parts):
            for _ in range(h * v):
                dc = int(rng.integers(-60, 60))
                if c == 0:
                    luma.append(dc)
                n, extra = put(dc - last.get(c, 0))
                last[c] = dc
                bits += code(codes, n) + extra
                for s, k in (((0xF0, 0), (0x53, 3), (0x12, 2), (0x01, 1)) if rng.random() < 0.5 else ()):
                    bits += code(ac, s) + "1" * k
                bits += code(ac, 0x00)
    frame = bytes([8]) + size[1].to_bytes(2, "big") + size[0].to_bytes(2, "big") + bytes([len(parts)]) + b"".join(bytes([c + 1, h << 4 | v, 0]) for c, (h, v) in enumerate(parts))
    scan = bytes([len(parts)]) + b"".join(bytes([c + 1, 0]) for c in range(len(parts))) + bytes([0, 63, 0])
    raw = b"\xff\xd8" + jpeg._segment(0xE0, b"JFIF\0") + jpeg._segment(0xDB, bytes([0] + [quantum] * 64)) + jpeg._segment(0xC0, frame)
    raw += jpeg._segment(0xC4, bytes([0, 0, 2, 2, 2, 2, 2, 2, *[0] * 9, *range(12)])) + jpeg._segment(0xC4, bytes([0x10, 0, 2, 2, 1, *[0] * 12, *symbols]))
    raw += (jpeg._segment(0xDD, restart.to_bytes(2, "big")) if restart else b"") + jpeg._segment(0xDA, scan) + out + flush(bits) + b"\xff\xd9"
    return raw, luma


def test_images_with_components_and_coefficients():
    rng = np.random.default_rng(6)
    made = [_image(6, 16, 0, [(1, 1)], (24, 16), rng), _image(4, 8, 2, [(2, 2), (1, 1), (1, 1)], (32, 32), rng)]
    raw, scans, want = b"", [], []
    for k, (image, luma) in enumerate(made):
        s, end = jpeg.parse(image, 0, k)
        assert end == len(image)
        s.data = (s.data[0] + len(raw), s.data[1] + len(raw))
        scans.append(s)
        raw += image
        q = [16, 8][k]
        want.append(np.clip(np.array(luma) * q // 8 + 128, 0, 255))
    first, second = jpeg.decode(raw, scans)
    assert first.ravel().tolist() == want[0].tolist()
    assert second.tolist() == want[1].reshape(2, 2, 2, 2).transpose(0, 2, 1, 3).reshape(4, 4).tolist()


def test_broken_media_has_null_features(spark):
    df = spark.createDataFrame([(1, 3, bytearray(b"not an image")), (2, 0, None)], "doc_id long, n_bytes long, media binary")
    assert [r.payload_bytes for r in jpeg.features(df).collect()] == [None, None]


def test_fingerprints(spark, docs, rows):
    got = imatch.edited_fingerprints(docs).collect()
    assert len(got) == len(rows)
    order = sorted(((i, t or "") for i, t in rows), key=lambda x: (x[0] is not None, x[0] or 0))
    edits = collections.Counter(hashlib.sha256((t[: len(t) - len(t) // 4] + order[(k + 1) % len(order)][1][: len(t) // 4]).encode()).hexdigest() for k, (_, t) in enumerate(order))
    assert collections.Counter(r.edited_sha256 for r in got) == edits
    prints = collections.defaultdict(set)
    for r in got:
        prints[r.doc_id, r.n_chars].add(r.fingerprint)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    texts = collections.defaultdict(set)
    for i, t in rows:
        texts[t or ""] |= prints[i, len(t or "")]
    assert all(len(p) == 1 for p in texts.values())


def test_likeness_tells_edits_from_others(spark):
    rng = np.random.default_rng(12)
    df = spark.createDataFrame([(i, " ".join(f"w{x}" for x in rng.integers(0, 9000, 400))) for i in range(60)], "doc_id long, text string")
    got = imatch.edited_fingerprints(df).agg(F.avg("near_edited").alias("e"), F.avg("near_next").alias("n")).first()
    assert got.e > 0.3 and got.n < 0.2


def test_archives(spark):
    body = "<p>" + "b" * 200 + "</p>"
    pages = [(1, "http://www.Example.com:80/a b?x=1", body), (0, "https://example.com/z", body), (2, None, None), (3, "", "short"), (4, "http://example.com/c", "short"), (5, "::bad::", "é" * 90), (6, "http://example.com/c", "é" * 90), (None, "http://none.org/", body), (7, "http://a%20b.org/%25", "\r\n\r\nWARC/1.1" + "c" * 300), (7, "http://a%20b.org/%25", "\r\n\r\nWARC/1.1" + "c" * 300)]
    df = spark.createDataFrame([(*p, "x", "y") for p in pages], "page_id long, url string, html string, `__first` string, `__n` string").repartition(3)
    p = warc.Warc(block_lines=2, file_bytes=600, key_chars=8)
    archive = warc.build(df, p)
    got = warc.captures(df, archive, p).collect()
    first = {}
    for i, _, h in pages:
        if h and len(h.encode()) >= 100 and i is not None:
            first[h] = min(i, first.get(h, i))
    want = []
    for i, _, h in pages:
        b = (h or "").encode()
        to = first.get(h)
        revisit = to is not None and i is not None and to != i
        want.append((repr(i), len(b), hashlib.sha256(b).hexdigest(), "revisit" if revisit else "response", repr(to if revisit else None)))
    assert sorted((repr(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, repr(r.refers_to)) for r in got) == sorted(want)
    assert all(r.read_digest == r.payload_digest for r in got if r.record_type == "response")
    wanted = spark.createDataFrame([("http://example.com/c",), ("http://nobody.net/",)], "url string")
    assert sorted(r.page_id for r in warc.captures(wanted, archive, p).collect()) == [4, 6]


def test_boilerplate_lines(spark, docs, rows):
    got = linedup.drop_boilerplate(docs, percent=20, count_col="dropped")
    assert got.columns == [*docs.columns, "dropped"]
    sites = ["src0" if k % 3 else "" for k in range(len(rows))]
    pages, seen = collections.defaultdict(set), collections.defaultdict(set)
    for s, (_, t) in zip(sites, rows, strict=True):
        pages[s].add(t or "")
        for line in set((t or "").split("\n")):
            if line.strip(" "):
                seen[s, line].add(t or "")
    bad = {k for k, v in seen.items() if len(v) >= 2 and len(v) * 100 > len(pages[k[0]]) * 20}
    assert bad
    want = sorted((repr(i), repr(None if t is None else "\n".join(x for x in t.split("\n") if (s, x) not in bad))) for s, (i, t) in zip(sites, rows, strict=True))
    assert sorted((repr(r.doc_id), repr(r.text)) for r in got.collect()) == want


def test_mixing_reaches_its_targets(spark):
    rng = np.random.default_rng(5)
    kinds = {"en": "the and of house river", "fr": "le la des maison fleuve", "de": "der die und haus fluss"}
    rows = [(i, " ".join(rng.choice(kinds[d].split(), 60)), d) for i in range(600) for d in [["en", "en", "en", "fr", "de"][i % 5]]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    fitted, _ = mixing.fit(docs, docs, targets={"en": 1.0, "fr": 1.0, "de": 2.0})
    assert all(abs(a / b - 1) < 0.02 for a, b in zip(fitted.reached, fitted.targets, strict=True))
    got = mixing.mix(docs, docs, targets={"en": 1.0, "fr": 1.0, "de": 2.0}).groupBy("lang").count().collect()
    n = {r.lang: r["count"] for r in got}
    assert abs(n["de"] / n["fr"] - 2) < 0.5 and abs(n["en"] / n["fr"] - 1) < 0.3
    assert all(r.rate >= 0 for r in mixing.rates(docs, docs).collect())


def test_toxic_sentences_are_found(spark):
    rows = [(i, f"{prose(i, 40)}. {'You stupid worthless idiot' if i % 3 == 0 else 'A kind word'} {prose(i + 999, 5)}. {prose(i + 500, 30)}.") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)], "doc_id long, toxic int")
    got = toxicity.score_documents(docs, labels).collect()
    held = [r for r in got if r.held_out]
    assert held and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert sum(r.predicted == (r.doc_id % 3 == 0) for r in held) >= 0.95 * len(held)
    text = dict(rows)
    found = [text[r.doc_id][s.start : s.stop] for r in held if r.predicted for s in r.sentences]
    assert found and sum("idiot" in x for x in found) >= 0.9 * len(found)


def test_licences(spark):
    lines = {1: "Released under the MIT License.", 2: prose(7, 90) + "\nLicensed under CC BY-NC 4.0.\n" + prose(8, 10), 3: prose(9, 80), 4: None, 5: "", 6: "License to drive and other permits of the city", 7: prose(3, 200) + "\nThis work is licensed under the GNU General Public License, version 3."}
    docs = spark.createDataFrame(list(lines.items()) + [(100 + i, prose(300 + i, 60)) for i in range(100)], "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scan(docs, licenses.train(docs)).collect()}
    assert (got[1].family, got[2].family, got[7].family) == ("MIT", "CC-BY-NC-4.0", "GPL-3.0")
    assert lines[2][got[2].start : got[2].stop].startswith("Licensed under CC BY-NC 4")
    assert not [i for i, r in got.items() if r.family and i not in (1, 2, 7)] and got[4].n_paragraphs == 0


def test_empty_tables(spark):
    none = empty(spark)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    path = queries.tokenizer_path()
    for df in (minhash.near_duplicates(none), suffixdup.remove_repeats(none), packing.pack_documents(none, path), jpeg.features(jpeg.media_column(none)), imatch.edited_fingerprints(none), linedup.drop_boilerplate(none), mixing.rates(none, labels), mixing.mix(none, labels), toxicity.score_documents(none, labels), licenses.scan(none, licenses.train(none))):
        assert df.count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.captures(pages, warc.build(pages)).count() == 0


def test_odd_rows_do_not_stop_models(spark, docs, labels, rows):
    assert toxicity.score_documents(docs, labels).count() == len(rows)
    assert mixing.rates(docs, labels).count() == len(rows)
    assert mixing.mix(docs, labels).columns == docs.columns
    assert licenses.scan(docs, licenses.train(docs)).count() == len(rows)
    assert not [r for r in toxicity.score_documents(docs, labels).select("score").collect() if not 0 <= r.score <= 1 or math.isnan(r.score)]
