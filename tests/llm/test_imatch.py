"""I-Match against plain Python: document frequencies, the band, the lexicons' hashes, likeness, neighbours."""

from __future__ import annotations

import collections
import re

import numpy as np
import pytest

from skyloom.llm import imatch
from skyloom.llm.words import word_hashes

P = imatch.IMatch(rare=0.05, common=0.4, lexicons=6, levels=4)
MASK = 2**64 - 1


def _finish(x):
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
        x ^= x >> shift
        x = x * factor & MASK
    return x


def _words(text):
    return set(re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower()))


def _hash(word):
    raw = np.frombuffer(word.encode(), np.uint8)
    return int(word_hashes(raw, np.array([0]), np.array([len(raw)]))[0])


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(3)
    out = [" ".join(f"W{x}" if x % 3 else f"w{x}" for x in np.minimum(rng.zipf(1.3, rng.integers(1, 200)), 400)) for _ in range(120)]
    return [*out, None, "", "nie gesehen", out[0], "wort " * 500_000 + out[1]]


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(5)


def _band(texts):
    df = collections.Counter(w for t in texts for w in _words(t))
    return {w for w, n in df.items() if max(2, 0.05 * len(texts)) <= n <= max(2, 0.4 * len(texts))}


def _plainly(text, band):
    terms = sorted(_hash(w) for w in _words(text) & band)
    out = []
    for level in range(P.levels):
        for k in range(P.lexicons):
            place = [_finish(t ^ _finish(P.seed * 1000 + k + 1)) for t in terms]
            inside = [x for x in place if x < int(P.keep * 2.0**-level * 2.0**64)]
            total = sum(_finish((x * 0x9E3779B97F4A7C15 + 1) & MASK) for x in inside) & MASK
            out.append(f"{_finish(total) >> 48:04x}" if inside else imatch.NONE)
    return out if terms else None


def test_lexicon_is_the_band(spark, docs, texts):
    counts = {r.term & MASK: r.n for r in imatch.document_frequency(docs).collect()}
    assert counts == {_hash(w): n for w, n in collections.Counter(w for t in texts for w in _words(t)).items()}
    assert imatch.lexicon(docs, P).tolist() == sorted(_hash(w) for w in _band(texts))
    with pytest.raises(ValueError, match="raise rare"):
        imatch.lexicon(docs, imatch.IMatch(rare=0.0, common=1.0, max_terms=3))


def test_fingerprints_and_likeness(docs, texts):
    band = _band(texts)
    got = {r.doc_id: r for r in imatch.edited_fingerprints(docs, P).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        t, after = t or "", texts[(i + 1) % len(texts)] or ""
        own, edited, follow = _plainly(t, band), _plainly(t[: len(t) - len(t) // 4] + after[: len(t) // 4], band), _plainly(after, band)
        assert got[i].fingerprint == "".join(own) if own else got[i].fingerprint[0] == "="
        assert got[i].edited_fingerprint == "".join(edited) if edited else got[i].edited_fingerprint[0] == "="
        for a, b, near, same in ((own, edited, got[i].near_edited, got[i].fingerprint == got[i].edited_fingerprint), (own, follow, got[i].near_next, got[i].fingerprint == got[(i + 1) % len(texts)].fingerprint)):
            want = 1.0 if same else 0.0
            if a and b and not same:
                for level in range(P.levels):
                    pairs = [(x, y) for x, y in zip(a[level * 6 : level * 6 + 6], b[level * 6 : level * 6 + 6], strict=True) if (x, y) != (imatch.NONE, imatch.NONE)]
                    if pairs and (2 * len(pairs) >= 6 or level == 0):
                        want = max(want, sum(x == y for x, y in pairs) / len(pairs))
            assert near == pytest.approx(want)


def test_texts_without_terms_of_the_band_are_like_copies_alone():
    lex = np.zeros(0, np.uint64)
    raw = [b"a b", b"a b", b"c", b""]
    off = np.concatenate([[0], np.cumsum([len(x) for x in raw])])
    a, b, c, d = imatch.fingerprints(np.frombuffer(b"".join(raw), np.uint8), off, lex, P)
    assert (imatch.likeness(a, b, P), imatch.likeness(a, c, P), imatch.likeness(c, d, P), imatch.likeness(d, d, P)) == (1.0, 0.0, 0.0, 1.0)
