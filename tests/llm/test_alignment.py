"""Alignment against plain Python: whole texts encoded at once, links by comparing byte ranges, counts in a dictionary."""

from __future__ import annotations

import collections
import hashlib
import random
from functools import lru_cache

import numpy as np
import pytest

from skyloom.llm import alignment
from skyloom.llm.alignment import Alignment

P = pytest.importorskip("public_tokenizers")
A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def tokens():
    return alignment._Tokens(A, B, 1000)


def _texts():
    rng = random.Random(8)
    signs = ["a", "word", " ", "  ", "\n", "\n\n", "\t", "é", "ß", "東京", "😀", "́", "\xa0", " ", "\x00", "\x1c", ".", "!!", "123", "don't", "'s", "<s>", "<0x41>", "<|endoftext|>", "\r\n", "�", "Straße", "_", "¼"]
    out = ["".join(rng.choice(signs) for _ in range(rng.randrange(1, 40))) for _ in range(150)]
    words = ["Tokenizers", "disagree", "about", "unbelievable", "words", "naïve", "1234567", "lower-case"]
    out += [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 300))) for _ in range(30)]
    return [*out, None, "", " ", "  ", "\n", "a ", " a", "▁", "mixed ▁ sign", "x" * 5000, "a b" * 3000, out[0], out[0], "<|endoftext|>", "\n\n x"]


@lru_cache
def _models():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(A)
    t.encode_special_tokens = True
    return t, SentencePieceProcessor(model_file=B)


def _whole(text):
    t, s = _models()
    signs = alignment._byte_signs()
    a = [(e, bytes(signs[c] for c in t.id_to_token(e))) for e in t.encode(" " + text, add_special_tokens=False).ids]
    b = [(e, bytes([int(s.id_to_piece(e)[3:5], 16)]) if s.is_byte(e) else s.id_to_piece(e).replace("▁", " ").encode()) for e in s.encode(text)]
    want = (" " + text).encode()
    return (a, b) if text and b"".join(x for _, x in a) == want == b"".join(x for _, x in b) else ([], [])


def _plain(text):
    """Ids of both sides, groups as text, links as pairs of ids."""
    a, b = _whole(text or "")
    ranges = []
    for side in (a, b):
        at, out = 0, []
        for e, raw in side:
            out.append((e, at, at + len(raw)))
            at += len(raw)
        ranges.append(out)
    links, k = [], 0
    for e, i, j in ranges[0]:
        while k < len(ranges[1]) and ranges[1][k][2] <= i:
            k += 1
        m = k
        while m < len(ranges[1]) and ranges[1][m][1] < j:
            links.append((e, ranges[1][m][0]))
            m += 1
    groups, open_a, open_b = [], [], []
    events = sorted([(j, 0, e) for e, _, j in ranges[0]] + [(j, 1, e) for e, _, j in ranges[1]])
    both = {j for _, _, j in ranges[0]} & {j for _, _, j in ranges[1]}
    for n, (j, side, e) in enumerate(events):
        (open_b if side else open_a).append(e)
        if j in both and (n + 1 == len(events) or events[n + 1][0] > j):
            groups.append(",".join(map(str, open_a)) + "|" + ",".join(map(str, open_b)))
            open_a, open_b = [], []
    return len(a), len(b), groups, links


@pytest.mark.parametrize("p", [Alignment(), Alignment(block=3, batch=7, keep_chunks=5, max_pairs=300)], ids=["usual", "small"])
def test_rows_are_those_of_plain_sweeps(spark, p):
    texts = _texts()
    docs = spark.createDataFrame([(i if i != 3 else None, t, 1, "b") for i, t in enumerate(texts)], "doc_id long, text string, row int, pairs string").repartition(5)
    got = {r.doc_id: r for r in alignment.align(docs, A, B, p).collect()}
    assert len(got) == len(texts)
    plain = [_plain(t) for t in texts]
    counts = collections.Counter(x for _, _, _, links in plain for x in links)
    most = collections.defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    for i, (n_a, n_b, groups, links) in enumerate(plain):
        r = got[i if i != 3 else None]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links) == (n_a, n_b, len(groups), len(links)), texts[i]
        assert r.n_best == sum(counts[x] == most[x[1]] for x in links)
        assert r.count_sum == sum(counts[x] for x in links)
        assert r.groups_sha256 == (hashlib.sha256(";".join(groups).encode()).hexdigest() if n_a else "")
    assert sum(not x[0] for x in plain) >= 4 and sum(x[0] > 3 for x in plain) > 150


def test_chunks_are_those_of_the_whole(tokens):
    texts = [t or "" for t in _texts()]
    for text, (a, b) in zip(texts, tokens.of(texts), strict=True):
        want = _whole(text)
        assert np.frombuffer(a, tokens.kinds[0]).tolist() == [e for e, _ in want[0]], text
        assert np.frombuffer(b, tokens.kinds[1]).tolist() == [e for e, _ in want[1]], text
    assert tokens.encode.__name__ == "encode_ordinary"
    assert "".join(alignment._CHUNK.findall(" a  b\n\nc\td \n")) == " a  b\n\nc\td \n"


def test_packed_pairs_come_back():
    rng = np.random.default_rng(0)
    for n in (0, 1, 700):
        pairs, times = np.unique(rng.integers(0, 1 << 31, n)), None
        times = rng.integers(1, 1 << 20, len(pairs))
        a, b = alignment.unpacked(alignment.packed(pairs, times))
        assert np.array_equal(a, pairs) and np.array_equal(b, times)


def test_empty_table(spark):
    assert alignment.align(spark.createDataFrame([], "doc_id long, text string"), A, B).collect() == []
