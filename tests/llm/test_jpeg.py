"""Damaged media, payloads of several images, and thumbnail hashes against plain versions."""

from __future__ import annotations

import hashlib

import numpy as np

from skyloom.llm import jpeg


def test_a_damaged_scan_spoils_its_own_row_only(spark):
    good = [bytes(x) for x in jpeg.encode([f"text {i} ".encode().ljust(192 * (1 + i % 3)) for i in range(40)])]
    rng = np.random.default_rng(1)
    media = []
    for i, x in enumerate(good):
        b = bytearray(x)
        if i % 4 == 0:
            for k in rng.integers(len(b) - 60, len(b) - 2, 25):
                b[k] = 0xFE
        media.append((i, 0, b))
    got = {r.doc_id: r for r in jpeg.features(spark.createDataFrame(media, "doc_id long, n_bytes long, media binary").repartition(2)).collect()}
    assert len(got) == 40
    for i in range(40):
        body = f"text {i} ".encode().ljust(192 * (1 + i % 3))
        if i % 4:
            assert got[i].payload_sha256 == hashlib.sha256(body).hexdigest()
        else:
            assert got[i].payload_sha256 is None or got[i].payload_sha256 != hashlib.sha256(body).hexdigest()
    assert any(got[i].payload_sha256 is None for i in range(0, 40, 4))


def test_payloads_of_several_images(spark):
    texts = ["ab" * (192 * 8191), "c" * (192 * 8191), "d" * (192 * 8191 + 1)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in jpeg.features(jpeg.media_column(docs)).collect():
        body = texts[r.doc_id].encode()
        body = body.ljust(-(-len(body) // 192) * 192)
        assert (r.payload_bytes, r.payload_sha256, r.height) == (len(body), hashlib.sha256(body).hexdigest(), 8 * len(body) // 192)


def test_thumbnail_hashes_plainly():
    rng = np.random.default_rng(2)
    for _ in range(30):
        y = rng.integers(0, 256, (rng.integers(1, 40), rng.integers(1, 60)))

        def mean(down, across, i, j, y=y):
            r0, c0 = i * y.shape[0] // down, j * y.shape[1] // across
            r1, c1 = max((i + 1) * y.shape[0] // down, r0 + 1), max((j + 1) * y.shape[1] // across, c0 + 1)
            return y[r0:r1, c0:c1].mean()

        a = [[mean(8, 8, i, j) for j in range(8)] for i in range(8)]
        d = [[mean(8, 9, i, j) for j in range(9)] for i in range(8)]
        average = "".join("1" if v > np.mean(a) else "0" for row in a for v in row)
        difference = "".join("1" if row[j + 1] > row[j] else "0" for row in d for j in range(8))
        assert jpeg.thumbnail_hashes(y) == (int(average, 2), int(difference, 2))
