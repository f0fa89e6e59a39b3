"""Best-fit packing with certified bounds.

Pieces of at most `capacity` tokens are dealt to partitions of about `per_partition` pieces and packed best-fit
decreasing. Each partition computes a lower bound of its bin count by dual-feasible functions. A partition whose bins
exceed its bound gives up its loosest bins; so does, in the end, every partition that holds a slack bin, since whole
bins are only proven per partition. The pieces given up are dealt anew, to fewer partitions, and packed again, until
the pool fits one partition or no longer shrinks. Only (id, piece, length) rows move; texts stay where they are read.
"""

from __future__ import annotations

import re
import struct
import zlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm.common import cut, text_or_empty

PIECES = "doc_id long, row long, piece long, start long, length long, ids_crc32 long"


@dataclass(frozen=True)
class Packing:
    """capacity: tokens of a sequence. closing: the id that ends each document. keep_parts bounds a worker's cache of ids."""

    capacity: int = 4096
    closing: int = 1
    per_partition: int = 20_000
    keep_parts: int = 250_000
    max_rounds: int = 12


# The tokenizer drops white space, lower-cases, and splits a text into letters, single digits and other signs before its
# merges, so a text's ids are those of its parts. For these characters, which its normal form leaves alone, the parts are found here.
_PLAIN = re.compile("[\x00-\x7f\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u0148\u014a-\u017e]*")
# Fixed value: the tokenizer's split, for those characters in lower case.
_PART = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u017e]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u017e\x09-\x0d ]+")


class _Parts(dict):
    """Token ids of parts, as little-endian 32-bit numbers; at most `most` are kept."""

    def __init__(self, path: str, most: int):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.encode, self.merged, self.most = tokenizer.encode, tokenizer.model.tokenize, most

    def __missing__(self, part: str) -> bytes:
        if len(self) >= self.most:
            self.clear()
        # a part of plain letters is not changed by normal form, split or byte map, so that only the merges are left
        ids = [x.id for x in self.merged(part)] if part.isascii() and part.islower() and part.isalpha() else self.encode(part, add_special_tokens=False).ids
        got = self[part] = struct.pack(f"<{len(ids)}I", *ids)
        return got

    def of(self, text: str) -> bytes:
        if _PLAIN.fullmatch(text) and "<|" not in text:
            return b"".join([self[x] for x in _PART.findall(text.lower())])
        return b"".join([self[x] for x in re.split("[ \n\t\r]+", text) if x])  # words


@lru_cache(maxsize=1)
def _parts(path: str, most: int) -> _Parts:
    """One cache for all tasks of a worker process."""
    return _Parts(path, most)


def pieces(docs: DataFrame, tokenizer: str, p: Packing = Packing(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, row, piece, start, length, ids_crc32): each document's ids and the closing id, cut at the capacity. row tells repeated documents apart."""

    def run(batches):
        parts = _parts(tokenizer, p.keep_parts)
        end = np.array([p.closing], "<u4").tobytes()
        step = 4 * p.capacity
        for b in batches:
            out: list[tuple[int | None, int, int, int, int, int]] = []
            for doc, row, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                ids = parts.of(text.as_py()) + end
                out += [(doc, row, k, i // 4, min(step, len(ids) - i) // 4, zlib.crc32(ids[i : i + step])) for k, i in enumerate(range(0, len(ids), step))]
            cols = list(zip(*out, strict=True)) or [[]] * 6
            yield pa.record_batch([pa.array(c, pa.int64()) for c in cols], ["doc_id", "row", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.monotonically_increasing_id().alias("row"), text_or_empty(text_col).alias("text")).mapInArrow(run, PIECES)


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Best-fit decreasing: each piece's bin and place in it, and the number of bins. Bins are found by their free space in a bit mask."""
    order = np.argsort(-lengths, kind="stable")
    bin_of, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, used = 0, 0
    for i, n in zip(order.tolist(), lengths[order].tolist(), strict=True):
        rest = mask >> n
        if rest:
            room = n + (rest & -rest).bit_length() - 1
            k = free[room].pop()
            if not free[room]:
                mask &= ~(1 << room)
        else:
            room, k, used = capacity, used, used + 1
        bin_of[i], offset[i] = k, capacity - room
        free[room - n].append(k)
        mask |= 1 << (room - n)
    return bin_of, offset, used


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """The best of some dual-feasible functions: the volume bound, the threshold family (large pieces count as whole bins, small ones below a threshold not at all) and the rounding family."""
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1, dtype=np.int64)
    best = -(-int((count * size).sum()) // capacity)
    for t in np.unique(np.concatenate([size[count > 0], capacity - size[count > 0]])):
        if 0 < t <= capacity // 2:
            u = np.where(size > capacity - t, capacity, np.where(size >= t, size, 0))
            best = max(best, -(-int((count * u).sum()) // capacity))
    for k in range(1, 21):
        whole = size * (k + 1) % capacity == 0
        u = np.where(whole, size * k, (size * (k + 1) // capacity) * capacity)  # over k * capacity
        best = max(best, -(-int((count * u).sum()) // (k * capacity)))
    return best


def _pack_round(pool: DataFrame, parts: int, round_no: int, p: Packing, last: bool) -> DataFrame:
    """(…, sequence_id, offset, open): open pieces lie in a bin that its partition gives up."""
    schema = "doc_id long, row long, piece long, length long, sequence_id long, offset long, open boolean"

    def of(key, t):
        at = np.lexsort((t.column("piece").to_numpy(), t.column("row").to_numpy()))
        t = t.take(pa.array(at)).select(["part", "doc_id", "row", "piece", "length"])
        n = t.column("length").to_numpy()
        bin_of, offset, used = best_fit(n, p.capacity)
        fill = np.bincount(bin_of, n, used).astype(np.int64)
        gap = used - lower_bound(n, p.capacity)
        given = np.zeros(used, bool)
        if not last:
            loose = np.argsort(fill, kind="stable")
            given[loose[: 1 + 8 * gap]] = True  # the slack bin, and with a gap also bins to exchange
            given &= fill < p.capacity
        seq = (np.int64(round_no) << 56) | (np.int64(key[0].as_py()) << 28) | bin_of
        return pa.table({"doc_id": t.column("doc_id"), "row": t.column("row"), "piece": t.column("piece"), "length": t.column("length"), "sequence_id": pa.array(seq), "offset": pa.array(offset), "open": pa.array(given[bin_of])})

    dealt = pool.select("doc_id", "row", "piece", "length", F.pmod(F.xxhash64("row", "piece", F.lit(round_no)), F.lit(parts)).alias("part"))
    return dealt.groupBy("part").applyInArrow(of, schema)


def pack(items: DataFrame, p: Packing = Packing()) -> DataFrame:
    """items (row, piece, length, …) with sequence_id and offset. (row, piece) must be unique."""
    pool = items.select("doc_id", "row", "piece", "length")
    placed: DataFrame | None = None
    size = pool.count()
    for r in range(p.max_rounds):
        parts = max(1, -(-size // p.per_partition))
        last = parts == 1 or r == p.max_rounds - 1
        got = cut(_pack_round(pool, parts, r, p, last), "packed")
        done = got.where("not open").drop("open")
        placed = done if placed is None else placed.unionByName(done)
        if last:
            break
        pool = got.where("open").select("doc_id", "row", "piece", "length")
        left = pool.count()
        if not left:
            break
        if left > 0.9 * size:  # no longer shrinking: the next round keeps all
            placed = placed.unionByName(_pack_round(pool, max(1, -(-left // p.per_partition)), r + 1, p, True).drop("open"))
            break
        size = left
    return items.join(placed.select("row", "piece", "sequence_id", "offset"), ["row", "piece"])


def pack_documents(docs: DataFrame, tokenizer: str, p: Packing = Packing(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for every piece of every row.

    Null and empty texts are the closing id alone. Repeated rows are packed each on its own; a null id stays null.
    Equal lengths are placed in the order of rows. An empty table gives an empty result.
    """
    items = cut(pieces(docs, tokenizer, p, id_col, text_col), "pieces")
    return pack(items, p).select("doc_id", F.col("piece").cast("int").alias("piece"), "start", "length", "ids_crc32", "sequence_id", "offset")
