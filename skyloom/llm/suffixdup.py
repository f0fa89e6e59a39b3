"""Removal of repeated passages by prefix doubling over a sparse suffix array.

A passage is a string of `length` bytes that starts at two places at least. Ranking all positions of a corpus costs
many times its size, so positions are ranked in classes. Each window of `length` bytes is filed under its anchor: the
place of the least `gram`-byte hash in it, which equal windows have at the same offset. Anchors are about a hundredth
of all positions; each stands for a run of neighbouring windows.

An item is a run of windows; its rank is the string that all of its windows contain, first the gram, and after each
round a longer one, up to the whole window. Spark sorts items by (rank, context) pairs: an item whose rank is unique
goes, one whose whole context is shared is past the threshold and settled, and one item for each context of the others
is cut into shorter runs, whose common string is longer, and ranked anew. What is settled is exact on the byte. A string
is named by the pair of 64-bit hashes of its rank and of itself, a text by 128 bits.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm.common import U64, cut, mix, scratch, spans, tasks, text_or_empty, utf8

AT_ONCE = 2 << 20
_TABLE = np.random.default_rng(97).integers(1, 2**63, 256, dtype=np.uint64) | U64(1)
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 2**64)
ITEM = "g long, u long, key binary, at long, c0 int, c1 int"


@dataclass(frozen=True)
class Repeats:
    """length: bytes of a passage. gram: bytes that anchors are chosen by. runs: lengths of runs of windows in the rounds after the first, the last one 1."""

    length: int = 200
    gram: int = 32
    runs: tuple[int, ...] = (32, 8, 1)


class _Hasher:
    """Hashes of substrings of one array of bytes."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        with np.errstate(over="ignore"):
            self.total, self.down = np.zeros(n + 1, np.uint64), np.full(n + 1, _INVERSE, np.uint64)
            powers = np.full(n, _BASE, np.uint64)
            powers[:1] = self.down[0] = 1
            np.multiply.accumulate(powers, out=powers)
            np.multiply.accumulate(self.down, out=self.down)
            np.cumsum(_TABLE[data] * powers, out=self.total[1:])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self.total[stop] - self.total[start]) * self.down[start] + (stop - start).astype(np.uint64))

    def grams(self, size: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self.total[size:] - self.total[:-size]) * self.down[: len(self.down) - size])


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each window of `width` values."""
    n = len(values)
    rows = -(-n // width)
    a = np.concatenate([values, np.full(rows * width - n, np.iinfo(np.uint64).max, np.uint64)]).reshape(rows, width)
    before = np.minimum.accumulate(a, axis=1).ravel()
    after = np.minimum.accumulate(a[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[: n - width + 1], before[width - 1 : n])


def _anchor_runs(data: np.ndarray, offsets: np.ndarray, p: Repeats):
    """For each run of windows of one anchor: row, anchor's place in its row, c0 and c1 (the first and last window's start, less the anchor), gram hash, context hash."""
    n = len(data)
    if n < p.length:
        return None
    h = _Hasher(data)
    gram = h.grams(p.gram)
    width = p.length - p.gram + 1
    place = np.arange(len(gram), dtype=np.uint64)
    anchor = (_least(gram >> U64(28) << U64(28) | place, width) & U64((1 << 28) - 1)).astype(np.int64)  # leftmost least
    starts = np.arange(len(anchor))
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(anchor)]
    whole = starts + p.length <= offsets[row + 1]
    starts, anchor, row = starts[whole], anchor[whole], row[whole]
    if not len(starts):
        return None
    new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(starts)]]) - 1
    lo, hi, a, row = starts[first], starts[last], anchor[first], row[first]
    c0, c1 = lo - a, hi - a
    with np.errstate(over="ignore"):
        shape = mix(((c0 + 1024) * 4096 + c1 + 1024).astype(np.uint64))
    return row, a - offsets[row], c0.astype(np.int32), c1.astype(np.int32), gram[a], h.of(lo, hi + p.length) ^ shape


def _batch(g, u, key: pa.Array, at, c0, c1) -> pa.RecordBatch:
    return pa.record_batch([pa.array(g.view(np.int64)), pa.array(u.view(np.int64)), key, pa.array(at.astype(np.int64)), pa.array(c0.astype(np.int32)), pa.array(c1.astype(np.int32))], ["g", "u", "key", "at", "c0", "c1"])


def anchors(texts: DataFrame, p: Repeats) -> DataFrame:
    """ITEM rows of (key, text): g names the gram, u the context. Of a text that a task meets again and again, two copies count."""

    def run(batches):
        seen: dict[bytes, int] = {}
        for b in batches:
            keys = b.column(0).to_pylist()
            data, off = utf8(b.column(1))
            for i, j in spans(off, AT_ONCE):
                use = []
                for k in range(i, j):
                    times = seen.get(keys[k], 0)
                    if times < 2 and off[k + 1] - off[k] >= p.length:
                        seen[keys[k]] = times + 1
                        use.append(k)
                if not use:
                    continue
                if len(use) == 1 and off[use[0] + 1] - off[use[0]] > 2 * AT_ONCE:  # a long text in parts that share all but the first windows
                    a, b1 = off[use[0]], off[use[0] + 1]
                    parts = [(use, np.array([s]), data[a + s : min(a + s + AT_ONCE + p.length - 1, b1)], None) for s in range(0, int(b1 - a) - p.length + 1, AT_ONCE)]
                else:
                    sizes = np.array([off[k + 1] - off[k] for k in use])
                    parts = [(use, np.zeros(len(use), np.int64), np.concatenate([data[off[k] : off[k + 1]] for k in use]), np.concatenate([[0], np.cumsum(sizes)]))]
                for own, base, raw, o in parts:
                    got = _anchor_runs(raw, np.array([0, len(raw)]) if o is None else o, p)
                    if got is not None:
                        row, at, c0, c1, g, u = got
                        yield _batch(g, u, b.column(0).take(pa.array(np.array(own)[row])), at + base[row], c0, c1)

    return texts.mapInArrow(run, ITEM)


def _settle(items: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """(items whose context is shared, an item of each context of the ranks that have several). Items of unique rank are in neither.

    Items are sorted by (rank, context) over all tasks, in ranges that also split a common rank or context, and what is
    equal then stands together. Only a task's first and last context may go on in another task: their last rows, two for
    each task at most, are joined up on the driver.
    """
    keys = ["g", "u", "key", "at", "c0", "c1"]
    flags = ["shared", "one", "edge", "near", "part"]
    ordered = items.select(*keys).repartitionByRange(tasks(items.sparkSession), *keys).sortWithinPartitions("g", "u")

    def run(batches):
        part, held = TaskContext.get().partitionId(), None
        as_before = rank_before = False  # of the row held back: whether the row before it has its context; whether the context before has its rank
        first = True  # whether it is in the task's first context

        def out(t: pa.Table, shared, one, edge, near):
            some = shared | one | (edge > 0)
            if some.any():
                cols = [pa.array(shared), pa.array(one), pa.array(edge.astype(np.int32)), pa.array(near), pa.array(np.full(len(shared), part, np.int32))]
                yield from pa.table([*t.columns, *cols], [*keys, *flags]).filter(pa.array(some)).to_batches()

        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b])
            t = t if held is None else pa.concat_tables([held, t])
            g, u = t.column("g").to_numpy(), t.column("u").to_numpy()
            rank_next, same_next = g[1:] == g[:-1], (g[1:] == g[:-1]) & (u[1:] == u[:-1])
            same = np.append(as_before, same_next)
            begins = np.flatnonzero(np.append(True, ~same_next))
            context = np.cumsum(np.append(0, ~same_next))
            rank = np.append(rank_before, rank_next[begins[1:] - 1])[context]
            in_first = (context == 0) & first
            end = ~same_next
            edge = in_first[:-1] & end
            yield from out(t.slice(0, len(g) - 1), same[:-1] | same_next, end & (rank[:-1] | rank_next) & ~edge, edge.astype(np.int32), rank_next)
            held, as_before, rank_before, first = t.slice(len(g) - 1), bool(same[-1]), bool(rank[-1]), bool(in_first[-1])
        if held is not None:
            yield from out(held, np.array([as_before]), np.array([False]), np.array([3 if first else 2]), np.array([rank_before]))

    marked = cut(ordered.mapInArrow(run, f"{ITEM}, shared boolean, one boolean, edge int, near boolean, part int"), label)
    found, apart = _joined_up(marked.where("edge > 0").orderBy("part", "edge").collect())  # two rows for each task at most
    more = lambda rows: marked.sparkSession.createDataFrame([tuple(r[c] for c in keys) for r in rows], ITEM)
    return marked.where("shared").select(*keys).unionByName(more(found)), marked.where("one").select(*keys).unionByName(more(apart))


def _joined_up(edges: list) -> tuple[list, list]:
    """Of the last rows of each task's first (edge 1), last (2) or only (3) context, in order: those that turn out to be shared, and one of each context whose rank has several."""
    runs: list[tuple[list, bool]] = []  # rows of one context, and whether its rank has several
    for i, r in enumerate(edges):
        after_task = i > 0 and edges[i - 1].part != r.part
        if after_task and (edges[i - 1].g, edges[i - 1].u) == (r.g, r.u):
            runs[-1] = (runs[-1][0] + [r], runs[-1][1] or r.near)
            continue
        beside = after_task and edges[i - 1].g == r.g
        if beside:
            runs[-1] = (runs[-1][0], True)
        runs.append(([r], r.near or beside))
    found = [r for rows, _ in runs if len(rows) > 1 for r in rows if not r.shared]
    return found, [rows[0] for rows, several in runs if several]


def _shorter(items: DataFrame, run_length: int, p: Repeats) -> DataFrame:
    """ITEM rows of (g, key, at, c0, c1, context): each run cut at multiples of run_length. g names the old rank, the cut and the string common to its windows; u the context."""

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            g, at, c0, c1 = (b.column(i).to_numpy() for i in (0, 2, 3, 4))
            data, off = utf8(b.column(5))
            h = _Hasher(data)
            first, last = np.floor_divide(c0, run_length), np.floor_divide(c1, run_length)
            n = last - first + 1
            item = np.repeat(np.arange(len(g)), n)
            block = np.repeat(first, n) + np.arange(len(item)) - np.repeat(np.cumsum(n) - n, n)
            r0, r1 = block * run_length, block * run_length + run_length - 1
            d0, d1 = np.maximum(r0, c0[item]), np.minimum(r1, c1[item])
            zero = off[item] - c0[item]  # where the anchor is
            with np.errstate(over="ignore"):
                old = mix(g[item].view(np.uint64) + mix((block + 4096).astype(np.uint64)))
                rank = mix(old ^ h.of(zero + r1, zero + r0 + p.length))
                context = rank ^ mix(h.of(zero + d0, zero + d1 + p.length) + ((d0 + 1024) * 4096 + d1 + 1024).astype(np.uint64))
            yield _batch(rank, context, b.column(1).take(pa.array(item)), at[item], d0, d1)

    return items.select("g", "key", "at", "c0", "c1", "context").mapInArrow(run, ITEM)


def _contexts(items: DataFrame, texts: DataFrame, p: Repeats) -> DataFrame:
    """(key, at, c0, c1, context) of the distinct places of items: the bytes of all windows of the run."""
    places = items.select("key", "at", "c0", "c1").distinct().groupBy("key").agg(F.collect_list(F.struct("at", "c0", "c1")).alias("places"))  # of one text

    def run(batches):
        for b in batches:
            data, off = utf8(b.column(2))
            for i, (key, places) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)):
                raw = data[off[i] : off[i + 1]].tobytes()
                for s in range(0, len(places), 4096):
                    some = places[s : s + 4096]
                    cols = [[x[c] for x in some] for c in ("at", "c0", "c1")]
                    yield pa.record_batch([pa.array([key] * len(some), pa.binary()), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int32()), pa.array([raw[a + x : a + y + p.length] for a, x, y in zip(*cols, strict=True)], pa.binary())], ["key", "at", "c0", "c1", "context"])

    return places.join(texts, "key").select("key", "places", "text").mapInArrow(run, "key binary, at long, c0 int, c1 int, context binary")


def repeated_ranges(texts: DataFrame, p: Repeats = Repeats()) -> DataFrame:
    """(key, start, stop): byte ranges of (key, text) that repeated passages cover; they may overlap. texts: rows of equal key have equal texts."""
    found, apart = _settle(cut(anchors(texts, p), "anchors"), "contexts")
    ranges = [found]
    apart = cut(apart, "apart")
    held = cut(_contexts(apart, texts.groupBy("key").agg(F.first("text").alias("text")), p), "context")
    apart = apart.join(held, ["key", "at", "c0", "c1"])
    for k, n in enumerate(p.runs):
        items = cut(_shorter(apart, n, p), "items")
        found, left = _settle(items, "contexts")
        ranges.append(found)
        if k < len(p.runs) - 1:
            whole = held.withColumnsRenamed({"c0": "w0", "c1": "w1"})
            apart = left.join(whole, ["key", "at"]).where("c0 >= w0 and c1 <= w1").withColumn("context", F.substring("context", F.col("c0") - F.col("w0") + 1, F.col("c1") - F.col("c0") + p.length)).drop("w0", "w1")
    out = ranges[0]
    for r in ranges[1:]:
        out = out.unionByName(r)
    return out.select("key", (F.col("at") + F.col("c0")).alias("start"), (F.col("at") + F.col("c1") + p.length).alias("stop"))


RESULT = "key binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _removed(texts: DataFrame, ranges: DataFrame, with_kept: bool) -> DataFrame:
    of_text = ranges.distinct().groupBy("key").agg(F.collect_list(F.struct("start", "stop")).alias("ranges"))  # of one text

    def run(batches):
        for b in batches:
            data, off = utf8(b.column(2))
            out = []
            for i, (key, found) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)):
                raw = data[off[i] : off[i + 1]]
                n, removed, runs, kept = len(raw), 0, 0, raw.tobytes()
                if found:
                    edge = np.zeros(n + 1, np.int64)
                    np.add.at(edge, [x["start"] for x in found], 1)
                    np.add.at(edge, [x["stop"] for x in found], -1)
                    gone = np.cumsum(edge[:n]) > 0
                    removed, runs, kept = int(gone.sum()), int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()), raw[~gone].tobytes()
                out.append((key, n, removed, runs, hashlib.sha256(kept).hexdigest(), kept if with_kept else None))
            if out:
                kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], ["key", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return texts.join(of_text, "key", "left").select("key", "ranges", "text").mapInArrow(run, RESULT)


def remove_repeats(docs: DataFrame, p: Repeats = Repeats(), id_col: str = "doc_id", text_col: str = "text", with_kept: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) for every row; kept, the bytes that are left, only with_kept.

    A null text is empty. Texts shorter than a passage, empty ones among them, lose nothing; rows with equal texts of at
    least that length lose all. Repeated and null ids stay as they are. An empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")).withColumn("key", F.unhex(F.md5("text")))
    texts = rows.select("key", "text")
    with scratch(docs.sparkSession):
        ranges = repeated_ranges(texts, p)
        distinct = texts.groupBy("key").agg(F.first("text").alias("text"))  # one copy from each task, not all
        done = cut(_removed(distinct, ranges, with_kept), "removed", keep=True)
    return rows.select("doc_id", "key").join(done, "key").select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")
