"""Alignment of two tokenizers' tokens by a sweep over their ends.

Both tokenizers read every whole text. Each token's end, a byte offset, is an event; the events of both sides are put
together, dealt by document and sorted by offset, and one pass over each partition emits the rest: where both sides end,
a group closes; every distinct end is one link, of the two tokens that cover the bytes before it. Ends travel in blocks
of at most `block` ids of one side, since an id names its token's length; a block's place is the offset where it starts.
The pass holds a block of each side and the open group, however long a document is.

How often a pair of ids is linked is counted over the corpus; counts go to the documents in slices of at most about
`max_pairs` pairs, each broadcast to a pass over the documents' distinct pairs.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm.common import cut, spans, tasks, text_or_empty, utf8

EVENTS = "row long, doc_id long, side byte, first long, ids binary"
SWEPT = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary"
_BITS = np.int64(40)  # of an offset; the document's place in a batch stands above


@dataclass(frozen=True)
class Alignment:
    """block: ids in an event row. keep_chunks bounds a worker's cache. batch: ids that the sweep takes at a time. max_pairs: counts broadcast at a time, and held by a task before it passes them on."""

    block: int = 2048
    keep_chunks: int = 150_000
    batch: int = 150_000
    max_pairs: int = 2_000_000


# A text is cut before a blank or line feed that follows another sign. No token of either side crosses such a place: A's split
# begins a part there, and B has no piece with a blank behind another sign or with a line feed (`_Tokens` checks it).
_CHUNK = re.compile(r"[ \n]\s*\S*(?:[^\S \n]\s*\S*)*")
_WHOLE = re.compile(r"(?s).+")
# Fixed value: the split of byte-level vocabularies.
_SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_signs() -> dict[str, int]:
    """The byte that each sign of a byte-level vocabulary stands for: printable Latin-1 signs for themselves, the other bytes in order for the signs from 256."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def _encoder(path: str):
    """A function from a text to A's ids, and the tokens of all ids.

    Where the file is a byte-level model whose ids are the ranks of its merges, the library that is faster on short texts
    encodes, and the other one isn't kept in memory.
    """
    with open(path, encoding="utf-8") as f:
        held = json.load(f)
    model, split = held["model"], held["pre_tokenizer"] or {}
    vocab, merges = model["vocab"], [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    plain = held["normalizer"] is None and not model.get("dropout") and not model.get("ignore_merges") and split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex")
    if plain and sorted(vocab.values()) == list(range(len(vocab))) and all(vocab.get(x + y) == len(vocab) - len(merges) + k for k, (x, y) in enumerate(merges)):
        import tiktoken

        signs = _byte_signs()
        ranks = {bytes(signs[c] for c in t): i for t, i in vocab.items()}
        return tiktoken.Encoding("ranks", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary, sorted(vocab, key=vocab.get)
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path)
    whole.encode_special_tokens = True
    return lambda text: whole.encode(text, add_special_tokens=False).ids, [whole.id_to_token(i) or "" for i in range(whole.get_vocab_size())]


class _Tokens(dict):
    """chunk -> (A's ids, B's ids) as bytes."""

    def __init__(self, a_path: str, b_path: str, keep: int):
        from sentencepiece import SentencePieceProcessor

        self.b, self.keep = SentencePieceProcessor(model_file=b_path), keep
        self.encode, raw = _encoder(a_path)
        signs = _byte_signs()
        self.a_bytes = [bytes(signs[c] for c in t) if all(c in signs for c in t) else t.encode() for t in raw]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(t[3:5], 16)]) if self.b.is_byte(i) else t.replace("▁", " ").encode() for i, t in enumerate(pieces)]
        self.kinds = tuple(np.dtype("<u2" if len(x) <= 1 << 16 else "<u4") for x in (self.a_bytes, self.b_bytes))
        self.lengths = tuple(np.array([len(t) for t in x], np.int64) for x in (self.a_bytes, self.b_bytes))
        self.blank = self.b.piece_to_id("▁")
        plain = [t for i, t in enumerate(pieces) if not (self.b.is_control(i) or self.b.is_unknown(i) or self.b.is_byte(i))]
        self.chunk = _WHOLE if any(re.search("[^▁]▁|\n", t) for t in plain) or self.b.is_unknown(self.blank) else _CHUNK
        self.odd: set[str] = set()
        self.codes = tuple("H" if k.itemsize == 2 else "I" for k in self.kinds)

    def learn(self, chunks) -> None:
        """Ids of chunks that aren't known yet."""
        new = [c for c in chunks if c not in self]
        blank = [c[0] == " " for c in new]
        known = self.b.encode([c[1:] if k else c for c, k in zip(new, blank, strict=True)], num_threads=1)
        for c, k, b in zip(new, blank, known, strict=True):
            b = [self.blank] if c == " " else b if k else b[1:]  # B adds a blank; of a chunk without one it goes
            a, want = self.encode(c), c.encode()
            if b"".join([self.a_bytes[i] for i in a]) != want or b"".join([self.b_bytes[i] for i in b]) != want:
                self.odd.add(c)
            self[c] = array(self.codes[0], a).tobytes(), array(self.codes[1], b).tobytes()

    def of(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """Both sides' ids of blank + text, for each text; empty where a side's bytes differ from it."""
        if len(self) > self.keep:
            self.clear()
            self.odd.clear()
        split = [self.chunk.findall(" " + t) if t else [] for t in texts]
        self.learn(set(chain.from_iterable(split)))
        out = []
        for text, chunks in zip(texts, split, strict=True):
            parts = [self[c] for c in chunks]
            a, b = b"".join([p[0] for p in parts]), b"".join([p[1] for p in parts])
            if self.odd and not self.odd.isdisjoint(chunks):
                want = (" " + text).encode()
                for ids, kind, table in ((a, self.kinds[0], self.a_bytes), (b, self.kinds[1], self.b_bytes)):
                    if b"".join([table[i] for i in np.frombuffer(ids, kind)]) != want:
                        a = b = b""
                        break
            out.append((a, b))
        for c in [c for c in chain.from_iterable(split) if len(c) > 64]:
            self.pop(c, None)  # long chunks are of one text
        return out


@lru_cache(maxsize=1)
def _tokens(a_path: str, b_path: str, keep: int) -> _Tokens:
    """One cache for all tasks of a worker process."""
    return _Tokens(a_path, b_path, keep)


def events(docs: DataFrame, a_path: str, b_path: str, p: Alignment = Alignment(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, doc_id, side, first, ids): the ends of both sides' tokens (0: A, 1: B) in blocks, each with the offset where it starts. A text without tokens has an empty block."""

    def run(batches):
        tokens = _tokens(a_path, b_path, p.keep_chunks)
        for b in batches:
            data, off = utf8(b.column(2).cast(pa.large_binary()))
            for i, j in spans(off, 1 << 20):
                raws = [data[off[k] : off[k + 1]].tobytes() for k in range(i, j)]
                texts = [raw.decode("utf-8", "replace") for raw in raws]
                texts = ["" if "\ufffd" in t and t.encode() != raw else t for t, raw in zip(texts, raws, strict=True)]
                out: list[tuple[int, int | None, int, int, bytes]] = []
                for sides, doc, row in zip(tokens.of(texts), b.column(0).slice(i, j - i).to_pylist(), b.column(1).slice(i, j - i).to_pylist(), strict=True):
                    if not sides[0]:
                        out.append((row, doc, 0, 0, b""))
                        continue
                    for side, ids in enumerate(sides):
                        kind, first = tokens.kinds[side], 0
                        step = p.block * kind.itemsize
                        for at in range(0, len(ids), step):
                            out.append((row, doc, side, first, ids[at : at + step]))
                            if at + step < len(ids):
                                first += int(tokens.lengths[side][np.frombuffer(out[-1][4], kind)].sum())
                cols = list(zip(*out, strict=True))
                kinds = (pa.int64(), pa.int64(), pa.int8(), pa.int64(), pa.binary())
                yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], ["row", "doc_id", "side", "first", "ids"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.monotonically_increasing_id().alias("row"), text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(run, EVENTS)


def _digits(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of all ids with room for a sign behind them, and how many there are."""
    n = np.arange(size)
    count = np.ones(size, np.int64)
    for k in range(1, 10):
        count += n >= 10**k
    out = np.zeros((size, 11), np.uint8)
    for k in range(int(count.max())):
        has = count > k
        out[has, k] = n[has] // 10 ** (count[has] - 1 - k) % 10 + 48
    return out[:, : int(count.max()) + 1], count


def packed(pairs: np.ndarray, times: np.ndarray) -> bytes:
    """Rising pairs and how often each is linked."""
    planes = np.diff(pairs, prepend=0).astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes() + times.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return zstandard.compress(planes, 1)


def unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(zstandard.decompress(blob), np.uint8)
    n = len(raw) // 12
    column = lambda x, kind: np.ascontiguousarray(x.reshape(np.dtype(kind).itemsize, n).T).view(kind).ravel()
    return np.cumsum(column(raw[: 8 * n], "<i8")), column(raw[8 * n :], "<u4").astype(np.int64)


@dataclass
class _Open:
    """A document whose events haven't ended: the ids behind its last group, per side, the offset where they start, and its groups' hash so far."""

    row: int
    doc: int | None
    ids: tuple[np.ndarray, np.ndarray]
    at: int
    sha: object | None


def _distinct(rising: np.ndarray) -> np.ndarray:
    return rising[np.concatenate([[True], rising[1:] != rising[:-1]])] if len(rising) else rising


class _Sweep:
    def __init__(self, tokens: _Tokens):
        self.lengths, self.kinds = tokens.lengths, tokens.kinds
        self.size_b = len(tokens.b_bytes)
        self.digits, self.n_digits = _digits(max(len(tokens.a_bytes), self.size_b))
        self.open: _Open | None = None

    def _ends(self, side: int, place: np.ndarray, first: np.ndarray, ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of one side and their ends, with the document's place above the offset."""
        count = np.array([len(x) for x in ids], np.int64)
        flat = np.concatenate([np.zeros(0, np.int64), *ids]).astype(np.int64)
        total = np.cumsum(self.lengths[side][flat])
        before = np.concatenate([[0], total])[np.cumsum(count) - count]
        return flat, np.repeat((place << _BITS) + first - before, count) + total

    def take(self, row: np.ndarray, doc: list[int | None], side: np.ndarray, first: np.ndarray, ids: list[np.ndarray], last: bool) -> pa.RecordBatch | None:
        """Sweep over these blocks; with last, no more of their last document come."""
        held = self.open
        if held:
            row, doc = np.concatenate([[held.row] * 2, row]), [held.doc, held.doc, *doc]
            side, first, ids = np.concatenate([[0, 1], side]), np.concatenate([[held.at] * 2, first]), [*held.ids, *ids]
        if not len(row):
            return None
        new = np.concatenate([[True], row[1:] != row[:-1]])
        place, starts = np.cumsum(new) - 1, np.flatnonzero(new)
        n_docs = len(starts)
        flat, ends = [], []
        for s in (0, 1):
            mine = np.flatnonzero(side == s)
            f, e = self._ends(s, place[mine].astype(np.int64), first[mine].astype(np.int64), [ids[k] for k in mine])
            flat.append(f)
            ends.append(e)
        self.open = None
        if not last:
            begun = np.int64(n_docs - 1) << _BITS
            tail = [e[np.searchsorted(e, begun, "right") :] for e in ends]
            shared = np.intersect1d(*tail, assume_unique=True)
            close = int(shared[-1]) if len(shared) else int(begun) + (held.at if held and n_docs == 1 else 0)
            upto = [int(np.searchsorted(e, close, "right")) for e in ends]
            at = close - int(begun)
            self.open = _Open(int(row[-1]), doc[int(starts[-1])], (flat[0][upto[0] :], flat[1][upto[1] :]), at, held.sha if held and n_docs == 1 else None)
            flat, ends = [f[:u] for f, u in zip(flat, upto, strict=True)], [e[:u] for e, u in zip(ends, upto, strict=True)]
        return self._told(flat, ends, row[starts], [doc[k] for k in starts], held.sha if held else None, last)

    def _told(self, flat, ends, rows, docs, sha, last: bool) -> pa.RecordBatch:
        n_docs = len(rows)
        every = _distinct(np.sort(np.concatenate(ends), kind="stable"))  # two sorted runs
        at = [np.searchsorted(every, e) for e in ends]
        is_end = [np.zeros(len(every), bool) for _ in ends]
        for flag, k in zip(is_end, at, strict=True):
            flag[k] = True
        both = is_end[0] & is_end[1]
        token = [np.cumsum(f) - f for f in is_end]
        group = np.cumsum(both) - both
        of_doc = every >> _BITS
        count = lambda where: np.bincount(where, minlength=n_docs)
        n_links, n_groups = count(of_doc), count(of_doc[both])
        # pairs
        space = np.int64(len(self.lengths[0])) * self.size_b
        linked = np.sort(of_doc * space + flat[0][token[0]] * self.size_b + flat[1][token[1]])
        key = _distinct(linked)
        times = np.diff(np.searchsorted(linked, key), append=len(linked))
        cuts = np.searchsorted(key, np.arange(n_docs + 1, dtype=np.int64) * space)
        # the groups' text: ids in the order of groups, A before B, each with the sign behind it
        of_group = [group[k] for k in at]
        per = [np.bincount(g, minlength=int(both.sum())) for g in of_group]
        upto = [np.concatenate([[0], np.cumsum(x)]) for x in per]
        order = np.empty(len(flat[0]) + len(flat[1]), np.int64)
        sign = np.full(len(order), ord(","), np.uint8)
        spot = (np.arange(len(flat[0])) + upto[1][of_group[0]], np.arange(len(flat[1])) + upto[0][of_group[1] + 1])
        for s, mark in ((0, "|"), (1, ";")):
            order[spot[s]] = flat[s]
            sign[spot[s][both[at[s]]]] = ord(mark)
        wide = self.n_digits[order]
        shown = self.digits[order]
        shown[np.arange(len(order)), wide] = sign
        text = shown[np.arange(shown.shape[1]) <= wide[:, None]]
        bounds = np.concatenate([[0], np.cumsum(wide + 1)])
        n_a, n_b = count(ends[0] >> _BITS), count(ends[1] >> _BITS)
        bounds = bounds[np.concatenate([[0], np.cumsum(n_a + n_b)])]
        hashes: list[str | None] = []
        for k in range(n_docs):
            piece = text[bounds[k] : max(bounds[k], bounds[k + 1] - 1)].tobytes()  # without the last sign
            h = sha if k == 0 else None
            if piece:
                if h is None:
                    h = hashlib.sha256()
                else:
                    h.update(b";")
                h.update(piece)
            if k == n_docs - 1 and not last:
                self.open.sha = h
                hashes.append(None)
            else:
                hashes.append(h.hexdigest() if h else "")
        blobs = [packed(key[i:j] - k * space, times[i:j]) for k, (i, j) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))]
        cols = [pa.array(rows.astype(np.int64)), pa.array(docs, pa.int64()), *[pa.array(x.astype(np.int64)) for x in (n_a, n_b, n_groups, n_links)], pa.array(hashes, pa.string()), pa.array(blobs, pa.binary())]
        return pa.record_batch(cols, ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs"])


def sweep(ends: DataFrame, a_path: str, b_path: str, p: Alignment = Alignment()) -> DataFrame:
    """SWEPT of events: a document's counts and pairs, in a row or several; its last row has the hash of its groups."""

    def run(batches):
        tokens = _tokens(a_path, b_path, p.keep_chunks)
        state = _Sweep(tokens)
        for b in batches:
            if not b.num_rows:
                continue
            row, side, first = (b.column(k).to_numpy() for k in (0, 2, 3))
            doc = b.column(1).to_pylist()
            data, off = utf8(b.column(4))
            for i, j in spans(off, p.batch * tokens.kinds[0].itemsize):
                ids = [np.frombuffer(data[off[k] : off[k + 1]].tobytes(), tokens.kinds[side[k]]) for k in range(i, j)]
                yield state.take(row[i:j], doc[i:j], side[i:j], first[i:j], ids, False)
        none = np.zeros(0, np.int64)
        if (end := state.take(none, [], none, none, [], True)) is not None:
            yield end

    dealt = ends.repartition(tasks(ends.sparkSession), "row").sortWithinPartitions("row", "first", "side")
    return dealt.mapInArrow(run, SWEPT)


def pair_counts(swept: DataFrame, size_b: int, p: Alignment = Alignment()) -> DataFrame:
    """(pair, n, best): how often the ids of pair = A * size_b + B are linked, and whether no pair of that B is linked more often."""

    def run(batches):
        keys, n = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def told():
            return pa.record_batch([pa.array(keys), pa.array(n)], ["pair", "n"])

        for b in batches:
            blobs = b.column(0).to_pylist()
            for i in range(0, len(blobs), 1000):
                got = [unpacked(x) for x in blobs[i : i + 1000]]
                keys, at = np.unique(np.concatenate([keys, *[k for k, _ in got]]), return_inverse=True)
                more = np.zeros(len(keys), np.int64)
                np.add.at(more, at, np.concatenate([n, *[t for _, t in got]]))
                n = more
                if len(keys) > p.max_pairs:
                    yield told()
                    keys, n = keys[:0], n[:0]
        if len(keys):
            yield told()

    total = swept.select("pairs").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    total = cut(total, "pairs").withColumn("b", F.col("pair") % size_b)
    most = total.groupBy("b").agg(F.max("n").alias("most"))
    return total.join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _with_counts(swept: DataFrame, part: DataFrame, first: bool) -> DataFrame:
    """swept with n_best and count_sum over the pairs of part; but for the first part, the other numbers are 0."""
    got = part.toArrow().sort_by("pair")  # about max_pairs rows
    held = swept.sparkSession.sparkContext.broadcast(tuple(got.column(c).to_numpy() for c in ("pair", "n", "best")))

    def run(batches):
        keys, n, best = held.value
        worth = np.concatenate([n, [0]])
        top = np.concatenate([best, [False]])
        for b in batches:
            sums = []
            for blob in b.column(7).to_pylist():
                pairs, times = unpacked(blob)
                at = np.minimum(np.searchsorted(keys, pairs), max(0, len(keys) - 1))
                at = np.where(keys[at] == pairs, at, len(keys)) if len(keys) else np.zeros(len(pairs), np.int64)
                sums.append((int(times[top[at]].sum()), int((times * worth[at]).sum())))
            kept = [b.column(k) if first or k < 2 or k == 6 else pa.array(np.zeros(b.num_rows, np.int64)) for k in range(7)]
            yield pa.record_batch([*kept, pa.array([s[0] for s in sums], pa.int64()), pa.array([s[1] for s in sums], pa.int64())], [*b.schema.names[:7], "n_best", "count_sum"])

    return swept.mapInArrow(run, SWEPT.replace("pairs binary", "n_best long, count_sum long"))


def align(docs: DataFrame, a_path: str, b_path: str, p: Alignment = Alignment(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for every row.

    Null and empty texts, and those that a side's tokens don't give back byte by byte, have no tokens: zeros and ''.
    Repeated rows count each on its own; a null id stays null. An empty table gives an empty result.
    """
    swept = cut(sweep(events(docs, a_path, b_path, p, id_col, text_col), a_path, b_path, p), "swept")
    counts = cut(pair_counts(swept, _size(b_path), p), "counts")
    slices = max(1, -(-counts.count() // p.max_pairs))
    told: DataFrame | None = None
    for k in range(slices):
        part = counts.where(F.pmod(F.xxhash64("pair"), F.lit(slices)) == k)
        more = _with_counts(swept, part, k == 0)
        told = more if told is None else told.unionByName(more)
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    whole = told.groupBy("row", "doc_id").agg(*[F.sum(c).alias(c) for c in names], F.max("groups_sha256").alias("groups_sha256"))
    return whole.select("doc_id", *names, "groups_sha256")


def _size(b_path: str) -> int:
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=b_path).get_piece_size()
