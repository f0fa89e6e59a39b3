"""I-Match fingerprints.

Terms are lower-cased words. Their document frequencies are counted over all documents, and the lexicon is the band of
terms that stand in a share `rare` to `common` of them: below are misspellings, names and numbers, above the words that
all texts share. Since a term of the band stands in `rare` of all documents at least, the lexicon has at most (distinct
terms a document) / rare terms, whatever the input.

Randomised lexicons are subsets of it. There are `lexicons` random orders of the terms; of each, level l keeps a share
`keep` / 2**l, so level 0 keeps most of the lexicon, as I-Match with random lexicons does. A fingerprint has, for each of
these lexicons, the hash of all sorted distinct terms of the document that it holds. A large lexicon tells copies and
small edits, and changes with any longer edit; the smaller ones resolve those. Likeness is the largest share of equal
hashes that a level has, of levels at which at least half of the lexicons hold a term of one of the two documents.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm.common import U64, mix, spans, tasks, text_or_empty, utf8
from skyloom.llm.words import word_bounds, word_hashes

BYTES_AT_ONCE = 2 << 20
NONE = "----"


@dataclass(frozen=True)
class IMatch:
    """rare, common: the band of document frequency, as shares of all documents; a term of a single document is never in it. lexicons: random orders. levels, keep: sizes of the lexicons of each. max_terms: a larger lexicon is an error, since every task holds it."""

    rare: float = 0.0005
    common: float = 0.02
    lexicons: int = 12
    levels: int = 10
    keep: float = 2 / 3
    max_terms: int = 1 << 22
    seed: int = 11


def _terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct term hashes with their rows, in the order of (row, hash)."""
    s, e, row = word_bounds(data, offsets)
    h = word_hashes(data, s, e)
    at = np.lexsort((h, row))
    h, row = h[at], row[at]
    first = np.ones(len(h), bool)
    first[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return h[first], row[first]


def document_frequency(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(term, n): documents that each term, by its hash, stands in; over all rows."""

    def run(batches):
        terms, counts = [], []

        def merged():
            t, at = np.unique(np.concatenate(terms), return_inverse=True)
            return t, np.bincount(at, np.concatenate(counts)).astype(np.int64)

        for b in batches:
            data, off = utf8(b.column(0))
            for i, j in spans(off, BYTES_AT_ONCE):
                t, n = np.unique(_terms(data[off[i] : off[j]], off[i : j + 1] - off[i])[0], return_counts=True)
                terms.append(t)
                counts.append(n)
                if sum(len(x) for x in terms[1:]) > 1 << 20:
                    t, n = merged()
                    terms, counts = [t], [n]
                    if len(t) > 1 << 21:  # what a task holds is bounded
                        yield pa.record_batch([pa.array(t.view(np.int64)), pa.array(n)], ["term", "n"])
                        terms, counts = [], []
        if terms:
            t, n = merged()
            yield pa.record_batch([pa.array(t.view(np.int64)), pa.array(n)], ["term", "n"])

    return docs.select(text_or_empty(text_col).alias("text")).mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))


def lexicon(docs: DataFrame, p: IMatch = IMatch(), text_col: str = "text") -> np.ndarray:
    """The sorted hashes of the band's terms."""
    rows = docs.count()
    band = document_frequency(docs, text_col).where(F.col("n").between(max(2.0, p.rare * rows), max(2.0, p.common * rows))).select("term")
    got = band.limit(p.max_terms + 1).toArrow().column("term").to_numpy()
    if len(got) > p.max_terms:
        raise ValueError(f"more than {p.max_terms} terms in the band; raise rare")
    return np.sort(got.astype(np.int64).view(np.uint64))


def fingerprints(data: np.ndarray, offsets: np.ndarray, held: np.ndarray, p: IMatch) -> list[str]:
    """For each row lexicons * levels hashes of 4 hex digits, level by level, NONE where a lexicon holds none of its terms.

    A document without a term of the band has "=" and a hash of its whole text, so it is like equal texts alone.
    """
    rows = len(offsets) - 1
    t, row = _terms(data, offsets)
    if len(held):
        at = np.minimum(np.searchsorted(held, t), len(held) - 1)
        t, row = t[held[at] == t], row[held[at] == t]
    else:
        t, row = t[:0], row[:0]
    first = np.searchsorted(row, np.arange(rows))
    some = np.bincount(row, minlength=rows) > 0
    edge = first[some]
    out = np.full((p.levels, p.lexicons, rows), NONE, "U4")
    limits = [U64(int(p.keep * 2.0**-level * 2.0**64)) for level in range(p.levels)]
    digits = np.array([f"{v:04x}" for v in range(1 << 16)])
    for k in range(p.lexicons):
        with np.errstate(over="ignore"):
            place = mix(t ^ mix(np.array([p.seed * 1000 + k + 1], np.uint64))[0])  # a term's place in this order
            name = mix(place * U64(0x9E3779B97F4A7C15) + U64(1))
            for level, limit in enumerate(limits):
                inside = place < limit
                if not inside.any():
                    break
                # terms are distinct and sorted, so a sum of their mixed names stands for the sorted list
                total = mix(np.add.reduceat(np.where(inside, name, U64(0)), edge)) >> U64(48)
                any_in = np.logical_or.reduceat(inside, edge)
                out[level, k, some] = np.where(any_in, digits[total.astype(np.int64)], NONE)
    joined = ["".join(x) for x in out.reshape(-1, rows).T.tolist()]
    return [joined[i] if some[i] else "=" + hashlib.sha256(data[offsets[i] : offsets[i + 1]].tobytes()).hexdigest()[:32] for i in range(rows)]


def likeness(a: str, b: str, p: IMatch) -> float:
    """The largest share of equal hashes of a level, of those at which half of the lexicons hold a term; of the first level where none is so. Equal fingerprints have 1."""
    if a == b:
        return 1.0
    if a[:1] == "=" or b[:1] == "=":
        return 0.0
    width = 4 * p.lexicons
    best = 0.0
    for level in range(p.levels):
        x, y = a[level * width : (level + 1) * width], b[level * width : (level + 1) * width]
        told = equal = 0
        for k in range(0, width, 4):
            u, v = x[k : k + 4], y[k : k + 4]
            if u != NONE or v != NONE:
                told += 1
                equal += u == v
        if equal and (2 * told >= p.lexicons or level == 0):
            best = max(best, equal / told)
    return best


def _with_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(part, place, id, text): rows in parts by ascending id, each part followed by the first row of the next part as its guest (place 1), the last one by the first row of all.

    Parts are bounded by quantiles of the ids; rows of equal id stay together, in the order of their texts.
    """
    spark = docs.sparkSession
    n = tasks(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    bounds = sorted(set(rows.agg(F.percentile_approx("id", [k / n for k in range(1, n)], 10_000)).first()[0] or [])) if n > 1 else []
    edges = np.array(bounds, np.int64)

    @F.arrow_udf("int")
    def part_of(ids: pa.Array) -> pa.Array:
        i = np.asarray(ids.fill_null(-(1 << 63)))
        return pa.array(np.searchsorted(edges, i, "right").astype(np.int32))

    part, name = part_of("id"), F.xxhash64("text")
    firsts = rows.select("id", name.alias("h")).select(part.alias("part"), "id", "h").groupBy("part").agg(F.min(F.struct("id", "h")).alias("first")).collect()  # one row for each part
    order = sorted(firsts, key=lambda r: r.part)
    hosts = {(r["first"].id, r["first"].h): order[i - 1].part for i, r in enumerate(order)}

    @F.arrow_udf("int")
    def host_of(ids: pa.Array, h: pa.Array) -> pa.Array:
        return pa.array([hosts.get(x) for x in zip(ids.to_pylist(), h.to_pylist(), strict=True)], pa.int32())

    rows = rows.select("id", "text", name.alias("h")).select("id", "text", part.alias("own"), host_of("id", "h").alias("host"))
    part, host = F.col("own"), F.col("host")
    places = F.when(host.isNull(), F.array(F.struct(part.alias("part"), F.lit(0).alias("place")))).otherwise(F.array(F.struct(part.alias("part"), F.lit(0).alias("place")), F.struct(host.alias("part"), F.lit(1).alias("place"))))
    return rows.select(F.explode(places).alias("at"), "id", "text").select("at.part", "at.place", "id", "text")


def edited_fingerprints(docs: DataFrame, p: IMatch = IMatch(), id_col: str = "doc_id", text_col: str = "text", share: int = 4) -> DataFrame:
    """For every row its fingerprint and that of the edited text, whose last floor(n/share) characters are replaced by the first as many of the next row by id.

    Null, empty and wordless texts have the fingerprint of a text without terms of the band. Rows of equal id follow one another in the order of a hash of
    their texts; a null id comes first. A single row is its own next. An empty table gives an empty result.
    """
    held = docs.sparkSession.sparkContext.broadcast(lexicon(docs, p, text_col))  # at most max_terms hashes
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

    def made(texts: list[str]) -> list[str]:
        raw = [x.encode() for x in texts]
        off = np.concatenate([[0], np.cumsum([len(x) for x in raw])])
        return fingerprints(np.frombuffer(b"".join(raw), np.uint8), off, held.value, p)

    def told(rows: list[tuple[int | None, str, str]]) -> pa.RecordBatch:
        """Of rows with the part of the next text that they need; the last one is a successor only, and its own text whole."""
        ids, texts, heads = zip(*rows, strict=True)
        edited = [t[: len(t) - len(t) // share] + h for t, h in zip(texts, heads, strict=True)][:-1]
        own, changed = made(list(texts)), made(edited)
        return pa.record_batch([
            pa.array(ids[:-1], pa.int64()), pa.array([len(t) for t in texts[:-1]], pa.int64()), pa.array([hashlib.sha256(x.encode()).hexdigest() for x in edited], pa.string()), pa.array(own[:-1], pa.string()), pa.array(changed, pa.string()),
            pa.array([likeness(a, b, p) for a, b in zip(own, changed, strict=False)], pa.float64()), pa.array([likeness(a, b, p) for a, b in zip(own, own[1:], strict=False)], pa.float64())],
            ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    def run(batches):
        held_rows: list[tuple[int, int | None, str]] = []
        size = 0

        def out():
            return told([(i, t, n[2][: len(t) // share]) for (_, i, t), n in zip(held_rows, [*held_rows[1:], (0, None, "")], strict=True)])

        for b in batches:
            for part, place, i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3), strict=True):
                if held_rows and held_rows[-1][0] != part:
                    held_rows, size = [], 0
                t = t.as_py()
                held_rows.append((part, i, t))
                size += len(t)
                if len(held_rows) > 1 and (place or size > BYTES_AT_ONCE or len(held_rows) > 4096):
                    yield out()
                    held_rows, size = ([] if place else held_rows[-1:]), 0 if place else len(t)

    laid = _with_next(docs, id_col, text_col).repartitionById(tasks(docs.sparkSession), F.col("part")).sortWithinPartitions("part", "place", "id", F.xxhash64("text"))
    return laid.mapInArrow(run, schema)
