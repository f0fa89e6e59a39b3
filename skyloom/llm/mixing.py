"""Mixing to target weights with soft membership. DataFrame functions only.

A naive-Bayes table over hashed words, counted on labelled rows, gives each document a posterior over domains.
Nonnegative rates r_i are then fitted so that sum_i tokens_i * p_id * r_i meets the target of each domain d, by
projected gradient on least squares: with totals n_d = sum_i tokens_i * p_id and residuals
e_d = (sum_i tokens_i * p_id * r_i) / n_d - target_d / n_d, a step is r_i <- max(0, r_i - sum_d p_id * e_d). Rows of p sum to
one, so a step of 1 converges. Without given targets no rate is below 1: goals rise until the fit needs none, and steps
end at 1 instead of 0. A rate depends on its row's posterior and the residuals so far alone; each round
is one aggregate of as many sums as there are domains over a narrow table.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.llm.common import cut, text_or_empty, unused


@dataclass(frozen=True)
class Mixing:
    """max_labelled bounds the labelled rows of the classifier. evidence: how many words a text counts as at most, which keeps memberships soft. power: default targets are shares to this power, raised so that no document shrinks; growth: by so much at most beyond the least total at which no domain shrinks. replayed: rates are written after so many rounds."""

    buckets: int = 2048
    max_labelled: int = 5000
    evidence: float = 8.0
    smoothing: float = 0.5
    power: float = 0.7
    growth: float = 2.0
    rounds: int = 40
    tolerance: float = 1e-3
    replayed: int = 10
    max_domains: int = 64


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def _bucket(word: Column, p: Mixing) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(p.buckets)).cast("int")


def word_table(docs: DataFrame, labelled: DataFrame, p: Mixing, id_col: str, text_col: str, domain_col: str) -> dict[str, tuple[float, list[float]]]:
    """For each domain its log share and the log frequency of each bucket, from labelled rows; at most domains * buckets numbers."""
    ids = labelled.select(F.col(id_col).cast("long").alias("id")).where("id is not null").distinct()
    share = int(min(1.0, p.max_labelled / max(1, ids.count())) * 1_000_000)
    ids = ids.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < share)  # max_labelled rows or so, whatever the input
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(domain_col).cast("string").alias("domain"), text_or_empty(text_col).alias("text")).where("domain is not null").join(F.broadcast(ids), "id")
    if rows.select("domain").distinct().limit(p.max_domains + 1).count() > p.max_domains:  # before anything is gathered
        raise ValueError(f"more than {p.max_domains} domains")
    counts = rows.select("domain", F.explode(_words(F.col("text"))).alias("w")).groupBy("domain", _bucket(F.col("w"), p).alias("b")).count().collect()
    domains = sorted({r.domain for r in counts})
    table = {}
    whole = sum(r["count"] for r in counts)
    for d in domains:
        n = [p.smoothing] * p.buckets
        for r in counts:
            if r.domain == d:
                n[r.b] += r["count"]
        total = sum(n)
        table[d] = (math.log(total / (whole + p.smoothing * p.buckets * len(domains))), [math.log(x / total) for x in n])
    return table


def _numbers(x: list[float]) -> Column:
    return F.split(F.lit(",".join(f"{v:.6g}" for v in x)), ",").cast("array<double>")  # folds to a literal


def _let(value: Column, body) -> Column:
    """body(value), with value computed once a row."""
    return F.get(F.transform(F.array(value), body), 0)


def memberships(text: Column, table: dict[str, tuple[float, list[float]]], p: Mixing) -> Column:
    """struct(tokens, post): the number of words, and posteriors in the table's order. Without words the posterior is the domains' shares."""
    logs = [_numbers(v) for _, v in table.values()]
    names = [f"s{i}" for i in range(len(logs))]
    zero = F.struct(*[F.lit(0.0).alias(s) for s in names])
    add = lambda acc, w: F.struct(*[(acc[s] + F.get(v, w)).alias(s) for s, v in zip(names, logs, strict=True)])
    tame = lambda n: F.greatest(F.lit(1.0), n / F.lit(p.evidence))

    def of(words: Column) -> Column:
        sums = F.aggregate(words, zero, lambda acc, w: _let(_bucket(w, p), lambda i: add(acc, i)))
        z = _let(sums, lambda a: F.array(*[a[s] / tame(F.size(words)) + F.lit(prior) for s, (prior, _) in zip(names, table.values(), strict=True)]))
        e = _let(z, lambda v: _let(F.array_max(v), lambda top: F.transform(v, lambda x: F.exp(x - top))))
        post = _let(e, lambda v: _let(F.aggregate(v, F.lit(0.0), lambda a, x: a + x), lambda total: F.transform(v, lambda x: x / total)))
        return F.struct(F.size(words).cast("long").alias("tokens"), post.alias("post"))

    return _let(_words(F.coalesce(text.cast("string"), F.lit(""))), of)


def rate(post: Column, history: list[list[float]], floor: float = 0.0, start: Column | None = None) -> Column:
    """r after the rounds whose residuals are given, floor or more; start is r before them, 1 where it isn't given."""
    start = F.lit(1.0) if start is None else start
    if not history:
        return start
    width = len(history[0])
    steps = F.transform(F.sequence(F.lit(0), F.lit(len(history) - 1)), lambda k: F.slice(_numbers([v for e in history for v in e]), k * width + 1, width))
    dot = lambda e: sum((post[i] * e[i] for i in range(width)), F.lit(0.0))
    return F.aggregate(steps, start, lambda r, e: F.greatest(F.lit(floor), r - dot(e)))


@dataclass(frozen=True)
class Fitted:
    table: dict[str, tuple[float, list[float]]]
    totals: list[float]
    targets: list[float]
    history: list[list[float]]
    reached: list[float]
    floor: float = 0.0  # no rate is below


def fit(docs: DataFrame, labelled: DataFrame, p: Mixing = Mixing(), targets: dict[str, float] | None = None, id_col: str = "doc_id", text_col: str = "text", domain_col: str = "lang") -> tuple[Fitted, DataFrame]:
    """The fitted mix, and (doc_id, tokens, post) per row. targets: weights by domain; a missing domain gets 0."""
    table = word_table(docs, labelled, p, id_col, text_col, domain_col)
    if not table:
        return Fitted({}, [], [], [], []), docs.select(F.col(id_col).cast("long").alias("doc_id"), F.size(_words(text_or_empty(text_col))).cast("long").alias("tokens"), F.array().cast("array<double>").alias("post"))
    rows = cut(docs.select(F.col(id_col).cast("long").alias("doc_id"), memberships(F.col(text_col), table, p).alias("m")).select("doc_id", "m.tokens", "m.post"), "posteriors")
    width = range(len(table))
    gathered = lambda at, r: [x or 0.0 for x in at.agg(*[F.sum(F.col("tokens") * F.col("post")[i] * r).alias(f"n{i}") for i in width]).first()]
    n = [max(x, 1e-9) for x in gathered(rows, F.lit(1.0))]
    weight = [targets.get(d, 0.0) for d in table] if targets else [(x / sum(n)) ** p.power for x in n]
    weight = [w / sum(weight) for w in weight]
    total = sum(n) if targets else max(x / w for x, w in zip(n, weight, strict=True))
    goal = [w * total for w in weight]

    def descend(goal: list[float], floor: float) -> tuple[list[list[float]], list[float]]:
        history: list[list[float]] = []
        got, at, done = n, rows.withColumn("r", F.lit(1.0)), 0
        while len(history) < p.rounds:
            e = [(g - t) / x for g, t, x in zip(got, goal, n, strict=True)]
            if max(abs(v) for v in e) < p.tolerance:
                break
            if len(history) - done >= p.replayed:  # a round replays the few before it, not all
                at, done = cut(at.select("tokens", "post", rate(F.col("post"), history[done:], floor, F.col("r")).alias("r")), "rates"), len(history)
            history.append(e)
            got = gathered(at, rate(F.col("post"), history[done:], floor, F.col("r")))
        return history, got

    history, got = descend(goal, 0.0)
    if targets:
        return Fitted(table, n, goal, history, got), rows
    # soft memberships of repeated documents fill the largest domain beyond its goal, so its own documents would shrink
    least = rows.agg(F.min(rate(F.col("post"), history))).first()[0]
    if least is not None and least < 1:
        goal = [g * min(p.growth, 1 / max(least, 1e-9)) for g in goal]
        history, got = descend(goal, 1.0)
    return Fitted(table, n, goal, history, got, 1.0), rows


def copies(key: Column, r: Column) -> Column:
    """How often a document is taken: the whole part of its rate, and once more with the rest as probability, decided by a hash of key."""
    draw = F.pmod(F.xxhash64(key, F.lit("mix")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    whole = F.floor(r + 1e-9)
    return (whole + F.when(draw < r - whole, 1).otherwise(0)).cast("int")


def mix(docs: DataFrame, labelled: DataFrame, p: Mixing = Mixing(), targets: dict[str, float] | None = None, id_col: str = "doc_id", text_col: str = "text", domain_col: str = "lang") -> DataFrame:
    """docs with each row repeated as often as its rate says; null and empty texts are taken like others. Without labelled rows docs stay as they are."""
    fitted, _ = fit(docs, labelled, p, targets, id_col, text_col, domain_col)
    if not fitted.table:
        return docs
    own, copy = unused(docs, "__post"), unused(docs, "__copy")
    post = memberships(F.col(text_col), fitted.table, p)["post"]
    times = copies(F.coalesce(F.col(id_col).cast("string"), F.col(text_col), F.lit("")), rate(F.col(own), fitted.history, fitted.floor))
    # the posterior is computed once, below the explode that repeats rows
    return docs.withColumn(own, post).withColumn(copy, F.explode(F.array_repeat(F.lit(0), times))).select(*docs.columns)


def rates(docs: DataFrame, labelled: DataFrame, p: Mixing = Mixing(), targets: dict[str, float] | None = None, id_col: str = "doc_id", text_col: str = "text", domain_col: str = "lang") -> DataFrame:
    """(doc_id, tokens, domain, membership, rate, copies) per row; domain is the likeliest one, the first by name of equally likely ones.

    Null, empty and wordless texts have 0 tokens and the domains' shares as membership. Repeated rows have equal rates;
    rows without id are all drawn alike. Without labelled rows the domain is null and every rate is 1. An empty table
    gives an empty result.
    """
    fitted, rows = fit(docs, labelled, p, targets, id_col, text_col, domain_col)
    names = F.array(*[F.lit(d) for d in fitted.table]) if fitted.table else F.array().cast("array<string>")
    best = F.get(names, (F.array_position("post", F.array_max("post")) - 1).cast("int"))
    r = rate(F.col("post"), fitted.history, fitted.floor)
    out = rows.select("doc_id", "tokens", best.alias("domain"), F.array_max("post").alias("membership"), r.alias("rate"))
    return out.withColumn("copies", copies(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("rate")))
