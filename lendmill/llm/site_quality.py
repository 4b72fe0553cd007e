"""Quality classifier: document evidence combined with host and path posteriors.

Evidence of a document is the sum of its tokens' weights for two faults, low quality and toxic,
learnt from a bounded sample of labelled documents. Tokens are the words of the
whole text (present or not) and binned shape measures (share of capitals, marks, repeated words
and so on). Tokens whose association with a fault is beyond chance are candidates; a logistic
regression with an L1 penalty (follow-the-regularised-leader) weighs them together, so that words
which only accompany a telling word in copies of one text get no weight. The sums are calibrated
by a one-dimensional logistic fit on sample documents left out.

Every document's probability of a fault then enters grouped sums per host and per path. A host's
rate is shrunk toward the global rate, a path's toward its host's, with strengths estimated from
the spread of the rates (beta-binomial, method of moments); the document's odds are re-based from
the global rate to its path's.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendmill.llm import arrays, runtime
from lendmill.session import materialize

SAMPLE_LABELS = 20_000
MODEL_TOKENS = 20_000
LEAST_DOCS = 5
LEAST_GAIN = 16.0
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.3, 1.0, 1.0, 0.5
NULL_ID = -(1 << 63)
SHAPES = 10
# Measures are put into bins of equal width on a logarithmic scale.
BINS = 24


@dataclass(frozen=True)
class Evidence:
    """Tokens in ascending order with their two weights; slope and offset of each fault's calibration."""

    tokens: np.ndarray = field(repr=False)
    ratios: np.ndarray = field(repr=False)
    slope: tuple[float, float] = (1.0, 1.0)
    offset: tuple[float, float] = (0.0, 0.0)


def _counted(data: np.ndarray, wanted: bytes, offsets: np.ndarray) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(wanted)] = True
    upto = np.concatenate([[0], np.cumsum(table[data])])
    return np.diff(upto[offsets])


_UPPER, _LETTER = bytes(range(65, 91)), bytes([*range(65, 91), *range(97, 123), *range(128, 256)])


def _tokens(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, distinct token hashes text by text, bounds) of each slice."""
    for row, end, data, offsets in arrays.slices(texts):
        low = arrays.LOWER[data]
        starts, ends, first = arrays.word_spans(low, offsets, arrays.ALNUM)
        words = arrays.word_hashes(low, starts, ends)
        owner, _ = arrays.numbering(first)
        order = np.lexsort((words, owner))
        words, owner = words[order], owner[order]
        new = np.ones(len(words), bool)
        new[1:] = (words[1:] != words[:-1]) | (owner[1:] != owner[:-1])
        words, owner = words[new], owner[new]
        n, size = np.diff(first), np.maximum(np.diff(offsets), 1)
        distinct = np.diff(np.searchsorted(owner, np.arange(end - row + 1)))
        letters = np.maximum(_counted(data, _LETTER, offsets), 1)
        measures = [
            _counted(data, _UPPER, offsets) / letters, _counted(data, b"!", offsets) / size, _counted(data, b"|", offsets) / size,
            _counted(data, b"#$%&*+=<>@^_~", offsets) / size, _counted(data, b"0123456789", offsets) / size, _counted(data, b"\n", offsets) / size,
            _counted(data, b".,;:?", offsets) / size, 1 - distinct / np.maximum(n, 1), _counted(data, _LETTER, offsets) / size,
            np.minimum(letters / np.maximum(n, 1), 64) / 64,
        ]
        bins = np.stack([np.minimum(np.log2(1 + m * 4095) * 2, BINS - 1).astype(np.uint64) for m in measures], axis=1)
        shape = arrays.mix(np.arange(SHAPES, dtype=np.uint64)[None, :] * np.uint64(BINS) + bins + np.uint64(1 << 40))
        tokens = np.concatenate([words, shape.reshape(-1)])
        owner = np.concatenate([owner, np.repeat(np.arange(end - row), SHAPES)])
        order = np.argsort(owner, kind="stable")
        yield row, tokens[order], np.searchsorted(owner[order], np.arange(end - row + 1))


def _token_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, quality, toxic) to (token, n, junk, toxic): documents with the token, by fault."""
    for batch in batches:
        faults = [batch.column(1).to_numpy().astype(np.int64), batch.column(2).to_numpy().astype(np.int64)]
        for row, tokens, bounds in _tokens(arrays.text_array(batch.column(0))):
            owner = row + np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
            token, at = np.unique(tokens, return_inverse=True)
            sums = [np.bincount(at, minlength=len(token))] + [np.bincount(at, weights=f[owner], minlength=len(token)) for f in faults]
            yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), *(pa.array(s.astype(np.int64)) for s in sums)], ["token", "n", "junk", "toxic"])


def _sums(evidence: Evidence, tokens: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    out = np.zeros((len(bounds) - 1, 2))
    if not len(evidence.tokens):
        return out
    maybe = np.zeros(1 << 16, bool)
    maybe[(evidence.tokens & np.uint64(0xFFFF)).astype(np.int64)] = True
    at = np.flatnonzero(maybe[(tokens & np.uint64(0xFFFF)).astype(np.int64)])
    place = np.minimum(np.searchsorted(evidence.tokens, tokens[at]), len(evidence.tokens) - 1)
    hit = evidence.tokens[place] == tokens[at]
    owner = np.searchsorted(bounds, at[hit], "right") - 1
    for k in (0, 1):
        np.add.at(out[:, k], owner, evidence.ratios[place[hit], k])
    return out


def _scored(evidence: Evidence):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, tokens, bounds in _tokens(arrays.text_array(batch.column(0))):
                sums = _sums(evidence, tokens, bounds)
                rest = [batch.column(i).slice(row, len(sums)) for i in range(1, batch.num_columns)]
                yield pa.RecordBatch.from_arrays([*rest, pa.array(sums[:, 0]), pa.array(sums[:, 1])], [*batch.schema.names[1:], "junk_sum", "toxic_sum"])

    return run


def _placed(known: np.ndarray):
    """(text, junk, bad) to the places of the text's tokens among the known ones, a constant last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, tokens, bounds in _tokens(arrays.text_array(batch.column(0))):
                place = np.minimum(np.searchsorted(known, tokens), max(len(known) - 1, 0))
                hit = known[place] == tokens if len(known) else np.zeros(len(tokens), bool)
                lists = [np.append(place[x:y][hit[x:y]], len(known)).astype(np.int32) for x, y in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                rest = [batch.column(i).slice(row, len(lists)) for i in (1, 2)]
                yield pa.RecordBatch.from_arrays([pa.array(lists, pa.list_(pa.int32())), *rest], ["places", "junk", "bad"])

    return run


def _fitted(known: np.ndarray):
    """The sample's token places in one task (bounded by the sample's and the model's size) to the weights of both faults."""

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        lists = rows["places"].combine_chunks()
        places, ends = lists.flatten().to_numpy(), np.asarray(lists.offsets) - lists.offsets[0].as_py()
        examples = [places[x:y] for x, y in zip(ends[:-1].tolist(), ends[1:].tolist())]
        order = np.random.default_rng(0).permutation(len(examples))
        out = np.zeros((len(known) + 1, 2))
        for k, fault in enumerate(("junk", "bad")):
            y = rows[fault].to_numpy()
            z, n = np.zeros(len(known) + 1), np.zeros(len(known) + 1)

            def weights(at):
                return -np.sign(z[at]) * np.maximum(np.abs(z[at]) - L1, 0) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)

            for _ in range(EPOCHS):
                for i in order:
                    at = examples[i]
                    w = weights(at)
                    g = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - y[i]
                    before = np.sqrt(n[at])
                    n[at] += g * g
                    z[at] += g - (np.sqrt(n[at]) - before) / ALPHA * w
            out[:, k] = weights(slice(None))
        return pa.table({"weights": pa.array([out[:-1].tobytes()], pa.binary())})

    return run


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset by Newton steps with a weak penalty toward (1, 0)."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        w = np.maximum(p * (1 - p), 1e-9)
        grad = np.array([((p - y) * x).sum() + (a - 1), (p - y).sum() + 0.01 * b])
        hess = np.array([[(w * x * x).sum() + 1, (w * x).sum()], [(w * x).sum(), w.sum() + 0.01]])
        step = np.linalg.solve(hess, grad)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-9:
            break
    return max(float(a), 0.05), float(b)


def learn(docs: DataFrame, labels: DataFrame, sample_labels: int = SAMPLE_LABELS) -> Evidence:
    """Evidence from about `sample_labels` labelled documents (drawn by a hash of the id), a fifth kept for calibration."""
    real = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    total = real.count()
    share = min(1.0, sample_labels / max(total, 1))
    drawn = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1_000_003)) < int(share * 1_000_003)
    few = real.filter(drawn).select(F.col("doc_id").alias("label_id"), (1 - F.col("quality")).cast("int").alias("junk"), F.col("toxic").cast("int").alias("bad"))
    # the sample is bounded by `sample_labels`, whatever the table's size
    rows = docs.join(F.broadcast(few), docs["doc_id"] == few["label_id"]).select(F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"), "junk", "bad", F.pmod(F.xxhash64("label_id", F.lit(12)), F.lit(5)).alias("fold"))
    rows = materialize(rows, "labelled")
    fit = rows.filter("fold <> 0").select("text", "junk", "bad")
    base = fit.agg(F.count(F.lit(1)).alias("n"), F.sum("junk").alias("junk"), F.sum("bad").alias("toxic")).first()
    if not base["n"]:
        return Evidence(np.zeros(0, np.uint64), np.zeros((0, 2)))
    counts = fit.mapInArrow(_token_counts, "token long, n long, junk long, toxic long").groupBy("token").agg(*(F.sum(c).alias(c) for c in ("n", "junk", "toxic"))).filter(F.col("n") >= LEAST_DOCS)
    gains = [_gain(F.col("n"), F.col(c), base["n"], base[c]) for c in ("junk", "toxic")]
    best = F.greatest(*gains)
    kept = counts.select("token", "n", "junk", "toxic", gains[0].alias("junk_gain"), gains[1].alias("toxic_gain"), best.alias("gain")).filter(F.col("gain") >= LEAST_GAIN)
    found = kept.orderBy(F.desc("gain"), "token").limit(MODEL_TOKENS).collect()
    found = sorted(found, key=lambda r: r["token"] % (1 << 64))
    tokens = np.array([r["token"] % (1 << 64) for r in found], np.uint64)
    placed = fit.mapInArrow(_placed(tokens), "places array<int>, junk int, bad int").withColumn("all", F.lit(0))
    weights = placed.groupBy("all").applyInArrow(_fitted(tokens), "weights binary").first()
    evidence = Evidence(tokens, np.frombuffer(weights["weights"], np.float64).reshape(-1, 2)) if weights else Evidence(tokens, np.zeros((len(tokens), 2)))
    left = rows.filter("fold = 0").select("text", "junk", "bad").mapInArrow(_scored(evidence), "junk int, bad int, junk_sum double, toxic_sum double").collect()
    fits = []
    for fault, score in (("junk", "junk_sum"), ("bad", "toxic_sum")):
        x, y = np.array([r[score] for r in left]), np.array([r[fault] for r in left], float)
        fits.append(_logistic(x, y) if len(x) else (1.0, 0.0))
    return Evidence(evidence.tokens, evidence.ratios, (fits[0][0], fits[1][0]), (fits[0][1], fits[1][1]))


def _gain(n: Column, hit: Column, total: int, faults: int) -> Column:
    """Twice the log-likelihood gained by giving documents with the token a rate of their own."""

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    rate = (faults + 0.5) / (total + 1.0)
    hit, n = hit.cast("double"), n.cast("double")
    return 2 * (part(hit, n * rate) + part(n - hit, n * (1 - rate)))


def _shrunk(sums: Column, n: Column, parent: Column, strength: float) -> Column:
    return (sums + F.lit(strength) * parent) / (n + F.lit(strength))


def _strength(rates: DataFrame) -> float:
    """Beta-binomial strength from (rate, n, parent): large where the rates differ no more than chance."""
    r = rates.agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("groups"), F.sum(F.col("n") * F.pow(F.col("rate") - F.col("parent"), 2)).alias("spread"),
        F.sum(F.col("parent") * (1 - F.col("parent")) * F.col("n")).alias("chance"),
    ).first()
    if not r["n"] or r["groups"] < 2:
        return 100.0
    within = r["chance"] / r["n"]
    between = (r["spread"] - r["groups"] * within) / r["n"]
    return float(min(max(within / between - 1, 2.0), 1e6)) if between > 0 else 1e6


def classify(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", limit: float = 0.5, sample_labels: int = SAMPLE_LABELS, row: str | None = None) -> DataFrame:
    """Per row: doc_id, p_low_quality, p_toxic, host_rate, path_rate, p_fault, rejected, and the bigint column `row` if one is named.

    `path` names the part of the host that a document belongs to; null hosts and paths are groups
    of their own. A null text is empty and judged by its shape and site. A label table that names
    a document twice counts its worse labels; without labels nothing is rejected. Rows are
    judged one by one, so repeated rows repeat their result; other columns are ignored.
    """
    runtime.prepare(docs.sparkSession)
    evidence = learn(docs, labels, sample_labels)
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = [row] if row else []
    plain = docs.select(docs["text"].cast("string").alias("text"), docs["doc_id"], *(docs[c] for c in names), F.coalesce(docs[host].cast("string"), F.lit("")).alias("host"), F.coalesce(docs[path].cast("string"), F.lit("")).alias("path"))
    scored = plain.mapInArrow(_scored(evidence), f"doc_id {kind}, {''.join(f'{c} long, ' for c in names)}host string, path string, junk_sum double, toxic_sum double")

    def chance(c: str, k: int) -> Column:
        return 1 / (1 + F.exp(-(F.col(c) * evidence.slope[k] + evidence.offset[k])))

    nothing = not len(evidence.tokens)
    scored = scored.withColumns({"p_low_quality": F.lit(0.0) if nothing else chance("junk_sum", 0), "p_toxic": F.lit(0.0) if nothing else chance("toxic_sum", 1)})
    scored = scored.withColumn("p", F.greatest(F.least(1 - (1 - F.col("p_low_quality")) * (1 - F.col("p_toxic")), F.lit(1 - 1e-9)), F.lit(1e-9)))
    scored = materialize(scored.select("doc_id", *names, "host", "path", "p_low_quality", "p_toxic", "p"), "scored")
    paths = materialize(scored.groupBy("host", "path").agg(F.sum("p").alias("sum"), F.count(F.lit(1)).alias("n")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("sum").alias("host_sum"), F.sum("n").alias("host_n"))
    overall = hosts.agg((F.sum("host_sum") / F.sum("host_n")).alias("rate")).first()["rate"] or 0.0
    rate = min(max(overall, 1e-6), 1 - 1e-6)
    host_strength = _strength(hosts.select((F.col("host_sum") / F.col("host_n")).alias("rate"), F.col("host_n").alias("n"), F.lit(rate).alias("parent")))
    hosts = hosts.select("host", _shrunk(F.col("host_sum"), F.col("host_n"), F.lit(rate), host_strength).alias("host_rate"))
    nested = paths.join(hosts, "host")
    path_strength = _strength(nested.select((F.col("sum") / F.col("n")).alias("rate"), "n", F.col("host_rate").alias("parent")))
    sites = nested.select("host", "path", "host_rate", _shrunk(F.col("sum"), F.col("n"), F.col("host_rate"), path_strength).alias("path_rate"))
    odds = lambda p: F.log(p / (1 - p))
    logit = odds(F.col("p")) + odds(F.col("path_rate")) - F.lit(float(np.log(rate / (1 - rate))))
    out = scored.join(sites, ["host", "path"]).withColumn("p_fault", 1 / (1 + F.exp(-logit)))
    return out.select("doc_id", "p_low_quality", "p_toxic", "host_rate", "path_rate", "p_fault", (F.col("p_fault") >= limit).alias("rejected"), *names)
