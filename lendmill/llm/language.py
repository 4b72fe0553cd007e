"""Language identification: multinomial logistic regression on TF-IDF character n-grams.

N-grams of one to three lower-cased characters (a run of anything but letters is one blank) are
hashed into a fixed number of buckets. Document frequencies are counted over all training
documents. Weights are trained by follow-the-regularised-leader with L1 and L2 penalties on a
bounded sample, in parallel parts whose weights are averaged; a temperature fitted on other
training documents calibrates the scores. A document's score is linear in its term frequencies, so
the whole text is scored by summing one table over its n-grams.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendmill.llm import arrays, runtime

LONGEST_GRAM = 3
BUCKETS = 1 << 15
SLICE_BYTES = 1 << 20
UNKNOWN = "und"


@dataclass(frozen=True)
class Training:
    """`per_language` bounds the documents per language that weights are trained on (expected number, by a hash of the id)."""

    per_language: int = 1500
    per_language_calibration: int = 300
    parts: int = 8
    epochs: int = 4
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.1
    scale: float = 100.0


@dataclass(frozen=True)
class Model:
    languages: list[str]
    # a row per bucket and a last one of zeros; weights times IDF times scale
    table: np.ndarray = field(repr=False)
    bias: np.ndarray = field(repr=False)
    temperature: float = 1.0


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def _characters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters and single blanks of all texts in one array, and the texts' bounds."""
    lowered = [t.lower() for t in texts]
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in lowered])]).astype(np.int64)
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "replace"), np.uint32)
    letter = _letters()[codes]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    heads = bounds[:-1][bounds[:-1] < len(codes)]
    keep[heads] = letter[heads]
    upto = np.concatenate([[0], np.cumsum(keep)])
    return np.where(letter, codes, np.uint32(32))[keep], upto[bounds]


def _grams(codes: np.ndarray, bounds: np.ndarray) -> Iterator[np.ndarray]:
    """The bucket of the n-gram at each character, n = 1, 2, ..; BUCKETS where it leaves the text."""
    left = np.repeat(bounds[1:], np.diff(bounds)) - np.arange(len(codes))
    h = np.zeros(len(codes), np.uint32)
    for n in range(1, LONGEST_GRAM + 1):
        step = codes[n - 1 :] if n > 1 else codes
        h[: len(step)] = (h[: len(step)] * np.uint32(0x01000193)) ^ (step * np.uint32(0x9E3779B1) + np.uint32(n))
        g = h ^ (h >> np.uint32(15))
        g = g * np.uint32(0x2C1B3C6D)
        g ^= g >> np.uint32(13)
        yield np.where(left >= n, g & np.uint32(BUCKETS - 1), np.uint32(BUCKETS)).astype(np.int32)


def _slices(column) -> Iterator[tuple[int, list[str]]]:
    texts = arrays.text_array(column)
    for row, end, _, _ in arrays.slices(texts, SLICE_BYTES):
        yield row, texts.slice(row, end - row).to_pylist()


def _sparse(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(buckets, counts, all n-grams) of each text."""
    codes, bounds = _characters(texts)
    grams = list(_grams(codes, bounds))
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        own = np.concatenate([g[a:b] for g in grams])
        counts = np.bincount(own, minlength=BUCKETS + 1)[:BUCKETS]
        seen = np.flatnonzero(counts)
        yield seen, counts[seen], int(counts.sum())


def document_frequencies(docs: DataFrame) -> np.ndarray:
    """How many texts have each bucket; at most BUCKETS sums reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS + 1, np.int64)
        for batch in batches:
            for _, texts in _slices(batch.column(0)):
                codes, bounds = _characters(texts)
                grams = list(_grams(codes, bounds))
                for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                    seen = np.zeros(BUCKETS + 1, bool)
                    for g in grams:
                        seen[g[a:b]] = True
                    total += seen
        some = np.flatnonzero(total[:BUCKETS])
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    out = np.zeros(BUCKETS, np.int64)
    for r in docs.select(docs["text"].cast("string").alias("text")).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _trained(languages: int, idf: np.ndarray, how: Training):
    """Follow-the-regularised-leader over one part of the sample: its weights, the bias last."""

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        z, n = np.zeros((languages, BUCKETS + 1)), np.zeros((languages, BUCKETS + 1))
        examples = []
        for row, texts in _slices(rows["text"]):
            for k, (seen, counts, total) in enumerate(_sparse(texts)):
                if total:
                    examples.append((np.append(seen, BUCKETS), np.append(how.scale * counts / total * idf[seen], 1.0), row + k))
        labels = rows["y"].to_numpy()

        def weights(at):
            zi, ni = z[:, at], n[:, at]
            return -np.sign(zi) * np.maximum(np.abs(zi) - how.l1, 0) / ((how.beta + np.sqrt(ni)) / how.alpha + how.l2)

        draw = np.random.default_rng(0)
        for _ in range(how.epochs):
            for i in draw.permutation(len(examples)):
                at, x, row = examples[i]
                w = weights(at)
                p = _softmax(w @ x)
                p[labels[row]] -= 1
                g = p[:, None] * x[None, :]
                before = np.sqrt(n[:, at])
                n[:, at] += g * g
                z[:, at] += g - (np.sqrt(n[:, at]) - before) / how.alpha * w
        return pa.table({"weights": pa.array([weights(slice(None)).astype(np.float32).tobytes()], pa.binary())})

    return run


def _of_hash(seed: int, fraction: dict[str, float]):
    """True for about that fraction of each language's rows, by a hash of the id."""
    drawn = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1_000_003)) / F.lit(1_000_003.0)
    limit = F.lit(0.0)
    for language, share in fraction.items():
        limit = F.when(F.col("lang") == language, F.lit(share)).otherwise(limit)
    return drawn < limit


def train(docs: DataFrame, how: Training = Training()) -> Model:
    """A model of the documents' languages; rows with a null text or language teach nothing."""
    runtime.prepare(docs.sparkSession)
    known = docs.filter("text IS NOT NULL AND lang IS NOT NULL")
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(counts)
    if not languages:
        return Model([], np.zeros((BUCKETS + 1, 0), np.float32), np.zeros(0))
    df = document_frequencies(known)
    idf = np.log((1 + sum(counts.values())) / (1 + df)) + 1
    number = F.array_position(F.array(*(F.lit(x) for x in languages)), F.col("lang")).cast("int") - 1
    split = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(5))
    own, other = known.filter(split != 0), known.filter(split == 0)
    sample = own.filter(_of_hash(1, {x: min(1.0, 1.25 * how.per_language / counts[x]) for x in languages}))
    dealt = sample.select("text", number.alias("y"), F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(how.parts)).alias("part"))
    parts = dealt.groupBy("part").applyInArrow(_trained(len(languages), idf, how), "weights binary").collect()
    if not parts:  # so few documents that all fell to the calibration
        parts = known.select("text", number.alias("y"), F.lit(0).alias("part")).groupBy("part").applyInArrow(_trained(len(languages), idf, how), "weights binary").collect()
    weights = np.mean([np.frombuffer(r["weights"], np.float32).reshape(len(languages), -1) for r in parts], axis=0)
    table = np.zeros((BUCKETS + 1, len(languages)), np.float32)
    table[:BUCKETS] = (weights[:, :BUCKETS] * idf * how.scale).T
    model = Model(languages, table, weights[:, BUCKETS])
    rest = other.filter(_of_hash(4, {x: min(1.0, 5.0 * how.per_language_calibration / counts[x]) for x in languages}))
    return Model(model.languages, model.table, model.bias, _temperature(model, rest.select(number.alias("y"), "text")))


def _logits(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Logits of each text, and whether it has a letter."""
    codes, bounds = _characters(texts)
    total, sums = np.zeros(len(texts)), np.zeros((len(texts), len(model.languages)))
    full = np.flatnonzero(np.diff(bounds))
    if len(full):
        for g in _grams(codes, bounds):
            total[full] += np.add.reduceat((g < BUCKETS).astype(np.int64), bounds[:-1][full])
            for k in range(len(model.languages)):
                sums[full, k] += np.add.reduceat(model.table[:, k][g].astype(np.float64), bounds[:-1][full])
    return sums / np.maximum(total, 1)[:, None] + model.bias, np.diff(bounds) > 0


def _temperature(model: Model, rows: DataFrame) -> float:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, texts in _slices(batch.column(1)):
                logits, full = _logits(model, texts)
                keep = np.flatnonzero(full)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row + keep)), pa.array(list(logits[keep]), pa.list_(pa.float64()))], ["y", "logits"])

    found = rows.mapInArrow(run, "y int, logits array<double>").collect()
    if not found:
        return 1.0
    y, logits = np.array([r["y"] for r in found]), np.array([r["logits"] for r in found])

    def loss(log_t: float) -> float:
        scaled = logits / np.exp(log_t)
        scaled = scaled - scaled.max(1, keepdims=True)
        return float((np.log(np.exp(scaled).sum(1)) - scaled[np.arange(len(y)), y]).mean())

    low, high, ratio = -4.0, 4.0, (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        if loss(a) <= loss(b):
            high = b
        else:
            low = a
    return float(np.exp((low + high) / 2))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """The documents' (doc_id, lang_pred, score) by the text alone; ties go to the first language by name."""
    runtime.prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, texts in _slices(batch.column(1)):
                if model.languages:
                    logits, full = _logits(model, texts)
                    chance = _softmax(logits / model.temperature)
                    best = chance.argmax(1)
                    names = [model.languages[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), full.tolist())]
                    score = np.where(full, chance[np.arange(len(texts)), best], 0.0)
                else:
                    names, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, len(texts)), pa.array(names, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", docs["text"].cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def held_out():
    """A fifth of the documents, by a checksum of the id; a null id is not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def identify(docs: DataFrame, how: Training = Training()) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score, by a model learnt from the rows not held out.

    `und` with score 0 where the text is null or has no letter, or no row names a language. Rows
    are independent; repeated rows count as often as they occur; other columns are ignored.
    """
    model = train(docs.filter(~held_out()).select("doc_id", "text", "lang"), how)
    return predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
