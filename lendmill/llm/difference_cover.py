"""Removal of repeated word windows, found through difference-cover anchors.

The cover holds residues modulo the period such that every difference of two places is a
difference of two residues. So two equal windows of `period + anchor - 1` words share an anchor
(a run of `anchor` words) that starts at a cover place in both documents. Only anchors are hashed
and shuffled for the whole corpus; anchors that occur twice are extended to the windows around
them, and these are compared by a 128-bit hash. The first occurrence stays.

Equal hashes inside one Arrow batch are settled there, so that each hash leaves a batch once and a
passage that a third of all documents share stays a small group.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendmill.llm import arrays, runtime
from lendmill.session import materialize

WINDOW = 20
PERIOD = 13
COVER = (0, 1, 3, 9)
# Stands for a null id inside this module: it sorts first, as null does.
NULL_ID = -(1 << 63)


def is_cover(period: int, cover: tuple[int, ...]) -> bool:
    return {(a - b) % period for a in cover for b in cover} == set(range(period))


def _identified(docs: DataFrame) -> DataFrame:
    """(id, row, text): `row` tells texts of one id apart, so decisions are joined back by (id, row)."""
    named = docs.select(F.coalesce(docs["doc_id"].cast("bigint"), F.lit(NULL_ID)).alias("id"), docs["text"].cast("string").alias("text"))
    return named.select("id", runtime.row_key(F.col("id"), F.col("text")).alias("row"), "text")


def _later(order: np.ndarray, changed: np.ndarray, ids: np.ndarray, rows: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows in `order`, with `changed` at each new key: is it the key's first row; is it past that row's place."""
    head = np.maximum.accumulate(np.where(changed, np.arange(len(order)), 0))
    first = order[head]
    return changed, (ids[order] != ids[first]) | (rows[order] != rows[first]) | (places[order] != places[first])


def _anchors(window: int, period: int, cover: tuple[int, ...]):
    width = window - period + 1
    wanted = np.isin(np.arange(period), cover)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(1).to_numpy()
            texts = arrays.text_array(batch.column(2))
            hashes, owners, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for row, _, data, offsets in arrays.slices(texts):
                starts, ends, first = arrays.word_spans(data, offsets, arrays.NOT_SPACE)
                found = arrays.window_hashes(arrays.word_hashes(data, starts, ends), width)
                text, place = arrays.numbering(first)
                long_enough = np.diff(first)[text[: len(found)]] >= window
                at = np.flatnonzero(arrays.within_text(first, width) & wanted[place[: len(found)] % period] & long_enough)
                hashes.append(found[at])
                owners.append(keys[row + text[at]])
                places.append(place[at])
            key, owner, place = np.concatenate(hashes), np.concatenate(owners), np.concatenate(places)
            order = np.argsort(key, kind="stable")
            key, owner, place = key[order], owner[order], place[order]
            head = np.ones(len(key), bool)
            head[1:] = key[1:] != key[:-1]
            again = np.zeros(len(key), bool)
            again[:-1] = ~head[1:]
            again |= ~head
            # rows known to repeat need no partner: they travel under a key of their document, which compresses
            key = np.where(head, key, arrays.mix(owner.view(np.uint64)))
            order = np.lexsort((place, owner))
            key, owner, place, again = key[order], owner[order], place[order], again[order]
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(owner), pa.array(place, pa.int32()), pa.array(again)], ["key", "row", "place", "known"])

    return run


def repeated_anchors(docs: DataFrame, window: int, period: int, cover: tuple[int, ...]) -> DataFrame:
    """(row, places) of the anchors that occur more than once in the corpus."""
    anchors = docs.mapInArrow(_anchors(window, period, cover), "key long, row long, place int, known boolean")
    counted = anchors.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("key")))
    return counted.filter("n > 1 OR known").groupBy("row").agg(F.collect_set("place").alias("places"))


def _windows(window: int, period: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            texts = arrays.text_array(batch.column(2))
            lists = batch.column(3)
            parts = []
            for row, end, data, offsets in arrays.slices(texts):
                starts, ends, first = arrays.word_spans(data, offsets, arrays.NOT_SPACE)
                n = int(first[-1])
                if n < window:
                    continue
                some = lists.slice(row, end - row)
                found = some.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                counts = np.diff(np.asarray(some.offsets))
                text = np.repeat(np.arange(end - row), counts)
                ok = found < np.diff(first)[text]  # a key that two rows share has places of both
                anchors = first[text[ok]] + found[ok]
                near = np.zeros(n + 1, np.int32)
                np.add.at(near, np.maximum(anchors - period + 1, first[text[ok]]), 1)
                np.add.at(near, anchors + 1, -1)
                wanted = np.cumsum(near[: n - window + 1]) > 0
                at = np.flatnonzero(wanted & arrays.within_text(first, window))
                both = [arrays.window_hashes(arrays.word_hashes(data, starts, ends, k), window, k)[at] for k in (0, 1)]
                owner, place = arrays.numbering(first)
                parts.append((*both, ids[row + owner[at]], keys[row + owner[at]], place[at]))
            if not parts:
                continue
            h, g, owner, key, place = (np.concatenate(c) for c in zip(*parts))
            order = np.lexsort((place, key, owner, g, h))
            h2, g2 = h[order], g[order]
            changed = np.ones(len(order), bool)
            changed[1:] = (h2[1:] != h2[:-1]) | (g2[1:] != g2[:-1])
            _, known = _later(order, changed, owner, key, place)
            owner, key, place = owner[order], key[order], place[order]
            # known repeats need no partner: they travel under a key of their document, which compresses
            h2, g2 = np.where(known, arrays.mix(key.view(np.uint64)), h2), np.where(known, np.uint64(0), g2)
            order = np.lexsort((place, key, owner, known))
            h2, g2, owner, key, place, known = h2[order], g2[order], owner[order], key[order], place[order], known[order]
            yield pa.RecordBatch.from_arrays(
                [pa.array(h2.view(np.int64)), pa.array(g2.view(np.int64)), pa.array(owner), pa.array(key), pa.array(place, pa.int32()), pa.array(known)],
                ["h", "g", "id", "row", "place", "known"],
            )

    return run


def repeated_windows(docs: DataFrame, anchors: DataFrame, window: int, period: int) -> DataFrame:
    """(id, row, places) of the windows whose words also start earlier in the corpus."""
    some = runtime.only_slots_of(docs, "row", anchors, "row").join(anchors, "row").select("id", "row", "text", "places")
    found = some.mapInArrow(_windows(window, period), "h long, g long, id long, row long, place int, known boolean")
    first = F.min(F.struct("id", "row", "place")).over(Window.partitionBy("h", "g"))
    late = found.withColumn("first", first).filter("known OR struct(id, row, place) > first")
    return late.groupBy("id", "row").agg(F.collect_set("place").alias("places"))


def _kept(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2) if batch.num_columns > 2 else None
            totals, removed, digests, texts = [], [], [], []
            for row, text in enumerate(batch.column(1)):
                words = (text.as_py() or "").encode().split()
                total = len(words)
                places = lists[row].values.to_numpy() if lists is not None and lists[row].is_valid else ()
                if len(places):
                    places = places[places <= total - window]
                    cover = np.zeros(total + 1, np.int32)
                    np.add.at(cover, places, 1)
                    np.add.at(cover, places + window, -1)
                    words = [words[i] for i in np.flatnonzero(np.cumsum(cover[:-1]) == 0).tolist()]
                kept = b" ".join(words)
                totals.append(total)
                removed.append(total - len(words))
                digests.append(hashlib.sha256(kept).hexdigest())
                texts.append(kept.decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(totals, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string()), pa.array(texts, pa.string())],
                ["id", "n_words", "n_removed", "kept_sha256", "kept_text"],
            )

    return run


def remove_repeats(docs: DataFrame, window: int = WINDOW, period: int = PERIOD, cover: tuple[int, ...] = COVER) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256, kept_text.

    Words are runs of anything but ASCII white space, taken unchanged. A word goes if some window
    of `window` words over it has the same words as a window that starts earlier: in a smaller
    doc_id, or earlier in the same document. A null or empty text has no words. A null id counts
    as the smallest. Texts that share an id are documents of their own, ordered by a hash of the
    text; rows that repeat id and text are the same document (each gets its result row, and they
    do not remove each other). Other columns are ignored.
    """
    if not is_cover(period, cover) or window < period:
        raise ValueError("the cover must give every difference, and the window must hold an anchor")
    runtime.prepare(docs.sparkSession)
    docs = _identified(docs)
    anchors = materialize(repeated_anchors(docs, window, period, cover), "anchors")
    late = materialize(repeated_windows(docs, anchors, window, period), "repeats")
    slots = late.select(runtime.slot(F.col("row")).alias("slot")).distinct()
    touched = docs.join(F.broadcast(slots), runtime.slot(docs["row"]) == slots["slot"], "left_semi")
    clean = docs.join(F.broadcast(slots), runtime.slot(docs["row"]) == slots["slot"], "left_anti")
    schema = "id long, n_words long, n_removed long, kept_sha256 string, kept_text string"
    out = touched.join(late, ["id", "row"], "left").select("id", "text", "places").mapInArrow(_kept(window), schema).unionByName(clean.select("id", "text").mapInArrow(_kept(window), schema))
    return out.select(F.when(F.col("id") != NULL_ID, F.col("id")).alias("doc_id"), "n_words", "n_removed", "kept_sha256", "kept_text")
