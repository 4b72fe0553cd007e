"""Benchmark decontamination through a distributed positional inverted index.

Terms are 64-bit word hashes. The corpus count of each benchmark term is taken first; each
benchmark window then names its two rarest terms. The index holds, for those terms, the places in
every document (one row per term and document). Shifting each place back by the term's offset in
the benchmark item gives the place where the item would begin; a window can occur only where both
of its lists agree on it. What is left is compared word by word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendmill.llm import arrays, runtime
from lendmill.session import materialize

WINDOW = 10
NULL_ID = -(1 << 63)


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z only) runs of letters, digits and everything beyond ASCII."""
    return (text or "").encode().translate(_TO_WORDS).split()


_TO_WORDS = bytes(int(arrays.LOWER[b]) if arrays.ALNUM[b] else 0x20 for b in range(256))


def _hashed(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, word hashes, index of each text's first word) of each slice."""
    for row, _, data, offsets in arrays.slices(texts):
        data = arrays.LOWER[data]
        starts, ends, first = arrays.word_spans(data, offsets, arrays.ALNUM)
        yield row, arrays.word_hashes(data, starts, ends), first


def _identified(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(docs["doc_id"].cast("bigint"), F.lit(NULL_ID)).alias("id"), docs["text"].cast("string").alias("text"))


def item_terms(items: DataFrame) -> DataFrame:
    """(item, item_id, words, off, term): each word of each distinct item; items without words give nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = arrays.text_array(batch.column(2))
            plain = [b" ".join(words_of(t.as_py())).decode() for t in texts]
            for row, terms, first in _hashed(texts):
                owner, place = arrays.numbering(first)
                rows = pa.array(row + owner)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(plain, pa.string()).take(rows), pa.array(place, pa.int32()), pa.array(terms.view(np.int64))],
                    ["item", "item_id", "words", "off", "term"],
                )

    named = items.select(F.coalesce(items["item_id"].cast("string"), F.lit("null")).alias("item_id"), items["text"].cast("string").alias("text")).distinct()
    return named.select(F.xxhash64("item_id", "text").alias("item"), "item_id", "text").mapInArrow(run, "item long, item_id string, words string, off int, term long")


def _filter_of(terms: DataFrame) -> np.ndarray:
    """A fixed-size presence table of the terms' low bits (at most runtime.SLOTS numbers are collected)."""
    found = np.zeros(runtime.SLOTS, bool)
    rows = terms.select(F.col("term").bitwiseAND(F.lit(runtime.SLOTS - 1)).cast("int").alias("s")).distinct().collect()
    found[[r["s"] for r in rows]] = True
    return np.packbits(found)


def _maybe(packed: np.ndarray, terms: np.ndarray) -> np.ndarray:
    return np.unpackbits(packed).view(bool)[(terms & np.uint64(runtime.SLOTS - 1)).astype(np.int64)]


def term_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, n): how often each wanted term occurs in the whole corpus."""
    packed = _filter_of(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, found, _ in _hashed(arrays.text_array(batch.column(0))):
                term, n = np.unique(found[_maybe(packed, found)], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(term.view(np.int64)), pa.array(n.astype(np.int64))], ["term", "n"])

    counts = docs.select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    return counts.join(terms.select("term").distinct(), "term", "left_semi")


def live_windows(terms: DataFrame, counts: DataFrame, window: int) -> DataFrame:
    """(item, item_id, words, start, a_off, a_term, b_off, b_term): each window that can occur, with its two rarest terms."""
    sized = terms.join(counts, "term", "left").withColumn("size", F.count(F.lit(1)).over(Window.partitionBy("item")))
    last = F.greatest(F.col("size") - window, F.lit(0))
    starts = F.sequence(F.greatest(F.col("off") - (window - 1), F.lit(0)), F.least(F.col("off"), last.cast("int")))
    spread = sized.withColumn("start", F.explode(starts))
    grouped = spread.groupBy("item", "item_id", "words", "start").agg(
        F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "off", "term"))).alias("by_count")
    )
    rare = F.col("by_count")
    second = F.when(F.size(rare) > 1, rare[F.least(F.size(rare) - 1, F.lit(1))]).otherwise(rare[0])
    return grouped.filter(rare[0]["n"] > 0).select(
        "item", "item_id", "words", "start", rare[0]["off"].alias("a_off"), rare[0]["term"].alias("a_term"), second["off"].alias("b_off"), second["term"].alias("b_term")
    )


def build_index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, id, places): the postings of the wanted terms over all documents."""
    packed = _filter_of(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for row, found, first in _hashed(arrays.text_array(batch.column(1))):
                at = np.flatnonzero(_maybe(packed, found))
                owner, place = arrays.numbering(first)
                owner, place, term = owner[at], place[at], found[at]
                order = np.lexsort((place, term, owner))
                owner, place, term = owner[order], place[order], term[order]
                head = np.ones(len(order), bool)
                head[1:] = (owner[1:] != owner[:-1]) | (term[1:] != term[:-1])
                heads = np.flatnonzero(head)
                offsets = np.append(heads, len(order)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(term[heads].view(np.int64)), pa.array(ids[row + owner[heads]]), pa.ListArray.from_arrays(pa.array(offsets), pa.array(place, pa.int32()))],
                    ["term", "id", "places"],
                )

    index = docs.mapInArrow(run, "term long, id long, places array<int>")
    return index.join(terms.select("term").distinct(), "term", "left_semi")


def _rare_places(windows: DataFrame) -> DataFrame:
    """(item, term, off): every place of an item that is a rarest one of some window."""
    return windows.select("item", F.explode(F.array(F.struct(F.col("a_term").alias("term"), F.col("a_off").alias("off")), F.struct(F.col("b_term").alias("term"), F.col("b_off").alias("off")))).alias("p")).select("item", "p.term", "p.off").distinct()


def _hits(index: DataFrame, windows: DataFrame) -> DataFrame:
    """(id, item, begin, off): where an item would begin, by each place of its rare terms."""
    spread = index.join(_rare_places(windows), "term").select("id", "item", "off", F.explode("places").alias("place"))
    return spread.select("id", "item", (F.col("place") - F.col("off")).alias("begin"), "off")


def _by_item(windows: DataFrame) -> DataFrame:
    return windows.groupBy("item", "item_id", "words").agg(F.collect_list(F.struct("start", "a_off", "b_off")).alias("windows"))


def _agreeing(offs: str):
    return F.filter("windows", lambda w: F.array_contains(F.col(offs), w["a_off"]) & F.array_contains(F.col(offs), w["b_off"]))


def aligned(index: DataFrame, windows: DataFrame) -> DataFrame:
    """(id, item_id, words, begin, starts): windows whose two rarest terms stand at the right distance."""
    met = _hits(index, windows).groupBy("id", "item", "begin").agg(F.collect_set("off").alias("offs"))
    return met.join(_by_item(windows), "item").withColumn("starts", _agreeing("offs")["start"]).filter(F.size("starts") > 0).select("id", "item_id", "words", "begin", "starts")


def proximity_matches(docs: DataFrame, items: DataFrame, slop: int, window: int = WINDOW) -> DataFrame:
    """(doc_id, item_id) where the two rarest terms of a window stand within `slop` words of their distance in it.

    Nulls, ties and empty tables as in `decontaminate`; exact phrases are matches too.
    """
    docs, windows, index = _prepared(docs, items, window)
    near = Window.partitionBy("id", "item").orderBy("begin").rangeBetween(-slop, 0)
    met = _hits(index, windows).withColumn("offs", F.collect_set("off").over(near))
    found = met.join(_by_item(windows), "item").filter(F.size(_agreeing("offs")) > 0)
    return found.select(F.when(F.col("id") != NULL_ID, F.col("id")).alias("doc_id"), "item_id").distinct()


def _prepared(docs: DataFrame, items: DataFrame, window: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    runtime.prepare(docs.sparkSession)
    docs = _identified(docs)
    terms = materialize(item_terms(items), "item-terms")
    windows = materialize(live_windows(terms, term_counts(docs, terms), window), "item-windows")
    rare = _rare_places(windows)
    return docs, windows, materialize(build_index(docs, rare), "postings")


def _verified(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column(2).to_pylist() if batch.num_columns > 2 else [None] * batch.num_rows
            totals, hits, items = [], [], []
            for text, candidates in zip(batch.column(1), found):
                words = words_of(text.as_py())
                hit, seen = np.zeros(len(words) + 1, np.int32), set()
                for c in candidates or ():
                    item = c["words"].encode().split()
                    for start in c["starts"]:
                        part, at = item[start : start + window], c["begin"] + start
                        if at >= 0 and words[at : at + len(part)] == part:
                            hit[at] += 1
                            hit[at + len(part)] -= 1
                            seen.add(c["item_id"])
                totals.append(len(words))
                hits.append(int((np.cumsum(hit)[:-1] > 0).sum()))
                items.append(sorted(seen))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(totals, pa.int64()), pa.array(hits, pa.int64()), pa.array(items, pa.list_(pa.string()))], ["id", "n_words", "n_hit", "items"]
            )

    return run


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: doc_id, n_words, n_hit (words inside a benchmark window) and the item_ids found.

    A window is `window` consecutive words of an item, or the whole item where it is shorter. A
    null text has no words, an item without words no window. Items that repeat id and text count
    once; a null item_id is "null". Rows that repeat a doc_id are looked at one by one. Null ids
    and empty tables are allowed; columns besides doc_id, item_id and text are ignored.
    """
    docs, windows, index = _prepared(docs, items, window)
    grouped = aligned(index, windows).groupBy("id").agg(F.collect_list(F.struct("item_id", "words", "begin", "starts")).alias("candidates"))
    found = materialize(grouped, "aligned")
    touched, clean = runtime.split_by_slots(docs, "id", found, "id")
    schema = "id long, n_words long, n_hit long, items array<string>"
    out = touched.join(found, "id", "left").select("id", "text", "candidates").mapInArrow(_verified(window), schema).unionByName(clean.mapInArrow(_verified(window), schema))
    return out.select(F.when(F.col("id") != NULL_ID, F.col("id")).alias("doc_id"), "n_words", "n_hit", "items")


def digest(found: DataFrame) -> DataFrame:
    """The result of `decontaminate` with the item list as count and digest."""
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
    )

