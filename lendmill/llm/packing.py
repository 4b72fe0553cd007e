"""Order-preserving packing of documents into token sequences by dynamic programming.

Documents are laid end to end in ascending doc_id order, per range partition. Cuts are allowed at
document ends (free), at sentence ends (small penalty), and inside a sentence only where it is
longer than a sequence (larger penalty). A sequence of n ids costs `longest - n` ids of padding,
or none if n is a power of two. With

    best(j) = penalty(j) + min( longest - p(j) + min{ best(i) + p(i) : p(j) - p(i) <= longest },
                                min{ best(i) : p(j) - p(i) a power of two } )

the first inner minimum slides along the cuts and is kept in a monotone queue. The work is done
in blocks of whole documents; the last sequence of a block is carried into the next block.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from lendmill.llm import arrays, runtime, tokens
from lendmill.llm.token_stream import in_id_order

LONGEST = 4096
BLOCK_IDS = 1 << 20
SENTENCE_PENALTY = 4
INSIDE_PENALTY = 64
# Sequences of one partition are numbered from its number times this.
SEQUENCES_PER_PARTITION = 1 << 33

PIECES = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, padded long"


def padding(length: int, longest: int = LONGEST) -> int:
    return 0 if length & (length - 1) == 0 else longest - length


def cut_places(n: int, document_ends: np.ndarray, sentence_ends: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Places where a cut is allowed (0 and n included) and the penalty of each."""
    places = np.union1d(np.concatenate([[0, n], document_ends]), sentence_ends)
    gaps = np.diff(places)
    wide = np.flatnonzero(gaps > longest)
    inside = [np.arange(places[w] + longest, places[w + 1], longest) for w in wide]
    if inside:
        places = np.union1d(places, np.concatenate(inside))
    cost = np.full(len(places), INSIDE_PENALTY, np.int64)
    cost[np.searchsorted(places, sentence_ends)] = SENTENCE_PENALTY
    cost[np.searchsorted(places, document_ends)] = 0
    cost[0] = 0
    return places, cost


def best_cuts(places: np.ndarray, cost: np.ndarray, longest: int) -> list[int]:
    """The chosen places, first and last included."""
    later, earlier = [], []
    size = 1
    while size <= longest:
        at = np.searchsorted(places, places - size)
        ok = np.flatnonzero((places[at] == places - size) & (places >= size))
        later.append(ok)
        earlier.append(at[ok])
        size *= 2
    later, earlier = np.concatenate(later), np.concatenate(earlier)
    order = np.argsort(later, kind="stable")
    later, earlier = later[order].tolist() + [len(places)], earlier[order].tolist()
    p, c = places.tolist(), cost.tolist()
    best, back = [0] * len(p), [0] * len(p)
    queue, k = deque([(0, 0)]), 0  # (best + place, index), least first
    for j in range(1, len(p)):
        at = p[j]
        while p[queue[0][1]] < at - longest:
            queue.popleft()
        least, i = queue[0]
        least += longest - at
        while later[k] == j:
            if best[earlier[k]] < least:
                least, i = best[earlier[k]], earlier[k]
            k += 1
        best[j], back[j] = least + c[j], i
        key = best[j] + at
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, j))
    out, j = [], len(p) - 1
    while j:
        out.append(p[j])
        j = back[j]
    return [0, *reversed(out)]


class _Packer:
    """Holds the ids not yet cut and turns blocks of whole documents into pieces."""

    def __init__(self, longest: int, sentence_ends: np.ndarray, first_sequence: int):
        self.longest, self.sentence_ends, self.sequence = longest, sentence_ends, first_sequence
        self.ids: list[np.ndarray] = []
        # documents in the block: row id, all its ids, ids of it before the block
        self.docs: list[tuple[object, int, int]] = []
        self.n = 0

    def add(self, doc_id, ids: np.ndarray) -> None:
        self.ids.append(ids)
        self.docs.append((doc_id, len(ids), 0))
        self.n += len(ids)

    def cut(self, last: bool) -> dict[str, list]:
        ids = np.concatenate(self.ids)
        sizes = np.array([n - before for _, n, before in self.docs], np.int64)
        ends = np.cumsum(sizes)
        marks = np.flatnonzero(np.isin(ids, self.sentence_ends)) + 1
        # the end id after a sentence mark belongs to the document's end
        marks = marks[marks < len(ids)]
        cuts = best_cuts(*cut_places(len(ids), ends, marks, self.longest), self.longest)
        if not last and len(cuts) > 2:
            cuts = cuts[:-1]
        upto = cuts[-1]
        bounds = np.union1d(cuts, ends[ends < upto])
        lo, hi = bounds[:-1], bounds[1:]
        doc = np.searchsorted(ends, lo, "right")
        seq = np.searchsorted(cuts, lo, "right") - 1
        starts = lo - (ends - sizes)[doc] + np.array([b for _, _, b in self.docs], np.int64)[doc]
        widths = np.diff(cuts)
        padded = np.array([w + padding(w, self.longest) for w in widths.tolist()], np.int64)
        raw = ids.astype("<u4")
        out = {
            "doc_id": [self.docs[d][0] for d in doc.tolist()],
            "start": starts,
            "length": hi - lo,
            "ids_crc32": [zlib.crc32(raw[a:b]) for a, b in zip(lo.tolist(), hi.tolist())],
            "doc_tokens": np.array([n for _, n, _ in self.docs], np.int64)[doc],
            "sequence_id": self.sequence + seq,
            "offset": lo - np.array(cuts)[seq],
            "padded": padded[seq],
        }
        self.sequence += len(widths)
        left = int(np.searchsorted(ends, upto, "right"))
        rest = []
        for d in range(left, len(self.docs)):
            doc_id, n, before = self.docs[d]
            rest.append((doc_id, n, before + max(0, upto - int(ends[d] - sizes[d]))))
        self.ids, self.docs, self.n = [ids[upto:]], rest, len(ids) - upto
        return out


def pack(docs: DataFrame, tokenizer_path: str | None = None, end_id: int = 2, longest: int = LONGEST) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, padded.

    Every id is in one piece; offsets in a sequence have no gaps; `padded` is the length of the
    sequence with its padding. A null text is empty (its end id only); null ids come first; rows
    with equal ids are separate documents, in text order; an empty table gives no row; columns
    besides doc_id and text are ignored.
    """
    runtime.prepare(docs.sparkSession)
    path = tokenizer_path or tokens.default_path()

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(path, end_id)
        packer = _Packer(longest, encoder.sentence_ends, TaskContext.get().partitionId() * SEQUENCES_PER_PARTITION)
        kind = None

        def rows(last: bool) -> pa.RecordBatch:
            out = packer.cut(last)
            return pa.RecordBatch.from_arrays([pa.array(v, kind if k == "doc_id" else pa.int64()) for k, v in out.items()], list(out))

        for batch in batches:
            kind = batch.schema.field(0).type
            doc_ids = batch.column(0).to_pylist()
            for row, ids in encoder.documents(arrays.text_array(batch.column(1))):
                packer.add(doc_ids[row], ids)
                if packer.n >= BLOCK_IDS:
                    yield rows(False)
        if packer.n:
            yield rows(True)

    return in_id_order(docs).mapInArrow(packed, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {PIECES}")
