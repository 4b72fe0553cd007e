"""Token ids of whole texts inside Arrow tasks.

A tokenizer of the `tokenizers` library that never joins text across white space gives the same
ids piece by piece. So each text is split at ASCII white space, each distinct piece of a slice is
encoded once, and the ids are gathered back into text order. A piece of letters with closing
punctuation is encoded as two: letters, whatever their case, and marks are separate words to the
tokenizer. Words of letters are kept per worker process in a cache of two bounded halves.
"""

from __future__ import annotations

import os
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from lendmill.llm import arrays

CACHED_WORDS = 200_000
WORDS_PER_CALL = 256
SLICE_BYTES = 1 << 23
# The marks that end a sentence, as whole pieces of the vocabulary.
SENTENCE_MARKS = (".", "!", "?", "...", "!!", "!!!", "??", '."', '!"', '?"')
WORD_END = "</w>"
# Letters whose lower case is one letter (ASCII, Latin-1 and on to U+012F), then ASCII signs but the apostrophe.
WORD_AND_MARKS = "^(?P<word>[A-Za-zÀ-ÖØ-öø-į]+)(?P<marks>[!-&(-/:-@\\[-`{-~]*)$"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Encoder:
    """Ids of texts by the tokenizer file at `path`, each text closed by `end_id`.

    The tokenizer must lower-case, split letters from other signs and mark the end of a word in
    its last token; other files need `exact_words=False`, which encodes every piece as it stands.
    """

    def __init__(self, path: str, end_id: int, exact_words: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.exact_words = exact_words
        self.end = np.array([end_id], np.uint32).tobytes()
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for t, i in vocabulary.items() if t.endswith(WORD_END)]] = True
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}
        self.sentence_ends = np.array(sorted(vocabulary[m + WORD_END] for m in SENTENCE_MARKS if m + WORD_END in vocabulary), np.uint32)

    def _whole(self, pieces: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def _learn(self, words: list[str]) -> None:
        """Encode words of letters, many to a call: each ends at the next end-of-word token."""
        for lo in range(0, len(words), WORDS_PER_CALL):
            part = words[lo : lo + WORDS_PER_CALL]
            ids = np.array(self.tokenizer.encode(" ".join(part), add_special_tokens=False).ids, np.uint32)
            ends = (np.flatnonzero(self.ends_word[ids]) + 1) * 4
            if len(ends) != len(part):
                self.new.update(zip(part, self._whole(part)))
                continue
            raw, at = ids.tobytes(), 0
            for word, end in zip(part, ends.tolist()):
                self.new[word] = raw[at:end]
                at = end

    def _words(self, words: list[str]) -> list[bytes]:
        if len(self.new) > CACHED_WORDS:
            self.old, self.new = self.new, {}
        new, old = self.new, self.old
        fresh = [w for w in words if w not in new]
        kept = {w: old[w] for w in fresh if w in old}
        new.update(kept)
        self._learn([w for w in fresh if w not in kept])
        return [new[w] for w in words]

    def _units(self, pieces: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """Distinct encoded units, and each piece's first and second unit (the last unit is empty)."""
        if self.exact_words:
            split = pc.extract_regex(pieces, WORD_AND_MARKS)
            whole = np.flatnonzero(split.is_null().to_numpy(zero_copy_only=False))
            word, marks = (split.field(i) for i in (0, 1))
            at = np.flatnonzero(split.is_valid().to_numpy(zero_copy_only=False))
            word, marks = pc.utf8_lower(word.take(pa.array(at))).dictionary_encode(), marks.take(pa.array(at)).dictionary_encode()
        else:
            whole, at = np.arange(len(pieces)), np.zeros(0, np.int64)
            word = marks = pa.array([], pa.large_string()).dictionary_encode()
        closings = marks.dictionary.to_pylist()
        units = self._words(word.dictionary.to_pylist())
        units += self._whole(closings)
        first, second = np.empty(len(pieces), np.int32), np.empty(len(pieces), np.int32)
        first[at] = word.indices.to_numpy(zero_copy_only=False)
        second[at] = marks.indices.to_numpy(zero_copy_only=False) + len(word.dictionary)
        first[whole] = len(units) + np.arange(len(whole))
        units += self._whole(pieces.take(pa.array(whole)).to_pylist())
        second[whole] = len(units)
        units.append(b"")
        return units, first, second

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids (unsigned 32 bit) in order, and the number of ids of each text."""
        split = pc.ascii_split_whitespace(texts)
        pieces = split.flatten().dictionary_encode()
        units, first, second = self._units(pieces.dictionary)
        lengths = np.array([len(u) for u in units] + [len(self.end)], np.int32) // 4
        bounds = np.zeros(len(lengths) + 1, np.int32)
        np.cumsum(lengths, out=bounds[1:])
        lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.frombuffer(b"".join([*units, self.end]), np.uint32)))
        offsets = np.asarray(split.offsets).astype(np.int64)
        offsets -= offsets[0]
        piece = pieces.indices.to_numpy(zero_copy_only=False)
        # two units for each piece; the end id follows each text
        pairs = np.empty((len(piece), 2), np.int32)
        pairs[:, 0], pairs[:, 1] = first[piece], second[piece]
        order = np.insert(pairs.reshape(-1), 2 * offsets[1:], len(units))
        upto = np.concatenate([[0], np.cumsum(lengths[order], dtype=np.int64)])
        flat = lists.take(pa.array(order[lengths[order] > 0])).flatten().to_numpy(zero_copy_only=False)
        return flat, np.diff(upto[2 * offsets + np.arange(len(offsets))])

    def documents(self, texts: pa.Array):
        """(row, ids) of each text."""
        for first, end, _, _ in arrays.slices(texts, SLICE_BYTES):
            flat, sizes = self.encode(texts.slice(first, end - first))
            at = 0
            for row, n in enumerate(sizes.tolist(), first):
                yield row, flat[at : at + n]
                at += n
            # the pool would keep the slice's buffers beside those of the next
            pa.default_memory_pool().release_unused()


@lru_cache(maxsize=2)
def encoder(path: str, end_id: int) -> Encoder:
    return Encoder(path, end_id)
