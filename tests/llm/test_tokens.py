from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.ipc as ipc
import pytest

from lendmill.llm import packing, token_stream, tokens
from lendmill.session import shared_path
from tests.llm.cases import awkward_rows, empty, frame


@pytest.fixture(scope="module")
def encoder():
    return tokens.Encoder(tokens.default_path(), 2)


def whole(encoder, text):
    return [*encoder.tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def test_ids_equal_those_of_whole_texts(encoder):
    rnd = random.Random(5)
    signs = list("abzAZéÉßİıſKΣσς  \n\t\r\x0b\x0c\x1c\x85\xa0 　.,!?'\"’ss'tI'm0129²½Ⅳ̧́ʰǅ中文あ한国😀👍🏽-_<|>#@$%^&*") + ["<|endoftext|>", "<|ENDOFTEXT|>", "'ll", "n't", "word", "...", "é", "Å"]
    texts = ["".join(rnd.choice(signs) for _ in range(rnd.randint(0, 50))) for _ in range(3000)] + ["", None, "don't stop.,; now!!"]
    array = pa.array(["" if t is None else t for t in texts], pa.large_string())
    for row, ids in encoder.documents(array):
        assert ids.tolist() == whole(encoder, texts[row]), texts[row]


def test_cache_halves_turn_over(encoder, monkeypatch):
    monkeypatch.setattr(tokens, "CACHED_WORDS", 10)
    small = tokens.Encoder(tokens.default_path(), 2)
    texts = [f"{a}bcd{b} word" for a in "qwertz" for b in "asdfgh"] * 2
    for text in texts:
        for _, ids in small.documents(pa.array([text], pa.large_string())):
            assert ids.tolist() == whole(encoder, text)


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))


def test_files_round_trip(spark, encoder):
    rows = awkward_rows()
    got = token_stream.round_trip(spark, frame(spark, rows), sequence=64).collect()
    start, want = 0, []
    for d, text, _, _ in in_order(rows):
        ids = np.array(whole(encoder, text), "<u4")
        want.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    order = lambda r: (r[1], r[2])
    assert sorted((tuple(r) for r in got), key=order) == sorted(want, key=order)
    assert token_stream.round_trip(spark, empty(spark)).count() == 0


def test_file_layout(spark, encoder):
    rows = awkward_rows()
    manifest = token_stream.write_token_files(frame(spark, rows), shared_path(spark, "files"), sequence=32).collect()
    total = 0
    for shard in sorted(manifest, key=lambda r: r["shard"]):
        file = token_stream.TokenFile(shard["ids_path"])
        schema = ipc.open_stream(pa.memory_map(shard["ids_path"].removeprefix("file://"))).schema
        assert schema.field("ids").type == pa.list_(pa.uint16(), 32) and schema.field("mask").type == pa.list_(pa.bool_(), 32)
        masks = np.concatenate([file[i][1] for i in range(len(file))])
        assert masks.sum() == shard["n_ids"] and masks[: shard["n_ids"]].all()
        assert {b.num_rows for b in file.batches[:-1]} <= {token_stream.ROWS_PER_BATCH}
        total += shard["n_docs"]
    assert total == len(rows)


def check_pieces(pieces, rows, encoder, longest):
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p["doc_id"], []).append(p)
        by_sequence.setdefault(p["sequence_id"], []).append(p)
    for d, text, _, _ in rows:
        ids, copies = np.array(whole(encoder, text), "<u4"), sum(r[0] == d for r in rows)
        own = sorted(by_doc[d], key=lambda p: p["start"])
        assert sum(p["length"] for p in own) == sum(len(whole(encoder, t)) for x, t, _, _ in rows if x == d)
        if copies == 1:
            at = 0
            for p in own:
                assert p["start"] == at and p["doc_tokens"] == len(ids) and p["ids_crc32"] == zlib.crc32(ids[at : at + p["length"]].tobytes())
                at += p["length"]
    for sequence in by_sequence.values():
        at = 0
        for p in sorted(sequence, key=lambda p: p["offset"]):
            assert p["offset"] == at and p["length"] > 0
            at += p["length"]
        assert at <= longest and sequence[0]["padded"] == at + packing.padding(at, longest)


def test_packing_keeps_every_id(spark, encoder):
    rows = awkward_rows()
    for longest in (64, 4096):
        check_pieces(packing.pack(frame(spark, rows), longest=longest).collect(), rows, encoder, longest)
    assert packing.pack(empty(spark)).count() == 0


def test_blocks_carry_their_last_sequence(spark, encoder, monkeypatch):
    rows = [(i, " ".join(["river stone."] * (i % 37 + 1)), "en", "s") for i in range(200)]
    ids = {d: np.array(whole(encoder, t), np.uint32) for d, t, _, _ in rows}
    packer, pieces = packing._Packer(128, encoder.sentence_ends, 0), []
    for d, own in ids.items():
        packer.add(d, own)
        if packer.n >= 500:
            pieces.append(packer.cut(False))
    pieces.append(packer.cut(True))
    flat = [dict(zip(p, values)) for p in pieces for values in zip(*p.values())]
    check_pieces(flat, rows, encoder, 128)


def test_cuts_have_the_least_cost():
    rnd = random.Random(11)
    for _ in range(60):
        n = rnd.randint(1, 40)
        ends = np.array(sorted({rnd.randint(1, n) for _ in range(4)} | {n}))
        marks = np.array(sorted({rnd.randint(1, n) for _ in range(8)}), np.int64)
        places, cost = packing.cut_places(n, ends, marks, 8)
        cuts = packing.best_cuts(places, cost, 8)
        price = dict(zip(places.tolist(), cost.tolist()))
        best = {0: 0}
        for j in places.tolist()[1:]:
            best[j] = min(best[i] + packing.padding(j - i, 8) + price[j] for i in best if 0 < j - i <= 8)
        assert sum(packing.padding(b - a, 8) + price[b] for a, b in zip(cuts, cuts[1:])) == best[n]


def test_ids_that_do_not_fit_are_an_error(spark, tmp_path):
    with pytest.raises(ValueError, match="do not fit"):
        token_stream.write_token_files(frame(spark, [(1, "a word", "en", "s")]), str(tmp_path), id_type="uint8")
