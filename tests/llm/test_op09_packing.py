import random
import zlib

import numpy as np
import public_tokenizers
from cases import as_sf, edge_docs, edge_rows, empty_docs
from tokenizers import Tokenizer

from coderail.llm.op09_packing import first_fit_decreasing, op9_ffd_packing, pack_documents, sequences

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_tree_equals_plain_first_fit_decreasing():
    rng = random.Random(3)
    for n in (0, 1, 2, 7, 300):
        lengths = [rng.randint(1, 100) for _ in range(n)]
        room, want = [], {}
        for i in sorted(range(n), key=lambda i: -lengths[i]):
            b = next((b for b, r in enumerate(room) if r >= lengths[i]), len(room))
            if b == len(room):
                room.append(100)
            want[i] = (b, 100 - room[b])
            room[b] -= lengths[i]
        bins, offsets = first_fit_decreasing(np.array(lengths, np.int64), 100)
        assert {i: (bins[i], offsets[i]) for i in range(n)} == want


def test_every_id_lies_in_one_piece_and_sequences_are_gapless(spark, tmp_path):
    rows = op9_ffd_packing(spark, as_sf(spark, edge_docs(spark), tmp_path)).collect()
    tk, want = Tokenizer.from_file(PATH), []
    for r in edge_rows():
        ids = tk.encode(r[1] or "", add_special_tokens=False).ids + [2]
        for s in range(0, len(ids), 4096):
            part = ids[s : s + 4096]
            want.append((r[0], s, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), len(ids)))
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted((tuple(r)[:5] for r in rows), key=key) == sorted(want, key=key)
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(by) == -(-sum(r["length"] for r in rows) // 4096)


def test_sequences_are_padded_except_at_a_power_of_two(spark):
    docs = spark.createDataFrame([(1, "a " * 15), (2, "b " * 9)], "doc_id long, text string")
    packed = pack_documents(docs, PATH, seq_len=20, with_ids=True)
    got = {r["n_tokens"]: len(r["ids"]) // 4 for r in sequences(packed, 20, 0).collect()}
    assert got == {16: 16, 10: 20}


def test_empty_table(spark, tmp_path):
    assert op9_ffd_packing(spark, as_sf(spark, empty_docs(spark), tmp_path)).count() == 0
