import random
import zlib

import numpy as np
import public_tokenizers
from cases import as_sf, edge_docs, edge_rows, empty_docs
from tokenizers import Tokenizer

from coderail.llm import tokens
from coderail.llm.op01_dac import dac_decode, dac_encode, dac_get, op1_token_dac, read_documents, token_at, write_ids

PATH = public_tokenizers.path("word_bpe_49k.json")


def reference(rows, end):
    tk = Tokenizer.from_file(PATH)
    out, start = [], 0
    for doc_id, text in sorted(((r[0], r[1]) for r in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = tk.encode(text or "", add_special_tokens=False).ids + [end]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    return out


def test_levels_round_trip_and_random_access():
    rng = np.random.default_rng(5)
    for ids in (np.array([], np.uint32), rng.integers(0, 49408, 5000).astype(np.uint32), rng.integers(0, 256, 700).astype(np.uint32),
                (2.0 ** rng.uniform(0, 31.9, 3000)).astype(np.uint32)):
        levels = dac_encode(ids)
        assert (dac_decode(levels) == ids).all()
        assert [dac_get(levels, i) for i in range(len(ids))] == ids.tolist()


def test_query_equals_the_library_on_edge_documents(spark, tmp_path):
    got = sorted((tuple(r) for r in op1_token_dac(spark, as_sf(spark, edge_docs(spark), tmp_path)).collect()), key=lambda r: r[1])
    want = [r[:4] for r in reference(edge_rows(), 1)]
    assert sorted(((r[0], *r[2:]) for r in got), key=lambda r: (r[0] or -1, r[1:])) == sorted(((r[0], *r[2:]) for r in want), key=lambda r: (r[0] or -1, r[1:]))
    assert [r[0] for r in got] == [r[0] for r in want] and [r[1] for r in got] == [sum(x[2] for x in got[:i]) for i in range(len(got))]


def test_small_blocks_and_token_at(spark, tmp_path):
    path = str(tmp_path / "ids")
    write_ids(edge_docs(spark), path, PATH, end_id=1, block_tokens=500, partition_bytes=1 << 14)
    rows = sorted(read_documents(spark, path).collect(), key=lambda r: r["start"])
    want = np.concatenate([np.frombuffer(r["ids"], "<u4") for r in rows]).tolist()
    assert sorted(want) == sorted(i for r in reference(edge_rows(), 1) for i in r[4])
    for at in random.Random(2).sample(range(len(want)), 5):
        assert token_at(spark, path, at) == want[at]
    assert token_at(spark, path, len(want)) is None


def test_empty_table(spark, tmp_path):
    assert op1_token_dac(spark, as_sf(spark, empty_docs(spark), tmp_path)).count() == 0


def test_full_cache_changes_nothing(monkeypatch):
    texts = [r[1] for r in edge_rows()]
    want = tokens.ChunkEncoder(PATH).encode(texts)
    monkeypatch.setattr(tokens, "CACHE_CHUNKS", 20)
    small = tokens.ChunkEncoder(PATH)
    assert small.encode(texts) == want == small.encode(texts)
    assert len(small.known) <= 20
