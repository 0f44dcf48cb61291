"""Substring dedup by suffixes: difference cover, one suffix bucket at a time.

A byte goes if a 100-byte string covers it that also starts earlier (smaller doc_id, or same document, earlier start).

1. Equal whole texts: only the first is searched; a later copy of 100 bytes or more goes whole.
2. Candidates: 32-byte grams that are the least of some window's grams (by hash) are its anchors.  Equal windows have
   equal least grams, so a window whose least gram occurs once in all texts is unique and needs no sorting.
3. Cover sample: positions p with p mod 7 in {1, 2, 4}.  Any two positions i, j have a d < 7 for which i + d and j + d are
   both in the sample.  The ranks of the sample suffixes by their first 94 bytes stand for the long part of every
   comparison; the 6 bytes around it decide the rest.
4. Bucket after bucket: the suffixes of a bucket (a range of rank keys) are sorted by rank key, d by d; of those with
   equal rank and equal bytes around it all but the earliest start a repeated string.  Only one bucket is shuffled
   and sorted at a time, its part per task is bounded by the number of partitions, and equal suffixes of one batch
   are merged before the shuffle, so a passage found everywhere sends one suffix per batch.

Rank keys are 64-bit hashes: equality is all that the result needs, and the 48 bits around are compared as they are.

Null text: empty.  Null ``doc_id``: before all others.  Equal ids: by the text's hash.  Repeated rows: the second is a
copy of the first.  Empty table: no rows.  Other columns are ignored.  Memory: some 100 bytes per byte of a slice
(``SLICE_BYTES``) or of the longest text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coderail.llm.common import materialise, mix64, parts_for, release, slices, table, text_bytes
from coderail.llm.words import BASE, powers, running

WINDOW = 100
MOD, COVER = 7, (1, 2, 4)
CORE = WINDOW - MOD + 1
GRAM = 32
#: Suffix buckets, handled one after the other.
BUCKETS = 6
SLICE_BYTES = 2 << 20
PART_BYTES = 16 << 20

IN_COVER = np.isin(np.arange(MOD), COVER)
RECORD = np.dtype([("core", "<u8"), ("around", "V12"), ("low", "u1"), ("high", "u1"), ("gid", "<i8"), ("at", "<u4")])
FOUND = np.dtype([("gid", "<i8"), ("at", "<u4"), ("mask", "u1")])
ANCHOR = np.dtype([("hash", "<u8"), ("gid", "<i8"), ("at", "<u4"), ("again", "u1")])


def gram_hashes(data: np.ndarray, width: int, at: np.ndarray | None = None) -> np.ndarray:
    """Hashes of the ``width`` bytes from every position on, or from ``at`` on."""
    powers.to(len(data) + 1)
    with np.errstate(over="ignore"):
        sums = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers.up[: len(data)])])
        if at is None:
            return mix64((sums[width:] - sums[:-width]) * powers.down[: len(data) - width + 1])
        return mix64((sums[at + width] - sums[at]) * powers.down[at])


def join_texts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes, and where each text starts and ends."""
    ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
    return np.frombuffer(b"".join(texts), np.uint8), ends - [len(t) for t in texts], ends


def inside(starts: np.ndarray, ends: np.ndarray, width: int, n: int) -> np.ndarray:
    """Positions (of ``n``) from which ``width`` bytes stay in their text."""
    steps = np.zeros(n + 1, np.int32)
    ok = ends - starts >= width
    np.add.at(steps, starts[ok], 1)
    np.add.at(steps, ends[ok] - width + 1, -1)
    return np.cumsum(steps)[:n] > 0


def gram_keys(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every gram and the key by which grams are compared."""
    h = gram_hashes(data, GRAM)
    return h, (h >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def anchors(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text and offset of every gram that is least in some window of its text."""
    data, starts, ends = join_texts(texts)
    none = np.zeros(0, np.int64)
    if len(data) < WINDOW:
        return none.astype(np.uint64), none, none
    h, key = gram_keys(data)
    width = WINDOW - GRAM + 1
    least = running(key, width, np.minimum)
    least[~inside(starts, ends, WINDOW, len(least))] = 0
    pad = np.zeros(width - 1, np.uint32)
    at = np.flatnonzero(running(np.concatenate([pad, least, pad]), width, np.maximum) == key)
    text = np.searchsorted(ends, at, side="right")
    return h[at], text, at - starts[text]


def alive(texts: list[bytes], text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Of every byte of the joined texts: a window starts there and its least gram is among the given anchors."""
    data, starts, ends = join_texts(texts)
    if len(data) < WINDOW:
        return np.zeros(len(data), bool)
    _, key = gram_keys(data)
    given = np.full(len(key), np.iinfo(np.uint32).max)
    place = starts[text] + at
    given[place] = key[place]
    width = WINDOW - GRAM + 1
    same = running(key, width, np.minimum) == running(given, width, np.minimum)
    out = np.zeros(len(data), bool)
    out[: len(same)] = same & inside(starts, ends, WINDOW, len(same))
    return out


def _blocks(records: np.ndarray, bucket: np.ndarray, kind: int) -> Iterator[dict]:
    """One row per bucket, its records packed."""
    if not len(records):
        return
    order = np.argsort(bucket, kind="stable")
    keys, first = np.unique(bucket[order], return_index=True)
    for k, part in zip(keys.tolist(), np.split(records[order], first[1:]), strict=True):
        yield {"bucket": k, "kind": kind, "data": part.tobytes()}


BLOCK = "bucket long, kind int, data binary"


def _frame(rows: list[dict]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["bucket", "kind", "data"])


def _unpack(pdf: pd.DataFrame, kind: int, dtype: np.dtype) -> np.ndarray:
    return np.frombuffer(b"".join(pdf.loc[pdf["kind"] == kind, "data"]), dtype)


def home(gid, parts: int):
    """Where a document's findings and its text meet."""
    return gid % parts


def repeated_anchors(texts: DataFrame, parts: int) -> DataFrame:
    """Anchors that occur more than once, packed by the home of their document (bucket, data of gid and at)."""
    where = np.dtype([("gid", "<i8"), ("at", "<u4")])

    def send(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in slices(frames, "text", SLICE_BYTES):
            h, text, at = anchors(list(pdf["text"]))
            order = np.argsort(h, kind="stable")
            h, gid, at = h[order], pdf["gid"].to_numpy()[text[order]], at[order]
            same = np.concatenate([[False], h[1:] == h[:-1]]) if len(h) else np.zeros(0, bool)
            out = np.zeros(len(h), ANCHOR)
            out["hash"], out["gid"], out["at"] = h, gid, at
            out["again"][:-1] = same[1:]
            known = np.zeros(int(same.sum()), where)
            known["gid"], known["at"] = gid[same], at[same]
            # of equal anchors of one batch the first goes on; the others are known to be repeated
            yield _frame([*_blocks(out[~same], (h[~same] % np.uint64(parts)).astype(np.int64), 0),
                          *_blocks(known, home(known["gid"], parts), 1)])

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        got = _unpack(pdf, 0, ANCHOR)
        got = got[np.argsort(got["hash"], kind="stable")]
        same = got["hash"][1:] == got["hash"][:-1]
        again = got["again"] > 0
        again[1:] |= same
        again[:-1] |= same
        found = np.concatenate([got[["gid", "at"]][again].astype(where), _unpack(pdf, 1, where)])
        return _frame(list(_blocks(found, home(found["gid"], parts), 0)))

    return texts.mapInPandas(send, BLOCK).groupBy("bucket").applyInPandas(meet, BLOCK)


def candidates(texts: DataFrame, repeated: DataFrame, parts: int) -> DataFrame:
    """Documents with windows whose least gram repeats: gid, text, and the runs of such windows (first, last)."""

    def runs(texts: list[bytes], gids: np.ndarray, got: np.ndarray) -> Iterator[tuple]:
        order = np.argsort(gids, kind="stable")
        live = alive(texts, order[np.searchsorted(gids, got["gid"], sorter=order)], got["at"])
        start = 0
        for gid, t in zip(gids.tolist(), texts, strict=True):
            edge = np.flatnonzero(np.diff(np.concatenate([[0], live[start : start + len(t)].astype(np.int8), [0]])))
            start += len(t)
            if len(edge):
                pairs = edge.reshape(-1, 2).astype("<i8")
                pairs[:, 1] -= 1
                yield gid, t, pairs.tobytes()

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        got = np.frombuffer(b"".join(right["data"]), np.dtype([("gid", "<i8"), ("at", "<u4")]))
        got = got[np.argsort(got["gid"], kind="stable")]
        owner, out = np.ascontiguousarray(got["gid"]), []
        for pdf in slices(iter([left.drop_duplicates("gid").sort_values("gid")]), "text", SLICE_BYTES):
            gids = pdf["gid"].to_numpy()
            near = got[np.searchsorted(owner, gids[0]) : np.searchsorted(owner, gids[-1], side="right")]
            out += runs(list(pdf["text"]), gids, near[np.isin(near["gid"], gids)])
        return pd.DataFrame(out, columns=["gid", "text", "runs"])

    homed = texts.withColumn("bucket", F.pmod("gid", F.lit(parts)))
    return (homed.groupBy("bucket").cogroup(repeated.groupBy("bucket"))
            .applyInPandas(meet, "gid long, text binary, runs binary"))


def sample_suffixes(texts: list[bytes], runs: list[np.ndarray], gids: np.ndarray, bucket: int, buckets: int) -> np.ndarray:
    """Records of one bucket's cover suffixes that serve the windows of ``runs``."""
    run = np.concatenate([np.zeros((0, 2), np.int64), *runs])
    owner = np.repeat(np.arange(len(texts)), [len(r) for r in runs])
    data, starts, ends = join_texts([texts[k][a : b + WINDOW] for k, (a, b) in zip(owner.tolist(), run.tolist(), strict=True)])
    seg = np.repeat(np.arange(len(run)), ends - starts)
    at = np.arange(len(data)) - starts[seg]  # in its segment
    pos = np.flatnonzero(IN_COVER[(at + run[seg, 0]) % MOD] & (at + CORE <= (ends - starts)[seg]))
    core = gram_hashes(data, CORE, pos)
    mine = (core >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32) == bucket
    pos, core = pos[mine], core[mine]
    seg, at = seg[pos], at[pos]
    side = MOD - 1
    padded = np.concatenate([np.zeros(side, np.uint8), data, np.zeros(side, np.uint8)])
    around = np.empty((len(pos), 2 * side), np.uint8)
    for k in range(side):
        around[:, k], around[:, side + k] = padded[pos + k], padded[pos + side + CORE + k]
    rec = np.zeros(len(pos), RECORD)
    rec["core"], rec["around"], rec["gid"], rec["at"] = core, around.view("V12")[:, 0], gids[owner[seg]], at + run[seg, 0]
    rec["low"] = np.maximum(0, at - (run[seg, 1] - run[seg, 0]))  # the d whose window lies in the run
    rec["high"] = np.minimum(side, at)
    return rec


def _pieces(rec: np.ndarray) -> list[np.ndarray]:
    """Of each d, the bytes that with the core make the window starting d before the suffix."""
    around = np.ascontiguousarray(rec["around"]).view(np.uint8).reshape(-1, 2 * (MOD - 1))
    out = []
    for d in range(MOD):
        wide = np.zeros((len(rec), 8), np.uint8)
        wide[:, : MOD - 1] = around[:, MOD - 1 - d : 2 * (MOD - 1) - d]
        out.append(wide.view("<u8")[:, 0])
    return out


def _valid(rec: np.ndarray) -> np.ndarray:
    """Bit d: the window starting d before the suffix takes part."""
    d = np.arange(MOD)
    ok = (d >= rec["low"][:, None]) & (d <= rec["high"][:, None])
    return (ok << d).sum(1).astype(np.uint8)


def later(rec: np.ndarray) -> np.ndarray:
    """Bit d: a window equal to the one starting d before the suffix starts earlier (both serve in this bucket)."""
    out = np.zeros(len(rec), np.uint8)
    order = np.argsort(rec["core"], kind="stable")
    core = rec["core"][order]
    first = np.concatenate([[True], core[1:] != core[:-1]]) if len(core) else np.zeros(0, bool)
    single = first & np.concatenate([first[1:], [True]]) if len(core) else first
    order = order[~single]
    if not len(order):
        return out
    group = np.cumsum(first[~single]) - 1  # the rank of the core among those that occur twice or more
    part = rec[order]
    heads = np.flatnonzero(np.diff(group, prepend=-1))
    gid, at = part["gid"], part["at"].astype(np.int64)
    least = np.minimum.reduceat(gid, heads)[group]
    at_least = np.minimum.reduceat(np.where(gid == least, at, np.iinfo(np.int64).max), heads)[group]
    lead = np.zeros(len(heads), np.int64)
    is_lead = (gid == least) & (at == at_least)
    lead[group[is_lead]] = np.flatnonzero(is_lead)
    lead = lead[group]
    valid, mask = _valid(part), np.zeros(len(part), np.uint8)
    for d, piece in enumerate(_pieces(part)):
        bit = np.uint8(1 << d)
        takes = (valid & bit > 0) & ~is_lead
        same = takes & (valid[lead] & bit > 0) & (piece == piece[lead])
        mask[same] |= bit
        rest = np.flatnonzero(takes & ~same)  # compared among themselves
        if len(rest) > 1:
            o = rest[np.lexsort((at[rest], gid[rest], piece[rest], group[rest]))]
            equal = (group[o[1:]] == group[o[:-1]]) & (piece[o[1:]] == piece[o[:-1]])
            head = np.maximum.accumulate(np.where(np.concatenate([[True], ~equal]), np.arange(len(o)), 0))
            lead_of = o[head]
            mask[o[(gid[lead_of] < gid[o]) | (at[lead_of] < at[o])]] |= bit
    out[order] = mask
    return out


def repeated_in_bucket(found: DataFrame, bucket: int, buckets: int, parts: int) -> DataFrame:
    """Sort the suffixes of one bucket; starts of repeated windows, packed by the home of their document."""

    def pack(rec: np.ndarray, mask: np.ndarray) -> np.ndarray:
        hit = mask > 0
        out = np.zeros(int(hit.sum()), FOUND)
        out["gid"], out["at"], out["mask"] = rec["gid"][hit], rec["at"][hit], mask[hit]
        return out[np.lexsort((out["at"], out["gid"]))]

    def send(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in slices(frames, "text", SLICE_BYTES):
            runs = [np.frombuffer(r, "<i8").reshape(-1, 2) for r in pdf["runs"]]
            rec = sample_suffixes(list(pdf["text"]), runs, pdf["gid"].to_numpy(), bucket, buckets)
            around = np.ascontiguousarray(rec["around"]).view(np.uint8).reshape(-1, 12)
            a, b = (np.ascontiguousarray(around[:, k : k + 6]) for k in (0, 6))
            key = rec["core"].copy()
            with np.errstate(over="ignore"):
                for x in (a, b):
                    wide = np.zeros((len(rec), 8), np.uint8)
                    wide[:, :6] = x
                    key = mix64(key * BASE + wide.view("<u8")[:, 0])
                key = mix64(key + rec["low"] * np.uint64(8) + rec["high"])
            order = np.lexsort((rec["at"], rec["gid"], key))
            rec, key = rec[order], key[order]
            same = np.concatenate([[False], key[1:] == key[:-1]])
            # of equal suffixes of one batch the first goes on; the others start no later string than it does
            known = pack(rec[same], _valid(rec[same]))
            rec = rec[~same]
            yield _frame([*_blocks(rec, (rec["core"] % np.uint64(parts)).astype(np.int64), 0),
                          *_blocks(known, home(known["gid"], parts), 1)])

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        rec = _unpack(pdf, 0, RECORD)
        hits = np.concatenate([pack(rec, later(rec)), _unpack(pdf, 1, FOUND)])
        return _frame(list(_blocks(hits, home(hits["gid"], parts), 0)))

    return found.mapInPandas(send, BLOCK).groupBy("bucket").applyInPandas(meet, BLOCK)


def cut_out(text: bytes, at: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Removed runs (start, end) of a text, from the repeated windows found."""
    start = np.zeros(len(text) + 1, bool)
    for d in range(MOD):
        start[at[mask & (1 << d) > 0] - d] = True
    start = np.flatnonzero(start)
    if not len(start):
        return start, start
    gap = np.flatnonzero(start[1:] > start[:-1] + WINDOW) + 1  # windows that touch make one run
    return start[np.concatenate([[0], gap])], start[np.concatenate([gap - 1, [len(start) - 1]])] + WINDOW


def removals(found: DataFrame, hits: DataFrame, parts: int, spans: bool) -> DataFrame:
    """Per searched document with repeats: gid, n_removed, n_spans, kept_sha256 (and the kept text, if ``spans``)."""

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        got = np.frombuffer(b"".join(right["data"]), FOUND)
        order = np.argsort(got["gid"], kind="stable")
        at, mask, gids = got["at"][order].astype(np.int64), got["mask"][order], left["gid"].to_numpy()
        first, last = (np.searchsorted(got["gid"][order], gids, side=side).tolist() for side in ("left", "right"))
        out = []
        for gid, text, a, b in zip(gids.tolist(), left["text"], first, last, strict=True):
            starts, ends = cut_out(text, at[a:b], mask[a:b])
            kept = b"".join(text[i:j] for i, j in zip([0, *ends], [*starts, len(text)], strict=True))
            out.append((gid, int((ends - starts).sum()), len(starts), hashlib.sha256(kept).hexdigest(), *[kept] * spans))
        return pd.DataFrame(out, columns=["gid", "n_removed", "n_spans", "kept_sha256", *["kept"] * spans])

    homed = found.select("gid", "text", F.pmod("gid", F.lit(parts)).alias("bucket"))
    schema = "gid long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if spans else "")
    return homed.groupBy("bucket").cogroup(hits.groupBy("bucket")).applyInPandas(meet, schema)


def _digest(text: Column) -> Column:
    return F.sha2(text, 256)


def dedup_substrings(docs: DataFrame, buckets: int = BUCKETS, part_bytes: int = PART_BYTES, kept: bool = False) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and the kept bytes)."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", text_bytes().alias("text")).withColumn("digest", _digest(F.col("text")))
    rows = materialise(docs.groupBy("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes"))
                       .agg(F.count("*").alias("copies")), "suffix_rows")
    who = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id")
    firsts = rows.groupBy("digest", "n_bytes").agg(F.min(who).alias("f")).select("digest", "n_bytes", "f.known", "f.doc_id")
    firsts = materialise(firsts.repartitionByRange("known", "doc_id", "digest").sortWithinPartitions("known", "doc_id", "digest")
                         .withColumn("gid", F.monotonically_increasing_id()), "suffix_firsts")
    parts = parts_for(firsts, F.col("n_bytes"), part_bytes)
    f = firsts.where(F.col("n_bytes") >= WINDOW).select(F.col("doc_id").alias("f_id"), F.col("digest").alias("f_digest"), "gid")
    texts = materialise(docs.join(f, docs["doc_id"].eqNullSafe(f["f_id"]) & (docs["digest"] == f["f_digest"]))
                        .select("gid", "text"), "suffix_texts")
    release(spark)
    repeated = materialise(repeated_anchors(texts, parts), "suffix_anchors")
    release(spark)
    found = materialise(candidates(texts, repeated, parts), "suffix_candidates")
    release(spark)
    hits = None
    for k in range(buckets):
        one = materialise(repeated_in_bucket(found, k, buckets, parts), f"suffix_bucket_{k}")
        hits = one if hits is None else hits.unionByName(one)
        release(spark)
    gone = materialise(removals(found, hits, parts, kept), "suffix_removed")
    release(spark)
    known = firsts.select("digest", "gid", F.col("doc_id").alias("f_id")).join(gone, "gid", "left").drop("gid")
    each = rows.join(known, "digest").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    first = F.col("doc_id").eqNullSafe(F.col("f_id")) & (F.col("copy") == 1)
    copy = ~first & (F.col("n_bytes") >= WINDOW)
    out = each.select(
        "doc_id", "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copy, _digest(F.lit(b""))).otherwise(F.coalesce("kept_sha256", "digest")).alias("kept_sha256"),
        *([F.when(copy, F.lit(b"")).otherwise(F.col("kept")).alias("kept"), "digest"] if kept else []))
    return out


def op2_substring_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(table(spark, sf_dir, "documents"))


OP2_SQL = """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), w AS (
  SELECT doc_id, i, substr(h, 2 * i + 1, 200) AS s
  FROM (SELECT doc_id, h, unnest(range(greatest(len(h) // 2 - 99, 0))) AS i FROM d)
), repeated AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS rn FROM w) WHERE rn > 1
), marked AS (
  SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END AS opens FROM repeated
), numbered AS (
  SELECT doc_id, i, sum(opens) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked
), runs AS (
  SELECT doc_id, min(i) AS a, max(i) + 100 AS b FROM numbered GROUP BY doc_id, run
), pieces AS (
  SELECT r.doc_id, r.a, substr(d.h, 2 * coalesce(lag(r.b) OVER (PARTITION BY r.doc_id ORDER BY r.a), 0) + 1,
    2 * (r.a - coalesce(lag(r.b) OVER (PARTITION BY r.doc_id ORDER BY r.a), 0))) AS before
  FROM runs r JOIN d ON r.doc_id = d.doc_id
), cut AS (
  SELECT doc_id, string_agg(before, '' ORDER BY a) AS head FROM pieces GROUP BY doc_id
), sums AS (
  SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last FROM runs GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(s.n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(s.n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(c.head, '') || substr(d.h, 2 * coalesce(s.last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN sums s ON d.doc_id = s.doc_id LEFT JOIN cut c ON d.doc_id = c.doc_id
"""
