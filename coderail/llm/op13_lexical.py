"""Ranked lexical search: term at a time, rarest first, with limited accumulators.

The documents become shards of an inverted index: a directory (ids and lengths) and, per term, the places and counts of
the shard's documents that hold it.  The index is written once and joined with the terms of the queries, so only
postings of asked terms go on.  A (shard, block of queries) is the unit of work.  There each query takes its terms
by ascending document frequency.  A document gets an accumulator when a term first meets it, until the largest gains
of the terms left add up to less than the k-th best partial score; from then on no accumulator is made and the
existing ones are updated to their exact scores.  (A document without accumulator then scores below k others.)  One shard in
``SEED_SHARDS`` is searched first; its k-th scores are where the others start from.

Null text: no terms.  Null ``doc_id``: found like any other, last among ties.  Null item or item without terms: no
rows.  Repeated documents or items: each row is a document, or a query, of its own.  Ties: ascending ``doc_id``.  Empty
tables: no rows.  Very long texts: a shard of their own size.  Other columns are ignored.
Memory: one shard's postings of asked terms and one block of queries.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from coderail.llm.common import arrow_slices, exact_ids, materialise, table, text_bytes

# Fixed values of the score (see ``gains``) and of the terms: all but ASCII blanks, signs and control characters.
SCALE, LENGTH_SHARE, TF_FACTOR, LENGTH_FACTOR = 1_000_000_000, 90, 1000, 8
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TOP = 10
#: A shard ends with the document that reaches one of these.
SHARD_DOCS, SHARD_BYTES = 16_384, 32 << 20
#: Query terms of a block, about.
BLOCK_TERMS = 1 << 18
SEED_SHARDS = 16

#: Byte by byte: letters to lower case, what is in no term to a blank; bytes of other characters stay.
FOLD = bytes((c + 32 if 65 <= c <= 90 else c) if c >= 128 or chr(c).isalnum() else 32 for c in range(256))

INDEX = "shard long, term binary, df int, places binary, counts binary, ids binary, missing binary, lengths binary"


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


def shard_rows(shard: int, ids: list, found: list[np.ndarray], terms: list[bytes]) -> Iterator[pa.RecordBatch]:
    """The postings, a row per term, and the directory of a shard; ``found`` has the term numbers of each document."""
    lengths = np.array([len(f) for f in found], "<i8")
    place = np.repeat(np.arange(len(found), dtype=np.int64), lengths)
    pair, tf = np.unique(np.concatenate([*found, np.zeros(0, np.int64)]) << 32 | place, return_counts=True)
    term = pair >> 32
    edges = np.concatenate([[0], np.flatnonzero(np.diff(term)) + 1, [len(term)]]) if len(term) else np.zeros(1, np.int64)
    n, offsets = len(edges) - 1, pa.py_buffer((edges * 4).astype("<i4"))

    def lists(values: np.ndarray) -> pa.Array:
        return pa.Array.from_buffers(pa.binary(), n, [None, offsets, pa.py_buffer(values.astype("<u4"))])

    names, none = [c.split()[0] for c in INDEX.split(", ")], pa.nulls(n, pa.binary())
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, shard)), pa.array(terms, pa.binary()), pa.array(np.diff(edges).astype("<i4")),
         lists(pair & 0xFFFFFFFF), lists(tf), none, none, none], names=names)
    directory = {"shard": shard, "ids": np.array([i or 0 for i in ids], "<i8").tobytes(),
                 "missing": np.array([i is None for i in ids], np.uint8).tobytes(), "lengths": lengths.tobytes()}
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in INDEX.split(", ")])
    yield pa.RecordBatch.from_pylist([directory], schema=schema)


def build_index(docs: DataFrame, shard_docs: int = SHARD_DOCS, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The written index of ``docs`` (doc_id, text): rows with a ``term`` are postings, the others directories."""

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, ids, found, size, number = TaskContext.get().partitionId() << 32, [], [], 0, defaultdict(count().__next__)
        for batch in arrow_slices(batches, "text", shard_bytes):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                words = terms_of(text)
                ids.append(doc_id)
                found.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
                size += len(text)
                if len(ids) >= shard_docs or size >= shard_bytes:
                    yield from shard_rows(shard, ids, found, list(number))
                    shard, ids, found, size, number = shard + 1, [], [], 0, defaultdict(count().__next__)
        if ids:
            yield from shard_rows(shard, ids, found, list(number))

    return materialise(docs.select("doc_id", text_bytes().alias("text")).mapInArrow(shards, INDEX), "lexical_index")


def query_terms(items: DataFrame, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """rid (a number per item row), item_id, term and block of each distinct term of each item."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        rid = TaskContext.get().partitionId() << 40
        for batch in batches:
            out = []
            for item, text in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                rid += 1
                out += [(rid, item, term) for term in dict.fromkeys(terms_of(text))]
            columns = list(zip(*out)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.binary()), strict=True)],
                                             names=["rid", "item_id", "term"])

    asked = items.select("item_id", text_bytes().alias("text")).mapInArrow(rows, "rid long, item_id long, term binary")
    asked = materialise(asked, "query_terms")
    blocks = max(1, -(-asked.count() // block_terms))
    return asked.withColumn("block", F.pmod(F.xxhash64("rid"), F.lit(blocks)))


def gains(tf: np.ndarray, lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """A term's gain, before its weight, in documents of these lengths."""
    if LENGTH_SHARE * int(lengths.max(initial=0)) * n_docs >= 1 << 63:
        lengths = lengths.astype(object)
    m = (100 - LENGTH_SHARE + LENGTH_SHARE * lengths * n_docs // n_terms).astype(np.int64)
    return SCALE * tf // (TF_FACTOR * tf + LENGTH_FACTOR * m)


def accumulate(postings: list[tuple[np.ndarray, np.ndarray]], n_docs: int, k: int, least: int = 0) -> tuple[np.ndarray, np.ndarray, int]:
    """Documents with an accumulator, their exact scores, and after how many terms no accumulator was made any more.

    ``postings``: places and gains of each term, rarest first; ``least``: a score that ``k`` documents elsewhere reach.
    """
    score, made = np.zeros(n_docs, np.int64), np.zeros(n_docs, bool)
    left = np.cumsum([int(g.max(initial=0)) for _, g in postings][::-1], dtype=object)[::-1] if postings else []
    closed = len(postings)
    for i, (places, gain) in enumerate(postings):
        if closed > i:
            kth = least
            if kth <= left[i] <= score.max(initial=0):
                held = score[made]
                kth = max(kth, int(np.partition(held, len(held) - k)[len(held) - k])) if len(held) >= k else kth
            if left[i] < kth:
                closed = i
            else:
                made[places] = True
                score[places] += gain  # a document is once in a term's list
                continue
        old = made[places]
        score[places[old]] += gain[old]
    docs = np.flatnonzero(made)
    return docs, score[docs], closed


HIT = "rid long, item_id long, doc_id long, score long"


def search(index: DataFrame, asked: DataFrame, k: int = TOP, seed_shards: int = SEED_SHARDS) -> DataFrame:
    """item_id, rank, doc_id and score of each item's ``k`` best documents."""
    directory = index.where("term is null").select("shard", "ids", "missing", "lengths")

    def with_terms(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for x in pdf["lengths"]:
                n = np.frombuffer(x, "<i8")
                yield pd.DataFrame({"n": [int((n > 0).sum())], "total": [int(n.sum())]})

    total = directory.select("lengths").mapInPandas(with_terms, "n long, total long").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).first()
    n_docs, n_terms = total["n"] or 0, total["total"] or 0
    blocks = asked.select("block", "term").distinct()
    hits = index.where("term is not null").select("shard", "term", "df", "places", "counts").join(blocks, "term")
    hits = materialise(hits, "lexical_hits")
    weight = F.floor(F.lit(1000.0) * F.log((2.0 * n_docs + 2.0) / (F.lit(2.0) * F.col("df") + 1.0))).cast("long")
    weights = hits.groupBy("block", "term").agg(F.sum("df").alias("df")).withColumn("w", weight)
    one = F.struct("df", "term", "w")
    asked = asked.withColumn("item_id", F.col("item_id").cast("string"))
    queries = materialise(asked.join(weights, ["block", "term"]).groupBy("rid", "item_id", "block")
                          .agg(F.array_sort(F.collect_list(one)).alias("terms")), "lexical_queries")  # rarest first

    def meet(key: tuple, rows: pd.DataFrame, items: pd.DataFrame) -> pd.DataFrame:
        names = [c.split()[0] for c in HIT.split(", ")]
        head = rows[rows["term"].isna()]
        if not len(head) or not len(items):
            return pd.DataFrame([], columns=names)
        head = head.iloc[0]
        ids, missing, lengths = np.frombuffer(head["ids"], "<i8"), np.frombuffer(head["missing"], np.uint8) > 0, np.frombuffer(head["lengths"], "<i8")
        postings = {}
        for row in rows[rows["term"].notna()].itertuples():
            places = np.frombuffer(row.places, "<u4").astype(np.int64)
            postings[bytes(row.term)] = places, gains(np.frombuffer(row.counts, "<u4").astype(np.int64), lengths[places], n_docs, n_terms)
        out = []
        for item in items.itertuples():
            mine = [(t, postings[t][0], postings[t][1] * x["w"]) for x in item.terms if (t := bytes(x["term"])) in postings]
            docs, score, _ = accumulate([(p, g) for _, p, g in mine], len(ids), k, item.least)
            held = (score > 0) & (score >= item.least)
            docs, score = docs[held], score[held]
            for at in np.lexsort((ids[docs], missing[docs], -score))[:k].tolist():
                out.append((item.rid, item.item_id, None if missing[docs[at]] else int(ids[docs[at]]), int(score[at])))
        made = pd.DataFrame(out, columns=names)
        return made.assign(item_id=exact_ids([r[1] for r in out]), doc_id=exact_ids([r[2] for r in out]))

    none = F.lit(None).cast("binary")
    n_blocks = (asked.agg(F.max("block")).first()[0] or 0) + 1

    def searched(shards, items: DataFrame, name: str) -> DataFrame:
        heads = directory.where(shards).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))))
        left = (hits.where(shards).select("shard", "block", "term", "places", "counts", none.alias("ids"), none.alias("missing"), none.alias("lengths"))
                .unionByName(heads.select("shard", "block", none.alias("term"), none.alias("places"), none.alias("counts"), "ids", "missing", "lengths")))
        right = items.join(heads.select(F.col("shard").alias("s"), "block"), "block")
        return materialise(left.groupBy("shard", "block").cogroup(right.groupBy("s", "block")).applyInPandas(meet, HIT), name)

    seed = F.pmod(F.xxhash64("shard"), F.lit(seed_shards)) == 0
    first = searched(seed, queries.withColumn("least", F.lit(0).cast("long")), "lexical_seed")
    by_score = Window.partitionBy("rid").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    kth = first.withColumn("r", F.row_number().over(by_score)).where(F.col("r") == k).select("rid", F.col("score").alias("least"))
    rest = searched(~seed, queries.join(kth, "rid", "left").withColumn("least", F.coalesce("least", F.lit(0).cast("long"))), "lexical_rest")
    found = first.unionByName(rest).withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
    return found.select("item_id", "rank", "doc_id", "score")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(build_index(table(spark, sf_dir, "documents")), query_terms(table(spark, sf_dir, "benchmark")))


OP13_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), items AS (
  SELECT row_number() OVER () AS rid, item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM benchmark
), sizes AS (
  SELECT CAST(count(*) FILTER (len(terms) > 0) AS BIGINT) AS N, CAST(sum(len(terms)) AS BIGINT) AS L FROM docs
), tfs AS (
  SELECT d, doc_id, size, term, count(*) AS tf FROM (SELECT d, doc_id, CAST(len(terms) AS BIGINT) AS size, unnest(terms) AS term FROM docs) GROUP BY ALL
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * CAST(any_value(N) AS DOUBLE) + 2) / (2 * CAST(count(*) AS DOUBLE) + 1))) AS BIGINT) AS w FROM tfs, sizes GROUP BY term
), scores AS (
  SELECT rid, item_id, d, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * size * N) // L))))) AS BIGINT) AS score
  FROM (SELECT DISTINCT rid, item_id, unnest(terms) AS term FROM items) JOIN tfs USING (term) JOIN weights USING (term), sizes
  GROUP BY rid, item_id, d, doc_id
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY rid ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank FROM scores WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
