"""SimHash near-duplicates by the general pigeonhole principle.

Equal fingerprints fall together first.  The 64 bits are grouped into partitions of correlated bits; two fingerprints
within ``max_bits`` differ by at most t_i bits in some partition i whenever the thresholds add up to
max_bits - partitions + 1.  Dynamic programming gives each partition its own threshold (-1: not probed) for the least
estimated cost of probes and candidates.  Every fingerprint is indexed by its bits in each partition and probes all
values within the threshold; candidates are verified inside the join, and a pair counts in the first partition that
finds it.  Links become components by star steps.  Estimates use a bounded sample; the search covers all.

Null or empty text: fingerprint zero, linked like any other.  Null ``doc_id``: shares its component, never names one
unless no document in it has an id (then null).  Repeated rows: one result each.  Empty table: no rows.  Other columns
are ignored (``near_duplicates_kept`` carries them).
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coderail.llm.common import free_name, materialise, release, table, with_text_column
from coderail.llm.components import components

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
#: Fingerprints from which bit correlations and candidate counts are estimated.
SAMPLE = 10_000
#: Cost of a probe, which is shuffled, against a candidate, which is compared in place.
PROBE_COST, CANDIDATE_COST = 1.0, 0.1


def fingerprint(text: str | None, width: int = SHINGLE_WORDS) -> int:
    """Majority of the bits of the XXH64 of all word shingles; a bit is set if over half of the hashes have it."""
    words = (text or "").encode().lower().split()  # bytes: A-Z and the ASCII blanks only
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts, ends = (ends - lengths, ends[width - 1 :]) if len(words) >= width else ([0], [len(joined)])
    digest, hashes = xxhash.xxh64_intdigest, np.empty(len(ends), np.uint64)
    hashes[:] = [digest(joined[a:b], SEED) for a, b in zip(list(starts), list(ends), strict=False)]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def with_fingerprints(docs: DataFrame, width: int = SHINGLE_WORDS) -> DataFrame:
    """``docs`` with ``fp_``, the fingerprint as a signed long."""
    return with_text_column(docs, "fp_", "long", lambda texts: pa.array([fingerprint(t, width) for t in texts], pa.int64()))


def group_bits(sample: np.ndarray, parts: int) -> list[list[int]]:
    """Bits dealt to ``parts`` even partitions, each grown by the bit most correlated with it."""
    bits = np.unpackbits(sample.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(float)
    spread = bits.std(0)
    spread[spread == 0] = 1
    bits = (bits - bits.mean(0)) / spread
    alike = np.abs(bits.T @ bits) / max(1, len(bits))
    np.fill_diagonal(alike, 0)
    left, out = set(range(64)), []
    for k in range(parts):
        size = len(left) // (parts - k)
        group = [max(left, key=lambda b: (alike[b, list(left)].sum(), -b))]
        left.discard(group[0])
        while len(group) < size:
            best = max(left, key=lambda b: (alike[b, group].sum(), -b))
            group.append(best)
            left.discard(best)
        out.append(sorted(group))
    return out


def mask(bits) -> int:
    """The bits as a signed 64-bit mask."""
    value = sum(1 << b for b in bits)
    return value - (1 << 64) if value >> 63 else value


def flips(group: list[int], most: int) -> list[int]:
    """All masks of at most ``most`` bits of the group."""
    return [mask(c) for n in range(most + 1) for c in combinations(group, n)]


def candidates_per_row(sample: np.ndarray, group: list[int], most: int, total: int) -> list[float]:
    """Estimated rows that a probe meets at thresholds 0 to ``most``: sample pairs, and no less than for even bits."""
    keys, n = np.unique(sample & np.int64(mask(group)), return_counts=True)
    out, pairs, even = [], 0.0, 0.0
    for t in range(most + 1):
        for c in combinations(group, t):
            other = keys ^ np.int64(mask(c))
            at = np.minimum(np.searchsorted(keys, other), len(keys) - 1)
            pairs += float((n * n[at])[keys[at] == other].sum()) - (len(sample) if t == 0 else 0)
            even += 2.0 ** -len(group)
        out.append(total * max(even, pairs / max(1, len(sample)) ** 2))
    return out


def allocate(sample: np.ndarray, total: int, max_bits: int = MAX_BITS) -> list[tuple[list[int], int]]:
    """Partitions with their thresholds: the cheapest over 2 to ``max_bits`` + 1 partitions."""
    best, best_cost = None, float("inf")
    for parts in range(2, max_bits + 2):
        groups, budget = group_bits(sample, parts), max_bits - parts + 1
        most = min(budget + parts - 1, 2)  # three flips in a wide partition cost more than any other split
        table_ = {0: (0.0, [])}  # thresholds' sum so far -> cost and thresholds
        for g in groups:
            seen = candidates_per_row(sample, g, most, total)
            probes = np.cumsum([len(list(combinations(g, t))) for t in range(most + 1)])
            cost = {-1: 0.0} | {t: PROBE_COST * (probes[t] + 1) + CANDIDATE_COST * seen[t] for t in range(most + 1)}
            grown: dict[int, tuple[float, list[int]]] = {}
            for s, (c, ts) in table_.items():
                for t, more in cost.items():
                    if s + t not in grown or c + more < grown[s + t][0]:
                        grown[s + t] = (c + more, [*ts, t])
            table_ = grown
        if budget in table_ and table_[budget][0] < best_cost:
            best_cost, best = table_[budget][0], list(zip(groups, table_[budget][1], strict=True))
    return best


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """All pairs a < b of different fingerprints (column fp) that differ in at most ``max_bits`` bits."""
    total = fps.count()
    drawn = fps.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE)
    sample = np.array(sorted(r["fp"] for r in drawn.collect()), np.int64)
    plan = allocate(sample if len(sample) else np.zeros(1, np.int64), total, max_bits)
    probed = [(k, mask(g), flips(g, t), t) for k, (g, t) in enumerate(plan) if t >= 0]
    index = fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(k).alias("part"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for k, m, _, _ in probed])).alias("s"))
    index = index.select(F.col("fp").alias("b"), "s.part", "s.key")
    probe = fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(k).alias("part"), F.lit(m).alias("mask"), F.array(*map(F.lit, fl)).alias("flips")) for k, m, fl, _ in probed])).alias("s"))
    probe = probe.select(F.col("fp").alias("a"), "s.part", F.col("fp").bitwiseAND(F.col("s.mask")).alias("own"), F.explode("s.flips").alias("flip"))
    probe = probe.select("a", "part", F.col("own").bitwiseXOR(F.col("flip")).alias("key"))
    differ = F.col("a").bitwiseXOR(F.col("b"))
    met = (F.col("a") < F.col("b")) & (F.bit_count(differ) <= max_bits)
    for k, m, _, t in probed:  # not found by an earlier partition
        met &= (F.col("p.part") <= k) | (F.bit_count(differ.bitwiseAND(F.lit(m))) > t)
    same = (F.col("p.part") == F.col("i.part")) & (F.col("p.key") == F.col("i.key"))
    return probe.alias("p").join(index.alias("i"), same & met).select("a", "b")  # only true links leave the join


def near_duplicates(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fp_) to one row per document with ``component_id``, the smallest doc_id reachable over links."""
    nodes = materialise(prints.groupBy(F.col("fp_").alias("fp")).agg(F.min("doc_id").alias("first")), "fingerprints")
    edges = materialise(links(nodes.select("fp"), max_bits), "simhash_links")
    release(prints.sparkSession)
    roots = components(edges)
    rooted = nodes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    rooted = materialise(rooted, "simhash_rooted")
    # written as well, so that both sides of the join are plain shuffles and Spark can split a large component
    least = materialise(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "simhash_least")
    return materialise(rooted.join(least, "root").select(F.col("fp").alias("fp_"), "component_id", "root"), "simhash_components")


def near_duplicates_kept(docs: DataFrame, width: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one document of each component: the smallest doc_id, then the smallest text hash."""
    printed = with_fingerprints(docs.select("doc_id", "text"), width)
    prints = materialise(printed.select("doc_id", F.xxhash64("text").alias("h"), "fp_"), "prints")
    roots = near_duplicates(prints, max_bits)
    stays = free_name(docs, "_stays")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")
    one = prints.join(roots, "fp_").groupBy("root").agg(F.min(rank).alias("r")).select("r.doc_id", "r.h")
    many = prints.groupBy("doc_id", "h").agg(F.count("*").alias("n"))
    one = materialise(one.alias("o").join(many.alias("m"), F.col("o.doc_id").eqNullSafe(F.col("m.doc_id")) & (F.col("o.h") == F.col("m.h")))
                      .select(F.struct(F.col("o.doc_id").alias("id"), F.col("o.h").alias("h"), "n").alias(stays)), "simhash_kept")
    stay = docs.join(one, docs["doc_id"].eqNullSafe(F.col(f"{stays}.id")) & (F.xxhash64(docs["text"]) == F.col(f"{stays}.h")))
    columns = [docs[f"`{c}`"] for c in docs.columns]
    single = stay.where(f"{stays}.n = 1").select(columns)
    repeated = stay.where(f"{stays}.n > 1").dropDuplicates([stays]).select(docs.columns)
    return single.unionByName(repeated)


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    prints = materialise(with_fingerprints(docs).select("doc_id", "fp_"), "prints")
    roots = near_duplicates(prints)
    return prints.join(roots, "fp_").select("doc_id", F.lower(F.lpad(F.hex("fp_"), 16, "0")).alias("fingerprint"), "component_id")
