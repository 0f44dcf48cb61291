"""Fuzzy passages that repeat across documents, by collinear chaining of shared word k-mers.

1. Seeds: k-mers of words that are least of some window of ``WINDOW`` k-mers (by hash); any run of K + WINDOW - 1 equal
   words has one, and both sides choose it alike.  Wide seeds beside them: any run of ``MIN_WORDS`` equal words has one.
2. Matches: each seed is joined to its earliest occurrence in another document, so a passage found in thousands of
   documents gives one match per occurrence, never pairs among them.
3. Chains: matches of a document with one earlier document merge into exact fragments (same diagonal, seeds that overlap
   or touch); fragments are chained in order on both sides, the best predecessor within ``MAX_GAP`` words under a linear
   gap cost coming from a tree of range maxima.
4. Alignment: the words between the fragments of a chain and beside its ends are fetched by pages; gaps are aligned by
   least edits, ends are extended while equal words outweigh others.  Passages of ``MIN_WORDS`` words and up with
   ``MIN_SIMILARITY`` equal words are reported; a chain that is none is split at its worst gap, and its parts judged.

"Earlier" means smaller doc_id (null first; equal ids by a hash of the text; then any order among repeated rows).
Null or empty text: no passage.  Null ``doc_id``: takes part, reported as null.  Repeated rows: the second repeats the
first.  Empty table: no rows.  Other columns are ignored (``without_passages`` carries them).  Memory: one document's
matches, pages of one chain.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coderail.llm.common import arrow_slices, materialise, mix64, parts_for, release, table
from coderail.llm.words import BASE, Batch, running

K = 8
WINDOW = 8
GAP_COST = 0.5
#: Words that a gap of a chain may span on either side.
MAX_GAP = 40
#: Wide seeds, least of WIDE_WINDOW by hash: any run of MIN_WORDS equal words has one.  Words that are stock phrases one
#: by one, each first seen in another document, meet here in the first document that has them together.
WIDE = 32
WIDE_WINDOW = 19
#: Words on each side of a seed that are carried along, BITS bits of a hash each.
BESIDE = 10
BITS = 3
#: ``extend``: words that it may leave out, and equal words that must follow.
JUMP = 6
CONFIRM = 4
MIN_WORDS = 50
MIN_SIMILARITY = 0.8
PAGE = 64
SLICE_BYTES = 1 << 20


def text_seeds(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text, first word, and whether it is the text's first with this hash, of the seeds of some texts."""
    return batch_seeds(Batch(texts))


def batch_seeds(batch: Batch, k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    w, n = batch.word_hash, len(batch.word_hash)
    if n < k + window - 1:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none.astype(bool)
    with np.errstate(over="ignore"):
        h = np.zeros(n - k + 1, np.uint64)
        for i in range(k):
            h = (h + w[i : n - k + 1 + i]) * BASE
        h = mix64(h)
    key = (h >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    least = running(key, window, np.minimum)
    least[batch.word_doc[k + window - 2 :] != batch.word_doc[: len(least)]] = 0  # the window leaves its text
    pad = np.zeros(window - 1, np.uint32)
    at = np.flatnonzero(running(np.concatenate([pad, least, pad]), window, np.maximum) == key)
    first_word = np.concatenate([[0], np.cumsum(batch.n_words)])
    h, text = h[at], batch.word_doc[at]

    def in_order() -> tuple[np.ndarray, np.ndarray]:
        order = np.lexsort((at, h, text))
        return order, (h[order[1:]] == h[order[:-1]]) & (text[order[1:]] == text[order[:-1]])

    order, same = in_order()
    tight = np.concatenate([[False], same & (np.diff(at[order]) <= k)])  # text that repeats itself within k words:
    rank = np.arange(len(at)) - np.maximum.accumulate(np.where(tight, 0, np.arange(len(at))))
    with np.errstate(over="ignore"):  # the n-th turn on one side goes with the n-th on the other
        h[order] = np.where(tight, mix64(h[order] + rank.astype(np.uint64) * BASE), h[order])
    order, same = in_order()
    lead = np.ones(len(at), bool)
    lead[order[1:]] = ~same
    return h, text, at - first_word[text], lead


def beside(batch: Batch, text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """BITS bits of each of the BESIDE words behind a seed, nearest lowest, and above them of those before it; 0 past the text's ends."""
    code = np.concatenate([(batch.word_hash >> np.uint64(64 - BITS)).astype(np.int64), [0]])
    last = np.cumsum(batch.n_words)
    first = last - batch.n_words
    out = np.zeros(len(at), np.int64)
    for i in range(BESIDE):
        right, left = first[text] + at + K + i, first[text] + at - 1 - i
        out |= code[np.where(right < last[text], right, -1)] << (BITS * i)
        out |= code[np.where(left >= first[text], left, -1)] << (BITS * (BESIDE + i))
    return out


def may_extend(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether ``extend`` may get anywhere from a seed, by what ``beside`` says of both sides; never false where it does.

    Equal words have equal bits, so its score is at most the one counted here.
    """
    out = np.zeros(len(a), bool)
    for side in (0, BITS * BESIDE):
        u, v = ((x >> side) & ((1 << BITS * BESIDE) - 1) for x in (a, b))
        score, ended = np.zeros(len(a), np.int64), np.zeros(len(a), bool)
        for i in range(BESIDE):
            score += np.where(((u ^ v) >> (BITS * i)) & ((1 << BITS) - 1) == 0, 1, -2)
            out |= ~ended & (score > 0)
            ended |= score < -6
        out |= ~ended
        for m in range(JUMP + 1):
            for n in range(JUMP + 1):
                if m + n:
                    out |= ((u >> (BITS * m)) ^ (v >> (BITS * n))) & ((1 << BITS * CONFIRM) - 1) == 0
    return out


def seeds(docs: DataFrame) -> DataFrame:
    """(rid, text) to (seed, rid, at, lead, beside); ``beside`` is -1 at a wide seed."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrow_slices(batches, "text", SLICE_BYTES):
            batch = Batch(part.column("text").to_pylist())
            rid = part.column("rid").to_numpy()
            for k, window in ((K, WINDOW), (WIDE, WIDE_WINDOW)):
                h, text, at, lead = batch_seeds(batch, k, window)
                near = beside(batch, text, at) if k == K else np.full(len(at), -1, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), pa.array(rid[text]), pa.array(at.astype(np.int32)), pa.array(lead), pa.array(near)],
                    names=["seed", "rid", "at", "lead", "beside"])

    return docs.select("rid", "text").mapInArrow(rows, "seed long, rid long, at int, lead boolean, beside long")


def matches(found: DataFrame) -> DataFrame:
    """Seeds with their earliest occurrence, where that lies in an earlier document: (rid, at, beside, first, first_at, first_beside)."""
    lead = F.when(F.col("lead"), F.col("rid"))
    firsts = (found.groupBy("seed").agg(F.min("rid").alias("first"), F.max("rid").alias("last"), F.min_by("at", lead).alias("first_at"),
                                         F.min_by("beside", lead).alias("first_beside"))
              .where("last > first").drop("last"))
    firsts = materialise(firsts, "repeated_seeds")  # far fewer than all seeds, whose shuffle files can go now
    release(found.sparkSession)
    step = F.explode(F.when(F.col("beside") < 0, F.array(*map(F.lit, range(0, WIDE, K)))).otherwise(F.array(F.lit(0))))
    return (found.drop("lead").join(firsts, "seed").where("rid > first").withColumn("step", step)  # a wide seed as K words each
            .select("rid", (F.col("at") + F.col("step")).alias("at"), "beside", "first",
                    (F.col("first_at") + F.col("step")).alias("first_at"), "first_beside"))


NONE = (float("-inf"), -1)


class Maxima:
    """Largest value (with its owner) of a range of places."""

    def __init__(self, n: int):
        self.n, self.best = n, [NONE] * (2 * n)

    def put(self, i: int, value: tuple[float, int]) -> None:
        i += self.n
        self.best[i] = value
        while i > 1:
            i >>= 1
            self.best[i] = max(self.best[2 * i], self.best[2 * i + 1])

    def between(self, a: int, b: int) -> tuple[float, int]:
        """Of the places from a to before b."""
        out, a, b = NONE, a + self.n, b + self.n
        while a < b:
            if a & 1:
                out, a = max(out, self.best[a]), a + 1
            if b & 1:
                b -= 1
                out = max(out, self.best[b])
            a, b = a >> 1, b >> 1
        return out


def chain(fragments: list[tuple[int, int, int]], cost: float = GAP_COST, max_gap: int = MAX_GAP) -> list[list[int]]:
    """Chains of fragments (x, y, length), best first; each fragment is in one chain.

    Score of a chain: its words, less ``cost`` for every word between its fragments on either side.  A predecessor is
    the best of those that end at most ``max_gap`` words before on both sides: on the first side they enter the tree
    and leave it again, on the second side the tree is asked for a range.
    """
    n = len(fragments)
    by_start = sorted(range(n), key=lambda i: fragments[i][:2])
    end_x = [x + m for x, _, m in fragments]
    by_end = sorted(range(n), key=lambda i: end_x[i])
    by_end_y = sorted(range(n), key=lambda i: fragments[i][1] + fragments[i][2])
    ends_y = [fragments[i][1] + fragments[i][2] for i in by_end_y]
    place = [0] * n
    for r, i in enumerate(by_end_y):
        place[i] = r
    tree, score, before, put, gone = Maxima(n), [0.0] * n, [-1] * n, 0, 0
    for i in by_start:
        x, y, m = fragments[i]
        while put < n and end_x[by_end[put]] <= x:
            j = by_end[put]
            tree.put(place[j], (score[j] + cost * (end_x[j] + ends_y[place[j]]), j))
            put += 1
        while gone < put and end_x[by_end[gone]] < x - max_gap:
            tree.put(place[by_end[gone]], NONE)
            gone += 1
        value, j = tree.between(bisect_left(ends_y, y - max_gap), bisect_right(ends_y, y))
        value -= cost * (x + y)
        if j >= 0 and value > 0:
            before[i] = j
        score[i] = m + (value if before[i] >= 0 else 0)
    free, out = [True] * n, []
    for i in sorted(range(n), key=lambda i: (-score[i], i)):
        made = []
        while i >= 0 and free[i]:
            free[i] = False
            made.append(i)
            i = before[i]
        if made:
            out.append(made[::-1])
    return out


CHAIN = "rid long, first long, fragments binary"


def chains(found: DataFrame, parts: int) -> DataFrame:
    """Chains of each document with each earlier one; ``fragments`` packs (x, y, length) as int32.

    A chain of one seed is left out only if its alignment would get nowhere: then it is the seed's K words.
    """

    def of(pdf: pd.DataFrame) -> Iterator[tuple]:
        rid, first, x, y = (pdf[c].to_numpy() for c in ("rid", "first", "at", "first_at"))
        order = np.lexsort((x, x - y, first, rid))
        rid, first, x, y = rid[order], first[order], x[order], y[order]
        pair = (rid[1:] != rid[:-1]) | (first[1:] != first[:-1])
        cut = np.concatenate([[True], pair | (x[1:] - y[1:] != x[:-1] - y[:-1]) | (x[1:] - x[:-1] > K)])
        head = np.flatnonzero(cut)
        tail = np.concatenate([head[1:], [len(x)]]) - 1
        fragments = np.stack([x[head], y[head], x[tail] - x[head] + K], axis=1)
        owner, target = rid[head], first[head]
        edge = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (target[1:] != target[:-1]), [True]]))
        alone = (tail == head) & ~may_extend(pdf["beside"].to_numpy()[order][head], pdf["first_beside"].to_numpy()[order][head])
        for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
            part = fragments[a:b]
            for c in [[0]] if b - a == 1 else chain([tuple(f) for f in part.tolist()]):
                if len(c) > 1 or not alone[a + c[0]]:
                    yield int(owner[a]), int(target[a]), part[c].astype("<i4").tobytes()

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = []
        for pdf in frames:  # sorted by rid: the last document of a batch may go on in the next
            if not len(pdf):
                continue
            held.append(pdf)
            last = pdf["rid"].iloc[-1]
            if held[0]["rid"].iloc[0] == last:
                continue
            pdf = pd.concat(held)
            done = pdf[pdf["rid"] != last]
            held = [pdf[pdf["rid"] == last]]
            yield pd.DataFrame(list(of(done)), columns=["rid", "first", "fragments"])
        if held:
            yield pd.DataFrame(list(of(pd.concat(held))), columns=["rid", "first", "fragments"])

    return found.repartition(parts, "rid").sortWithinPartitions("rid").mapInPandas(rows, CHAIN)


def wanted_pages(fragments: np.ndarray) -> tuple[set[int], set[int]]:
    """Pages of the document and of the earlier one that the alignment of a chain and of its parts reads."""
    out = []
    for side in (0, 1):
        start, end = fragments[:, side], fragments[:, side] + fragments[:, 2]
        spans = [s for a, b in zip(start.tolist(), end.tolist()) for s in ((max(0, a - MIN_WORDS), a), (b, b + MIN_WORDS))]
        out.append({p for a, b in spans if a < b for p in range(a // PAGE, (b - 1) // PAGE + 1)})
    return out[0], out[1]


def edit_matches(a: list[bytes], b: list[bytes]) -> int:
    """Equal words in an alignment of ``a`` and ``b`` with the fewest edits (most equal words among those)."""
    row = [(j, 0) for j in range(len(b) + 1)]  # edits, minus equal words
    for i, x in enumerate(a, 1):
        old, row = row, [(i, 0)]
        for j, y in enumerate(b, 1):
            e, m = old[j - 1]
            best = (e, m - 1) if x == y else (e + 1, m)
            row.append(min(best, (old[j][0] + 1, old[j][1]), (row[-1][0] + 1, row[-1][1])))
    return -row[-1][1]


def extend(a: list[bytes], b: list[bytes], jump: int = JUMP, confirm: int = CONFIRM) -> tuple[int, int, int]:
    """How far equal words go on, on both sides, and how many they are.

    Words are compared one by one: +1 and -2 per word, up to the best sum, given up 6 below it.  Then up to ``jump``
    words may be left out on either side if ``confirm`` equal words follow, and so on.
    """
    x = y = equal = 0
    while True:
        best = score = far = hits = best_hits = 0
        for i, (p, q) in enumerate(zip(a[x:], b[y:]), 1):
            score += 1 if p == q else -2
            hits += p == q
            if score > best:
                best, far, best_hits = score, i, hits
            elif score < best - 6:
                break
        x, y, equal = x + far, y + far, equal + best_hits
        here = b[y : y + jump + 1]
        follow = [(m + n, m, n) for m, p in enumerate(a[x : x + jump + 1]) if p in here for n, q in enumerate(here)
                  if p == q and m + n and len(a) >= x + m + confirm and a[x + m : x + m + confirm] == b[y + n : y + n + confirm]]
        if not follow:
            return x, y, equal
        _, m, n = min(follow)
        x, y = x + m, y + n


class Pages:
    def __init__(self, got: dict[int, list[bytes]]):
        self.got = got

    def words(self, a: int, b: int) -> list[bytes]:
        out: list[bytes] = []
        for p in range(max(0, a) // PAGE, (b - 1) // PAGE + 1 if b > a else 0):
            page = self.got.get(p, [])
            out += page[max(0, a - p * PAGE) : b - p * PAGE]
        return out


def align(fragments: np.ndarray, mine: Pages, theirs: Pages) -> list[tuple[int, int, int, int, float]]:
    """The passages of a chain: start and end in both documents, similarity.

    A chain that is no passage as a whole is split at its worst gap (most words that are not equal) and its parts are
    judged again, down to single fragments.
    """
    parts = fragments.tolist()
    gaps = []
    for (ax, ay, am), (bx, by, _) in zip(parts, parts[1:]):
        equal = edit_matches(mine.words(ax + am, bx), theirs.words(ay + am, by))
        gaps.append((max(bx - ax - am, by - ay - am) - equal, equal))
    out, todo = [], [(0, len(parts))]
    while todo:
        a, b = todo.pop()
        (x0, y0, _), (x1, y1, last) = parts[a], parts[b - 1]
        x1, y1, equal = x1 + last, y1 + last, sum(m for _, _, m in parts[a:b]) + sum(e for _, e in gaps[a : b - 1])
        back, front = (w[::-1] for w in (mine.words(x0 - MIN_WORDS, x0), theirs.words(y0 - MIN_WORDS, y0)))
        dx, dy, hits = extend(back, front)
        x0, y0, equal = x0 - dx, y0 - dy, equal + hits
        dx, dy, hits = extend(mine.words(x1, x1 + MIN_WORDS), theirs.words(y1, y1 + MIN_WORDS))
        x1, y1, equal = x1 + dx, y1 + dy, equal + hits
        similarity = equal / max(x1 - x0, y1 - y0)
        if x1 - x0 >= MIN_WORDS and similarity >= MIN_SIMILARITY:
            out.append((x0, x1, y0, y1, similarity))
        elif b - a > 1:
            cut = max(range(a, b - 1), key=lambda i: gaps[i][0]) + 1
            todo += [(cut, b), (a, cut)]
    return out


def pages(docs: DataFrame) -> DataFrame:
    """(rid, text) to its words by pages: (rid, page, words)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrow_slices(batches, "text", SLICE_BYTES):
            rids, numbers, made = [], [], []
            for rid, text in zip(part.column("rid").to_pylist(), part.column("text").to_pylist(), strict=True):
                words = (text or "").encode().split()
                n = -(-len(words) // PAGE)
                rids += [rid] * n
                numbers += range(n)
                made += [b" ".join(words[p * PAGE : (p + 1) * PAGE]) for p in range(n)]
            yield pa.RecordBatch.from_arrays([pa.array(rids, pa.int64()), pa.array(numbers, pa.int32()), pa.array(made, pa.binary())],
                                             names=["rid", "page", "words"])

    return docs.select("rid", "text").mapInArrow(rows, "rid long, page int, words binary")


def passages(docs: DataFrame, parts: int) -> DataFrame:
    """Per passage of (rid, text) found in an earlier document: rid, start_word, end_word, first, first_start,
    first_end, similarity."""
    spark = docs.sparkSession
    made = materialise(chains(matches(seeds(docs)), parts).withColumn("chain", F.monotonically_increasing_id()), "chains")
    release(spark)

    def asked(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            out = []
            for c, rid, first, raw in zip(pdf["chain"], pdf["rid"], pdf["first"], pdf["fragments"], strict=True):
                mine, theirs = wanted_pages(np.frombuffer(raw, "<i4").reshape(-1, 3))
                out += [(c, 0, rid, p) for p in mine] + [(c, 1, first, p) for p in theirs]
            yield pd.DataFrame(out, columns=["chain", "side", "rid", "page"])

    def aligned(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []

        def of(pdf: pd.DataFrame) -> pd.DataFrame:
            out = []
            ids, side, page, words, rids, firsts = (pdf[c].tolist() for c in ("chain", "side", "page", "words", "rid", "first"))
            edge = [0, *(np.flatnonzero(np.diff(pdf["chain"].to_numpy())) + 1).tolist(), len(ids)]
            for a, b in zip(edge, edge[1:]):
                got: tuple[dict, dict] = ({}, {})
                for i in range(a, b):
                    if page[i] < 0:  # the chain itself
                        fragments, rid, first = np.frombuffer(words[i], "<i4").reshape(-1, 3), rids[i], firsts[i]
                    else:
                        got[side[i]][page[i]] = words[i].split()
                out += [(rid, x0, x1, first, y0, y1, similarity)
                        for x0, x1, y0, y1, similarity in align(fragments, Pages(got[0]), Pages(got[1]))]
            return pd.DataFrame(out, columns=["rid", "start_word", "end_word", "first", "first_start", "first_end", "similarity"])

        for pdf in frames:  # sorted by chain: the last one may go on in the next batch
            if not len(pdf):
                continue
            held.append(pdf)
            last = pdf["chain"].iloc[-1]
            if held[0]["chain"].iloc[0] == last:
                continue
            pdf = pd.concat(held)
            held = [pdf[pdf["chain"] == last]]
            yield of(pdf[pdf["chain"] != last])
        if held:
            yield of(pd.concat(held))

    read = made.mapInPandas(asked, "chain long, side int, rid long, page int").join(pages(docs), ["rid", "page"])
    none = F.lit(0).cast("long")
    read = read.select("chain", "side", "page", "words", none.alias("rid"), none.alias("first"))
    own = made.select("chain", F.lit(0).alias("side"), F.lit(-1).alias("page"), F.col("fragments").alias("words"), "rid", "first")
    both = read.unionByName(own).repartition(parts, "chain").sortWithinPartitions("chain")
    out = both.mapInPandas(aligned, "rid long, start_word int, end_word int, first long, first_start int, first_end int, similarity double")
    return materialise(out, "passages")


def in_order(docs: DataFrame) -> tuple[DataFrame, int]:
    """``docs`` with ``rid``, a unique number in the order of doc_id, and the number of partitions that suits them."""
    parts = parts_for(docs, F.octet_length("text"), 16 << 20)
    keyed = docs.withColumn("h_", F.xxhash64("text"))
    keyed = keyed.repartitionByRange(parts, "doc_id", "h_").sortWithinPartitions("doc_id", "h_").drop("h_")
    return materialise(keyed.withColumn("rid", F.monotonically_increasing_id()), "ordered_docs"), parts


def without_passages(docs: DataFrame) -> DataFrame:
    """``docs`` without the passages that an earlier document has; ``n_chars`` follows where there is one."""
    plain = [c for c in docs.columns]
    packed, parts = in_order(docs.select("doc_id", "text", F.struct(*[docs[f"`{c}`"] for c in plain]).alias("doc")))
    release(docs.sparkSession)
    found = passages(packed, parts).groupBy("rid").agg(F.collect_list(F.struct("start_word", "end_word")).alias("spans"))

    def cut(text: str, spans: np.ndarray) -> str:
        raw = text.encode()
        batch = Batch([text])
        gone = np.zeros(len(batch.word_start) + 1, np.int32)
        np.add.at(gone, np.minimum(spans[:, 0], len(batch.word_start)), 1)
        np.add.at(gone, np.minimum(spans[:, 1], len(batch.word_start)), -1)
        gone = np.cumsum(gone)[:-1] > 0
        edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
        starts = [int(batch.word_start[a]) for a in edge[::2]]  # a passage goes with the blanks behind it
        ends = [int(batch.word_start[b]) if b < len(gone) else len(raw) for b in edge[1::2]]
        return b"".join(raw[i:j] for i, j in zip([0, *ends], [*starts, len(raw)], strict=True)).decode()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t if s is None or t is None else cut(t, np.array([(x["start_word"], x["end_word"]) for x in s]))
                     for t, s in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(texts, pa.string())], names=["doc", "text"])

    kept = (packed.select("rid", "text", "doc").join(found, "rid", "left").drop("rid")
            .mapInArrow(rows, f"doc {packed.schema['doc'].dataType.simpleString()}, text string"))
    size = F.when(F.col("text").eqNullSafe(F.col("doc.text")), F.col("doc.n_chars")).otherwise(F.length("text")) if "n_chars" in plain else None
    return kept.select(*[F.col("text") if c == "text" else size.cast(docs.schema["n_chars"].dataType).alias("n_chars")
                         if c == "n_chars" else F.col(f"doc.`{c}`") for c in plain])


def op6_fuzzy_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, parts = in_order(table(spark, sf_dir, "documents").select("doc_id", "text"))
    release(spark)
    found = passages(docs, parts)
    ids = docs.select("rid", "doc_id")
    firsts = ids.select(F.col("rid").alias("first"), F.col("doc_id").alias("first_doc_id"))
    return (found.join(ids, "rid").join(firsts, "first")
            .select("doc_id", "start_word", "end_word", "first_doc_id", "first_start", "first_end", "similarity"))
