"""Documents with nulls, empty and long texts, ties, repeated rows and clashing extra columns."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, start long, size long, count long, n long, h long, doc string, rid long, copies int, q_ string, _stays long, fp_ long, id string"


def words(rng, n, letters="abcdefghij", most=7):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, most))) for _ in range(n))


def edge_rows(seed=1):
    rng = random.Random(seed)
    passage = words(rng, 60)
    texts = [None, "", " ", "\n\n", "a", "Ünï çödé ß Σς ﬁ é", "<|endoftext|> x<|endoftext|>", "﻿x　y z\tq\r\n",
             "x" * 3000, "a a a a a a a a a a a a", words(rng, 9000), passage, words(rng, 40) + "\n" + passage,
             passage + " " + words(rng, 30), words(rng, 300), words(rng, 4), "don't WE'LL 12345 ### ;;"]
    texts += [texts[14], texts[14].replace("a", "b", 3), texts[10]]
    rows = [(i * 3, t, "en", ["s0", "s1", None, "é", ""][i % 5], len(t or ""), 7, 8, 9, 1, 2, "d", 3, 4) for i, t in enumerate(texts)]
    rows += [((1 << 53) + 1 + 2 * i, t, "en", "s1", len(t), 7, 8, 9, 1, 2, "d", 3, 4) for i, t in enumerate(("beyond doubles", "Beyond doubles again."))]
    rows += [rows[10], rows[10], (None, "null id " + passage, *[None] * 11), (None,) * 13]
    return [(*r, *(("q", 5, 6, "i") if r[1] else (None,) * 4)) for r in rows]


def edge_docs(spark, seed=1):
    return spark.createDataFrame(edge_rows(seed), SCHEMA).repartition(3)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def as_sf(spark, docs, folder):
    """The documents as the table of a data folder."""
    docs.write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    return str(folder)
