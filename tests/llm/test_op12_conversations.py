import hashlib
import random
import re
import zlib

import duckdb

from coderail.llm.op12_conversations import OP12_SQL, cheapest, kind, op12_conversation_repair

SCHEMA = "conv_id long, turn long, role string, text string, part int, left string, head long, audit string, cost int"


def brute(rows):
    """Least (cost, audit) of (initial, must go, truncated) rows, over all edit sequences with up to two rows put in at a place."""
    best = (10**9, "")
    paths = [(0, "", "", 0, 0)]
    while paths:
        cost, audit, roles, i, put_in = paths.pop()
        if cost > best[0]:
            continue
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            best = min(best, (cost, audit))
        if put_in < 2:
            paths += [(cost + 3, audit + "I", roles + r, i, put_in + 1) for r in "ua"]
        if i < len(rows):
            initial, must_go, truncated = rows[i]
            paths.append((cost + 4, audit + "D", roles, i + 1, 0))
            if not must_go:
                more = 3 * truncated
                paths.append((cost + more, audit + "K", roles + (initial or "?"), i + 1, 0))
                paths += [(cost + 3 + more, audit + "R", roles + r, i + 1, 0) for r in "ua"]
    return best


def test_cheapest_edits_equal_all_sequences():
    rng = random.Random(5)
    for _ in range(120):
        rows = [(rng.choice("suaua? "), rng.random() < 0.2, rng.random() < 0.25) for _ in range(rng.randint(0, 4))]
        rows = [(a, m, t and not m) for a, m, t in rows]
        kinds = bytes(kind(*r) for r in rows)
        assert cheapest(kinds) == cheapest(kinds, 1) == cheapest(kinds, 3) == brute(rows)


def test_segments_do_not_change_long_conversations():
    rng = random.Random(6)
    kinds = bytes(kind(rng.choice("sua?"), rng.random() < 0.1, False) for _ in range(700))
    assert cheapest(kinds, 64) == cheapest(kinds, 1000)


def model(rows, conv):
    """The contract on the rows of one conversation, in plain Python."""
    out = []
    for c, turn, role, text, *_ in rows:
        role, text = " " if role is None else role, " " if text is None else text
        what = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if what == 1 else re.sub("[.!?]", "", text) if what == 2 else text
        out += [(turn, "user" if what == 4 else role, text)] * (0 if what == 0 else 2 if what == 3 else 1)
    out.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    faults, seen = [], set()
    for _, role, text in out:
        body = text.strip("\x20\x09\x0a\x0b\x0c\x0d")
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = [t for t, _, _ in out if t is not None]
    cost, audit = brute([(r[:1], f in ("blank", "duplicate"), f == "truncated") for (_, r, _), f in zip(out, faults)])
    lines, last, left = [], "", iter(out)
    for letter in audit:
        fits = "a" if last == "u" else "u"
        _, role, text = ("", "", "") if letter == "I" else next(left)
        if letter in "IR":
            role = "user" if fits == "u" else "assistant"
        if letter != "D":
            last = role[:1]
            lines.append(f"{role}:{text}")
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(out, out[1:])]
    return (conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(x) for x in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def edge_rows():
    rng = random.Random(9)
    texts = ["Good.", "Good.", "cut", "", " \t\n", None, "..!", "x" * 3000 + "?", "é ü!", "Yes?  \n", "　"]
    rows = []
    for conv in [*range(60), None]:
        for _ in range(rng.randint(1, 4)):
            turn = rng.choice([None, 0, 1, 2, 3, 5, 9])
            rows.append((conv, turn, rng.choice(["user", "assistant", "system", "user", "assistant", None, "", "tool", "Übung"]), rng.choice(texts), 1, "l", 2, "a", 3))
    return rows + [rows[0], rows[0]]


def check(spark, rows, folder):
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.mode("overwrite").parquet(f"{folder}/conversations.parquet")
    got = sorted((tuple(r) for r in op12_conversation_repair(spark, str(folder)).collect()), key=str)
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    assert got == sorted((model(r, c) for c, r in by.items()), key=str)
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet/*.parquet'")
        assert sorted(db.execute(OP12_SQL).fetchall(), key=str) == got


def test_query_equals_model_and_sql(spark, tmp_path):
    check(spark, edge_rows(), tmp_path)


def test_conversation_that_loses_every_row(spark, tmp_path):
    lost = next(c for c in range(1000) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    check(spark, [(lost, 1, "user", "Hello.", 1, "l", 2, "a", 3)], tmp_path)


def test_empty_table(spark, tmp_path):
    check(spark, [], tmp_path)


def test_one_long_conversation(spark, tmp_path):
    rows = [(7, t, ["user", "assistant"][t % 2], f"Line {t}.", 1, "l", 2, "a", 3) for t in range(3000)]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.mode("overwrite").parquet(f"{tmp_path}/conversations.parquet")
    (row,) = op12_conversation_repair(spark, str(tmp_path)).collect()
    hit = [zlib.crc32(f"7:{t}".encode()) % 20 for t in range(3000)]
    assert row["gaps"] == sum(h == 0 for h in hit[1:-1]) and row["duplicate"] == hit.count(3) and row["blank"] == hit.count(1)
    assert len(row["audit"].replace("I", "")) == 3000 - hit.count(0) + hit.count(3)
