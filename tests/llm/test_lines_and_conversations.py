"""Line dedup, conversation repair and prefix trie against brute-force versions."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from feedlens.llm import hot_keys, line_dedup, prefix_trie, queries, repair

from .conftest import EDGE_ROWS, SF001

SPACES = " \t\n\x0b\f\r"
LOWER = {ord(c): ord(c.lower()) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
CONV_SCHEMA = "conv_id long, turn long, role string, text string"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


# ------------------------------------------------------------------ line dedup

def brute_lines(docs, min_chars=40, min_documents=5):
    held = collections.defaultdict(set)
    for doc, text in docs:
        for line in (text or "").split("\n"):
            key = line.strip(SPACES).translate(LOWER)
            if len(key) >= min_chars:
                held[key].add(doc)
    keep = {k: max(ids - {None}, default=None) for k, ids in held.items() if len(ids) >= min_documents}
    out = []
    for doc, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if keep.get(x.strip(SPACES).translate(LOWER), doc) == doc]
        out.append((doc, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def line_documents():
    shared = "This Passage of fourty code points é is Long enough"
    short = "é" * 39
    docs = [(i, f"own line {i}\n  {shared.upper().replace('É', 'é')}\t\nend {i}") for i in range(6)]
    docs += [(10 + i, f"{short}\nx" if i % 2 else short + "\n") for i in range(8)]  # one code point too few
    docs += [(20 + i, "é" * 40 + "\n" + "é" * 40) for i in range(5)]  # twice in each; all lines of the last stay
    docs += [(30 + i, "four documents hold this line and that is one too few") for i in range(4)]
    docs += [(40, "repeated rows are one document, however often they come")] * 7
    docs += [(None, "rows without an id are one document, however many there are")] * 7
    docs += [(None, "a line of rows without id and of four documents goes there")]
    docs += [(50 + i, "a line of rows without id and of four documents goes there\r") for i in range(4)]
    docs += [(60, None), (61, ""), (62, "\n\n"), (63, "\n" + "long " * 50000 + "\n")]
    docs += [(70 + i, "\n".join(f"line {j} that many long documents share with each other" for j in range(300))) for i in range(6)]
    return docs + [(d, t) for d, t, _, _ in EDGE_ROWS]


@pytest.mark.parametrize("limit", [line_dedup.BROADCAST_LINES, 0])
def test_line_dedup_equals_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(line_dedup, "BROADCAST_LINES", limit)
    docs = line_documents()
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    df = df.withColumns({c: F.lit(1) for c in ("key", "line", "body", "first", "rows", "keep_id", "n_lines")})
    out = line_dedup.drop_repeated_lines(df)
    assert out.columns == ["doc_id", "text", "n_lines", "n_dropped"]
    assert rows_of(out) == brute_lines(docs)


def test_line_dedup_of_an_empty_table(spark, empty):
    assert line_dedup.drop_repeated_lines(empty).count() == 0


def test_line_dedup_joins_cold_keys_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(hot_keys, "HOT_KEYS", 3)
    docs = line_documents()
    out = line_dedup.drop_repeated_lines(spark.createDataFrame(docs, "doc_id long, text string"))
    assert rows_of(out) == brute_lines(docs)


# ------------------------------------------------------------------ running totals

@pytest.mark.parametrize("parts", [1, 7, 40])
def test_running_totals_equal_a_window(spark, parts):
    key = F.when(F.col("id") % 3 == 0, 5).when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 50)
    rows = spark.range(2000).select("id", key.cast("long").alias("key"), F.xxhash64("id").alias("x"), (F.col("id") % 11).alias("n"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = hot_keys.running(rows, "key", [F.col("id")], ("x",), ("n",))
        over = Window.partitionBy("key").orderBy("id")
        want = rows.select("*", F.row_number().over(over).cast("long").alias("position"),
                           F.bit_xor("x").over(over).alias("run_x"), F.sum("n").over(over).alias("run_n"))
        assert got.columns == want.columns
        assert rows_of(got) == rows_of(want)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert hot_keys.running(rows.where("id < 0"), "key", [F.col("id")]).count() == 0


# ------------------------------------------------------------------ conversations

def conversations():
    """Null ids, turns, roles and texts, repeated rows, ties, long conversations."""
    rng = random.Random(5)
    rows = []
    for conv in [*range(0, 60), -1, -3, -5, -7, 10**12, None]:
        for turn in range(rng.choice([1, 2, 3, 4, 5, 6, 12, 40])):
            role = rng.choice(["user", "assistant"] * 4 + ["system", "tool", "User", None, ""])
            text = rng.choice(["Yes.", "No!", "well", "", None, " \t", "Why?", "cut off,", f"Turn {turn}.", "né. "])
            rows.append((conv, rng.choice([turn, turn, turn, turn + 2, None]), role, text))
    rows += [(7, 3, "user", "Same row.")] * 4
    rows += [(200 + i, t, ("user", "assistant")[t % 2], f"Common turn {t}.") for i in range(12) for t in range(3 + i % 3)]
    rows += [(300, 0, "user", "ü" * 100_000 + ".")]
    return rows


def ordered(rows, h):
    """Rows of one conversation as the operators order them."""
    return sorted(rows, key=lambda r: (r[0] is not None, r[0], *h[r[1:3]], r[3]))


def hashes(spark, pairs):
    df = spark.createDataFrame(sorted(set(pairs)), "role string, text string")
    found = df.select("role", "text", F.xxhash64(F.lit(1), "role", "text"), F.xxhash64(F.lit(2), "role", "text")).collect()
    return {(r[0], r[1]): (r[2], r[3]) for r in found}


def damaged(rows):
    out = {}
    for conv, turn, role, text in rows:
        mine = out.setdefault(conv, [])
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        if kind:
            mine += [(turn, role, text, copy) for copy in range(2 if kind == 3 else 1)]
    return out


def brute_repair(rows):
    """Forward dynamic programme over (cost, letters, lines); ``rows`` in order."""
    seen, fault = set(), []
    for _, role, text, _ in rows:
        body = text.rstrip(SPACES)
        fault.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    pairs = zip(rows, rows[1:])
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in pairs)
    follows, names = {"": "u", "s": "u", "u": "a", "a": "u"}, {"u": "user:", "a": "assistant:"}

    def better(ways, q, way):
        if q not in ways or way < ways[q]:
            ways[q] = way

    def inserts(ways):
        for _ in range(4):
            for q, (cost, letters, lines) in list(ways.items()):
                better(ways, follows[q], (cost + 3, letters + "I", (*lines, names[follows[q]])))
        return ways

    ways = inserts({"": (0, "", ())})
    for (_, role, text, _), wrong in zip(rows, fault):
        new = {}
        for q, (cost, letters, lines) in ways.items():
            better(new, q, (cost + 4, letters + "D", lines))
            if wrong not in ("blank", "duplicate"):
                extra = 3 * (wrong == "truncated")
                if (first := role[:1]) and (first == follows[q] or first == "s" and q == ""):
                    better(new, first, (cost + extra, letters + "K", (*lines, f"{role}:{text}")))
                better(new, follows[q], (cost + 3 + extra, letters + "R", (*lines, names[follows[q]] + text)))
        ways = inserts(new)
    cost, letters, lines = min(ways[q] for q in ("", "a") if q in ways)
    return (gaps, *(fault.count(x) for x in ("blank", "duplicate", "truncated")), illegal, cost, letters,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(), len(lines))


@pytest.mark.parametrize("chunk_rows", [repair.CHUNK, 3, 1])
def test_repair_equals_brute_force(spark, chunk_rows):
    rows = conversations()
    df = spark.createDataFrame(rows, CONV_SCHEMA).repartition(4).withColumns(
        {c: F.lit("x") for c in ("copy", "position", "chunk", "kind", "audit", "blank")})
    left = damaged(rows)
    h = hashes(spark, [r[1:3] for mine in left.values() for r in mine])
    want = [(conv, *brute_repair(ordered(mine, h))) for conv, mine in left.items()]
    assert rows_of(repair.repair_conversations(df, chunk_rows)) == sorted(want, key=repr)


def test_repair_of_an_empty_table(spark):
    empty = spark.createDataFrame([], CONV_SCHEMA)
    assert repair.repair_conversations(empty).count() == 0
    assert prefix_trie.conversation_trie(empty).count() == 0


def test_repair_of_a_conversation_without_rows_left(spark):
    gone = next(t for t in range(10**6) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    row, = repair.repair_conversations(spark.createDataFrame([(1, gone, "user", "Hi.")], CONV_SCHEMA)).collect()
    assert tuple(row) == (1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest(), 0)


def test_block_tables_trace_like_the_brute_force():
    """All sequences of up to five symbols of five kinds, and long random ones."""
    texts = {0: ("system", "a."), 1: ("user", "b."), 2: ("assistant", "c."), 5: ("user", "cut"), 8: ("user", " ")}
    rng = np.random.Generator(np.random.PCG64(1))
    some = [s for n in range(6) for s in itertools.product(texts, repeat=n)]
    some += [tuple(rng.choice(list(texts), size=n).tolist()) for n in (17, 64, 201)]
    for symbols in some:
        rows = [(i, texts[s][0], texts[s][1] if s == 8 else f"{i}{texts[s][1]}", 0) for i, s in enumerate(symbols)]
        want = brute_repair(rows)
        letters, _, cost = repair.trace(np.array(symbols, np.int64), 0, repair.START, True)
        assert (cost, letters) == want[5:7]


def brute_trie(rows, h, of=5, head=9):
    turns = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn, role or "", text or "", 0))
    own = {c: [r[1:3] for r in ordered(mine, h)] for c, mine in turns.items()}
    members, children = collections.defaultdict(list), collections.defaultdict(set)
    for c, mine in own.items():
        n = zlib.crc32(str(c).encode()) % head
        base = c - (abs(c) % of if c >= 0 else -(abs(c) % of))  # the remainder has the sign of c
        seq = tuple(own.get(base, [])[:n] + mine[n:])
        for d in range(len(seq) + 1):
            members[seq[:d]].append((c, len(seq)))
            if d:
                children[seq[:d - 1]].add(seq[:d])
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        below = children.get(p, ())
        leaves[p] = sum(leaves[k] for k in below) if below else 1
        saved[p] = sum(saved[k] for k in below) + ((len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0)
    out = []
    for p, found in members.items():
        ids = ",".join(str(c) for c, n in sorted(found) if n == len(p))
        out.append((min(found)[0], len(p), min(members[p[:-1]])[0] if p else None, len(found), len(children.get(p, ())),
                    leaves[p], saved[p], hashlib.sha256(ids.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("cells, hot", [(None, hot_keys.HOT_KEYS), (8, 2)])
def test_trie_equals_brute_force(spark, monkeypatch, cells, hot):
    """With a sketch of eight counters hardly any prefix is proven to be single."""
    if cells:
        monkeypatch.setattr(prefix_trie, "SEGMENT_CELLS", cells)
        monkeypatch.setattr(prefix_trie, "MAX_CELLS", cells)
    monkeypatch.setattr(hot_keys, "HOT_KEYS", hot)
    monkeypatch.setattr(prefix_trie, "ID_BLOCK_BYTES", 16)
    rows = conversations()
    df = spark.createDataFrame(rows, CONV_SCHEMA).repartition(4).withColumns(
        {c: F.lit("x") for c in ("x1", "position", "depth", "bytes", "first", "rows")})
    h = hashes(spark, [(r[2] or "", r[3] or "") for r in rows])
    out = prefix_trie.conversation_trie(df)
    assert rows_of(out.drop("x1", "x2", "screened")) == brute_trie(rows, h)
    if not cells:
        assert out.where("screened").count() > 50


def test_trie_query_reads_the_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    h = hashes(spark, [(r[2] or "", r[3] or "") for r in rows])
    assert rows_of(queries.op13_prefix_trie(spark, SF001)) == brute_trie(rows, h)
