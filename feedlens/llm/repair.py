"""Conversation structure repair with Four-Russians block tables.

A conversation's rows are symbols (role class and fault).  The cheapest edits
that give the role pattern ``(s?(ua)+)?`` follow from the cost to go of four
pattern states before each row.  Cost vectors differ by a bounded amount, so
normalised (least cost 0) there are only some dozens; the vector before every
block of ``BLOCK`` symbols is looked up in a table of all blocks.  Blocks are
processed from the end; then each block is expanded backward from the vector
behind it and traced forward, taking the ASCII-least letter among the cheapest.

Spark numbers the rows, marks duplicates and cuts each conversation into chunks of
``CHUNK`` rows.  A chunk is a function from the vector behind it to the vector
before it (and, for each, from state to state), so the chunks of a very long
conversation are worked on by many tasks and only these small functions are
composed.  Texts move once, to be hashed row by row.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.llm.hot_keys import join_by_key, running
from feedlens.llm.tables import materialize, prepare_tasks

#: Costs of the edits, and what a truncated row adds that stays.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Symbols of a block, and rows of a chunk.
BLOCK = 4
CHUNK = 1 << 16

_SPACES = " \t\n\x0b\f\r"
# Pattern states: nothing yet, after s, after u, after a; what each accepts next.
START, SYSTEM, USER, ASSISTANT = range(4)
_NEXT_TURN = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_ACCEPTS = (START, ASSISTANT)
# Role classes s, u, a, other; a symbol is class + 4 * truncated, or MUST_GO, or PAD.
MUST_GO, PAD = 8, 9
SYMBOLS = 10
_ROLE_OF_STATE = {USER: "user", ASSISTANT: "assistant"}


def _step(state: int, symbol: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of the edits that take up a row, in ASCII order."""
    edits = [("D", DELETE, state)]
    if symbol != MUST_GO:
        role, extra = symbol % 4, TRUNCATED * (symbol // 4)
        if role == 0 and state == START:
            edits.append(("K", extra, SYSTEM))
        elif role in (1, 2) and _NEXT_TURN[state] == role + 1:
            edits.append(("K", extra, role + 1))
        edits.append(("R", REROLE + extra, _NEXT_TURN[state]))
    return edits


def _with_inserts(costs: list[int]) -> list[int]:
    """Costs to go when rows may be inserted first; three lead through all states."""
    costs = list(costs)
    for _ in range(3):
        costs = [min(c, INSERT + costs[_NEXT_TURN[q]]) for q, c in enumerate(costs)]
    return costs


def _before(symbol: int, costs: list[int]) -> list[int]:
    """Costs to go before a row from those behind it."""
    if symbol == PAD:
        return list(costs)
    return _with_inserts([min(c + costs[to] for _, c, to in _step(q, symbol)) for q in range(4)])


@lru_cache(maxsize=1)
def tables() -> tuple[list[tuple[int, ...]], np.ndarray, np.ndarray]:
    """(normalised vectors, vector before a symbol, vector before a block): the
    first vector is the one behind a conversation's last row."""
    end = tuple(_with_inserts([0 if q in _ACCEPTS else 10**6 for q in range(4)]))
    vectors, number, steps = [end], {end: 0}, []
    for costs in vectors:  # grows while it is read
        row = []
        for symbol in range(SYMBOLS):
            found = _before(symbol, list(costs))
            found = tuple(c - min(found) for c in found)
            if found not in number:
                number[found] = len(vectors)
                vectors.append(found)
            row.append(number[found])
        steps.append(row)
    step = np.array(steps, np.int16)
    block = np.arange(len(vectors), dtype=np.int16)[:, None]
    for _ in range(BLOCK):  # one more symbol in front each time
        block = np.stack([step[block, s] for s in range(SYMBOLS)], axis=1).reshape(len(vectors), -1)
    return vectors, step, block


def block_codes(symbols: np.ndarray) -> np.ndarray:
    """Symbols, filled up with PAD, as numbers of blocks (first symbol highest)."""
    filled = np.full(-(-len(symbols) // BLOCK) * BLOCK, PAD, np.int64)
    filled[:len(symbols)] = symbols
    return filled.reshape(-1, BLOCK) @ (SYMBOLS ** np.arange(BLOCK - 1, -1, -1))


@lru_cache(maxsize=200_000)
def _trace_block(state: int, code: int, behind: int) -> tuple[str, int, int]:
    """(letters, state behind, cost) of a block that starts in ``state``, when
    vector ``behind`` holds behind it: expanded backward, traced forward."""
    vectors, step, _ = tables()
    symbols = [code // SYMBOLS ** j % SYMBOLS for j in range(BLOCK - 1, -1, -1)]
    to_go = [behind]
    for symbol in reversed(symbols):
        to_go.append(int(step[to_go[-1], symbol]))
    to_go.reverse()
    letters, cost = [], 0
    for j, symbol in enumerate(symbols):
        if symbol == PAD:
            continue
        after = vectors[to_go[j + 1]]
        here = _before(symbol, list(after))
        while True:
            options = [(c + after[to], letter, c, to) for letter, c, to in _step(state, symbol)]
            options.append((INSERT + here[_NEXT_TURN[state]], "I", INSERT, _NEXT_TURN[state]))
            _, letter, c, state = min(options)
            letters.append(letter)
            cost += c
            if letter != "I":
                break
    return "".join(letters), state, cost


def vectors_behind(codes: np.ndarray, end: int) -> list[int]:
    """The vector behind each block, and before the first one, by look-up from the end."""
    block = tables()[2]
    found = [end]
    for code in codes[::-1].tolist():
        found.append(int(block[found[-1], code]))
    return found[::-1]


def trace(symbols: np.ndarray, end: int, state: int, last: bool) -> tuple[str, int, int]:
    """(letters, state behind, cost) of a chunk; ``last``: the conversation
    ends behind it, so the rows that its pattern lacks are inserted."""
    codes = block_codes(symbols)
    behind = vectors_behind(codes, end)[1:]
    letters, cost = [], 0
    for code, vector in zip(codes.tolist(), behind):
        found, state, c = _trace_block(state, code, vector)
        letters.append(found)
        cost += c
    while last and state not in _ACCEPTS:
        letters.append("I")
        state, cost = _NEXT_TURN[state], cost + INSERT
    return "".join(letters), state, cost


def chunk_function(symbols: np.ndarray) -> tuple[list[int], list[int]]:
    """For each vector behind the chunk the one before it, and for each (vector
    behind, state before) the state behind."""
    vectors, _, block = tables()
    codes = block_codes(symbols)
    ids = np.arange(len(vectors), dtype=np.int16)
    before = ids
    for code in codes[::-1].tolist():
        before = block[before, code]
    states = []
    for end in range(len(vectors)):
        behind = vectors_behind(codes, end)[1:]
        for state in range(4):
            for code, vector in zip(codes.tolist(), behind):
                state = _trace_block(state, code, vector)[1]
            states.append(state)
    return before.tolist(), states


# ------------------------------------------------------------------ Spark side

def damage(conversations: DataFrame) -> DataFrame:
    """The damaged rows ``conv_id, turn, copy, role, text``: by the unsigned
    crc32 of ``conv_id:turn`` (nulls: one space) modulo 20, 0 drops a row, 1
    empties its text, 2 takes its ``.!?`` away, 3 repeats it, 4 makes it a
    user's.  Null role or text is one space."""
    def shown(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    role, body = shown("role"), shown("text")
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), kind.alias("kind"),
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(body, ".!?", "")).otherwise(body).alias("text"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.where("kind <> 0").select("conv_id", "turn", F.explode(copies).alias("copy"), "role", "text")


def order_columns() -> list[Column]:
    return [F.col("turn").asc_nulls_first(), F.col("h1"), F.col("h2"), F.col("copy")]


def _hashes() -> list[Column]:
    return [F.xxhash64(F.lit(1), "role", "text").alias("h1"), F.xxhash64(F.lit(2), "role", "text").alias("h2")]


def faults(damaged: DataFrame) -> DataFrame:
    """Narrow, numbered rows with ``role`` (class), ``blank``, ``duplicate``
    and ``truncated``; each row has its first fault only."""
    stripped = F.rtrim("text", F.lit(_SPACES))
    initial = F.substring("role", 1, 1)
    role = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    narrow = damaged.select("conv_id", "turn", "copy", *_hashes(), role.alias("role"),
                            (F.length(stripped) == 0).alias("blank"),
                            (~F.right(stripped, F.lit(1)).isin(".", "!", "?")).alias("truncated"))
    narrow = materialize(narrow, "repair-rows")
    numbered = materialize(running(narrow, "conv_id", order_columns(), name="repair-numbered"), "repair-positions")
    again = (numbered.where("not blank").groupBy("conv_id", "h1", "h2")
             .agg(F.min("position").alias("earliest"), F.count("*").alias("rows")).where("rows > 1"))
    again = materialize(again, "repair-repeated")
    rows = join_by_key(numbered, again, ["conv_id", "h1", "h2"], "rows", numbered.count(), "left")
    later = F.coalesce(F.col("position") > F.col("earliest"), F.lit(False))
    return rows.select("conv_id", "turn", "copy", "h1", "h2", "position", "role", "blank", later.alias("duplicate"),
                       (F.col("truncated") & ~F.col("blank") & ~later).alias("truncated"))


def _illegal(roles: np.ndarray) -> int:
    """Adjacent role classes other than su, ua and au."""
    first, second = roles[:-1], roles[1:]
    fine = ((first == 0) & (second == 1)) | ((first == 1) & (second == 2)) | ((first == 2) & (second == 1))
    return int((~fine).sum())


def _split(chunk: bytes, follows: bool) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, roles) of a chunk's codes (role + 4 * truncated + 8 * must go);
    the code of the next chunk's first row counts as a role only."""
    codes = np.frombuffer(chunk, np.uint8) - ord("0")
    symbols = np.where(codes >= 8, MUST_GO, codes)
    return symbols[:-1] if follows else symbols, codes % 4


def _functions(batches):
    for batch in batches:
        for conv, chunk, follows, codes in zip(*(c.to_pylist() for c in batch.columns)):
            before, states = chunk_function(_split(codes.encode(), follows)[0])
            yield pa.RecordBatch.from_arrays(
                [pa.array([conv], pa.int64()), pa.array([chunk], pa.int64()), pa.array([before], pa.list_(pa.int32())),
                 pa.array([states], pa.list_(pa.int32()))], names=["conv_id", "chunk", "before", "states"])


def _composed(table: pa.Table) -> pa.Table:
    """All chunk functions of a conversation -> each chunk's vector behind and state before."""
    rows = sorted(zip(*(table[c].to_pylist() for c in ("conv_id", "chunk", "before", "states"))), key=lambda r: r[1])
    behind, vector = [], 0
    for _, _, before, _ in reversed(rows):
        behind.append(vector)
        vector = before[vector]
    behind.reverse()
    starts, state = [], START
    for (_, _, _, states), vector in zip(rows, behind):
        starts.append(state)
        state = states[4 * vector + state]
    return pa.table({"conv_id": pa.array([r[0] for r in rows], pa.int64()), "chunk": pa.array([r[1] for r in rows], pa.int64()),
                     "vector": pa.array(behind, pa.int32()), "state": pa.array(starts, pa.int32())})


def _traced(batches):
    for batch in batches:
        out = []
        for conv, chunk, follows, codes, vector, state in zip(*(c.to_pylist() for c in batch.columns)):
            symbols, roles = _split(codes.encode(), follows)
            letters, _, cost = trace(symbols, vector, state, not follows)
            out.append((conv, chunk, letters, cost, _illegal(roles)))
        columns = zip(*out) if out else [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()))],
            names=["conv_id", "chunk", "letters", "cost", "illegal"])


def traced_chunks(rows: DataFrame, chunk_rows: int = CHUNK) -> DataFrame:
    """``faults`` rows -> ``conv_id, chunk, letters, cost, illegal``."""
    at = F.floor((F.col("position") - 1) / chunk_rows)
    # A chunk's first row is also the last one that the chunk before sees.
    both = F.when((F.col("position") > 1) & ((F.col("position") - 1) % chunk_rows == 0), F.array(at, at - 1)).otherwise(F.array(at))
    code = F.col("role") + F.when(F.col("blank") | F.col("duplicate"), 8).when(F.col("truncated"), 4).otherwise(0)
    listed = F.array_sort(F.collect_list(F.struct("position", "letter")))
    chunks = (rows.select("conv_id", "position", F.char(code + ord("0")).alias("letter"), F.explode(both).alias("chunk"))
              .groupBy("conv_id", "chunk").agg(listed.alias("found"), (F.max("position") > F.col("chunk") * chunk_rows + chunk_rows).alias("follows"))
              .select("conv_id", "chunk", "follows", F.array_join(F.transform("found", lambda x: x["letter"]), "").alias("codes")))
    chunks = materialize(chunks, "repair-chunks")
    short = chunks.where("chunk = 0 and not follows").withColumns({"vector": F.lit(0), "state": F.lit(START)})
    long = chunks.where("chunk > 0 or follows")
    given = (long.mapInArrow(_functions, "conv_id long, chunk long, before array<int>, states array<int>")
             .groupBy("conv_id").applyInArrow(_composed, "conv_id long, chunk long, vector int, state int"))
    same = long["conv_id"].eqNullSafe(given["conv_id"]) & (long["chunk"] == given["chunk"])
    placed = short.unionByName(long.join(given, same).select(long["*"], "vector", "state"))
    traced = placed.mapInArrow(_traced, "conv_id long, chunk long, letters string, cost long, illegal long")
    return materialize(traced, "repair-traced")


def _repaired(batches):
    """Sorted edits and rows of each conversation -> the SHA-256 of its repaired
    lines and their number, holding one row's text at a time."""
    conv, state, lines, pending, at = None, None, 0, [], START

    def done():
        return pa.RecordBatch.from_arrays(
            [pa.array([conv[0]], pa.int64()), pa.array([state.hexdigest()]), pa.array([lines], pa.int64())],
            names=["conv_id", "repaired_sha256", "n_repaired"])

    def line(role: str, body: str) -> None:
        nonlocal lines
        if lines:
            state.update(b"\n")
        state.update(f"{role}:{body}".encode())
        lines += 1

    for batch in batches:
        for number, edit, role, body in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist()
                                              for c in ("conv_id", "edit", "role", "text"))):
            if conv != (number,):
                if conv is not None:
                    yield done()
                conv, state, lines, pending, at = (number,), hashlib.sha256(), 0, [], START
            if edit is not None:
                pending.append(edit)
                continue
            for letter in pending.pop(0):
                if letter == "D":
                    continue
                if letter == "K":
                    at = SYSTEM if at == START and role[:1] == "s" else _NEXT_TURN[at]
                    line(role, body)
                    continue
                at = _NEXT_TURN[at]
                line(_ROLE_OF_STATE[at], body if letter == "R" else "")
    if conv is not None:
        yield done()


def repaired_digests(damaged: DataFrame, rows: DataFrame, traced: DataFrame, chunk_rows: int = CHUNK) -> DataFrame:
    """``conv_id, repaired_sha256, n_repaired``.  Each row's edits come just before
    it in one sorted stream; the texts are shuffled once."""
    edits = F.regexp_extract_all("letters", F.lit("I*[DKR](?:I+$)?"), F.lit(0))
    edits = traced.select("conv_id", "chunk", F.posexplode(edits).alias("place", "edit")).select(
        F.col("conv_id").alias("__conv"), (F.col("chunk") * chunk_rows + F.col("place") + 1).alias("__position"), "edit")
    marks = rows.join(edits, rows["conv_id"].eqNullSafe(edits["__conv"]) & (rows["position"] == edits["__position"]))
    keys = ["conv_id", "turn", "h1", "h2", "copy"]
    none = F.lit(None).cast("string")
    marks = marks.select(*keys, "position", "edit", none.alias("role"), none.alias("text"))
    texts = damaged.select("conv_id", "turn", *_hashes(), "copy", F.lit(None).cast("long").alias("position"),
                           none.alias("edit"), "role", "text")
    # Equal rows share one sort key; their edits come first, by position, and are handed out in turn.
    stream = (marks.unionByName(texts).repartition("conv_id")
              .sortWithinPartitions(F.col("conv_id").asc_nulls_first(), *order_columns(), F.col("position").asc_nulls_last()))
    return stream.select("conv_id", "edit", "role", "text").mapInArrow(
        _repaired, "conv_id long, repaired_sha256 string, n_repaired long")


def repair_conversations(conversations: DataFrame, chunk_rows: int = CHUNK) -> DataFrame:
    """``conversations(conv_id, turn, role, text)`` -> one row per conversation:
    ``conv_id``, ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``,
    ``cost``, ``audit``, ``repaired_sha256`` and ``n_repaired`` (rows left).

    * Rows are damaged first (see ``damage``); nulls count as one space, so a
      null text is blank and a null role fits no pattern.  Rows without
      ``conv_id`` are one conversation, whose id is null.
    * Rows are ordered by ``turn`` (null first), those of one turn by a hash of role and text; equal rows
      stay side by side and the later ones are duplicates.
    * Of the cheapest edits those with the ASCII-least letters are taken.
    * A conversation without rows after the damage has zeros, an empty audit and
      the hash of the empty string.  An empty table gives no rows.
    * A conversation may be of any length: its rows are numbered and traced in chunks
      by many tasks; its texts pass one task as a stream, because the hash
      of its lines is sequential.  ``audit`` holds a letter a row.
    """
    prepare_tasks(conversations.sparkSession)
    damaged = damage(conversations.select("conv_id", "turn", "role", "text"))
    rows = materialize(faults(damaged), "repair-faults")
    traced = traced_chunks(rows, chunk_rows)
    digests = repaired_digests(damaged, rows, traced, chunk_rows)
    distinct = F.countDistinct("turn")
    counts = rows.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - distinct, F.lit(0)).alias("gaps"),
        *(F.count_if(c).alias(c) for c in ("blank", "duplicate", "truncated")))
    letters = F.transform(F.array_sort(F.collect_list(F.struct("chunk", "letters"))), lambda x: x["letters"])
    costs = traced.groupBy("conv_id").agg(
        F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"), F.array_join(letters, "").alias("audit"))
    out = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    for part in (counts, costs, digests):
        part = part.withColumnRenamed("conv_id", "__conv")
        out = out.join(part, out["conv_id"].eqNullSafe(part["__conv"]), "left").drop("__conv")
    zero = F.lit(0).cast("long")
    return out.select(
        "conv_id", *(F.coalesce(F.col(c).cast("long"), zero).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
        F.coalesce("n_repaired", zero).alias("n_repaired"))
