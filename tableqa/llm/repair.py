"""Repair of conversations: faults, and the cheapest edits that make the roles a well-formed sequence.

A conversation is well-formed if its role initials match `(s?(ua)+)?`. Edits, by row: Keep costs 0, Rerole (to user or
assistant) 1, Delete 2; Insert of an empty user or assistant turn, anywhere, 5. Blank rows and duplicates (role and text
seen earlier) must be deleted; truncated rows (last character is no `.`, `!` or `?`) cost 5 more unless deleted. Of all
cheapest edits those whose initials (K, R, D, I in order) are least in ASCII are taken.

Four Russians: a row is one of nine symbols (four kinds of role, truncated or not, or to be deleted) and the costs to go
from the four states of the grammar are a vector; less its least entry it is one of few vectors. For every block of
BLOCK symbols and every such vector the vector before the block is tabulated once, so a conversation is processed from
its end by one lookup a block. The trace goes forward: each block is expanded backward from its end vector and the
least of the edits that keep the cost is taken at each row. Taken from the front that is the least of all cheapest.

Conversations of at most `limit` rows lie whole in a sorted stream of a task. Longer ones are cut into segments of
SEGMENT rows by a range sort: a segment gives the 4 x 4 costs between its ends by the same lookups (one run for each end
state), these are scanned by conversation (16 numbers for SEGMENT rows), traced from each state, scanned again, and
joined to the texts by position. Only the hash of a long conversation's repaired text is taken in one task, as a stream
in order, because SHA-256 can only be computed from the front.

Edges: null ids, turns, roles and texts count as one space where text is needed; null turns come first; rows of one turn
are in order of role and a hash of the text, which keeps long texts out of the range sort; a conversation without rows
has zeros and the hash of the empty text; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableqa.llm import common
from tableqa.llm.merkle import crc32_sql

LIMIT, SEGMENT, BLOCK = 4096, 4096, 4
FAR = 1 << 40  # no way
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
UNFINISHED = 5
KINDS = "sua"  # and any other role
START, AFTER_S, AFTER_U, AFTER_A = STATES = range(4)
MUST_DELETE, SYMBOLS = 8, 9
BY_KIND = {(START, 0): AFTER_S, (START, 1): AFTER_U, (AFTER_S, 1): AFTER_U, (AFTER_U, 2): AFTER_A, (AFTER_A, 1): AFTER_U}
NEXT = {START: AFTER_U, AFTER_S: AFTER_U, AFTER_U: AFTER_A, AFTER_A: AFTER_U}  # by a turn of the wanted role
WANTED = {START: "user", AFTER_S: "user", AFTER_U: "assistant", AFTER_A: "user"}
NO_FAULT, BLANK, DUPLICATE, TRUNCATED = range(4)
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def edits(state: int, symbol: int) -> list[tuple[str, int, int]]:
    """Edits of a row in ASCII order: initial, cost, next state."""
    out = [(DELETE, COST[DELETE], state)]
    if symbol != MUST_DELETE:
        kind, extra = symbol // 2, symbol % 2 * UNFINISHED
        if (state, kind) in BY_KIND:
            out.append((KEEP, extra, BY_KIND[state, kind]))
        out.append((REROLE, COST[REROLE] + extra, NEXT[state]))
    return out


def with_inserts(costs: tuple) -> tuple:
    """Costs to go when turns may be inserted first."""
    for _ in range(3):  # no more than three inserted turns in a row can be of use
        costs = tuple(min(costs[q], costs[NEXT[q]] + COST[INSERT]) for q in STATES)
    return costs


def before(symbol: int, costs: tuple) -> tuple:
    """Costs to go in front of a row from those behind it."""
    return with_inserts(tuple(min(c + costs[to] for _, c, to in edits(q, symbol)) for q in STATES))


def normal(costs: tuple) -> tuple[tuple, int]:
    least = min(costs)
    return tuple(FAR if c >= FAR else c - least for c in costs), least


ENDED = with_inserts((0, FAR, FAR, 0))


class Tables:
    """Vectors by number, and the transitions of every vector before one symbol and before every block of `size`."""

    def __init__(self, size: int = BLOCK):
        self.size = size
        units = [tuple(0 if p == q else FAR for p in STATES) for q in STATES]
        self.vectors = [normal(v)[0] for v in (ENDED, *units)]
        self.number = {v: k for k, v in enumerate(self.vectors)}
        rows = []
        for v in self.vectors:  # grows while it is read
            row = []
            for symbol in range(SYMBOLS):
                found, least = normal(before(symbol, v))
                if found not in self.number:
                    self.number[found] = len(self.vectors)
                    self.vectors.append(found)
                row.append((self.number[found], least))
            rows.append(row)
        self.one = np.array(rows, dtype=np.int32)  # vector, symbol: vector, cost
        to, cost = self.one[:, :, 0].T, self.one[:, :, 1].T
        block, paid = np.arange(len(rows))[None, :], np.zeros((1, len(rows)), dtype=np.int64)
        for _ in range(size):  # blocks are numbered with their first symbol as the highest digit
            paid = np.stack([paid[:, to[s]] + cost[s] for s in range(SYMBOLS)], axis=1).reshape(-1, len(rows))
            block = np.stack([block[:, to[s]] for s in range(SYMBOLS)], axis=1).reshape(-1, len(rows))
        self.block, self.paid = block, paid
        self.weights = SYMBOLS ** np.arange(size - 1, -1, -1)

    def boundaries(self, symbols: np.ndarray, end: int) -> tuple[list[int], int, np.ndarray]:
        """Vectors at the block boundaries from the front (the first block is what is left over), and the cost so far."""
        rest = len(symbols) % self.size
        codes = (symbols[rest:].reshape(-1, self.size).astype(np.int64) @ self.weights)[::-1]
        at, total, found = end, 0, [end]
        for code in codes.tolist():
            total += int(self.paid[code, at])
            at = int(self.block[code, at])
            found.append(at)
        for symbol in symbols[:rest][::-1].tolist():
            at, least = self.one[at, symbol].tolist()
            total += least
        return found[::-1], total, np.array(self.vectors[at], dtype=np.int64)

    def costs(self, symbols: np.ndarray, end: int) -> np.ndarray:
        """Costs to go in front of the symbols."""
        _, total, last = self.boundaries(symbols, end)
        return np.where(last >= FAR, FAR, last + total)

    def trace(self, symbols: np.ndarray, end: int, state: int = START, finish: bool = True) -> tuple[str, int]:
        """The least of the cheapest edits from a state, and the state reached. `finish` closes the conversation."""
        found, _, _ = self.boundaries(symbols, end)
        rest, out = len(symbols) % self.size, []
        cuts = [0, *range(rest, len(symbols) + 1, self.size)] if rest else [*range(0, len(symbols) + 1, self.size)]
        ends = found if rest else found[1:]
        for (a, b), vector in zip(itertools.pairwise(cuts), ends):
            inner = [vector]
            for symbol in symbols[a:b][::-1].tolist():
                inner.append(int(self.one[inner[-1], symbol, 0]))
            inner.reverse()
            for symbol, behind in zip(symbols[a:b].tolist(), inner[1:]):
                after = self.vectors[behind]
                while True:
                    taken = least_edit(state, symbol, after)
                    out.append(taken[0])
                    state = taken[1]
                    if taken[0] != INSERT:
                        break
        if finish:
            while state not in (START, AFTER_A):
                out.append(INSERT)
                state = NEXT[state]
        return "".join(out), state


@functools.cache
def least_edit(state: int, symbol: int, after: tuple) -> tuple[str, int]:
    """The first in ASCII order of the cheapest: an edit of the row, or an inserted turn before it. Few arguments occur."""
    full = before(symbol, after)
    ways = [(e, c + after[to], to) for e, c, to in edits(state, symbol)]
    ways.append((INSERT, COST[INSERT] + full[NEXT[state]], NEXT[state]))
    return min((e, to) for e, c, to in ways if c == full[state])


_TABLES: dict[int, Tables] = {}


def tables(size: int = BLOCK) -> Tables:
    """Built once for each Python worker."""
    if size not in _TABLES:
        _TABLES[size] = Tables(size)
    return _TABLES[size]


def symbols_of(kinds: np.ndarray, faults: np.ndarray) -> np.ndarray:
    gone = (faults == BLANK) | (faults == DUPLICATE)
    return np.where(gone, MUST_DELETE, kinds * 2 + (faults == TRUNCATED)).astype(np.int16)


def illegal_pairs(kinds: np.ndarray) -> int:
    pairs = kinds[:-1] * 4 + kinds[1:]
    return int((~np.isin(pairs, [0 * 4 + 1, 1 * 4 + 2, 2 * 4 + 1])).sum())  # su, ua, au


def lines_of(audit: str, rows: list[tuple[str, str]], state: int = START) -> Iterator[str]:
    """Repaired turns as `role:text`."""
    at = iter(rows)
    for edit in audit:
        if edit == INSERT:
            yield f"{WANTED[state]}:"
            state = NEXT[state]
            continue
        role, text = next(at)
        if edit == KEEP:
            yield f"{role}:{text}"
            state = BY_KIND[state, KINDS.index(role[:1])]
        elif edit == REROLE:
            yield f"{WANTED[state]}:{text}"
            state = NEXT[state]


def damage(rows: DataFrame) -> DataFrame:
    """conv, turn, role, text: rows with planted faults, by the crc32 of `conv_id:turn` modulo 20.

    0 drops the row, 1 empties its text, 2 removes its `.!?`, 3 repeats it, 4 makes it a user's. Nulls of role and text
    become one space.
    """
    blank = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    fate = (F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20).alias("fate")
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("fate") == 4, "user").otherwise(F.col("role"))
    plain = rows.select(F.col("`conv_id`").alias("conv"), F.col("`turn`").alias("turn"), blank("role").alias("role"), blank("text").alias("text"), fate)
    copies = F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return plain.where("fate <> 0").select("conv", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def kind_of(role: Column) -> Column:
    first = F.substring(role, 1, 1)
    return F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)


def plain_fault(text: Column) -> Column:
    """Faults that show in the row alone."""
    body = F.rtrim(text, F.lit(SPACE))
    return F.when(body == "", BLANK).when(~F.substring(body, -1, 1).isin(".", "!", "?"), TRUNCATED).otherwise(NO_FAULT)


RESULT = ["conv", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
RESULT_SCHEMA = "conv string, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _solve(conv: str | None, kinds: list[int], faults: list[int], roles: list[str], texts: list[str], size: int) -> tuple:
    seen: set[tuple[str, str]] = set()
    for k, row in enumerate(zip(roles, texts)):
        if row in seen and faults[k] != BLANK:
            faults[k] = DUPLICATE
        seen.add(row)
    kinds_, faults_ = np.array(kinds), np.array(faults)
    symbols, table = symbols_of(kinds_, faults_), tables(size)
    cost = int(table.costs(symbols, table.number[ENDED])[START])
    audit, _ = table.trace(symbols, table.number[ENDED])
    text = "\n".join(lines_of(audit, list(zip(roles, texts))))
    return (
        conv, *[int((faults_ == f).sum()) for f in (BLANK, DUPLICATE, TRUNCATED)], illegal_pairs(kinds_), cost, audit,
        hashlib.sha256(text.encode("utf-8", "replace")).hexdigest(),
    )


def _short(rows: DataFrame, size: int) -> DataFrame:
    """Conversations that a task holds one at a time."""

    def stream(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_, held = False, ()
        for part in parts:
            out = []
            columns = [part[c].tolist() for c in ("conv", "kind", "fault", "role", "text")]
            for conv, *row in zip(*columns):
                if not open_ or conv != held[0]:
                    if open_:
                        out.append(_solve(*held, size))
                    open_, held = True, (conv, [], [], [], [])
                for into, value in zip(held[1:], row):
                    into.append(value)
            yield pd.DataFrame(out, columns=RESULT)
        if open_:
            yield pd.DataFrame([_solve(*held, size)], columns=RESULT)

    lying = rows.repartition("conv").sortWithinPartitions("conv", "turn", "role", F.xxhash64("text"))
    return lying.select("conv", "kind", "fault", "role", "text").mapInPandas(stream, RESULT_SCHEMA)


def _long(rows: DataFrame, size: int, segment: int) -> DataFrame:
    """Conversations over many tasks."""
    body = F.xxhash64("text")
    tied = common.cut(rows.withColumn("tie", F.monotonically_increasing_id()))
    placed = tied.repartitionByRange("conv", "turn", "role", body, "tie").sortWithinPartitions("conv", "turn", "role", body, "tie")
    placed = common.cut(placed.drop("tie", "turn").withColumn("pos", F.monotonically_increasing_id()).withColumn("seg", F.floor(F.col("pos") / segment)))
    firsts = placed.groupBy("conv", "role", F.xxhash64("text", F.lit(1)).alias("h1"), F.xxhash64("text", F.lit(2)).alias("h2")).agg(F.min("pos").alias("first"))
    marked = placed.select("conv", "seg", "pos", "kind", "fault").join(firsts.select("first"), F.col("pos") == F.col("first"), "left")
    fault = F.when((F.col("fault") != BLANK) & F.col("first").isNull(), DUPLICATE).otherwise(F.col("fault"))
    code = F.struct("pos", (F.col("kind") * 4 + fault).alias("code"))
    parts = common.cut(marked.groupBy("conv", "seg").agg(F.sort_array(F.collect_list(code)).alias("rows")).select(
        "conv", "seg", F.col("rows.code").alias("codes"), F.col("rows.pos").alias("at")
    ))

    def codes_of(part: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for codes in part["codes"]:
            yield np.asarray(codes) // 4, np.asarray(codes) % 4

    def ends_of(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = tables(size)
        for part in parts:
            out = []
            for conv, seg, (kinds, faults) in zip(part["conv"], part["seg"], codes_of(part)):
                symbols = symbols_of(kinds, faults)
                units = [table.costs(symbols, 1 + q) for q in STATES]  # of a way that ends in q
                counts = [int((faults == f).sum()) for f in (BLANK, DUPLICATE, TRUNCATED)]
                out.append((conv, seg, np.stack(units, axis=1).ravel().tolist(), int(kinds[0]), int(kinds[-1]), *counts, illegal_pairs(kinds)))
            yield pd.DataFrame(out, columns=["conv", "seg", "ways", "head", "tail", "blank", "duplicate", "truncated", "illegal"])

    ways = common.cut(parts.select("conv", "seg", "codes").mapInPandas(
        ends_of, "conv string, seg long, ways array<long>, head int, tail int, blank long, duplicate long, truncated long, illegal long"
    ))

    def back(part: pd.DataFrame) -> pd.DataFrame:
        """Costs to go behind every segment, normalised; the cost of the whole is that of the first one's front."""
        part = part.sort_values("seg").reset_index(drop=True)
        behind, paid, found = np.array(ENDED, dtype=np.int64), 0, [()] * len(part)
        for k in range(len(part) - 1, -1, -1):
            found[k] = behind.tolist()
            here = (np.asarray(part["ways"][k]).reshape(4, 4) + behind[None, :]).min(axis=1)
            vector, least = normal(tuple(np.minimum(here, FAR).tolist()))
            behind, paid = np.array(vector, dtype=np.int64), paid + least
        borders = np.stack([part["tail"].to_numpy()[:-1], part["head"].to_numpy()[1:]], axis=1)
        across = sum(illegal_pairs(b) for b in borders)
        return pd.DataFrame({
            "conv": part["conv"], "seg": part["seg"], "behind": found, "last": [False] * (len(part) - 1) + [True], "cost": int(behind[START]) + paid,
            **{c: int(part[c].sum()) for c in ("blank", "duplicate", "truncated")}, "illegal": int(part["illegal"].sum()) + across,
        })

    scanned = common.cut(ways.groupBy("conv").applyInPandas(
        back, "conv string, seg long, behind array<long>, last boolean, cost long, blank long, duplicate long, truncated long, illegal long"
    ))

    def traced(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = tables(size)
        for part in parts:
            out = []
            for conv, seg, behind, last, (kinds, faults) in zip(part["conv"], part["seg"], part["behind"], part["last"], codes_of(part)):
                symbols, end = symbols_of(kinds, faults), table.number[normal(tuple(int(x) for x in behind))[0]]
                tried = [table.trace(symbols, end, q, bool(last)) for q in STATES]
                out.append((conv, seg, [a for a, _ in tried], [q for _, q in tried]))
            yield pd.DataFrame(out, columns=["conv", "seg", "audits", "ends"])

    tries = common.cut(parts.select("conv", "seg", "codes").join(scanned.select("conv", "seg", "behind", "last"), ["conv", "seg"]).mapInPandas(
        traced, "conv string, seg long, audits array<string>, ends array<int>"
    ))

    def forward(part: pd.DataFrame) -> pd.DataFrame:
        part, state, found = part.sort_values("seg").reset_index(drop=True), START, []
        for ends in part["ends"]:
            found.append(state)
            state = int(ends[state])
        return pd.DataFrame({"conv": part["conv"], "seg": part["seg"], "state": found})

    states = tries.select("conv", "seg", "ends").groupBy("conv").applyInPandas(forward, "conv string, seg long, state int")
    chosen = common.cut(tries.join(states, ["conv", "seg"]).select("conv", "seg", "state", F.element_at("audits", F.col("state") + 1).alias("audit")))

    def edited(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """What becomes of each row: turns inserted before and behind it, and its role, null if it goes; `=` keeps it."""
        for part in parts:
            out = []
            for state, audit, at, (kinds, _) in zip(part["state"], part["audit"], part["at"], codes_of(part)):
                made, k, waiting = [], 0, []
                for edit in audit:
                    if edit == INSERT:
                        waiting.append(f"{WANTED[state]}:")
                        state = NEXT[state]
                        continue
                    made.append([int(at[k]), waiting, None if edit == DELETE else "=" if edit == KEEP else WANTED[state], []])
                    state = BY_KIND[state, int(kinds[k])] if edit == KEEP else NEXT[state] if edit == REROLE else state
                    waiting, k = [], k + 1
                made[-1][3] = waiting
                out += made
            yield pd.DataFrame(out, columns=["at", "ahead", "as_role", "behind"])

    fates = parts.join(chosen, ["conv", "seg"]).select("state", "audit", "at", "codes").mapInPandas(edited, "at long, ahead array<string>, as_role string, behind array<string>")
    own = F.when(F.col("as_role").isNotNull(), F.array(F.concat(F.when(F.col("as_role") == "=", F.col("role")).otherwise(F.col("as_role")), F.lit(":"), "text")))
    turns = placed.select("conv", "pos", "role", "text").join(fates, F.col("pos") == F.col("at")).select(
        "conv", "pos", F.concat("ahead", F.coalesce(own, F.array().cast("array<string>")), "behind").alias("lines")
    )

    def hashed(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_, held, state, started = False, None, hashlib.sha256(), False
        for part in parts:
            out = []
            for conv, lines in zip(part["conv"].tolist(), part["lines"]):
                if not open_ or conv != held:
                    if open_:
                        out.append((held, state.hexdigest()))
                    open_, held, state, started = True, conv, hashlib.sha256(), False
                for line in lines:
                    state.update((("\n" if started else "") + line).encode("utf-8", "replace"))
                    started = True
            yield pd.DataFrame(out, columns=["conv", "sha"])
        if open_:
            yield pd.DataFrame([(held, state.hexdigest())], columns=["conv", "sha"])

    hashes = turns.repartition("conv").sortWithinPartitions("conv", "pos").select("conv", "lines").mapInPandas(hashed, "conv string, sha string")
    audits = chosen.groupBy("conv").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("seg", "audit"))), lambda x: x["audit"]), "").alias("audit"))
    totals = scanned.where("last").select("conv", "blank", "duplicate", "truncated", "illegal", "cost")
    return totals.join(audits, "conv").join(hashes, "conv").select("conv", "blank", "duplicate", "truncated", "illegal", "cost", "audit", F.col("sha").alias("repaired_sha256"))


def repair(rows: DataFrame, limit: int = LIMIT, segment: int = SEGMENT, block: int = BLOCK) -> DataFrame:
    """One row for each conversation of `rows` (conv, turn, role, text; no nulls but in conv and turn): gaps, faults,
    illegal neighbours, cost, audit and hash of the repaired turns.

    `limit` and `segment` decide only how the work is cut, not its results.
    """
    # a null id travels as null text with a mark, so it is one conversation of its own
    conv = F.concat(F.when(F.col("conv").isNull(), "n").otherwise("c"), F.coalesce(F.col("conv").cast("string"), F.lit("")))
    kind = rows.schema["conv"].dataType
    ready = common.cut(rows.select(conv.alias("conv"), "turn", "role", "text", kind_of(F.col("role")).alias("kind"), plain_fault(F.col("text")).alias("fault")))
    span = F.max("turn") - F.min("turn") + 1
    sizes = common.cut(ready.groupBy("conv").agg(F.count(F.lit(1)).alias("n"), F.max("turn").alias("hi"), F.min("turn").alias("lo")))
    # distinct turns by two levels of counting, so a long conversation is combined before the shuffle
    distinct = ready.where("turn IS NOT NULL").groupBy("conv", "turn").count().groupBy("conv").agg(F.count(F.lit(1)).alias("different"))
    gaps = sizes.join(distinct, "conv", "left").select(F.col("conv").alias("of"), F.coalesce(F.col("hi") - F.col("lo") + 1 - F.col("different"), F.lit(0)).cast("long").alias("gaps"))
    long_ones = sizes.where(F.col("n") > limit).select("conv")
    if long_ones.isEmpty():
        solved = _short(ready, block)
    else:
        apart = common.small(long_ones)
        solved = _short(ready.join(apart, "conv", "left_anti"), block).unionByName(_long(ready.join(apart, "conv", "left_semi"), block, segment))
    back = F.when(F.col("conv").startswith("c"), F.substring("conv", 2, 1 << 30)).cast(kind)
    return solved.join(gaps, F.col("conv") == F.col("of")).select(back.alias("conv"), "gaps", *RESULT[1:])


def repaired_digests(conversations: DataFrame, **options) -> DataFrame:
    """Damages `conversations`, repairs what is left and gives a row for each of its conv_id."""
    found = repair(damage(conversations), **options)
    every = conversations.select(F.col("`conv_id`").alias("conv_id")).distinct()
    none = {c: F.lit(0).cast("long") for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    none |= {"audit": F.lit(""), "repaired_sha256": F.lit(hashlib.sha256(b"").hexdigest())}
    return every.join(found, F.col("conv_id").eqNullSafe(F.col("conv")), "left").select(
        "conv_id", *[F.coalesce(F.col(c), v).alias(c) for c, v in none.items()]
    )


def repair_sql() -> str:
    """The digests as SQL over `conversations`: a recursion from the last row; a way is `cost:audit:turns`, least first."""
    step = lambda e, cost, to, turn: (
        f"printf('%09d:%s%s:%s', CAST(left({to}, 9) AS BIGINT) + {cost}, '{e}', split_part(substr({to}, 11), ':', 1), "
        f"{turn} || substr({to}, 12 + strpos(substr({to}, 11), ':') - 1))"
    )
    insert = lambda q, to: step("I", COST[INSERT], to, f"chr(10) || '{WANTED[q]}:'")
    fail = "CAST(NULL AS VARCHAR)"

    def row(q: int) -> str:
        keeps = " ".join(f"WHEN kind = {kind} THEN {step('K', 'extra', f'v{to}', 'chr(10) || role || chr(58) || text')}" for (p, kind), to in BY_KIND.items() if p == q)
        rerole = step("R", f"{COST[REROLE]} + extra", f"v{NEXT[q]}", f"chr(10) || '{WANTED[q]}:' || text")
        return f"least({step('D', COST[DELETE], f'v{q}', repr(''))}, CASE WHEN gone THEN {fail} {keeps} END, CASE WHEN NOT gone THEN {rerole} END)"

    def closed(source: str, keys: str) -> str:
        """Three rounds of possible inserts."""
        for _ in range(3):
            source = f"SELECT {keys}, " + ", ".join(f"least(v{q}, {insert(q, f'v{NEXT[q]}')}) AS v{q}" for q in STATES) + f" FROM ({source})"
        return source

    ended = "SELECT conv, n AS k, '000000000::' AS v0, '000000010:II:' || chr(10) || 'user:' || chr(10) || 'assistant:' AS v1, '000000005:I:' || chr(10) || 'assistant:' AS v2, '000000000::' AS v3 FROM sizes"
    again = closed(f"SELECT r.conv, r.k - 1 AS k, {', '.join(f'{row(q)} AS v{q}' for q in STATES)} FROM best b JOIN rows r ON r.conv IS NOT DISTINCT FROM b.conv AND r.k = b.k", "conv, k")
    blank = r"regexp_replace(text, '[\x20\x09-\x0D]+$', '')"
    text = lambda c: f"coalesce(CAST({c} AS VARCHAR), ' ')"
    return f"""
WITH RECURSIVE fated AS (
  SELECT conv_id AS conv, turn, {text("role")} AS role, {text("text")} AS text, {crc32_sql(f"{text('conv_id')} || ':' || {text('turn')}")} % 20 AS fate
  FROM conversations
), damaged AS (
  SELECT conv, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
         CASE fate WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM fated JOIN (VALUES (0), (1)) c(copy) ON copy = 0 OR fate = 3 WHERE fate <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text) AS k,
         CASE left(role, 1) WHEN 's' THEN 0 WHEN 'u' THEN 1 WHEN 'a' THEN 2 ELSE 3 END AS kind, {blank} AS body
  FROM damaged
), faulty AS (
  SELECT *, CASE WHEN body = '' THEN 1 WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY k) > 1 THEN 2
                 WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
         kind * 10 + lead(kind) OVER (PARTITION BY conv ORDER BY k) AS pair
  FROM placed
), rows AS MATERIALIZED (
  SELECT *, fault IN (1, 2) AS gone, CASE WHEN fault = 3 THEN {UNFINISHED} ELSE 0 END AS extra FROM faulty
), sizes AS (
  SELECT conv, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
         count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated, count(*) FILTER (pair NOT IN (1, 12, 21)) AS illegal
  FROM rows GROUP BY conv
), best AS (
  {ended}
  UNION ALL
  {again}
)
SELECT e.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
  CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal,
  CAST(coalesce(left(v0, 9), '0') AS BIGINT) AS cost, coalesce(split_part(substr(v0, 11), ':', 1), '') AS audit,
  sha256(coalesce(substr(v0, 12 + strpos(substr(v0, 11), ':')), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) e
LEFT JOIN sizes s ON s.conv IS NOT DISTINCT FROM e.conv_id
LEFT JOIN best b ON b.conv IS NOT DISTINCT FROM e.conv_id AND b.k = 0 AND s.conv IS NOT DISTINCT FROM b.conv AND s.n IS NOT NULL"""
