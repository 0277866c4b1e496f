"""Conversation structure repair by the cheapest edits, found by bidirectional Dijkstra.

The turns of a conversation are edited (kept, given another role, deleted, or
new ones inserted) until their role initials read `(s?(ua)+)?`. The edit
lattice has a node for every number of turns read and every role written last
(none, system, user, assistant). A forward search from the beginning and a
reverse search from the ends settle nodes by cost; when the sum of both
frontiers exceeds the best meeting, every cheapest path has a node known to
both sides. All these crossings are finished, the nodes that lead to them are
marked, and the least audit (the edits' initials in order) is read off by
following the least letter that stays on a cheapest path: from a node every
letter leads to one node only.

Conversations of up to MOST_TURNS turns and MOST_CHARS characters are streamed
one at a time from sorted partitions. Longer ones are cut into segments of
SEGMENT_TURNS consecutive turns: distances across a segment form a small
matrix, a chain over these matrices says what lies ahead of each segment, every
segment is searched for each role it may begin with, and a second chain picks
the pieces that fit. Only the digest of the repaired text, which is sequential
by nature, reads such a conversation in one task, as a stream that holds one
batch.

Defined results: null roles and texts read as one space; null turns come
first; null ids are one conversation; turns of one number are ordered by role,
then text; repeated rows are duplicates. A conversation without rows has zeros,
an empty audit and the digest of the empty text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from heapq import heappop, heappush
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendloom.llm.common import saved, utf8
from spendloom.operators.rank import placed

#: Costs of the edits; a truncated turn that stays costs TRUNCATED more.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: What is repaired in one piece, and the turns of a segment of anything longer.
MOST_TURNS, MOST_CHARS, SEGMENT_TURNS = 10_000, 1 << 24, 8_192

WHITE = " \t\n\v\f\r"
ENDS = ".!?"
#: The role written last. Roles are user after all but user, then assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
_NEXT = (USER, USER, ASSISTANT, USER)
_BEFORE = {USER: (START, SYSTEM, ASSISTANT), ASSISTANT: (USER,)}
_ROLE = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
_NAMES = {USER: "user", ASSISTANT: "assistant"}
FAR = 1 << 60
#: Costs to finish after the last turn.
END = (0, FAR, FAR, 0)


class Lattice:
    """Moves between nodes 4 * (turns read) + (role written last).

    `turns` has one character a turn: x must be deleted, s, u and a are role
    initials, o any other; a capital is a truncated turn. Turns may be inserted
    after the last one only if `last`: else they belong to the next segment.
    """

    def __init__(self, turns: str, last: bool = True):
        self.turns, self.n, self.last = turns, len(turns), last

    def after(self, node: int) -> Iterator[tuple[str, int, int]]:
        """(letter, cost, node) of the moves from a node, by letter."""
        i, state = divmod(node, 4)
        if i < self.n:
            yield "D", DELETE, node + 4
        if i < self.n or self.last:
            yield "I", INSERT, 4 * i + _NEXT[state]
        if i < self.n and (turn := self.turns[i]) != "x":
            extra = TRUNCATED if turn.isupper() else 0
            role = _ROLE.get(turn.lower())
            if role == _NEXT[state] or role == SYSTEM and state == START:
                yield "K", KEEP + extra, 4 * i + 4 + role
            yield "R", REROLE + extra, 4 * i + 4 + _NEXT[state]

    def before(self, node: int) -> Iterator[tuple[int, int]]:
        """(cost, node) of the moves into a node."""
        i, state = divmod(node, 4)
        if i < self.n or self.last:
            for other in _BEFORE.get(state, ()):
                yield INSERT, 4 * i + other
        if i:
            yield DELETE, node - 4
            turn = self.turns[i - 1]
            if turn != "x":
                extra = TRUNCATED if turn.isupper() else 0
                kept = _ROLE.get(turn.lower()) == state
                for other in _BEFORE.get(state, ()):
                    yield (KEEP if kept else REROLE) + extra, 4 * i - 4 + other
                if kept and state == SYSTEM:
                    yield KEEP + extra, 4 * i - 4 + START


def cheapest(turns: str, entry: int = START, ends: tuple[int, ...] = END, last: bool = True) -> tuple[int, str, int]:
    """(cost, least audit, role written last) of the cheapest edits of some turns.

    `entry` is the role written before them, `ends` the cost of going on after
    them from each role.
    """
    lattice = Lattice(turns, last)
    ahead: dict[int, int] = {entry: 0}
    behind: dict[int, int] = {4 * lattice.n + role: cost for role, cost in enumerate(ends) if cost < FAR}
    # free moves lead to a later turn, so among equal costs earlier turns are settled first, in reverse later ones
    forward = [(0, entry // 4, entry)]
    reverse = [(cost, -(node // 4), node) for node, cost in behind.items()]
    reverse.sort()
    settled: set[int] = set()
    known: set[int] = set()
    best = ahead[entry] + behind.get(entry, FAR)
    while forward and reverse and forward[0][0] + reverse[0][0] <= best:
        if forward[0][0] <= reverse[0][0]:
            cost, _, node = heappop(forward)
            if node in settled:
                continue
            settled.add(node)
            for _, extra, to in lattice.after(node):
                if cost + extra < ahead.get(to, FAR):
                    ahead[to] = cost + extra
                    heappush(forward, (cost + extra, to // 4, to))
                    best = min(best, cost + extra + behind.get(to, FAR))
        else:
            cost, _, node = heappop(reverse)
            if node in known:
                continue
            known.add(node)
            for extra, to in lattice.before(node):
                if cost + extra < behind.get(to, FAR):
                    behind[to] = cost + extra
                    heappush(reverse, (cost + extra, -(to // 4), to))
                    best = min(best, cost + extra + ahead.get(to, FAR))
    # crossings, and the settled nodes that lead to one at the least cost
    marked = {x for x in settled if ahead[x] + behind.get(x, FAR) == best}
    todo = list(marked)
    while todo:
        node = todo.pop()
        for extra, to in lattice.before(node):
            if to in settled and to not in marked and ahead[to] + extra == ahead[node]:
                marked.add(to)
                todo.append(to)
    letters: list[str] = []
    node, left = entry, best
    final = 4 * lattice.n
    while not (node >= final and ends[node - final] == left):
        for letter, extra, to in lattice.after(node):
            if (to in marked and ahead[to] + left - extra == best) or (to in known and behind[to] == left - extra):
                letters.append(letter)
                node, left = to, left - extra
                break
        else:
            raise AssertionError("no cheapest path")
    return best, "".join(letters), node - final


def crossing_costs(turns: str, last: bool) -> list[list[int]]:
    """Least costs of reading a segment, from each role before it to each role after it."""
    out = []
    for entry in range(4):
        cost = [0 if role == entry else FAR for role in range(4)]
        for i in range(len(turns) + 1):
            for _ in range(2):  # no more than two insertions in a row are of use
                for role in range(4):
                    if (i < len(turns) or last) and cost[role] < FAR:
                        cost[_NEXT[role]] = min(cost[_NEXT[role]], cost[role] + INSERT)
            if i < len(turns):
                step = Lattice(turns[i], last=False)
                now = [FAR] * 4
                for role in range(4):
                    for letter, extra, to in step.after(role):
                        if letter != "I":
                            now[to - 4] = min(now[to - 4], cost[role] + extra)
                cost = now
        out.append(cost)
    return out


class Repaired:
    """The repaired text, written edit by edit into a digest."""

    def __init__(self) -> None:
        self.digest, self.state, self.empty = hashlib.sha256(), START, True

    def write(self, letter: str, role: str = "", text: str = "") -> None:
        if letter == "D":
            return
        self.state = _ROLE[role[:1]] if letter == "K" else _NEXT[self.state]
        line = f"{role if letter == 'K' else _NAMES[self.state]}:{text}"
        self.digest.update(utf8(line if self.empty else "\n" + line))
        self.empty = False

    def read(self, audit: str, turns: Iterator[tuple[str, str]]) -> None:
        for letter in audit:
            self.write(letter, *(("", "") if letter == "I" else next(turns)))


def is_blank(text: str) -> bool:
    return not text.strip(WHITE)


def is_truncated(text: str) -> bool:
    return text.rstrip(WHITE)[-1:] not in ENDS


def symbol(role: str, deleted: bool, truncated: bool) -> str:
    """One turn of a Lattice."""
    if deleted:
        return "x"
    initial = role[:1] if role[:1] in _ROLE else "o"
    return initial.upper() if truncated else initial


_REPORT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


@lru_cache(maxsize=100_000)
def _remembered(turns: str) -> tuple[int, str]:
    return cheapest(turns)[:2]


def repair(turns: list[tuple[int | None, str, str]]) -> tuple[list[int], str, str]:
    """(the numbers of _REPORT, audit, digest) of one conversation's ordered (turn, role, text)."""
    seen: set[tuple[str, str]] = set()
    blank = duplicate = truncated = 0
    symbols: list[str] = []
    for _, role, text in turns:
        is_duplicate = (role, text) in seen
        seen.add((role, text))
        if is_blank(text):
            blank += 1
        elif is_duplicate:
            duplicate += 1
        elif is_truncated(text):
            truncated += 1
            symbols.append(symbol(role, False, True))
            continue
        else:
            symbols.append(symbol(role, False, False))
            continue
        symbols.append("x")
    numbers = {turn for turn, _, _ in turns if turn is not None}
    gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
    illegal = sum(not legal(a[1], b[1]) for a, b in zip(turns, turns[1:]))
    whole = "".join(symbols)
    cost, audit = (_remembered if len(whole) <= 64 else lambda t: cheapest(t)[:2])(whole)
    out = Repaired()
    out.read(audit, iter([(role, text) for _, role, text in turns]))
    return [gaps, blank, duplicate, truncated, illegal, cost], audit, out.digest.hexdigest()


def legal(role: str, following: str) -> bool:
    return (role[:1], following[:1]) in (("s", "u"), ("u", "a"), ("a", "u"))


def damaged(conversations: DataFrame) -> DataFrame:
    """`conversations` (conv_id, turn, role, text) with reproducible faults, and `copies`: how often a row is there now.

    The remainder of crc32(`conv_id:turn`) by 20 decides: 0 drops the row
    (copies 0), 1 empties its text, 2 removes its sentence ends, 3 repeats it,
    4 makes it a user's.
    """
    part = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat(part[0], F.lit(":"), part[1]).cast("binary")) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    return conversations.select(
        "conv_id", "turn",
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind <= 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


def _result_schema(kind: str) -> str:
    return f"conv_id {kind}, " + ", ".join(f"{c} long" for c in _REPORT) + ", audit string, repaired_sha256 string"


_ORDER = ("turn", "role", "text")


def _one_by_one(rows: DataFrame, kind: str) -> DataFrame:
    """Repair conversations that are held one at a time."""
    names = ["conv_id", *_REPORT, "audit", "repaired_sha256"]

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        like: list[pa.DataType] = []

        def turns() -> Iterator[tuple]:
            for batch in batches:
                like[:] = [batch.schema.field("conv_id").type]
                yield from zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "copies")))

        def flush() -> pa.RecordBatch:
            columns = [pa.array([r[0] for r in done], like[0])]
            columns += [pa.array([r[1][k] for r in done], pa.int64()) for k in range(len(_REPORT))]
            return pa.RecordBatch.from_arrays([*columns, pa.array([r[2] for r in done]), pa.array([r[3] for r in done])], names=names)

        done: list[tuple] = []
        for conv_id, group in groupby(turns(), key=lambda r: r[0]):
            done.append((conv_id, *repair([r[1:4] for r in group for _ in range(r[4])])))
            if len(done) == 2_000:
                yield flush()
                done = []
        if done:
            yield flush()

    order = [F.col(c).asc_nulls_first() for c in ("conv_id", *_ORDER)]
    return rows.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(stream, _result_schema(kind))


def _joined(column: str, by: str) -> Column:
    """The strings of a group, in order, as one."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(by, column))), lambda x: x[column]), "")


def _by_row(df: DataFrame, fn: Callable[..., list[tuple]], columns: list[str], schema: str) -> DataFrame:
    """`fn(*columns)` for every row; its tuples are the rows of `schema`."""
    fields = [c.split(" ", 1) for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [t for values in zip(*(batch.column(c).to_pylist() for c in columns)) for t in fn(*values)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(v)) for v in zip(*out)], names=[f[0] for f in fields])

    return df.mapInArrow(run, schema)


def _segments(long_rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns with segment and faults, one row per segment) of long conversations."""
    rows = long_rows.select("name", *_ORDER, F.explode(F.expr("array_repeat(1, copies)")).alias("copy")).drop("copy")
    rows = placed(rows, F.col("name"), *[F.col(c).asc_nulls_first() for c in _ORDER], out="place")
    rows = rows.withColumn("seg", F.floor(F.col("place") / SEGMENT_TURNS))
    bare = F.rtrim("text", F.lit(WHITE))
    rows = (rows.withColumn("key", F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary")))
            .withColumn("is_blank", bare == "").withColumn("is_cut", ~F.substring(bare, -1, 1).isin(*ENDS)))
    # a turn is a duplicate unless it is the first of its key: one row per key and segment is compared
    firsts = rows.groupBy("name", "key", "seg").agg(F.min("place").alias("place"))
    first = firsts.groupBy("name", "key").agg(F.min("place").alias("first"))
    firsts = firsts.drop("place").join(first, ["name", "key"])
    rows = rows.join(firsts, ["name", "key", "seg"]).withColumn("again", F.col("place") > F.col("first"))
    fault = F.when(F.col("is_blank"), "blank").when(F.col("again"), "duplicate").when(F.col("is_cut"), "truncated")
    initial = F.substring("role", 1, 1)
    letter = F.when(initial.isin(*_ROLE), initial).otherwise("o")
    rows = rows.withColumn("fault", fault).withColumn("initial", letter).withColumn(
        "symbol", F.when(F.col("fault").isin("blank", "duplicate"), "x").when(F.col("fault") == "truncated", F.upper(letter)).otherwise(letter))
    rows = saved(rows.select("name", "seg", "place", *_ORDER, "fault", "symbol", "initial"), "long-turns")
    counts = [F.sum((F.col("fault") == c).cast("long")).alias(c) for c in ("blank", "duplicate", "truncated")]
    segments = rows.groupBy("name", "seg").agg(_joined("symbol", "place").alias("symbols"), _joined("initial", "place").alias("initials"),
                                               *[F.coalesce(c, F.lit(0)).alias(n) for c, n in zip(counts, ("blank", "duplicate", "truncated"))])
    return rows, saved(segments, "segments")


def _in_segments(long_rows: DataFrame, kind: str) -> DataFrame:
    """Repair conversations of any length; `long_rows` has a `name` besides the columns of `damaged`."""
    rows, segments = _segments(long_rows)

    def summary(name, seg, symbols, initials):
        flat = [c for last in (False, True) for line in crossing_costs(symbols, last) for c in line]
        illegal = sum(not legal(a, b) for a, b in zip(initials, initials[1:]))
        return [(name, seg, flat, illegal, initials[0], initials[-1])]

    costs = _by_row(segments, summary, ["name", "seg", "symbols", "initials"], "name string, seg long, costs array<long>, illegal long, head string, tail string")

    def look_ahead(table: pa.Table) -> pa.Table:
        """What going on costs after each segment, from its end back."""
        lines = sorted(table.to_pylist(), key=lambda r: r["seg"])
        out, ends = [], list(END)
        for k in range(len(lines) - 1, -1, -1):
            last = k == len(lines) - 1
            flat = lines[k]["costs"][16 * last :]
            begun = [min(min(flat[4 * a + b] + ends[b], FAR) for b in range(4)) for a in range(4)]
            edge = 0 if last else int(not legal(lines[k]["tail"], lines[k + 1]["head"]))
            out.append({"name": lines[k]["name"], "seg": lines[k]["seg"], "ends": ends, "last": last, "illegal": lines[k]["illegal"] + edge, "begun": begun[START]})
            ends = begun
        return pa.Table.from_pylist(out, schema=pa.schema([("name", pa.string()), ("seg", pa.int64()), ("ends", pa.list_(pa.int64())), ("last", pa.bool_()), ("illegal", pa.int64()), ("begun", pa.int64())]))

    chain = saved(costs.groupBy("name").applyInArrow(look_ahead, "name string, seg long, ends array<long>, last boolean, illegal long, begun long"), "chain")

    def search(name, seg, symbols, ends, last):
        # a role from which no end can be reached has no piece
        found = [cheapest(symbols, entry, tuple(ends), last) if min(c + e for c, e in zip(crossing_costs(symbols, last)[entry], ends)) < FAR else (FAR, "", START)
                 for entry in range(4)]
        return [(name, seg, [f[1] for f in found], [f[2] for f in found])]

    pieces = _by_row(segments.join(chain, ["name", "seg"]), search, ["name", "seg", "symbols", "ends", "last"], "name string, seg long, audits array<string>, exits array<long>")
    pieces = saved(pieces, "pieces")

    def entries(table: pa.Table) -> pa.Table:
        lines = sorted(table.to_pylist(), key=lambda r: r["seg"])
        role, out = START, []
        for line in lines:
            out.append({"name": line["name"], "seg": line["seg"], "entry": role})
            role = line["exits"][role]
        return pa.Table.from_pylist(out, schema=pa.schema([("name", pa.string()), ("seg", pa.int64()), ("entry", pa.int64())]))

    begun = pieces.select("name", "seg", "exits").groupBy("name").applyInArrow(entries, "name string, seg long, entry long")
    picked = saved(pieces.join(begun, ["name", "seg"]).select("name", "seg", F.get("audits", F.col("entry").cast("int")).alias("piece")), "picked")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One conversation after the other, in order; the first turn of a segment carries its edits."""
        name, out, letters, at = None, Repaired(), "", 0

        def end() -> pa.RecordBatch:
            out.read(letters[at:], iter(()))  # only insertions are left
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([out.digest.hexdigest()])], names=["name", "repaired_sha256"])

        for batch in batches:
            for own, piece, role, text in zip(*(batch.column(c).to_pylist() for c in ("name", "piece", "role", "text"))):
                if own != name:
                    if name is not None:
                        yield end()
                    name, out = own, Repaired()
                if piece is not None:
                    letters, at = piece, 0
                while letters[at] == "I":
                    out.write("I")
                    at += 1
                out.write(letters[at], role, text)
                at += 1
        if name is not None:
            yield end()

    first = rows.groupBy("name", "seg").agg(F.min("place").alias("place")).join(picked, ["name", "seg"]).drop("seg")
    ordered = rows.select("name", "place", "role", "text").join(first, ["name", "place"], "left").repartition("name").sortWithinPartitions("name", "place")
    hashes = ordered.select("name", "piece", "role", "text").mapInArrow(digest, "name string, repaired_sha256 string")
    turn = rows.groupBy("name").agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"))
    sums = segments.groupBy("name").agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")])
    costs = chain.groupBy("name").agg(F.sum("illegal").alias("illegal"), F.min_by("begun", "seg").alias("cost"))
    audits = picked.groupBy("name").agg(_joined("piece", "seg").alias("audit"))
    out = turn.join(sums, "name").join(costs, "name").join(audits, "name").join(hashes, "name")
    return out.select(F.expr(f"cast(if(name = '', null, substring(name, 2)) as {kind})").alias("conv_id"), *_REPORT, "audit", "repaired_sha256")


def repair_conversations(conversations: DataFrame, most_turns: int = MOST_TURNS, most_chars: int = MOST_CHARS,
                         damage: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """One row per conversation of `conversations` (conv_id, turn, role, text).

    Columns: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256. `damage` maps the rows to rows with `copies` (`damaged`
    plants reproducible faults); without it the rows are taken as they are.
    """
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    kind = rows.schema["conv_id"].dataType.simpleString()
    rows = damage(rows) if damage else rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), F.lit(1).alias("copies"))
    name = F.when(F.col("conv_id").isNull(), "").otherwise(F.concat(F.lit("="), F.col("conv_id").cast("string")))
    sizes = rows.groupBy("conv_id").agg(F.sum("copies").alias("n"), F.sum(F.length("text") * F.col("copies")).alias("chars"))
    long_ids = saved(sizes.filter((F.col("n") > most_turns) | (F.col("chars") > most_chars)).select(name.alias("name")), "long-conversations")
    if long_ids.isEmpty():
        return _one_by_one(rows, kind)
    named = rows.withColumn("name", name)
    short = _one_by_one(named.join(long_ids, "name", "left_anti").select(*rows.columns), kind)
    return short.unionByName(_in_segments(named.join(long_ids, "name", "left_semi"), kind))
