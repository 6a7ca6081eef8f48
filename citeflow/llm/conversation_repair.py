"""Conversation structure repair by bidirectional Dijkstra over the edit lattice.

A conversation is right when the initials of its roles read ``(s?(ua)+)?``. Edits turn it into
a right one: ``K`` keep a turn (0), ``R`` give it the role user or assistant (2), ``D`` delete it (3; blank
turns and repeats must go), ``I`` insert an empty turn (2); a truncated turn that stays costs 1.

A node of the lattice is (turns consumed, what the output ends with: nothing, ``s``, ``u``, ``a``). Two heaps
grow from the first and from the last nodes. When the sum of their least costs is over the best
meeting, every cheapest path crosses an edge from the forward to the reverse side; all such
crossings are finished and the least concatenated audit counts. Two cheapest audits to one
node are never prefixes of each other (an audit tells its turns consumed, its state and its cost), so the
least halves make the least whole, for each end alone.

On Spark: turns are ordered by range (conversation, turn, role, text hash, row), so a conversation of
any size lies over as many tasks as its share of the rows. A task repairs the conversations that it sees
whole; of its first and last one it makes a segment: for each state before and after, the cheapest audit.
Segments meet per conversation (one per task that it lies in) and are chained. Only codes of turns
move for this, no texts. Then the texts of each conversation stream once, in order, past its
audit; nothing is held but the running hash (SHA-256 can only be taken in order).

Results: a null role or text is one space (so a null text is blank); a null turn comes first;
equal turns are ordered by role and text hash; a null conversation id is one conversation; repeated rows are
repeats, of which the first stays; a role of any other initial has to be changed or go; an empty
table gives no rows; other columns are left out; other names may clash with anything.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citeflow.llm.common import bound_batches, partitions_for, prepare, read, stored

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: the output so far ends with: nothing, a system, a user, an assistant turn
STATES = "_sua"
ACCEPTED = (0, 3)
#: state -> initial that may follow -> state; and the state that a user or assistant turn leads to
FOLLOWS = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
FORCED = (2, 2, 3, 2)
LEGAL = frozenset(["su", "ua", "au"])
#: ASCII white space, as the contracts of this package have it
BLANKS = " \t\n\x0b\x0c\r"
#: turns of one search; longer conversations are chained from segments
SEGMENT = 256
ROWS_PER_TASK = 100_000
#: what is wrong with a turn, first fault first
FINE, CUT, BLANK, REPEAT, ABSENT = range(5)

Found = tuple[int, str] | None


def _steps(code: str, state: int) -> list[tuple[int, int, str]]:
    """Edits of one turn in a state: (state after, cost, initial)."""
    initial, fault = code[0], int(code[1])
    out = [(state, DELETE, "D")]
    if fault in (FINE, CUT):
        extra = TRUNCATED if fault == CUT else 0
        if initial in FOLLOWS[state]:
            out.append((FOLLOWS[state][initial], KEEP + extra, "K"))
        if STATES[FORCED[state]] != initial:
            out.append((FORCED[state], REROLE + extra, "R"))
    return out


_STEPS = {i + str(f): [_steps(i + str(f), s) for s in range(4)] for i in "sua?" for f in (FINE, CUT, BLANK)}
_BACK = {c: [[(s, cost, op) for s in range(4) for t, cost, op in rows[s] if t == end] for end in range(4)] for c, rows in _STEPS.items()}
_COMES = [[s for s in range(4) if FORCED[s] == end] for end in range(4)]


def _search(codes: list[str], begin: int, ends: tuple[int, ...]) -> Found:
    n = len(codes)
    there: dict[tuple[int, int], tuple[int, str]] = {(0, begin): (0, "")}
    back: dict[tuple[int, int], tuple[int, str]] = {(n, e): (0, "") for e in ends}
    ahead = [(0, 0, begin)]
    behind = [(0, -n, e) for e in ends]  # of equal costs the later turns first: free edits are settled in order
    done: tuple[set, set] = (set(), set())
    best = min((back[v][0] for v in there if v in back), default=None)
    while ahead and behind and (best is None or ahead[0][0] + behind[0][0] <= best):
        if ahead[0][0] <= behind[0][0]:
            cost, i, s = heappop(ahead)
            if (i, s) in done[0]:
                continue
            done[0].add((i, s))
            audit = there[i, s][1]
            edges = [(i + 1, t, c, op) for t, c, op in _STEPS[codes[i]][s]] if i < n else []
            edges.append((i, FORCED[s], INSERT, "I"))
            for j, t, c, op in edges:
                label = (cost + c, audit + op)
                if (j, t) not in there or label < there[j, t]:
                    if (j, t) not in there or label[0] < there[j, t][0]:
                        heappush(ahead, (label[0], j, t))
                    there[j, t] = label
                if (j, t) in back and (best is None or label[0] + back[j, t][0] < best):
                    best = label[0] + back[j, t][0]
        else:
            cost, i, s = heappop(behind)
            i = -i
            if (i, s) in done[1]:
                continue
            done[1].add((i, s))
            audit = back[i, s][1]
            edges = [(i - 1, t, c, op) for t, c, op in _BACK[codes[i - 1]][s]] if i else []
            edges += [(i, t, INSERT, "I") for t in _COMES[s]]
            for j, t, c, op in edges:
                label = (cost + c, op + audit)
                if (j, t) not in back or label < back[j, t]:
                    if (j, t) not in back or label[0] < back[j, t][0]:
                        heappush(behind, (label[0], -j, t))
                    back[j, t] = label
                if (j, t) in there and (best is None or label[0] + there[j, t][0] < best):
                    best = label[0] + there[j, t][0]
    if best is None:
        return None
    # every cheapest path has an edge (or a node) from what is settled ahead to what is settled behind or an end
    found, settled = None, done[1].union((n, e) for e in ends)
    for i, s in done[0]:
        cost, audit = there[i, s]
        crossings = [(i, s, 0, "")] + [(i, FORCED[s], INSERT, "I")]
        crossings += [(i + 1, t, c, op) for t, c, op in _STEPS[codes[i]][s]] if i < n else []
        for j, t, c, op in crossings:
            if (j, t) in settled and cost + c + back[j, t][0] == best:
                whole = audit + op + back[j, t][1]
                if found is None or whole < found:
                    found = whole
    return best, found


@lru_cache(maxsize=1 << 16)
def _short(codes: str, begin: int, ends: tuple[int, ...]) -> Found:
    return _search([codes[i:i + 2] for i in range(0, len(codes), 2)], begin, ends)


def cheapest(codes: list[str], begin: int = 0, ends: tuple[int, ...] = ACCEPTED) -> Found:
    """Cost and least audit of the cheapest edits of some turns (initial and fault each) from a
    state to one of ``ends``; ``None`` if there are none."""
    if len(codes) <= 24:  # conversations repeat their structure
        return _short("".join(codes), begin, ends)
    return _search(codes, begin, ends)


Matrix = list[list[Found]]


def _least(options: Iterator[Found]) -> Found:
    return min((o for o in options if o is not None), default=None)


def _chain(one: Matrix, two: Matrix) -> Matrix:
    def via(a: Found, b: Found) -> Found:
        return None if a is None or b is None else (a[0] + b[0], a[1] + b[1])

    return [[_least(via(row[m], two[m][e]) for m in range(4)) for e in range(4)] for row in one]


def segment(codes: list[str]) -> Matrix:
    """The cheapest edits from each state to each state; long ones by halves."""
    if len(codes) > SEGMENT:
        half = len(codes) // 2
        return _chain(segment(codes[:half]), segment(codes[half:]))
    return [[cheapest(codes, b, (e,)) for e in range(4)] for b in range(4)]


def repair(codes: list[str]) -> tuple[int, str]:
    """Cost and audit of a whole conversation."""
    if len(codes) <= SEGMENT:
        return cheapest(codes)
    return _least(iter([segment(codes)[0][e] for e in ACCEPTED]))


def repaired(turns: Iterator[tuple[str, str]], audit: str) -> Iterator[tuple[str, str]]:
    """The repaired turns: ``turns`` (role, text) past their audit."""
    state, at = 0, iter(audit)

    def inserted(op: str | None) -> Iterator[tuple[str, str] | str | None]:
        nonlocal state
        while op == "I":
            state = FORCED[state]
            yield ("user" if state == 2 else "assistant"), ""
            op = next(at, None)
        return op

    for role, text in turns:
        op = yield from inserted(next(at, None))
        if op == "K":
            state = FOLLOWS[state][role[:1]]
            yield role, text
        elif op == "R":
            state = FORCED[state]
            yield ("user" if state == 2 else "assistant"), text
    yield from inserted(next(at, None))


def coded(rows: DataFrame, group: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
          present: Column | None = None) -> DataFrame:
    """Rows of turns, stored, with what the repair needs: ``conv_id, turn, role, text, tie, row, fault``. Where
    ``present`` is false the row only says that there is such a conversation."""
    space = F.lit(" ")
    rows = rows.select(F.col(group).alias("conv_id"), F.col(turn).cast("long").alias("turn"),
                       F.coalesce(F.col(role).cast("string"), space).alias("role"),
                       F.coalesce(F.col(text).cast("string"), space).alias("text"),
                       (F.lit(True) if present is None else present).alias("present"))
    visible = F.rtrim("text", F.lit(BLANKS))
    rows = (rows.withColumn("tie", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
            .withColumn("blank", visible == "").withColumn("cut", ~F.right(visible, F.lit(1)).isin(".", "!", "?")))
    prepare(rows.sparkSession)
    rows = stored(rows, "turns")
    # the first of equal turns, as they are ordered: a row per conversation, role and text (128-bit hash)
    first = (rows.where("present").groupBy("conv_id", "role", "tie", F.xxhash64(F.lit(1), "text").alias("tie2"))
             .agg(F.min(F.struct("turn", "row")).alias("first")).select(F.col("first.row").alias("row"), F.lit(True).alias("is_first")))
    fault = (F.when(~F.col("present"), ABSENT).when(F.col("blank"), BLANK).when(F.col("is_first").isNull(), REPEAT)
             .when(F.col("cut"), CUT).otherwise(FINE))
    return rows.join(first, "row", "left").withColumn("fault", fault).drop("present", "blank", "cut", "is_first")


ORDER = ("conv_id", "turn", "role", "tie", "row")
_COUNTS = ("n", "low", "high", "turns", "blank", "duplicate", "truncated", "illegal")
_SEGMENTS = ("part int, " + ", ".join(f"{c} long" for c in _COUNTS)
             + ", first string, last string, whole boolean, costs array<long>, audits array<string>")


class _Run:
    """Turns of one conversation within a task."""

    def __init__(self):
        self.codes: list[str] = []
        self.low = self.high = None
        self.turns = self.illegal = 0
        self.faults = [0] * 5
        self.first = self.last = None

    def add(self, turn: int | None, initial: str, fault: int) -> None:
        self.faults[fault] += 1
        if fault == ABSENT:
            return
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.turns += turn != self.high
            self.high = turn
        if self.last is None:
            self.first = initial
        elif self.last + initial not in LEGAL:
            self.illegal += 1
        self.last = initial
        self.codes.append((initial if initial in ("s", "u", "a") else "?") + str(min(fault, BLANK)))

    def row(self, part: int, whole: bool) -> list:
        found = [repair(self.codes)] if whole else [x for line in segment(self.codes) for x in line]
        return [part, len(self.codes), self.low, self.high, self.turns, self.faults[BLANK], self.faults[REPEAT], self.faults[CUT],
                self.illegal, self.first, self.last, whole, [x and x[0] for x in found], [x and x[1] for x in found]]


def _segments(schema: pa.Schema):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, none = TaskContext.get().partitionId(), object()
        conversation, run, seen, out = none, None, 0, []

        def rows() -> pa.RecordBatch:
            columns = [[r[0] for r in out], *([r[1][i] for r in out] for i in range(len(schema) - 1))]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "initial", "fault")]
            for conv, turn, initial, fault in zip(*columns):
                if run is None or conv != conversation:
                    if run is not None:
                        out.append((conversation, run.row(part, seen > 1)))  # the first may have begun before
                    conversation, run, seen = conv, _Run(), seen + 1
                run.add(turn, initial, fault)
            if len(out) >= 2000:
                yield rows()
                out.clear()
        if run is not None:
            out.append((conversation, run.row(part, False)))
            yield rows()

    return work


def _joined(schema: pa.Schema):
    def work(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["part"])
        total = rows[0]
        state = [(0, ""), None, None, None]
        last = None
        for k, r in enumerate(rows):
            found = [None if c is None else (c, a) for c, a in zip(r["costs"], r["audits"])]
            state = _chain([state], [found[4 * b:4 * b + 4] for b in range(4)])[0]
            if k:
                for c in ("n", "turns", "blank", "duplicate", "truncated", "illegal"):
                    total[c] += r[c]
                total["turns"] -= r["low"] is not None and r["low"] == total["high"]
                total["low"] = r["low"] if total["low"] is None else total["low"]
                total["high"] = total["high"] if r["high"] is None else r["high"]
                total["illegal"] += last is not None and r["first"] is not None and last + r["first"] not in LEGAL
            last = last if r["last"] is None else r["last"]
        best = _least(state[e] for e in ACCEPTED)
        total |= {"whole": True, "costs": [best[0]], "audits": [best[1]]}
        return pa.Table.from_pylist([total], schema=schema)

    return work


def audits(turns: DataFrame, per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Per conversation of ``coded`` turns: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = turns.sparkSession
    bound_batches(spark)
    kind = turns.schema["conv_id"].dataType.simpleString()
    light = turns.select(*ORDER, F.substring("role", 1, 1).alias("initial"), "fault")
    parts = partitions_for(spark, turns.count(), per_task)
    keys = [F.col(c).asc_nulls_first() for c in ORDER]
    ordered = light.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).select("conv_id", "turn", "initial", "fault")
    ddl = f"conv_id {kind}, {_SEGMENTS}"
    schema = to_arrow_schema(spark.createDataFrame([], ddl).schema)
    found = stored(ordered.mapInArrow(_segments(schema), ddl), "segments")
    chained = found.where("NOT whole").groupBy("conv_id").applyInArrow(_joined(schema), ddl)
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0))
    return found.where("whole").unionByName(chained).select(
        "conv_id", gaps.cast("long").alias("gaps"), "blank", "duplicate", "truncated", "illegal",
        F.col("costs")[0].alias("cost"), F.col("audits")[0].alias("audit"))


def _beside(turns: DataFrame, found: DataFrame) -> DataFrame:
    """Each conversation's audit, then its turns in order, in one task."""
    head = found.select("conv_id", F.lit(0).alias("part"), "audit", F.struct(*[c for c in found.columns if c not in ("conv_id", "audit")]).alias("more"))
    body = turns.where(F.col("fault") != ABSENT).select("conv_id", F.lit(1).alias("part"), "turn", "role", "tie", "row", "text")
    keys = [F.col(c).asc_nulls_first() for c in ("conv_id", "part", *ORDER[1:])]
    return head.unionByName(body, allowMissingColumns=True).repartition("conv_id").sortWithinPartitions(*keys)


def _streams(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[tuple[dict, Iterator[tuple[str, str]]]]:
    """Head and turns of one conversation after another; turns must be read before the next."""
    def rows():
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in columns))

    at = rows()
    row = next(at, None)
    while row is not None:
        head = dict(zip(columns, row))

        def turns():
            nonlocal row
            row = next(at, None)
            while row is not None and row[1] == 1:
                yield row[2], row[3]
                row = next(at, None)

        mine = turns()
        yield head, mine
        for _ in mine:
            pass


_STREAM = ("conv_id", "part", "role", "text", "audit", "more")


def repaired_turns(turns: DataFrame, found: DataFrame) -> DataFrame:
    """The repaired conversations as rows: ``conv_id, place`` (from 0) ``, role, text``."""
    kind = turns.schema["conv_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: Iterator[pa.RecordBatch] = batches
        first = next(kept, None)
        if first is None:
            return
        key = first.schema.field("conv_id").type

        def again():
            yield first
            yield from kept

        out, size = [], 0
        names = ["conv_id", "place", "role", "text"]
        pack = lambda: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (key, pa.int64(), pa.string(), pa.string()))], names)
        for head, mine in _streams(again(), _STREAM):
            for place, (role, text) in enumerate(repaired(mine, head["audit"])):
                out.append((head["conv_id"], place, role, text))
                size += len(text) + 64
                if size > 4 << 20:
                    yield pack()
                    out, size = [], 0
        if out:
            yield pack()

    return _beside(turns, found).mapInArrow(work, f"conv_id {kind}, place long, role string, text string")


def repair_digests(turns: DataFrame, found: DataFrame) -> DataFrame:
    """``found`` with ``repaired_sha256``: the hash of the repaired ``role:text`` lines, joined by newlines."""
    kind = turns.schema["conv_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return
        key = first.schema.field("conv_id").type

        def again():
            yield first
            yield from batches

        names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
        kinds = [key, *[pa.int64()] * 6, pa.string(), pa.string()]
        out: list[tuple] = []
        for head, mine in _streams(again(), _STREAM):
            sha, joint = hashlib.sha256(), ""
            for role, text in repaired(mine, head["audit"]):
                sha.update(f"{joint}{role}:{text}".encode())
                joint = "\n"
            more = head["more"]
            out.append((head["conv_id"], *(more[c] for c in names[1:7]), head["audit"], sha.hexdigest()))
            if len(out) >= 2000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

    counts = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
    return _beside(turns, found).mapInArrow(work, f"conv_id {kind}, {counts}, audit string, repaired_sha256 string")


def damaged(conversations: DataFrame) -> tuple[DataFrame, Column]:
    """Conversations with planted faults by the hash of conversation and turn, and which rows are there."""
    space = F.lit(" ")
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    code = F.crc32(key.cast("binary")) % 20
    text = F.coalesce(F.col("text").cast("string"), space)
    rows = conversations.select(
        "conv_id", "turn", F.when(code == 4, "user").otherwise(F.col("role").cast("string")).alias("role"),
        F.when(code == 1, "").when(code == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"), (code != 0).alias("stays"),
        F.explode(F.when(code == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
    return rows, F.col("stays")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged and repaired."""
    rows, present = damaged(read(spark, sf_dir, "conversations"))
    turns = stored(coded(rows, present=present), "coded-turns")
    return repair_digests(turns, stored(audits(turns), "audits"))
