"""Conversation structure repair: bidirectional Dijkstra over the edit lattice.

A node of the lattice is (rows consumed, state of the role pattern); the states
are nothing yet, after ``s``, after ``u`` and after ``a``.  Edges are the edits Keep, Rerole, Delete and
Insert with their costs.  A forward and a reverse heap expand towards each
other; once they meet, all crossings of equal cost are finished, and among them
the least concatenated audit is taken.  Two prefixes of equal cost that reach
the same node never extend one another (an audit decides its node, and inserts
cost), so the least audit is a least prefix and a least suffix.

Rows that must be deleted are one edge with as many letters, however many.

Long conversations do not go to one task: rows are ranged over tasks by
(conversation, turn, ...), each task searches pieces of at most ``PIECE`` rows from
every state to every state, and the pieces of a conversation are then
chained from the last to the first.  What meets in one task for one conversation is its
audit (one letter a row, the size of the answer), and the stream of its repaired text
through one digest, a piece at a time: SHA-256 cannot be split.

Order: by turn (nulls first); rows of one turn by role, then by the MD5 of
role and text.  Rows equal in all of these are counted, not listed.  A role's
initial is its first character; other initials than s, u, a cannot be kept.
Null role and text are one space, so such a text is blank.  A null conv_id is
one conversation of its own.  Other columns are ignored; an empty table gives
no rows.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockhand.llm.common import settle, settle_texts, small_side

PIECE = 512             # rows of one search
PIECE_BYTES = 1 << 20   # and about as much text
START, ACCEPTED = 0, (0, 3)  # states: 0 nothing yet, 1 after s, 2 after u, 3 after a
# The edits' costs.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
_BLANK = " \t\n\x0b\x0c\r"
_NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
_MADE = (2, 2, 3, 2)  # the state after an inserted or reroled row, by the state before
_ROLE = {2: "user", 3: "assistant"}

# A step of a conversation: ("D", copies) must go; (initial, truncated) is free to stay.
Step = tuple[str, int]


def _forward(node: tuple[int, int], steps: list[Step]):
    """(node after, cost, letters) of every edit at a node."""
    i, q = node
    yield (i, _MADE[q]), INSERT, "I"
    if i < len(steps):
        kind, n = steps[i]
        if kind == "D":
            yield (i + 1, q), DELETE * n, "D" * n
            return
        yield (i + 1, q), DELETE, "D"
        if (q, kind) in _NEXT:
            yield (i + 1, _NEXT[q, kind]), TRUNCATED * n, "K"
        yield (i + 1, _MADE[q]), REROLE + TRUNCATED * n, "R"


def _reverse(node: tuple[int, int], steps: list[Step]):
    """(node before, cost, letters) of every edit that ends at a node."""
    i, q = node
    for p in range(4):
        if _MADE[p] == q:
            yield (i, p), INSERT, "I"
    if i:
        kind, n = steps[i - 1]
        if kind == "D":
            yield (i - 1, q), DELETE * n, "D" * n
            return
        yield (i - 1, q), DELETE, "D"
        for p in range(4):
            if _NEXT.get((p, kind)) == q:
                yield (i - 1, p), TRUNCATED * n, "K"
            if _MADE[p] == q:
                yield (i - 1, p), REROLE + TRUNCATED * n, "R"


def cheapest_audit(steps: list[Step], start: int = START, goals: tuple[int, ...] = ACCEPTED) -> tuple[int, str] | None:
    """Least (cost, audit) from ``start`` to one of the ``goals`` over all steps; None if there is no way."""
    labels: tuple[dict, dict] = ({(0, start): (0, "")}, {(len(steps), g): (0, "") for g in goals})
    done: tuple[set, set] = (set(), set())
    # free edges (Keep) only lead to more rows consumed (forward) or fewer (reverse), so among equal costs that
    # order settles a label after all that it can come from
    heaps = ([(0, 0, start)], [(0, -len(steps), g) for g in goals])
    best = None
    while heaps[0] or heaps[1]:
        tops = [h[0][0] if h else None for h in heaps]
        if best and (None in tops or tops[0] + tops[1] > best[0]):
            break
        side = 0 if tops[1] is None or (tops[0] is not None and tops[0] <= tops[1]) else 1
        cost, i, q = heapq.heappop(heaps[side])
        node = (abs(i), q)
        if node in done[side]:
            continue
        done[side].add(node)
        own, other = labels[side], labels[1 - side]
        said = own[node][1]
        if node in done[1 - side]:
            best = min(filter(None, (best, _joined(side, (cost, said), other[node], 0, ""))))
        for near, more, letters in (_reverse if side else _forward)(node, steps):
            if near in done[1 - side]:
                best = min(filter(None, (best, _joined(side, (cost, said), other[near], more, letters))))
            if near not in done[side]:
                label = (cost + more, letters + said if side else said + letters)
                if near not in own or label < own[near]:
                    own[near] = label
                    heapq.heappush(heaps[side], (label[0], -near[0] if side else near[0], near[1]))
    return best


def _joined(side: int, here: tuple[int, str], there: tuple[int, str], more: int, letters: str) -> tuple[int, str]:
    first, last = (there, here) if side else (here, there)
    return here[0] + more + there[0], first[1] + letters + last[1]


def repaired_lines(rows: list[tuple[str, str, int]], steps: list[Step], audit: str, state: int) -> Iterator[str]:
    """``role:text`` of each row that the audit leaves, from a state on."""
    at = 0
    skip = 0
    for letter in audit:
        if letter == "I":
            state = _MADE[state]
            yield f"{_ROLE[state]}:"
            continue
        if not skip:
            kind, n = steps[at]
            skip = n if kind == "D" else 1
        if letter != "D":
            role, text, _ = rows[at]
            state = _MADE[state] if letter == "R" else _NEXT[state, role[:1]]
            yield f"{_ROLE[state] if letter == 'R' else role}:{text}"
        skip -= 1
        if not skip:
            at += 1


class _Run:
    """Rows of one conversation in reading order, as one task sees them."""

    def __init__(self, conv_id: int | None, known_start: bool):
        self.conv_id, self.known_start = conv_id, known_start
        self.rows: list[tuple[str, str, int]] = []  # role, text, index (of a step)
        self.steps: list[Step] = []
        self.blank = self.duplicate = self.truncated = self.illegal = self.held = 0
        self.first = self.last = ""

    def add(self, role: str, text: str, copies: int, repeated: bool) -> None:
        initial = role[:1]
        if self.rows or self.steps:
            self.illegal += self.last + initial not in ("su", "ua", "au")
        else:
            self.first = initial
        self.illegal += copies - 1
        self.last = initial
        said = text.rstrip(_BLANK)
        gone = 0
        if not said.strip(_BLANK):
            self.blank += copies
            gone = copies
        elif repeated:
            self.duplicate += copies
            gone = copies
        else:
            cut = said[-1] not in ".!?"
            self.truncated += cut
            self.rows.append((role, text, len(self.steps)))
            self.steps.append((initial if initial in ("s", "u", "a") else "?", int(cut)))
            self.duplicate += copies - 1
            gone = copies - 1
            self.held += len(text)
        if gone and self.steps and self.steps[-1][0] == "D":
            self.steps[-1] = ("D", self.steps[-1][1] + gone)
        elif gone:
            self.rows.append((role, "", len(self.steps)))
            self.steps.append(("D", gone))

    def full(self) -> bool:
        return len(self.steps) >= PIECE or self.held >= PIECE_BYTES


_PIECES = ("conv_id long, whole boolean, part int, piece int, blank long, duplicate long, truncated long, illegal long, "
           "first string, last string, cost long, audit string, repaired_sha256 string, "
           "froms array<int>, tos array<int>, costs array<long>, audits array<string>, "
           "roles array<string>, texts array<string>, kinds array<string>, counts array<long>")
_STRINGS, _INTS, _LONGS = pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.int64())
_PIECES_ARROW = [pa.int64(), pa.bool_(), pa.int32(), pa.int32(), *[pa.int64()] * 4, pa.string(), pa.string(), pa.int64(), pa.string(),
                 pa.string(), _INTS, _INTS, _LONGS, _STRINGS, _STRINGS, _STRINGS, _STRINGS, _LONGS]
_PIECES_NAMES = [x.split()[0] for x in _PIECES.split(", ")]


def _record(run: _Run, ended: bool, part: int, piece: int) -> tuple:
    head = (run.conv_id, run.known_start and ended, part, piece, run.blank, run.duplicate, run.truncated, run.illegal, run.first, run.last)
    if run.known_start and ended:
        cost, audit = cheapest_audit(run.steps)
        text = "\n".join(repaired_lines(run.rows, run.steps, audit, START))
        return (*head, cost, audit, hashlib.sha256(text.encode()).hexdigest(), *[None] * 8)
    ways = [(p, q, found) for p in ((START,) if run.known_start else range(4)) for q in range(4)
            if (found := cheapest_audit(run.steps, p, (q,))) is not None]
    return (*head, None, None, None, [w[0] for w in ways], [w[1] for w in ways], [w[2][0] for w in ways], [w[2][1] for w in ways],
            [r[0] for r in run.rows], [r[1] for r in run.rows], [s[0] for s in run.steps], [s[1] for s in run.steps])


def _search_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation and turn -> records of whole conversations and of pieces of broken ones."""
    part, piece, out = TaskContext.get().partitionId(), 0, []
    run: _Run | None = None

    def batch_of(records: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*records, strict=True), _PIECES_ARROW, strict=True)], names=_PIECES_NAMES)

    for batch in batches:
        for conv_id, role, text, copies, repeated in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
            if run is None or run.conv_id != conv_id or run.full():
                if run is not None:
                    out.append(_record(run, run.conv_id != conv_id, part, piece))
                    piece += 1
                # a task's first run may go on from the task before
                run = _Run(conv_id, run is not None and run.conv_id != conv_id)
            run.add(role, text, copies, repeated)
        if out:
            yield batch_of(out)
            out = []
    if run is not None:  # and its last one may go on in the task after
        yield batch_of([_record(run, False, part, piece)])


_CHAINED = ("conv_id long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
            "parts array<int>, pieces array<int>, states array<int>, lengths array<int>")
_CHAINED_ARROW = [*[pa.int64()] * 6, pa.string(), _INTS, _INTS, _INTS, _INTS]
_CHAINED_NAMES = [x.split()[0] for x in _CHAINED.split(", ")]


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of broken conversations, each conversation's last piece first -> the cheapest chain."""
    conv = None

    def close():
        cost, audit = best[START]
        state, states, lengths = START, [], []
        for to in reversed(steps):  # from the first piece on
            states.append(state)
            state, n = to[state]
            lengths.append(n)
        return pa.RecordBatch.from_arrays(
            [pa.array([x], t) for x, t in zip((conv[0], *sums, cost, audit, at[0][::-1], at[1][::-1], states, lengths), _CHAINED_ARROW, strict=True)],
            names=_CHAINED_NAMES)

    for batch in batches:
        for r in batch.to_pylist():
            if conv is None or conv[0] != r["conv_id"]:
                if conv is not None:
                    yield close()
                conv, sums, steps, at, after = (r["conv_id"],), [0, 0, 0, 0], [], ([], []), ""
                best = {q: (0, "") for q in ACCEPTED}
            for k, name in enumerate(("blank", "duplicate", "truncated", "illegal")):
                sums[k] += r[name]
            if steps:
                sums[3] += r["last"] + after not in ("su", "ua", "au")
            after = r["first"]
            ahead: dict[int, tuple[int, str]] = {}
            to: dict[int, tuple[int, int]] = {}
            for p, q, cost, audit in zip(r["froms"], r["tos"], r["costs"], r["audits"], strict=True):
                if q in best:
                    way = (cost + best[q][0], audit + best[q][1])
                    if p not in ahead or way < ahead[p]:
                        ahead[p], to[p] = way, (q, len(audit))
            best = ahead
            steps.append(to)
            at[0].append(r["part"])
            at[1].append(r["piece"])
    if conv is not None:
        yield close()


def _digest_stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repaired pieces in order -> one digest per conversation, a piece at a time."""
    ids, digests, sha, some = [], [], None, False
    for batch in batches:
        for conv_id, texts in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if sha is None or ids[-1] != conv_id:
                if sha is not None:
                    digests.append(sha.hexdigest())
                ids.append(conv_id)
                sha, some = hashlib.sha256(), False
            text = texts.as_py()
            if text is not None:
                sha.update(b"\n" * some + text.encode())
                some = True
    if sha is not None:
        digests.append(sha.hexdigest())
    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(digests, pa.string())], names=["conv_id", "repaired_sha256"])


def _repair_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The repaired text of each piece (null if nothing is left of it)."""
    for batch in batches:
        texts = []
        for r in batch.to_pylist():
            rows = [(role, text, k) for k, (role, text) in enumerate(zip(r["roles"], r["texts"], strict=True))]
            lines = list(repaired_lines(rows, list(zip(r["kinds"], r["counts"], strict=True)), r["audit"], r["state"]))
            texts.append("\n".join(lines) if lines else None)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(texts, pa.string())],
                                         names=["conv_id", "part", "piece", "text"])


_ANSWER = ["conv_id", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def _chained(pieces: DataFrame) -> DataFrame:
    """Answers of the conversations that lie in several pieces."""
    broken = pieces.where("not whole")
    flat = broken.select("conv_id", "part", "piece", "blank", "duplicate", "truncated", "illegal", "first", "last",
                         "froms", "tos", "costs", "audits")
    chains = settle_texts(flat.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("part"), F.desc("piece"))
                          .mapInArrow(_chain, _CHAINED))
    lengths = F.col("lengths")
    offset = F.transform(lengths, lambda x, k: F.aggregate(F.slice(lengths, F.lit(1), k), F.lit(0), lambda s, y: s + y))
    chosen = (chains.select("audit", F.arrays_zip(F.col("parts"), F.col("pieces"), F.col("states"), lengths, offset.alias("offset")).alias("x"))
              .select("audit", F.inline("x"))
              .select(F.col("parts").alias("part"), F.col("pieces").alias("piece"), F.col("states").alias("state"),
                      F.substring("audit", F.col("offset") + 1, F.col("lengths")).alias("audit")))
    texts = (broken.select("conv_id", "part", "piece", "roles", "texts", "kinds", "counts").join(chosen, ["part", "piece"])
             .select("conv_id", "part", "piece", "roles", "texts", "kinds", "counts", "audit", "state"))
    repaired = settle_texts(texts.mapInArrow(_repair_pieces, "conv_id long, part int, piece int, text string"), 64)
    digests = (repaired.repartition("conv_id").sortWithinPartitions("conv_id", "part", "piece").select("conv_id", "text")
               .mapInArrow(_digest_stream, "conv_id long, repaired_sha256 string"))
    same = F.col("c.conv_id").eqNullSafe(F.col("d.conv_id"))
    return chains.alias("c").join(settle_texts(digests, 64).alias("d"), same).select("c.conv_id", *_ANSWER[1:-1], "repaired_sha256")


def repair(rows: DataFrame) -> DataFrame:
    """Audit of every conversation of ``rows`` (conv_id, turn, role, text), in ``_ANSWER`` order after conv_id and gaps."""
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    given = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        role.alias("role"), text.alias("text"))
    mark = F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"))
    rows = settle(given.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies"))
                  .withColumn("mark", F.unhex(mark)))  # identical rows meet in their own tasks first
    place = F.struct(F.col("turn").isNotNull().alias("some"), F.col("turn").alias("turn"))
    again = settle(rows.groupBy("conv_id", "mark").agg(F.min(place).alias("place"), F.count(F.lit(1)).alias("n"))
                   .where("n > 1").select(F.col("conv_id").alias("c"), F.col("mark").alias("m"), "place"))
    told = rows.join(small_side(again), F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("mark") == F.col("m")), "left")
    repeated = F.coalesce(place != F.col("place"), F.lit(False))
    order = ["conv_id", "turn", "role", "mark"]
    ranged = (told.select(*order, "text", "copies", repeated.alias("repeated")).repartitionByRange(*order).sortWithinPartitions(*order)
              .select("conv_id", "role", "text", "copies", "repeated"))
    pieces = settle_texts(ranged.mapInArrow(_search_pieces, _PIECES))
    turns = rows.where("turn is not null").select("conv_id", "turn").distinct()
    gaps = settle(turns.groupBy("conv_id").agg((F.max("turn") - F.min("turn") + 1 - F.count(F.lit(1))).alias("gaps")))
    answers = pieces.where("whole").select(*_ANSWER).unionByName(_chained(pieces))
    found = answers.alias("a").join(gaps.alias("g"), F.col("a.conv_id").eqNullSafe(F.col("g.conv_id")), "left")
    return found.select("a.conv_id", F.coalesce("gaps", F.lit(0)).cast("long").alias("gaps"), *_ANSWER[1:])


def repair_all(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """``repair``, with a row for every conv_id of ``conversations``; zeros where no row is left."""
    ids = conversations.select(F.col("conv_id").cast("long").alias("id")).distinct()
    found = settle(repair(rows))
    zero, empty = F.lit(0).cast("long"), hashlib.sha256(b"").hexdigest()
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return ids.join(found, F.col("id").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("id").alias("conv_id"), *(F.coalesce(c, zero).alias(c) for c in numbers),
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"))


def damaged(conversations: DataFrame) -> DataFrame:
    """The planted damage, chosen by crc32 of ``conv_id:turn`` modulo 20: 0 drops a row, 1 empties its text,
    2 removes its ``[.!?]``, 3 repeats it, 4 sets the role user."""
    conv, turn, role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text"))
    kind = F.crc32(F.concat(conv, F.lit(":"), turn).cast("binary")) % 20
    rows = conversations.select(F.col("conv_id"), F.col("turn"), role.alias("role"), text.alias("text"), kind.alias("kind")).where("kind != 0")
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy")).drop("copy")
