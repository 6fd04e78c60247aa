"""Repair of a conversation's turn structure by its cheapest edits.

The rows of a conversation are read once, in order. For each of the four places
in the wanted shape, system? (user assistant)+ or nothing, the cheapest edits
that lead there are kept; what edits they were is a node of a tree that all of
them share, so a step adds a few nodes and copies nothing. Equally cheap edits
are told apart by their strings: each node keeps a far ancestor beside its
parent (binary lifting in linear space) and a rolling hash of its path, by which
the longest common prefix is found in a logarithm of the length; the edit after
it decides. Equal hashes are verified: of one string there is one node only, so
two different nodes never stand for the same edits.

Texts don't take part in that search. It reads one narrow row per turn, and a
second pass over the turns, led by the edits found, writes the repaired turns.
"""

from __future__ import annotations

import hashlib
from array import array

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SYSTEM_NEXT, USER, ASSISTANT = 1, 2, 3  # after the system turn, a user's, an assistant's; 0 is the start
ROLE = {USER: "user", ASSISTANT: "assistant"}
KEEPS = {(0, "s"): SYSTEM_NEXT, (0, "u"): USER, (SYSTEM_NEXT, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
NEXT = (USER, USER, ASSISTANT, USER)  # the place that an inserted or reroled turn leads to
RIGHT_PAIRS = {"su", "ua", "au"}
DELETE_COST, REROLE_COST, INSERT_COST, TRUNCATED_COST = 3, 2, 2, 1
FAULTS = ("", "blank", "duplicate", "truncated")
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
OUT_BYTES, OUT_ROWS = 4 << 20, 4096
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15

WHITE = " \t\n\x0b\x0c\r"
AUDIT_COLUMNS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, faults string"
LOG_COLUMNS = (
    "step long, edit string, fault string, turn long, role string, text string, gaps long, blank long, duplicate long, "
    "truncated long, illegal long, cost long"
)


class EditTree:
    """Edit strings as paths from a root; a string is the node it ends in."""

    def __init__(self):
        self.parent, self.far, self.depth = array("q", [0]), array("q", [0]), array("q", [0])
        self.hash, self.edit = array("Q", [0]), bytearray(1)

    def add(self, node: int, edit: int) -> int:
        far, depth = self.far, self.depth
        near = far[node]
        # Two jumps of the same length make one of the next length.
        doubles = depth[node] - depth[near] == depth[near] - depth[far[near]]
        self.parent.append(node)
        far.append(far[near] if doubles else node)
        depth.append(depth[node] + 1)
        self.hash.append((self.hash[node] * _BASE + edit) & _MASK)
        self.edit.append(edit)
        return len(depth) - 1

    def drop_last(self) -> None:
        for column in (self.parent, self.far, self.depth, self.hash, self.edit):
            column.pop()

    def ancestor(self, node: int, depth: int) -> int:
        while self.depth[node] > depth:
            node = self.far[node] if self.depth[self.far[node]] >= depth else self.parent[node]
        return node

    def same(self, a: int, b: int) -> bool:
        """Whether two nodes of one depth are one string: by hash, then verified."""
        return self.hash[a] == self.hash[b] and a == b

    def less(self, a: int, b: int) -> bool:
        """Whether a's string is before b's in ASCII order."""
        shorter = min(self.depth[a], self.depth[b])
        x, y = self.ancestor(a, shorter), self.ancestor(b, shorter)
        if self.same(x, y):
            return self.depth[a] < self.depth[b]
        while True:
            if not self.same(self.far[x], self.far[y]):
                x, y = self.far[x], self.far[y]
            elif self.same(self.parent[x], self.parent[y]):
                return self.edit[x] < self.edit[y]
            else:
                x, y = self.parent[x], self.parent[y]

    def text(self, node: int) -> str:
        out = bytearray(self.depth[node])
        for place in range(len(out) - 1, -1, -1):
            out[place] = self.edit[node]
            node = self.parent[node]
        return out.decode()


K, R, D, I = b"KRDI"  # noqa: E741


class Audit:
    """The cheapest edits of one conversation, turn by turn."""

    def __init__(self):
        self.tree = EditTree()
        self.best: dict[int, tuple[int, int]] = {0: (0, 0)}  # place: cost, node
        self.counts = [0, 0, 0, 0]
        self.faults = bytearray()
        self.before, self.illegal = None, 0
        self.low = self.high = self.seen = None
        self.turns = 0
        self._insert()

    def _cheapest(self, options: list[tuple[int, int, int]]) -> tuple[int, int]:
        """(cost, node) of the cheapest (cost, node before, edit), ties by string."""
        cost = min(options)[0]
        tied = [(node, edit) for c, node, edit in options if c == cost]
        best = tied[0]
        for other in tied[1:]:
            a, b = self.tree.add(*best), self.tree.add(*other)
            if self.tree.less(b, a):
                best = other
            self.tree.drop_last()
            self.tree.drop_last()
        return cost, self.tree.add(*best)

    def _offer(self, place: int, cost: int, node: int) -> None:
        """A turn inserted behind `node` leads to `place`, if nothing better does."""
        have, new = self.best.get(place), self.tree.add(node, I)
        if have is None or cost < have[0] or (cost == have[0] and self.tree.less(new, have[1])):
            self.best[place] = (cost, new)
        else:
            self.tree.drop_last()

    def _insert(self) -> None:
        """Inserted turns lead on from what is there; a whole pair brings no new place."""
        best = self.best
        for place in (0, SYSTEM_NEXT):
            if place in best:
                self._offer(USER, best[place][0] + INSERT_COST, best[place][1])
        user, assistant = best.get(USER), best.get(ASSISTANT)
        if assistant:
            self._offer(USER, assistant[0] + INSERT_COST, assistant[1])
        if user:
            self._offer(ASSISTANT, user[0] + INSERT_COST, user[1])
        # Who is behind an assistant's turn can do all that these places can.
        if ASSISTANT in best:
            done = best[ASSISTANT][0]
            if 0 in best and best[0][0] > done + DELETE_COST:
                del best[0]
            if SYSTEM_NEXT in best and best[SYSTEM_NEXT][0] > done:
                del best[SYSTEM_NEXT]

    def add(self, turn: int | None, initial: str, fault: int) -> None:
        if self.before is not None and self.before + initial not in RIGHT_PAIRS:
            self.illegal += 1
        self.before = initial
        if turn is not None:
            # Turns come in order.
            if self.low is None:
                self.low = turn
            self.turns += turn != self.high
            self.high = turn
        self.counts[fault] += 1
        self.faults.append(48 + fault)
        options: dict[int, list[tuple[int, int, int]]] = {}
        extra = TRUNCATED_COST if fault == TRUNCATED else 0
        for place, (cost, node) in self.best.items():
            options.setdefault(place, []).append((cost + DELETE_COST, node, D))
            if fault in (BLANK, DUPLICATE):
                continue
            kept = KEEPS.get((place, initial))
            if kept is not None:
                options.setdefault(kept, []).append((cost + extra, node, K))
            options.setdefault(NEXT[place], []).append((cost + REROLE_COST + extra, node, R))
        self.best = {place: self._cheapest(found) for place, found in options.items()}
        self._insert()

    def result(self) -> tuple:
        ends = [self.best[p] for p in (0, ASSISTANT) if p in self.best]
        cost, node = min(ends, key=lambda x: x[0])
        for c, other in ends:
            if c == cost and other != node and self.tree.less(other, node):
                node = other
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (gaps, self.counts[BLANK], self.counts[DUPLICATE], self.counts[TRUNCATED], self.illegal, cost,
                self.tree.text(node), self.faults.decode())


class _Out:
    """Rows gathered to batches of bounded size."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.size = schema, [], 0

    def add(self, row: tuple, size: int):
        self.rows.append(row)
        self.size += size
        if self.size > OUT_BYTES or len(self.rows) >= OUT_ROWS:
            yield self.flush()

    def flush(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) or [()] * len(self.schema)
        batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, self.schema)], schema=self.schema)
        self.rows, self.size = [], 0
        return batch


def _arrow(columns: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in ("conv_id long, " + columns).split(","))])


_NO_CONVERSATION = object()


def _find_edits(batches):
    """One row per conversation; its turns come together and in order."""
    out = _Out(_arrow(AUDIT_COLUMNS))
    current, audit = _NO_CONVERSATION, None
    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in ("conv_id", "turn", "initial", "fault", "lost")]
        for conv, turn, initial, fault, lost in zip(*columns):
            if conv != current:
                if audit:
                    found = audit.result()
                    yield from out.add((current, *found), 2 * len(found[-1]))
                current, audit = conv, Audit()
            if not lost:
                audit.add(turn, initial, fault)
    if audit:
        yield from out.add((current, *audit.result()), 0)
    yield out.flush()


def _apply_edits(batches):
    """The log of every conversation: its summary, then its edits in order."""
    out = _Out(_arrow(LOG_COLUMNS))
    nothing = (None,) * 6
    current, audit, faults = _NO_CONVERSATION, "", ""
    place = at = row = 0

    def inserted():
        nonlocal place, at
        while at < len(audit) and audit[at] == "I":
            place, at = NEXT[place], at + 1
            yield from out.add((current, at, "I", None, None, ROLE[place], "", *nothing), 32)

    names = ("conv_id", "kind", "turn", "role", "text", "audit", "faults", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    for batch in batches:
        for conv, kind, turn, role, text, new_audit, new_faults, *numbers in zip(*(batch.column(n).to_pylist() for n in names)):
            if kind == 0:
                yield from inserted()
                current, audit, faults = conv, new_audit, new_faults
                place = at = row = 0
                yield from out.add((conv, 0, "", None, None, None, None, *numbers), 100)
                continue
            yield from inserted()
            edit, fault = audit[at], FAULTS[ord(faults[row]) - 48]
            at, row = at + 1, row + 1
            if edit == "K":
                place = KEEPS[place, role[:1]]
            elif edit == "R":
                place = NEXT[place]
                role = ROLE[place]
            yield from out.add((current, at, edit, fault or None, turn, role, text, *nothing), 32 + len(text))
    yield from inserted()
    yield out.flush()


def repair_conversations(
    df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    lost: Column | None = None,
) -> DataFrame:
    """The cheapest edits that give every conversation the shape system? (user assistant)+, or nothing.

    Returns a log: for each conversation one row of step 0 with its figures
    (gaps, blank, duplicate, truncated, illegal, cost) and a row per edit, in
    order, with step, edit, fault, turn, role and text as they are after the
    edit; of a deleted turn (edit D) they are as before. All edits but D are the
    repaired conversation. Rows of one conversation come together, in order.

    Turns are taken in order of `turn_col`, nulls first, ties by role and then by
    digest of the text. A turn's first fault counts: blank (no other characters
    than white space), duplicate (role and text seen before in the
    conversation), truncated (ends without `.!?`). Costs: keep 0, rerole to user
    or assistant 2, delete 3 (must be done for blank and duplicate), insert an
    empty turn 2; a truncated turn that stays costs 1 more. Equally cheap edits:
    the least string of the initials K, R, D, I. A role's first letter is
    what has to fit.

    A null role or text is one space. Rows with a null id are one conversation.
    `lost` marks rows that are not part of their conversation; one without other
    rows has figures of 0 and no edits. Repeated rows are duplicates; an empty
    table gives no rows; other columns are ignored. Ids and turns are cast to
    long.

    A conversation goes through one task, since order and digest run through
    all of it, but row by row: about 100 bytes a turn are held, and no texts.
    """
    # The digest stands for role and text, so that the search needs no texts.
    turns = df.select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit(" ")).alias("text"),
        F.coalesce(lost if lost is not None else F.lit(False), F.lit(False)).alias("lost"),
    ).withColumn("digest", F.unhex(F.sha2(F.concat_ws(":", F.length("role").cast("string"), "role", "text"), 256)))
    last = F.right(F.rtrim("text", F.lit(WHITE)), F.lit(1))
    narrow = turns.select(
        "conv_id", "turn", "role", "digest", "lost", F.substring("role", 1, 1).alias("initial"),
        (~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("blank"), (~last.isin(".", "!", "?")).alias("open"),
    )
    # Partitioned by conversation alone, the rank below and the order need no other shuffle.
    same = Window.partitionBy("conv_id", "lost", "digest").orderBy(F.col("turn").asc_nulls_first())
    judged = narrow.repartition("conv_id").withColumn("nth", F.row_number().over(same)).withColumn(
        "fault", F.when(F.col("blank"), BLANK).when(F.col("nth") > 1, DUPLICATE).when(F.col("open"), TRUNCATED).otherwise(0))
    order = [F.col("turn").asc_nulls_first(), "role", "digest"]
    audits = judged.sortWithinPartitions("conv_id", *order, "nth").select("conv_id", "turn", "initial", "fault", "lost").mapInArrow(
        _find_edits, "conv_id long, " + AUDIT_COLUMNS)
    both = audits.withColumn("kind", F.lit(0)).unionByName(
        turns.filter("not lost").drop("lost").withColumn("kind", F.lit(1)), allowMissingColumns=True)
    led = both.repartition("conv_id").sortWithinPartitions("conv_id", "kind", *order).drop("digest")
    return led.mapInArrow(_apply_edits, "conv_id long, " + LOG_COLUMNS)


def _digest_log(batches):
    schema = _arrow("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")
    out, summary, audit, digest = _Out(schema), None, bytearray(), hashlib.sha256()
    any_turn = False
    names = ("conv_id", "step", "edit", "role", "text", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    for batch in batches:
        for conv, step, edit, role, text, *numbers in zip(*(batch.column(n).to_pylist() for n in names)):
            if step == 0:
                if summary:
                    yield from out.add((*summary, audit.decode(), digest.hexdigest()), 100 + len(audit))
                summary, audit, digest, any_turn = (conv, *numbers), bytearray(), hashlib.sha256(), False
                continue
            audit += edit.encode()
            if edit != "D":
                digest.update(f"{chr(10) if any_turn else ''}{role}:{text}".encode())
                any_turn = True
    if summary:
        yield from out.add((*summary, audit.decode(), digest.hexdigest()), 0)
    yield out.flush()


def summaries(log: DataFrame) -> DataFrame:
    """Per conversation of a log: its figures, its edits' initials and SHA-256 of the repaired `role:text` lines.

    The log must come as `repair_conversations` gives it, its rows in order.
    """
    return log.mapInArrow(
        _digest_log,
        "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string",
    )


def damaged(df: DataFrame) -> DataFrame:
    """Conversations with faults put in by the checksum of `conv_id:turn`, modulo 20.

    0 loses the row (column `lost`), 1 empties its text, 2 removes its `.!?`, 3
    repeats it, 4 makes its role user; nulls are one space.
    """
    as_text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(as_text("conv_id"), F.lit(":"), as_text("turn"))) % 20
    rows = df.select("conv_id", "turn", as_text("role").alias("role"), as_text("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        (F.col("kind") == 0).alias("lost"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")
