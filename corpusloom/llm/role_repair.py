"""Repair of the turn structure of conversations by a generalised LR parser with weighted edits.

The roles of a repaired conversation follow the grammar ``(s?(ua)+)?`` of role initials. Every turn is kept, given another
role or deleted, and turns without text are inserted anywhere; the parser looks for the cheapest edits and, among these,
for the audit (initials of the edits in order) that stands first in ASCII order.

Stacks of the LR automaton share their tails. After each turn, stacks with equal tops are merged and the one
with the smaller (cost, audit) goes on: equal tops accept the same continuations in this grammar. Audits are not compared as
texts: the edits of one turn, insertions before it included, end with a letter that no insertion has, so no turn's edits begin another's, and
the order of all audits follows from the order before the turn. What is left of the costs and orders after a turn takes few
forms, so each pair (form, kind of turn) is worked out once and looked up after that.

Turns are dealt by conversation, sorted, and parsed as they come: without texts, hashes in their place. The edits
then meet the texts by turn. One conversation is parsed by one task, which holds some 300 bytes for each of its turns.

Nulls count as one blank, in every column; a null ``conv_id`` is a conversation like others. Turns with equal numbers follow by
role, then by the MD5 of the text. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.session import materialize

#: A conversation is empty, or pairs of user and assistant after an optional system turn: s, u, a are role initials.
GRAMMAR = [("S", ""), ("S", "P"), ("S", "sP"), ("P", "ua"), ("P", "Pua")]
ROLES = {"u": "user", "a": "assistant"}
INSERT, REROLE, DELETE, TRUNCATED = 3, 3, 4, 3
SPACES = " \t\n\x0b\x0c\r"
LEGAL = {"su", "ua", "au"}
ROWS_AT_A_TIME = 1 << 14


class Automaton:
    """LR automaton of a grammar, with reductions by the symbols that may follow."""

    def __init__(self, grammar: list[tuple[str, str]] = GRAMMAR):
        self.rules = [("", grammar[0][0]), *grammar]
        self.names = {left for left, _ in self.rules}
        self.follow = self._follow()
        self.states = [self._closure({(0, 0)})]
        self.goto: dict[tuple[int, str], int] = {}
        for state, items in enumerate(self.states):
            for symbol in sorted({self.rules[rule][1][dot] for rule, dot in items if dot < len(self.rules[rule][1])}):
                moved = {(rule, dot + 1) for rule, dot in items if self.rules[rule][1][dot : dot + 1] == symbol}
                target = self._closure(moved)
                if target not in self.states:
                    self.states.append(target)
                self.goto[state, symbol] = self.states.index(target)

    def _closure(self, items: set[tuple[int, int]]) -> frozenset[tuple[int, int]]:
        while True:
            ahead = {self.rules[rule][1][dot : dot + 1] for rule, dot in items}
            more = items | {(i, 0) for i, (left, _) in enumerate(self.rules) if left in ahead and left}
            if more == items:
                return frozenset(items)
            items = more

    def _first(self, symbol: str) -> set[str]:
        """Terminals that begin what ``symbol`` stands for; no rule used inside another is empty here."""
        if symbol not in self.names:
            return {symbol}
        return set().union(*(self._first(right[0]) for left, right in self.rules if left == symbol and right and right[0] != symbol))

    def _follow(self) -> dict[str, set[str]]:
        found = {name: set() for name in self.names}
        found[self.rules[0][1]] = {"$"}
        while True:
            before = sum(map(len, found.values()))
            for left, right in self.rules[1:]:
                for i, symbol in enumerate(right):
                    if symbol in self.names:
                        found[symbol] |= self._first(right[i + 1]) if i + 1 < len(right) else found[left]
            if sum(map(len, found.values())) == before:
                return found

    def shifted(self, stack: tuple, symbol: str) -> list[tuple]:
        """Stacks after all reductions that allow ``symbol`` next, and its shift; at the end (``$``) the accepting ones.

        A stack is (state, rest of the stack).
        """
        out, state = [], stack[0]
        if (state, symbol) in self.goto:
            out.append((self.goto[state, symbol], stack))
        for rule, dot in self.states[state]:
            left, right = self.rules[rule]
            if dot == len(right):
                if not rule:
                    out += [stack] if symbol == "$" else []
                elif symbol in self.follow[left]:
                    below = stack
                    for _ in right:
                        below = below[1]
                    out += self.shifted((self.goto[below[0], left], below), symbol)
        return out


class Repairer:
    """Parses turn by turn; a turn's kind is (role initial, must go, is truncated)."""

    def __init__(self, automaton: Automaton | None = None):
        self.automaton = automaton or Automaton()
        # A form has the stacks that are left, each with its cost above the cheapest one and the rank of its audit.
        self.start = (((0, ()), 0, 0),)
        self.steps: dict[tuple, tuple] = {}
        self.ends: dict[tuple, tuple] = {}

    def inserted(self, stack: tuple) -> list[tuple[tuple, str]]:
        """Stacks that insertions lead to, with the initials inserted; the fewest for each top."""
        found, new = {stack[0]: (stack, "")}, [(stack, "")]
        while new:
            new = [(after, said + initial) for before, said in new for initial in ROLES for after in self.automaton.shifted(before, initial)]
            new = [found.setdefault(after[0], (after, said)) for after, said in new if after[0] not in found]
        return list(found.values())

    def step(self, form: tuple, kind: tuple[str, bool, bool]) -> tuple[tuple, int, tuple]:
        """The form after a turn, what the cheapest stack costs more, and each stack's (place before, letters, initials)."""
        if (form, kind) not in self.steps:
            initial, must_go, truncated = kind
            best: dict[int, tuple] = {}
            for place, (stack, cost, rank) in enumerate(form):
                for before, said in self.inserted(stack):
                    edits = [("D", "", DELETE, [before])]
                    if not must_go:
                        price = TRUNCATED if truncated else 0
                        edits.append(("K", "", price, self.automaton.shifted(before, initial)))
                        edits += [("R", role, price + REROLE, self.automaton.shifted(before, role)) for role in ROLES]
                    for letter, role, price, stacks in edits:
                        for after in stacks:
                            letters = "I" * len(said) + letter
                            option = (cost + INSERT * len(said) + price, rank, letters, place, said + role, after)
                            if after[0] not in best or option[:3] < best[after[0]][:3]:
                                best[after[0]] = option
            options = sorted(best.values(), key=lambda option: option[1:3])
            ranks = {audit: i for i, audit in enumerate(sorted({option[1:3] for option in options}))}
            least = min(option[0] for option in options)
            after = tuple((option[5], option[0] - least, ranks[option[1:3]]) for option in options)
            self.steps[form, kind] = after, least, tuple((option[3], option[2], option[4]) for option in options)
        return self.steps[form, kind]

    def end(self, form: tuple) -> tuple[int, int, str]:
        """The cheapest way to end: what it costs more, the place of its stack, the initials inserted."""
        if form not in self.ends:
            options = [
                (cost + INSERT * len(said), rank, len(said), place, said)
                for place, (stack, cost, rank) in enumerate(form)
                for after, said in self.inserted(stack)
                if self.automaton.shifted(after, "$")
            ]
            cost, _, _, place, said = min(options)
            self.ends[form] = cost, place, said
        return self.ends[form]


class Conversation:
    """What is known of one conversation while its turns come in order."""

    def __init__(self, repairer: Repairer, conv_id: int | None):
        self.repairer, self.conv_id = repairer, conv_id
        self.form, self.cost, self.moves = repairer.start, 0, []
        self.turns: list[tuple] = []
        self.seen: set[tuple] = set()
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
        self.numbers = [None, None, 0]
        self.before: str | None = None

    def add(self, turn: int | None, role: str, digest: bytes, blank: bool, cut: bool) -> None:
        duplicate = (role, digest) in self.seen
        self.seen.add((role, digest))
        fault = "blank" if blank else "duplicate" if duplicate else "truncated" if cut else None
        if fault:
            self.faults[fault] += 1
        initial = role[:1]
        if self.before is not None and self.before + initial not in LEGAL:
            self.faults["illegal"] += 1
        self.before = initial
        if turn is not None and (self.numbers[1] is None or turn != self.numbers[1]):
            first, _, distinct = self.numbers
            self.numbers = [turn if first is None else first, turn, distinct + 1]
        self.form, more, moves = self.repairer.step(self.form, (initial if initial in ("s", "u", "a") else "", fault in ("blank", "duplicate"), fault == "truncated"))
        self.cost += more
        self.moves.append(moves)
        self.turns.append((turn, role, digest))

    def finished(self) -> Iterator[tuple]:
        """The report, then the turns of the repaired conversation."""
        more, place, said = self.repairer.end(self.form)
        edits = [("I" * len(said), said)]
        for moves in reversed(self.moves):
            place, letters, initials = moves[place]
            edits.append((letters, initials))
        edits.reverse()
        first, last, distinct = self.numbers
        gaps = 0 if first is None else last - first + 1 - distinct
        audit = "".join(letters for letters, _ in edits)
        yield (self.conv_id, True, gaps, *self.faults.values(), self.cost + more, audit, None, None, None, None, None)
        n = 0
        for i, (letters, initials) in enumerate(edits):
            roles = iter(initials)
            for letter in letters:
                turn, role, digest = self.turns[i] if letter in "KR" else (None, None, None)
                if letter != "D":
                    yield (self.conv_id, *[None] * 8, n, turn, role, digest, role if letter == "K" else ROLES[next(roles)])
                    n += 1


REPORT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
EDITS = pa.schema(
    [("conv_id", pa.int64()), ("report", pa.bool_()), *((name, pa.int64()) for name in REPORT), ("audit", pa.string()), ("place", pa.int64())]
    + [("turn", pa.int64()), ("role", pa.string()), ("digest", pa.binary()), ("new_role", pa.string())]
)
EDITS_SQL = f"conv_id long, report boolean, {', '.join(f'{name} long' for name in REPORT)}, audit string, place long, turn long, role string, digest binary, new_role string"


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    repairer, conv, out = Repairer(), None, []

    def written() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*out), EDITS.types)], schema=EDITS)
        out.clear()
        return batch

    for batch in batches:
        for conv_id, turn, role, digest, blank, cut, lost in zip(*(column.to_pylist() for column in batch.columns)):
            if conv is None or conv.conv_id != conv_id:
                for row in conv.finished() if conv else ():
                    out.append(row)
                    if len(out) >= ROWS_AT_A_TIME:
                        yield written()
                conv = Conversation(repairer, conv_id)
            if not lost:
                conv.add(turn, role, digest, blank, cut)
    for row in conv.finished() if conv else ():
        out.append(row)
        if len(out) >= ROWS_AT_A_TIME:
            yield written()
    if out:
        yield written()


def damaged(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text, copies)``: one row in four is damaged, by the CRC-32 of ``conv_id:turn``.

    Of twenty values, 0 loses the turn (no copies), 1 empties it, 2 takes its ``.``, ``!`` and ``?``, 3 repeats it, 4 makes it the user's.
    """
    blank = F.lit(" ")
    shown = lambda name: F.coalesce(F.col(name).cast("string"), blank)
    fate = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    text, role = F.coalesce("text", blank), F.coalesce("role", blank)
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.when(fate == 4, "user").otherwise(role).alias("role"),
        F.when(fate == 1, "").when(fate == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1).alias("copies"),
    )


def edits(turns: DataFrame) -> DataFrame:
    """The cheapest edits of conversations ``(conv_id, turn, role, text, copies)``: reports and the turns of the repaired ones.

    A row with ``report`` has faults, ``cost`` and ``audit`` of a conversation, also of one without turns. Any other row is a turn of the
    repaired conversation: its ``place``, its ``new_role``, and the turn, role and digest it had; an inserted one has no digest.
    """
    told = F.rtrim("text", F.lit(SPACES))
    known = turns.select(
        "conv_id",
        "turn",
        "role",
        F.unhex(F.md5("text")).alias("digest"),
        (told == "").alias("blank"),
        (~F.right(told, F.lit(1)).isin(".", "!", "?")).alias("cut"),
        (F.col("copies") == 0).alias("lost"),
        F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), "copies"))).alias("copy"),
    ).drop("copy")
    by_conversation = known.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "digest")
    return materialize(by_conversation.mapInArrow(_parsed, EDITS_SQL), "edits")


def repaired(turns: DataFrame, found: DataFrame) -> DataFrame:
    """``(conv_id, place, role, text)``: the turns of the repaired conversations, from the turns and their :func:`edits`."""
    places = found.where("report IS NULL").select("conv_id", "place", "turn", "role", "digest", "new_role")
    key = ["conv_id", "turn", "role", "digest"]
    # Equal turns under one number are one turn here: the others are duplicates and were deleted.
    texts = turns.where("copies > 0").select("conv_id", "turn", "role", F.unhex(F.md5("text")).alias("digest"), "text")
    texts = texts.groupBy(*key).agg(F.first("text").alias("text")).alias("t")
    kept = places.where("digest IS NOT NULL").alias("p")
    same = [F.col(f"p.{name}").eqNullSafe(F.col(f"t.{name}")) for name in key]
    joined = kept.join(texts, same).select("p.conv_id", "place", F.col("new_role").alias("role"), "text")
    inserted = places.where("digest IS NULL").select("conv_id", "place", F.col("new_role").alias("role"), F.lit("").alias("text"))
    return joined.unionByName(inserted)


def conversation_digests(turns: DataFrame) -> DataFrame:
    """``(conv_id, sha256)`` of ``role:text`` lines in order of ``place``, joined by line feeds; turns pass one by one."""
    lines = turns.select("conv_id", "place", F.concat("role", F.lit(":"), "text").alias("line"))
    return lines.repartition("conv_id").sortWithinPartitions("conv_id", "place").mapInArrow(_digested, "conv_id long, sha256 string")


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last, state, done = None, None, []

    def written() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array([c for c, _ in done], pa.int64()), pa.array([d for _, d in done])], names=["conv_id", "sha256"])
        done.clear()
        return batch

    for batch in batches:
        for conv_id, line in zip(batch.column("conv_id").to_pylist(), batch.column("line").to_pylist()):
            if state is not None and conv_id == last:
                state.update(b"\n" + line.encode())
                continue
            if state is not None:
                done.append((last, state.hexdigest()))
            last, state = conv_id, hashlib.sha256(line.encode())
        if done:
            yield written()
    if state is not None:
        done.append((last, state.hexdigest()))
        yield written()


def repair_report(turns: DataFrame) -> DataFrame:
    """``conv_id``, faults, ``cost``, ``audit`` and ``repaired_sha256`` of every conversation."""
    found = edits(turns)
    report = found.where("report").select("conv_id", *REPORT, "audit").alias("r")
    digests = conversation_digests(repaired(turns, found)).alias("d")
    joined = report.join(digests, F.col("r.conv_id").eqNullSafe(F.col("d.conv_id")), "left")
    return joined.select("r.*", F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
