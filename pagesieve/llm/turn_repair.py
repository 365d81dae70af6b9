"""Conversation repair: cheapest edits that make roles alternate, by one sorted stream.

Rows are dealt by conversation and sorted by turn; ``mapInPandas`` reads the stream
and carries a dynamic program from row to row and from Arrow batch to Arrow batch.
Its state has four places (nothing yet, after a system turn, after a user turn, after
an assistant turn). A place holds the least cost, the rank of its edits among those
of the others (for ties) and the running hash of the repaired text, so no text is
kept. Each row leaves one byte per place: which edit led there, from where. When a
conversation has left SPILL_ROWS of these, the edits they stand for are sent out as
rows of the result, so that a worker holds a bounded number whatever the length;
``_joined`` puts the parts of the few long conversations together again.

Whether a message was seen before is decided relationally: only digests that occur
twice are looked up, and what occurs later enters the stream as a thin marker row
before its turn. A worker needs no set of what it has seen.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import parallelism, stored

SPILL_ROWS = 65_536

# A message is blank without a character other than these; a text ends at one of ENDS.
BLANKS, ENDS = " \t\n\x0b\x0c\r", ".!?"
# Places of the program: the letters that may come next and where they lead.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
NAMES = {"u": "user", "a": "assistant"}
# Empty turns that complete what ends at a place.
CLOSING = {START: "", SYSTEM: "ua", USER: "a", ASSISTANT: ""}
LAWFUL = {"su", "ua", "au"}

EDITS, MARKER, TURN, DROPPED = range(4)  # kinds of rows in the stream


@dataclass(frozen=True)
class Costs:
    rerole: int = 3
    delete: int = 4
    insert: int = 3
    truncated: int = 3  # of a truncated message that stays


@dataclass(frozen=True)
class Step:
    """One way over a row: from a place, by edits (ASCII order decides ties), to a place."""

    source: int
    edits: str
    target: int
    cost: int
    inserted: str  # role put before the row, or ''
    role: str  # role the row gets; '' keeps its own


def ways(initial: str, must_go: bool, truncated: bool, costs: Costs) -> list[list[Step]]:
    """For each place, the ways to get there over one row.

    One insertion before a row is enough: two lead back to where they began, or on
    from the start to where none leads as well. An insertion before a deleted row is
    the same as one after it, which stands first in ASCII order.
    """
    out: list[list[Step]] = [[] for _ in NEXT]
    for source in NEXT:
        out[source].append(Step(source, "D", source, costs.delete, "", ""))
        if must_go:
            continue
        stays = costs.truncated if truncated else 0
        inserted = next((r for r in NEXT[source] if r in NAMES), "")
        for before, place, cost in (("", source, 0), (inserted, NEXT[source][inserted], costs.insert)):
            prefix = "I" if before else ""
            if initial in NEXT[place]:
                out[NEXT[place][initial]].append(Step(source, prefix + "K", NEXT[place][initial], cost + stays, before, ""))
            for role in NAMES:
                if role in NEXT[place]:
                    target = NEXT[place][role]
                    out[target].append(Step(source, prefix + "R", target, cost + costs.rerole + stays, before, role))
    return out


class Program:
    """The dynamic program over one conversation's rows; start() begins the next one."""

    def __init__(self, costs: Costs):
        self.costs = costs
        self.kinds: dict[tuple, list[list[Step]]] = {}
        self.steps: list[Step] = []
        self.number: dict[Step, int] = {}
        self.start()

    def start(self) -> None:
        # Of a place that is reached: (cost, rank, hash); start only, at first.
        self.now: list[tuple | None] = [(0, 0, hashlib.sha256()), None, None, None]
        self.left = bytearray()

    def _ways(self, kind: tuple) -> list[list[Step]]:
        if kind not in self.kinds:
            self.kinds[kind] = ways(*kind, self.costs)
            for step in (s for to in self.kinds[kind] for s in to):
                if step not in self.number:
                    self.number[step] = len(self.steps)
                    self.steps.append(step)
        return self.kinds[kind]

    def row(self, role: str, text: str, must_go: bool, truncated: bool) -> None:
        now, best = self.now, []
        for target, steps in enumerate(self._ways((role[:1], must_go, truncated))):
            # The edits up to two places never begin one another, so ranks decide first.
            open_ = [(now[s.source][0] + s.cost, now[s.source][1], s.edits, s) for s in steps if now[s.source]]
            if open_:
                cost, rank, edits, step = min(open_, key=lambda o: o[:3])
                best.append((target, cost, (rank, edits), step))
        order = sorted(key for _, _, key, _ in best)
        after: list[tuple | None] = [None] * 4
        codes = bytearray(4)
        body = None
        for target, cost, key, step in best:
            codes[target] = self.number[step]
            done = now[step.source][2]
            if step.edits != "D":
                body = body or (":" + text).encode("utf-8", "surrogatepass")
                own = NAMES[step.role] if step.role else role
                lead = "" if step.source == START else "\n"
                lead += f"{NAMES[step.inserted]}:\n" if step.inserted else ""
                done = done.copy()
                done.update((lead + own).encode("utf-8", "surrogatepass") + body)
            after[target] = (cost, order.index(key), done)
        self.now = after
        self.left += codes

    def traced(self) -> tuple[list[int], list[str]]:
        """Per place: where its edits began when the last part was sent out, and the edits since."""
        begun, texts = [], []
        for place in range(4):
            out = []
            if self.now[place]:
                for at in range(len(self.left) - 4, -1, -4):
                    step = self.steps[self.left[at + place]]
                    out.append(step.edits)
                    place = step.source
            begun.append(place)
            texts.append("".join(reversed(out)))
        self.left = bytearray()
        return begun, texts

    def finish(self) -> tuple[int, int, str, str]:
        """(place, cost, closing edits, hash) of the cheapest way to a lawful end."""
        ends = [
            (now[0] + self.costs.insert * len(CLOSING[place]), now[1], place) for place, now in enumerate(self.now) if now
        ]
        cost, _, place = min(ends)
        done = self.now[place][2].copy()
        done.update("".join(f"\n{NAMES[r]}:" for r in CLOSING[place]).encode())
        return place, cost, "I" * len(CLOSING[place]), done.hexdigest()


_COUNTS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
_SCHEMA = f"part int, begun array<int>, edits array<string>, {_COUNTS}, repaired_sha256 string"
_NAMES, _COUNT_NAMES = ([c.split()[0] for c in x.split(", ")] for x in (_SCHEMA, _COUNTS))


class _Conversation:
    """Counts of one conversation and its program."""

    def __init__(self, conv_id, program: Program):
        self.conv_id, self.program, self.part = conv_id, program, 0
        program.start()
        self.rows = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.turns, self.first, self.last = 0, None, None
        self.initial = self.marked = None
        self.before = None  # (turn, digest) of the row before

    def turn(self, turn, role: str, text: str, digest) -> None:
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.turns, self.last = self.turns + 1, turn
        if self.rows:
            self.illegal += self.initial + role[:1] not in LAWFUL
        self.initial = role[:1]
        self.rows += 1
        ends = text.rstrip(BLANKS)
        repeated = (turn, digest) in (self.before, self.marked)
        self.before = (turn, digest)
        blank, duplicate = not ends, bool(ends) and repeated
        truncated = bool(ends) and not repeated and ends[-1] not in ENDS
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += truncated
        self.program.row(role, text, blank or duplicate, truncated)

    def spilled(self) -> tuple:
        begun, edits = self.program.traced()
        self.part += 1
        return self.conv_id, self.part - 1, begun, edits, *[None] * 7

    def finished(self) -> tuple:
        begun, edits = self.program.traced()
        place, cost, closing, digest = self.program.finish()
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        counts = (gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost)
        return self.conv_id, self.part, [begun[place]], [edits[place] + closing], *counts, digest


def _rows(turns: DataFrame) -> DataFrame:
    """The rows of the stream: conv_id, turn, digest, what, role, text; dropped rows only name their conversation."""
    dropped = F.coalesce("dropped", F.lit(False)) if "dropped" in turns.columns else F.lit(False)
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    return turns.select(
        "conv_id", "turn", F.when(~dropped, digest).alias("digest"), F.when(dropped, DROPPED).otherwise(TURN).alias("what"),
        F.when(~dropped, role).alias("role"), F.when(~dropped, text).alias("text"),
    )


def _markers(rows: DataFrame) -> DataFrame:
    """A thin row per turn whose message occurs in an earlier turn of its conversation, too."""
    thin = rows.where(F.col("what") == TURN).groupBy("conv_id", "digest", "turn").agg(F.count(F.lit(1)).alias("n"))

    def place(turn: str) -> Column:
        """A null turn comes first: the pair sorts before all others."""
        return F.struct(F.col(turn).isNotNull().alias("named"), F.col(turn).alias("turn"))

    first = thin.groupBy("conv_id", "digest").agg(F.min(place("turn")).alias("first"), F.count(F.lit(1)).alias("places"))
    same = F.col("l.conv_id").eqNullSafe(F.col("r.conv_id")) & (F.col("l.digest") == F.col("r.digest"))
    later = thin.alias("l").join(first.where("places > 1").alias("r"), same).where(F.col("first") < place("l.turn"))
    none = F.lit(None).cast("string")
    return later.select("l.conv_id", "l.turn", "l.digest", F.lit(MARKER).alias("what"), none.alias("role"), none.alias("text"))


def _sorted(rows: DataFrame) -> DataFrame:
    """The stream; ids and turns go to Python as text, where a null doesn't cost the others their digits."""
    keys = [F.col("conv_id").asc_nulls_first(), (F.col("what") == EDITS).desc(), F.col("turn").asc_nulls_first(), "digest", "what"]
    dealt = rows.repartition(parallelism(rows.sparkSession), "conv_id").sortWithinPartitions(*keys)
    return dealt.select(F.col("conv_id").cast("string"), F.col("turn").cast("string"), "digest", "what", "role", "text")


def _read(batch: pd.DataFrame) -> Iterator[tuple]:
    return zip(*(batch[c].to_list() for c in ("conv_id", "turn", "digest", "what", "role", "text")), strict=True)


def _joined(parts: DataFrame) -> DataFrame:
    """One row per conversation: the parts' edits chosen from the last part backwards."""
    last = F.element_at("parts", -1)
    before = F.reverse(F.slice("parts", 1, F.size("parts") - 1))
    begin = F.struct(last["begun"][0].alias("place"), F.array(last["edits"][0]).alias("texts"))
    chosen = F.aggregate(
        before, begin,
        lambda acc, p: F.struct(
            F.get(p["begun"], acc["place"]).alias("place"), F.concat(F.array(F.get(p["edits"], acc["place"])), acc["texts"]).alias("texts")
        ),
    )
    counts = [F.max(c).alias(c) for c in [*_COUNT_NAMES, "repaired_sha256"]]
    sets = F.array_sort(F.collect_list(F.struct("part", "begun", "edits"))).alias("parts")
    return parts.groupBy("conv_id").agg(sets, *counts).withColumn("audit", F.array_join(chosen["texts"], "")).drop("parts")


def repair(turns: DataFrame, costs: Costs = Costs(), spill_rows: int = SPILL_ROWS) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256: a row per conversation.

    ``turns``: conv_id, turn, role, text and, if it is there, ``dropped`` (true: the row
    only names its conversation); other columns are ignored. Rows stand by turn, null
    turns first, equal turns by digest of role and text. Null texts and roles are one
    space. A null conv_id is a conversation of its own. An empty role can't be kept.
    Repeated rows are duplicates but for the first. No rows left: zeros and an empty
    audit. An empty table gives an empty result. Texts of any length are read whole.
    """
    rows = _rows(turns)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, held, program = None, [], Program(costs)

        def table() -> pd.DataFrame:
            out = pd.DataFrame(held, columns=["conv_id", *_NAMES])
            held.clear()
            return out.astype({c: "Int64" for c in ("part", *_COUNT_NAMES)})

        for batch in batches:
            for conv_id, turn, digest, what, role, text in _read(batch):
                if now is None or conv_id != now.conv_id:
                    if now is not None:
                        held.append(now.finished())
                    now = _Conversation(conv_id, program)
                turn = None if turn is None else int(turn)
                if what == TURN:
                    now.turn(turn, role, text, digest)
                    if len(program.left) >= 4 * spill_rows:
                        held.append(now.spilled())
                elif what == MARKER:
                    now.marked = (turn, digest)
            yield table()
        if now is not None:
            held.append(now.finished())
        yield table()

    stream = _sorted(rows.unionByName(_markers(rows)))
    parts = stored(stream.mapInPandas(run, f"conv_id string, {_SCHEMA}"), "repair")
    several = parts.where("part > 0").select("conv_id").distinct()
    same = F.col("l.conv_id").eqNullSafe(F.col("r.conv_id"))
    few = parts.alias("l").join(several.alias("r"), same, "left_anti")
    many = _joined(parts.alias("l").join(several.alias("r"), same, "left_semi"))
    whole = few.withColumn("audit", F.col("edits")[0])
    conv_id = F.col("conv_id").cast(turns.schema["conv_id"].dataType).alias("conv_id")
    columns = [conv_id, *_COUNT_NAMES, "audit", "repaired_sha256"]
    return whole.select(columns).unionByName(many.select(columns))


def repaired(turns: DataFrame, found: DataFrame) -> DataFrame:
    """The repaired rows: conv_id, place (from 0), edit (K, R or I), role, text; ``found``: what ``repair(turns)`` gave.

    The same stream once more, each conversation led by its edits.
    """
    none = F.lit(None)
    edits = found.select(
        "conv_id", none.cast(turns.schema["turn"].dataType).alias("turn"), none.cast("string").alias("digest"),
        F.lit(EDITS).alias("what"), none.cast("string").alias("role"), F.col("audit").alias("text"),
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, audit, at, state, place, held = None, "", 0, START, 0, []

        def put(edit: str, role: str, text: str) -> None:
            nonlocal state, place
            held.append((now, place, edit, role, text))
            state, place = NEXT[state][role[:1]], place + 1

        def expected() -> str:
            return NAMES[next(r for r in NEXT[state] if r in NAMES)]

        def insert() -> None:
            nonlocal at
            while audit[at : at + 1] == "I":
                put("I", expected(), "")
                at += 1

        for batch in batches:
            for conv_id, _, _, what, role, text in _read(batch):
                if what == EDITS:
                    insert()
                    now, audit, at, state, place = conv_id, text, 0, START, 0
                elif what == TURN:
                    insert()
                    if audit[at] != "D":
                        put(audit[at], role if audit[at] == "K" else expected(), text)
                    at += 1
            yield pd.DataFrame(held, columns=["conv_id", "place", "edit", "role", "text"])
            held.clear()
        insert()
        yield pd.DataFrame(held, columns=["conv_id", "place", "edit", "role", "text"])

    out = _sorted(_rows(turns).unionByName(edits)).mapInPandas(run, "conv_id string, place long, edit string, role string, text string")
    return out.withColumn("conv_id", F.col("conv_id").cast(turns.schema["conv_id"].dataType))


def damaged(turns: DataFrame, modulus: int = 20) -> DataFrame:
    """Rows with seeded faults, by crc32 of ``conv_id:turn`` (nulls: one space).

    0: dropped (the row stays as a name of its conversation), 1: text emptied, 2: without
    sentence ends, 3: twice, 4: role user. Null roles and texts become one space.
    """
    name = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    fault = F.crc32(name.cast("binary")) % modulus
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    rows = turns.select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(role).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate(text, ENDS, "")).otherwise(text).alias("text"),
        (fault == 0).alias("dropped"), F.when(fault == 3, 2).otherwise(1).alias("times"),
    )
    return rows.select("conv_id", "turn", "role", "text", "dropped", F.explode(F.array_repeat(F.lit(0), F.col("times"))).alias("copy")).drop("copy")
