"""Conversation structure repair over a suffix-shared automaton.

A conversation is legal when the initials of its roles read ``(s?(ua)+)?``.
Rows may be kept (0), given the role user or assistant (2), deleted (3) or
new rows without text inserted (2 each); a truncated row that stays costs 1
more, a blank or repeated row must go.  Wanted are the cheapest edits, of
equally cheap ones those whose initials (D, I, K, R) come first in ASCII.

What a conversation needs depends on its *signature* only, a letter for
each row: its role's initial and its fault.  Signatures are minimised from
the end: two that end alike share the nodes of that end, whatever came
before, so a node is a distinct suffix.  In each of four grammar states
(nothing yet, after system, after user, after assistant) a node has a
cost-to-go and a first letter of its best audit suffix; both follow from
the node one row later, once for all conversations that pass through it.

On Spark: the distinct signatures are dealt out by ranges of the *reversed*
signature and sorted.  Signatures with a common end are then neighbours, so
a task meets the automaton's nodes depth first: it keeps the one path from
the end to where it is, drops what the next signature does not share and
computes only nodes that are new.  Its memory is the longest signature; no
node is held after its last use, and nodes above a cut between two tasks
are the only ones computed twice.  Copies of a conversation, however many,
are one signature.

A conversation's rows are brought to one task and sorted there by Spark,
which spills; they stream through and are never held.  Only the signature
(a byte a row) is.  The digest over a whole conversation is one SHA-256,
which cannot be put together from parts, so one task has to see the rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import small_batches, stored

# Fixed by the repair rules: costs of the edits, the role that a state asks
# for next, and the state after it.
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
START, SYSTEM, USER, ASSISTANT = range(4)
WANTED = ("user", "user", "assistant", "user")
AFTER = (USER, USER, ASSISTANT, USER)
ACCEPTS = (True, False, False, True)
LEGAL_PAIRS = ("su", "ua", "au")
NEVER = 1 << 60

BLANKS = " \t\n\x0b\x0c\r"
# A row's letter: its initial (o: any other), capital when truncated, a digit when it must go.
INITIALS = "suao"
MUST_GO = {"blank": "0123", "duplicate": "4567"}
EVERY_GONE = "".join(MUST_GO.values())


def damaged(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
            text: str = "text") -> DataFrame:
    """Rows with faults put in by crc32 of ``conv:turn`` modulo 20: 0 drops
    the row (``dropped`` is true), 1 empties its text, 2 takes out its
    ``.!?``, 3 repeats it, 4 makes it a user's.  Nulls count as one space."""
    def given(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(given(conv), F.lit(":"), given(turn)).cast("binary")) % 20
    rows = df.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), given(role).alias("role"),
                     given(text).alias("text"), kind.alias("kind"))
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"), (F.col("kind") == 0).alias("dropped"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias(
            "copy")).drop("copy")


def row_letter(role: Column, text: Column, seen: Column) -> Column:
    """The letter of a row, from its role, its text and whether both were seen before."""
    initial = F.substring(role, 1, 1)
    at = F.when(initial == "s", 1).when(initial == "u", 2).when(initial == "a", 3).otherwise(4)
    end = F.substring(F.rtrim(text, F.lit(BLANKS)), -1, 1)
    letters = (F.when(end == "", MUST_GO["blank"]).when(seen, MUST_GO["duplicate"])
               .when(end.isin(".", "!", "?"), INITIALS).otherwise(INITIALS.upper()))
    return F.substring(letters, at, F.lit(1))


def ordered_rows(df: DataFrame, conv: str, turn: str, role: str, text: str, dropped: str | None) -> DataFrame:
    """``conv_id, turn, role, text, dropped, pos, letter``: each conversation's
    rows numbered by turn (nulls first), then role and text.  One shuffle; both
    windows sort within its partitions and stream."""
    def filled(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    gone = F.lit(False) if dropped is None else F.coalesce(F.col(dropped), F.lit(False))
    rows = df.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), filled(role).alias("role"),
                     filled(text).alias("text"), gone.alias("dropped")).repartition("conv_id")
    same = Window.partitionBy("conv_id", "dropped", "role", "text").orderBy(F.asc_nulls_first("turn"))
    order = Window.partitionBy("conv_id").orderBy("dropped", F.asc_nulls_first("turn"), "role", "text")
    return (rows.withColumn("seen", F.row_number().over(same) > 1)
            .withColumn("pos", F.row_number().over(order).cast("long"))
            .withColumn("letter", row_letter(F.col("role"), F.col("text"), F.col("seen"))).drop("seen"))


def summaries(rows: DataFrame) -> DataFrame:
    """One row a conversation: ``conv_id, gaps, blank, duplicate, truncated,
    illegal`` and its ``signature``.  Only ids, turns and letters are moved."""
    import pyarrow as pa

    narrow = (rows.select("conv_id", "turn", "dropped", "pos", "letter").repartition("conv_id")
              .sortWithinPartitions("conv_id", "pos"))
    schema = StructType([rows.schema["conv_id"], *StructType.fromDDL(
        "gaps long, blank long, duplicate long, truncated long, illegal long, signature string").fields])

    def finish(turns: list, letters: str) -> tuple:
        known = [t for t in turns if t is not None]
        gaps = known[-1] - known[0] + 1 - len(set(known)) if known else 0
        blank = sum(map(letters.count, MUST_GO["blank"]))
        duplicate = sum(map(letters.count, MUST_GO["duplicate"]))
        truncated = sum(map(letters.count, INITIALS.upper()))
        initials = letters.translate(str.maketrans(INITIALS.upper() + EVERY_GONE, INITIALS * 3))
        legal = sum(initials[i:i + 2] in LEGAL_PAIRS for i in range(len(initials) - 1))
        return (gaps, blank, duplicate, truncated, max(len(letters) - 1, 0) - legal,
                letters.translate(str.maketrans(EVERY_GONE, "x" * len(EVERY_GONE))))

    def run(batches):
        open_id, started, turns, parts = None, False, [], []
        kind = None
        for b in batches:
            kind = b.column(0).type
            ids, ts, gone = (b.column(i).to_pylist() for i in (0, 1, 2))
            letters, out, at = b.column(4).to_pylist(), [], 0
            while at < len(ids):
                if started and ids[at] != open_id:
                    out.append((open_id, *finish(turns, "".join(parts))))
                    turns, parts = [], []
                open_id, started, end = ids[at], True, at
                while end < len(ids) and ids[end] == open_id:
                    end += 1
                here = [i for i in range(at, end) if not gone[i]]
                turns += [ts[i] for i in here]
                parts.append("".join([letters[i] for i in here]))
                at = end
            if out:
                yield batch_of(out, kind)
        if started:
            yield batch_of([(open_id, *finish(turns, "".join(parts)))], kind)

    def batch_of(found: list[tuple], kind):
        cols = list(zip(*found))
        return pa.RecordBatch.from_arrays(
            [pa.array(cols[0], kind), *[pa.array(c, pa.int64()) for c in cols[1:6]], pa.array(cols[6], pa.string())],
            names=schema.names)

    return narrow.mapInArrow(run, schema)


class SuffixPath:
    """The nodes from the end of a signature to its start, one for each
    suffix, of an automaton that is met in the order of reversed signatures."""

    def __init__(self):
        self.rules: dict[tuple, tuple] = {}
        letters, costs = self.settle([0 if ok else NEVER for ok in ACCEPTS], ["" for _ in ACCEPTS])
        self.reversed, self.letters, self.costs = "", [letters], [costs]
        self.made = 1  # nodes computed so far

    @staticmethod
    def settle(base: list[int], letter: list[str]) -> tuple[tuple, tuple]:
        """Let rows be inserted before the next one, in every state."""
        cost = list(base)
        for _ in cost:
            cost = [min(base[q], INSERT + cost[AFTER[q]]) for q in range(4)]
        first = []
        for q in range(4):
            ways = ([letter[q]] if base[q] == cost[q] else []) + (["I"] if INSERT + cost[AFTER[q]] == cost[q] else [])
            first.append(min(ways))
        return tuple(first), tuple(cost)

    def node(self, row: str, later: tuple) -> tuple[tuple, tuple]:
        """First letters and costs of the suffix that starts with ``row``."""
        low = min(later)
        key = (row, *(c - low for c in later))
        if key not in self.rules:  # the differences are few, whatever the length
            later = key[1:]
            extra = TRUNCATED if row.isupper() else 0
            initial, base, letter = row.lower(), [], []
            for q in range(4):
                ways = [(DELETE + later[q], "D")]
                if row != "x":
                    ways.append((REROLE + extra + later[AFTER[q]], "R"))
                    to = kept_state(q, initial)
                    if to is not None:
                        ways.append((extra + later[to], "K"))
                cost, way = min(ways)
                base.append(cost)
                letter.append(way)
            self.rules[key] = self.settle(base, letter)
        letters, costs = self.rules[key]
        return letters, tuple(c + low for c in costs)

    def repair(self, signature: str) -> tuple[int, str]:
        """Cost and audit of a signature; shares the path's nodes as far as the ends agree."""
        turned = signature[::-1]
        shared = 0
        for x, y in zip(turned, self.reversed):
            if x != y:
                break
            shared += 1
        del self.letters[shared + 1:], self.costs[shared + 1:]
        for row in turned[shared:]:
            letters, costs = self.node(row, self.costs[-1])
            self.letters.append(letters)
            self.costs.append(costs)
            self.made += 1
        self.reversed = turned
        state, audit, left = START, [], len(turned)
        while True:
            way = self.letters[left][state]
            if way == "":
                break
            audit.append(way)
            row = turned[left - 1] if left else ""
            state, left = edited_state(state, way, row.lower()), left - (way != "I")
        return self.costs[len(turned)][START], "".join(audit)


def kept_state(state: int, initial: str) -> int | None:
    """The state after a kept row, None where it may not stand."""
    if state == START and initial == "s":
        return SYSTEM
    return AFTER[state] if WANTED[state][0] == initial else None


def edited_state(state: int, way: str, initial: str) -> int:
    if way == "D":
        return state
    return kept_state(state, initial) if way == "K" else AFTER[state]


def audits(signatures: DataFrame) -> DataFrame:
    """``signature, cost, audit`` of every distinct signature."""
    import pyarrow as pa

    once = signatures.select("signature").distinct().withColumn("turned", F.reverse("signature"))
    dealt = once.repartitionByRange("turned").sortWithinPartitions("turned").select("signature")

    def run(batches):
        path = SuffixPath()
        for b in batches:
            found = [path.repair(s) for s in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([f[0] for f in found], pa.int64()),
                 pa.array([f[1] for f in found], pa.string())], names=["signature", "cost", "audit"])

    return small_batches(dealt).mapInArrow(run, "signature string, cost long, audit string")


class Edits:
    """The edits of an audit, applied to rows as they come."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START

    def inserted(self):
        while self.audit[self.at:self.at + 1] == "I":
            yield "I", WANTED[self.state], ""
            self.state = AFTER[self.state]
            self.at += 1

    def row(self, role: str, text: str):
        """What comes out before and for the next row: ``(edit, role, text)``."""
        yield from self.inserted()
        way = self.audit[self.at]
        self.at += 1
        if way != "D":
            yield way, (role if way == "K" else WANTED[self.state]), text
        self.state = edited_state(self.state, way, role[:1])


@dataclass
class Repair:
    """``conversations``: ``conv_id, gaps, blank, duplicate, truncated,
    illegal, signature, cost, audit``; ``ordered``: the rows as numbered."""

    ordered: DataFrame
    conversations: DataFrame

    def _streamed(self) -> DataFrame:
        """Each conversation's summary (``pos`` 0), then its rows in order."""
        numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
        heads = self.conversations.select("conv_id", F.lit(0).cast("long").alias("pos"),
                                          F.lit(None).cast("string").alias("role"),
                                          F.lit(None).cast("string").alias("text"), *numbers)
        rows = self.ordered.filter("NOT dropped").select(
            "conv_id", "pos", "role", "text",
            *[F.lit(None).cast(heads.schema[c].dataType).alias(c) for c in numbers])
        return small_batches(heads.unionByName(rows).repartition("conv_id").sortWithinPartitions("conv_id", "pos"))

    def rows(self) -> DataFrame:
        """The repaired rows: ``conv_id, pos`` (from 1), ``edit`` (K, R or I), ``role, text``."""
        import pyarrow as pa

        names = ["conv_id", "pos", "edit", "role", "text"]
        schema = StructType([self.conversations.schema["conv_id"], *StructType.fromDDL(
            "pos long, edit string, role string, text string").fields])

        def run(batches):
            edits, conv, n, kind = None, None, 0, None
            for b in batches:
                kind, out = b.column(0).type, []
                for c, pos, role, text, audit in zip(*(b.column(i).to_pylist() for i in (0, 1, 2, 3, 10))):
                    if pos == 0:
                        if edits is not None:
                            for made in edits.inserted():
                                n += 1
                                out.append((conv, n, *made))
                        edits, conv, n = Edits(audit), c, 0
                    else:
                        for made in edits.row(role, text):
                            n += 1
                            out.append((conv, n, *made))
                if out:
                    yield batch_of(out, kind)
            if edits is not None:
                out = [(conv, n + i + 1, *made) for i, made in enumerate(edits.inserted())]
                if out:
                    yield batch_of(out, kind)

        def batch_of(found, kind):
            types = [kind, pa.int64(), pa.string(), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), types)], names=names)

        return self._streamed().mapInArrow(run, schema)

    def digests(self) -> DataFrame:
        """One row a conversation: its numbers, cost, audit and the SHA-256 of
        its repaired ``role:text`` rows joined by newlines."""
        import pyarrow as pa

        numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
        schema = StructType([self.conversations.schema["conv_id"], *StructType.fromDDL(
            ", ".join(f"{c} long" for c in numbers) + ", audit string, repaired_sha256 string").fields])

        def run(batches):
            import hashlib

            def feed(made):
                nonlocal first
                for _, role, text in made:
                    sha.update(f"{'' if first else chr(10)}{role}:{text}".encode("utf-8", "replace"))
                    first = False

            def closed():
                feed(edits.inserted())
                return (*head, sha.hexdigest())

            head, sha, edits, first, kind = None, None, None, True, None
            for b in batches:
                kind, out = b.column(0).type, []
                cols = [c.to_pylist() for c in b.columns]
                for i, pos in enumerate(cols[1]):
                    if pos == 0:
                        if head is not None:
                            out.append(closed())
                        head = (cols[0][i], *(cols[c][i] for c in range(4, 11)))
                        sha, edits, first = hashlib.sha256(), Edits(cols[10][i]), True
                    else:
                        feed(edits.row(cols[2][i], cols[3][i]))
                if out:
                    yield batch_of(out, kind)
            if head is not None:
                yield batch_of([closed()], kind)

        def batch_of(found, kind):
            types = [kind, *[pa.int64()] * 6, pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), types)],
                                              names=schema.names)

        return self._streamed().mapInArrow(run, schema)


def repair_conversations(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                         text: str = "text", dropped: str | None = None) -> Repair:
    """The cheapest repair of every conversation of ``df``.

    Rows come by turn (nulls first), rows of one turn by role and text; a
    null role or text is one space.  Of a row's faults the first counts:
    blank, duplicate (role and text seen earlier), truncated (the last
    character but white space is not ``.!?``).  Rows without a conversation
    id are one conversation.  Rows flagged in ``dropped`` take no part, but
    their conversation is returned: without other rows its numbers are 0 and
    its audit is empty.  Other columns of ``df`` are not read.  An empty
    table gives no row.
    """
    rows = stored(ordered_rows(df, conv, turn, role, text, dropped), "turns")
    told = stored(summaries(rows), "signatures")
    found = stored(audits(told), "audits")
    return Repair(rows, told.join(found, "signature").select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "signature", "cost", "audit"))


def repair_digest(conversations: DataFrame) -> DataFrame:
    """The digest of :func:`repair_conversations` over :func:`damaged` rows."""
    return repair_conversations(damaged(conversations), dropped="dropped").digests()
