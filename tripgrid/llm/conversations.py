"""Cheapest repair of damaged conversations, as a lightest derivation.

A repaired conversation has role initials ``(s?(ua)+)?``. Each row is kept (K, 0), given the role
user or assistant (R, 2) or deleted (D, 3; a must for blank and duplicate rows), and rows without
text are put in (I, 2); a truncated row that stays costs 1 more. Of equally cheap repairs the one
whose edits read first in ASCII order counts.

The edits are deductions of a weighted hypergraph. An item (i, p) says how rows i onward of a
stretch lead from state p of the pattern to its end; each edit derives an item from the one behind
it and puts its letter in front, and two stretches side by side make a longer one. Items are
popped by (cost, rows consumed, audit), which every edit raises: an edit costs something or
consumes a row. So the first pop of an item is its lightest derivation (Knuth), and an agenda ends
when its goals are popped. For one item the rows consumed are given, so (cost, audit) decides.
No audit of a stretch begins another one of equal cost, hence putting stretches together keeps the
order.

Rows are sorted over all tasks by conversation and turn, and a task cuts its rows into stretches of
at most ``STRETCH_ROWS`` rows or ``STRETCH_CHARS`` characters. A conversation inside one stretch is
repaired on the spot. One that crosses stretches, however long, gets the lightest derivation of
each stretch between any two states, and the stretches are put together from the last to the first
in a stream that holds no more than the audits that are still open. Its digest is taken in a stream
too, as a digest over a whole text has to be.

Defined cases: null role or text is one space; null turns come first and count as no turn; rows of
equal turn are in order of role, text and copy; null ids form one conversation; a conversation
without rows has zeros, no edits and the digest of nothing; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tripgrid.llm.common import stored

STRETCH_ROWS = 512
STRETCH_CHARS = 1_000_000
BLANKS = " \t\n\x0b\x0c\r"
#: states of the pattern: 0 nothing yet, 1 after system, 2 after user, 3 after assistant
STEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ENDS = (0, 3)
STATES = range(4)
NAMES = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")
COSTS = {"K": 0, "R": 2, "D": 3, "I": 2}


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows after a damage that their id and turn determine; dropped rows stay as rows that are not ``present``."""
    named = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat(named[0], F.lit(":"), named[1])) % 20
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), kind.alias("kind")
    )
    at = F.col("kind")
    text = F.when(at == 1, F.lit("")).when(at == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id", "turn", F.when(at == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(at != 0, text).alias("text"), (at != 0).alias("present"),
        F.explode(F.when(at == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )


@lru_cache(20_000)
def lightest(codes: str, ends: tuple[int, ...], goals: tuple[int, ...]) -> dict[int, tuple[int, str]]:
    """(cost, audit) for each goal state in front of the rows ``codes``, so that a state of ``ends`` is behind them.

    A code is the row's initial (x for any other), in capitals if truncated; b or d must go.
    """
    n, final, open_goals = len(codes), {}, set(goals)
    agenda = [(0, 0, "", n, p) for p in ends]
    heapq.heapify(agenda)
    while agenda and open_goals:
        cost, consumed, audit, i, p = heapq.heappop(agenda)
        if (i, p) in final:
            continue
        final[i, p] = cost, audit
        if i == 0:
            open_goals.discard(p)
        derived = [("I", i, before, COSTS["I"]) for (before, role), after in STEPS.items() if after == p and role != "s"]
        if i:
            code = codes[i - 1]
            derived.append(("D", i - 1, p, COSTS["D"]))
            if code not in "bd":
                initial, cut = code.lower(), code.isupper()
                for (before, role), after in STEPS.items():
                    if after == p and role == initial:
                        derived.append(("K", i - 1, before, COSTS["K"] + cut))
                    elif after == p and role != "s":
                        derived.append(("R", i - 1, before, COSTS["R"] + cut))
        for edit, j, before, more in derived:
            if (j, before) not in final:
                heapq.heappush(agenda, (cost + more, consumed + (edit != "I"), edit + audit, j, before))
    return {p: final[0, p] for p in goals if (0, p) in final}


def between(codes: str) -> dict[tuple[int, int], tuple[int, str]]:
    """Lightest derivations of a stretch from every state in front of it to every state behind it."""
    return {(p, q): found for q in STATES for p, found in lightest(codes, (q,), tuple(STATES)).items()}


def code(role: str, text: str) -> str:
    plain = text.strip(BLANKS)
    if not plain:
        return "b"
    initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
    return initial if plain[-1] in ".!?" else initial.upper()


def edited(roles: list[str], texts: list[str], audit: str, state: int) -> tuple[list[str], list[str], list[str]]:
    """Roles, texts and edits of the rows an audit leaves, beginning in ``state``."""
    out: tuple[list[str], list[str], list[str]] = ([], [], [])
    row = 0
    for edit in audit:
        if edit == "D":
            row += 1
            continue
        # outside of a kept system row, the state leaves one role only
        initial = roles[row][:1] if edit == "K" else "a" if state == 2 else "u"
        state = STEPS[state, initial]
        out[0].append(roles[row] if edit == "K" else NAMES[initial])
        out[1].append("" if edit == "I" else texts[row])
        out[2].append(edit)
        row += edit != "I"
    return out


def joined(roles: list[str], texts: list[str]) -> str:
    return "\n".join(f"{r}:{t}" for r, t in zip(roles, texts, strict=True))


class Stretch:
    """Rows of one conversation, as a task meets them."""

    def __init__(self, conv_id: object) -> None:
        self.conv_id = conv_id
        self.roles: list[str] = []
        self.texts: list[str] = []
        self.turns: list[int | None] = []
        self.chars = 0

    def add(self, turn: int | None, role: str, text: str) -> None:
        self.roles.append(role)
        self.texts.append(text)
        self.turns.append(turn)
        self.chars += len(role) + len(text)

    @property
    def full(self) -> bool:
        return len(self.roles) >= STRETCH_ROWS or self.chars >= STRETCH_CHARS

    def facts(self) -> dict:
        """What the rows say without their texts; codes do not know of earlier copies yet."""
        known = [t for t in self.turns if t is not None]
        initials = [r[:1] for r in self.roles]
        return {
            "codes": "".join(map(code, self.roles, self.texts)),
            "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False)),
            "first": initials[0] if initials else None, "last": initials[-1] if initials else None,
            "least": min(known, default=None), "most": max(known, default=None), "turns": len(set(known)),
        }

    def part(self, number: int) -> dict:
        """The stretch as it is, for a conversation that may go on elsewhere."""
        hashes = [
            hashlib.blake2b(repr((self.conv_id, r, t)).encode("utf-8", "surrogatepass"), digest_size=16).digest()
            for r, t in zip(self.roles, self.texts, strict=True)
        ]
        return {"conv_id": self.conv_id, "seg": number, "whole": False, **self.facts(), "hashes": hashes, "roles": self.roles, "texts": self.texts}

    def repaired(self, number: int) -> dict:
        """The repair, for a conversation that lies in this stretch."""
        facts, seen = self.facts(), set()
        codes = list(facts["codes"])
        for i, row in enumerate(zip(self.roles, self.texts, strict=True)):
            if row in seen and codes[i] != "b":
                codes[i] = "d"
            seen.add(row)
        facts["codes"] = "".join(codes)
        cost, audit = lightest(facts["codes"], ENDS, (0,))[0]
        roles, texts, edits = edited(self.roles, self.texts, audit, 0)
        digest = hashlib.sha256(joined(roles, texts).encode()).hexdigest()
        return {
            "conv_id": self.conv_id, "seg": number, "whole": True, **facts, "cost": cost, "audit": audit, "hashes": None,
            "roles": roles, "texts": texts, "edits": edits, "repaired_sha256": digest,
        }


FACTS = "codes string, illegal long, first string, last string, least long, most long, turns long"
STRETCHES = (
    f"conv_id {{kind}}, seg long, whole boolean, {FACTS}, cost long, audit string, hashes array<binary>, "
    "roles array<string>, texts array<string>, edits array<string>, repaired_sha256 string"
)
ROWS_OUT = 200


def _batches(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += sum(map(len, row.get("texts") or ()))
        if len(held) >= ROWS_OUT or chars > 4 * STRETCH_CHARS:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _mapped(df: DataFrame, run, schema: str) -> DataFrame:
    """``df`` through ``run``, from an iterator of rows to an iterator of rows."""
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(run(row for batch in batches for k in range(0, batch.num_rows, 500) for row in batch.slice(k, 500).to_pylist()), arrow)

    return df.mapInArrow(apply, schema)


def stretches(rows: DataFrame) -> DataFrame:
    """Written stretches of all conversations: repaired where ``whole``, else raw parts; ``seg`` ascends with the rows."""
    kind = dict(rows.dtypes)["conv_id"]
    dealt = rows.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 64))
    order = dealt.sortWithinPartitions("conv_id", "turn", "role", "text", "copy")

    def run(rows: Iterator[dict]) -> Iterator[dict]:
        number = TaskContext.get().partitionId() << 32
        held, whole = None, False
        for row in rows:
            if held is None or row["conv_id"] != held.conv_id:
                if held is not None:
                    yield held.repaired(number) if whole else held.part(number)
                    number += 1
                # the first conversation of a task may have begun in another one
                held, whole = Stretch(row["conv_id"]), held is not None
            elif held.full:
                yield held.part(number)
                number += 1
                held, whole = Stretch(row["conv_id"]), False
            if row["present"]:
                held.add(row["turn"], row["role"], row["text"])
        if held is not None:
            yield held.part(number)

    return stored(_mapped(order, run, STRETCHES.format(kind=kind)), "conv-stretches")


def _with_copies(parts: DataFrame) -> DataFrame:
    """Parts with the places of rows that repeat an earlier row of their conversation, in this part or before it."""
    rows = parts.select("seg", F.posexplode("hashes").alias("at", "hash"))
    firsts = rows.groupBy("hash").agg(F.min(F.struct("seg", "at")).alias("one"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    # a hot row is met once per first place, so adaptive execution can split it
    later = rows.join(firsts, "hash").filter("seg > one.seg or at > one.at").groupBy("seg").agg(F.collect_list("at").alias("copies"))
    return parts.join(later, "seg", "left")


class _Open(NamedTuple):
    """Audit of the stretches behind some state, as linked pieces."""

    piece: str
    rest: _Open | None
    path: tuple[int, int]


def _pieces(audit: _Open | None) -> Iterator[_Open]:
    while audit is not None:
        yield audit
        audit = audit.rest


def _before(a: _Open | None, b: _Open | None) -> bool:
    """Whether audit ``a`` reads before ``b``; looks no further than their first difference."""
    left = right = ""
    while a is not b or left != right:
        if not left and a is not None:
            left, a = a.piece, a.rest
        elif not right and b is not None:
            right, b = b.piece, b.rest
        else:
            n = min(len(left), len(right))
            if not n or left[:n] != right[:n]:
                return left[:n] < right[:n] if n else bool(right)
            left, right = left[n:], right[n:]
    return False


SOLVED = f"conv_id {{kind}}, seg long, state int, piece string, total boolean, {FACTS}, duplicates long, blanks long, cut long, cost long, audit string"


def _put_together(parts: DataFrame, kind: str) -> DataFrame:
    """For every part its piece of the cheapest audit and the state in front of it; one row more per conversation has the totals."""
    light = parts.select("conv_id", "seg", *[c.split()[0] for c in FACTS.split(", ")], "copies")
    order = light.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("seg"))

    def close(conv_id: object, sums: dict, best: dict[int, tuple[int, _Open | None]]) -> Iterator[dict]:
        cost, audit = best[0]
        pieces = list(_pieces(audit))
        for x in pieces:
            yield {"conv_id": conv_id, "seg": x.path[0], "state": x.path[1], "piece": x.piece, "total": False}
        yield {"conv_id": conv_id, "total": True, **sums, "cost": cost, "audit": "".join(x.piece for x in pieces)}

    def run(rows: Iterator[dict]) -> Iterator[dict]:
        held = None
        for row in rows:
            if held is None or row["conv_id"] != held[0]:
                if held is not None:
                    yield from close(*held)
                none = {"least": None, "most": None, "turns": 0, "illegal": 0, "first": None, "duplicates": 0, "blanks": 0, "cut": 0}
                held = (row["conv_id"], none, {p: (0, None) for p in ENDS})
            sums, best = held[1], held[2]
            codes = list(row["codes"])
            for i in row["copies"] or ():
                if codes[i] != "b":
                    codes[i] = "d"
            for name, n in (("blanks", codes.count("b")), ("duplicates", codes.count("d")), ("cut", sum(c.isupper() for c in codes))):
                sums[name] += n
            sums["illegal"] += row["illegal"]
            if row["last"] is not None:
                if sums["first"] is not None and row["last"] + sums["first"] not in LEGAL:
                    sums["illegal"] += 1
                sums["first"] = row["first"]
            if row["least"] is not None:
                sums["turns"] += row["turns"] - (row["most"] == sums["least"])
                sums["most"] = row["most"] if sums["most"] is None else sums["most"]
                sums["least"] = row["least"]
            longer: dict[int, tuple[int, _Open | None]] = {}
            for (p, q), (cost, piece) in between("".join(codes)).items():
                if q in best:
                    new = (cost + best[q][0], _Open(piece, best[q][1], (row["seg"], p)))
                    old = longer.get(p)
                    if old is None or new[0] < old[0] or (new[0] == old[0] and _before(new[1], old[1])):
                        longer[p] = new
            held = (row["conv_id"], sums, longer)
        if held is not None:
            yield from close(*held)

    return stored(_mapped(order, run, SOLVED.format(kind=kind)), "conv-solved")


class Repair(NamedTuple):
    """``summary``: one row per conversation; ``turns``: lists of repaired rows per stretch, in order of ``seg``."""

    summary: DataFrame
    turns: DataFrame


def _digests(turns: DataFrame, kind: str) -> DataFrame:
    order = turns.select("conv_id", "seg", "roles", "texts").repartition("conv_id").sortWithinPartitions("conv_id", "seg")

    def run(rows: Iterator[dict]) -> Iterator[dict]:
        conv_id = digest = None
        empty = True
        for row in rows:
            if digest is None or row["conv_id"] != conv_id:
                if digest is not None:
                    yield {"conv_id": conv_id, "repaired_sha256": digest.hexdigest()}
                conv_id, digest, empty = row["conv_id"], hashlib.sha256(), True
            if row["roles"]:
                digest.update(("" if empty else "\n").encode() + joined(row["roles"], row["texts"]).encode())
                empty = False
        if digest is not None:
            yield {"conv_id": conv_id, "repaired_sha256": digest.hexdigest()}

    return _mapped(order, run, f"conv_id {kind}, repaired_sha256 string")


def _count(codes: Column, pattern: str) -> Column:
    return F.regexp_count(codes, F.lit(pattern)).cast("long")


def repair(rows: DataFrame) -> Repair:
    """Repairs conversations of rows (conv_id, turn, role, text, present, copy), roles and texts not null.

    Rows that are not ``present`` only say that their conversation exists.
    """
    kind = dict(rows.dtypes)["conv_id"]
    cut = stretches(rows)
    whole, parts = cut.filter("whole"), cut.filter("not whole")
    gaps = F.coalesce(F.col("most") - F.col("least") + 1 - F.col("turns"), F.lit(0)).alias("gaps")
    codes = F.col("codes")
    names = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    at_once = whole.select(
        "conv_id", gaps, _count(codes, "b").alias("blank"), _count(codes, "d").alias("duplicate"), _count(codes, "[SUAX]").alias("truncated"),
        "illegal", "cost", "audit", "repaired_sha256",
    )
    solved = _put_together(_with_copies(parts), kind)
    pieces = solved.filter("not total").select("seg", "state", "piece")

    def apply(rows: Iterator[dict]) -> Iterator[dict]:
        for row in rows:
            roles, texts, edits = edited(row["roles"], row["texts"], row["piece"], row["state"])
            yield {"conv_id": row["conv_id"], "seg": row["seg"], "roles": roles, "texts": texts, "edits": edits}

    turns_of = "conv_id {kind}, seg long, roles array<string>, texts array<string>, edits array<string>".format(kind=kind)
    mended = stored(_mapped(parts.select("conv_id", "seg", "roles", "texts").join(pieces, "seg"), apply, turns_of), "conv-turns")
    digests = _digests(mended, kind).withColumnRenamed("conv_id", "conv")
    totals = solved.filter("total").join(digests, F.col("conv_id").eqNullSafe(F.col("conv")))
    later = totals.select(
        "conv_id", gaps, F.col("blanks").alias("blank"), F.col("duplicates").alias("duplicate"), F.col("cut").alias("truncated"),
        "illegal", "cost", "audit", "repaired_sha256",
    )
    columns = ("conv_id", "seg", "roles", "texts", "edits")
    return Repair(at_once.select(*names).unionByName(later), whole.select(*columns).unionByName(mended.select(*columns)))
