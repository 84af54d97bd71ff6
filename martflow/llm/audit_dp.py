"""Repair of conversation structure by a persistent audit DP.

A conversation is read row by row.  For each state of the wanted role grammar
(nothing yet, after a system row, after a user row, after an assistant row) the
DP keeps the cheapest edits that lead there.  Edit texts are never copied: an
edit is a node that points to the node before it, so all prefixes are shared.
Every node has a jump pointer to a far ancestor (binary lifting in skewed form,
one pointer a node) and a rolling hash of its prefix.

Of equally cheap edits the ASCII-least text is kept.  Two prefixes are compared
by a search for their longest common prefix: where hashes of ancestors of equal
depth agree the search jumps, else it descends.  The prefixes found equal by
their hashes are verified letter by letter, down to the first node they share;
should they differ there, that place decides.

Each state also carries the digest of its repaired text so far, so a text is
read once and never kept.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3  # costs
BASE, MODULUS = 1_000_003, (1 << 61) - 1
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after a row with this role initial; user follows all but user.
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
WANTED = {START: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}
FINAL = (START, ASSISTANT)
LEGAL = {"su", "ua", "au"}
BLANKS = " \t\n\v\f\r"


# -------------------------------------------------------------- edit prefixes
class Edit:
    """An edit and, through ``back``, all edits before it."""

    __slots__ = ("back", "jump", "depth", "hash", "letter")

    def __init__(self, back: Edit | None, letter: str):
        self.back, self.letter = back, letter
        if back is None:
            self.jump, self.depth, self.hash = self, 0, 0
            return
        self.depth = back.depth + 1
        self.hash = (back.hash * BASE + ord(letter)) % MODULUS
        far = back.jump
        self.jump = far.jump if back.depth - far.depth == far.depth - far.jump.depth else back

    def text(self) -> str:
        out, node = [], self
        while node.back is not None:
            out.append(node.letter)
            node = node.back
        return "".join(reversed(out))


def ancestor(node: Edit, depth: int) -> Edit:
    while node.depth > depth:
        node = node.jump if node.jump.depth >= depth else node.back
    return node


def _verified(a: Edit, b: Edit) -> tuple[Edit, Edit] | None:
    """None if two prefixes of equal depth are equal, else the nodes of their first difference."""
    first = None
    while a is not b:
        if a.letter != b.letter:
            first = (a, b)
        a, b = a.back, b.back
    return first


def before(a: Edit, b: Edit) -> bool:
    """Whether the text of ``a`` is ASCII-less than that of ``b``."""
    depth = min(a.depth, b.depth)
    x, y = ancestor(a, depth), ancestor(b, depth)
    if x is y:
        return a.depth < b.depth
    if x.hash == y.hash:
        other = _verified(x, y)
        return a.depth < b.depth if other is None else other[0].letter < other[1].letter
    # down to the last depth at which the hashes agree
    while x.back.hash != y.back.hash:
        if x.jump.hash != y.jump.hash:
            x, y = x.jump, y.jump
        else:
            x, y = x.back, y.back
    other = _verified(x.back, y.back)
    x, y = other or (x, y)
    return x.letter < y.letter


# ------------------------------------------------------------------------ DP
class Path:
    """The cheapest way to a state: cost, edits, digest of the repaired rows."""

    __slots__ = ("cost", "edit", "digest", "rows")

    def __init__(self, cost: int, edit: Edit, digest, rows: bool):
        self.cost, self.edit, self.digest, self.rows = cost, edit, digest, rows

    def then(self, letter: str, cost: int, role: str | None = None, text: bytes = b"") -> Path:
        """This way and one more edit; ``role`` is None where no row comes out."""
        digest = self.digest
        if role is not None:
            digest = digest.copy()
            digest.update((b"\n" if self.rows else b"") + role.encode("utf-8") + b":" + text)
        return Path(self.cost + cost, Edit(self.edit, letter), digest, self.rows or role is not None)


class Repair:
    """The DP over one conversation's rows, taken one by one."""

    def __init__(self):
        self.paths: dict[int, Path] = {START: Path(0, Edit(None, ""), hashlib.sha256(), False)}
        self._insert(self.paths)

    @staticmethod
    def _offer(paths: dict[int, Path], state: int, path: Path) -> None:
        now = paths.get(state)
        if now is None or path.cost < now.cost or path.cost == now.cost and before(path.edit, now.edit):
            paths[state] = path

    def _insert(self, paths: dict[int, Path]) -> None:
        """Inserted rows: a state is three steps from itself at most, so going
        from START and SYSTEM on to USER, to ASSISTANT and to USER is enough."""
        for state in (START, SYSTEM, USER, ASSISTANT):
            if state in paths:
                role = WANTED[state]
                self._offer(paths, NEXT[state, role[0]], paths[state].then("I", INSERT, role))

    def row(self, role: str, text: bytes, delete: bool, truncated: bool) -> None:
        """One row; a blank or repeated one (``delete``) has to go."""
        new: dict[int, Path] = {}
        more = TRUNCATED if truncated else 0
        for state, path in self.paths.items():
            self._offer(new, state, path.then("D", DELETE))
            if delete:
                continue
            if (then := NEXT.get((state, role[:1]))) is not None:
                self._offer(new, then, path.then("K", KEEP + more, role, text))
            wanted = WANTED[state]
            self._offer(new, NEXT[state, wanted[0]], path.then("R", REROLE + more, wanted, text))
        self._insert(new)
        self.paths = new

    def best(self) -> Path:
        found: dict[int, Path] = {}
        for state in FINAL:
            if state in self.paths:
                self._offer(found, START, self.paths[state])
        return found[START]


class Conversation:
    """Counts, faults and the repair of one conversation, row by row in order.
    What is kept is a digest and some linked edits a row, never a text."""

    def __init__(self):
        self.repair, self.seen, self.last = Repair(), set(), None
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = self.turn = None

    def row(self, turn: int | None, role: str, text: str) -> None:
        data = text.encode("utf-8", "surrogatepass")
        end = text.rstrip(BLANKS)
        key = hashlib.blake2b(role.encode("utf-8", "surrogatepass") + b"\0" + hashlib.sha256(data).digest(),
                              digest_size=16).digest()
        blank = not end
        duplicate = not blank and key in self.seen
        truncated = not blank and not duplicate and end[-1] not in ".!?"
        self.seen.add(key)
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += truncated
        if self.last is not None:
            self.illegal += self.last + role[:1] not in LEGAL
        self.last = role[:1]
        if turn is not None:
            self.turns += turn != self.turn  # equal turns stand together
            self.low, self.high, self.turn = turn if self.low is None else self.low, turn, turn
        self.repair.row(role, data, blank or duplicate, truncated)

    def result(self) -> dict:
        best = self.repair.best()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return {"gaps": gaps, "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated,
                "illegal": self.illegal, "cost": best.cost, "audit": best.edit.text(),
                "repaired_sha256": best.digest.hexdigest()}


# --------------------------------------------------------------------- Spark
def damaged(turns: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text, copy)``: the rows damaged by
    ``crc32(conv_id:turn) % 20``; null roles and texts are one space, as are nulls
    in that key.  A dropped row stays as one without a role, so that its
    conversation is not lost."""
    space = F.lit(" ")
    conv, turn = F.col("conv_id").cast("long"), F.col("turn").cast("long")
    key = F.concat(F.coalesce(conv.cast("string"), space), F.lit(":"), F.coalesce(turn.cast("string"), space))
    role, text = (F.coalesce(F.col(c).cast("string"), space) for c in ("role", "text"))
    rows = turns.select(conv.alias("conv_id"), turn.alias("turn"), role.alias("r"), text.alias("t"),
                        (F.crc32(key.cast("binary")) % 20).alias("fault"))
    copies = F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(
        "conv_id", "turn",
        F.when(F.col("fault") == 4, "user").when(F.col("fault") != 0, F.col("r")).alias("role"),
        F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("t", "[.!?]", "")).otherwise(F.col("t"))
        .alias("text"),
        F.explode(copies).alias("copy"))


RESULT = pa.schema([("conv_id", pa.int64()), ("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()),
                    ("truncated", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()),
                    ("repaired_sha256", pa.string())])


def repaired(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows`` (``conv_id, turn, role, text``; a null
    role marks a row that is gone): its faults, the cheapest edits and the digest of
    the repaired text.

    Rows are taken by turn, nulls first; rows of equal turn by role, then text.  A
    conversation all of whose rows are gone has zeros, no edits and the digest of
    the empty text.  Rows without an id are one conversation.  A role whose first
    character is none of s, u and a (the empty role too) cannot be kept.  Texts of
    any length are read once, as they come, and not kept; a conversation is a
    stream through one task, for its edits and its digest depend on all rows
    before, and needs some hundred bytes a row.  Other columns are ignored; an
    empty table gives an empty result.
    """
    wanted = rows.select("conv_id", "turn", "role", "text")
    dealt = wanted.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, open_one, done = None, None, []
        for batch in batches:
            for conv, turn, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text"))):
                if open_one is None or conv != now:
                    if open_one is not None:
                        done.append({"conv_id": now} | open_one.result())
                    now, open_one = conv, Conversation()
                if role is not None:
                    open_one.row(turn, role, text)
                if len(done) >= 4096:
                    yield pa.RecordBatch.from_pylist(done, RESULT)
                    done = []
        if open_one is not None:
            done.append({"conv_id": now} | open_one.result())
            yield pa.RecordBatch.from_pylist(done, RESULT)

    return dealt.mapInArrow(kernel, "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, "
                                    "illegal bigint, cost bigint, audit string, repaired_sha256 string")
