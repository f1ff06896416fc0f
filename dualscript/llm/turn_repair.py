"""Conversation structure repair: a Viterbi search whose survivors emit edits once they coalesce."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from dualscript.llm.common import WHITE, stored
from dualscript.operators.ranking import number_rows

BLOCK = 8_192  # rows searched in one go; longer conversations are cut into such blocks
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1  # costs

# What has been kept so far: nothing, a system turn, a user turn, a whole exchange.
# Nothing and a whole exchange are legal ends.
NOTHING, SYSTEM, USER, EXCHANGE = range(4)
ENDS = (NOTHING, EXCHANGE)
LEGAL = ("su", "ua", "au")  # neighbours
STEP = {(NOTHING, "s"): SYSTEM, (NOTHING, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): EXCHANGE, (EXCHANGE, "u"): USER}
INSERTED = {NOTHING: USER, SYSTEM: USER, USER: EXCHANGE, EXCHANGE: USER}
NEXT_ROLE = {NOTHING: "user", SYSTEM: "user", USER: "assistant", EXCHANGE: "user"}

# EMULATE[y][x]: what it costs at most to go on from y as a continuation from x does.
# From an exchange a kept system turn is deleted instead; an open turn is closed first.
EMULATE = (
    (0, 0, 2, 0),
    (4, 0, 2, 4),
    (5, 2, 0, 2),
    (3, 0, 2, 0),
)


# ---------------------------------------------------------------- survivors


@dataclass(slots=True, eq=False)
class Node:
    """One edit of the backpointer tree, kept while a survivor ends in it or edits follow it."""

    parent: Node | None
    edit: str
    depth: int
    ends: int = 0  # survivors that end here
    kids: list[Node] = field(default_factory=list)


class Survivors:
    """The cheapest edits into each state, of equal costs the ASCII-least.

    Edits live in a tree of backpointers.  A path that no survivor ends in is
    freed by its counts, and what all survivors share is emitted and cut off, so
    memory follows the edits still open.  Ties compare all the edits since the
    paths part, which the tree still holds.
    """

    def __init__(self, start: int):
        self.root = Node(None, "", 0, 1)
        self.at: dict[int, tuple[int, Node]] = {start: (0, self.root)}
        self.emitted: list[str] = []

    def _release(self, node: Node) -> None:
        """A survivor no longer ends here: free what only it has used."""
        node.ends -= 1
        while not node.ends and not node.kids and node.parent is not None:
            parent, node.parent = node.parent, None
            parent.kids.remove(node)
            node = parent

    @staticmethod
    def _less(a: Node, b: Node) -> bool:
        """Whether the edits to ``a`` are less than those to ``b``, from where they part."""
        left: list[str] = []
        right: list[str] = []
        while a is not b:
            if a.depth >= b.depth:
                left.append(a.edit)
                a = a.parent
            else:
                right.append(b.edit)
                b = b.parent
        return left[::-1] < right[::-1]

    def _offer(self, into: dict[int, tuple[int, Node]], state: int, cost: int, parent: Node, edit: str) -> bool:
        held = into.get(state)
        if held is not None and held[0] < cost:
            return False
        node = Node(parent, edit, parent.depth + 1, 1)
        parent.kids.append(node)
        if held is not None and held[0] == cost and not self._less(node, held[1]):
            self._release(node)
            return False
        into[state] = (cost, node)
        if held is not None:
            self._release(held[1])
        return True

    def insert(self) -> None:
        """Let every state insert a turn, as long as that helps."""
        open_ = list(self.at)
        while open_:
            state = open_.pop(0)
            cost, node = self.at[state]
            if self._offer(self.at, INSERTED[state], cost + INSERT, node, "I"):
                open_.append(INSERTED[state])

    def row(self, initial: str, must_go: bool, truncated: bool) -> None:
        """Keep, rerole or delete the next row, after turns inserted before it."""
        self.insert()
        new: dict[int, tuple[int, Node]] = {}
        for state, (cost, node) in self.at.items():
            self._offer(new, state, cost + DELETE, node, "D")
            if must_go:
                continue
            kept = STEP.get((state, initial))
            if kept is not None:
                self._offer(new, kept, cost + KEEP + TRUNCATED * truncated, node, "K")
            self._offer(new, INSERTED[state], cost + REROLE + TRUNCATED * truncated, node, "R")
        old, self.at = self.at, new
        for _, node in old.values():
            self._release(node)
        self._prune()
        self._emit()

    def _prune(self) -> None:
        """Drop survivors that another beats whatever follows, ties aside."""
        for x in list(self.at):
            if any(y != x and c + EMULATE[y][x] < self.at[x][0] for y, (c, _) in self.at.items()):
                self._release(self.at.pop(x)[1])

    def _emit(self) -> None:
        """Cut off the edits that all survivors share: those from the root on that nothing branches from."""
        root = self.root
        while len(root.kids) == 1 and not root.ends:
            root, = root.kids
            root.parent = None
            self.emitted.append(root.edit)
        self.root = root

    def edits(self, state: int) -> str:
        out, node = [], self.at[state][1]
        while node is not self.root:
            out.append(node.edit)
            node = node.parent
        return "".join(self.emitted) + "".join(out[::-1])


@dataclass
class Fragment:
    """A conversation's rows in one block, searched from each state it may begin in."""

    conversation: object
    begin: int
    whole: bool
    runs: dict[int, Survivors] = field(default_factory=dict)
    first: str | None = None
    last: str | None = None
    illegal: int = 0

    def __post_init__(self) -> None:
        self.runs = {s: Survivors(s) for s in ([NOTHING] if self.whole else range(4))}

    def row(self, initial: str, must_go: bool, truncated: bool) -> None:
        if self.last is None:
            self.first = initial
        elif self.last + initial not in LEGAL:
            self.illegal += 1
        self.last = initial
        for run in self.runs.values():
            run.row(initial, must_go, truncated)

    def finished(self, ended: bool) -> list[tuple]:
        """``start, end, cost, order, edits`` per way through; ``order`` ranks the edits from one start."""
        out = []
        for start, run in self.runs.items():
            if ended:
                run.insert()
            ways = sorted((run.edits(s), s, c) for s, (c, _) in run.at.items() if not ended or s in ENDS)
            if ended and self.whole:
                ways = [min(ways, key=lambda w: (w[2], w[0]))]
            out += [(self.conversation, self.begin, start, s, c, k, e, self.first, self.last, self.illegal)
                    for k, (e, s, c) in enumerate(ways)]
        return out


# ---------------------------------------------------------------- rows


def _arrow(schema: list[tuple[str, str]], key) -> pa.Schema:
    types = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "key": to_arrow_type(key)}
    return pa.schema([(name, types[kind]) for name, kind in schema])


def _ddl(schema: list[tuple[str, str]], key) -> str:
    return ", ".join(f"{name} {key.simpleString() if kind == 'key' else kind}" for name, kind in schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def placed(rows: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    """``_c, _t, _role, _text, _n``, stored: rows numbered by conversation and turn.

    Nulls in role and text are one space.  Rows of one turn follow their role,
    then a digest of their text; equal rows are interchangeable.
    """
    plain = rows.select(
        F.col(f"`{key}`").alias("_c"), F.col(f"`{turn}`").alias("_t"),
        *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" ")).alias(n) for c, n in ((role, "_role"), (text, "_text"))])
    tied = plain.withColumn("_tie", F.monotonically_increasing_id())  # splits a range of equal rows
    return number_rows(tied, [F.asc_nulls_first("_c"), F.asc_nulls_first("_t"), F.asc("_role"), F.asc(F.md5("_text")), F.asc("_tie")],
                       "_n").drop("_tie")


def faults(rows: DataFrame) -> DataFrame:
    """``_c, _t, _n, _initial, _fault`` of ``placed`` rows: the first of blank, duplicate, truncated, or null."""
    bare = F.rtrim("_text", F.lit(WHITE))
    own = F.when(bare == "", "blank").when(~F.substring(bare, -1, 1).isin(".", "!", "?"), "truncated")
    said = rows.select("_c", "_t", "_n", F.substring("_role", 1, 1).alias("_initial"),
                       F.md5(F.concat_ws("\n", F.md5("_role"), F.md5("_text"))).alias("_said"), own.alias("_own"))
    first = said.where("not _own <=> 'blank'").groupBy("_c", "_said").agg(F.min("_n").alias("_n")).select(
        "_n", F.lit(True).alias("_first"))
    again = F.col("_first").isNull() & ~F.col("_own").eqNullSafe("blank")
    return said.join(first, "_n", "left").select(
        "_c", "_t", "_n", "_initial", F.when(again, "duplicate").otherwise(F.col("_own")).alias("_fault"))


_WAYS = [("_c", "key"), ("_begin", "long"), ("_start", "int"), ("_end", "int"), ("_cost", "long"), ("_order", "int"),
         ("_edits", "string"), ("_head", "string"), ("_tail", "string"), ("_illegal", "long"), ("_whole", "boolean")]
_CHOSEN = [("_c", "key"), ("_begin", "long"), ("_start", "int"), ("_end", "int"), ("_more", "string"), ("_cost", "long"),
           ("_illegal", "long")]


def searched(marked: DataFrame) -> DataFrame:
    """The ways through each conversation's rows of each block.

    A block is ``BLOCK`` rows in order, however long the conversations are.
    Inside a block a conversation has one way; its first and last, which may
    reach into other blocks, have one per pair of states they can begin and end in.
    """
    key = marked.schema["_c"].dataType
    schema = _arrow(_WAYS, key)
    rows = marked.select(F.floor(F.col("_n") / BLOCK).alias("_block"), "_n", "_c", "_initial", "_fault")
    rows = rows.repartition(F.col("_block")).sortWithinPartitions("_block", "_n")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, part, ways = None, None, []
        for batch in batches:
            for b, n, c, initial, fault in zip(*[x.to_pylist() for x in batch.columns]):
                if block != b or part.conversation != c:
                    if part is not None:
                        ended = part.whole and block == b
                        ways += [(*w, ended) for w in part.finished(ended)]
                    part, block = Fragment(c, n, whole=block == b), b
                part.row(initial, fault in ("blank", "duplicate"), fault == "truncated")
            yield _batch(ways, schema)
            ways = []
        if part is not None:
            yield _batch([(*w, False) for w in part.finished(ended=False)], schema)

    return rows.mapInArrow(search, _ddl(_WAYS, key))


def _choose(ways: list[dict]) -> list[tuple]:
    """The way through each fragment of one conversation, cheapest and of these ASCII-least over all of them."""
    by: dict[int, list[dict]] = {}
    for w in ways:
        by.setdefault(w["_begin"], []).append(w)
    at: dict[int, tuple] = {NOTHING: (0, (), ())}
    illegal, tail = [], None
    for begin in sorted(by):
        new: dict[int, tuple] = {}
        for w in by[begin]:
            if w["_start"] in at:
                cost, orders, path = at[w["_start"]]
                way = (cost + w["_cost"], (*orders, w["_order"]), (*path, w))
                if w["_end"] not in new or way[:2] < new[w["_end"]][:2]:
                    new[w["_end"]] = way
        w = by[begin][0]
        illegal.append(w["_illegal"] + int(tail is not None and tail + w["_head"] not in LEGAL))
        tail, at = w["_tail"], new
    ends = []
    for state, (cost, orders, path) in at.items():
        more = ""  # turns inserted at the end
        while state not in ENDS:
            state, more = INSERTED[state], more + "I"
        ends.append((cost + INSERT * len(more), orders, more, path))
    *_, more, path = min(ends, key=lambda e: e[:3])
    last = len(path) - 1
    return [(w["_c"], w["_begin"], w["_start"], w["_end"], more if k == last else "", w["_cost"] + (INSERT * len(more) if k == last else 0), bad)
            for k, (w, bad) in enumerate(zip(path, illegal))]


def chosen(ways: DataFrame) -> DataFrame:
    """``_c, _begin, _edits, _cost, _illegal``: one way per fragment, so that whole conversations are cheapest.

    Only conversations that touch a block's edge have a choice left.  It is
    made on numbers, a few per block: costs add up, and of equal costs the
    first fragment that differs decides by its order.
    """
    key = ways.schema["_c"].dataType
    schema = _arrow(_CHOSEN, key)

    def choose(group: pa.Table) -> pa.Table:
        return pa.Table.from_batches([_batch(_choose(group.to_pylist()), schema)])

    open_ = ways.where("not _whole")
    picked = open_.drop("_edits").groupBy("_c").applyInArrow(choose, _ddl(_CHOSEN, key))
    edge = open_.select("_begin", "_start", "_end", "_edits").join(picked, ["_begin", "_start", "_end"]).select(
        "_c", "_begin", F.concat("_edits", "_more").alias("_edits"), "_cost", "_illegal")
    return ways.where("_whole").select("_c", "_begin", "_edits", "_cost", "_illegal").unionByName(edge)


# ---------------------------------------------------------------- repaired rows


class Writer:
    """Applies a conversation's edits to its rows as they come."""

    def __init__(self):
        self.state, self.edits, self.at = NOTHING, "", 0

    def go_on(self, edits: str) -> None:
        """``edits`` of the next fragment; those of the last one are used up."""
        self.edits, self.at = edits, 0

    def inserted(self) -> list[tuple[str, str, str]]:
        out = []
        while self.edits[self.at:self.at + 1] == "I":
            out.append(("I", NEXT_ROLE[self.state], ""))
            self.state, self.at = INSERTED[self.state], self.at + 1
        return out

    def row(self, role: str, text: str) -> list[tuple[str, str, str]]:
        """``edit, role, text`` of the turns inserted before a row, and of the row itself unless it goes."""
        out = self.inserted()
        edit = self.edits[self.at]
        self.at += 1
        if edit == "K":
            out.append(("K", role, text))
            self.state = STEP[self.state, role[:1]]
        elif edit == "R":
            out.append(("R", NEXT_ROLE[self.state], text))
            self.state = INSERTED[self.state]
        return out


def _script(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """Rows in order and, before each fragment's first row, its edits: ``_c, _kind, _role, _text``."""
    both = edits.select("_c", F.col("_begin").alias("_n"), F.lit(0).alias("_kind"), F.lit(None).cast("string").alias("_role"),
                        F.col("_edits").alias("_text")).unionByName(rows.select("_c", "_n", F.lit(1).alias("_kind"), "_role", "_text"))
    return both.repartition(F.col("_c")).sortWithinPartitions(F.asc_nulls_first("_c"), "_n", "_kind").drop("_n")


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, list[tuple[str, str, str]], bool]]:
    """Repaired lines as they come: the conversation, some of its lines, and whether these are its last."""
    writer, now, seen = Writer(), None, False
    for batch in batches:
        for c, kind, role, text in zip(*[x.to_pylist() for x in batch.columns]):
            if not seen or c != now:
                if seen:
                    yield now, writer.inserted(), True
                writer, now, seen = Writer(), c, True
            if kind == 0:
                yield now, writer.inserted(), False
                writer.go_on(text)
            else:
                yield now, writer.row(role, text), False
    if seen:
        yield now, writer.inserted(), True


_LINES = [("_c", "key"), ("_place", "long"), ("_edit", "string"), ("_role", "string"), ("_text", "string")]
_DIGESTS = [("_c", "key"), ("_sha256", "string")]


def repaired_rows(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """``_c, _place, _edit, _role, _text``: the repaired conversations, a row per turn that is there."""
    key = rows.schema["_c"].dataType
    schema = _arrow(_LINES, key)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, place = [], 0
        for c, lines, ended in _lines(batches):
            out += [(c, place + k, *line) for k, line in enumerate(lines)]
            place = 0 if ended else place + len(lines)
            if len(out) >= 1024:
                yield _batch(out, schema)
                out = []
        yield _batch(out, schema)

    return _script(rows, edits).mapInArrow(write, _ddl(_LINES, key))


def digests(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """``_c, _sha256`` of the repaired ``role:text`` lines, joined by line feeds.

    Such a digest is sequential by definition, so a conversation's rows pass
    through one task; they pass one by one and are never held.
    """
    key = rows.schema["_c"].dataType
    schema = _arrow(_DIGESTS, key)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, mark, between = [], hashlib.sha256(), ""
        for c, lines, ended in _lines(batches):
            for _, role, text in lines:
                mark.update(f"{between}{role}:{text}".encode())
                between = "\n"
            if ended:
                out.append((c, mark.hexdigest()))
                mark, between = hashlib.sha256(), ""
        yield _batch(out, schema)

    return _script(rows, edits).mapInArrow(digest, _ddl(_DIGESTS, key))


def repair(rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stored ``placed`` rows, their ``faults``, and the ``chosen`` edits of each conversation's fragments.

    A conversation is repaired to an optional system turn and user-assistant
    exchanges, or to nothing.  Keeping a row is free, rerole to user or
    assistant costs 2, deletion 3 (blank and duplicate rows must go), an
    inserted empty user or assistant turn 2, and a truncated row that stays 1
    more.  Of the cheapest edits the ASCII-least are taken, ``D`` before ``I``
    before ``K`` before ``R``.  A role counts by its first character; rows of
    other roles, null ones included (one space), are reroled or go.

    Rows with a null key are one conversation; null turns come first; rows of
    one turn follow their role and a digest of their text; of repeated rows all
    but the first are duplicates; an empty table has no conversations.  Other
    columns are ignored.  However long a conversation is, it is searched in
    blocks of bounded size.
    """
    found = placed(rows, key, turn, role, text)
    marked = stored(faults(found), "turn-faults")
    return found, marked, stored(chosen(stored(searched(marked), "turn-ways")), "turn-edits")


def report(rows: DataFrame, marked: DataFrame, edits: DataFrame) -> DataFrame:
    """Per conversation ``_c``: its gaps, faults, illegal neighbours, cost, edits and the digest of what it becomes."""
    turn = F.col("_t").cast("long")
    found = marked.groupBy("_c").agg(
        F.coalesce(F.max(turn) - F.min(turn) + 1 - F.count_distinct(turn), F.lit(0)).alias("gaps"),
        *[F.count_if(F.coalesce(F.col("_fault") == f, F.lit(False))).alias(f) for f in ("blank", "duplicate", "truncated")])
    fragments = F.array_sort(F.collect_list(F.struct("_begin", "_edits")))  # a fragment per block
    ways = edits.groupBy("_c").agg(F.sum("_illegal").alias("illegal"), F.sum("_cost").alias("cost"),
                                   F.array_join(F.transform(fragments, lambda x: x["_edits"]), "").alias("audit"))
    out = found.alias("f")
    for other in (ways.alias("w"), digests(rows, edits).alias("d")):
        name = "w" if other.columns[-1] == "audit" else "d"
        out = out.join(other, F.col("f._c").eqNullSafe(F.col(f"{name}._c")))
    return out.select("f._c", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "_sha256")
