"""Cheapest repair of conversations to the form ``(system? (user assistant)+)?``.

Every edit is an arc of a lattice whose nodes are (rows passed, state of the form). Shortest paths come from the auction
algorithm: nodes have integer prices, a path is extended along an arc that its end node's price allows, or contracted
after raising that price to what the best arc asks. Origins are taken from the last rows to the first and keep the
prices found before, so a path ends where it meets a settled node. The converged prices are the distances to the end;
an arc is tight if its cost equals the difference of its prices, and following the smallest letter among tight arcs
gives the smallest of all cheapest repairs.

Conversations of any length are cut into chunks of ``CHUNK`` rows. A chunk's own lattice gives its costs from state to
state; one pass over the chunks of a conversation, last to first, gives the prices behind each chunk; chunks are traced
from every state they can be entered in, and a pass in order picks the trace. Both passes hold four numbers at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pandas as pd
import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame, Window

from ..operators.staging import materialize
from .common import small_batches
from .ranking import ranked

# Rows of a conversation that are taken together.
CHUNK = 256
# Fixed values of the task: costs of edits, and what a truncated row adds unless it is deleted.
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)
# State after a row with the initial s, u or a.
AFTER = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
# The role that may be added in a state.
ADDED = {START: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
# Insertions that finish the form in a state.
FINISH = {START: "", SYSTEM: "IuIa", USER: "Ia", ASSISTANT: ""}
FINISH_COST = [INSERT * len(FINISH[s]) // 2 for s in range(4)]
# States from which a state can be reached.
SOURCES = {START: (START,), SYSTEM: (START, SYSTEM), USER: range(4), ASSISTANT: range(4)}
FAR = 1 << 60

# A row is one letter: its initial (other, s, u, a) and whether it is fine, truncated or has to go.
_INITIALS, _KINDS = ("", "s", "u", "a"), 3
_FIRST = "a"
SPACE = " \t\n\x0b\x0c\r"


def _arcs(code: int, state: int) -> list[tuple[str, int, int, int]]:
    """Edits of a row in a state by letter: edit and role, cost, rows passed, next state."""
    initial, kind = _INITIALS[code // _KINDS], code % _KINDS
    role = ADDED[state]
    forced = AFTER[state, role]
    arcs = [("D.", DELETE, 1, state), ("I" + role, INSERT, 0, forced)]
    if kind < 2:
        more = TRUNCATED * kind
        if (state, initial) in AFTER:
            arcs.append(("K.", more, 1, AFTER[state, initial]))
        arcs.append(("R" + role, REROLE + more, 1, forced))
    return arcs


ARCS = {chr(ord(_FIRST) + c): [_arcs(c, s) for s in range(4)] for c in range(len(_INITIALS) * _KINDS)}


class Auction:
    """Prices of the nodes of one chunk, towards exits with given prices. Node: 4 * rows passed + state."""

    def __init__(self, codes: str, exits: list[int], states=range(4)) -> None:
        self.size = 4 * len(codes)
        self.price = [0] * self.size + list(exits)
        self.settled = [False] * self.size + [True] * 4
        self.arcs = []
        for i, code in enumerate(codes):
            for state in range(4):
                self.arcs.append([(c, 4 * (i + passed) + s, edit) for edit, c, passed, s in ARCS[code][state] if s in states])
        for i in range(len(codes) - 1, -1, -1):
            for state in states:
                self._solve(4 * i + state)

    def _solve(self, origin: int) -> None:
        price, settled, path = self.price, self.settled, [origin]
        while not settled[path[-1]]:
            node = path[-1]
            value, best = FAR, -1
            for cost, following, _ in self.arcs[node]:
                if (asked := cost + price[following]) < value:
                    value, best = asked, following
            if value >= FAR:  # no way out of here
                price[node], settled[node] = FAR, True
                path.pop()
                if not path:
                    return
            elif price[node] < value:
                price[node] = value
                if len(path) > 1:
                    path.pop()
            else:
                path.append(best)
        for node in path:
            settled[node] = True

    def trace(self, state: int) -> tuple[str, int]:
        """Edits of the smallest cheapest path from a state before the first row, and the state it ends in."""
        node, edits = state, []
        while node < self.size:
            cost, node, edit = next(a for a in self.arcs[node] if a[0] + self.price[a[1]] == self.price[node])
            edits.append(edit)
        return "".join(edits), node - self.size


def crossing_costs(codes: str) -> list[int]:
    """Cheapest costs through the rows, from each state (by 4) to each state; ``FAR`` where there is no way."""
    costs = [FAR] * 16
    for target in range(4):
        exits = [0 if s == target else FAR for s in range(4)]
        prices = Auction(codes, exits, SOURCES[target]).price
        for state in SOURCES[target]:
            costs[4 * state + target] = min(FAR, prices[state])
    return costs


def _crossings(codes: pd.Series) -> pd.Series:
    return codes.map(lambda text: None if text is None else crossing_costs(text))


def _exits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Chunks of a conversation come last to first; each gets the prices behind it."""
    known, behind = object(), FINISH_COST
    for batch in batches:
        out = []
        for conv, costs in zip(batch["conv"], batch["costs"], strict=True):
            last = conv != known
            if last:
                known, behind = conv, FINISH_COST
            out.append((behind, last))
            if costs is not None:
                behind = [min(int(costs[4 * s + t]) + behind[t] for t in range(4)) for s in range(4)]
        yield batch[["conv", "chunk", "codes"]].assign(exits=[o[0] for o in out], last=[o[1] for o in out])


def _traces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The trace of every chunk from every state it can be entered in: edits, end and price."""
    for batch in batches:
        edits, ends, prices = [], [], []
        for chunk, codes, exits, last in zip(batch["chunk"], batch["codes"], batch["exits"], batch["last"], strict=True):
            auction = Auction(codes, [int(e) for e in exits])
            found = [auction.trace(s) for s in range(4 if chunk else 1)]
            edits.append([e + (FINISH[end] if last else "") for e, end in found])
            ends.append([end for _, end in found])
            prices.append(auction.price[START])
        yield batch[["conv", "chunk"]].assign(edits=edits, ends=ends, price=prices)


def _picked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Chunks of a conversation come in order; each is entered in the state that the one before ends in."""
    known, state = object(), START
    for batch in batches:
        edits = []
        for conv, theirs, ends in zip(batch["conv"], batch["edits"], batch["ends"], strict=True):
            if conv != known:
                known, state = conv, START
            edits.append(theirs[state])
            state = int(ends[state])
        yield batch[["conv", "chunk", "price"]].assign(edits=edits)


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of the lines of each conversation, chunk by chunk; only the running digest is held."""
    known, digest, some = None, None, False
    for batch in batches:
        done = []
        for conv, lines in zip(batch["conv"], batch["lines"], strict=True):
            if digest is None or conv != known:
                if digest is not None:
                    done.append((known, digest.hexdigest()))
                known, digest, some = conv, hashlib.sha256(), False
            if lines:
                digest.update(("\n" if some else "").encode() + lines.encode())
                some = True
        yield pd.DataFrame(done, columns=["conv", "digest"])
    if digest is not None:
        yield pd.DataFrame([(known, digest.hexdigest())], columns=["conv", "digest"])


def _same(*names: str) -> Column:
    """Null-safe equality of columns of the frames ``a`` and ``b``."""
    return reduce(Column.__and__, (F.col(f"a.{n}").eqNullSafe(F.col(f"b.{n}")) for n in names))


@dataclass
class Repair:
    """What ``repair`` gives; ``ids`` are all conversations asked for."""

    _rows: DataFrame
    _chunks: DataFrame
    _solved: DataFrame
    _ids: DataFrame
    _name: str
    _type: str

    def report(self) -> DataFrame:
        """One row per conversation: ``gaps, blank, duplicate, truncated, illegal, cost`` and ``audit``.

        Conversations without rows get zeros and an empty audit.
        """
        sums = ("blank", "duplicate", "truncated", "illegal", "turns")
        counted = self._chunks.groupBy("conv").agg(
            *(F.sum(c).alias(c) for c in sums), F.min("low").alias("low"), F.max("high").alias("high")
        )
        parts = F.array_sort(F.collect_list(F.struct("chunk", F.regexp_replace("edits", "(.).", "$1").alias("audit"))))
        cost = F.max(F.when(F.col("chunk") == 0, F.col("price")))
        solved = self._solved.groupBy("conv").agg(cost.alias("cost"), F.array_join(parts["audit"], "").alias("audit"))
        gaps = F.col("high") - F.col("low") + 1 - F.col("turns")
        met = self._ids.alias("a").join(counted.alias("b"), _same("conv"), "left").select(
            "a.conv", *sums, "low", "high").alias("a").join(solved.alias("b"), _same("conv"), "left")
        none = F.lit(0).cast("bigint")
        return met.select(
            F.col("a.conv").cast(self._type).alias(self._name), F.coalesce(gaps, none).cast("bigint").alias("gaps"),
            *(F.coalesce(c, none).alias(c) for c in sums[:-1]), F.coalesce("cost", none).alias("cost"),
            F.coalesce("audit", F.lit("")).alias("audit"),
        )

    def _edited(self) -> DataFrame:
        """Rows with the messages they leave: ``conv, rank, messages``."""
        # A row's edits end with what is done to the row itself; insertions at the very end stay with the last row.
        pattern = F.lit("(?:I.)*[DKR].(?:(?:I.)+$)?")
        spread = self._solved.select("conv", "chunk", F.posexplode(F.regexp_extract_all("edits", pattern, F.lit(0))))
        steps = spread.select("conv", (F.col("chunk") * CHUNK + F.col("pos")).alias("rank"), F.col("col").alias("edits"))

        def message(code: Column) -> Column:
            edit = F.substring(code, 1, 1)
            given = F.when(F.substring(code, 2, 1) == "u", F.lit("user")).otherwise(F.lit("assistant"))
            return F.struct(edit.alias("edit"), F.when(edit == "K", F.col("role")).otherwise(given).alias("role"),
                            F.when(edit == "I", F.lit("")).otherwise(F.col("text")).alias("text"))

        met = self._rows.alias("a").join(steps.alias("b"), _same("conv", "rank"))
        codes = F.filter(F.regexp_extract_all("edits", F.lit(".."), F.lit(0)), lambda c: c != "D.")
        return met.select("a.conv", "a.rank", F.transform(codes, message).alias("messages"))

    def messages(self) -> DataFrame:
        """The repaired conversations: ``place`` (ascending, with gaps), ``role, text`` and the ``edit`` (I, K or R)."""
        rows = self._edited().select("conv", "rank", F.posexplode("messages").alias("n", "m"))
        place = F.struct("rank", "n").alias("place")
        return rows.select(F.col("conv").cast(self._type).alias(self._name), place, "m.role", "m.text", "m.edit")

    def digests(self) -> DataFrame:
        """SHA-256 per conversation of its lines ``role:text``, joined by line ends (none: of the empty text)."""
        line = F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["text"]))
        lines = self._edited().select("conv", F.floor(F.col("rank") / CHUNK).alias("chunk"), "rank", line.alias("lines"))
        whole = F.flatten(F.array_sort(F.collect_list(F.struct("rank", "lines")))["lines"])
        texts = lines.groupBy("conv", "chunk").agg(F.array_join(whole, "\n").alias("lines"))
        ordered = texts.repartition("conv").sortWithinPartitions("conv", "chunk").select("conv", "lines")
        told = ordered.mapInPandas(_digests, "conv string, digest string")
        met = self._ids.alias("a").join(told.alias("b"), _same("conv"), "left")
        return met.select(F.col("a.conv").cast(self._type).alias(self._name),
                          F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("sha256"))


def repair(rows: DataFrame, ids: DataFrame | None = None, conv: str = "conv_id", turn: str = "turn",
           role: str = "role", text: str = "text") -> Repair:
    """Cheapest edits that give every conversation the role initials ``(s?(ua)+)?``.

    Rows stand in ascending ``turn``, NULL first; rows of one turn by a hash of role and text, so that copies are
    neighbours. The first fault of a row counts: blank (nothing but white space), duplicate (role and text occur
    earlier in the conversation), truncated (last character but white space is none of ``.!?``). Keeping a row costs 0,
    giving it another role 3, deleting it 4 (blank and duplicate rows must go), inserting an empty message 3; truncated
    rows that stay add 3. Of the cheapest repairs the one with the smallest edit letters (D, I, K, R) is taken.

    A NULL role or text counts as one space, a NULL conversation id as a conversation of its own. A row can be kept if
    the first character of its role is s, u or a and fits. ``ids`` may list conversations (first column) that are to be
    reported even without rows. An empty table gives no rows. Other columns are not read.
    """
    spark = rows.sparkSession
    small_batches(spark)
    kind = rows.schema[conv].dataType.simpleString()
    asked = rows.select(F.col(f"`{conv}`")) if ids is None else ids.select(F.col(f"`{ids.columns[0]}`"))
    given = rows.select(F.col(f"`{conv}`").cast("string").alias("conv"), F.col(f"`{turn}`").cast("bigint").alias("turn"),
                        F.coalesce(F.col(f"`{role}`"), F.lit(" ")).alias("role"),
                        F.coalesce(F.col(f"`{text}`"), F.lit(" ")).alias("text"))
    key = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    stored = ranked(materialize(given.withColumn("key", key), "messages"), "conv", ["turn", "key"])

    end = F.rtrim("text", F.lit(SPACE))
    slim = stored.select("conv", "rank", "turn", "key", F.substring("role", 1, 1).alias("initial"), (end == "").alias("blank"),
                         (~F.substring(end, -1, 1).isin(".", "!", "?")).alias("open"))
    # Counted per key before anything meets, so that a row repeated without end is one row here.
    first = slim.groupBy("conv", "key").agg(F.min("rank").alias("first"), F.count("*").alias("n")).filter("n > 1")
    known = slim.alias("a").join(first.alias("b"), _same("conv", "key"), "left").select("a.*", "b.first")
    blank, duplicate = F.col("blank"), F.coalesce(F.col("rank") > F.col("first"), F.lit(False))
    fault = F.when(blank, "blank").when(duplicate, "duplicate").when(F.col("open"), "truncated").otherwise("")
    # The first row of a chunk is also shown to the chunk before it, for what lies between the two.
    both = F.when((F.col("rank") > 0) & (F.col("rank") % CHUNK == 0), F.array(F.lit(False), F.lit(True))).otherwise(
        F.array(F.lit(False)))
    shown = known.select("conv", "rank", "turn", "initial", fault.alias("fault"), F.explode(both).alias("guest")).withColumn(
        "chunk", F.floor(F.col("rank") / CHUNK) - F.col("guest").cast("int"))
    order = Window.partitionBy("conv", "chunk").orderBy("rank")
    before = F.concat(F.lag("initial").over(order), "initial")
    has_before, turn_before = F.lag(F.lit(1)).over(order).isNotNull(), F.lag("turn").over(order)
    own = ~F.col("guest")
    letter = F.when(F.col("initial") == "s", 1).when(F.col("initial") == "u", 2).when(F.col("initial") == "a", 3).otherwise(0)
    state = F.when(F.col("fault") == "", 0).when(F.col("fault") == "truncated", 1).otherwise(2)
    code = F.char(letter * _KINDS + state + ord(_FIRST))
    marked = shown.select(
        "conv", "chunk", "rank", "turn", "fault", "guest", code.alias("code"),
        F.coalesce(~before.isin("su", "ua", "au"), F.lit(False)).alias("illegal"),
        (F.col("turn").isNotNull() & ((F.col("rank") == 0) | (has_before & ~turn_before.eqNullSafe(F.col("turn"))))).alias("new"),
    )
    counts = [F.count_if(own & (F.col("fault") == f)).alias(f) for f in ("blank", "duplicate", "truncated")]
    codes = F.array_join(F.array_sort(F.collect_list(F.when(own, F.struct("rank", "code"))))["code"], "")
    chunks = materialize(marked.groupBy("conv", "chunk").agg(
        *counts, F.count_if("illegal").alias("illegal"), F.count_if("new").alias("turns"),
        F.min(F.when(own, F.col("turn"))).alias("low"), F.max(F.when(own, F.col("turn"))).alias("high"), codes.alias("codes"),
    ), "chunks")

    crossings = F.pandas_udf(_crossings, "array<bigint>")(F.when(F.col("chunk") > 0, F.col("codes")))
    crossed = chunks.select("conv", "chunk", "codes", crossings.alias("costs"))
    backwards = crossed.repartition("conv").sortWithinPartitions("conv", F.desc("chunk"))
    priced = backwards.mapInPandas(_exits, "conv string, chunk bigint, codes string, exits array<bigint>, last boolean")
    # Tracing is the larger work, so it is spread by chunk again.
    traced = priced.repartition("conv", "chunk").mapInPandas(
        _traces, "conv string, chunk bigint, edits array<string>, ends array<int>, price bigint")
    forwards = traced.repartition("conv").sortWithinPartitions("conv", "chunk")
    solved = materialize(forwards.mapInPandas(_picked, "conv string, chunk bigint, price bigint, edits string"), "repairs")
    every = asked.toDF("id").select(F.col("id").cast("string").alias("conv")).distinct()
    return Repair(stored.select("conv", "rank", "role", "text"), chunks, solved, every, conv, kind)
