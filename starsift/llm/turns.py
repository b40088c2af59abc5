"""Conversation structure repair on a suffix-shared automaton of role and fault signatures.

1. A conversation's rows, in order, give one symbol each: its role initial and its fault. Equal signatures are one.
2. Read from the end, signatures share their common suffixes: each distinct suffix is one node. Reversed signatures are
   sorted over the cluster, so a walk in that order meets every node of the automaton once (again only where a range of
   the sort begins), with no more than the current path in memory.
3. A node holds, for each state of the grammar ``(s?(ua)+)?``, the cost of the cheapest way to repair what follows, and the
   first edit of the ASCII-least cheapest audit. Two cheapest audits of one node and state differ in their first edit, so
   that letter alone settles ties. Nodes whose costs differ by a constant behave alike; their step is worked out once.
4. Audits go back to the conversations, whose rows pass once more in order and are hashed as they are repaired.
"""

import hashlib
from array import array

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from starsift.llm.shared import stored

#: Costs of the edits; a truncated row that stays adds ``TRUNCATED``.
RELABEL, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Grammar states: nothing yet, after s, after u, after a. Only the first and last may end.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: The initial that an inserted or relabelled row takes in each state.
WANTED = "uuau"
NAMES = {"u": "user", "a": "assistant"}
#: Symbols: "-" must go; s, u, a and o (any other role) stay as they are; capitals are the same, truncated.
NO_COST = 1 << 40


def step(symbol: str, after: tuple[int, ...]) -> tuple[tuple[int, ...], str]:
    """Costs and first edits of a node from the costs of the node that follows its symbol."""
    role, extra = symbol.lower(), TRUNCATED * symbol.isupper()
    found = []
    for state in range(4):
        options = [(after[state] + DELETE, "D")]
        if symbol != "-":
            options.append((after[NEXT[state, WANTED[state]]] + RELABEL + extra, "R"))
            if (state, role) in NEXT:
                options.append((after[NEXT[state, role]] + extra, "K"))
        found.append(min(options))
    return inserted(found)


def inserted(found: list[tuple[int, str]]) -> tuple[tuple[int, ...], str]:
    """The same when rows may also be inserted before what follows; two rounds reach every state."""
    for _ in range(2):
        found = [min(own, (found[NEXT[state, WANTED[state]]][0] + INSERT, "I")) for state, own in enumerate(found)]
    return tuple(c for c, _ in found), "".join(e for _, e in found)


class Automaton:
    """Nodes on the path of the current reversed signature; kinds of nodes are kept, as they are few."""

    def __init__(self):
        end = inserted([(0 if state in (START, ASSISTANT) else NO_COST, " ") for state in range(4)])
        self.kinds, self.costs, self.edits, self.moves = {}, [], [], {}
        self.path, self.base = array("l", [self._kind(end[0], end[1])]), array("q", [0])
        self.word = ""

    def _kind(self, costs: tuple[int, ...], edits: str) -> int:
        key = (costs, edits)
        if key not in self.kinds:
            self.kinds[key] = len(self.costs)
            self.costs.append(costs)
            self.edits.append(edits)
        return self.kinds[key]

    def walk(self, word: str) -> tuple[int, str]:
        """Cost and audit of a signature given reversed; the path that it shares with the one before is kept."""
        keep, most = 0, min(len(word), len(self.word))
        if word[:most] == self.word[:most]:
            keep = most
        else:
            lo, hi = 0, most  # first difference, by bisection on prefixes
            while lo < hi:
                middle = (lo + hi) // 2
                lo, hi = (middle + 1, hi) if word[lo : middle + 1] == self.word[lo : middle + 1] else (lo, middle)
            keep = lo
        del self.path[keep + 1 :], self.base[keep + 1 :]
        for symbol in word[keep:]:
            kind = self.path[-1]
            if (kind, symbol) not in self.moves:
                costs, edits = step(symbol, self.costs[kind])
                least = min(costs)
                self.moves[kind, symbol] = (self._kind(tuple(c - least for c in costs), edits), least)
            to, least = self.moves[kind, symbol]
            self.path.append(to)
            self.base.append(self.base[-1] + least)
        self.word = word
        return self.base[-1] + self.costs[self.path[-1]][START], "".join(self._audit())

    def _audit(self):
        state, at = START, len(self.word)
        while True:
            edit = self.edits[self.path[at]][state]
            if edit == " ":
                return
            yield edit
            if edit == "D":
                at -= 1
            elif edit == "I":
                state = NEXT[state, WANTED[state]]
            else:
                at -= 1
                state = NEXT[state, self.word[at].lower() if edit == "K" else WANTED[state]]


def solved(signatures: DataFrame) -> DataFrame:
    """signature, cost, audit of every distinct signature."""
    ordered = signatures.select(F.reverse("signature").alias("word")).distinct().repartitionByRange("word").sortWithinPartitions("word")

    def run(batches):
        automaton = Automaton()
        for batch in batches:
            words = batch.column(0).to_pylist()
            found = [automaton.walk(w) for w in words]
            yield pa.RecordBatch.from_arrays([pa.array([w[::-1] for w in words]), pa.array([c for c, _ in found], pa.int64()), pa.array([a for _, a in found])], ["signature", "cost", "audit"])

    return ordered.mapInArrow(run, "signature string, cost long, audit string")


def damaged(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The rows after the stated damage; null roles and texts, and nulls within the hashed key, are one space."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col(id_col).cast("string"), blank), F.lit(":"), F.coalesce(F.col(turn_col).cast("string"), blank))
    df = rows.select(F.col(id_col), F.col(turn_col), F.coalesce(F.col(role_col), blank).alias(role_col), F.coalesce(F.col(text_col), blank).alias(text_col), (F.crc32(key) % 20).alias("hit_"))
    text = F.when(F.col("hit_") == 1, "").when(F.col("hit_") == 2, F.regexp_replace(text_col, "[.!?]", "")).otherwise(F.col(text_col))
    role = F.when(F.col("hit_") == 4, "user").otherwise(F.col(role_col))
    df = df.filter(F.col("hit_") != 0).withColumns({text_col: text, role_col: role})
    return df.withColumn("copy_", F.explode(F.when(F.col("hit_") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("hit_", "copy_")


def _marked(rows: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str, with_text: bool) -> DataFrame:
    """id_, turn_, role_, digest_ (of role and text), symbol_ without duplicates, and the text if wanted."""
    role, text = F.coalesce(F.col(role_col), F.lit(" ")), F.coalesce(F.col(text_col), F.lit(" "))
    initial = F.substring(role, 1, 1)
    last = F.regexp_extract(F.reverse(text), "[^\\x20\\x09-\\x0D]", 0)
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    symbol = F.when(last == "", "-").when(last.rlike("[.!?]"), known).otherwise(F.upper(known))
    return rows.select(
        F.col(id_col).alias("id_"), F.col(turn_col).alias("turn_"), role.alias("role_"), F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("digest_"),
        initial.alias("initial_"), symbol.alias("symbol_"), *([text.alias("text_")] if with_text else []),
    )


ORDER = ["turn_", "role_", "digest_"]


def signatures(rows: DataFrame) -> DataFrame:
    """id_, gaps, blank, duplicate, truncated, illegal, signature of every conversation among the marked rows.

    Rows of a conversation pass in order, a batch at a time; only its signature, a byte a row, is held.
    """
    once = Window.partitionBy("id_", "digest_").orderBy("turn_")
    held = rows.repartition("id_").withColumn("again_", F.row_number().over(once) > 1)
    held = held.select("id_", "turn_", "role_", "digest_", "initial_", "again_", F.when(F.col("symbol_") == "-", F.lit("b")).when(F.col("again_"), F.lit("d")).otherwise(F.col("symbol_")).alias("symbol_"))
    held = held.sortWithinPartitions("id_", *ORDER, "again_").select("id_", "turn_", "initial_", "symbol_")
    names = ["id_", "gaps", "blank", "duplicate", "truncated", "illegal", "signature"]

    def run(batches):
        now, state = None, None

        def closed(state):
            low, high, seen, counts, illegal, _, parts = state
            return (now[0], 0 if low is None else high - low + 1 - seen, *counts, illegal, "".join(parts))

        for batch in batches:
            out = []
            for key, turn, initial, symbol in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or now[0] != key:
                    if now is not None:
                        out.append(closed(state))
                    now, state = (key,), [None, None, 0, [0, 0, 0], 0, None, []]
                if turn is not None and turn != state[1]:
                    state[0] = turn if state[0] is None else state[0]
                    state[1], state[2] = turn, state[2] + 1
                if symbol in "bd":
                    state[3]["bd".index(symbol)] += 1
                elif symbol.isupper():
                    state[3][2] += 1
                if state[5] is not None and state[5] + initial not in ("su", "ua", "au"):
                    state[4] += 1
                state[5] = initial
                state[6].append("-" if symbol in "bd" else symbol)
            if out:
                yield _batch(out, names, types)
        if now is not None:
            yield _batch([closed(state)], names, types)

    kind = rows.schema["id_"].dataType
    types = [to_arrow_type(kind), *[pa.int64()] * 5, pa.string()]
    return held.mapInArrow(run, f"id_ {kind.simpleString()}, gaps long, blank long, duplicate long, truncated long, illegal long, signature string")


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), types)], names)


def repaired(rows: DataFrame, audits: DataFrame, keep: bool) -> DataFrame:
    """id_, repaired_sha256 and, with ``keep``, repaired (role and text of each row) of every conversation.

    A conversation's audit comes before its rows in one sorted stream, so neither is repeated for the other.
    """
    lead = audits.select("id_", F.lit(0).alias("kind_"), F.lit(None).cast(rows.schema["turn_"].dataType).alias("turn_"), F.col("audit").alias("role_"), F.lit("").alias("digest_"), F.lit("").alias("text_"))
    body = rows.select("id_", F.lit(1).alias("kind_"), "turn_", "role_", "digest_", "text_")
    stream = lead.unionByName(body).repartition("id_").sortWithinPartitions("id_", "kind_", *ORDER).select("id_", "kind_", "role_", "text_")
    names = ["id_", "repaired_sha256"] + ["repaired"] * keep
    kind = rows.schema["id_"].dataType
    types = [to_arrow_type(kind), pa.string()] + [pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))] * keep

    class Writer:
        """Applies an audit to rows as they come."""

        def __init__(self, key, audit):
            self.key, self.audit, self.at, self.state = key, audit, 0, START
            self.hash, self.first, self.lines = hashlib.sha256(), True, []
            self.insert()

        def put(self, role, text):
            self.hash.update(f"{'' if self.first else chr(10)}{role}:{text}".encode("utf-8", "surrogatepass"))
            self.first = False
            if keep:
                self.lines.append({"role": role, "text": text})

        def insert(self):
            while self.audit[self.at : self.at + 1] == "I":
                self.put(NAMES[WANTED[self.state]], "")
                self.state, self.at = NEXT[self.state, WANTED[self.state]], self.at + 1

        def row(self, role, text):
            edit = self.audit[self.at]
            self.at += 1
            if edit != "D":
                initial = role[:1] if edit == "K" else WANTED[self.state]
                self.put(role if edit == "K" else NAMES[initial], text)
                self.state = NEXT[self.state, initial]
            self.insert()

        def done(self):
            return (self.key, self.hash.hexdigest(), *([self.lines] if keep else []))

    def run(batches):
        now = None
        for batch in batches:
            out = []
            for key, what, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if what == 0:
                    out += [now.done()] if now else []
                    now = Writer(key, role)
                else:
                    now.row(role, text)
            if out:
                yield _batch(out, names, types)
        if now:
            yield _batch([now.done()], names, types)

    return stream.mapInArrow(run, f"id_ {kind.simpleString()}, repaired_sha256 string" + ", repaired array<struct<role:string,text:string>>" * keep)


def repair(rows: DataFrame, every: DataFrame | None = None, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", keep: bool = True) -> DataFrame:
    """id_col, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 and, with ``keep``, repaired.

    ``rows`` are turns; ``every`` (default: ``rows``) names the conversations to report, of which those without rows get
    zeros, an empty audit and the hash of nothing. Rows go by turn, nulls first; rows of one turn by role, then by the hash
    of role and text. Null roles and texts are one space (so such texts are blank); a null id is a conversation of its own.
    Repeated rows count as duplicates. Other columns are not read, and an empty table gives no rows.
    """
    columns = (id_col, turn_col, role_col, text_col)
    found = stored(signatures(_marked(rows, *columns, with_text=False)), "signatures")
    answers = stored(solved(found.select("signature")), "audits")
    known = stored(found.join(answers, "signature").drop("signature"), "repairs")
    hashes = repaired(_marked(rows, *columns, with_text=True), known.select("id_", "audit"), keep).withColumnRenamed("id_", "key_")
    ids = (rows if every is None else every).select(F.col(id_col).alias("conv_")).distinct()
    out = ids.join(known, F.col("conv_").eqNullSafe(F.col("id_")), "left").join(hashes, F.col("conv_").eqNullSafe(F.col("key_")), "left")
    nothing: Column = F.lit(hashlib.sha256(b"").hexdigest())
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return out.select(
        F.col("conv_").alias(id_col), *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers), F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"), *([F.coalesce("repaired", F.array().cast("array<struct<role:string,text:string>>")).alias("repaired")] if keep else []),
    )
