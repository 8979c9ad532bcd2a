"""Cheapest repair of conversations by a suffix-shared automaton.

Every row of a conversation is one letter: its role and fault (``signature``). What a repair can
still cost depends on the letters from a row to the end and on what the grammar
``(s?(ua)+)?`` has read, and on nothing else. So signatures are read from the end into an
acyclic automaton whose nodes are the distinct suffixes of all signatures: for each node and
grammar state the cost to go and the first edit of the best audit are worked out once, and all
conversations that end alike share them. The first edits of the options differ, so the least of
equally cheap audits is known from first letters alone, and an audit is read by walking from its
first node to the end.

* Signatures are made distinct before (a conversation that a third of all are copies of is one),
  dealt out in ranges of their reversed letters, and read in that order: neighbours share the
  longest suffix, so a task keeps the nodes of one signature only, 36 bytes a letter.
* Rows are grouped without their texts: (conversation, turn, role, SHA-256 of the text). They are
  ordered by a range partitioning over conversation and turn, so a conversation that holds a
  third of all rows spans many tasks; each makes one segment of letters, and segments meet as
  one string of a byte a row, as the audit is.
* The texts travel once, to the task that hashes the repaired conversation. It streams sorted
  rows and holds one batch. SHA-256 of a whole conversation is one chain, so this last step is
  one task for each conversation, by definition of the result.

Defined results: null roles and texts are one space (so a null text is blank), in the key of the
damage a null conv_id or turn is one space. Rows with one turn go by role and text digest; equal
rows lie side by side. Rows without conv_id are one conversation. A role counts by its first
letter; an empty role, or one that starts with any other letter, fits nowhere. ``gaps`` is null
where it exceeds 64 bits. Empty tables give no row. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histmill.llm.common import arrow_batches, drop_stage, ensure_columns, shuffle_partitions, stage

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: Letter of a row that has to go; other rows are the initial of their role, upper case if truncated.
GONE = "x"

# grammar states: nothing read, s read, u read, a read; all may end but the second and third
_FITS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_TURN = (2, 2, 3, 2)  # the state after the turn that is due, which is the assistant's after u
_ENDS = (0, 3)
_NEVER = 1 << 60


# --- damage ----------------------------------------------------------------------------------

def damage(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copies`` after the damage of the contract; 0 copies: dropped."""
    ensure_columns(rows, "conv_id", "turn", "role", "text")

    def spaced(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn"))) % 20
    return rows.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"),
                       kind.alias("kind")).select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text")).alias("text"),
        F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1).alias("copies"))


# --- signatures ------------------------------------------------------------------------------

def _first_turns(entries: DataFrame) -> DataFrame:
    """First turn of each role and text that a conversation has at several turns."""
    turn = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    return stage(entries.filter("copies > 0").groupBy("conv_id", "role", "digest")
                 .agg(F.count(F.lit(1)).alias("n"), F.min(turn).alias("first_turn"))
                 .filter("n > 1").drop("n"))


def signatures(rows: DataFrame) -> DataFrame:
    """Per conversation: ``letters`` and ``initials`` of its rows after damage, the number of
    rows of each first fault (blank, duplicate, truncated), and ``gaps`` in its turns."""
    text = F.col("text")
    bare = F.regexp_replace(text, r"[\x20\x09-\x0D]++", "")
    there = F.col("copies") > 0
    entries = stage(rows.select(
        "conv_id", "turn", "copies", F.when(there, F.col("role")).otherwise("").alias("role"),
        F.when(there, F.unhex(F.sha2(text, 256))).alias("digest"), (bare == "").alias("blank"),
        (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("truncated"))
        .groupBy("conv_id", "turn", "role", "digest")
        .agg(F.sum("copies").alias("copies"), F.first("blank").alias("blank"),
             F.first("truncated").alias("truncated")))
    again = _first_turns(entries).select(*[F.col(c).alias(f"_{c}") for c in ("conv_id", "role", "digest", "first_turn")])
    same = (F.col("conv_id").eqNullSafe(F.col("_conv_id")) & (F.col("role") == F.col("_role"))
            & (F.col("digest") == F.col("_digest")))
    initial = F.when(F.left("role", F.lit(1)).isin("s", "u", "a"), F.left("role", F.lit(1))).otherwise("o")
    entries_and_first = (entries.join(again, same, "left")
                         .withColumn("later", F.col("_first_turn").isNotNull()
                                     & ~F.col("_first_turn.turn").eqNullSafe(F.col("turn"))))
    letter = (F.when(F.col("blank") | F.col("later"), GONE)
              .when(F.col("truncated"), F.upper(initial)).otherwise(initial))
    more = F.greatest(F.col("copies") - 1, F.lit(0)).cast("int")
    some = F.col("copies") > 0
    lettered = entries_and_first.select(
        "conv_id", "turn", "role", "digest",
        F.when(some, F.concat(letter, F.repeat(F.lit(GONE), more))).otherwise("").alias("letters"),
        F.repeat(initial, F.col("copies").cast("int")).alias("initials"),
        F.when(F.col("blank"), F.col("copies")).otherwise(0).alias("n_blank"),
        F.when(F.col("blank") | ~some, 0).otherwise(more + F.col("later").cast("int")).alias("n_duplicate"),
        F.when(F.col("blank") | F.col("later") | ~F.col("truncated") | ~some, 0).otherwise(1).alias("n_truncated"),
        F.when(some, F.col("turn")).alias("turn_there"))
    n = shuffle_partitions(rows.sparkSession)
    ordered = stage(lettered.repartitionByRange(n, "conv_id", F.asc_nulls_first("turn"), "role", "digest")
                    .withColumn("part", F.spark_partition_id()))
    place = "(order by turn nulls first, role, digest)"
    segments = ordered.groupBy("conv_id", "part").agg(
        F.expr(f"listagg(letters, '') within group {place}").alias("letters"),
        F.expr(f"listagg(initials, '') within group {place}").alias("initials"),
        *[F.sum(c).alias(c) for c in ("n_blank", "n_duplicate", "n_truncated")])
    whole = segments.groupBy("conv_id").agg(
        F.expr("listagg(letters, '') within group (order by part)").alias("letters"),
        F.expr("listagg(initials, '') within group (order by part)").alias("initials"),
        *[F.sum(c).alias(c) for c in ("n_blank", "n_duplicate", "n_truncated")])
    turns = ordered.groupBy("conv_id").agg(
        F.min("turn_there").alias("low"), F.max("turn_there").alias("high"), F.count_distinct("turn_there").alias("k"))
    wide = [F.col(c).cast("decimal(20,0)") for c in ("high", "low", "k")]
    gaps = F.coalesce(wide[0] - wide[1] + 1 - wide[2], F.lit(0))
    turns = turns.select(F.col("conv_id").alias("_conv_id"), gaps.try_cast("long").alias("gaps"))
    out = stage(whole.join(turns, F.col("conv_id").eqNullSafe(F.col("_conv_id"))).drop("_conv_id"))
    drop_stage(entries)
    drop_stage(ordered)
    return out


# --- automaton -------------------------------------------------------------------------------

class SuffixAutomaton:
    """Nodes of the signature read last, from its end: cost to go and first edit per state.

    ``audit`` shares every node of the suffix that a signature has in common with the one before;
    signatures that come in order of their reversed letters therefore make each node once."""

    def __init__(self):
        self.reversed = ""
        self.cost = array("q")
        self.first = bytearray()
        self.made = 0
        base = [(0, "") if state in _ENDS else (_NEVER, "") for state in range(4)]
        self._push(base)

    def _push(self, options: list[tuple[int, str]]) -> None:
        """Add a node, given for each state the best option but insertion."""
        best = [cost for cost, _ in options]
        for _ in range(3):  # an insertion leads to another state of the same node
            best = [min(best[s], INSERT + best[_TURN[s]]) for s in range(4)]
        for state, (cost, edit) in enumerate(options):
            inserted = INSERT + best[_TURN[state]]
            if cost == best[state] and not (inserted == cost and "I" < edit):
                self.first.append(ord(edit) if edit else 0)
            else:
                self.first.append(ord("I"))
        self.cost.extend(best)
        self.made += 1

    def _letter(self, letter: str, node: int) -> None:
        below = self.cost[4 * node:4 * node + 4]
        late = TRUNCATED if letter.isupper() else KEEP
        role = letter.lower()
        options = []
        for state in range(4):
            # in the order of their letters, so that min takes the least of equal costs
            choices = [(DELETE + below[state], "D")]
            if letter != GONE:
                if (state, role) in _FITS:
                    choices.append((late + below[_FITS[state, role]], "K"))
                choices.append((REROLE + late + below[_TURN[state]], "R"))
            options.append(min(choices, key=lambda c: c[0]))
        self._push(options)

    def audit(self, letters_reversed: str) -> tuple[int, str]:
        """(cost, audit) of a signature, given from its end."""
        shared = 0
        for old, new in zip(self.reversed, letters_reversed):
            if old != new:
                break
            shared += 1
        del self.cost[4 * (shared + 1):]
        del self.first[4 * (shared + 1):]
        for node in range(shared, len(letters_reversed)):
            self._letter(letters_reversed[node], node)
        self.reversed = letters_reversed
        out, node, state = bytearray(), len(letters_reversed), 0
        while True:
            edit = self.first[4 * node + state]
            if not edit:
                break
            out.append(edit)
            if edit == ord("I"):
                state = _TURN[state]
                continue
            node -= 1
            if edit == ord("K"):
                state = _FITS[state, letters_reversed[node].lower()]
            elif edit == ord("R"):
                state = _TURN[state]
        return self.cost[4 * len(letters_reversed)], out.decode()


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    automaton = SuffixAutomaton()
    for batch in batches:
        found = [automaton.audit(x) for x in batch.column("reversed").to_pylist()]
        yield pa.RecordBatch.from_pydict({
            "letters": batch.column("letters").cast(pa.string()),
            "cost": pa.array([c for c, _ in found], pa.int64()), "audit": pa.array([a for _, a in found], pa.string())})


def audits(letters: DataFrame) -> DataFrame:
    """(letters, cost, audit) of every distinct signature."""
    n = shuffle_partitions(letters.sparkSession)
    distinct = letters.select("letters").distinct().withColumn("reversed", F.reverse("letters"))
    return (distinct.repartitionByRange(n, "reversed").sortWithinPartitions("reversed")
            .mapInArrow(_audits, "letters string, cost long, audit string"))


# --- repaired text ---------------------------------------------------------------------------

class _Conversation:
    """Repaired conversation, hashed row by row."""

    def __init__(self, conv_id, audit: str):
        self.conv_id, self.audit, self.at, self.state = conv_id, audit, 0, 0
        self.hash, self.written = hashlib.sha256(), False

    def _write(self, role: str, text: bytes) -> None:
        if self.written:
            self.hash.update(b"\n")
        self.hash.update(role.encode() + b":" + text)
        self.written = True

    def _due(self, text: bytes) -> None:
        self._write("assistant" if self.state == 2 else "user", text)
        self.state = _TURN[self.state]

    def insertions(self) -> None:
        while self.audit[self.at:self.at + 1] == "I":
            self._due(b"")
            self.at += 1

    def row(self, role: str, text: bytes) -> None:
        self.insertions()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self._write(role, text)
            self.state = _FITS[self.state, role[:1]]
        elif edit == "R":
            self._due(text)

    def digest(self) -> str:
        self.insertions()
        return self.hash.hexdigest()


def _hash_repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now = None

    def out(done: list[_Conversation]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"conv_id": pa.array([c.conv_id for c in done], kind),
                                           "repaired_sha256": pa.array([c.digest() for c in done], pa.string())})

    kind = None
    for batch in batches:
        kind = batch.schema.field("conv_id").type
        done = []
        for conv_id, audit, role, text, copies in zip(*[batch.column(c) for c in (
                "conv_id", "audit", "role", "text", "copies")], strict=True):
            if audit.is_valid:
                if now is not None:
                    done.append(now)
                now = _Conversation(conv_id.as_py(), audit.as_py())
                continue
            role, text = role.as_py(), text.as_py()
            for _ in range(copies.as_py()):
                now.row(role, text)
        if done:
            yield out(done)
    if now is not None:
        yield out([now])


def _repaired(rows: DataFrame, repairs: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): each conversation's audit goes ahead of its sorted rows."""
    kind = rows.schema["conv_id"].dataType
    ahead = repairs.select("conv_id", "audit", F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"),
                           F.lit(None).cast("string").alias("role"), F.lit(None).cast("binary").alias("text"),
                           F.lit(0).alias("copies"), F.lit(None).cast("binary").alias("digest"))
    body = rows.filter("copies > 0").select(
        "conv_id", F.lit(None).cast("string").alias("audit"), "turn", "role", F.col("text").cast("binary").alias("text"),
        "copies", F.unhex(F.sha2("text", 256)).alias("digest"))
    n = shuffle_partitions(rows.sparkSession)
    return (ahead.unionByName(body).repartition(n, "conv_id")
            .sortWithinPartitions("conv_id", F.col("audit").isNull(), F.asc_nulls_first("turn"), "role", "digest")
            .drop("turn", "digest")
            .mapInArrow(_hash_repaired, f"conv_id {kind.simpleString()}, repaired_sha256 string"))


def repair(conversations: DataFrame, damaged: bool = True) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256. ``damaged`` applies the damage of the contract first; without it the rows
    are judged as they are."""
    if damaged:
        rows = damage(conversations)
    else:
        ensure_columns(conversations, "conv_id", "turn", "role", "text")
        rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"),
                                    F.coalesce("text", F.lit(" ")).alias("text"), F.lit(1).alias("copies"))
    with arrow_batches(conversations.sparkSession):
        found = signatures(rows)
        # staged, so that the join of a signature that many conversations have is dealt anew
        best = stage(audits(found))
        repairs = stage(found.join(best, "letters"))
        hashes = stage(_repaired(rows, repairs)).withColumnRenamed("conv_id", "_conv_id")
    pairs = F.greatest(F.length("initials") - 1, F.lit(0))
    illegal = pairs - F.regexp_count("initials", F.lit("(?=su|ua|au)"))
    return (repairs.join(hashes, F.col("conv_id").eqNullSafe(F.col("_conv_id")))
            .select("conv_id", F.col("gaps").cast("long").alias("gaps"),
                    *[F.col(f"n_{c}").cast("long").alias(c) for c in ("blank", "duplicate", "truncated")],
                    illegal.cast("long").alias("illegal"), F.col("cost").cast("long").alias("cost"), "audit",
                    "repaired_sha256"))


ORACLE = r"""
with recursive keyed as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
         xor(list_reduce(list_prepend(4294967295::bigint, list_transform(
               string_split(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), ''),
               lambda ch: ascii(ch)::bigint)),
             lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
               lambda x, i: case when (x & 1) = 1 then xor(x >> 1, 3988292384) else x >> 1 end)),
             4294967295) % 20 as kind
  from conversations
), hurt as (
  select conv_id, turn, case when kind = 4 then 'user' else role end as role,
         case kind when 1 then '' when 2 then translate(text, '.!?', '') else text end as text,
         unnest(range(case kind when 3 then 2 else 1 end)) as copy
  from keyed where kind <> 0
), placed as (
  select *, row_number() over w as pos, regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g') as bare,
         row_number() over (partition by conv_id, role, text order by turn nulls first, copy) as nth
  from hurt window w as (partition by conv_id order by turn nulls first, role, sha256(text), copy)
), judged as (
  select conv_id, turn, role, text, pos, left(role, 1) as i,
         case when bare = '' then 'b' when nth > 1 then 'd' when right(bare, 1) not in ('.', '!', '?') then 't'
              else '' end as fault,
         lag(left(role, 1)) over (partition by conv_id order by pos) as before
  from placed
), conv as (
  select k.conv_id, coalesce(max(j.turn) - min(j.turn) + 1 - count(distinct j.turn), 0) as gaps,
         count(*) filter (fault = 'b') as blank, count(*) filter (fault = 'd') as duplicate,
         count(*) filter (fault = 't') as truncated,
         count(*) filter (before is not null and before || i not in ('su', 'ua', 'au')) as illegal,
         coalesce(max(pos), 0) as n
  from (select distinct conv_id from conversations) k left join judged j on j.conv_id is not distinct from k.conv_id
  group by k.conv_id
), go(conv_id, pos, f0, f1, f2, f3) as (
  select conv_id, n, {'c': 0, 'a': '', 't': cast([] as varchar[])},
         {'c': 4, 'a': 'II', 't': ['user:', 'assistant:']}, {'c': 2, 'a': 'I', 't': ['assistant:']},
         {'c': 0, 'a': '', 't': cast([] as varchar[])} from conv
  union all
  select conv_id, pos,
         list_min([b0, {'c': 2 + f2.c, 'a': 'I' || f2.a, 't': list_prepend('user:', f2.t)}]),
         list_min([b1, {'c': 2 + f2.c, 'a': 'I' || f2.a, 't': list_prepend('user:', f2.t)}]),
         f2, list_min([b3, {'c': 2 + b2.c, 'a': 'I' || b2.a, 't': list_prepend('user:', b2.t)}])
  from (
    select *, list_min([b2, {'c': 2 + b3.c, 'a': 'I' || b3.a, 't': list_prepend('assistant:', b3.t)}]) as f2
    from (
      select conv_id, pos,
        list_min([d0, case when stays and i = 's' then {'c': e + g1.c, 'a': 'K' || g1.a, 't': list_prepend(own, g1.t)} end,
                  case when stays and i = 'u' then {'c': e + g2.c, 'a': 'K' || g2.a, 't': list_prepend(own, g2.t)} end,
                  case when stays then {'c': e + 2 + g2.c, 'a': 'R' || g2.a, 't': list_prepend('user:' || text, g2.t)} end]) as b0,
        list_min([d1, case when stays and i = 'u' then {'c': e + g2.c, 'a': 'K' || g2.a, 't': list_prepend(own, g2.t)} end,
                  case when stays then {'c': e + 2 + g2.c, 'a': 'R' || g2.a, 't': list_prepend('user:' || text, g2.t)} end]) as b1,
        list_min([d2, case when stays and i = 'a' then {'c': e + g3.c, 'a': 'K' || g3.a, 't': list_prepend(own, g3.t)} end,
                  case when stays then {'c': e + 2 + g3.c, 'a': 'R' || g3.a, 't': list_prepend('assistant:' || text, g3.t)} end]) as b2,
        list_min([d3, case when stays and i = 'u' then {'c': e + g2.c, 'a': 'K' || g2.a, 't': list_prepend(own, g2.t)} end,
                  case when stays then {'c': e + 2 + g2.c, 'a': 'R' || g2.a, 't': list_prepend('user:' || text, g2.t)} end]) as b3
      from (
        select g.conv_id, g.pos - 1 as pos, j.i, j.text, j.role || ':' || j.text as own, j.fault in ('', 't') as stays,
               case when j.fault = 't' then 1 else 0 end as e, g.f1 as g1, g.f2 as g2, g.f3 as g3,
               {'c': 3 + g.f0.c, 'a': 'D' || g.f0.a, 't': g.f0.t} as d0,
               {'c': 3 + g.f1.c, 'a': 'D' || g.f1.a, 't': g.f1.t} as d1,
               {'c': 3 + g.f2.c, 'a': 'D' || g.f2.a, 't': g.f2.t} as d2,
               {'c': 3 + g.f3.c, 'a': 'D' || g.f3.a, 't': g.f3.t} as d3
        from go g join judged j on j.conv_id is not distinct from g.conv_id and j.pos = g.pos)))
)
select c.conv_id, gaps, blank, duplicate, truncated, illegal, f0.c::bigint as cost, f0.a as audit,
       sha256(array_to_string(f0.t, chr(10))) as repaired_sha256
from conv c join go g on g.conv_id is not distinct from c.conv_id and g.pos = 0
"""
