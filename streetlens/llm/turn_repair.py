"""Cheapest repair of conversations, by Hirschberg's divide and conquer.

A repaired conversation is an optional system turn and then pairs of user and
assistant turns. Four states follow it: 0 nothing yet, 1 behind the system
turn, 2 behind a user turn, 3 behind an assistant turn. A row costs something
from state to state; the edits of the cheapest way are its audit.

A segment of rows is known by its 4 x 4 costs and, for each state it is
entered in, the order of the least audits to the four states it is left in. No audit
is a prefix of another (each ends with the letter of its last row), so this
order and the edits behind it decide between any two audits, and nothing else
of the past is kept. Costs and orders of neighbouring segments combine to
those of both together.

Forward and backward vectors of costs meet in the middle of a segment; of the
crossings of least cost that with the least audit is taken, and both halves go
on alone. Rows are held in blocks of at most ``BLOCK``, blocks in blocks of
blocks, as often as the longest conversation needs: the crossings between the
parts of a block are found first, then those inside each part. So no task holds
more than a block, however long a conversation is.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streetlens.llm.ordered import changes, group_key, placed
from streetlens.llm.tables import stored, text_batches

BLOCK = 512
FAR = 1 << 40
DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5
INITIALS = "sua"  # of roles; any other counts as 3
WORDS = ["D", "ID", "IK", "IR", "K", "R"]  # edits of one row, in ASCII order
CLOSE = np.array([0, FAR, INSERT, 0])  # from the state behind the last row; state 2 gets an assistant turn

FREE, CUT, MUST = 0, 1, 2  # faults of a row: none, truncated, blank or duplicate


def _follow(state: int, initial: int) -> int | None:
    """The state behind a turn with this initial, if it may stand there."""
    return {(0, 0): 1, (0, 1): 2, (1, 1): 2, (3, 1): 2, (2, 2): 3}.get((state, initial))


def _row_tables() -> tuple[np.ndarray, np.ndarray]:
    """Costs and edits from state to state, by initial and fault (code = 3 * initial + fault)."""
    cost, word = np.full((12, 4, 4), FAR), np.zeros((12, 4, 4), np.int64)
    for code in range(12):
        initial, fault = divmod(code, 3)
        for start in range(4):
            wanted = 2 if start == 2 else 1  # the turn that may be put here
            ways = []
            for letters, paid, at in (("", 0, start), ("I", INSERT, _follow(start, wanted))):
                ways.append((paid + DELETE, letters + "D", at))
                if fault != MUST:
                    paid += TRUNCATED * (fault == CUT)
                    ways.append((paid, letters + "K", _follow(at, initial)))
                    ways.append((paid + REROLE, letters + "R", _follow(at, 2 if at == 2 else 1)))
            for paid, letters, end in sorted(ways, reverse=True, key=lambda w: w[:2]):
                if end is not None and paid <= cost[code, start, end]:
                    cost[code, start, end], word[code, start, end] = paid, WORDS.index(letters)
    return cost, word


ROW_COST, ROW_WORD = _row_tables()


def _ranks(keys: np.ndarray) -> np.ndarray:
    return (keys[..., None, :] < keys[..., :, None]).sum(-1)


def _step(cost, rank, step_cost, step_word):
    """Vectors (…, 4) behind one more part."""
    total = np.minimum(cost[..., :, None] + step_cost, FAR)
    tie = rank[..., :, None] * 8 + step_word
    by = np.argmin(total * 64 + tie, axis=-2)[..., None, :]
    total, tie = (np.take_along_axis(x, by, -2)[..., 0, :] for x in (total, tie))
    return total, _ranks(np.where(total < FAR, tie, 64))


def _forward(cost, word, base, size, entry):
    """(costs, orders) at the end of each segment entered in the given states; entry has shape (segments, k)."""
    vector = np.full((*entry.shape, 4), FAR)
    np.put_along_axis(vector, entry[..., None], 0, -1)
    rank = np.zeros_like(vector)
    by = np.argsort(-size, kind="stable")
    for k in range(int(size.max(initial=0))):
        live = by[: np.searchsorted(-size[by], -k, "left")]
        at = base[live] + k
        vector[live], rank[live] = _step(vector[live], rank[live], cost[at][:, None], word[at][:, None])
    return vector, rank


def _backward(cost, base, size, leave):
    """Costs from each state at the start of each segment to the given state at its end."""
    vector = np.full((len(base), 4), FAR)
    vector[np.arange(len(base)), leave] = 0
    by = np.argsort(-size, kind="stable")
    for k in range(int(size.max(initial=0))):
        live = by[: np.searchsorted(-size[by], -k, "left")]
        at = base[live] + size[live] - 1 - k
        vector[live] = np.minimum((cost[at] + vector[live][:, None, :]).min(-1), FAR)
    return vector


def transfers(cost, word, base, size):
    """(costs, orders), each (segments, 4, 4): of every segment, from each state to each state."""
    return _forward(cost, word, base, size, np.tile(np.arange(4), (len(base), 1)))


def crossings(cost, word, base, size, entry, leave):
    """(before, behind): the states around every part on the cheapest way with the least audit.

    ``cost`` and ``word`` have one (4, 4) per part; segments are runs of parts.
    """
    before, behind = np.zeros(len(cost), np.int64), np.zeros(len(cost), np.int64)
    while len(base):
        one = size == 1
        before[base[one]], behind[base[one]] = entry[one], leave[one]
        base, size, entry, leave = (x[size > 1] for x in (base, size, entry, leave))
        half = size // 2
        ahead, rank = _forward(cost, word, base, half, entry[:, None])
        back = _backward(cost, base + half, size - half, leave)
        meet = np.argmin((ahead[:, 0] + back) * 4 + rank[:, 0], axis=-1) if len(base) else leave
        base, size = np.concatenate([base, base + half]), np.concatenate([half, size - half])
        entry, leave = np.concatenate([entry, meet]), np.concatenate([meet, leave])
    return before, behind


def _parts(batch: pa.RecordBatch):
    """(costs, edits or orders, first part, number of parts, first and last initials, breaks) of the blocks of a batch."""
    parts = batch["parts"]
    base = parts.offsets.to_numpy().astype(np.int64)
    values = parts.values
    if pa.types.is_integer(values.type):
        codes = values.to_numpy()
        first = last = codes // 3
        return ROW_COST[codes], ROW_WORD[codes], base[:-1], np.diff(base), first, last, np.zeros(len(codes), np.int64)
    cost, rank = (values.field(k).flatten().to_numpy().reshape(-1, 4, 4) for k in ("cost", "rank"))
    return cost, rank, base[:-1], np.diff(base), *(values.field(k).to_numpy() for k in ("first", "last", "breaks"))


def _lift(batches):
    """Of every block what a block of blocks needs."""
    for batch in batches:
        if not batch.num_rows:
            continue
        cost, word, base, size, first, last, breaks = _parts(batch)
        total, rank = transfers(cost, word, base, size)
        # system before user, user before assistant and assistant before user are right
        pair = last[:-1] * 4 + first[1:]
        wrong = np.append(~np.isin(pair, (1, 6, 9)), False).astype(np.int64)
        wrong[base + size - 1] = 0
        sums = np.append(0, np.cumsum(breaks + wrong))
        flat = lambda x: pa.FixedSizeListArray.from_arrays(pa.array(x.reshape(-1).astype(np.int64)), 16).cast(pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [batch["g"], batch["node"], flat(total), flat(rank), pa.array(first[base].astype(np.int32)), pa.array(last[base + size - 1].astype(np.int32)),
             pa.array(sums[base + size] - sums[base])],
            names=["g", "node", "cost", "rank", "first", "last", "breaks"],
        )


LIFTED = "g string, node long, cost array<long>, rank array<long>, first int, last int, breaks long"


def _lower(batches):
    """Crossings between the parts of every block: the states before and behind each part."""
    for batch in batches:
        if batch.num_rows:
            cost, word, base, size = _parts(batch)[:4]
            before, behind = crossings(cost, word, base, size, batch["before"].to_numpy(), batch["behind"].to_numpy())
            offsets = pa.array(np.append(base, base[-1] + size[-1]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (before, behind)]
            yield pa.RecordBatch.from_arrays([batch["g"], batch["node"], *lists], names=["g", "node", "before", "behind"])


def _edits(batches):
    """Crossings between the rows of every block, and their edits."""
    for batch in batches:
        if batch.num_rows:
            cost, word, base, size = _parts(batch)[:4]
            before, behind = crossings(cost, word, base, size, batch["before"].to_numpy(), batch["behind"].to_numpy())
            letters = word[np.arange(len(word)), before, behind]
            offsets = pa.array(np.append(base, base[-1] + size[-1]).astype(np.int32))
            words = np.array(WORDS, dtype=object)[letters]
            audit = ["".join(words[b : b + n]) for b, n in zip(base.tolist(), size.tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch["g"], batch["node"], pa.ListArray.from_arrays(offsets, pa.array(before)),
                 pa.ListArray.from_arrays(offsets, pa.array(words, pa.string())), pa.array(audit, pa.string())],
                names=["g", "node", "before", "edits", "audit"],
            )


@dataclass
class Repair:
    """``rows``: the repaired turns. ``report``: one row per conversation."""

    rows: DataFrame
    report: DataFrame


def _faults(turns: DataFrame) -> DataFrame:
    """``turns`` without text, with fault: the first of blank, duplicate and truncated that a row has."""
    solid = r"[^\x20\x09-\x0D]"
    slim = turns.select(
        "g", "pos", "turn", F.substring("role", 1, 1).alias("initial"),
        (~F.col("text").rlike(solid)).alias("blank"), (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("open"),
        F.md5(F.concat(F.char_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))).alias("digest"),
    )
    slim = stored(slim, "turns")
    first = stored(
        slim.groupBy("g", "digest").agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "first"
    )
    fault = F.when(F.col("blank"), F.lit("blank")).when(F.col("pos") > F.col("first"), F.lit("duplicate")).when(F.col("open"), F.lit("truncated"))
    return slim.join(first, ["g", "digest"], "left").select("g", "pos", "turn", "initial", fault.alias("fault"))


def repair(conversations: DataFrame) -> Repair:
    """The cheapest repair of every conversation (conv_id, turn, role, text, any more).

    Rows stand by turn (nulls first), then role and text, and equal rows as
    they come; null roles and texts are one space. A row is blank (only white
    space, or empty), a duplicate (role and text stood earlier) or truncated
    (its last character but white space is none of . ! ?), the first that
    applies. Keeping a row costs 0, a new role 1, deleting it 2, which blank
    rows and duplicates need; an inserted empty turn costs 5, and so does a
    truncated row that stays. A null conv_id is a conversation of its own. An
    empty table gives empty results; columns beyond the four are not returned.

    ``rows``: conv_id, pos (of the original row), part (0 inserted before it, 1
    itself), edit, turn (of the original), role, text. ``report``: conv_id, n,
    gaps, blank, duplicate, truncated, illegal (neighbours whose initials are
    none of su, ua, au), cost, audit. Runs several jobs.
    """
    text_batches(conversations)
    spark = conversations.sparkSession
    one = F.lit(" ")
    source = conversations.select(
        group_key("conv_id").alias("g"), "conv_id", "turn",
        F.coalesce(F.col("role").cast("string"), one).alias("role"), F.coalesce(F.col("text").cast("string"), one).alias("text"),
    )
    turns = placed(source, "g", [F.col("turn").asc_nulls_first(), "role", "text"], "pos", "conversations")
    rows = stored(_faults(turns), "faults")
    kind = F.when(F.col("initial") == "", F.lit(3)).otherwise(F.coalesce(F.nullif(F.instr(F.lit(INITIALS), F.col("initial")), F.lit(0)) - 1, F.lit(3)))
    state = F.when(F.col("fault") == "truncated", CUT).when(F.col("fault").isNotNull(), MUST).otherwise(FREE)
    block = F.floor(F.col("pos") / BLOCK).cast("long")

    def packed(parts: DataFrame, at: str, *fields: str) -> DataFrame:
        """Blocks of parts in their order; a block has at most ``BLOCK``."""
        entry = F.struct(at, *fields)
        list_ = F.array_sort(F.collect_list(entry))
        keep = (lambda x: x[fields[0]]) if len(fields) == 1 else (lambda x: F.struct(*(x[f].alias(f) for f in fields)))
        return parts.groupBy("g", F.floor(F.col(at) / BLOCK).cast("long").alias("node")).agg(F.transform(list_, keep).alias("parts"))

    codes = rows.select("g", "pos", (kind * 3 + state).cast("int").alias("code"))
    levels = [stored(packed(codes, "pos", "code"), "blocks")]
    while True:
        lifted = stored(levels[-1].mapInArrow(_lift, LIFTED), "lifted")
        if not (lifted.agg(F.max("node")).first()[0] or 0):
            break
        levels.append(stored(packed(lifted, "node", "cost", "rank", "first", "last", "breaks"), "blocks"))
    # entered in state 0; left in the state of least cost and audit
    ends = F.array(*(
        F.struct((F.col("cost")[s] + int(CLOSE[s])).alias("cost"), F.col("rank")[s].alias("rank"), F.lit(s).cast("long").alias("behind"))
        for s in (0, 2, 3)
    ))
    whole = lifted.select("g", "node", "breaks", F.array_min(ends).alias("end")).select(
        "g", "node", F.lit(0).cast("long").alias("before"), "end.behind", "end.cost", "breaks"
    )
    whole = stored(whole, "whole")
    states = whole.select("g", "node", "before", "behind")
    for level in reversed(levels[1:]):
        inner = level.join(states, ["g", "node"]).mapInArrow(_lower, "g string, node long, before array<long>, behind array<long>")
        states = stored(
            inner.select("g", (F.col("node") * BLOCK).alias("start"), F.posexplode(F.arrays_zip("before", "behind")).alias("k", "s")).select(
                "g", (F.col("start") + F.col("k")).alias("node"), "s.before", "s.behind"
            ),
            "states",
        )
    edits = stored(
        levels[0].join(states, ["g", "node"]).mapInArrow(
            _edits, "g string, node long, before array<long>, edits array<string>, audit string"
        ),
        "edits",
    )
    audits = edits.groupBy("g").agg(F.array_sort(F.collect_list(F.struct("node", "audit"))).alias("a")).select(
        "g", F.array_join(F.transform("a", lambda x: x["audit"]), "").alias("audit")
    )
    counted = rows.groupBy("g", "turn").agg(
        F.count(F.lit(1)).alias("n"), *(F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated"))
    ).groupBy("g").agg(
        F.sum("n").alias("n"), F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"),
        *(F.sum(f).alias(f) for f in ("blank", "duplicate", "truncated")),
    )
    last = whole.select("g", "behind", "cost", "breaks")
    known = counted.join(audits, "g").join(last, "g")
    ids = source.select("g", "conv_id").distinct()
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    report = ids.join(known, "g", "left").select(
        "conv_id", *(zero(F.col(c)).alias(c) for c in ("n", "gaps", "blank", "duplicate", "truncated")),
        zero(F.col("breaks")).alias("illegal"), zero(F.col("cost")).alias("cost"),
        F.concat(F.coalesce("audit", F.lit("")), F.when(F.col("behind") == 2, "I").otherwise("")).alias("audit"),
    )
    edited = edits.select("g", (F.col("node") * BLOCK).alias("start"), F.posexplode(F.arrays_zip("before", "edits")).alias("k", "e")).select(
        "g", (F.col("start") + F.col("k")).alias("pos"), F.col("e.before").alias("state"), F.col("e.edits").alias("edit")
    )
    put = lambda state: F.when(state == 2, "assistant").otherwise("user")
    inserted = F.col("edit").startswith("I")
    new_role = put(F.when(inserted, F.when(F.col("state") == 2, 3).otherwise(2)).otherwise(F.col("state")))
    kept = ~F.col("edit").endswith("D")
    turn_type = turns.schema["turn"].dataType
    made = F.filter(F.array(
        F.when(inserted, F.struct(
            F.lit(0).alias("part"), F.lit("I").alias("edit"), F.lit(None).cast(turn_type).alias("turn"), put(F.col("state")).alias("role"), F.lit("").alias("text")
        )),
        F.when(kept, F.struct(
            F.lit(1).alias("part"), F.right("edit", F.lit(1)).alias("edit"), F.col("turn"),
            F.when(F.col("edit").endswith("R"), new_role).otherwise(F.col("role")).alias("role"), F.col("text"),
        )),
    ), lambda x: x.isNotNull())
    body = turns.join(edited.filter("edit <> 'D'"), ["g", "pos"]).select("g", "conv_id", "pos", F.inline(made))
    closing = last.filter("behind = 2").join(counted.select("g", "n"), "g").join(ids, "g").select(
        "g", "conv_id", F.col("n").alias("pos"), F.lit(0).alias("part"), F.lit("I").alias("edit"), F.lit(None).cast(turn_type).alias("turn"),
        F.lit("assistant").alias("role"), F.lit("").alias("text"),
    )
    return Repair(body.unionByName(closing).drop("g"), report)


def _digests(batches):
    """SHA-256 of each conversation's ``role:text`` lines, as a stream: a long conversation is never held as a whole."""
    key, digest = None, None
    for batch in batches:
        g, ids = batch["g"], batch["conv_id"]
        lines = [f"{r}:{t}".encode() for r, t in zip(batch["role"].to_pylist(), batch["text"].to_pylist())]
        starts = np.append(np.flatnonzero(np.r_[True, changes(g)]), batch.num_rows) if batch.num_rows else np.zeros(1, np.int64)
        done = []
        for s, e in zip(starts[:-1], starts[1:]):
            joined = b"\n".join(lines[s:e])
            if key is None or g[s].as_py() != key[0]:
                if key is not None:
                    done.append((key[1], digest.hexdigest()))
                key, digest = (g[s].as_py(), ids[s].as_py()), hashlib.sha256(joined)
            else:
                digest.update(b"\n" + joined)
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], ids.type), pa.array([d[1] for d in done])], names=["conv_id", "sha256"])
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key[1]], ids.type), pa.array([digest.hexdigest()])], names=["conv_id", "sha256"])


def conversation_digests(rows: DataFrame) -> DataFrame:
    """(conv_id, sha256) of the lines ``role:text`` of repaired rows, joined by newlines.

    A digest is sequential, so a conversation's rows pass one task, one batch at a time.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    dealt = rows.select(group_key("conv_id").alias("g"), "conv_id", "pos", "part", "role", "text").repartition("g")
    return dealt.sortWithinPartitions("g", "pos", "part").mapInArrow(_digests, f"conv_id {kind}, sha256 string")
