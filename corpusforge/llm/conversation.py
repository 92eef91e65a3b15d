"""Repair of conversation structure at the least cost, as a fold in Spark SQL.

Windows derive each row's fault. The rows of a conversation become a sorted array of small structs,
and aggregate() carries four states over it, the cheapest (cost, audit) that ends with nothing said,
a system turn, a user turn or an assistant turn; least() picks among them, ties by the audit's text.
Of two audits of equal cost and state none begins the other (it would need a further insert, which
costs), so the least of a state stays the least whatever follows.

A fold from any of the four states to any other is itself a value that can be joined to the next,
so conversations of any length are folded in blocks of rows, then blocks of blocks: no task holds a
conversation, and no audit is copied once for every row. Only the repaired text's check sum, which
is sequential by its nature, passes a conversation through one task, as a stream of rows.
"""

from __future__ import annotations

import hashlib
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import Batches, checkpoint, lean, narrow, tune

DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5
#: Rows, or blocks, that one fold takes.
BLOCK = 256
#: Leading characters of a text by which rows of one turn are dealt into ranges.
LEAD = 64
#: In Java's and in Python's patterns: a character that is no blank, and a text whose last such character ends a sentence.
FILLED, ENDED = r"[^\x20\x09-\x0D]", r"[.!?][\x20\x09-\x0D]*\z"
STATES = ("none", "s", "u", "a")
FOUND = "struct<cost:bigint,audit:string>"
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
#: Of monotonically_increasing_id: bits of the place within a range.
PLACE_BITS = 33


def damage(rows: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The rows with faults put in by crc32(`id:turn`) % 20: 0 drops the row, 1 empties its text, 2 removes `.!?`, 3 repeats it, 4 makes it a user's.
    A null in any of the four columns counts as one space (id and turn stay null themselves). Other columns are ignored."""
    known = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    df = narrow(rows, id=id, turn=turn, role=role, text=text)
    df = df.withColumn("role", known("role")).withColumn("text", known("text"))
    df = df.withColumn("fate", F.crc32(F.concat_ws(":", known("id"), known("turn")).cast("binary")) % 20).filter("fate <> 0")
    said = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return df.select(F.col("id").alias(id), F.col("turn").alias(turn), F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias(role), said.alias(text), copies.alias("_")).drop("_")


def ordered(rows: DataFrame) -> DataFrame:
    """(id, turn, role, text) with range and place: ranges of the order by id, turn (nulls first), role and text, each numbered from 0.
    Rows that agree in all of these are dealt at random, so that no id, turn or text is more than a range."""
    order = [F.col("id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "lead", "hash", "salt"]
    keyed = rows.withColumn("lead", F.substring("text", 1, LEAD)).withColumn("hash", F.xxhash64("text")).withColumn("salt", F.rand(42))
    dealt = keyed.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    return checkpoint(dealt.select("id", "turn", "role", "text", F.shiftright("at", PLACE_BITS).alias("range"), F.col("at").bitwiseAND((1 << PLACE_BITS) - 1).alias("place")))


def numbered(dealt: DataFrame) -> tuple[DataFrame, int]:
    """place becomes pos, gapless over all ranges; and the number of rows."""
    sizes = sorted(dealt.groupBy("range").agg(F.count("*").alias("n")).collect())  # one row a range
    starts, total = [], 0
    for r in sizes:
        starts.append((r["range"], total))
        total += r.n
    table = dealt.sparkSession.createDataFrame(starts, "range long, start long")  # as many rows as ranges
    return dealt.join(F.broadcast(table), "range").withColumn("pos", F.col("start") + F.col("place")).drop("start"), total


def faults(rows: DataFrame) -> DataFrame:
    """Narrow rows (no text) with fault (blank, duplicate, truncated or null), the initial of the role, and what stands before them in their range."""
    initial, same = F.substring("role", 1, 1), F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    blank, cut = ~F.col("text").rlike(FILLED), ~F.col("text").rlike(ENDED)
    df = rows.select("id", "range", "place", "pos", "turn", initial.alias("initial"), same.alias("same"), blank.alias("blank"), cut.alias("cut"))
    # Said before: first among the copies of a range, then among the first ones of all ranges. A phrase of a third of all rows is neither one group nor one task.
    df = df.withColumn("nth", F.row_number().over(Window.partitionBy("id", "same", "range").orderBy("pos")))
    heads = Window.partitionBy("id", "same", F.when(F.col("nth") > 1, F.col("range"))).orderBy("pos")
    df = df.withColumn("again", (F.col("nth") > 1) | (F.row_number().over(heads) > 1))
    fault = F.when(F.col("blank"), "blank").when(F.col("again"), "duplicate").when(F.col("cut"), "truncated")
    before = Window.partitionBy("id", "range").orderBy("pos")
    df = df.select("id", "range", "pos", "turn", "initial", fault.alias("fault"), F.lag("initial").over(before).alias("last_initial"), F.lag("turn").over(before).alias("last_turn"), (F.col("place") == 0).alias("edge"))
    # The first row of a conversation for sure: nothing before it in its range, and its range doesn't begin with it.
    return df.withColumn("opens", F.col("last_initial").isNull() & (~F.col("edge") | (F.col("pos") == 0))).drop("edge")


def counts(marked: DataFrame) -> DataFrame:
    """Per id: gaps, blank, duplicate, truncated, illegal. Ranges are summed first, and joined at their borders."""
    odd = lambda a, b: F.when(a.isNotNull() & ~F.concat(a, b).isin("su", "ua", "au"), 1).otherwise(0)
    of = lambda kind: F.count_if(F.col("fault") == kind).alias(kind)
    new = F.when(F.col("turn").isNotNull() & ~F.col("turn").eqNullSafe(F.col("last_turn")), 1).otherwise(0)
    parts = marked.groupBy("id", "range").agg(
        of("blank"), of("duplicate"), of("truncated"), F.sum(odd(F.col("last_initial"), F.col("initial"))).alias("illegal"), F.sum(new).alias("turns"),
        F.min("turn").alias("low"), F.max("turn").alias("high"), F.min_by("initial", "pos").alias("head"), F.max_by("initial", "pos").alias("tail"),
    )
    w = Window.partitionBy("id").orderBy("range")  # one row a range
    parts = parts.withColumn("illegal", F.col("illegal") + odd(F.lag("tail").over(w), F.col("head"))).withColumn("shared", F.coalesce((F.lag("high").over(w) == F.col("low")).cast("int"), F.lit(0)))
    sums = [F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")]
    gaps = F.coalesce(F.max("high") - F.min("low") + 1 - (F.sum("turns") - F.sum("shared")), F.lit(0)).cast("long")
    return parts.groupBy("id").agg(gaps.alias("gaps"), *sums)


def _went(state: Column, cost, letter: str) -> Column:
    return F.when(state.isNotNull(), F.struct((state["cost"] + cost).cast("long").alias("cost"), F.concat(state["audit"], F.lit(letter)).alias("audit")))


def _four(states: dict[str, Column]) -> Column:
    return F.struct(*(states[s].cast(FOUND).alias(s) for s in STATES))


def _only(start: Column) -> Column:
    """Nothing done yet, in state number `start`."""
    zero = F.struct(F.lit(0).cast("long").alias("cost"), F.lit("").alias("audit"))
    return _four({s: F.when(start == k, zero) for k, s in enumerate(STATES)})


def _insert(four: Column) -> dict[str, Column]:
    """At most one insert between two rows: a second one leads where less would do."""
    return {
        "none": four["none"], "s": four["s"],
        "u": F.least(four["u"], _went(F.least(four["none"], four["s"], four["a"]), INSERT, "I")),
        "a": F.least(four["a"], _went(four["u"], INSERT, "I")),
    }


def _row(four: Column, row: Column) -> Column:
    """Inserts, if any, and then one row kept, given another role, or deleted."""
    extra = F.when(row["cut"], TRUNCATED).otherwise(0)

    def edit(at: Column) -> Column:
        keep = lambda state, initial: F.when(~row["must"] & (row["initial"] == initial), _went(state, extra, "K"))
        rerole = lambda state: F.when(~row["must"], _went(state, extra + REROLE, "R"))
        delete = lambda state: _went(state, DELETE, "D")
        open_ = F.least(at["none"], at["s"], at["a"])  # a user turn may follow these
        return _four({
            "none": delete(at["none"]), "s": F.least(delete(at["s"]), keep(at["none"], "s")),
            "u": F.least(delete(at["u"]), keep(open_, "u"), rerole(open_)), "a": F.least(delete(at["a"]), keep(at["u"], "a"), rerole(at["u"])),
        })

    return F.get(F.transform(F.array(_four(_insert(four))), edit), F.lit(0))


def _joined(four: Column, folds: Column) -> Column:
    """The four states after a block, whose folds are given by the state that it begins in."""
    def both(x: Column, y: Column) -> Column:
        return F.when(x.isNotNull() & y.isNotNull(), F.struct((x["cost"] + y["cost"]).alias("cost"), F.concat(x["audit"], y["audit"]).alias("audit")))

    return _four({q: F.least(*(both(four[r], F.get(folds, F.lit(k))[q]) for k, r in enumerate(STATES))) for q in STATES})


def cheapest(marked: DataFrame, total: int, block: int = BLOCK) -> DataFrame:
    """Per id: cost and audit of its cheapest repair."""
    turn = F.struct("pos", F.coalesce(F.col("fault").isin("blank", "duplicate"), F.lit(False)).alias("must"), F.coalesce(F.col("fault") == "truncated", F.lit(False)).alias("cut"), "initial")
    starts = F.when(F.col("opens"), F.array(F.lit(0))).otherwise(F.array(*map(F.lit, range(4))))
    level = marked.withColumn("block", F.expr(f"pos div {block}")).groupBy("id", "block").agg(F.array_sort(F.collect_list(turn)).alias("turns"), F.max("opens").alias("opens"))
    level = checkpoint(level.select("id", "block", F.transform(starts, lambda p: F.aggregate("turns", _only(p), _row)).alias("folds")))
    size = block
    while size < total:
        size *= block
        above = level.groupBy("id", F.expr(f"block div {block}").alias("block")).agg(F.array_sort(F.collect_list(F.struct(F.col("block").alias("at"), "folds"))).alias("parts"))
        first = F.get("parts", F.lit(0))["folds"]
        starts = F.when(F.size(first) == 1, F.array(F.lit(0))).otherwise(F.array(*map(F.lit, range(4))))
        merged = F.transform(starts, lambda p: F.aggregate("parts", _only(p), lambda four, part: _joined(four, part["folds"])))
        level = checkpoint(above.select("id", "block", F.when(F.size("parts") == 1, first).otherwise(merged).alias("folds")))
    done = F.get("folds", F.lit(0))
    last = F.transform(F.array(_four(_insert(done))), lambda at: F.least(at["none"], at["a"]))
    return level.select("id", F.get(last, F.lit(0)).alias("best")).select("id", "best.cost", "best.audit")


def _walk(batches: Batches):
    """Walks rows sorted by id and pos; the row at -1 opens an id and holds its audit. Yields (opening row, role, text) for each
    repaired row, and (opening row, None, None) at the end of each id."""
    opened, audit, k, expect = None, "", 0, 0
    roles = ("user", "assistant")
    for batch in batches:
        for row in batch.to_pylist():
            if opened is not None:  # inserts before this row, or at the end
                while k < len(audit) and audit[k] == "I":
                    yield opened, roles[expect], ""
                    expect, k = 1 - expect, k + 1
            if row["pos"] < 0:
                if opened is not None:
                    yield opened, None, None
                opened, audit, k, expect = row, row["audit"], 0, 0
                continue
            edit, k = audit[k], k + 1
            if edit != "D":
                yield opened, row["role"] if edit == "K" else roles[expect], row["text"]
                expect = expect if edit == "K" and row["role"][:1] == "s" else 1 - expect
    if opened is not None:
        while k < len(audit):
            yield opened, roles[expect], ""
            expect, k = 1 - expect, k + 1
        yield opened, None, None


def _digests(batches: Batches):
    sha, said = hashlib.sha256(), 0
    for row, role, text in _walk(batches):
        if role is None:
            yield (row["id"], *(row[c] for c in COUNTS), row["audit"], sha.hexdigest())
            sha, said = hashlib.sha256(), 0
        else:
            sha.update(f"{chr(10) * (said > 0)}{role}:{text}".encode())
            said += 1


def _turns(batches: Batches):
    nth = 0
    for row, role, text in _walk(batches):
        if role is None:
            nth = 0
        else:
            yield row["id"], nth, role, text
            nth += 1


def _in_batches(rows, names: list[str], types: list[pa.DataType], size: int = 256):
    """Rows as record batches of a bounded number of rows."""
    while some := list(islice(rows, size)):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some), types)], names=names)


def repair(rows: DataFrame, ids: DataFrame | None = None, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", digest: bool = False, block: int = BLOCK) -> DataFrame:
    """Repairs each conversation at the least cost, so that its roles are an optional system turn and pairs of user and assistant turns, or nothing.

    Rows are taken by turn, nulls first; rows of one turn by role, then by the text's first 64 characters and a hash of it. A null role or text counts as one space.
    A role that begins neither with s, u nor a, or an empty one, can't be kept. Rows without id are one conversation. Repeated
    rows are duplicates of the first. An empty table gives an empty result; further columns are ignored. Very long texts are
    moved row by row, never collected. `ids` may name conversations without rows: zeros, an empty audit.

    digest: one row an id, with gaps, blank, duplicate, truncated, illegal, cost (longs), audit (the edits' initials) and repaired_sha256
    (`role:text` joined by newlines). Otherwise the repaired rows: id, nth (from 0), role, text.
    """
    tune(rows.sparkSession)
    own = narrow(rows, id=id, turn=turn, role=role, text=text)
    kind = own.schema["id"].dataType.simpleString()
    own = own.select("id", F.col("turn").cast("long").alias("turn"), *(F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")))
    dealt, total = numbered(ordered(own))
    marked = checkpoint(faults(dealt))
    report = (narrow(ids, id=id) if ids is not None else dealt.select("id")).distinct()
    for part in (counts(marked), cheapest(marked, total, block)):
        part = part.withColumnRenamed("id", "_id")
        report = report.join(part, report["id"].eqNullSafe(part["_id"]), "left").drop("_id")
    opening = report.select("id", F.lit(-1).cast("long").alias("pos"), F.lit("").alias("role"), F.lit("").alias("text"), *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in COUNTS), F.coalesce("audit", F.lit("")).alias("audit"))
    none = [F.lit(None).cast("long").alias(c) for c in COUNTS] + [F.lit(None).cast("string").alias("audit")]
    walk = opening.unionAll(dealt.select("id", "pos", "role", "text", *none)).repartition("id").sortWithinPartitions("id", "pos")
    key, columns = to_arrow_type(own.schema["id"].dataType), COUNTS

    def digests(batches: Batches) -> Batches:
        yield from _in_batches(_digests(batches), ["id", *columns, "audit", "repaired_sha256"], [key, *[pa.int64()] * len(columns), pa.string(), pa.string()])

    def turns(batches: Batches) -> Batches:
        yield from _in_batches(_turns(batches), ["id", "nth", "role", "text"], [key, pa.int64(), pa.string(), pa.string()])

    longs = ", ".join(f"{c} long" for c in COUNTS)
    out = walk.mapInArrow(lean(digests), f"id {kind}, {longs}, audit string, repaired_sha256 string") if digest else walk.mapInArrow(lean(turns), f"id {kind}, nth long, role string, text string")
    return out.withColumnRenamed("id", id)
