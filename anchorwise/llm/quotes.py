"""Quotation linking (operator 8), with DataFrame functions only.

Lines that begin with `>` marks are quoted; the number of marks is the level. Neighbouring lines of one level form a passage. Passages, their
paragraphs (between blank lines) and their lines are normalised (lower case, white space runs to one blank) and hashed, and so are the unquoted texts
of all messages. A passage is linked to the earliest message before it in its conversation that has the largest unit in common
(passage, then paragraph, then line), and else to the first such message of any other conversation. Originals are reduced to one row a
hash before the join (with the first messages of two conversations, as one may be the asker's own), so a line that many messages share costs no more than one row a quotation. Quotations of a very frequent line are
dealt to all tasks, each of which has the line's original.

The parent of a message is the latest original in its conversation of its passages of the lowest level linked there. Messages that reply to each other form a
thread; their places in it come by doubling along a tour of the thread, in as many rounds as the logarithm of its length and with two rows a message, however long chains of
replies are. Rows are ordered by conversation, thread and place: a reply comes after what it answers, before later threads. The order is a range sort, so a
conversation of any size is dealt to many tasks.

Null text is empty. A null conv_id or turn links with nothing; it is a thread of its own (null first). Repeated rows are messages of their own with
the same links. An attribution line (`On ... wrote:`) before a quotation goes with it. Messages that only quote have an empty body. Very long
messages are rows as others are: their lines are. Further columns don't matter, whatever their names. Empty tables give no rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

MARKS, ATTRIBUTION = r"^(?:[ \t]*>)+", r"(?i)^[ \t]*on\b.+\bwrote:[ \t\r]*$"
#: A key is hot from this part of the rows on, so there are no more hot keys than this.
HOT = 1000
LINK = "struct<level:int,passage:string,conv_id:bigint,turn:bigint>"


def _key(text: Column) -> Column:
    normal = F.lower(F.trim(F.regexp_replace(text, r"\s+", " ")))
    return F.when(normal != "", F.unhex(F.md5(normal)))


def _units(text: Column) -> Column:
    """Keys of the text (size 3), its paragraphs (2) and its lines (1)."""
    unit = lambda size: lambda x: F.struct(F.lit(size).alias("size"), _key(x).alias("key"))
    every = F.concat(F.array(unit(3)(text)), F.transform(F.split(text, r"\n[ \t\r]*\n"), unit(2)), F.transform(F.split(text, "\n"), unit(1)))
    return F.array_distinct(F.filter(every, lambda u: u.key.isNotNull()))


def parse(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """messages (uid, text) with quotations to (uid, body) and to passages (uid, run, level, passage)."""
    lines = messages.select("uid", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    marks = F.regexp_extract("line", MARKS, 0)
    lines = lines.select("uid", "pos", F.length(F.regexp_replace(marks, "[^>]", "")).alias("level"), F.regexp_replace("line", MARKS + r"[ \t]?", "").alias("line"))
    w = Window.partitionBy("uid").orderBy("pos")
    lines = lines.withColumns({"new": F.coalesce((F.lag("level").over(w) != F.col("level")).cast("int"), F.lit(1)), "next": F.lead("level").over(w)})
    lines = lines.withColumn("run", F.sum("new").over(w)).filter(~((F.col("level") == 0) & (F.coalesce("next", F.lit(0)) > 0) & F.col("line").rlike(ATTRIBUTION)))
    joined = lambda: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda x: x.line), "\n")
    bodies = lines.filter("level = 0").groupBy("uid").agg(F.trim(joined()).alias("body"))
    passages = lines.filter("level > 0").groupBy("uid", "run", "level").agg(joined().alias("passage")).filter(F.trim("passage") != "")
    return bodies, passages


def _dealt_join(asked: DataFrame, originals: DataFrame, *keys: str) -> DataFrame:
    """Inner join of asked (with uid and run) to originals, one row a key. A key that over a thousandth of asked has, of which there are a thousand at most, is dealt to as many
    tasks as a shuffle has, with its original in each."""
    every, parts = asked.count(), common.parts(asked.sparkSession)
    hot = F.broadcast(asked.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") * HOT > every).select(*keys, F.lit(True).alias("hot")))
    part = F.when(F.col("hot"), F.pmod(F.xxhash64("uid", "run"), F.lit(parts)).cast("int")).otherwise(F.lit(0))
    parts_of = F.explode(F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(F.array(F.lit(0))))
    dealt = asked.join(hot, list(keys), "left").withColumn("part", part).drop("hot")
    return dealt.join(originals.join(hot, list(keys), "left").withColumn("part", parts_of).drop("hot"), [*keys, "part"]).drop("part")


def links(passages: DataFrame, originals: DataFrame) -> DataFrame:
    """passages (uid, conv_id, turn, run, level, passage) with the message (to_conv, to_turn) that each quotes; nulls where none is found."""
    asked = passages.select("uid", "run", "conv_id", "turn", F.explode(_units(F.col("passage"))).alias("u")).select("uid", "run", "conv_id", "turn", "u.*")
    units = originals.filter("conv_id is not null and turn is not null").select("conv_id", "turn", F.explode(_units(F.col("body"))).alias("u")).select("conv_id", "turn", "u.key")
    within = units.groupBy("conv_id", "key").agg(F.min("turn").alias("to_turn"))
    near = _dealt_join(asked, within, "conv_id", "key").filter("to_turn < turn").select("uid", "run", "size", F.lit(1).alias("own"), F.col("conv_id").alias("to_conv"), "to_turn")
    # The first messages of the two least conversations: one of them at least is not the asker's own. The limit of the window also holds before its shuffle.
    two = within.withColumn("nth", F.row_number().over(Window.partitionBy("key").orderBy("conv_id"))).filter("nth <= 2")
    firsts = two.groupBy("key").agg(*(F.min(F.when(F.col("nth") == k, F.struct("conv_id", F.col("to_turn").alias("turn")))).alias(f"f{k}") for k in (1, 2)))
    other = F.when(F.col("f1.conv_id").eqNullSafe(F.col("conv_id")), F.col("f2")).otherwise(F.col("f1"))
    far = _dealt_join(asked, firsts, "key").withColumn("f", other).filter("f is not null").select("uid", "run", "size", F.lit(0).alias("own"), F.col("f.conv_id").alias("to_conv"), F.col("f.turn").alias("to_turn"))
    best = near.union(far).groupBy("uid", "run").agg(F.max(F.struct("own", "size", (-F.col("to_conv")).alias("c"), (-F.col("to_turn")).alias("t"))).alias("b"))
    return passages.join(best, ["uid", "run"], "left").select("uid", "conv_id", "turn", "run", "level", "passage", (-F.col("b.c")).alias("to_conv"), (-F.col("b.t")).alias("to_turn"))


def _numbered(rows: DataFrame, *order: str) -> DataFrame:
    """rows as a table dealt by ranges of `order`, with the number of their range: no column's value is too frequent for it."""
    spark = rows.sparkSession
    return common.table(rows.repartitionByRange(common.parts(spark), *order).sortWithinPartitions(*order).withColumn("range", F.spark_partition_id()))


def _with_sibling(replies: DataFrame) -> DataFrame:
    """replies (conv_id, turn, parent), numbered by (conv_id, parent, turn), with `sibling`: the turn of the reply before it to the same message. A message with very many replies lies in several ranges:
    the first row of a range looks at the last one of the range before (one row for each range, sent to all)."""
    order = [F.col(c) for c in ("conv_id", "parent", "turn")]
    last = replies.groupBy("range").agg(F.max(F.struct("conv_id", "parent", "turn")).alias("l"))
    last = last.select(F.lead("range").over(Window.partitionBy(F.lit(0)).orderBy("range")).alias("range"), "l")
    before = F.coalesce(F.lag(F.struct("conv_id", "parent", "turn")).over(Window.partitionBy("range").orderBy(*order)), F.col("l"))
    rows = replies.join(F.broadcast(last.filter("range is not null")), "range", "left").withColumn("b", before)
    same = (F.col("b.conv_id") == F.col("conv_id")) & (F.col("b.parent") == F.col("parent"))
    return rows.select("conv_id", "turn", "parent", F.when(same, F.col("b.turn")).alias("sibling"))


def threads(parents: DataFrame) -> DataFrame:
    """(conv_id, turn, parent), parent < turn, to (conv_id, turn, root_turn, place, depth) of all messages that reply or are replied to: the first message of
    the thread, the number of the thread's messages before this one in reply order (a message, then its replies by turn, each with its own), and the number of those it
    replies to, directly or not.

    Each thread is a tour that enters and leaves every message once. Each step of the tour knows the step before it and what happened there; both double their reach each
    round, so the rounds are the logarithm of the longest tour, of two rows a message whatever the length of its chain. A step is looked up by one other a round, so no row
    is joined often."""
    replies = _numbered(parents.select("conv_id", "turn", "parent").distinct(), "conv_id", "parent", "turn")
    roots = replies.select("conv_id", F.col("parent").alias("turn")).join(replies, ["conv_id", "turn"], "left_anti").distinct().select("conv_id", "turn", F.lit(None).cast("long").alias("parent"), F.lit(None).cast("long").alias("sibling"))
    nodes = _with_sibling(replies).union(roots)
    last = replies.groupBy("conv_id", F.col("parent").alias("turn")).agg(F.max("turn").alias("child"))
    # Steps are (turn, leaves); weights of a step: one more message before, and one level down or up.
    enter = nodes.select("conv_id", "turn", F.lit(False).alias("leaves"), F.coalesce("sibling", "parent").alias("to"), F.col("sibling").isNotNull().alias("to_leaves"))
    leave = nodes.select("conv_id", "turn").join(last, ["conv_id", "turn"], "left").select("conv_id", "turn", F.lit(True).alias("leaves"), F.coalesce("child", "turn").alias("to"), F.col("child").isNotNull().alias("to_leaves"))
    weigh = lambda enters, leaves: F.when(F.col("to").isNull(), F.lit(0)).when(F.col("to_leaves"), leaves).otherwise(enters).cast("long")
    steps = enter.union(leave).withColumns({"place": weigh(F.lit(1), F.lit(0)), "depth": weigh(F.lit(1), F.lit(-1)), "root_turn": F.when(F.col("to").isNull(), F.col("turn"))})
    state = common.table(steps)
    while not state.filter("root_turn is null").isEmpty():
        up = state.select("conv_id", F.col("turn").alias("to"), F.col("leaves").alias("to_leaves"), F.col("to").alias("to2"), F.col("to_leaves").alias("to_leaves2"), F.col("place").alias("place2"), F.col("depth").alias("depth2"), F.col("root_turn").alias("root2"))
        further = state.filter("root_turn is null").join(up, ["conv_id", "to", "to_leaves"]).select(
            "conv_id", "turn", "leaves", F.col("to2").alias("to"), F.col("to_leaves2").alias("to_leaves"), (F.col("place") + F.col("place2")).alias("place"), (F.col("depth") + F.col("depth2")).alias("depth"), F.col("root2").alias("root_turn"))
        before, state = state, common.table(state.filter("root_turn is not null").union(further))
        common.release(before)
    common.release(replies)
    return state.filter("not leaves").select("conv_id", "turn", "root_turn", "place", "depth")


def link_quotations(messages: DataFrame) -> DataFrame:
    """Per row of messages (conv_id, turn, role, text): conv_id, turn, role, body, quotes (level, passage, conv_id, turn quoted), parent_turn, root_turn, place, depth; in reply order."""
    rows = common.with_uid(messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", F.coalesce("text", F.lit("")).alias("text")))
    has = F.col("text").rlike(r"(?m)^[ \t]*>")
    bodies, passages = parse(rows.filter(has).select("uid", "text"))
    passages = common.cut(passages.join(rows.filter(has).select("uid", "conv_id", "turn"), "uid"))
    whole = rows.join(bodies, "uid", "left").withColumn("body", F.when(has, F.coalesce("body", F.lit(""))).otherwise(F.col("text"))).drop("text")
    found = common.cut(links(passages, whole))
    inside = F.col("to_conv").eqNullSafe(F.col("conv_id"))
    lowest = found.filter(inside).groupBy("uid").agg(F.min("level").alias("lowest"))
    parent = found.filter(inside).join(lowest, "uid").filter("level = lowest").groupBy("uid", "conv_id", "turn").agg(F.max("to_turn").alias("parent_turn"))
    quoted = found.groupBy("uid").agg(F.transform(F.array_sort(F.collect_list(F.struct("run", "level", "passage", "to_conv", "to_turn"))), lambda x: F.struct(x.level.alias("level"), x.passage.alias("passage"), x.to_conv.alias("conv_id"), x.to_turn.alias("turn"))).cast(f"array<{LINK}>").alias("quotes"))
    parent = common.cut(parent)
    place = threads(parent.groupBy("conv_id", "turn").agg(F.max("parent_turn").alias("parent")))
    out = whole.join(quoted, "uid", "left").join(parent.select("uid", "parent_turn"), "uid", "left").join(place, ["conv_id", "turn"], "left")
    zero = F.lit(0).cast("long")
    # A row that repeats a message's place without its quotation (another text under the same numbers) starts a thread of its own, or shares that which starts there.
    own = F.col("parent_turn").isNull() & (F.coalesce("depth", zero) > 0)
    out = out.select(
        "uid", "conv_id", "turn", "role", "body", F.coalesce("quotes", F.array().cast(f"array<{LINK}>")).alias("quotes"), "parent_turn", F.when(own, F.col("turn")).otherwise(F.coalesce("root_turn", "turn")).alias("root_turn"),
        F.when(own, zero).otherwise(F.coalesce("place", zero)).alias("place"), F.when(own, zero).otherwise(F.coalesce("depth", zero)).alias("depth"),
    )
    order = ("conv_id", "root_turn", "place", "uid")
    return out.repartitionByRange(common.parts(messages.sparkSession), *order).sortWithinPartitions(*order).drop("uid")
