"""Chat formatting by quotation linking, with DataFrame functions only.

Lines that begin with ``>`` are quoted, one level for each ``>``; runs of lines of one
level are passages. Passages and their lines are normalised and hashed, and joined to
the first message of the conversation that says the same. A message answers the
message that its first-level passages come from, by matched characters, or else the
turn before it. Conversations are then written in reply order without the quotes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadlens.session import materialize

#: Turns of a bucket when the turn before is looked up; messages of a row of a conversation, on average at most.
BUCKET, ROW_MESSAGES = 256, 512
MAX_ROUNDS = 64
#: Possessive: the regex engine loops over quote marks where it would otherwise recurse, a stack frame for each.
_QUOTE = r"^[ \t]*+((?:>[ \t]?+)++)"
#: Lines that announce a quotation, in the mail programs' usual wordings, of any length and in time linear in it.
_ANNOUNCE = r"(?d)^[ \t]*+(?:On .+ wrote|Am (?>.+? schrieb).*|Le .+ a écrit|El .+ escribió)[ \t]*+:[ \t]*+$"
_SPACES = " \t\n\x0b\f\r"


def level(line: Column) -> Column:
    """How many quote marks the line begins with."""
    return F.length(F.regexp_replace(F.regexp_extract(line, _QUOTE, 1), "[^>]", ""))


def bare(line: Column) -> Column:
    """The line without its quote marks."""
    return F.regexp_replace(line, _QUOTE, "")


def normalised(text: Column) -> Column:
    """Lower case, with each run of white space and punctuation made one space."""
    return F.trim(F.regexp_replace(F.lower(text), r"[\s\p{Punct}]+", " "))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), r"\r\n|\r|\n")


def unquoted(text: Column) -> Column:
    """The message without quoted and announcing lines, trimmed, with at most one blank line in a row.

    Quoted lines go whether or not their passage was linked to a message: outside text,
    Markdown quotes and ``>>>`` code stand nowhere in the result.
    """
    own = F.filter(lines_of(text), lambda x: (level(x) == 0) & ~x.rlike(_ANNOUNCE))
    return F.btrim(F.regexp_replace(F.array_join(own, "\n"), r"\n\s*\n", "\n\n"), F.lit(_SPACES))


def messages(conversations: DataFrame) -> DataFrame:
    """Distinct messages: key (of the conversation), conv_id, turn, role, text, copies (repeated rows)."""
    slim = conversations.select("conv_id", "turn", "role", "text").groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies"))
    return slim.withColumn("key", F.coalesce(F.col("conv_id").cast("string"), F.lit("null")))


def _id() -> Column:
    """What tells the messages of a turn apart; a null role isn't an empty one."""
    return F.md5(F.concat_ws("\u0001", F.coalesce(F.concat(F.lit("r"), "role"), F.lit("n")), "text"))


def quotations(msgs: DataFrame) -> DataFrame:
    """One row per quoted passage: key, turn, id (of the message), passage, level, passage_hash, n_lines, original_turn (null if not found)."""
    quoted = msgs.where(F.col("text").rlike(r"(?m)^[ \t]*>")).withColumn("id", _id())
    each = quoted.select("key", "turn", "id", F.posexplode(lines_of(F.col("text"))).alias("nth", "line")).select("key", "turn", "id", "nth", level(F.col("line")).alias("level"), bare(F.col("line")).alias("line"))
    w = Window.partitionBy("key", "turn", "id").orderBy("nth")  # the lines of one message
    runs = each.withColumn("new", (F.col("level") != F.coalesce(F.lag("level").over(w), F.lit(-1))).cast("int")).withColumn("passage", F.sum("new").over(w)).where("level > 0")
    whole = runs.groupBy("key", "turn", "id", "passage", "level").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("nth", "line"))), lambda s: s["line"]), "\n").alias("body"), F.count(F.lit(1)).alias("n_lines"))
    units = (
        runs.select("key", "turn", "id", "passage", normalised(F.col("line")).alias("unit"))
        .unionByName(whole.select("key", "turn", "id", "passage", normalised(F.col("body")).alias("unit")))
        .where("unit <> ''")
        .withColumn("hash", F.md5("unit"))
        .withColumn("weight", F.length("unit"))
    )
    own = msgs.join(quoted.select("key").distinct(), "key", "left_semi").withColumn("own", unquoted(F.col("text")))
    said = own.select("key", "turn", F.explode(F.array_distinct(F.concat(F.split("own", "\n"), F.split("own", r"\n\n"), F.array("own")))).alias("unit"))
    first = said.select("key", "turn", F.md5(normalised(F.col("unit"))).alias("hash")).where(F.col("hash") != F.md5(F.lit(""))).groupBy("key", "hash").agg(F.min("turn").alias("original_turn"))
    votes = units.join(first, ["key", "hash"]).where("original_turn < turn").groupBy("key", "turn", "id", "passage", "original_turn").agg(F.sum("weight").alias("weight"))
    best = votes.groupBy("key", "turn", "id", "passage").agg(F.max(F.struct("weight", "original_turn")).alias("b"))
    return whole.join(best, ["key", "turn", "id", "passage"], "left").select(
        "key", "turn", "id", "passage", "level", F.md5(normalised(F.col("body"))).alias("passage_hash"), "n_lines", F.col("b.original_turn").alias("original_turn"), F.col("b.weight").alias("weight")
    )


def replies(msgs: DataFrame, found: DataFrame) -> DataFrame:
    """One row per turn of a conversation: key, turn, parent (null for the first), depth."""
    turns = msgs.groupBy("key", "turn").agg(F.lit(1).alias("one")).where("turn IS NOT NULL").withColumn("bucket", F.floor(F.col("turn") / BUCKET))
    within = Window.partitionBy("key", "bucket").orderBy("turn")
    ends = turns.groupBy("key", "bucket").agg(F.max("turn").alias("end"))
    ends = ends.withColumn("before", F.lag("end").over(Window.partitionBy("key").orderBy("bucket"))).drop("end")
    previous = turns.withColumn("prev", F.lag("turn").over(within)).join(ends, ["key", "bucket"]).select("key", "turn", F.coalesce("prev", "before").alias("prev"))
    sums = found.where("level = 1 AND original_turn IS NOT NULL").groupBy("key", "turn", "original_turn").agg(F.sum("weight").alias("weight"))
    answered = sums.groupBy("key", "turn").agg(F.max(F.struct("weight", "original_turn")).alias("b")).select("key", "turn", F.col("b.original_turn").alias("quoted"))
    links = previous.join(answered, ["key", "turn"], "left").select("key", "turn", F.coalesce("quoted", "prev").alias("parent"))
    state = materialize(links.withColumn("up", F.col("parent")).withColumn("depth", F.when(F.col("parent").isNull(), 0).otherwise(1).cast("long")))
    for _ in range(MAX_ROUNDS):  # pointer jumping: the distance to the first turn in as many rounds as its logarithm
        if state.where("up IS NOT NULL").isEmpty():
            break
        # Only turns that haven't reached the first one yet are joined again: one long conversation costs its own rows.
        above = state.select("key", F.col("turn").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more"))
        moved = state.where("up IS NOT NULL").join(above, ["key", "up"], "left").select("key", "turn", "parent", F.col("next").alias("up"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"))
        state = materialize(state.where("up IS NULL").unionByName(moved))
    return state.select("key", "turn", "parent", "depth")


def link_messages(conversations: DataFrame) -> DataFrame:
    """One row per distinct message: conv_id, turn, role, content, parent_turn, depth, n_quotes, n_linked, copies.

    Null text has no content; a null conv_id is one conversation; messages of a null
    turn have neither parent nor depth, and no quotes are counted; several messages of
    one turn share its parent, each with quotes of its own. Repeated rows are one message, counted in copies. An empty table gives no
    rows; other columns are ignored.
    """
    msgs = materialize(messages(conversations))
    found = materialize(quotations(msgs))
    chain = replies(msgs, found)
    quotes = found.groupBy("key", "turn", "id").agg(F.count(F.lit(1)).alias("n_quotes"), F.count("original_turn").alias("n_linked"))
    return (
        msgs.withColumn("id", _id())
        .join(chain, ["key", "turn"], "left")
        .join(quotes, ["key", "turn", "id"], "left")
        .select("key", "conv_id", "turn", "role", unquoted(F.col("text")).alias("content"), F.col("parent").alias("parent_turn"), "depth", F.coalesce("n_quotes", F.lit(0)).alias("n_quotes"), F.coalesce("n_linked", F.lit(0)).alias("n_linked"), "copies")
    )


def _pieces(many: DataFrame, row_messages: int) -> DataFrame:
    """Adds piece: the rank of a message in its part, in reply order, by ``row_messages``.

    Ranges of the order are cells, whatever conversation they are of; cells are ranked
    each on its own, and prefix sums run over their counts alone.
    """
    n = int(many.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = many.withColumn("head", F.substring("line", 1, 256)).repartitionByRange(n, "key", "part", "depth", "turn", "r", "head").drop("head")
    dealt = materialize(dealt.withColumn("cell", F.spark_partition_id()))
    upto = Window.partitionBy("key", "part").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("key", "part", "cell").agg(F.count(F.lit(1)).alias("held")).select("key", "part", "cell", F.coalesce(F.sum("held").over(upto), F.lit(0)).alias("start"))
    own = Window.partitionBy("key", "part", "cell").orderBy("depth", "turn", "r", "line")
    ranked = dealt.withColumn("nth", F.row_number().over(own) - 1).join(starts, ["key", "part", "cell"])
    return ranked.select(*many.columns, F.floor((F.col("start") + F.col("nth")) / row_messages).alias("piece"))


def chat_rows(linked: DataFrame, row_messages: int = ROW_MESSAGES) -> DataFrame:
    """Conversations in reply order: conv_id, part, piece, n_messages, n_quotes, n_linked, chat.

    Messages are ordered by depth, then turn, role and content: each stands after the
    one it answers. A long conversation spans several parts of ``row_messages`` depths,
    and a part of very many messages several pieces, consecutive in that order, so that
    no row grows without bound: joined by part and piece, chats give the whole order.
    """
    line = F.concat(F.lit("<|"), F.coalesce("role", F.lit("unknown")), F.lit("|>\n"), F.col("content"), F.lit("<|end|>\n"))
    parted = linked.withColumn("part", F.coalesce(F.floor(F.col("depth") / row_messages), F.lit(-1)))
    parted = materialize(parted.select("key", "part", "conv_id", "depth", "turn", F.coalesce("role", F.lit("")).alias("r"), line.alias("line"), "n_quotes", "n_linked"))
    sizes = materialize(parted.groupBy("key", "part").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 4 * row_messages).drop("n"))
    cut = parted.withColumn("piece", F.lit(0).cast("long"))
    if not sizes.isEmpty():
        cut = parted.join(sizes, ["key", "part"], "left_anti").withColumn("piece", F.lit(0).cast("long")).unionByName(_pieces(parted.join(sizes, ["key", "part"], "left_semi"), row_messages))
    rows = cut.groupBy("key", "part", "piece").agg(
        F.first("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_messages"),
        F.sum("n_quotes").alias("n_quotes"),
        F.sum("n_linked").alias("n_linked"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("depth", "turn", "r", "line"))), lambda s: s["line"]), "").alias("chat"),
    )
    return rows.select("conv_id", "part", "piece", "n_messages", "n_quotes", "n_linked", "chat")


def format_chats(conversations: DataFrame) -> DataFrame:
    return chat_rows(link_messages(conversations))
