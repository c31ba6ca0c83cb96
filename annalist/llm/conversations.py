"""Chat formatting by quotation linking, with built-in functions.

A line's quote level is the number of `>` before it; lines of one level that follow
each other are a passage, whatever its line breaks. Passages are normalised and
hashed by their runs of WIDTH words (a shorter passage whole), and joined to the
unquoted words of earlier messages of the conversation. A message answers the
message that most of its outermost passages come from, or else the message before
it; its text is kept without quotes. Answers make a tree, whose preorder is the
order of the conversation: each message comes after what it answers, and a side
thread in one piece.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from annalist.llm.common import cut, tables
from annalist.llm.fingerprints import let

#: Words of a run; the share of a passage's runs that its original must have.
WIDTH, SHARE = 5, 0.5
#: Turns that one task looks back over at once.
BLOCK = 4096
_MARKS = r"^(?:[ \t]*>)+[ \t]?"


def parse_lines(text: Column) -> Column:
    """(place, level, body) of each line of a text; a null text has one empty line."""
    lines = F.split(F.coalesce(text, F.lit("")), "\r?\n", -1)

    def one(line: Column, place: Column) -> Column:
        marks = F.regexp_extract(line, _MARKS, 0)
        return F.struct(place.alias("place"), F.length(F.regexp_replace(marks, "[^>]", "")).alias("level"), F.substring(line, F.length(marks) + 1, F.length(line)).alias("body"))

    return let(lines, lambda ls: F.transform(ls, one))


def normalised(body: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(body), r"[^\p{L}\p{N}]+", " "))


def passages(lines: Column) -> Column:
    """(place, level, words) of each quoted passage: lines of one level that follow each other, line breaks and marks normalised away."""

    def found(ls: Column) -> Column:
        level = lambda i: F.get(ls, i)["level"]
        edges = F.filter(F.sequence(F.lit(0), F.size(ls) - 1), lambda i: (i == 0) | (level(i - 1) != level(i)))

        def each(es: Column) -> Column:
            # a passage ends where the next one begins
            def one(k: Column) -> Column:
                i = F.get(es, k)
                body = F.transform(F.slice(ls, i + 1, F.coalesce(F.get(es, k + 1), F.size(ls)) - i), lambda x: x["body"])
                return F.struct(i.alias("place"), level(i).alias("level"), F.when(level(i) > 0, _words(F.array_join(body, " "))).alias("words"))

            return F.transform(F.sequence(F.lit(0), F.size(es) - 1), one)

        return F.filter(let(edges, each), lambda p: F.size(p["words"]) > 0)

    return let(lines, found)


def _words(text: Column) -> Column:
    return F.filter(F.split(normalised(text), " "), lambda w: w != "")


def _runs(words: Column, width: Column) -> Column:
    """Hashes of all runs of so many words; none if there are fewer."""
    last = F.size(words) - width + 1
    return F.when(last >= 1, F.transform(F.sequence(F.lit(1), last), lambda i: F.sha1(F.array_join(F.slice(words, i, width), " ")))).otherwise(F.array().cast("array<string>"))


def _last_before(rows: DataFrame, keys: list[str], turn: str, value: Column, name: str) -> DataFrame:
    """rows with `name`: the last value that is not null of the rows before, by turn, of the same keys.

    Turns are taken in blocks of BLOCK, and the last of each block by itself, so a key of very many turns is no task of its own.
    """
    rows = rows.withColumn("_block", F.floor(F.col(turn).cast("double") / BLOCK)).withColumn("_value", value)
    near = Window.partitionBy(*keys, "_block").orderBy(turn).rowsBetween(Window.unboundedPreceding, -1)
    far = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    tops = rows.groupBy(*keys, "_block").agg(F.max(F.when(F.col("_value").isNotNull(), F.struct(F.col(turn).alias("at"), F.col("_value").alias("value"))))["value"].alias("_top"))
    tops = tops.withColumn("_carried", F.last("_top", ignorenulls=True).over(far)).drop("_top")
    found = rows.withColumn("_near", F.last("_value", ignorenulls=True).over(near)).join(tops, [*keys, "_block"])
    return found.withColumn(name, F.coalesce("_near", "_carried")).drop("_block", "_value", "_near", "_carried")


def _parents(parsed: DataFrame) -> DataFrame:
    """(conv_id, turn, source): for messages with quotes, the earlier message that they come from."""
    quoting = cut(parsed.where("conv_id IS NOT NULL AND turn IS NOT NULL AND n_quoted > 0").select("conv_id", "turn", F.monotonically_increasing_id().alias("message"), F.explode("passages").alias("p")), "passages")
    if quoting.first() is None:
        return quoting.select("conv_id", "turn", F.col("turn").alias("source"))
    width = F.least(F.size("p.words"), F.lit(WIDTH))
    runs = quoting.select("conv_id", "turn", "message", "p.place", "p.level", F.size("p.words").alias("size"), F.explode(F.array_distinct(_runs(F.col("p.words"), width))).alias("h"))
    wanted = cut(runs.select("conv_id", "h").distinct(), "wanted")
    # plain words of conversations that quote at all, in runs of all lengths up to WIDTH; the wanted ones stay
    plain = parsed.where("turn IS NOT NULL").join(wanted.select("conv_id").distinct(), "conv_id", "left_semi").select("conv_id", "turn", _words(F.col("content")).alias("words"))
    every = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(WIDTH)), lambda w: _runs(F.col("words"), w)))
    originals = plain.select("conv_id", "turn", F.explode(F.array_distinct(every)).alias("h")).join(wanted, ["conv_id", "h"], "left_semi").distinct()
    # the latest original before each quoted run, without a pair for each of them
    asked = runs.select("conv_id", "turn", "h").distinct().withColumn("quotes", F.lit(True))
    both = asked.join(originals.withColumn("holds", F.lit(True)), ["conv_id", "h", "turn"], "full")
    found = _last_before(both, ["conv_id", "h"], "turn", F.when(F.col("holds"), F.col("turn")), "source").where("quotes AND source IS NOT NULL")
    hits = runs.join(found.select("conv_id", "turn", "h", "source"), ["conv_id", "turn", "h"]).groupBy("conv_id", "turn", "message", "place", "level", "size", "source").agg(F.count("*").alias("n"))
    best = hits.groupBy("conv_id", "turn", "message", "place", "level", "size").agg(F.max_by(F.struct("source", "n"), F.struct("n", "source")).alias("best"))
    told = runs.groupBy("message", "place").agg(F.count("*").alias("runs"))
    linked = best.join(told, ["message", "place"]).where(F.col("best.n") >= F.col("runs") * SHARE)
    votes = linked.groupBy("conv_id", "turn", F.col("best.source").alias("source")).agg(F.sum(F.when(F.col("level") == 1, F.col("size")).otherwise(0)).alias("outer"), F.sum("size").alias("n"))
    return votes.groupBy("conv_id", "turn").agg(F.max_by("source", F.struct("outer", "n", "source")).alias("source"))


def _places(tree: DataFrame) -> DataFrame:
    """(conv_id, turn, position) of the messages (conv_id, turn, reply_to, before) in the preorder of their conversation, from 0.

    Where each message answers the one before it, that is the order of turns, and
    its ranks are counted in blocks. Other conversations are ranked along the tour
    of their tree by pointer doubling: a number of steps that is logarithmic in the
    length of the longest conversation.
    """
    forked = cut(tree.where("reply_to <> before").select("conv_id").distinct(), "forked")
    plain = tree.join(forked, "conv_id", "left_anti").withColumn("block", F.floor(F.col("turn").cast("double") / BLOCK))
    sizes = plain.groupBy("conv_id", "block").agg(F.count("*").alias("n"))
    sizes = sizes.withColumn("earlier", F.coalesce(F.sum("n").over(Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    rank = F.row_number().over(Window.partitionBy("conv_id", "block").orderBy("turn")) - 1
    plain = plain.withColumn("rank", rank).join(sizes, ["conv_id", "block"]).select("conv_id", "turn", (F.col("rank") + F.col("earlier")).cast("long").alias("position"))
    nodes = cut(tree.join(forked, "conv_id", "left_semi").select("conv_id", "turn", "reply_to"), "nodes")
    if nodes.first() is None:
        return plain
    # the tour enters (1) and leaves (0) each message; a message is entered after it the next of its parent's, or the parent is left
    answers = nodes.where("reply_to IS NOT NULL").withColumn("back", -F.col("turn").cast("long"))
    after = _last_before(answers, ["conv_id", "reply_to"], "back", F.col("turn"), "sibling").drop("back").unionByName(nodes.where("reply_to IS NULL"), allowMissingColumns=True)
    first = nodes.where("reply_to IS NOT NULL").groupBy("conv_id", F.col("reply_to").alias("turn")).agg(F.min("turn").alias("child"))
    nodes = cut(after.join(first, ["conv_id", "turn"], "left"), "tour")
    none = F.lit(None).cast("struct<turn:bigint,inside:int>")
    node = lambda c, inside: F.struct(F.col(c).cast("long").alias("turn"), F.lit(inside).alias("inside"))
    entered = nodes.select("conv_id", node("turn", 1).alias("at"), F.when(F.col("child").isNotNull(), node("child", 1)).otherwise(node("turn", 0)).alias("next"), F.lit(1).cast("long").alias("left"))
    left = nodes.select("conv_id", node("turn", 0).alias("at"), F.when(F.col("sibling").isNotNull(), node("sibling", 1)).when(F.col("reply_to").isNotNull(), node("reply_to", 0)).otherwise(none).alias("next"), F.lit(0).cast("long").alias("left"))
    tour = cut(entered.unionByName(left), "tour")
    while tour.where("next IS NOT NULL").first() is not None:
        ahead = tour.select("conv_id", F.col("at").alias("next"), F.col("next").alias("further"), F.col("left").alias("more"))
        tour = cut(tour.join(ahead, ["conv_id", "next"], "left").select("conv_id", "at", F.col("further").alias("next"), (F.col("left") + F.coalesce("more", F.lit(0))).alias("left")), "tour")
    total = nodes.groupBy("conv_id").agg(F.count("*").alias("total"))
    ranked = tour.where("at.inside = 1").join(total, "conv_id").select("conv_id", F.col("at.turn").alias("turn"), (F.col("total") - F.col("left")).alias("position"))
    return plain.unionByName(ranked)


def link_quotes(messages: DataFrame) -> DataFrame:
    """One row per message: conv_id, turn, role, content, n_quoted, max_level, reply_to, linked, position.

    `content` is the text without quoted lines (and without the blank lines that
    they leave at both ends), `n_quoted` its number of quoted lines, `max_level`
    the deepest level. `reply_to` is the turn of the earlier message that most
    words of the level-1 passages come from (the latest on ties; any level if no
    passage of level 1 is found), `linked` tells so. A passage comes from the
    message that has most of its runs of words, half of them at least; of a run
    that stands in several messages, the latest before the quote counts. Else
    `reply_to` is the last turn before that exists, or null for the first.
    `position` is the message's place in the reply-ordered conversation, from 0.
    Messages that repeat a (conv_id, turn) are rows of their own with one parent
    and one place; a null conv_id or turn links with nothing and has none. Null
    texts are empty. Other columns are left out. turn: whole numbers.
    """
    with tables(messages.sparkSession):
        return _linked(messages)


def _linked(messages: DataFrame) -> DataFrame:
    rows = messages.select("conv_id", "turn", "role", parse_lines(F.col("text")).alias("lines"))
    quoted = F.filter("lines", lambda x: x["level"] > 0)
    plain = F.filter("lines", lambda x: x["level"] == 0)
    content = F.regexp_replace(F.array_join(F.transform(plain, lambda x: x["body"]), "\n"), r"^(?:[ \t]*\n)+|(?:\n[ \t]*)+$", "")
    parsed = cut(
        rows.select(
            "conv_id", "turn", "role", content.alias("content"), F.size(quoted).cast("long").alias("n_quoted"),
            F.coalesce(F.array_max(F.transform("lines", lambda x: x["level"])), F.lit(0)).cast("long").alias("max_level"), "lines",
        ).withColumn("passages", F.when(F.col("n_quoted") > 0, passages(F.col("lines")))).drop("lines"),
        "messages", keep=True,
    )
    parents = cut(_parents(parsed), "parents")
    turns = parsed.where("conv_id IS NOT NULL AND turn IS NOT NULL").select("conv_id", "turn").distinct()
    known = _last_before(turns, ["conv_id"], "turn", F.col("turn"), "before").join(parents, ["conv_id", "turn"], "left")
    tree = cut(known.select("conv_id", "turn", "before", F.coalesce("source", "before").alias("reply_to"), F.col("source").isNotNull().alias("linked")), "replies")
    found = cut(tree.drop("before").join(_places(tree), ["conv_id", "turn"]), "places", keep=True)
    return parsed.drop("passages").join(found, ["conv_id", "turn"], "left").select("conv_id", "turn", "role", "content", "n_quoted", "max_level", F.col("reply_to").cast("long").alias("reply_to"), F.coalesce("linked", F.lit(False)).alias("linked"), "position")
