"""Chat formatting by quotation linking.

Quoted lines (``>`` marks, nested) are parsed to level and text. Each run of
lines of one level is a passage: normalised with white space and line breaks
folded, hashed, and joined to the passages of the conversation's earlier
messages; the latest earlier message that wrote it is its source. The lines of
a passage that nobody wrote as a whole are joined singly, each to the message
that wrote it first. The message that is the source of most lines quoted at the
outermost level is the parent. Threads are found by pointer doubling over parents; a conversation in
reply order is its messages by (thread, turn), since a parent's turn is always
smaller. What is quoted is cut from the texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearth.llm.common import written

QUOTED = r"(?m)^[ \t]*>"
MARKS = r"^([ \t]*>)+"
#: A line that announces a quotation right below it.
ATTRIBUTION = r"(?m)^[^\n>]*\b(wrote|writes|schrieb|a écrit|escribió):[ \t]*\n(?=[ \t]*>)"


def own_text(text: Column) -> Column:
    """The text without quoted lines and the lines that announce them; untouched if nothing is quoted."""
    cut = F.regexp_replace(F.regexp_replace(text, ATTRIBUTION, ""), r"(?m)^[ \t]*>[^\n]*(\n|\z)", "")
    return F.when(text.rlike(QUOTED), F.btrim(F.regexp_replace(cut, r"\n{3,}", "\n\n"), F.lit("\n \t"))).otherwise(text)


def passages(messages: DataFrame) -> DataFrame:
    """(conv, turn, level, hash, lines) of every run of lines of one level; level 0 is the message's own.

    ``lines`` are the hashes of the run's lines. Lines without letters or digits
    belong to no run and part none.
    """
    def parsed(line: Column) -> Column:
        marks = F.regexp_extract(line, MARKS, 0)
        body = F.btrim(F.regexp_replace(F.lower(F.regexp_replace(line, MARKS, "")), r"\s+", " "))
        return F.struct((F.length(marks) - F.length(F.replace(marks, F.lit(">"), F.lit("")))).alias("level"), body.alias("body"))

    said = F.filter(F.transform(F.split("text", "\n", -1), parsed), lambda x: x["body"].rlike(r"[\p{L}\p{N}]"))
    # one-element explodes hold the arrays, which later expressions use several times
    held = messages.select("conv", "turn", F.explode(F.array(said)).alias("said")).where(F.size("said") > 0)
    begins = F.filter(F.sequence(F.lit(0), F.size("said") - 1), lambda i: (i == 0) | (F.col("said")[i]["level"] != F.col("said")[F.greatest(i - 1, F.lit(0))]["level"]))
    held = held.select("conv", "turn", "said", F.explode(F.array(begins)).alias("begins"))
    run = held.select("conv", "turn", "said", F.posexplode("begins").alias("k", "at"), F.col("begins"))
    end = F.coalesce(F.get("begins", F.col("k") + 1), F.size("said"))
    run = run.select("conv", "turn", F.explode(F.array(F.slice("said", F.col("at") + 1, end - F.col("at")))).alias("run"))
    return run.select("conv", "turn", F.col("run")[0]["level"].alias("level"), F.sha2(F.array_join("run.body", " "), 256).alias("hash"),
                      F.transform("run.body", lambda body: F.sha2(body, 256)).alias("lines"))


def sources(quoted: DataFrame, own: DataFrame) -> DataFrame:
    """(conv, hash, turn, source) of the quoted passages: the latest earlier message that wrote the passage, null if there is none."""
    asked = quoted.select("conv", "hash", "turn").distinct()
    wrote = own.join(asked.select("conv", "hash").distinct(), ["conv", "hash"], "left_semi").select("conv", "hash", "turn").distinct()
    # in turn order, a message's quotations before its own text: the last writer so far is an earlier message
    both = asked.withColumn("wrote", F.lit(0)).unionByName(wrote.withColumn("wrote", F.lit(1)))
    so_far = Window.partitionBy("conv", "hash").orderBy("turn", "wrote").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (both.withColumn("source", F.last(F.when(F.col("wrote") == 1, F.col("turn")), ignorenulls=True).over(so_far))
            .where("wrote = 0").select("conv", "hash", "turn", "source"))


def parents(messages: DataFrame) -> DataFrame:
    """(conv, turn, parent, n_quoted, max_level) of the messages that quote; parent is null where no earlier message wrote the passages or lines.

    A passage belongs to the latest earlier message that wrote it, a line of a
    passage without such a message to the first one. Ties between parents go to
    the later message.
    """
    talk = written(messages.where("quotes").select(F.col("conv").alias("c")).distinct(), "quote-conversations")
    told = written(passages(messages.join(talk, F.col("conv") == F.col("c"), "left_semi")), "quote-passages")
    own, quoted = told.where("level = 0"), told.where("level > 0")
    found = written(quoted.join(written(sources(quoted, own), "quote-sources"), ["conv", "hash", "turn"], "left"), "quote-found")
    whole = found.where("source is not null").select("conv", "turn", "level", "source", F.size("lines").alias("n"))
    origin = own.select("conv", "turn", F.explode("lines").alias("line")).groupBy("conv", "line").agg(F.min("turn").alias("first"))
    single = (found.where("source is null").select("conv", "turn", "level", F.explode("lines").alias("line")).join(origin, ["conv", "line"], "left")
              .select("conv", "turn", "level", F.when(F.col("first") < F.col("turn"), F.col("first")).alias("source"), F.lit(1).alias("n")))
    # nested marks name older messages; the outermost level that a message quotes names its parent
    votes = whole.unionByName(single).groupBy("conv", "turn", "level", "source").agg(F.sum("n").alias("n"))
    sums = votes.groupBy("conv", "turn").agg(
        F.sum("n").alias("n_quoted"), F.max("level").alias("max_level"),
        F.max(F.when(F.col("source").isNotNull(), F.struct((-F.col("level")).alias("l"), "n", "source")))["source"].alias("parent"))
    return sums.select("conv", "turn", "parent", "n_quoted", "max_level")


def threads(links: DataFrame) -> DataFrame:
    """(conv, turn, thread, depth) of the linked messages: the first message of the chain of parents, and its length."""
    chain = written(links.where("parent is not null").select("conv", "turn", F.col("parent").alias("thread"), F.lit(1).alias("depth")), "quote-chain")
    while True:
        up = chain.select(F.col("conv").alias("c"), F.col("turn").alias("t"), F.col("thread").alias("next"), F.col("depth").alias("more"))
        moved = chain.join(up, (F.col("conv") == F.col("c")) & (F.col("thread") == F.col("t")), "left")
        chain = written(moved.select("conv", "turn", F.coalesce("next", "thread").alias("thread"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
                                     F.col("next").isNotNull().alias("moved")), "quote-chain")
        done = chain.where("moved").isEmpty()
        chain = chain.drop("moved")
        if done:
            return chain


def link_conversations(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, turn, role, parent, thread, depth, n_quoted, max_level, text, rendered), one row for each input row.

    Ordering by (conv, thread, turn) gives every conversation in reply order:
    a thread begins with a message that quotes nothing found and holds all that
    answer it, directly or not. ``text`` is the message without quotations,
    ``rendered`` that text below a role header. Rows with a null conversation or
    turn have no parent and are their own thread; a null text is the empty one,
    a null role ``user``. Rows repeated under one turn get the same links. An
    empty table gives no rows; other columns are ignored.
    """
    base = messages.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("user")).alias("role"),
                           F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    named = base.where("conv is not null and turn is not null").withColumn("quotes", F.col("text").rlike(QUOTED))
    links = written(parents(named), "quote-links")
    place = links.join(threads(links), ["conv", "turn"], "left")
    found = base.join(place, ["conv", "turn"], "left")
    text = own_text(F.col("text"))
    return found.select("conv", "turn", "role", "parent", F.coalesce("thread", "turn").alias("thread"), F.coalesce("depth", F.lit(0)).alias("depth"),
                        F.coalesce("n_quoted", F.lit(0)).cast("bigint").alias("n_quoted"), F.coalesce("max_level", F.lit(0)).alias("max_level"),
                        text.alias("text"), F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n"), text, F.lit("\n")).alias("rendered"))
