"""Quotation linking in conversations (DataFrame functions only).

Lines that begin with ``>`` are quotations, nested as deep as they have marks. A
quoted line is normalised (marks and outer white space off, white space folded,
lower case), hashed and joined to the earliest message of the conversation that
has the line as its own. A message answers the message that most of its least
deeply quoted lines come from. Threads follow from the answers by pointer
doubling, and messages come out without quotations, with keys of reply order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import barrier, staged

_MARKS = r"^[ \t]*(>[ \t]*)+"
#: A line that only introduces a quotation ("On Monday X wrote:"), dropped before one.
_INTRO = r"(?i)(wrote|writes|said|schrieb|a écrit|escribió):[ \t]*$"


def _quoted(line: Column) -> Column:
    return line.rlike(r"^[ \t]*>")


def _level(line: Column) -> Column:
    return F.length(F.translate(F.regexp_extract(line, _MARKS, 0), " \t", ""))


def normalise(line: Column) -> Column:
    """A line without quotation marks, in lower case, white space folded and trimmed."""
    return F.trim(F.regexp_replace(F.lower(F.regexp_replace(line, _MARKS, "")), r"[ \t\r\x0B\x0C]+", " "))


def read(messages: DataFrame, conv: str, turn: str, text: str) -> DataFrame:
    """``messages`` plus ``__c_lines`` (their lines)."""
    return barrier(messages, __c_conv=F.coalesce(messages[conv].cast("string"), F.lit("")), __c_turn=messages[turn].cast("bigint"),
                   __c_lines=F.split(F.coalesce(messages[text], F.lit("")), "\n"))


def own_text(lines: Column) -> Column:
    """The lines that are not quoted and do not introduce a quotation, trimmed at both ends."""
    kept = F.filter(lines, lambda x, i: ~_quoted(x) & ~(x.rlike(_INTRO) & F.coalesce(_quoted(F.get(lines, i + 1)), F.lit(False))))
    return F.regexp_replace(F.array_join(kept, "\n"), r"^[ \t\r\n]+|[ \t\r\n]+$", "")


def answers(lined: DataFrame) -> DataFrame:
    """``conv``, ``turn``, ``parent``: the message that each quoting message answers.

    Only quoted lines and the first owners of their hashes are joined. A line
    that many messages have is reduced to its earliest owner before the join,
    and lines are counted before a parent is chosen: no pairs of messages arise.
    """
    # the mark is tested before a line is laid out: most messages quote nothing
    quoted = (lined.where(F.exists("__c_lines", _quoted)).select(F.col("__c_conv").alias("conv"), F.col("__c_turn").alias("turn"), F.explode("__c_lines").alias("line"))
              .where(_quoted(F.col("line"))).select("conv", "turn", _level(F.col("line")).alias("level"), normalise(F.col("line")).alias("line"))
              .where("line <> '' AND turn IS NOT NULL").groupBy("conv", "turn", "level", F.sha2(F.col("line").cast("binary"), 256).alias("h")).agg(F.count("*").alias("n")))
    quoted = staged(quoted, "quoted")
    wanted = quoted.select("conv", "h").distinct()
    plain = (lined.select(F.col("__c_conv").alias("conv"), F.col("__c_turn").alias("turn"), F.explode("__c_lines").alias("line")).where("turn IS NOT NULL")
             .where(~_quoted(F.col("line"))).select("conv", "turn", normalise(F.col("line")).alias("line")).where("line <> ''")
             .select("conv", "turn", F.sha2(F.col("line").cast("binary"), 256).alias("h")))
    owners = plain.join(wanted, ["conv", "h"], "left_semi").groupBy("conv", "h").agg(F.min("turn").alias("parent"))
    matched = quoted.join(owners, ["conv", "h"]).where("parent < turn").groupBy("conv", "turn", "level", "parent").agg(F.sum("n").alias("n"))
    # least level, then most lines, then the latest message
    best = F.max(F.struct((-F.col("level")).alias("l"), F.col("n"), F.col("parent")))
    return matched.groupBy("conv", "turn").agg(best.alias("b")).select("conv", "turn", F.col("b.parent").alias("parent"))


def threads(links: DataFrame) -> DataFrame:
    """``conv``, ``turn``, ``thread``, ``depth`` of every answering message, by pointer doubling.

    The rounds are the logarithm of the longest chain; each is written to the
    shared folder.
    """
    at = staged(links.select("conv", "turn", F.col("parent").alias("up"), F.lit(1).cast("bigint").alias("depth")), "threads")
    while True:
        above = at.select("conv", F.col("turn").alias("up"), F.col("up").alias("up2"), F.col("depth").alias("d2"))
        step = staged(at.join(above, ["conv", "up"], "left").select("conv", "turn", F.coalesce("up2", "up").alias("up"),
                                                                    (F.col("depth") + F.coalesce("d2", F.lit(0))).alias("depth"), F.col("up2").isNotNull().alias("moved")), "threads")
        if step.where("moved").isEmpty():
            return step.select("conv", "turn", F.col("up").alias("thread"), "depth")
        at = step.drop("moved")


def link(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv``, ``turn``, ``role``, ``n_quoted``, ``quote_depth``, ``parent_turn``, ``thread_turn``, ``depth``, ``own_text``.

    One row per message; ordering a conversation by ``thread_turn`` and ``turn``
    puts every answer behind what it answers. A message that quotes no earlier
    message of its conversation begins a thread (no parent, depth 0). A null or
    empty text has no lines; a null turn neither answers nor is answered; null
    and empty conversations are one; rows that share conversation and turn are
    one message with several texts. Other columns are dropped. An empty table
    gives no rows; a very long text is split into lines within its row.
    """
    lined = read(messages.select(messages[conv], messages[turn], messages[role], messages[text]), conv, turn, text)
    links = staged(answers(lined), "answers")
    tree = links.join(threads(links), ["conv", "turn"])
    tree = tree.select(F.col("conv").alias("__c_conv"), F.col("turn").alias("__c_turn"), "parent", "thread", "depth")
    lines = F.col("__c_lines")
    return lined.join(tree, ["__c_conv", "__c_turn"], "left").select(
        F.col(conv), F.col(turn), F.col(role), F.size(F.filter(lines, _quoted)).cast("bigint").alias("n_quoted"),
        F.coalesce(F.array_max(F.transform(lines, _level)), F.lit(0)).cast("bigint").alias("quote_depth"), F.col("parent").alias("parent_turn"),
        F.coalesce("thread", "__c_turn").alias("thread_turn"), F.coalesce("depth", F.lit(0)).cast("bigint").alias("depth"), own_text(lines).alias("own_text"))
