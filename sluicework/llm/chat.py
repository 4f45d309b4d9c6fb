"""Chat formatting with a grammar round trip.

A conversation is written as its turns, one after the other:

    user        <s>[INST] text [/INST]
    assistant   <s>[ANSW] text </s>
    system      <s>[SYST] text [/SYST]
    any other   <s>[ROLE] name\\ntext [/ROLE]

A control string is "<s>", "</s>", or "[", an optional "/", one of the four words
and "]".  The parser is deterministic: a turn's head names its tail, the body ends
at the first tail, and in the body a backslash stands before a character that is
meant literally.  Every turn is rendered plainly first and parsed again.  Where
the parser does not return the turn's role and text, its control strings and
backslashes are escaped, and if that does not do either, every bracket and
backslash; the first rendering that reparses to the source is kept, and what was
compared is the text of the whole conversation once its turns are joined.

All of it is SQL expressions: turns are rendered and escaped row by row, and only
finished strings are gathered per conversation.

Defined results: null texts and roles are empty; turns go by number, then role,
then text, null numbers first; rows with a null conversation id form one
conversation; repeated rows are repeated turns; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Template words, fixed.
HEADS = {"user": "INST", "assistant": "ANSW", "system": "SYST"}
OTHER = "ROLE"
WORDS = "INST|ANSW|SYST|ROLE"
CONTROL = rf"</?s>|\[/?(?:{WORDS})\]"
TAILS = {"INST": " [/INST]", "ANSW": " </s>", "SYST": " [/SYST]", "ROLE": " [/ROLE]"}
# A body: literal characters, or a backslash and the character it protects; no loop that backtracks.
BODY = r"(?:[^\\<\[]|\\.|<(?!/?s>)|\[(?!/?(?:INST|ANSW|SYST|ROLE)\]))*+"
# A role's name in a turn of another role: up to the first line feed that no backslash protects.
NAME = r"(?s)^(?:[^\\\n]|\\.)*+\n"
# Where a turn starts: a head that no backslash protects always follows a finished turn.
TURN = rf"(?s)<s>\[(?:{WORDS})\] {BODY}(?:</s>|\[/(?:{WORDS})\])"


def head_of(role: Column) -> Column:
    """The template word of a role."""
    found = F.lit(OTHER)
    for name, word in HEADS.items():
        found = F.when(role == name, word).otherwise(found)
    return found


def escape(text: Column, level: int) -> Column:
    """A text at an escaping level: 0 as it is, 1 control strings and backslashes, 2 every bracket and line feed too."""
    if level == 0:
        return text
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, CONTROL if level == 1 else r"[<\[\n]", r"\\$0")


def unescape(body: Column) -> Column:
    """The text that an escaped body stands for."""
    return F.regexp_replace(body, r"(?s)\\(.)", "$1")


def render(role: Column, text: Column, level: int) -> Column:
    """One turn as text."""
    word = head_of(role)
    tail = F.lit(TAILS[OTHER])
    for name in HEADS.values():
        tail = F.when(word == name, TAILS[name]).otherwise(tail)
    name = F.when(word == OTHER, F.concat(escape(role, 2), F.lit("\n"))).otherwise(F.lit(""))
    return F.concat(F.lit("<s>["), word, F.lit("] "), name, escape(text, level), tail)


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation, as an array of (role, text).

    Joined to its end, the result covers the whole string or the string is not of the grammar.
    """
    turns = F.regexp_extract_all(formatted, F.lit(TURN), F.lit(0))

    def turn(rendered: Column) -> Column:
        word = F.substring(rendered, 5, 4)
        rest = F.substr(rendered, F.lit(11), F.length(rendered) - 10 - F.when(word == "ANSW", 5).otherwise(8))
        cut = F.when(word == OTHER, F.length(F.regexp_extract(rest, NAME, 0))).otherwise(F.lit(0))
        role = F.when(word == OTHER, unescape(F.substr(rest, F.lit(1), cut - 1)))
        for name, known in HEADS.items():
            role = F.when(word == known, name).otherwise(role)
        return F.struct(role.alias("role"), unescape(F.substr(rest, cut + 1)).alias("text"))

    return F.transform(turns, turn)


def format_turns(table: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text") -> DataFrame:
    """(key, formatted, faithful): each conversation as one string, and whether it reparses to its source."""
    rows = table.select(
        F.col(key).alias("key"), F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    source = F.array(F.struct("role", "text"))
    # A text without a backslash or a control string is its own escape; only the rest needs the round trip.
    plain = ~F.col("text").rlike(r"[\\<\[]") & F.col("role").isin(*HEADS)
    tries = F.when(plain, render(F.col("role"), F.col("text"), 0))
    for level in (0, 1):
        once = render(F.col("role"), F.col("text"), level)
        tries = tries.when(parse(once) == source, once)
    rendered = rows.withColumn("rendered", tries.otherwise(render(F.col("role"), F.col("text"), 2)))
    turns = rendered.groupBy("key").agg(F.array_sort(F.collect_list(
        F.struct("turn", "role", "text", "rendered"))).alias("turns"))
    formatted = F.array_join(F.transform("turns", lambda t: t["rendered"]), "")
    told = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    joined = turns.select("key", formatted.alias("formatted"), told.alias("told"))
    return joined.select(F.col("key").alias(key), "formatted", (parse(F.col("formatted")) == F.col("told")).alias("faithful"))


def loss_text(turns: Column) -> Column:
    """What a model is trained on: the assistant's texts, in order, nothing between them."""
    return F.array_join(F.transform(F.filter(turns, lambda t: t["role"] == "assistant"), lambda t: t["text"]), "")
