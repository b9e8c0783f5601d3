"""Conversations as training text in a chat template, held to a round trip through a grammar.

A conversation is written turn by turn as ``<|im_start|>role``, a new line, the text, ``<|im_end|>``, a new line.  The
grammar is deterministic: every start mark opens a turn, the first new line after it ends the role, the next end mark
must be followed by a new line that ends the turn, and nothing stands between turns.  Texts come back with one backslash
less in every mark that has backslashes after ``<|``; roles also with their new lines.

A turn is first written as it is and parsed again.  If what comes back is not the turn itself, it holds something that
conflicts with the grammar; its marks then get one more backslash each (``<|\\im_end|>``), in roles new lines are written
as backslash n, and it is parsed again.  The whole conversation is parsed once more after it is put together.  A turn or
a conversation that still differs fails the job, so nothing is written that reads back as something else.

The loss mask is a list of byte ranges of the formatted text, the texts of assistant turns; byte ranges let a reader cut
them out without looking at what stands before.

Turns are put in order by a sort within the conversations' partition, where the ranges come from a running sum, so a
long conversation takes time in proportion to its length; it is one row of the output, which bounds its length.

Edge cases.  Null roles and texts are empty.  Turns come in order of ``turn``, null first; equal ``turn``s in order of role
and text; rows that repeat are turns of their own.  Rows with a null conv_id are one conversation.  An empty table gives
none.  Columns other than conv_id, turn, role and text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from moodtape.llm.common import whole_text

START, END, TRAINED = "<|im_start|>", "<|im_end|>", "assistant"
_MARK, _ESCAPED = r"<\|(\\*im_(?:start|end)\|>)", r"<\|\\(\\*im_(?:start|end)\|>)"


def escaped(text: Column) -> Column:
    """The text with one backslash more in each of its marks."""
    return F.regexp_replace(text, _MARK, r"<|\\$1")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "<|$1")


def escaped_role(role: Column) -> Column:
    """On one line: backslashes are doubled, new lines become backslash n; then the marks are escaped."""
    return escaped(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescaped_role(role: Column) -> Column:
    """The reverse; a role without backslashes is as it is."""
    parts = F.transform(F.split(unescaped(role), r"\\\\"), lambda p: F.replace(p, F.lit("\\n"), F.lit("\n")))
    return F.array_join(parts, "\\")


def rendered(role: Column, text: Column, level: Column) -> Column:
    """One turn in the template, as it is (level 0) or with what conflicts escaped (level 1)."""
    as_is = level == 0
    shown = F.when(as_is, role).otherwise(escaped_role(role)), F.when(as_is, text).otherwise(escaped(text))
    return F.concat(F.lit(START), shown[0], F.lit("\n"), shown[1], F.lit(f"{END}\n"))


def parsed(formatted: Column) -> Column:
    """The turns (role, text) of a formatted text; null where it does not follow the grammar."""
    pieces = F.split(formatted, r"<\|im_start\|>")
    turns = F.slice(pieces, F.lit(2), F.size(pieces))
    stop = f"{END}\n"

    def follows(piece: Column) -> Column:
        line, end = F.instr(piece, "\n"), F.locate(END, piece)
        return (line > 0) & (line < end) & piece.endswith(stop) & (end == F.char_length(piece) - len(stop) + 1)

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, "\n", 1)
        start = F.char_length(role) + 2
        text = F.substring(piece, start, F.char_length(piece) - start + 1 - len(stop))
        return F.struct(unescaped_role(role).alias("role"), unescaped(text).alias("text"))

    return F.when((pieces[0] == "") & F.forall(turns, follows), F.transform(turns, turn))


def _level(role: Column, text: Column) -> Column:
    """The first level at which the turn reads back as itself."""
    source = F.array(F.struct(role.alias("role"), text.alias("text")))

    def reads_back(level: int) -> Column:
        return F.coalesce(parsed(rendered(role, text, F.lit(level))) == source, F.lit(False))

    plain = ~F.contains(text, F.lit("<|")) & ~F.contains(role, F.lit("\n")) & ~F.contains(role, F.lit("\\")) & ~F.contains(role, F.lit("<|"))
    failed = F.raise_error(F.concat(F.lit("a turn does not read back: "), role)).cast("int")
    return F.when(plain, 0).when(reads_back(0), 0).when(reads_back(1), 1).otherwise(failed)


def format_conversations(conversations: DataFrame, key="conv_id", turn="turn", role="role", text="text", trained: str = TRAINED) -> DataFrame:
    """conv_id, formatted, loss (start, length in bytes) of every conversation."""
    rows = conversations.select(
        F.col(key).alias("conv_id"), F.col(turn).alias("turn"), whole_text(F.col(role)).alias("role"), whole_text(F.col(text)).alias("text")
    ).repartition("conv_id")
    rows = rows.withColumn("level", _level(F.col("role"), F.col("text")))
    written = F.octet_length(rendered(F.col("role"), F.col("text"), F.col("level")))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("nth", F.row_number().over(order)).withColumn("start", F.coalesce(F.sum(written).over(before), F.lit(0)))
    held = F.struct("nth", "start", "role", "text", "level")
    turns = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(held)).alias("turns"))
    formatted = F.array_join(F.transform("turns", lambda t: rendered(t.role, t.text, t.level)), "")

    def loss(t: Column) -> Column:
        head = F.octet_length(F.when(t.level == 0, t.role).otherwise(escaped_role(t.role))) + len(START) + 1
        length = F.octet_length(F.when(t.level == 0, t.text).otherwise(escaped(t.text)))
        return F.struct((t.start + head).cast("int").alias("start"), length.cast("int").alias("length"))

    spans = F.transform(F.filter("turns", lambda t: t.role == trained), loss)
    source = F.transform("turns", lambda t: F.struct(t.role.alias("role"), t.text.alias("text")))
    same = F.coalesce(parsed(F.col("formatted")) == source, F.lit(False))
    failed = F.raise_error(F.concat(F.lit("a conversation does not read back: "), F.col("conv_id").cast("string"))).cast("string")
    made = turns.withColumn("formatted", formatted)
    return made.select("conv_id", F.when(same, F.col("formatted")).otherwise(failed).alias("formatted"), spans.alias("loss"))


def write_formatted(conversations: DataFrame, path: str, **columns: str) -> None:
    format_conversations(conversations, **columns).write.option("compression", "zstd").parquet(path)


def read_formatted(spark: SparkSession, path: str) -> DataFrame:
    """conv_id, formatted, turns, trained: the formatted text, the turns in it and the texts under the loss mask."""
    rows = spark.read.parquet(path)
    raw = F.col("formatted").cast("binary")
    trained = F.transform("loss", lambda span: unescaped(F.substring(raw, span.start + 1, span.length).cast("string")))
    return rows.select("conv_id", "formatted", parsed(F.col("formatted")).alias("turns"), trained.alias("trained"))


def format_report(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars of what ``read_formatted`` reads."""
    said = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    trained = F.array_join("trained", "")
    return formatted.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.char_length(trained).cast("long").alias("loss_chars"),
        F.sha2(trained.cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
