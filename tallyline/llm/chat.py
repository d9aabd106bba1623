"""Chat formatting in budgeted windows, in column expressions only.

Turns are written with marks around them, ``<|im_start|>role``, a line feed, the text, ``<|im_end|>``
and a line feed. Inside roles and texts ``<|``, also with backslashes between the two characters, gets
one more backslash there, so no text can hold a mark, and taking it away again restores every text.

A conversation is cut into windows of ``budget`` tokens at turn boundaries. With the tokens of its turns
summed up from the first one, the line of tokens falls into slots of ``room`` (the budget less the system
turn and the history). Turns inside a slot are one window. A turn that crosses into a slot joins the
window there if both fit into ``room`` together, else it has a window of its own. So a window is over the
budget only where a turn (or the system turn) is longer than what is left for it; ``n_tokens`` tells. All
this depends on sums, not on the window before, and needs no pass over a whole conversation.

Each window begins with the system turn, if the conversation opens with one, then repeats the turns
directly before it, up to ``history`` tokens. The loss mask, spans of code points, covers the texts of
assistant turns and leaves out all that is repeated, so each is learned once.

Turns stand in the order of their number, nulls first; those of one number by a hash of role and text.
Repeated rows are turns of their own. Null roles and texts are empty. An empty table gives no window.
Only the four columns are read, so other columns' names cannot clash; rows without a conversation id
are one conversation.

A conversation of more than ``hot_turns`` turns (a third of all rows may be one) is not brought into one
task: its turns are sorted into segments by range, sums are carried over by one row per segment, and
turns within ``history`` of a segment's end are given to the next one to repeat. No window crosses such a cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.llm.common import Stored

BUDGET, HISTORY, HOT_TURNS = 1024, 256, 10_000
#: Tokens that the marks of a turn cost.
MARKS = 4
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def escape(text: Column) -> Column:
    """The text without a mark in it."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    """What :func:`escape` was given."""
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _escape_role(role: Column) -> Column:
    """A role ends at the first line feed, so it may not hold one."""
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def _unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def count_tokens(text: Column) -> Column:
    """Tokens as estimated by length: four letters, three digits or one other sign each, white space for free."""
    pieces = F.regexp_replace(text, r"\s*(?:\p{L}{1,4}|\p{N}{1,3}|[^\s\p{L}\p{N}])", "x")
    return F.length(pieces).cast("long")


def windows(
    turns: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    budget: int = BUDGET,
    history: int = HISTORY,
    hot_turns: int = HOT_TURNS,
) -> DataFrame:
    """``conv, window, formatted, loss, n_turns, n_repeated, n_tokens`` for every window.

    ``window`` is the number of tokens before it and orders the windows of a conversation. The first
    ``n_repeated`` of the ``n_turns`` turns in it are repeated: the system turn, then the history.
    ``loss`` has the spans ``start, end`` of the formatted text, in code points, that are to be learned.
    """
    if not 0 <= history < budget:
        raise ValueError("the history is a part of the budget")
    role_text, body = F.coalesce(F.col(role).cast("string"), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    rows = turns.select(
        F.col(conv).alias("conv"),
        F.col(turn).alias("turn"),
        F.xxhash64(role_text, body).alias("tie"),
        role_text.alias("role"),
        F.concat(F.lit(OPEN), _escape_role(role_text), F.lit("\n")).alias("head"),
        escape(body).alias("said"),
        (count_tokens(role_text) + count_tokens(body) + MARKS).alias("tokens"),
    )
    sizes = turns.groupBy(F.col(conv).alias("conv")).agg(F.count("*").alias("n"))
    hot = sizes.where(F.col("n") > hot_turns).select(F.col("conv").alias("large"))
    same = F.col("conv").eqNullSafe(F.col("large"))
    if hot.isEmpty():
        out = _cut(_summed(rows), ["conv"], budget, history)
    else:
        usual = _cut(_summed(rows.join(hot, same, "left_anti")), ["conv"], budget, history)
        large = _segments(rows.join(hot, same, "left_semi"), history)
        out = usual.unionByName(_cut(large, ["conv", "segment"], budget, history))
    return out.withColumnRenamed("conv", conv)


def _order(*keys: str):
    return Window.partitionBy(*keys).orderBy("turn", "tie", "role", "said").rowsBetween(Window.unboundedPreceding, 0)


_TURN = ("role", "head", "said", "tokens")


def _summed(rows: DataFrame) -> DataFrame:
    """Adds ``is_system``, the ``system`` turn and ``c``, the tokens before the turn; the system turn takes none."""
    order = _order("conv")
    first = F.first(F.struct(*_TURN)).over(order)
    rows = rows.withColumns(
        {
            "is_system": (F.row_number().over(order) == 1) & (F.col("role") == "system"),
            "system": F.when(first["role"] == "system", first),
        }
    )
    mine = F.when(F.col("is_system"), F.lit(0)).otherwise(F.col("tokens")).cast("long")
    return rows.withColumn("c", F.sum(mine).over(order) - mine).withColumn("before", F.lit(False))


def _segments(rows: DataFrame, history: int) -> DataFrame:
    """What :func:`_summed` adds, for conversations that are too large for a task, by segments."""
    store = Stored(rows.sparkSession)
    ranged = rows.withColumn("id", F.monotonically_increasing_id()).repartitionByRange("conv", "turn", "tie", "id")
    rows = store.put(ranged.withColumn("segment", F.spark_partition_id()).drop("id"), "segments")
    order = _order("conv", "segment")
    rows = rows.withColumn("place", F.row_number().over(order))
    # One row per conversation and segment from here on; only a conversation at a boundary has two or more.
    sums = rows.groupBy("conv", "segment").agg(
        F.sum("tokens").alias("sum"), F.max(F.when(F.col("place") == 1, F.struct(*_TURN))).alias("first")
    )
    line = Window.partitionBy("conv").orderBy("segment")
    opening = F.first("first").over(line)
    sums = sums.withColumns(
        {
            "system": F.when(opening["role"] == "system", opening),
            "opens": F.row_number().over(line) == 1,
            "next": F.lead("segment").over(line),
        }
    )
    own = F.col("sum") - F.when(F.col("opens") & F.col("system").isNotNull(), F.col("system.tokens")).otherwise(F.lit(0))
    sums = sums.withColumn("until", F.sum(own).over(line)).withColumn("from", F.col("until") - own)
    sums = store.put(sums.drop("sum", "first"), "sums").withColumnsRenamed({"conv": "c_conv", "segment": "c_segment"})
    rows = rows.join(sums, F.col("conv").eqNullSafe(F.col("c_conv")) & (F.col("segment") == F.col("c_segment")))
    rows = rows.withColumn("is_system", F.col("opens") & (F.col("place") == 1) & F.col("system").isNotNull())
    mine = F.when(F.col("is_system"), F.lit(0)).otherwise(F.col("tokens")).cast("long")
    rows = rows.withColumn("c", F.col("from") + F.sum(mine).over(order) - mine).withColumn("before", F.lit(False))
    kept = [*rows.columns[: rows.columns.index("place")], "is_system", "system", "c", "before"]
    ends = rows.where(~F.col("is_system") & F.col("next").isNotNull() & (F.col("c") >= F.col("until") - history))
    ends = ends.withColumns({"segment": F.col("next"), "before": F.lit(True)})
    return rows.select(*kept).unionByName(ends.select(*kept))


def _cut(rows: DataFrame, keys: list[str], budget: int, history: int) -> DataFrame:
    """Windows of turns with ``c``; what is ``before`` is there to be repeated only."""
    for_system = F.coalesce(F.col("system.tokens"), F.lit(0))
    rows = rows.withColumn("room", F.greatest(F.lit(budget - history) - for_system, F.lit(max(1, budget // 4))).cast("long"))
    rows = rows.withColumn("e", F.col("c") + F.when(F.col("is_system"), F.lit(0)).otherwise(F.col("tokens")).cast("long"))
    rows = rows.withColumn("slot", F.expr("c div room"))
    rows = rows.withColumn("crosses", F.col("e") > (F.col("slot") + 1) * F.col("room"))
    rows = rows.withColumn("slot", F.when(F.col("crosses"), F.expr("e div room")).otherwise(F.col("slot")))
    here = Window.partitionBy(*keys, "slot")
    plain = ~F.col("is_system") & ~F.col("before")
    rows = rows.withColumns(
        {
            "enters": F.min(F.when(plain & F.col("crosses"), F.col("c"))).over(here),
            "inside": F.min(F.when(plain & ~F.col("crosses"), F.col("c"))).over(here),
            "leaves": F.max(F.when(plain & ~F.col("crosses"), F.col("e"))).over(here),
        }
    )
    together = F.coalesce(F.col("leaves") - F.col("enters") <= F.col("room"), F.lit(False))
    # A window is named by the tokens before its first turn; the system turn belongs to the first one.
    window = (
        F.when(F.col("is_system"), F.lit(0).cast("long"))
        .when(F.col("crosses") | together, F.col("enters"))
        .otherwise(F.col("inside"))
    )
    rows = rows.withColumn("window", F.when(~F.col("before"), window))
    starts = F.when(plain & (F.col("c") == F.col("window")), F.col("window"))
    line = Window.partitionBy(*keys).orderBy("c").rangeBetween(1, history)
    later = F.collect_list(starts).over(line) if history else F.array().cast("array<bigint>")
    rows = rows.withColumn("later", F.when(F.col("is_system"), F.array().cast("array<bigint>")).otherwise(later))
    mine = F.when(F.col("before"), F.array().cast("array<bigint>")).otherwise(F.array("window"))
    placed = rows.select(
        *keys,
        F.when(F.col("is_system"), F.lit(-1).cast("long")).otherwise(F.col("c")).alias("n"),
        *_TURN,
        "system",
        F.col("window").alias("own"),
        F.explode(F.concat(mine, "later")).alias("window"),
    )
    own = F.coalesce(F.col("own") == F.col("window"), F.lit(False))
    entry = F.struct("n", own.alias("own"), *_TURN)
    grouped = placed.groupBy(*keys, "window").agg(
        F.sort_array(F.collect_list(entry)).alias("turns"), F.first("system").alias("system")
    )
    again = F.struct(F.lit(-1).cast("long").alias("n"), F.lit(False).alias("own"), *[F.col(f"system.{c}").alias(c) for c in _TURN])
    with_system = F.when((F.col("window") > 0) & F.col("system").isNotNull(), F.concat(F.array(again), "turns"))
    grouped = grouped.withColumn("turns", F.coalesce(with_system, "turns"))
    return grouped.select(
        "conv",
        "window",
        F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["said"], F.lit(CLOSE))), "").alias("formatted"),
        _loss(F.col("turns")).alias("loss"),
        F.size("turns").cast("long").alias("n_turns"),
        F.size(F.filter("turns", lambda t: ~t["own"])).cast("long").alias("n_repeated"),
        F.aggregate("turns", F.lit(0).cast("long"), lambda total, t: total + t["tokens"]).alias("n_tokens"),
    )


def _loss(turns: Column) -> Column:
    """The spans of the texts of assistant turns that are not repeated."""
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")

    def add(state: Column, t: Column) -> Column:
        start = state["at"] + F.length(t["head"])
        end = start + F.length(t["said"])
        learn = t["own"] & (t["role"] == "assistant")
        span = F.struct(start.cast("long").alias("start"), end.cast("long").alias("end"))
        return F.struct(
            (end + len(CLOSE)).cast("long").alias("at"),
            F.when(learn, F.array_append(state["spans"], span)).otherwise(state["spans"]).alias("spans"),
        )

    start = F.struct(F.lit(0).cast("long").alias("at"), none.alias("spans"))
    return F.aggregate(turns, start, add, lambda state: state["spans"])


def read_turns(formatted: Column, skip: Column | int = 0) -> Column:
    """``array<struct<role, text>>`` of a formatted text without its first ``skip`` turns."""
    first = F.lit(skip) if isinstance(skip, int) else skip
    whole = F.filter(F.split(formatted, r"<\|im_end\|>\n", -1), lambda piece, i: (piece != "") & (i >= first))
    return F.transform(
        whole,
        lambda piece: F.struct(
            _unescape_role(F.substr(F.substring_index(piece, "\n", 1), F.lit(len(OPEN) + 1))).alias("role"),
            unescape(F.substr(piece, F.length(F.substring_index(piece, "\n", 1)) + 2)).alias("text"),
        ),
    )


def read_loss(formatted: Column, loss: Column) -> Column:
    """The texts under the mask, as they were before they were escaped."""
    return F.transform(loss, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
