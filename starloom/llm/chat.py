"""Chat formatting in budgeted windows, with DataFrame functions only.

Prefix sums of the turns' tokens choose the windows: the new turns of a window are those whose sum before them falls
into one stretch of ``PITCH`` tokens.  A turn of up to ``PITCH`` tokens may begin at the end of a stretch, so a window
has at most twice ``PITCH`` new tokens; a longer turn is a window of its own and is never cut.  Before its new turns a
window repeats the system turn of the conversation and as many of the turns just before as have ``HISTORY_TURNS`` and
``HISTORY_TOKENS`` at most.  Of a system turn of more than ``SYSTEM_TOKENS`` only the first words are repeated, so that,
but for the turn that is a window of its own, no window is beyond ``2 * PITCH + HISTORY_TOKENS + SYSTEM_TOKENS``.  Only
new assistant turns are under the loss mask, so every target counts once.

The turns of a conversation are summed by runs of ``RUN_TURNS`` turn numbers, so that a conversation of any length is
many groups.  A run has one narrow row, with its sums and its first turns' sizes; over these rows the sums go on from run
to run, and each run learns how the next ones begin.  Where runs end therefore changes no window and no history.

A turn is written as ``<s>role\\ntext</s>``.  Control strings inside roles and texts, and the backslash, are replaced by
a backslash and a digit, which is undone without loss.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PITCH = 320
HISTORY_TURNS = 2
HISTORY_TOKENS = 128
SYSTEM_TOKENS = 128
TURN_TOKENS = 4  # for the marks of a turn
RUN_TURNS = 1_024
BEGIN, END = "<s>", "</s>"
ASSISTANT, SYSTEM = "assistant", "system"

# The backslash comes first and its code last, so that decoding in reverse order is exact.
_CODES = [
    ("\\", "\\0"), ("</s>", "\\1"), ("<s>", "\\2"), ("[INST]", "\\3"), ("[/INST]", "\\4"), ("<<SYS>>", "\\5"),
    ("<</SYS>>", "\\6"),
]
_NEWLINE = ("\n", "\\7")  # in roles


def escape(text: Column, more: tuple[tuple[str, str], ...] = ()) -> Column:
    for plain, code in [*_CODES, *more]:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column, more: tuple[tuple[str, str], ...] = ()) -> Column:
    for plain, code in reversed([*_CODES, *more]):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def token_count(text: Column) -> Column:
    """Words and the marks of the turn; a bound for the window, not a tokenizer's count."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long") + TURN_TOKENS


def format_conversations(
    conversations: DataFrame,
    pitch: int = PITCH,
    history_turns: int = HISTORY_TURNS,
    history_tokens: int = HISTORY_TOKENS,
    system_tokens: int = SYSTEM_TOKENS,
) -> DataFrame:
    """Windows: conv_id, run, first (the number of its first new turn, from 1), n_context, n_tokens, text, loss.

    ``run`` is the run of turn numbers in which the window begins.
    ``text`` holds ``n_context`` repeated turns and then the new ones; ``loss`` lists the spans (start, end, in code
    points) of the new assistant texts.  Turns are ordered by turn (null last), then role, then text; null roles and
    texts are empty; repeated rows are turns of their own; rows with a null conv_id are one conversation.  Other
    columns are ignored; an empty table gives an empty result.
    """
    turns = conversations.select(
        F.coalesce(F.col("conv_id"), F.lit(0)).cast("long").alias("conv"),
        F.col("conv_id").isNull().alias("stray"),
        F.coalesce(F.floor(F.col("turn") / RUN_TURNS), F.lit(2**62)).cast("long").alias("run"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    ).withColumn("tokens", token_count(F.col("text")))
    order = [F.col("turn").asc_nulls_last(), F.col("role"), F.col("text")]
    run = ["conv", "stray", "run"]
    inside = Window.partitionBy(*run).orderBy(*order)
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    long = F.col("tokens") > pitch
    placed = turns.withColumns(
        {
            "at": F.row_number().over(inside).cast("long"),
            "before": F.sum("tokens").over(so_far) - F.col("tokens"),
            "longs": F.count_if(long).over(so_far),
        }
    )
    # One row per run: what it adds to the sums, and its first turns.  Made of the columns above, so that Spark shuffles
    # the turns once for both uses.
    sizes = F.struct("at", "tokens")
    runs = placed.groupBy(*run).agg(
        F.max("at").alias("n"), F.max(F.col("before") + F.col("tokens")).alias("run_tokens"), F.max("longs").alias("run_longs"),
        F.array_sort(F.collect_list(F.when(F.col("at") <= history_turns, sizes))).alias("head"),
    )
    along = Window.partitionBy("conv", "stray").orderBy("run")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    following = along.rowsBetween(1, max(1, history_turns))
    sums = {f"{name}0": F.coalesce(F.sum(name).over(earlier), F.lit(0)) for name in ("n", "run_tokens", "run_longs")}
    heads = F.slice(F.flatten(F.collect_list("head").over(following)), 1, history_turns)
    ahead = F.transform(heads, lambda t: t["tokens"])
    runs = runs.withColumns(sums | {"ahead": ahead}).drop("head", "run_tokens", "run_longs")
    windowed = lambda longs, tokens, before: F.struct(
        longs.alias("longs"), (tokens > pitch).alias("long"), F.floor(before / pitch).alias("stretch")
    )
    # A turn belongs to its own window, and is history of the windows that begin with one of the next turns.
    nexts = {f"tokens{i}": F.lead("tokens", i).over(inside) for i in range(1, history_turns + 1)}
    placed = placed.withColumns(nexts).join(runs, run).withColumns({
        "left": (F.col("n") - F.col("at")).cast("int"), "at": F.col("at") + F.col("n0"),
        "before0": F.col("before") + F.col("run_tokens0"), "longs0": F.col("longs") + F.col("run_longs0"), "tokens0": F.col("tokens"),
    }).withColumn("window0", windowed(F.col("longs0"), F.col("tokens0"), F.col("before0")))
    for i in range(1, history_turns + 1):
        beyond = F.get("ahead", F.greatest(F.lit(i - 1) - F.col("left"), F.lit(0)))
        placed = placed.withColumn(f"tokens{i}", F.when(F.col("left") >= i, F.col(f"tokens{i}")).otherwise(beyond)).withColumns({
            f"before{i}": F.col(f"before{i - 1}") + F.col(f"tokens{i - 1}"),
            f"longs{i}": F.col(f"longs{i - 1}") + (F.col(f"tokens{i}") > pitch).cast("long"),
        })
        there = windowed(F.col(f"longs{i}"), F.col(f"tokens{i}"), F.col(f"before{i}"))
        placed = placed.withColumn(f"window{i}", F.when(F.col(f"tokens{i}").isNotNull(), there))
    roles = [F.struct(F.col("window0").alias("window"), F.lit(0).alias("back"))]
    for back in range(1, history_turns + 1):
        theirs = F.col(f"window{back}")
        begins = theirs != F.col(f"window{back - 1}")
        near = F.col(f"before{back}") - F.col("before0") <= history_tokens
        roles.append(F.when(begins & near, F.struct(theirs.alias("window"), F.lit(back).alias("back"))))
    member = F.explode(F.filter(F.array(*roles), lambda m: m.isNotNull()))
    piece = F.struct(
        "at", F.col("member.back").alias("back"), F.concat(F.lit(BEGIN), escape(F.col("role"), (_NEWLINE,)), F.lit("\n"))
        .alias("head"), escape(F.col("text")).alias("body"), (F.col("role") == ASSISTANT).alias("target"), "tokens", "turn", "role",
    )
    new = F.col("member.back") == 0
    windows = placed.withColumn("member", member).groupBy("conv", "stray", "member.window").agg(
        F.array_sort(F.collect_list(piece)).alias("pieces"),
        F.min(F.when(new, F.col("at"))).alias("first"), F.min(F.when(new, F.col("run"))).alias("run"),
    )

    # The system turn is the earliest with that role; windows after it repeat it, or its first words.
    few = F.regexp_extract("text", rf"^[\x20\x09-\x0D]*+(?:[^\x20\x09-\x0D]++[\x20\x09-\x0D]*+){{0,{max(0, system_tokens - TURN_TOKENS)}}}", 0)
    where = F.struct("run", F.col("turn").isNull(), "turn", "text")
    system = turns.where(F.col("role") == SYSTEM).groupBy("conv", "stray").agg(
        F.min_by(F.struct("turn", "text", "tokens"), where).alias("s")
    )
    shown = F.when(F.col("s.tokens") > system_tokens, few).otherwise(F.col("text"))
    system = system.select("conv", "stray", "s", F.col("s.text").alias("text")).select(
        "conv", "stray", F.struct("s.turn", escape(F.col("text")).alias("whole"), shown.alias("text")).alias("system")
    )
    joined = windows.join(system, ["conv", "stray"], "left")
    # Its copies, equal in turn, role and text, count as it.
    place = lambda turn, role: F.struct(turn.isNull(), turn, role)
    own = place(F.col("system.turn"), F.lit(SYSTEM))
    same = lambda p: (place(p["turn"], p["role"]) == own) & (p["body"] == F.col("system.whole"))
    begin = F.filter("pieces", lambda p: p["back"] == 0)[0]
    earlier = own <= place(begin["turn"], begin["role"])
    repeated = F.exists("pieces", same)
    kept = F.struct(
        F.lit(0).cast("long").alias("at"), F.lit(1).alias("back"),
        F.lit(f"{BEGIN}{SYSTEM}\n").alias("head"), escape(F.col("system.text")).alias("body"),
        F.lit(False).alias("target"),
        token_count(F.col("system.text")).alias("tokens"), F.col("system.turn").alias("turn"), F.lit(SYSTEM).alias("role"),
    )
    pieces = F.when(F.col("system").isNotNull() & earlier & ~repeated, F.concat(F.array(kept), "pieces")).otherwise(
        F.col("pieces")
    )
    laid = joined.withColumn("pieces", pieces)
    size = lambda p: F.length(p["head"]) + F.length(p["body"]) + len(END)
    total = lambda ps: F.aggregate(ps, F.lit(0), lambda s, p: s + size(p))
    spans = F.transform(
        "pieces",
        lambda p, i: F.when(
            p["target"] & (p["back"] == 0),
            F.struct(
                (total(F.slice("pieces", 1, i)) + F.length(p["head"])).alias("start"),
                (total(F.slice("pieces", 1, i)) + F.length(p["head"]) + F.length(p["body"])).alias("end"),
            ),
        ),
    )
    return laid.select(
        F.when(~F.col("stray"), F.col("conv")).alias("conv_id"), "run", "first",
        F.size(F.filter("pieces", lambda p: p["back"] > 0)).alias("n_context"),
        F.aggregate("pieces", F.lit(0).cast("long"), lambda s, p: s + p["tokens"]).alias("n_tokens"),
        F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit(END))), "").alias("text"),
        F.filter(spans, lambda s: s.isNotNull()).alias("loss"),
    )


def read_back(windows: DataFrame) -> DataFrame:
    """(conv_id, run, first, turns, targets) of formatted windows: the new turns (role, text) and the texts under the
    loss mask, unescaped."""
    pieces = F.split("text", END, -1)
    new = F.slice(pieces, F.col("n_context") + 1, F.size(pieces) - 1 - F.col("n_context"))

    def turn(piece: Column) -> Column:
        head = F.substring_index(piece, "\n", 1)
        role = F.substring(head, F.lit(len(BEGIN) + 1), F.length(head))
        body = F.substring(piece, F.length(head) + 2, F.length(piece))
        return F.struct(unescape(role, (_NEWLINE,)).alias("role"), unescape(body).alias("text"))

    target = lambda s: unescape(F.substring(F.col("text"), s["start"] + 1, s["end"] - s["start"]))
    return windows.select(
        "conv_id", "run", "first", F.transform(new, turn).alias("turns"), F.transform("loss", target).alias("targets"),
        F.length("text").alias("n_chars"),
    )
