"""Chat formatting in budgeted windows, in DataFrame operations.

A conversation's turns have token counts. By their prefix sums the turns are dealt into windows: one for
each half ``BUDGET`` of tokens in which turns end, a turn of more than half a budget being a window of its
own, whole; so a window has at most ``BUDGET`` new tokens unless a single turn has more. A window begins with the
conversation's system turns, then repeats earlier turns that lie within ``HISTORY`` tokens before it, then
has its new turns. A turn stands between markers, its mark telling new from repeated ones; only the
texts of new assistant turns are under the loss mask, so that each is trained on once.

Markers begin with < or [, as those of common templates do; in texts and roles \\, < and [ are written
as \\s, \\l and \\b, so no text can hold a marker, and reading back is exact.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

BUDGET = 512
HISTORY = 128
NEW, REPEATED, BODY, END = "<|turn|>", "<|again|>", "<|text|>", "<|end|>"
_CODES = (("\\", "\\s"), ("<", "\\l"), ("[", "\\b"))  # first to last when written; last to first when read


def escape(text):
    for plain, code in _CODES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text):
    for plain, code in reversed(_CODES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def token_count(text):
    """Words, numbers and other marks: about the tokens of a text, at least one a turn."""
    return F.greatest(F.lit(1), F.regexp_count(text, F.lit(r"[\p{L}\p{M}]+|\p{N}+|[^\s\p{L}\p{M}\p{N}]"))).cast("long")


def windows(turns, conv="conv_id", turn="turn", role="role", text="text", budget=BUDGET, history=HISTORY):
    """conv, window, formatted and loss (spans of code points under the mask) of every window.

    Turns are taken by turn number, equal ones by role and text, repeated rows each; null texts and roles
    are empty, a null turn comes first, null conversations are one. An empty table gives no windows.
    """
    half = budget // 2
    if not 0 <= history <= half:
        raise ValueError("history may be at most half the budget")
    rows = turns.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text")
    ).withColumn("tokens", token_count(F.col("text")))
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    placed = rows.withColumns(
        {"no": F.row_number().over(order), "stop": F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, 0))}
    )
    bin_, long_ = F.floor((F.col("stop") - 1) / half), F.col("tokens") > half
    turns_over = (bin_ != F.lag(bin_).over(order)) | long_ | F.lag(long_).over(order)
    placed = placed.withColumn("opens", F.coalesce(turns_over, F.lit(False)).cast("long"))
    placed = placed.withColumn("window", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("opens")
    # where each window's new turns begin in tokens, and the next three, all that its turns can be history of
    starts = placed.groupBy("conv", "window").agg(F.min(F.col("stop") - F.col("tokens")).alias("start"))
    ahead = Window.partitionBy("conv").orderBy("window")
    starts = starts.withColumn("later", F.array_compact(F.array(*(F.lead(F.struct("window", "start"), k).over(ahead) for k in (1, 2, 3)))))
    same = F.expr("placed.conv <=> starts.conv AND placed.window = starts.window")
    reach = placed.alias("placed").join(starts.alias("starts"), same).select("placed.*", "later")
    repeats = (
        reach.filter("role != 'system'")
        .withColumn("to", F.explode("later"))
        .filter(F.col("to.start") - (F.col("stop") - F.col("tokens")) <= history)
        .select("conv", F.col("to.window").alias("window"), "no", "role", "text")
    )
    # a system turn is repeated in every later window
    system = placed.filter("role = 'system'").select("conv", F.col("window").alias("own"), "no", "role", "text")
    retained = (
        system.alias("s")
        .join(starts.alias("w"), F.expr("s.conv <=> w.conv AND w.window > s.own"))
        .select("s.conv", "w.window", "s.no", "s.role", "s.text")
    )
    own = placed.select("conv", "window", "no", "role", "text", F.lit(True).alias("new"))
    parts = own.unionByName(repeats.unionByName(retained).withColumn("new", F.lit(False)))
    written = F.concat(
        F.when(F.col("new"), NEW).otherwise(REPEATED), escape(F.col("role")), F.lit(BODY), escape(F.col("text")), F.lit(END)
    )
    sizes = Window.partitionBy("conv", "window").orderBy("no").rowsBetween(Window.unboundedPreceding, 0)
    parts = parts.select("conv", "window", "no", "role", "new", escape(F.col("text")).alias("body"), written.alias("written"))
    end = F.col("reach") - len(END)
    span = F.when(F.col("new") & (F.col("role") == "assistant"), F.struct((end - F.length("body")).alias("start"), end.alias("end")))
    return (
        parts.withColumn("reach", F.sum(F.length("written")).over(sizes))
        .withColumn("span", span)
        .groupBy("conv", "window")
        .agg(F.array_sort(F.collect_list(F.struct("no", "written", "span"))).alias("p"))
        .select(
            F.col("conv").alias(conv),
            "window",
            F.array_join(F.transform("p", lambda x: x["written"]), "").alias("formatted"),
            F.filter(F.transform("p", lambda x: x["span"]), lambda x: x.isNotNull()).alias("loss"),
        )
    )


def read_back(formatted, conv="conv_id"):
    """conv, turns (role, text) in order, loss (the unescaped texts under the mask) and the formatted size."""
    marks = F.split("formatted", r"(?=<\|turn\|>|<\|again\|>)", -1)
    new = F.filter(marks, lambda x: F.startswith(x, F.lit(NEW)))

    def parse(x):
        return F.struct(
            unescape(F.substring_index(F.substring(x, len(NEW) + 1, 1 << 30), BODY, 1)).alias("role"),
            unescape(F.substring_index(F.substring_index(x, BODY, -1), END, 1)).alias("text"),
        )

    loss = F.transform(
        "loss", lambda s: unescape(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))
    )
    each = formatted.select(conv, "window", F.transform(new, parse).alias("turns"), loss.alias("loss"), F.length("formatted").alias("size"))
    ordered = F.array_sort(F.collect_list(F.struct("window", "turns", "loss")))
    return each.groupBy(conv).agg(ordered.alias("w"), F.sum("size").cast("long").alias("formatted_chars")).select(
        conv,
        F.flatten(F.transform("w", lambda x: x["turns"])).alias("turns"),
        F.flatten(F.transform("w", lambda x: x["loss"])).alias("loss"),
        "formatted_chars",
    )
