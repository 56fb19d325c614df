"""Chat formatting in budgeted windows.

Prefix sums of the turns' tokens lay a grid over a conversation. Turns that lie
within one cell of the grid form a window, a turn that crosses a grid line is a
window of its own; so windows are aligned to turns, a cell never holds more
than the budget leaves for new turns, and no window waits for the one before.
Every window starts with the conversation's system turn and a limited history:
turns right before it, while they fit in the history's share of the budget and
in what the system turn and the window's own turns leave of it. A window exceeds
the budget only if the system turn and one turn alone do; it has no history then.
Targets are the assistant's texts; in repeated turns they are masked, so each
counts once.

Template: <|im_start|>ROLE newline TEXT<|im_end|> newline. In roles and texts a
backslash is doubled, and a backslash is put behind the first character of
every control string; a newline in a role becomes backslash n.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import row_identity, stored, word_count

BUDGET, HISTORY_TOKENS, HISTORY_TURNS = 512, 128, 4
MARKERS = 4                       # tokens counted for a turn besides its words
CELL_TURNS = 64
START, END = "<|im_start|>", "<|im_end|>\n"
# FIXED VALUES: control strings of this and other common templates.
CONTROL = ["<|im_start|>", "<|im_end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]


def escape(text: Column) -> Column:
    rest = "|".join("".join("\\" + c if not c.isalnum() else c for c in s[1:]) for s in CONTROL)
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), rf"([<\[])(?={rest})", r"$1\\")


def unescape(text: Column, newline: bool = False) -> Column:
    """Doubled backslashes stay one; a single one goes (with an n behind it, in roles, it is a newline)."""
    def part(p: Column) -> Column:
        p = F.replace(p, F.lit("\\n"), F.lit("\n")) if newline else p
        return F.replace(p, F.lit("\\"), F.lit(""))
    return F.array_join(F.transform(F.split(text, r"\\\\"), part), "\\")


def header(role: Column) -> Column:
    return F.concat(F.lit(START), F.replace(escape(role), F.lit("\n"), F.lit("\\n")), F.lit("\n"))


def format_windows(turns: DataFrame, budget: int = BUDGET, history_tokens: int = HISTORY_TOKENS,
                   history_turns: int = HISTORY_TURNS) -> DataFrame:
    """(conv_id, turn, role, text) -> one row per window: conv (identity),
    conv_id, window, text, loss (array of start and length in code points,
    start from 0), repeated (leading turns that an earlier window holds),
    n_tokens.

    Nulls in role and text count as empty. Turns are put in order of turn
    (null first), role and text; repeated rows are turns of their own. A null
    conv_id is one conversation. A first turn of role system is the system
    turn. A turn above the budget is a window on its own, uncut. Tokens are
    words plus MARKERS a turn, so a budget in a tokenizer's ids is to be divided
    by its ids per word.
    """
    turns = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = stored(turns.withColumn("conv", row_identity(F.col("conv_id").cast("string")))
                   .withColumn("tokens", word_count(F.col("text")) + MARKERS).withColumn("one", F.lit(1))
                   .withColumn("cell", F.coalesce(F.floor(F.col("turn") / CELL_TURNS), F.lit(-2**62))), "turns")
    sums = (turns.groupBy("conv", "cell").agg(F.sum("tokens").alias("t"), F.sum("one").alias("n")))
    before = Window.partitionBy("conv").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy("conv", "cell").orderBy(F.asc_nulls_first("turn"), "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("conv", "cell", F.coalesce(F.sum("t").over(before), F.lit(0)).alias("t0"),
                          F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"))
    placed = stored(turns.withColumn("t1", F.coalesce(F.sum("tokens").over(within), F.lit(0)))
                    .withColumn("n1", F.coalesce(F.sum("one").over(within), F.lit(0)))
                    .join(offsets, ["conv", "cell"])
                    .select("conv", "conv_id", (F.col("n0") + F.col("n1")).alias("pos"), (F.col("t0") + F.col("t1")).alias("start"),
                            "tokens", "role", "text"), "placed-turns")

    system = placed.filter("pos = 0 AND role = 'system'")
    plain = (placed.join(system.select("conv", F.col("tokens").alias("sys")), "conv", "left")
             .withColumn("sys", F.coalesce("sys", F.lit(0))).filter("NOT (pos = 0 AND role = 'system')")
             .withColumn("start", F.col("start") - F.col("sys"))
             .withColumn("room", F.greatest(F.lit(budget - history_tokens) - F.col("sys"), F.lit(1)))
             .withColumn("grid", F.floor(F.col("start") / F.col("room")))
             .withColumn("window", F.col("grid") * 2 + (F.floor((F.col("start") + F.col("tokens") - 1) / F.col("room")) > F.col("grid")).cast("int")))
    plain = plain.select("conv", "conv_id", "window", "pos", "start", "tokens", "role", "text", "sys")
    # what the system turn and the new turns leave of the budget bounds the history too
    spans = (plain.groupBy("conv", "window").agg(F.min("pos").alias("first"), F.min("start").alias("from"),
                                                 (F.lit(budget) - F.max("sys") - F.sum("tokens")).alias("left"))
             .withColumn("left", F.least(F.lit(history_tokens), F.col("left"))))
    plain = plain.drop("sys")

    wanted = (spans.filter("left > 0").select("conv", "window", "from", "left", F.explode(F.sequence(F.lit(1), F.lit(history_turns))).alias("back"), "first")
              .select("conv", F.col("window").alias("into"), "from", "left", (F.col("first") - F.col("back")).alias("pos")))
    history = (wanted.join(plain.drop("window"), ["conv", "pos"]).filter(F.col("from") - F.col("start") <= F.col("left"))
               .select("conv", "conv_id", F.col("into").alias("window"), "pos", "tokens", "role", "text", F.lit(True).alias("again")))
    leads = (system.select("conv", "conv_id", "pos", "tokens", "role", "text")
             .join(spans.select("conv", "window", "first"), "conv", "left")
             .select("conv", "conv_id", F.coalesce("window", F.lit(0)).alias("window"), "pos", "tokens", "role", "text",
                     F.coalesce(F.col("first") > 1, F.lit(False)).alias("again")))
    parts = (plain.drop("start").withColumn("again", F.lit(False)).unionByName(history).unionByName(leads)
             .withColumn("head", header(F.col("role")))
             .withColumn("body", escape(F.col("text"))))
    parts = parts.withColumn("piece", F.concat("head", "body", F.lit(END))).withColumn("chars", F.length("piece"))
    at = F.coalesce(F.sum("chars").over(Window.partitionBy("conv", "window").orderBy("pos")
                                        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    target = F.when((F.col("role") == "assistant") & ~F.col("again"),
                    F.struct((at + F.length("head")).alias("start"), F.length("body").cast("long").alias("length")))
    return (parts.withColumn("target", target).groupBy("conv", "conv_id", "window")
            .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "piece"))), lambda x: x["piece"]), "").alias("text"),
                 F.sort_array(F.collect_list("target")).alias("loss"), F.sum(F.col("again").cast("int")).cast("int").alias("repeated"),
                 F.sum("tokens").alias("n_tokens")))


def read_windows(windows: DataFrame) -> DataFrame:
    """Per window, from its text: the new turns (role, text, unescaped) in order and the text under its loss spans."""
    pieces = F.split("text", r"<\|im_end\|>\n")
    new = F.slice("pieces", F.col("repeated") + 1, F.size("pieces") - 1 - F.col("repeated"))
    def turn(p: Column) -> Column:
        head = F.substring_index(p, "\n", 1)
        return F.struct(unescape(F.substring(head, F.lit(len(START) + 1), F.length(head)), newline=True).alias("role"),
                        unescape(F.substring(p, F.length(head) + 2, F.length(p))).alias("text"))
    loss = F.transform("loss", lambda s: unescape(F.substring("text", (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return (windows.withColumn("pieces", pieces)
            .select("conv", "conv_id", "window", F.length("text").alias("chars"), F.transform(new, turn).alias("turns"),
                    F.array_join(loss, "").alias("loss_text")))


def conversation_digests(windows: DataFrame) -> DataFrame:
    """Per conversation, read back from its windows: turns and loss texts as digests, and characters."""
    read = read_windows(windows).withColumn("turns_text", F.array_join(F.transform(
        "turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""))
    whole = read.groupBy("conv", "conv_id").agg(
        F.sum(F.size("turns")).cast("long").alias("n_turns"), F.sum("chars").cast("long").alias("formatted_chars"),
        F.sort_array(F.collect_list(F.struct("window", "turns_text", "loss_text"))).alias("all"))
    text = F.array_join(F.transform("all", lambda x: x["turns_text"]), "")
    loss = F.array_join(F.transform("all", lambda x: x["loss_text"]), "")
    return whole.select("conv_id", "n_turns", F.sha2(text, 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"),
                        F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars")
