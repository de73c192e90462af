"""Files that hold one JSON array each, read by many tasks.

A file is cut at closing braces, so every split gives whole pieces wherever it begins. What a piece cannot
know by itself is whether it begins inside a string and how deep it is: both are added up, first inside each
split, then over a table with one row per split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from threadloom.session import materialise

SPLIT = ["file", "split"]
# What stands between records: the array's own signs. Anything else stays with the record after it, which then does not parse.
BETWEEN = r"^[\s,\[\]\x{FEFF}]*"


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """The text between closing braces with file, split (its first byte) and ``at``, which grows within a split."""
    read = spark.read.option("lineSep", "}").text(path)
    return read.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"),
        F.col("_metadata.file_size").alias("file_size"),
        "value",
    )


def _opened(segments: Column, odd: int) -> Column:
    """Opening braces in every other of the texts between quotes."""
    text = F.array_join(F.filter(segments, lambda s, i: i % 2 == odd), "")
    return F.length(text) - F.length(F.translate(text, "{", ""))


def signs(found: DataFrame) -> DataFrame:
    """Adds the quotes of a piece (escaped ones aside), the braces it opens if it begins outside (``o0``) or inside (``o1``) a
    string, and ``blank``: nothing but what stands between records."""
    segments = F.split(F.regexp_replace("value", r"(?s)\\.", ""), '"', -1)
    cut = found.withColumns({"segments": segments, "blank": F.regexp_like("value", F.lit(rf"{BETWEEN}$"))})
    counts = {"bytes": F.octet_length("value") + 1, "quotes": F.size("segments") - 1, "o0": _opened(F.col("segments"), 0), "o1": _opened(F.col("segments"), 1)}
    return cut.withColumns(counts).drop("segments")


def _placed(rows: DataFrame) -> DataFrame:
    """Adds for both states ``s`` at the start of the split: ``c<s>``, whether the brace after the piece counts, and ``r<s>``, the
    depth after it, less that at the start of the split."""
    before = Window.partitionBy(*SPLIT).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*SPLIT).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("q", F.coalesce(F.sum("quotes").over(before), F.lit(0)))
    for s in (0, 1):
        inside = (F.col("q") + s) % 2 == 1
        closes = (F.col("q") + s + F.col("quotes")) % 2 == 0
        rows = rows.withColumn(f"c{s}", closes)
        rows = rows.withColumn(f"r{s}", F.sum(F.when(inside, F.col("o1")).otherwise(F.col("o0")) - closes.cast("int")).over(upto))
    return rows


def split_states(narrow: DataFrame) -> DataFrame:
    """One row per split: state and depth at its start, the records ended before it, and whether its file balances.

    A record ends where the depth comes back to 0, which within a split is its lowest point. So a split tells
    for both states how far down it goes and how often it gets there, whatever the depth before it.
    """
    whole = Window.partitionBy(*SPLIT)
    rows = _placed(narrow).withColumns({f"m{s}": F.min(F.when(F.col(f"c{s}"), F.col(f"r{s}"))).over(whole) for s in (0, 1)})
    sums = {f"end{s}": F.max_by(f"r{s}", "at") for s in (0, 1)}
    sums |= {f"low{s}": F.min(f"m{s}") for s in (0, 1)}
    sums |= {f"n{s}": F.count_if(F.col(f"c{s}") & (F.col(f"r{s}") == F.col(f"m{s}"))) for s in (0, 1)}
    sums |= {"quotes": F.sum("quotes"), "bytes": F.sum("bytes"), "file_size": F.max("file_size"), "blank": F.max_by("blank", "at")}
    splits = rows.groupBy(*SPLIT).agg(*[c.alias(n) for n, c in sums.items()])

    order = Window.partitionBy("file").orderBy("split")
    before, every = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("file")
    splits = splits.withColumn("state", (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2).cast("int"))
    own = lambda name: F.when(F.col("state") == 1, F.col(f"{name}1")).otherwise(F.col(f"{name}0"))
    splits = splits.withColumn("depth", F.coalesce(F.sum(own("end")).over(before), F.lit(0)))
    splits = splits.withColumn("ended", F.when(own("low") + F.col("depth") == 0, own("n")).otherwise(0))
    # A piece without a brace after it, the last of most files, was counted as if it had one. The bytes tell, but for a packed file.
    over = F.sum("bytes").over(every) - F.col("file_size")
    no_brace = F.when(over == 0, False).when(over == 1, True).otherwise(F.max_by("blank", "split").over(every))
    sound = (F.sum("quotes").over(every) % 2 == 0) & (F.sum(own("end")).over(every) + no_brace.cast("int") == 0)
    return splits.select(
        *SPLIT, "state", "depth", F.coalesce(F.sum("ended").over(before), F.lit(0)).alias("records"), sound.alias("sound")
    )


def array_records(spark: SparkSession, path: str) -> DataFrame:
    """``record``: the text of each object of the arrays in ``path``; ``sound`` is false for pieces of a file that does not balance.

    The text is exchanged by split and by record; the states are found from columns without it. Pieces of a file
    whose braces or quotes don't pair up are given one by one, so a missing brace never gathers the rest of a file.
    """
    found = pieces(spark, path)
    states = materialise(split_states(signs(found).drop("value")), "array-splits")
    placed = _placed(signs(found)).join(states, SPLIT)
    own = lambda name: F.when(F.col("state") == 1, F.col(f"{name}1")).otherwise(F.col(f"{name}0"))
    ends = own("c") & (own("r") + F.col("depth") == 0)
    before = Window.partitionBy(*SPLIT).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    rows = placed.withColumn("number", F.col("records") + F.coalesce(F.sum(ends.cast("long")).over(before), F.lit(0)))
    alone = F.when(~F.col("sound"), F.struct("split", "at"))
    joined = rows.groupBy("file", "number", alone.alias("alone")).agg(
        F.array_sort(F.collect_list(F.struct("split", "at", "value"))).alias("parts"), F.first("sound").alias("sound")
    )
    text = F.concat(F.array_join("parts.value", "}"), F.lit("}"))
    records = joined.select(F.regexp_replace(text, BETWEEN, "").alias("record"), "sound")
    return records.where("record <> '}'")
