"""Near-duplicate lines across documents: an exact Jaccard join of the lines' shingle sets. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.session import materialise

SIZE, PERCENT = 5, 80
FREQUENT, SLOTS, SALTS = 500, 1 << 14, 64
SENT_ROWS = 500_000
# A shingle that more classes have in their prefixes is crowded; one that more crowded classes have at all comes late in their order.
CROWD, USUAL = 64, 8


def numbered_lines(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, at (from 0), line."""
    lines = F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), "\n")).alias("at", "line")
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), lines)


def line_words(lines: DataFrame, *kept: str) -> DataFrame:
    """``kept`` and ``words``: hashes of the words, split at white space, of a lower-cased line."""
    # Translating goes letter by letter, so only lines that need it are.
    spaced = F.when(F.col("line").rlike(r"[\t\x0b\f\r]"), F.translate(F.lower("line"), "\t\x0b\f\r", "    ")).otherwise(F.lower("line"))
    words = F.array_remove(F.split(spaced, " "), "")
    return lines.select(*kept, F.transform(words, lambda w: F.xxhash64(w)).alias("words"))


def line_sets(words: DataFrame, size: int, *kept: str) -> DataFrame:
    """``kept`` and ``set``: distinct hashes of all runs of ``size`` of the ``words``, sorted; fewer words are one run; null without words.

    The hashed words must be a column of their own: written into the lambda they would be made anew for every
    run. So nothing that reads ``set`` may be a filter or join key until the sets are written.
    """
    runs = F.transform("words", lambda w, i: F.xxhash64(w, *[F.get("words", i + k) for k in range(1, size)]))
    runs = F.slice(runs, F.lit(1), F.greatest(F.size("words") - size + 1, F.lit(1)))
    return words.select(*kept, F.when(F.size("words") > 0, F.sort_array(F.array_distinct(runs))).alias("set"))


def listed(slots: list[int]):
    """A test of a column for hashes in one of the ``slots``: one constant of ``SLOTS`` bits, looked up in place."""
    words = [0] * (SLOTS // 64)
    for slot in slots:
        words[slot // 64] |= 1 << slot % 64
    bits = F.lit([w - (1 << 64) if w >> 63 else w for w in words]).cast("array<bigint>")
    return lambda x: F.getbit(F.get(bits, F.pmod(F.shiftright(x, 6), F.lit(SLOTS // 64)).cast("int")), F.pmod(x, F.lit(64)).cast("int")) == 1


def slot_of(x: Column) -> Column:
    return F.pmod(F.shiftright(x, 6), F.lit(SLOTS // 64)) * 64 + F.pmod(x, F.lit(64))


def frequent_slots(shingles: DataFrame) -> list[int]:
    """The fullest slots, ``FREQUENT`` at most, of those that hold far more shingles than chance gives a slot.

    Counts are of all shingles, added up per task before they are shuffled: at most ``SLOTS`` rows a task.
    """
    counts = materialise(shingles.groupBy(slot_of(F.col("shingle")).alias("slot")).count(), "line-slots")
    usual = counts.agg(F.sum("count")).first()[0] or 0
    mean = usual / SLOTS
    full = counts.where(F.col("count") >= mean + 8 * mean**0.5 + 16)
    return [r[0] for r in full.orderBy(F.desc("count"), "slot").limit(FREQUENT).select("slot").collect()]


def need(n: Column, percent: int) -> Column:
    """The fewest common shingles of a line with n and any line it matches."""
    return F.floor((n * percent + 99) / 100).cast("int")


def overlap_for(n: Column, m: Column, percent: int) -> Column:
    """The fewest common shingles of matching lines with n and m."""
    return F.floor((percent * (n + m) + 99 + percent) / (100 + percent)).cast("int")


def sent_if_small(df: DataFrame) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``SENT_ROWS`` (short) rows; else joins shuffle both sides."""
    return F.broadcast(df) if df.count() <= SENT_ROWS else df


def matching_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """doc_id and at (line number from 0) of every line that matches an earlier one.

    Lines are in order of document id, then number. Two lines match when their sets of runs of ``size`` words
    have a Jaccard similarity of ``percent`` hundredths or more. A line with fewer words is one run, so it
    matches its exact copies, case and white space aside; a line without words never matches.

    Lines with equal sets are one class. The rest is a prefix join of classes: shingles are ordered by rarity
    (by hash, with those in the ``FREQUENT`` fullest of ``SLOTS`` slots after all others; only that bounded
    table is sent to the tasks, and it sets the order, not the result), and matching lines must share one of
    their first n - need + 1. A shared shingle's places in both orders bound the overlap that is still possible
    (positional filter), as do the sizes (length filter). What is left is compared set by set. The earliest
    class of each shingle (of each of ``SALTS`` parts of a frequent one) is compared first, which is linear;
    only classes that found no match there are then compared with all others they meet, so that a large
    group of similar lines is not paired out.

    Null and empty texts are one empty line. A null id comes after all others. Rows with the same id are one
    document that is there twice: equal places are the same line. An empty table gives no rows. Other columns
    are not read, whatever their names.
    """
    lines = numbered_lines(docs, doc_id, text)
    sets = line_sets(line_words(lines, "doc_id", "at"), size, "doc_id", "at")
    n = F.size("set")
    prefix = n - need(n, percent) + 1
    # More than the prefix has: enough to fill it when some of them turn out frequent.
    head = F.slice("set", F.lit(1), F.floor(prefix * 5 / 4).cast("int") + 2)
    heads = sets.select("doc_id", "at", F.xxhash64("set").alias("class_id"), F.when(F.col("set").isNotNull(), n).alias("n"), head.alias("head"))
    # Lines without words are left out when the table is read: a filter here would make every set twice.
    heads = materialise(heads, "line-heads").where("n is not null")
    heads = heads.withColumn("prefix", F.col("n") - need(F.col("n"), percent) + 1)

    place = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "at")
    classes = heads.groupBy("class_id").agg(F.min(place).alias("first"), F.max("n").alias("n"), F.count("*").alias("copies"))
    classes = materialise(classes, "line-classes")
    several = sent_if_small(classes.where("copies > 1").select("class_id", F.col("first").alias("earliest")))
    # One line of each class; the lines of all other classes stay where they are.
    heads_once = heads.withColumn("first", place).join(several, "class_id", "left").where(F.col("earliest").isNull() | (F.col("earliest") == F.col("first")))

    is_frequent = listed(frequent_slots(heads.select(F.explode(F.slice("head", F.lit(1), F.col("prefix"))).alias("shingle"))))
    rare = heads_once.withColumn("rare", F.filter("head", lambda x: ~is_frequent(x)))
    full = F.size("rare") >= F.col("prefix")
    ready = rare.where(full | (F.size("head") >= F.col("n")))
    in_order = F.when(full, F.col("rare")).otherwise(F.concat("rare", F.filter("head", is_frequent)))
    ready = ready.select("class_id", "n", "first", F.slice(in_order, F.lit(1), F.col("prefix")).alias("short"))
    # Lines with so many frequent shingles that their heads don't fill the prefix are read again.
    lacking = materialise(rare.where(~(full | (F.size("head") >= F.col("n")))).select("class_id", "first"), "lacking-lines")
    if not lacking.isEmpty():
        again = _sets_at(lines, lacking, size).withColumn("n", F.size("set"))
        again_order = F.concat(F.filter("set", lambda x: ~is_frequent(x)), F.filter("set", is_frequent))
        again = again.select("class_id", "n", "first", F.slice(again_order, F.lit(1), F.col("n") - need(F.col("n"), percent) + 1).alias("short"))
        ready = ready.unionByName(again)
    postings = ready.select(F.posexplode("short").alias("pos", "shingle"), "class_id", "n", "first")

    met = _met(postings.withColumn("common", is_frequent(F.col("shingle"))))
    early = _counted(_early(met), percent)
    sizes = met.groupBy("shingle").agg(F.count("*").alias("count"))
    crowded = materialise(sizes.where(F.col("count") > CROWD).select("shingle"), "crowded-shingles")
    crowded = sent_if_small(crowded)
    crowd = materialise(met.join(crowded, "shingle", "left_semi").select("class_id", "n", "first").distinct(), "crowd-lines")
    # One reading of the texts serves the first comparison and the order of the crowd.
    sets = _class_sets(_ends(early).unionByName(crowd.select("class_id")).distinct(), classes, lines, size)
    gone = materialise(_matching(early, sets, percent).select(F.col("b").alias("class_id")).distinct(), "gone-early")

    again = _met(_rare_first(crowd, sets, percent))
    early = _counted(_early(again.where("a.first < first").join(gone, "class_id", "left_anti")), percent)
    gone = gone.unionByName(_matching(early, sets, percent).select(F.col("b").alias("class_id"))).distinct()
    gone = materialise(gone, "gone-crowd")
    late = _counted(_late(again, gone), percent)
    gone = materialise(gone.unionByName(_matching(late, sets, percent).select(F.col("b").alias("class_id"))).distinct(), "gone-late")

    late = _counted(_late(met.join(crowded, "shingle", "left_anti"), gone), percent)
    found = _matching(late, _class_sets(_ends(late), classes, lines, size), percent)
    gone = gone.unionByName(found.select(F.col("b").alias("class_id"))).distinct().withColumn("gone", F.lit(True))

    decided = classes.join(gone, "class_id", "left").where("copies > 1 or gone").select("class_id", "first", F.coalesce("gone", F.lit(False)).alias("gone"))
    decided = materialise(decided, "decided-lines")
    out = heads.select("doc_id", "at", "class_id", place.alias("place")).join(decided, "class_id")
    return out.where("gone or not (place <=> first)").select("doc_id", "at")


def _sets_at(lines: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """class_id, first and the whole set of the lines at the places ``first``.

    Words and sets are written before anything is compared: as part of a filter or join key, the sets of all
    lines would be made, and the words anew for every run.
    """
    wanted = sent_if_small(wanted.select("class_id", "first", F.col("first.doc_id").alias("wanted_id"), F.col("first.at").alias("wanted_at")))
    at = lines.join(wanted, F.col("doc_id").eqNullSafe(F.col("wanted_id")) & (F.col("at") == F.col("wanted_at")))
    words = materialise(line_words(at, "class_id", "first"), "wanted-words")
    sets = materialise(line_sets(words, size, "class_id", "first"), "wanted-sets")
    # A repeated id may have another line at the same place.
    return sets.where(F.xxhash64("set") == F.col("class_id"))


def _met(postings: DataFrame) -> DataFrame:
    """The postings of shingles that more than one class has, each with the earliest class ``a`` of its part of the shingle.

    The classes of a ``common`` shingle are dealt over several tasks; each part has an earliest class of its own.
    All postings are shuffled here, so their columns are few and flat.
    """
    salt = F.when(F.col("common"), F.pmod(F.col("class_id"), F.lit(SALTS)).cast("int") + 1).otherwise(0).alias("salt")
    sizes = (F.shiftleft(F.col("n").cast("long"), 32) + F.col("pos")).alias("sizes")
    flat = postings.select("shingle", "class_id", F.col("first.doc_id").alias("doc_id"), F.col("first.at").alias("at"), sizes, salt)
    part = Window.partitionBy("shingle", "salt")
    here = F.struct(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "at").alias("first"), "class_id", "sizes")
    met = flat.withColumns({"least": F.min(here).over(part), "classes": F.count("*").over(part)}).where("classes > 1 or salt > 0")
    n, pos = lambda x: F.shiftright(x, 32).cast("int").alias("n"), lambda x: x.bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("pos")
    a = F.struct(F.col("least.class_id"), n(F.col("least.sizes")), pos(F.col("least.sizes")), F.col("least.first")).alias("a")
    met = met.select("shingle", "class_id", n(F.col("sizes")), pos(F.col("sizes")), F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "at").alias("first"), a)
    return materialise(met, "met-lines")


def _early(met: DataFrame) -> DataFrame:
    """Every posting beside the earliest class of its part: a, na, pa, b, nb, pb."""
    early = met.select(F.col("a.class_id").alias("a"), F.col("a.n").alias("na"), F.col("a.pos").alias("pa"), F.col("class_id").alias("b"), F.col("n").alias("nb"), F.col("pos").alias("pb"))
    return early.where("a <> b")


def _late(met: DataFrame, gone: DataFrame) -> DataFrame:
    """Every posting of a class that is not ``gone`` beside all earlier ones of its shingle: a, na, pa, b, nb, pb."""
    left, right = met.drop("a").alias("l"), met.join(gone, "class_id", "left_anti").drop("a").alias("r")
    late = left.join(right, (F.col("l.shingle") == F.col("r.shingle")) & (F.col("l.first") < F.col("r.first")))
    return late.select(F.col("l.class_id").alias("a"), F.col("l.n").alias("na"), F.col("l.pos").alias("pa"), F.col("r.class_id").alias("b"), F.col("r.n").alias("nb"), F.col("r.pos").alias("pb"))


def _rare_first(crowd: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Postings of the ``crowd``'s prefixes, its shingles in order of how many of its classes have them, then by hash.

    Counts up to ``USUAL`` are one. Lines made of the same passage with other words in it have those in their
    prefixes, and do not meet by the passage.
    """
    shingles = sets.join(sent_if_small(crowd.select("class_id")), "class_id", "left_semi").select("class_id", F.explode("set").alias("shingle"))
    often = materialise(shingles.groupBy("shingle").agg(F.count("*").alias("count")).where(F.col("count") > USUAL), "often-met")
    ranked = shingles.join(sent_if_small(often), "shingle", "left").select("class_id", F.struct(F.coalesce("count", F.lit(0)).alias("count"), "shingle").alias("run"))
    ranked = ranked.groupBy("class_id").agg(F.sort_array(F.collect_set("run")).alias("ranked")).join(crowd, "class_id")
    short = F.slice("ranked", F.lit(1), F.col("n") - need(F.col("n"), percent) + 1)
    postings = ranked.select(F.posexplode(short).alias("pos", "run"), "class_id", "n", "first")
    return postings.select("pos", "run.shingle", "class_id", "n", "first", (F.col("run.count") > CROWD).alias("common"))


def _counted(pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that may match, with na and nb. ``pairs``: a, na, pa, b, nb, pb, a row for each shared prefix shingle."""
    least = overlap_for(F.col("na"), F.col("nb"), percent)
    # Before their places the two share at most as many as the earlier place has; after them, what is left of the shorter rest.
    possible = F.least("pa", "pb") + F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb"))
    pairs = pairs.where((100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")) & (possible >= least))
    counted = pairs.groupBy("a", "b", "na", "nb").agg(F.count("*").alias("shared"))
    # What both have in their prefixes, and the rest of the set whose prefix ends first.
    counted = counted.where(F.col("shared") + F.greatest(need(F.col("na"), percent), need(F.col("nb"), percent)) - 1 >= least)
    return materialise(counted.select("a", "b", "na", "nb"), "line-pairs")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("class_id")).unionByName(pairs.select(F.col("b").alias("class_id")))


def _class_sets(wanted: DataFrame, classes: DataFrame, lines: DataFrame, size: int) -> DataFrame:
    """class_id and set of the ``wanted`` classes; a class whose place is there twice may come twice."""
    wanted = materialise(classes.join(wanted.distinct(), "class_id", "left_semi").select("class_id", "first"), "wanted-lines")
    return _sets_at(lines, wanted, size).select("class_id", "set")


def _matching(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets match. Sets of other classes don't travel."""
    least = overlap_for(F.col("na"), F.col("nb"), percent)
    sets = sets.join(sent_if_small(_ends(pairs).distinct()), "class_id", "left_semi").dropDuplicates(["class_id"])
    both = pairs.join(sets.select(F.col("class_id").alias("a"), F.col("set").alias("sa")), "a")
    both = both.join(sets.select(F.col("class_id").alias("b"), F.col("set").alias("sb")), "b")
    return both.where(F.size(F.array_intersect("sa", "sb")) >= least).select("a", "b")


def without_matching_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """Every row of ``docs`` as a struct ``row`` beside n_lines, n_removed and the text of the lines that stay."""
    removed = matching_lines(docs, doc_id, text, **settings).groupBy(F.col("doc_id").alias("removed_id")).agg(F.collect_set("at").alias("removed"))
    removed = sent_if_small(materialise(removed, "removed-lines"))
    rows = docs.select(F.struct("*").alias("row"), F.col(doc_id).cast("long").alias("key"), F.split(F.coalesce(F.col(text), F.lit("")), "\n").alias("lines"))
    rows = rows.join(removed, F.col("key").eqNullSafe(F.col("removed_id")), "left")
    stay = F.filter("lines", lambda line, at: ~F.array_contains("removed", at))
    return rows.select(
        "row",
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
        F.when(F.col("removed").isNull(), F.array_join("lines", "\n")).otherwise(F.array_join(stay, "\n")).alias("text"),
    )
