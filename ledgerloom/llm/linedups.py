"""Near-duplicate lines as an exact set-similarity join, by DataFrame functions only.

A line is the set of its distinct words, lowered. Words are ordered by rarity: how often words of their hash bucket stand in all documents,
in steps of an eighth of a power of two, then by hash. Any order gives the same result; this one keeps the pairs few. Two sets of sizes n and m with a Jaccard
similarity of ``percent`` share at least ``need = ceil(percent * (n + m) / (100 + percent))`` words, so one of the first
``n - ceil(percent * n / 100) + 1`` words of each (prefix filter). A shared word at places i and j must leave enough
words behind it (positional filter), and sizes must be near enough (length filter). Every word flips one of 64 bits of
its line, so two lines differ in at least as many words as bits (parity filter). In lines of many words 64 bits say little: pairs of those
are held against each other by 256 more before they are verified. What is left is verified on all words.

Lines with equal sets are one set from the start, with its first occurrence. A line goes if an earlier line, by
doc_id and place, is similar enough; lines are judged on the input. One earlier line is enough, so each set is first
verified against the earliest one that has the same prefix word, where many lines have it, and those left against the earliest
of those left. Only sets left over then meet all earlier ones: a group of thousands of near copies needs a few comparisons for
each member.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.texts import held
from ledgerloom.session import release, settle, settle_last

#: similarity in percent; lines of fewer distinct words are not touched unless the caller says otherwise
PERCENT, MIN_WORDS = 80, 5
#: hash buckets that words are counted in: a fixed size, whatever the corpus
BUCKETS = 1 << 17
#: lines of so many distinct words have 256 parity bits besides their 64
LONG = 96
#: prefix words of so many lines bring them to the earliest of these lines first, and how often
MANY, ROUNDS = 256, 2
_GAPS = r"[ \t\r\f\x0b]+"


def _split(line: Column) -> Column:
    """The lowered words of a line, with empty ones between gaps. A pattern is needed only by lines with other gaps than blanks."""
    other = F.contains(line, F.lit("\t")) | F.contains(line, F.lit("\r")) | F.contains(line, F.lit("\f")) | F.contains(line, F.lit("\x0b"))
    return F.when(other, F.split(F.lower(line), _GAPS)).otherwise(F.split(F.lower(line), " "))


def _words(line: Column) -> Column:
    return F.array_distinct(F.transform(F.array_remove(_split(line), ""), lambda w: F.xxhash64(w)))


def _rarity(rows: DataFrame) -> DataFrame:
    """One row: the rarity step of every bucket, above 54 bits. The words of all texts count."""
    word = F.explode(_split(F.replace("text", F.lit("\n"), F.lit(" ")))).alias("w")
    counts = rows.select(word).select(F.xxhash64("w").bitwiseAND(BUCKETS - 1).alias("b")).groupBy("b").agg(F.count(F.lit(1)).alias("n"))
    step = counts.select("b", F.floor(8 * F.log2("n")).cast("long").alias("step"))
    every = rows.sparkSession.range(BUCKETS).select(F.col("id").alias("b")).join(step, "b", "left").select(F.struct("b", F.shiftleft(F.coalesce("step", F.lit(0)), 54).alias("step")).alias("x"))
    return every.agg(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["step"]).alias("steps"))


def _as_variable(one: DataFrame) -> str:
    """A session variable with the value of a one-row table: a literal in the plans that read it."""
    spark, name = one.sparkSession, f"line_rarity_{uuid.uuid4().hex[:12]}"
    one.createOrReplaceTempView(name)
    spark.sql(f"DECLARE OR REPLACE VARIABLE {name} ARRAY<BIGINT>")
    spark.sql(f"SET VARIABLE {name} = (SELECT steps FROM {name})")
    spark.catalog.dropTempView(name)
    return name


def _ordered(line: Column, steps: Column) -> Column:
    """The words of a line, rarest first, as 63-bit keys: the step above 54 bits of the hash. One pass over the words; keys that cannot be null are sorted
    as plain numbers."""
    step = lambda w: F.coalesce(F.get(steps, F.xxhash64(w).bitwiseAND(BUCKETS - 1)), F.lit(0).cast("long"))
    key = lambda w: step(w).bitwiseOR(F.shiftrightunsigned(F.xxhash64(w), 10))
    return F.sort_array(F.array_distinct(F.transform(F.array_remove(_split(line), ""), key)))


def _long_parity() -> Column:
    """256 parity bits of a line of many words as four numbers; null for other lines."""
    quarters = ", ".join(f"aggregate(keys, 0L, (z, k) -> z ^ if(k & 192 = {q << 6}, shiftleft(1L, cast(shiftright(k, 8) & 63 as int)), 0L))" for q in range(4))
    return F.expr(f"if(size(keys) >= {LONG}, array({quarters}), null)")


def _need(n: str, percent: int) -> str:
    return f"-floor(-{percent} * {n} / 100)"


def repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc, txt, removed): for every text that has some, the places of lines, from 0, that repeat an earlier line. ``doc`` is the doc_id, or the
    largest number for none, so such texts come last; ``txt`` is a hash of the text.

    Lines lie between line breaks. Lines with fewer than ``min_words`` distinct words, lines without words, null and empty texts never
    go and remove nothing; ``min_words`` of 1 lets every line with a word take part. Equal rows count as one. An empty table gives no rows.
    """
    return settle_last("line-removed", lambda: _repeated_lines(docs, doc_id, text, percent, min_words))


def _repeated_lines(docs: DataFrame, doc_id: str, text: str, percent: int, min_words: int) -> DataFrame:
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit((1 << 63) - 1)).alias("doc"), F.xxhash64(text).alias("txt"), F.col(text).alias("text")).where("text is not null")
    steps = F.expr(f"system.session.{_as_variable(_rarity(rows))}")
    lines = rows.select("doc", "txt", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    keyed = lines.select("doc", "txt", "pos", _ordered(F.col("line"), steps).alias("keys"))
    odd = F.expr("aggregate(keys, 0L, (z, k) -> z ^ shiftleft(1L, cast(k & 63 as int)))")
    prefix = F.expr(f"slice(keys, 1, cast(size(keys) - {_need('size(keys)', percent)} + 1 as int))")
    keyed = settle(keyed.select("doc", "txt", "pos", F.xxhash64("keys").alias("a"), F.hash("keys").alias("b"), F.size("keys").alias("n"), prefix.alias("prefix"), odd.alias("odd"), _long_parity().alias("bits")), "line-sets")
    keyed = keyed.where(F.col("n") >= max(1, min_words))  # on the written table, so that words are worked out once
    release(spark)
    at = F.struct("doc", "txt", "pos")
    sets = keyed.groupBy("a", "b").agg(F.min(at).alias("at"), F.first("n").alias("n"), F.first("prefix").alias("prefix"), F.first("odd").alias("odd"), F.first("bits").alias("bits"), F.count(F.lit(1)).alias("copies"))
    sets = settle(sets.orderBy("at").withColumn("id", F.monotonically_increasing_id()), "line-distinct")  # numbers in the order of lines
    release(spark)

    def similar(some: DataFrame) -> DataFrame:
        """The later sets of pairs that are similar enough, on the words of their first occurrences."""
        wanted = some.select(F.col("late").alias("id")).union(some.select("early")).distinct()
        held = sets.select("id", "at.*").join(wanted, "id", "left_semi").groupBy("doc", "txt").agg(F.collect_list(F.struct("pos", "id")).alias("places"))
        held = rows.join(held, ["doc", "txt"]).select(F.split("text", "\n", -1).alias("lines"), F.explode("places").alias("p"))
        held = settle(held.select("p.id", F.expr("lines[p.pos]").alias("line")).select("id", _words(F.col("line")).alias("keys")).dropDuplicates(["id"]), "line-words")
        release(spark)
        both = F.size(F.array_intersect("k", "l"))
        joined = some.join(held.toDF("late", "k"), "late").join(held.toDF("early", "l"), "early")
        return joined.where(100 * both >= percent * (F.size("k") + F.size("l") - both)).select("late").distinct()

    # conditions in whole numbers, with s for the sum of both sizes: need = percent * s / (100 + percent) words must be shared, and
    # s - 2 * need may differ
    s = "(x.n + y.n)"
    alike = f"{100 + percent} * ({s} - bit_count(x.odd ^ y.odd)) >= {2 * percent} * {s}"
    behind = f"{100 + percent} * least(x.n - x.i, y.n - y.i) >= {percent} * {s}"
    sized = f"100 * x.n >= {percent} * y.n and 100 * y.n >= {percent} * x.n"
    long = sets.where("bits is not null").select("id", "n", "bits")
    apart = " + ".join(f"bit_count(bits_x[{q}] ^ bits_y[{q}])" for q in range(4))

    def far(pairs: DataFrame) -> DataFrame:
        """Pairs without those of long lines that differ in too many bits."""
        pairs = pairs.join(long.toDF("early", "n_x", "bits_x"), "early", "left").join(long.toDF("late", "n_y", "bits_y"), "late", "left")
        pairs = pairs.where(f"bits_x is null or bits_y is null or {100 + percent} * (n_x + n_y - ({apart})) >= {2 * percent} * (n_x + n_y)")
        return settle(pairs.select("late", "early"), "line-pairs")

    # one earlier similar line is enough: in prefix words that many lines have, first the earliest line of about that size, then the
    # earliest of those left, so that a group of thousands of near copies is settled by a few comparisons for each member
    # sets so small that one word more or less is too much are similar to equal ones only, which are one set already
    nearby = f"100 * n >= {percent} * (n + 1)"
    index = sets.where(nearby).select("id", F.col("n").cast("long").alias("n"), "odd", F.posexplode("prefix").alias("i", "word"))
    many = settle(index.groupBy("word").count().where(F.col("count") >= MANY).select("word"), "line-many")
    band = F.floor(F.log("n") / F.log(F.lit(100 / percent))).alias("band") if percent < 100 else F.col("n").alias("band")
    crowd, gone = settle(index.join(many, "word").select("*", band), "line-crowd"), sets.select(F.col("id").alias("late")).limit(0)
    for _ in range(ROUNDS):
        leads = crowd.groupBy("word", "band").agg(F.min(F.struct("id", "n", "odd", "i")).alias("x")).select("word", "band", "x.*")
        pairs = crowd.alias("y").join(leads.alias("x"), ["word", "band"]).where(f"x.id < y.id and {alike} and {behind} and {sized}")
        pairs = settle(pairs.select(F.col("y.id").alias("late"), F.col("x.id").alias("early")).distinct(), "line-pairs")
        found = settle(similar(far(pairs)), "line-links")
        gone = gone.union(found)
        crowd = crowd.join(found, F.col("id") == F.col("late"), "left_anti").join(leads.select("word", "band", F.col("id").alias("lead")), ["word", "band"])
        crowd = settle(crowd.where("id != lead").drop("lead"), "line-crowd")
        release(spark)
    # then lines that are left against all earlier ones
    gone = settle(gone.distinct(), "line-links")
    left = sets.join(gone.select(F.col("late").alias("id"), F.lit(-1).cast("long").alias("till")), "id", "left").withColumn("till", F.coalesce("till", "id"))
    index = left.where(nearby).select("id", "till", F.col("n").cast("long").alias("n"), "odd", F.posexplode("prefix").alias("i", "word"))
    # till is the number, or -1 for a line that goes already; x.till < y.id always holds, so that both sides have the same columns and one shuffle
    met = index.alias("x").join(index.alias("y"), F.expr(f"x.word = y.word and x.id < y.till and x.till < y.id and {alike} and {behind} and {sized}"))
    met = settle(met.select(F.col("x.id").alias("early"), F.col("y.id").alias("late")).distinct(), "line-pairs")
    release(spark)
    gone = settle(gone.union(similar(far(met))), "line-links")
    release(spark)
    near = sets.join(gone.select(F.col("late").alias("id"), F.lit(True).alias("near")), "id", "left")
    near = near.where("copies > 1 or near").select("a", "b", F.col("at").alias("first"), F.coalesce("near", F.lit(False)).alias("near"))
    out = keyed.select("a", "b", at.alias("at")).join(near, ["a", "b"]).where("near or at > first")
    return out.select("at.*").distinct().groupBy("doc", "txt").agg(F.array_sort(F.collect_list("pos")).alias("removed"))


def drop_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT, min_words: int = MIN_WORDS, out: str = "left_text", removed: str = "removed") -> DataFrame:
    """All columns of ``docs`` with two more: ``removed``, the places of lines that repeat an earlier line of the corpus, and ``out``, the
    text without them. See ``repeated_lines``; texts without such lines, null and empty ones stay as they are.
    An input column called like a new one gives way to it.
    """
    gone = repeated_lines(docs, doc_id, text, percent, min_words).select(F.col("doc").alias("gone_doc"), F.col("txt").alias("gone_txt"), F.col("removed").alias("gone"))
    columns = [c for c in docs.columns if c not in (out, removed)]
    rows = held(docs.select(*[F.col(f"`{c}`") for c in columns]))  # names that no column of this join has
    said, number = F.col(f"`_in_{text}`"), F.col(f"`_in_{doc_id}`")
    rows = rows.join(gone, (F.coalesce(number.cast("long"), F.lit((1 << 63) - 1)) == F.col("gone_doc")) & (F.xxhash64(said) == F.col("gone_txt")), "left")
    kept = F.array_join(F.filter(F.split(said, "\n", -1), lambda _, i: ~F.array_contains("gone", i)), "\n")
    # under names of their own first: in one list, a name could mean the input column that is shown beside it
    rows = rows.withColumns({"kept_text": F.when(F.col("gone").isNull(), said).otherwise(kept), "gone_lines": F.coalesce("gone", F.array().cast("array<int>"))})
    return rows.select(*[F.col(f"`_in_{c}`").alias(c) for c in columns], F.col("kept_text").alias(out), F.col("gone_lines").alias(removed))
