"""Personal data with bootstrapped contextual extraction, by DataFrame functions only.

Base patterns give the seeds. The two words before a seed are a lexical pattern; so are the two words before any other token that
looks like an identifier. Patterns and instances (distinct values) form a graph. Scores run to and fro: a pattern
scores the mean of its instances, held down by ``PRIOR`` doubtful ones; an instance that is no seed scores the mean of its patterns.
After ``ROUNDS`` rounds, patterns that enough seeds stand behind and that score ``SURE`` or more report the
identifiers that follow them. All steps are joins and grouped sums over distinct edges, however common a pattern is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import found
from ledgerloom.session import settle

#: fixed values: the base patterns, in the order of kinds. A run of characters of the first part is entered at its start or where
#: the match before ended, and never given back, so that long runs cost one pass.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
KINDS = ("email", "ip", "card", "phone", "context")
#: fixed value: a token that looks like an identifier
CANDIDATE = r"(?<![A-Za-z0-9])[A-Za-z]*+[-#/]?[0-9][A-Za-z0-9/-]{3,}+"
ROUNDS, PRIOR, SURE, MIN_SEEDS = 3, 2.0, 0.6, 3


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    back = F.reverse(_digits(value))
    doubled = F.transform(F.sequence(F.lit(1), F.length(back)), lambda i: F.substring(back, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1))
    return F.aggregate(doubled, F.lit(0), lambda s, x: s + F.when(x > 9, x - 9).otherwise(x)) % 10 == 0


def _before(gap: Column) -> Column:
    """The last two words of a gap with what stands between and behind them; the whole gap is looked at, from its end."""
    return F.reverse(F.regexp_extract(F.reverse(gap), r"^[^\p{L}_]*+[\p{L}_]++[^\p{L}_]++[\p{L}_]++", 0))


def _base(text: Column) -> dict[str, Column]:
    size = lambda m: F.length(_digits(m["v"]))
    return {
        "email": found.matches(text, EMAIL, "@", _before),
        "ip": F.filter(found.matches(text, IP, None, _before), lambda m: m["v"].rlike(rf"^{BYTE}(?:\.{BYTE}){{3}}$")),
        "card": F.filter(found.matches(text, CARD, None, _before), lambda m: F.when(size(m).between(14, 19), _luhn(m["v"])).otherwise(F.lit(False))),
        "phone": F.filter(found.matches(text, PHONE, None, _before), lambda m: size(m).between(10, 15)),
    }


def _pattern(context: Column) -> Column:
    """The last two words of the text before, lowered; null if there are fewer."""
    two = F.regexp_extract(F.lower(context), r"([\p{L}_]+)[^\p{L}_]+([\p{L}_]+)[^\p{L}_]*$", 0)
    return F.when(two != "", F.trim(F.regexp_replace(two, r"[^\p{L}_]+", " ")))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rounds: int = ROUNDS, prior: float = PRIOR, sure: float = SURE, min_seeds: int = MIN_SEEDS) -> DataFrame:
    """(doc_id, txt, base, spans): for every row the base spans and all spans, as (start, order, end, kind) by start and kind, in code
    points. ``txt``, a hash of the text, tells rows apart that share a doc_id.

    Null and empty texts have no spans. Rows that share a doc_id are judged by their own texts; equal rows get equal results and
    count once in the graph. An identifier that overlaps a base span is left out. An empty table gives no rows.
    """
    t = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc"), F.xxhash64(text).alias("txt"), F.col(text).alias("text"))
    kinds = KINDS[:4]
    rows = rows.select("doc", "txt", *[c.alias(k) for k, c in _base(t).items()], found.matches(t, CANDIDATE, "[0-9]", _before).alias("other"))
    base = found.listed(*[found.spans(k, i, F.col(k)) for i, k in enumerate(kinds)])
    seen = lambda column, seed: F.transform(column, lambda m: F.struct(m["s"].alias("s"), m["e"].alias("e"), m["v"].alias("v"), _pattern(m["c"]).alias("p"), F.lit(seed).alias("seed")))
    instances = F.concat(*[seen(F.col(k), True) for k in kinds], seen(found.apart(F.col("other"), *map(F.col, kinds)), False))
    rows = settle(rows.select("doc", "txt", base.alias("base"), instances.alias("seen")), "person-seeds")

    each = rows.where(F.size("seen") > 0).select("doc", "txt", F.explode("seen").alias("x")).select("doc", "txt", "x.*").where("p is not null")
    edges = settle(each.groupBy("p", "v").agg(F.max("seed").alias("seed")), "person-edges")
    score = settle(edges.groupBy("v").agg(F.max("seed").cast("double").alias("score")), "person-scores")
    for _ in range(rounds):
        patterns = edges.join(score, "v").groupBy("p").agg((F.sum("score") / (F.count(F.lit(1)) + F.lit(prior))).alias("sure"), F.sum(F.col("seed").cast("long")).alias("seeds"))
        patterns = settle(patterns, "person-patterns")
        mean = edges.join(patterns, "p").groupBy("v").agg(F.max("seed").alias("seed"), F.avg("sure").alias("sure"))
        score = settle(mean.select("v", F.when(F.col("seed"), 1.0).otherwise(F.col("sure")).alias("score")), "person-scores")
    good = patterns.where((F.col("sure") >= sure) & (F.col("seeds") >= min_seeds)).select("p") if rounds else edges.select("p").limit(0)
    span = F.struct(F.col("s"), F.lit(4).alias("k"), F.col("e"), F.lit("context").alias("kind"))
    more = each.where("not seed").join(good, "p", "left_semi").select("doc", "txt", span.alias("x")).distinct().groupBy("doc", "txt").agg(F.collect_list("x").alias("more"))
    joined = rows.alias("r").join(more.alias("l"), F.expr("r.doc <=> l.doc and r.txt <=> l.txt"), "left")
    spans = F.array_sort(F.concat("r.base", F.coalesce(F.col("l.more"), F.array()).cast(found.SPAN)))
    return joined.select(F.col("r.doc").alias("doc_id"), "r.txt", "r.base", spans.alias("spans"))
