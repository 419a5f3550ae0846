"""The brand dictionary and the longest-prefix match against it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motorpool.dictionaries import STARTER_BRANDS, inline_table
from motorpool.functions.makemodel import IMPORT_SEGMENT
from motorpool.functions.text import normalize_text
from motorpool.session import settle, settle_counted

# Beyond this many entries one regular expression is the wrong tool; use `match_by_join` or `match_by_search`.
MAX_PATTERN_BRANDS = 5000
# A beginning that fewer texts share is not worth dealing over tasks.
HOT_TEXTS = 10_000


def checked_brands(brands: Sequence[str]) -> tuple[str, ...]:
    names = tuple(dict.fromkeys(b for b in brands if b))
    if IMPORT_SEGMENT in names:
        raise ValueError(f"{IMPORT_SEGMENT} marks imports and cannot be a brand")
    if len(names) > MAX_PATTERN_BRANDS:
        raise ValueError(f"{len(names)} brands do not fit one pattern; use match_by_join")
    return names


def load_dictionary(spark: SparkSession, path: str) -> tuple[str, ...] | DataFrame:
    """Brand names from a text file, one per line: names for one pattern, or a table for the join beyond that."""
    rows = spark.read.text(path).select(F.trim("value").alias("brand")).where("brand != ''")
    names = [r.brand for r in rows.limit(MAX_PATTERN_BRANDS + 1).collect()]
    return checked_brands(names) if len(names) <= MAX_PATTERN_BRANDS else rows.distinct()


def brand_names(dictionary: DataFrame) -> tuple[str, ...]:
    """A dictionary small enough for one pattern, as names; a larger one is refused."""
    rows = dictionary.select("brand").distinct().orderBy("brand").limit(MAX_PATTERN_BRANDS + 1)
    return checked_brands([r.brand for r in rows.collect()])


def dictionary_from_catalogue(catalogue: DataFrame, column: str = "marca") -> DataFrame:
    """Dictionary rule: the distinct normalised brand names of a vehicle catalogue."""
    name = normalize_text(F.col(column), drop_punctuation=False)
    return catalogue.select(name.alias("brand")).where("brand != ''").distinct()


def dictionary_table(spark: SparkSession, brands: Sequence[str] = STARTER_BRANDS) -> DataFrame:
    return inline_table(spark, [(b,) for b in brands], ("brand",))


def longest_first(dictionary: DataFrame) -> DataFrame:
    """Dictionary order of the prefix match: longer names first, then by name."""
    return dictionary.orderBy(F.length("brand").desc(), "brand")


def match_by_join(texts: DataFrame, column: str, dictionary: DataFrame) -> DataFrame:
    """(column, brand) for every distinct text, for dictionaries of any size.

    A text offers its own prefixes, one for each name length the dictionary has, and an equi-join
    keeps the ones that are names. The longest hit is found from its length alone, so the aggregate
    buffer is a number, and the prefixes stay in the partition of their text: one shuffle in all.
    """
    lengths = sorted(r.n for r in dictionary.select(F.length("brand").alias("n")).distinct().collect())
    distinct = texts.select(column).where(F.col(column).isNotNull()).distinct()
    sizes = F.array(*[F.lit(n) for n in lengths]) if lengths else F.array().cast("array<int>")
    fitting = F.filter(sizes, lambda n: n <= F.length(column))
    prefixes = distinct.select(column, F.explode(fitting).alias("n")).withColumn(
        "brand", F.substring(F.col(column), F.lit(1), F.col("n"))
    )
    hits = prefixes.join(dictionary.select("brand").distinct(), "brand")
    best = hits.groupBy(column).agg(F.max("n").alias("n"))
    return best.select(column, F.substring(F.col(column), F.lit(1), F.col("n")).alias("brand"))


def _probes_before(target: int, count: int) -> list[int]:
    """The shorter positions a binary search over `count` lengths tries on its way to `target`."""
    low, high, tried = 0, count - 1, []
    while (mid := (low + high) // 2) != target:
        if mid < target:
            tried.append(mid)
            low = mid + 1
        else:
            high = mid - 1
    return tried


def search_table(dictionary: DataFrame, lengths: Sequence[int]) -> DataFrame:
    """(prefix, found): what a search by length can meet, and the length of the longest name each entry starts with.

    Besides the names these are markers: beginnings of longer names, at the lengths the search tries before theirs.
    They say that longer names may follow, and hold the answer should none. A name has at most log2(lengths) markers.
    """
    names = dictionary.select("brand").where("brand != ''").distinct()
    own = [F.array(*[F.lit(lengths[i]) for i in (*_probes_before(at, len(lengths)), at)]) for at in range(len(lengths))]
    stops = F.element_at(F.array(*own), F.array_position(F.array(*[F.lit(n) for n in lengths]), F.length("brand")).cast("int"))
    prefix = F.substring(F.col("brand"), F.lit(1), F.col("n")).alias("prefix")
    entries = names.select("brand", F.explode(stops).alias("n")).select(prefix).distinct()
    answers = match_by_join(entries, "prefix", names).select("prefix", F.length("brand").alias("found"))
    return entries.join(answers, "prefix", "left").select("prefix", F.coalesce("found", F.lit(0)).alias("found"))


def match_by_search(texts: DataFrame, column: str, dictionary: DataFrame) -> DataFrame:
    """(column, brand) for every distinct text with a hit, by a binary search over the lengths of the names.

    Where `match_by_join` makes a row for each length, a text here stays one row and is looked up log2(lengths)
    times. Texts that start with no first letter of a name never enter. A beginning that many texts share is counted
    before each look-up and dealt over several tasks, its entry being repeated for each, so no task gets it whole.
    Null texts and empty names take no part.
    """
    spark = texts.sparkSession
    names = dictionary.select("brand").where("brand != ''").distinct()
    lengths = sorted(r.n for r in names.select(F.length("brand").alias("n")).distinct().collect())
    entries = settle(search_table(names, lengths), "entries") if lengths else None
    first = names.select(F.substring("brand", 1, 1).alias("_first")).distinct()
    rows = texts.select(F.col(column).alias("_text")).where(F.col(column).isNotNull()).distinct()
    # as many rows as there are first letters, so their number is bounded by the alphabet
    rows = rows.join(F.broadcast(first), F.substring("_text", 1, 1) == F.col("_first"), "left_semi")
    state = rows.select("_text", F.lit(0).alias("_low"), F.lit(len(lengths) - 1).alias("_high"), F.lit(0).alias("_found"))
    for _ in range(len(lengths).bit_length()):
        state, total = settle_counted(state, "search")
        state = _look_up(state, entries, lengths, max(HOT_TEXTS, total // (4 * int(spark.conf.get("spark.sql.shuffle.partitions")))))
    hit = F.substring(F.col("_text"), F.lit(1), F.col("_found")).alias("brand")
    return state.where("_found > 0").select(F.col("_text").alias(column), hit)


def _look_up(state: DataFrame, entries: DataFrame, lengths: Sequence[int], most: int) -> DataFrame:
    """One step of the search; a beginning that more than `most` texts ask for is dealt over tasks."""
    middle = F.expr("(_low + _high) div 2").cast("int")
    size = F.element_at(F.array(*[F.lit(n) for n in lengths]), F.col("_middle") + 1)
    asking = (F.col("_low") <= F.col("_high")) & (F.length("_text") >= F.col("_size"))
    asked = (
        state.withColumn("_middle", middle)
        .withColumn("_size", F.when(F.col("_low") <= F.col("_high"), size))
        .withColumn("_asked", F.when(asking, F.substring(F.col("_text"), F.lit(1), F.col("_size"))))
    )
    # at most 4 x shuffle partitions of them by the choice of `most`, hence the broadcast
    hot = (
        asked.where(F.col("_asked").isNotNull()).groupBy("_asked").agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > most).select("_asked", F.ceil(F.col("_n") / most).cast("int").alias("_parts"))
    )
    # texts that ask for nothing are spread too: a NULL key would gather them
    spread = F.pmod(F.xxhash64("_text"), F.coalesce("_parts", F.when(F.col("_asked").isNull(), F.lit(1 << 20)), F.lit(1)))
    left = asked.join(F.broadcast(hot), "_asked", "left").withColumn("_part", spread)
    left = left.withColumn("_asked", F.coalesce("_asked", F.lit("")))
    right = (
        entries.join(F.broadcast(hot.withColumnRenamed("_asked", "prefix")), "prefix", "left")
        .withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)))
        .select(F.col("prefix").alias("_asked"), F.col("_part").cast("long"), F.col("found").alias("_answer"))
    )
    met = F.col("_answer").isNotNull()
    return left.join(right, ["_asked", "_part"], "left").select(
        "_text",
        F.when(met, F.col("_middle") + 1).otherwise(F.col("_low")).alias("_low"),
        F.when(met, F.col("_high")).otherwise(F.col("_middle") - 1).alias("_high"),
        F.greatest("_found", F.coalesce("_answer", F.lit(0))).alias("_found"),
    )
