"""Quality rules and the log-likelihood ratio of hashed n-grams, in DataFrame operations only."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from math import log

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sootledger.llm.shared import cut, documents, held_out, words

BUCKETS = 1 << 14  # at least; beyond, the buckets follow the corpus
LOAD = 64  # n-grams a bucket, at most
PRIOR = 16
PAGE = 1024  # buckets a row of the table
COUNTED = 1 << 26  # n-grams a task counts, at least, where there are as many tasks as cores
PACKED = 1 << 25  # buckets that are broadcast at a time, at most: 128 MB
PAGE_BYTES = 4352  # a page in memory, with what stands around its ratios
UNIT = float(1 << 20)
BLOCKS = 1 << 14  # bitmaps of ids, 4 KB each
RUN = 8
LEAST_WORDS = 20
MOST_REPEATED = 30
LEAST_RATIO = -0.1
FOUND = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "ratio", "kept")


def bucket(gram: Column) -> Column:
    return F.pmod(gram, F.lit(BUCKETS)).cast("int")


def hashed(word: Column) -> Column:
    return F.xxhash64(word)


def joined(left: Column, right: Column) -> Column:
    """Hash of two neighbouring pieces from the hashes of both."""
    return F.xxhash64(left, right)


def neighbours(hashes: str, apart: int) -> Column:
    """Hashes of all pieces made of two pieces that begin `apart` words from each other."""
    left = F.slice(hashes, 1, F.greatest(F.size(hashes) - apart, F.lit(0)))
    return F.transform(left, lambda h, i: joined(h, F.get(hashes, i + apart)))


def flagged(docs: DataFrame, ids: DataFrame, most: int = BLOCKS) -> DataFrame:
    """Add `trusted`: whether the document's id is among the given ids. NULL is not.

    The ids are folded into bitmaps of 32,768 neighbouring ids, 4 KB each. Up to `most` bitmaps are
    broadcast, so no text moves; where the ids lie in more blocks, documents and ids meet in a
    shuffle instead, with the same result.
    """
    ids = ids.where(F.col("doc_id").isNotNull()).select("doc_id")
    block = F.bitmap_bucket_number("doc_id")
    if ids.select(block.alias("_block")).distinct().limit(most + 1).count() > most:
        met = docs.join(ids.distinct().withColumn("trusted", F.lit(True)), "doc_id", "left")
        return met.withColumn("trusted", F.coalesce("trusted", F.lit(False)))
    maps = ids.groupBy(block.alias("_block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("doc_id")).alias("_map")
    )
    place = F.bitmap_bit_position("doc_id")
    byte = F.substring("_map", F.floor(place / 8).cast("int") + 1, F.lit(1))
    bit = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (place % 8).cast("int"))
    met = docs.join(F.broadcast(maps), block == F.col("_block"), "left")
    return met.withColumn("trusted", F.coalesce(bit == 1, F.lit(False))).drop("_block", "_map")


def bucket_counts(docs: DataFrame) -> tuple[dict[int, int], dict[int, int]]:
    """How often each bucket occurs among words and pairs of neighbouring words: in trusted texts, in all.

    Takes rows (text, trusted). At most BUCKETS rows reach the driver.
    """
    found = docs.select("trusted", words(F.col("text")).alias("found"))
    after = F.slice("found", 2, F.greatest(F.size("found"), F.lit(1))).alias("after")
    pairs = found.select("trusted", F.explode(F.arrays_zip("found", after)).alias("p"))
    hashes = pairs.select(
        "trusted", hashed(F.col("p.found")).alias("own"), hashed(F.col("p.after")).alias("after"),
        F.col("p.after").isNotNull().alias("has"),
    )
    pair = F.when(F.col("has"), bucket(joined(F.col("own"), F.col("after"))))
    grams = hashes.select("trusted", F.explode(F.array(bucket(F.col("own")), pair)).alias("bucket"))
    counts = (
        grams.where(F.col("bucket").isNotNull())
        .groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.count_if("trusted").alias("t")).collect()
    )
    return {r["bucket"]: r["t"] for r in counts}, {r["bucket"]: r["n"] for r in counts}


def log_ratios(target: dict[int, int], raw: dict[int, int]) -> list[float]:
    """log of target over raw probability of each bucket.

    Both counts are raised by PRIOR n-grams, of which the target has its share of all n-grams: a
    bucket that was seen seldom says little, whatever the size of the corpus, and no target says nothing.
    """
    share = sum(target.values()) / max(sum(raw.values()), 1)
    if share == 0:
        return [0.0] * BUCKETS
    return [log((target.get(b, 0) + PRIOR * share) / ((raw.get(b, 0) + PRIOR) * share)) for b in range(BUCKETS)]


@dataclass
class Table:
    """Log ratios of more than BUCKETS buckets: rows (page, ratios), each PAGE ratios in units of 1 / UNIT."""

    pages: DataFrame
    buckets: int

    def sums(self, docs: DataFrame) -> DataFrame:
        """Rows (_key, _sum) of rows (_key, text) that have n-grams: the sum of their log ratios.

        The key stands for the text, so it does not matter how often, where or in which splits rows are read: rows
        of one key are added up, and the sum is divided by their number. N-grams never move, only sums do: a table
        that the driver can hold is broadcast, a larger one slice by slice, and the texts are read once a slice.
        Sums of integers do not depend on the order.
        """
        slices, pages = -(-self.buckets // slice_size(docs.sparkSession)), -(-self.buckets // PAGE)
        bounds = [pages * i // slices for i in range(slices + 1)]
        looked_up = (self._part(docs, a, b) for a, b in zip(bounds, bounds[1:]))
        if slices == 1:
            whole = next(looked_up)
        else:  # each slice is summed up before the next one is made, so that one is broadcast at a time
            parts = reduce(DataFrame.unionByName, map(cut, looked_up))
            whole = parts.groupBy("_key").agg(F.sum("_r").alias("_r"), F.max("_rows").alias("_rows"))
        return whole.select("_key", (F.col("_r") / F.col("_rows") / UNIT).alias("_sum"))

    def _part(self, docs: DataFrame, begin: int, end: int) -> DataFrame:
        """Rows (_key, _r, _rows): the sum of the n-grams in some pages, and the number of rows that have n-grams."""
        pages, first = self.pages, F.col("_at") == 0
        places = [F.pmod(gram, F.lit(self.buckets).cast("long")).alias(gram) for gram in ("_one", "_pair")]
        found = hashed_words(docs).select("_key", first.alias("_first"), *places)
        if (begin, end) != (0, -(-self.buckets // PAGE)):
            pages = pages.where((F.col("page") >= begin) & (F.col("page") < end))
            own = [(F.col(g) >= begin * PAGE) & (F.col(g) < end * PAGE) for g in ("_one", "_pair")]
            found = found.where(F.coalesce(own[0] | own[1] | F.col("_first"), F.lit(False)))
        for gram in ("_one", "_pair"):
            side = F.broadcast(pages.select(F.col("page").alias("_page"), F.col("ratios").alias("_ratios")))
            at = F.shiftright(gram, 10)
            looked = F.get("_ratios", place_of(gram)).cast("long")
            rest = [c for c in found.columns if c != gram]
            found = found.join(side, at == F.col("_page"), "left").select(*rest, F.coalesce(looked, F.lit(0)).alias(f"r{gram}"))
        return found.groupBy("_key").agg(
            F.sum(F.col("r_one") + F.col("r_pair")).alias("_r"), F.count_if("_first").alias("_rows")
        )


def slice_size(spark: SparkSession) -> int:
    """Buckets that are broadcast at a time: PACKED, or what takes a twelfth of the driver's memory.

    While it builds a broadcast, the driver holds the slice some four times, beside the blocks of earlier ones.
    """
    heap = spark.sparkContext._jvm.java.lang.Runtime.getRuntime().maxMemory()
    return max(PAGE, min(PACKED, heap // 12 // PAGE_BYTES * PAGE))


def page_of(bucket: str) -> Column:
    return F.shiftright(bucket, 10).alias("page")


def place_of(bucket: str) -> Column:
    return F.col(bucket).bitwiseAND(F.lit(PAGE - 1)).cast("int").alias("place")


def placed_grams(docs: DataFrame, buckets: int, first: bool = False) -> DataFrame:
    """One row for each word and pair of neighbouring words: all columns but the text, and `bucket`.

    `first` adds whether it is the first one of its row.
    """
    kept = [c for c in docs.columns if c != "text"]
    grams = hashed_words(docs).select(*kept, "_at", "_more", F.posexplode(F.array("_one", "_pair")).alias("_kind", "_gram"))
    grams = grams.where((F.col("_kind") == 0) | F.col("_more"))
    if first:
        kept = [*kept, ((F.col("_at") == 0) & (F.col("_kind") == 0)).alias("_first")]
    return grams.select(*kept, F.pmod("_gram", F.lit(buckets).cast("long")).alias("bucket"))


def hashed_words(docs: DataFrame) -> DataFrame:
    """One row for each word: all columns but the text, its place `_at`, its hash `_one`, `_more`, whether one follows, and then `_pair`.

    Words are hashed behind the generator, where Spark compiles it; inside a function over an array each word
    would be interpreted.
    """
    kept = [c for c in docs.columns if c != "text"]
    one = docs.select(*kept, words(F.col("text")).alias("_words"))
    after = F.slice("_words", 2, F.greatest(F.size("_words"), F.lit(1)))
    met = one.select(*kept, F.posexplode(F.arrays_zip(F.col("_words").alias("one"), after.alias("two"))).alias("_at", "_word"))
    hashes = met.select(*kept, "_at", hashed(F.col("_word.one")).alias("_one"), hashed(F.col("_word.two")).alias("_two"),
                        F.col("_word.two").isNotNull().alias("_more"))
    pair = F.when(F.col("_more"), joined(F.col("_one"), F.col("_two")))
    return hashes.select(*kept, "_at", "_more", "_one", pair.alias("_pair"))


def table_of(marked: DataFrame, total: int, share: float) -> Table:
    """The same ratios as log_ratios, counted and kept as a table, with a bucket for each LOAD n-grams."""
    buckets = -(-total // LOAD)
    # A task sends one row for each bucket it has seen: few tasks send least. All cores stay busy, and no task
    # counts much more than COUNTED n-grams, so their number follows the corpus.
    tasks = max(marked.sparkSession.sparkContext.defaultParallelism, -(-total // COUNTED))
    counts = placed_grams(marked.select("trusted", "text").coalesce(tasks), buckets).groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("trusted").cast("long")).alias("t")
    )
    ratio = F.log((F.col("t") + PRIOR * share) / ((F.col("n") + PRIOR) * share)) if share else F.lit(0.0)
    entry = F.struct(place_of("bucket"), F.round(ratio * UNIT).cast("int").alias("ratio"))
    pages = counts.groupBy(page_of("bucket")).agg(F.collect_list(entry).alias("seen"))
    unseen = F.array_except(F.sequence(F.lit(0), F.lit(PAGE - 1)), F.col("seen.place"))
    filled = F.concat("seen", F.transform(unseen, lambda i: F.struct(i.alias("place"), F.lit(0).alias("ratio"))))
    return Table(cut(pages.select("page", F.sort_array(filled).getField("ratio").alias("ratios"))), buckets)


def fit(docs: DataFrame, labels: DataFrame) -> list[float] | Table:
    """Ratios of the trusted texts (label quality 1, not held out) to all texts."""
    trusted = labels.where((F.col("quality") == 1) & ~held_out(F.col("doc_id")))
    marked = flagged(docs.select("doc_id", "text"), trusted)
    n = F.greatest(2 * F.size(words(F.col("text"))).cast("long") - 1, F.lit(0).cast("long"))
    total, target = marked.agg(F.sum(n), F.sum(F.when(F.col("trusted"), n))).first()
    if (total or 0) <= LOAD * BUCKETS:
        return log_ratios(*bucket_counts(marked))
    return table_of(marked, total, (target or 0) / total)


def _total(hashes: str, table: Column) -> Column:
    return F.aggregate(hashes, F.lit(0.0), lambda total, h: total + F.get(table, bucket(h)))


def rated(docs: DataFrame, ratios: list[float] | Table, least: float = LEAST_RATIO) -> DataFrame:
    """Add counts, base_failed, ratio and kept; columns of the caller's with these names are replaced.

    n_repeat_words are the words that windows of eight words cover which occur twice or more in the text.
    ratio is the mean log ratio over the text's n-grams; a text with none has 0. NULL counts as
    empty, and an empty text fails the base rules. Repeated rows are rated alike.
    """
    docs = docs.drop(*FOUND)
    if isinstance(ratios, Table):
        return _rated_by_table(docs.withColumn("_key", text_key()), ratios, least).drop("_key")
    table = F.split(F.lit(",".join(map(repr, ratios))), ",").cast("array<double>")
    return _rated(docs, table, least)


def text_key() -> Column:
    """What stands for a text where rows meet: its SHA-256."""
    return F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256))


def _rated_by_table(docs: DataFrame, ratios: Table, least: float) -> DataFrame:
    """The same for rows with `_key`, the key of their text, on which they meet their sums."""
    based = _rated(docs, None, least)
    met = based.join(ratios.sums(docs.select("_key", "text")), "_key", "left")
    ratio = F.coalesce("_sum", F.lit(0.0)) / F.greatest(2 * F.col("n_words") - 1, F.lit(1))
    judged = met.withColumn("ratio", ratio).withColumn("kept", ~F.col("base_failed") & (F.col("ratio") >= least))
    return judged.select(*based.columns)


def _rated(docs: DataFrame, table: Column | None, least: float) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    one = docs.select("*", words(F.col("text")).alias("_words"), lines.alias("_lines"))
    # Hashes of single words, then of two, four and eight words in a row, each from two of the last kind.
    ones = one.select(
        *docs.columns,
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.transform("_words", hashed).alias("_one"),
    )
    kept_columns = [c for c in ones.columns if c != "_one"]
    twos = ones.select("*", neighbours("_one", 1).alias("_two"))
    total = F.lit(0.0) if table is None else _total("_one", table) + _total("_two", table)
    fours = twos.select(*kept_columns, neighbours("_two", 2).alias("_four"), total.alias("_sum"))
    # A window of eight words that occurs twice has halves that do.
    repeats = F.size(F.array_distinct("_four")) < F.size("_four")
    two = fours.select(*kept_columns, "_sum", F.when(repeats, neighbours("_four", 4)).alias("_windows"))
    # Only texts that repeat a window sort them.
    sorted_windows = F.when(
        F.size(F.array_distinct("_windows")) < F.size("_windows"),
        F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    )
    three = two.select(*[c for c in two.columns if c != "_windows"], sorted_windows.alias("_sorted"))
    twice = F.filter(
        "_sorted",
        lambda w, k: ((k > 0) & (w.h == F.get("_sorted", F.greatest(k - 1, F.lit(0))).h))
        | (w.h == F.get("_sorted", k + 1).h),
    )
    places = F.sort_array(F.transform(twice, lambda w: w.i))
    covered = F.aggregate(
        places,
        F.struct(F.lit(-RUN).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda seen, i: F.struct(i.alias("last"), (seen.n + F.least(F.lit(RUN), i - seen["last"])).alias("n")),
        lambda seen: seen.n,
    )
    four = three.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long")))
    grams = F.greatest(2 * F.col("n_words") - 1, F.lit(1))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    five = four.withColumns({"base_failed": failed, "ratio": F.col("_sum") / grams}).withColumn(
        "kept", ~F.col("base_failed") & (F.col("ratio") >= least)
    )
    # Behind a generator: a caller's filter would else be pushed below the projections, and
    # repeat their work inside every lambda.
    found = [c for c in five.columns if c not in (*docs.columns, "_sum", "_sorted")]
    return five.select(*docs.columns, F.explode(F.array(F.struct(*found))).alias("_found")).select(
        *docs.columns, "_found.*"
    )


def kept(docs: DataFrame, ratios: list[float] | Table) -> DataFrame:
    """The documents that pass, all columns as they were, whatever their names and however rows are read.

    With a table, keys of texts are judged first, without the rows; then rows meet the keys that pass.
    """
    columns = docs.columns
    rows = docs.select(F.col("text"), F.struct(*columns).alias("_row"))
    if isinstance(ratios, Table):
        keyed = docs.select("text", text_key().alias("_key"))
        judged = _rated_by_table(keyed, ratios, LEAST_RATIO)
        good = cut(judged.where("kept").select("_key").distinct())
        rows = rows.select("_row", text_key().alias("_key")).join(good, "_key", "left_semi")
    else:
        rows = rated(rows, ratios).where("kept")
    return rows.select(*(F.col("_row").getField(c).alias(c) for c in columns))


def op2_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    ratios = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return rated(docs, ratios).drop("text")
