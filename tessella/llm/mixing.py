"""Mixing sources to target weights, by blocks of words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm.common import cut, table, text_or_empty

#: Primes above 2 ** 30; at most one of them divides a number of blocks.
STRIDES = (1073741827, 1073741831)
WORD = r"[^\x20\x09-\x0D]+"
CELLS = 4096
#: Slots of an output shard if not told otherwise, of a row that is unfolded at once, and of a task.
SHARD, RUN, TASK = 1 << 20, 1 << 12, 1 << 16


def word_count(text: Column) -> Column:
    return F.when(F.length(text) == 0, F.lit(0)).otherwise(F.regexp_count(text, F.lit(WORD))).cast("bigint")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3) -> DataFrame:
    """Add ``target`` to (source, source_size): shares of all sizes by weight, none above ``most`` times its size.

    Sources are taken by code point, null last, and get the weights in turn. What a full source cannot take is shared
    by weight among the others until none is above: sources fill in the order of size over weight, so it is enough to
    find the first one that is not full.
    """
    by_rank = "ORDER BY ratio, place"
    d = sizes.withColumn("place", F.expr("row_number() OVER (ORDER BY source ASC NULLS LAST)"))
    d = d.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.col("place") - 1, F.lit(len(weights))).cast("int") + 1))
    d = d.withColumn("full", F.col("source_size") * most).withColumn("ratio", F.col("full") / F.col("weight"))
    d = d.withColumns({"before": F.expr(f"sum(full) OVER ({by_rank}, source_size ROWS UNBOUNDED PRECEDING) - full"), "open": F.expr(f"sum(weight) OVER () - sum(weight) OVER ({by_rank}, source_size ROWS UNBOUNDED PRECEDING) + weight"), "total": F.expr("sum(source_size) OVER ()")})
    d = d.withColumn("level", (F.col("total") - F.col("before")) / F.col("open"))
    d = d.withColumn("level", F.expr("min(CASE WHEN level <= ratio THEN struct(ratio, place, level) END) OVER ()").getField("level"))
    return d.withColumn("target", F.least(F.col("full").cast("double"), F.col("weight") * F.col("level"))).select("source", "place", "source_size", F.coalesce("target", F.lit(0.0)).alias("target"))


def permuted(df: DataFrame, index: str, of: str, keys: list[str], seed: int, rounds: int = 6) -> DataFrame:
    """Replace ``index`` by its place in a pseudorandom permutation of 0 .. ``of`` - 1: a coprime stride, then rounds of swap-or-not."""
    stride = F.when(F.col(of) % STRIDES[0] != 0, F.lit(STRIDES[0])).otherwise(F.lit(STRIDES[1]))
    start = F.pmod(F.col(index) * stride + F.pmod(F.xxhash64(*keys, F.lit(seed)), F.col(of)), F.col(of))

    def swap_or_not(at: Column, k: Column) -> Column:
        other = F.pmod(F.xxhash64(*keys, k, F.lit(seed)) % F.col(of) + F.col(of) - at, F.col(of))
        return F.when(F.xxhash64(*keys, F.greatest(at, other), k) % 2 == 0, other).otherwise(at)

    # A lambda, since repeated projections of one another would be copied into each other's filters.
    return df.withColumn(index, F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, swap_or_not))


def draw(plan: DataFrame, n: int, shards: int, seed: int) -> DataFrame:
    """(place, shard, first, taken): which stretch of each source's slots, of ``n`` of all sources, every output shard gets.

    Every slot of every shard draws its source from the multinomial of the targets. Where a source was drawn more often
    than its target allows, its last slots go to the sources that were drawn too seldom, in order.
    """
    spark = plan.sparkSession
    per = max(1, -(-n // shards))
    plan = plan.withColumn("to", F.expr("sum(slots) OVER (ORDER BY place ROWS UNBOUNDED PRECEDING)")).withColumn("from", F.expr("to - slots"))
    cells = plan.filter("slots > 0").select("place", "from", "to", F.explode(F.expr(f"sequence(from * {CELLS} div {max(n, 1)}, (to - 1) * {CELLS} div {max(n, 1)})")).alias("cell"))
    slots = spark.range(n).withColumn("u", F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(max(n, 1)))).select(F.expr(f"id div {per}").alias("shard"), "u", F.expr(f"u * {CELLS} div {max(n, 1)}").alias("cell"))
    drawn = slots.join(cells, "cell").filter("u >= from AND u < to").groupBy("place", "shard").agg(F.count("*").alias("n"))
    counts = cut(drawn, "mix-drawn").join(plan.select("place", "slots"), "place").withColumn("before", F.expr("sum(n) OVER (PARTITION BY place ORDER BY shard ROWS UNBOUNDED PRECEDING) - n"))
    counts = counts.withColumn("taken", F.expr("greatest(0, least(n, slots - before))"))
    spare = counts.groupBy("shard").agg(F.sum(F.col("n") - F.col("taken")).alias("n")).filter("n > 0").withColumn("to", F.expr("sum(n) OVER (ORDER BY shard ROWS UNBOUNDED PRECEDING)")).withColumn("from", F.expr("to - n"))
    short = plan.select("place", "slots").join(counts.groupBy("place").agg(F.sum("taken").alias("had")), "place", "left").select("place", F.coalesce("had", F.lit(0)).alias("had"), (F.col("slots") - F.coalesce("had", F.lit(0))).alias("n")).filter("n > 0")
    short = short.withColumn("to", F.expr("sum(n) OVER (ORDER BY place ROWS UNBOUNDED PRECEDING)")).withColumn("from", F.expr("to - n"))
    # Both lists tile 0 .. spare: cut them at each other's ends with one sort instead of comparing them pairwise.
    ends = spare.select("to").union(short.select("to")).distinct().withColumn("start", F.expr("coalesce(lag(to) OVER (ORDER BY to), 0)"))
    tiles = ends.select("start", F.col("to").alias("end"), F.lit(None).cast("bigint").alias("shard"), F.lit(None).cast("bigint").alias("place"), F.lit(None).cast("bigint").alias("had"), F.lit(None).cast("bigint").alias("base"), F.lit(1).alias("last"))
    marks = spare.select(F.col("from").alias("start"), F.lit(None).cast("bigint").alias("end"), "shard", F.lit(None).cast("bigint").alias("place"), F.lit(None).cast("bigint").alias("had"), F.lit(None).cast("bigint").alias("base"), F.lit(0).alias("last"))
    marks = marks.union(short.select(F.col("from").alias("start"), F.lit(None).cast("bigint"), F.lit(None).cast("bigint"), F.col("place").cast("bigint"), F.col("had").cast("bigint"), F.col("from").cast("bigint"), F.lit(0)))
    over = "OVER (ORDER BY start, last ROWS UNBOUNDED PRECEDING)"
    moved = tiles.union(marks).select("start", "end", "last", *[F.expr(f"last_value({c}, true) {over}").alias(c) for c in ("shard", "place", "had", "base")]).filter("last = 1")
    moved = moved.select("place", "shard", F.expr("had + start - base").alias("first"), F.expr("end - start").alias("taken"))
    return counts.filter("taken > 0").select(F.col("place").cast("bigint").alias("place"), "shard", F.col("before").alias("first"), "taken").union(moved)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = (5, 2, 1), most: int = 3, block_words: int = 128, shards: int | None = None, rows_per_bucket: int = 4_000, seed: int = 29, row_col: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Mix the sources of ``docs`` to their targets; returns (sized, pieces, slots).

    sized: _row, id, source, size, place, source_size, target of every row. pieces: the stretches of words (_row,
    first_word, words) that make up block (place, block). slots: (shard, slot, place, epoch, block), the mix: blocks of
    ``block_words`` words in the order in which each output shard takes them; a source's blocks are used up in
    pseudorandom order before any is used again, so that no document is taken more than ``most`` times.

    A null text has no words; null is a source of its own, the last; documents without words are in no block. Repeated
    rows are separate rows. An empty table gives three empty results. Offsets of words in a source come from sums over
    hash buckets of about ``rows_per_bucket`` rows, not from one window over a source, so a source with a third of all
    rows is spread like any other. There are 64 ``shards``, more beyond 64 times ``SHARD`` slots.
    """
    text = text_or_empty(text_col)
    row = F.monotonically_increasing_id() if row_col is None else F.col(row_col)
    sized = cut(docs.select(row.alias("_row"), F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(text).alias("size"), F.xxhash64(F.col(id_col), text).alias("hash")), "mix-sized")
    buckets = max(1, -(-sized.count() // rows_per_bucket))
    plan = cut(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most), "mix-targets")
    plan = plan.withColumn("blocks", F.expr(f"(source_size + {block_words - 1}) div {block_words}"))
    plan = plan.withColumn("slots", F.when(F.col("source_size") > 0, F.least(F.round(F.col("target") * F.col("blocks") / F.col("source_size")).cast("bigint"), most * F.col("blocks"))).otherwise(F.lit(0)))
    sized = _with_plan(sized.withColumn("bucket", F.pmod("hash", F.lit(buckets))), plan)

    sums = sized.groupBy("place", "bucket").agg(F.sum("size").alias("n")).select("place", "bucket", F.expr("sum(n) OVER (PARTITION BY place ORDER BY bucket ROWS UNBOUNDED PRECEDING) - n").alias("base"))
    worded = sized.filter("size > 0").withColumn("within", F.expr("sum(size) OVER (PARTITION BY place, bucket ORDER BY id, hash, _row ROWS UNBOUNDED PRECEDING) - size"))
    worded = worded.join(sums, ["place", "bucket"]).withColumn("at", F.col("base") + F.col("within"))
    pieces = worded.select("_row", "place", "at", "size", F.explode(F.expr(f"sequence(at div {block_words}, (at + size - 1) div {block_words})")).alias("block"))
    pieces = pieces.select("_row", "place", "block", F.expr(f"greatest(at, block * {block_words}) - at").alias("first_word"), F.expr(f"least(at + size, (block + 1) * {block_words}) - greatest(at, block * {block_words})").alias("words"))

    n = plan.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0]
    slots = draw(plan, n, shards or max(64, n // SHARD), seed).join(plan.select("place", "blocks"), "place")
    # A stretch is unfolded in two steps, so that no array holds more than RUN slots or stretches of a shard, and no task much more than TASK.
    slots = slots.select("place", "blocks", "shard", F.expr("first + taken - 1").alias("last"), F.explode(F.expr(f"sequence(first, first + taken - 1, {RUN})")).alias("start"))
    slots = slots.repartition(min(20_000, 1 + n // TASK), "place", "start").select("place", "blocks", "shard", F.explode(F.expr(f"sequence(start, least(last, start + {RUN - 1}))")).alias("slot"))
    slots = slots.withColumn("epoch", F.expr("slot div blocks")).withColumn("block", F.expr("slot % blocks"))
    slots = permuted(slots, "block", "blocks", ["place", "epoch"], seed).select("shard", "slot", "place", "epoch", "block")
    return sized, pieces, slots


def _with_plan(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows with their source's place, size and target; the few sources are broadcast only while counted few."""
    few = plan.select(F.col("source").alias("_source"), "place", "source_size", "target")
    return sized.join(F.broadcast(few) if few.count() <= 100_000 else few, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")


def taken_words(sized: DataFrame, pieces: DataFrame, slots: DataFrame) -> DataFrame:
    """Words that the mix takes of every row, repeats counted."""
    times = slots.groupBy("place", "block").agg(F.count("*").alias("times"))
    taken = pieces.join(times, ["place", "block"]).groupBy("_row").agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    return sized.join(taken, "_row", "left").withColumn("taken", F.coalesce("taken", F.lit(0)))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", chars_col: str | None = "n_chars", **options: int) -> DataFrame:
    """The mix as documents: copy c of a row holds those of its blocks' stretches that the mix takes at least c times.

    A copy of all stretches keeps its text as it was; otherwise its words are joined by single blanks. Rows that the mix does not take, and those
    without words, are left out. Returns the columns of ``docs``, ``chars_col`` (if there is one) counted again.
    """
    names = docs.columns
    base = cut(docs.withColumn("_row", F.monotonically_increasing_id()), "mix-documents")
    _, pieces, slots = mix(base, id_col, text_col, source_col, row_col="_row", **options)
    times = slots.groupBy("place", "block").agg(F.count("*").cast("int").alias("times"))
    taken = pieces.join(times, ["place", "block"], "left").withColumn("times", F.coalesce("times", F.lit(0)))
    taken = taken.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("first_word", "words", "times"))).alias("_pieces"), F.max("times").alias("_most"), F.min("times").alias("_least")).filter("_most > 0")
    copies = base.join(taken, "_row").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_most"))))
    words = F.regexp_extract_all(F.col(text_col), F.lit(WORD), F.lit(0))
    part = F.expr("flatten(transform(filter(_pieces, p -> p.times >= _copy), p -> slice(_words, int(p.first_word) + 1, int(p.words))))")
    copies = copies.withColumn("_words", F.when(F.col("_copy") > F.col("_least"), words)).withColumn(text_col, F.when(F.col("_copy") <= F.col("_least"), F.col(text_col)).otherwise(F.array_join(part, " ")))
    if chars_col in names:
        copies = copies.withColumn(chars_col, F.length(text_col).cast(docs.schema[chars_col].dataType))
    return copies.select(*names)


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = taken_words(*mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source")))
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")
