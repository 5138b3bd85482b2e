"""A mix of sources with target weights, in blocks of a fixed number of words. DataFrame functions only.

The words of a source, document after document, are one stream, cut into blocks. Each slot of each output shard draws a
source with the share of its target, so the counts of a shard are multinomial. The draws of a source are numbered over all
shards and permuted; the numbers below its quota of blocks stay, and draws beyond it go to sources that were drawn too rarely, so
that the whole mix has each source's quota. A draw's number gives the pass over the source and, by a pseudorandom
permutation of the source's block indexes for that pass, the block, which is then joined by its index. A pass takes each block
once, so no block comes up more often than the number of passes.

No stream, shard or source is in one task: places in a stream are sums over buckets of documents and sums inside of a
bucket; numbers of draws are sums over groups of shards and sums inside of a group.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from timberline.llm.order import numbered
from timberline.session import Workspace, materialize

WORD = r"[^\x20\x09-\x0D]+"
# Fixed by what the mix is for: weights of sources in turn, share of all words, and how often a source may be used.
WEIGHTS = (3, 1, 2)
SHARE, PASSES = 1.5, 2
# Words of a block, slots of an output shard.
BLOCK, SHARD_SLOTS = 64, 1024
SEED = 20_260_113
# Documents of a bucket, about; shards and sources that are summed up together.
BUCKET_ROWS, GROUP = 1 << 14, 1 << 12
# Parts of a range of numbers by which it is joined.
CELLS = 1 << 12
# Slots that a task draws.
RANGE_ROWS = 1 << 20
# Rounds of a permutation.
ROUNDS = 24


def permuted(x: Column, n: Column, *key: Column) -> Column:
    """A pseudorandom permutation of 0..n-1, one for each key: swap-or-not.

    A round pairs each number with another one by a reflection and swaps the pair or not, by a bit that both
    compute from the larger one. It needs no power of two, so nothing leaves the range.
    """

    def swap(number: Column, turn: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(*key, turn), n) - number, n)
        return F.when(F.pmod(F.xxhash64(*key, turn, F.greatest(number, other)), F.lit(2)) == 1, other).otherwise(number)

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), x.cast("long"), swap)


def running(df: DataFrame, keys: list[str], bucket: str, order: list[str], amount: str, name: str) -> DataFrame:
    """``df`` with ``name``: the sum of ``amount`` over the rows of ``keys`` that come before, by bucket and order."""
    behind = (Window.unboundedPreceding, -1)
    totals = df.groupBy(*keys, bucket).agg(F.sum(amount).alias("_total"))
    outer = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(*behind)
    before = totals.select(*keys, bucket, F.coalesce(F.sum("_total").over(outer), F.lit(0)).alias("_before"))
    inner = F.coalesce(F.sum(amount).over(Window.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(*behind)), F.lit(0))
    return df.withColumn("_inner", inner).join(before, [*keys, bucket]).withColumn(name, F.col("_before") + F.col("_inner")).drop("_before", "_inner")


def cells(ranges: DataFrame, first: str, count: str, total: int) -> DataFrame:
    """A row for each cell that a range touches; ranges lie one after the other and fill 0..total-1."""
    size = max(1, -(-total // CELLS))
    parts = F.sequence(F.expr(f"{first} div {size}"), F.expr(f"({first} + {count} - 1) div {size}"))
    return ranges.where(F.col(count) > 0).withColumn("_cell", F.explode(parts))


def within(df: DataFrame, number: str, ranges: DataFrame, first: str, count: str, total: int) -> DataFrame:
    """``df`` with the columns of the range that its number lies in; ``ranges`` are the ``cells`` of them."""
    size = max(1, -(-total // CELLS))
    near = df.withColumn("_cell", F.expr(f"{number} div {size}")).join(ranges, "_cell")
    return near.where((F.col(number) >= F.col(first)) & (F.col(number) < F.col(first) + F.col(count))).drop("_cell")


@dataclass
class Mix:
    """What a mix is made of. ``sources``: facts of each source; ``rows``: place of each document in its source's stream;
    ``slots``: source, pass and block of each slot."""

    sources: DataFrame
    rows: DataFrame
    slots: DataFrame
    block: int

    def pieces(self) -> DataFrame:
        """The parts of documents that blocks are made of: where in the block, where in the document, and how many words."""
        size = self.block
        last = F.expr(f"(place + size - 1) div {size}")
        blocks = self.rows.where("size > 0").withColumn("block", F.explode(F.sequence(F.expr(f"place div {size}"), last)))
        begin = F.greatest(F.col("block") * size, F.col("place"))
        end = F.least((F.col("block") + 1) * size, F.col("place") + F.col("size"))
        return blocks.select("*", (begin - F.col("block") * size).alias("offset"), (begin - F.col("place")).alias("start"), (end - begin).alias("length"))

    def contents(self) -> DataFrame:
        """``shard, slot, source_no, pass, block, offset, doc_id, digest, start, length``: what is in each slot."""
        found = self.slots.join(self.pieces(), ["source_no", "block"])
        return found.select("shard", "slot", "source_no", "pass", "block", "offset", "doc_id", "digest", "start", "length")

    def texts(self, docs: DataFrame) -> DataFrame:
        """``shard, slot, text``: the words of each slot, joined by spaces."""
        key = ["source", "doc_id", "digest"]
        own = identified(docs).dropDuplicates(key).select(*[F.col(name).alias(f"own_{name}") for name in key], "text")
        rows = self.rows.where("size > 0").join(self.sources.select("source_no", "source"), "source_no")
        same = [F.col(f"own_{name}").eqNullSafe(F.col(name)) for name in key]
        words = rows.join(own, same).select("source_no", "place", F.posexplode(F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).alias("at", "word"))
        words = words.withColumn("at", F.col("place") + F.col("at"))
        line = F.transform(F.sort_array(F.collect_list(F.struct("at", "word"))), lambda x: x["word"])
        blocks = words.groupBy("source_no", F.expr(f"at div {self.block}").alias("block")).agg(F.array_join(line, " ").alias("text"))
        return self.slots.join(blocks, ["source_no", "block"]).select("shard", "slot", "text")


def identified(docs: DataFrame) -> DataFrame:
    """``source, doc_id, digest, text``: rows that agree in the first three are copies of each other."""
    return docs.select(F.col("source").cast("string").alias("source"), "doc_id", F.xxhash64("text").alias("digest"), "text")


def targets(sources: DataFrame, share: float, most: float) -> DataFrame:
    """``sources`` with ``target``: shares by ``weight``, none above ``most`` times ``source_size``.

    What a source cannot take is shared out again by weight among the others, until none is above. Only sums leave a round.
    """
    cap = F.col("source_size") * float(most)
    total = sources.agg(F.sum("source_size").alias("total")).first().total or 0
    level, full = 0.0, -1
    while True:
        above = F.col("weight") * F.lit(level) > cap
        sums = sources.agg(
            F.coalesce(F.sum(F.when(above, cap)), F.lit(0.0)).alias("taken"),
            F.sum(F.when(above, 0).otherwise(F.col("weight"))).alias("open"),
            F.sum(above.cast("long")).alias("full"),
        ).first()
        if sums.full == full or not sums.open:
            return sources.withColumn("target", F.least(cap, F.col("weight") * F.lit(level)) if sums.open else cap)
        full, level = sums.full, (share * total - sums.taken) / sums.open


def mix(
    docs: DataFrame,
    kept: Workspace,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    passes: int = PASSES,
    block: int = BLOCK,
    shard_slots: int = SHARD_SLOTS,
    seed: int = SEED,
) -> Mix:
    """The mix of ``doc_id, text, source``. Its tables live as long as the workspace.

    Sources are in the order of code points, null last; they get the weights in turn. A null text has no words, a null id
    or source is one like any other, repeated rows count as often as they occur, and an empty table gives an empty mix;
    other columns are ignored. The same rows give the same mix, however they are partitioned.
    """
    spark = docs.sparkSession
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    # Copies are counted first: many of them are one row.
    sized = identified(docs).withColumn("size", size).groupBy("source", "doc_id", "digest", "size").agg(F.count("*").alias("copies"))
    sized = kept(sized.withColumn("words", F.col("size") * F.col("copies")), "sized")

    # --- sources: order, weights, targets, blocks and quotas
    found = sized.groupBy("source").agg(F.sum("words").alias("source_size"), F.sum("copies").alias("documents"))
    found = numbered(found.withColumn("_no_source", F.col("source").isNull()), ["_no_source", "source"], "mix-sources", "source_no").drop("_no_source")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("source_no") % len(weights) + 1).cast("int"))
    found = kept(targets(kept(found.withColumn("weight", weight), "weights"), share, passes), "targets")
    blocks = F.ceil(F.col("source_size") / block).cast("long")
    quota = F.least(passes * blocks, F.round(F.col("target") / F.col("source_size") * blocks)).cast("long")
    found = found.withColumn("blocks", blocks).withColumn("quota", F.when(F.col("source_size") > 0, quota).otherwise(0)).withColumn("_all", F.lit(0))
    found = found.withColumn("_bucket", F.floor(F.col("source_no") / GROUP))
    sources = kept(running(found, ["_all"], "_bucket", ["source_no"], "quota", "quota_start").drop("_bucket", "_all"), "sources")
    sums = sources.agg(F.sum("quota").alias("slots"), F.sum("documents").alias("documents")).first()
    total, documents = sums.slots or 0, sums.documents or 0

    # --- places of documents in the streams
    buckets = max(1, -(-documents // BUCKET_ROWS))
    names = sources.select(F.col("source").alias("_source"), "source_no")
    placed = sized.join(names, sized.source.eqNullSafe(F.col("_source"))).drop("source", "_source")
    placed = placed.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "digest", F.lit(seed)), F.lit(buckets)))
    placed = running(placed, ["source_no"], "_bucket", ["doc_id", "digest"], "words", "first")
    copies = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy")
    placed = placed.select("source_no", "doc_id", "digest", "size", "first", copies)
    rows = kept(placed.withColumn("place", F.col("first") + F.col("copy") * F.col("size")).drop("first"), "rows")

    # --- draws: one source for each slot, and their numbers within the source
    ranges = kept(cells(sources.select("source_no", "quota_start", "quota"), "quota_start", "quota", total), "quota-cells")
    slots = spark.range(0, total, 1, max(spark.sparkContext.defaultParallelism, -(-total // RANGE_ROWS))).select("id", F.floor(F.col("id") / shard_slots).alias("shard"), F.pmod(F.xxhash64("id", F.lit(seed + 1)), F.lit(max(total, 1))).alias("_draw"))
    drawn = within(slots, "_draw", ranges, "quota_start", "quota", total).select("id", "shard", "source_no")
    counts = drawn.groupBy("shard", "source_no").agg(F.count("*").alias("drawn")).withColumn("_bucket", F.floor(F.col("shard") / GROUP))
    counts = kept(running(counts, ["source_no"], "_bucket", ["shard"], "drawn", "drawn_before").drop("_bucket"), "counts")
    facts = sources.join(counts.groupBy("source_no").agg(F.sum("drawn").alias("all_drawn")), "source_no", "left").fillna({"all_drawn": 0})
    facts = facts.withColumn("lacking", F.greatest(F.col("quota") - F.col("all_drawn"), F.lit(0))).withColumn("_all", F.lit(0))
    facts = facts.withColumn("surplus", F.greatest(F.col("all_drawn") - F.col("quota"), F.lit(0))).withColumn("_bucket", F.floor(F.col("source_no") / GROUP))
    facts = running(facts, ["_all"], "_bucket", ["source_no"], "surplus", "surplus_start")
    facts = kept(running(facts, ["_all"], "_bucket", ["source_no"], "lacking", "lacking_start").drop("_bucket", "_all"), "facts")

    place = F.row_number().over(Window.partitionBy("shard", "source_no").orderBy("id")) - 1
    draws = drawn.withColumn("_place", place).join(counts, ["shard", "source_no"])
    draws = draws.join(facts.select("source_no", "quota", "all_drawn", "surplus_start"), "source_no")
    draws = draws.withColumn("number", permuted(F.col("drawn_before") + F.col("_place"), F.col("all_drawn"), F.col("source_no"), F.lit(seed + 2)))
    draws = kept(draws.select("id", "shard", "source_no", "number", "quota", "surplus_start"), "draws")
    stay = draws.where("number < quota").select("id", "shard", "source_no", "number")
    # Draws beyond a quota are numbered through, and so are the places that are lacking.
    extra = facts.agg(F.sum("surplus").alias("extra")).first().extra or 0
    lacking = kept(cells(facts.select("source_no", "lacking_start", "lacking", "all_drawn"), "lacking_start", "lacking", extra), "lacking-cells")
    moved = draws.where("number >= quota").select("id", "shard", (F.col("surplus_start") + F.col("number") - F.col("quota")).alias("_extra"))
    moved = within(moved, "_extra", lacking, "lacking_start", "lacking", extra)
    moved = moved.select("id", "shard", "source_no", (F.col("all_drawn") + F.col("_extra") - F.col("lacking_start")).alias("number"))

    # --- blocks of slots
    slots = stay.unionByName(moved).join(sources.select("source_no", "blocks"), "source_no").withColumn("pass", F.expr("number div blocks"))
    index = permuted(F.pmod("number", F.col("blocks")), F.col("blocks"), F.col("source_no"), F.col("pass"), F.lit(seed + 3))
    slots = slots.select("shard", (F.col("id") - F.col("shard") * shard_slots).alias("slot"), "source_no", "pass", index.alias("block"))
    return Mix(sources, rows, kept(slots, "slots"), block)


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of each row of ``documents``; see ``mix`` for nulls, repeated rows and empty tables."""
    with Workspace(spark, "mixing") as kept:
        made = mix(spark.read.parquet(f"{sf_dir}/documents.parquet"), kept)
        used = made.slots.groupBy("source_no", "block").agg(F.count("*").alias("times"))
        pieces = made.pieces().join(used, ["source_no", "block"], "left")
        taken = pieces.groupBy("source_no", "place", "doc_id", "size").agg(F.sum(F.col("length") * F.coalesce("times", F.lit(0))).alias("taken"))
        empty = made.rows.where("size = 0").select("source_no", "place", "doc_id", "size", F.lit(0).cast("long").alias("taken"))
        result = taken.unionByName(empty).join(made.sources.select("source_no", "source_size", "target"), "source_no")
        return materialize(result.select("doc_id", "size", "source_size", "target", "taken"), "mixed")
