"""Mixing sources to target weights, in DataFrame operations only.

The words of a source form one stream, cut into blocks of fixed length. A target in words becomes
a number of draws per source. Slots of the mix are dealt over output shards; which source a slot
draws from is decided by a pseudorandom permutation of all slots, so the counts of a shard are a
multinomial draw conditioned on the totals (independent draws would miss a target of K blocks by
about 1/sqrt(K)). The q-th draw of a source maps through the source's own pseudorandom permutation
of block indices, once per pass over the stream, and blocks are joined to documents by index.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forumlens.functions.vectors import let
from forumlens.llm.words import word_array, word_count
from forumlens.session import staged

BLOCK = 128
ROUNDS = 12
# A document's place in its source's stream is found in cells of about this many documents.
CELL_ROWS = 20_000
CAP = 3
MAX_TASKS = 20_000
# Equal rows are counted and handled in bunches of at most this many rows and about this many words.
BUNCH_ROWS, BUNCH_WORDS = 1_024, 65_536


def permuted(x: Column, n: Column, seed: Column, inverse: bool = False) -> Column:
    """Image of ``x`` under a keyed permutation of 0 .. n-1, or its pre-image.

    Every round pairs x with key - x modulo n and swaps the pair when a hash of its larger member
    says so; each round is its own inverse, so the inverse runs the rounds backwards.
    """
    rounds = range(ROUNDS - 1, -1, -1) if inverse else range(ROUNDS)

    def step(value: Column, turn: Column) -> Column:
        key = F.pmod(F.xxhash64(seed, turn), n)
        other = F.pmod(key - value, n)
        swap = F.xxhash64(seed, turn, F.greatest(value, other)) % 2 == 0
        return F.when(swap, other).otherwise(value)

    def run(start: Column) -> Column:
        return F.aggregate(F.array(*[F.lit(r) for r in rounds]), start, step)

    return run(x.cast("long"))


def source_targets(sizes: DataFrame, source: str = "source", cap: float = CAP) -> DataFrame:
    """Target words per source from (source, source_size).

    Sources in code point order, null last, weigh 1, 2, 3, 1, ...; a target stops at ``cap`` times
    the size and what is over goes to the others by weight. Sorted by cap / weight, the capped
    sources are a prefix, so one pass of running sums replaces the repeated resharing.
    """
    by_name = Window.orderBy(F.col(source).isNull(), F.col(source).cast("binary"))
    weighed = sizes.withColumn("_w", ((F.row_number().over(by_name) - 1) % 3 + 1).cast("double"))
    weighed = weighed.withColumn("_cap", cap * F.col("source_size").cast("double"))
    everything = Window.partitionBy()
    order = Window.orderBy(F.col("_cap") / F.col("_w"), F.col(source).isNull(), F.col(source).cast("binary"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(0, Window.unboundedFollowing)
    left = F.sum(F.col("source_size").cast("double")).over(everything) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    level = left / F.sum("_w").over(onward)
    leveled = weighed.withColumn("_level", level).withColumn("_full", F.col("_cap") <= F.col("_level") * F.col("_w"))
    # The level of the first source that stays below its cap holds for all that follow.
    common = F.min(F.when(~F.col("_full"), F.struct(F.col("_cap") / F.col("_w"), F.col("_level")))).over(everything)
    target = F.when(F.col("_full"), F.col("_cap")).otherwise(F.col("_w") * common.getField("_level"))
    return leveled.select(source, "source_size", F.coalesce(target, F.lit(0.0)).alias("target"))


def rows_of_bunch(size: Column) -> Column:
    """How many equal rows of ``size`` words make a full bunch."""
    fitting = F.floor(F.lit(BUNCH_WORDS) / F.greatest(size, F.lit(1)))
    return F.greatest(F.least(fitting, F.lit(BUNCH_ROWS)), F.lit(1)).cast("long")


def bunched(rows: DataFrame, identity: list[str], size: str) -> DataFrame:
    """Equal rows as bunches: the identity, size, ``_bunch`` (number), ``_copies`` (rows) and ``_span`` (words)."""
    counted = rows.groupBy(*identity, size).agg(F.count("*").alias("_rows"))
    counted = counted.withColumn("_most", rows_of_bunch(F.col(size)))
    parts = counted.withColumn("_bunch", F.explode(F.sequence(F.lit(0), F.floor((F.col("_rows") - 1) / F.col("_most")))))
    copies = F.least(F.col("_most"), F.col("_rows") - F.col("_bunch") * F.col("_most"))
    return parts.select(*identity, size, "_bunch", copies.alias("_copies"), (copies * F.col(size)).alias("_span"))


def placed(rows: DataFrame, source: str, key: list[str], size: str) -> DataFrame:
    """Add ``_at``, the position of a row's first word in the stream of its source.

    A source may hold a third of all rows: rows are dealt to cells by a hash of the key, sorted and
    summed inside a cell, and shifted by the cells before, of which there are few.
    """
    n = rows.count()
    cells = max(16, -(-n // CELL_ROWS))
    dealt = rows.withColumn("_cell", F.pmod(F.xxhash64(*key), F.lit(cells)).cast("int"))
    inside = Window.partitionBy(source, "_cell").orderBy(*key).rowsBetween(Window.unboundedPreceding, -1)
    local = dealt.withColumn("_in", F.coalesce(F.sum(size).over(inside), F.lit(0)))
    totals = dealt.groupBy(source, "_cell").agg(F.sum(size).alias("_sum"))
    earlier = Window.partitionBy(source).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    shifts = totals.select(
        F.col(source).alias("_s"), F.col("_cell").alias("_c"), F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_shift")
    )
    joined = local.join(shifts, F.col(source).eqNullSafe(F.col("_s")) & (F.col("_cell") == F.col("_c")))
    return joined.withColumn("_at", F.col("_in") + F.col("_shift")).drop("_in", "_shift", "_s", "_c", "_cell")


def draw_plan(targets: DataFrame, source: str, block: int, seed: int) -> DataFrame:
    """Per source: blocks, whole passes, draws of the last pass, and words to cut from its last draw.

    The tail block may be shorter; whether the last pass draws it is known from the inverse
    permutation, so one draw more makes up for it where needed.
    """
    size, target = F.col("source_size"), F.col("_words")
    plan = targets.withColumn("_words", F.round("target").cast("long"))
    plan = plan.withColumn("_blocks", F.ceil(size / F.lit(block)).cast("long"))
    plan = plan.withColumn("_passes", F.when(size > 0, F.floor(target / size)).otherwise(0).cast("long"))
    plan = plan.withColumn("_rest", F.when(size > 0, target - F.col("_passes") * size).otherwise(0).cast("long"))
    plan = plan.withColumn("_tail", size - (F.col("_blocks") - 1) * block)
    seed_of = F.xxhash64(F.lit(seed), F.col(source), F.col("_passes"))
    plan = plan.withColumn("_seed", seed_of)
    tail_at = F.when(F.col("_blocks") > 0, permuted(F.col("_blocks") - 1, F.col("_blocks"), F.col("_seed"), inverse=True))
    plan = plan.withColumn("_tail_at", tail_at)
    plain = F.ceil(F.col("_rest") / F.lit(block)).cast("long")
    short = F.lit(block) - F.col("_tail")
    lacking = (F.col("_tail_at") < plain) & (plain * block - short < F.col("_rest"))
    draws = F.when(F.col("_rest") == 0, F.lit(0)).when(lacking, plain + 1).otherwise(plain)
    plan = plan.withColumn("_draws", draws.cast("long"))
    drawn = F.col("_draws") * block - F.when(F.col("_tail_at") < F.col("_draws"), short).otherwise(0)
    return plan.withColumn("_cut", drawn - F.col("_rest"))


def mix_slots(plan: DataFrame, source: str, shards: int, block: int, seed: int) -> DataFrame:
    """The mix itself: one row per slot of an output shard with the source and block it takes.

    Returns shard, slot, source, block, words. Rows grow with the mix; nothing is gathered.
    """
    draws_in_all = plan.agg(F.sum(F.col("_passes") * F.col("_blocks") + F.col("_draws"))).first()[0] or 0
    per = plan.select(source, "_blocks", "_passes", "_draws", "_seed", "_cut", "_tail",
                      (F.col("_passes") * F.col("_blocks") + F.col("_draws")).alias("_n"))
    order = Window.orderBy(F.col(source).isNull(), F.col(source).cast("binary"))
    per = per.withColumn("_from", F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n"))
    per = per.withColumn("_all", F.sum("_n").over(Window.partitionBy()))
    # Two levels of generated rows, dealt to a given number of tasks: no task makes a source's draws.
    chunk = 16_384
    parts = per.where("_n > 0").withColumn("_part", F.explode(F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / chunk))))
    parts = parts.repartition(max(1, min(MAX_TASKS, draws_in_all // chunk + 1)), F.col(source), F.col("_part"))
    first = F.col("_part") * chunk
    draws = parts.withColumn("_q", F.explode(F.sequence(first, F.least(first + chunk, F.col("_n")) - 1)))
    turn = F.floor(F.col("_q") / F.col("_blocks"))
    inside = F.col("_q") % F.col("_blocks")
    seed_of = F.xxhash64(F.lit(seed), F.col(source), turn)
    draws = draws.withColumn("block", permuted(inside, F.col("_blocks"), seed_of))
    full = F.when(F.col("block") == F.col("_blocks") - 1, F.col("_tail")).otherwise(F.lit(block))
    last = (turn == F.col("_passes")) & (inside == F.col("_draws") - 1)
    draws = draws.withColumn("words", F.when(last, full - F.col("_cut")).otherwise(full))
    place = permuted(F.col("_from") + F.col("_q"), F.col("_all"), F.xxhash64(F.lit(seed), F.lit("slots")))
    draws = draws.withColumn("_place", place)
    per_shard = F.greatest(F.ceil(F.col("_all") / F.lit(shards)), F.lit(1))
    return draws.select(
        F.floor(F.col("_place") / per_shard).cast("int").alias("shard"),
        (F.col("_place") % per_shard).cast("long").alias("slot"),
        source, "block", "words",
    )


def shard_counts(slots: DataFrame, source: str = "source") -> DataFrame:
    """Draws per output shard and source."""
    return slots.groupBy("shard", source).agg(F.count("*").alias("n"), F.sum("words").alias("words"))


class Mix:
    """A mix over documents: its plan per source, its slots, and the share of every row."""

    BUNCH = ("_key", "_source", "size", "_sum", "_bunch", "_copies")

    def __init__(
        self, docs: DataFrame, source: str = "source", key: str = "doc_id", text: str = "text",
        block: int = BLOCK, shards: int = 16, seed: int = 7, cap: float = CAP,
    ) -> None:
        self.docs, self.source, self.key, self.text = docs, source, key, text
        rows = docs.select(
            F.col(key).alias("_key"), F.col(source).alias("_source"), word_count(F.col(text)).alias("size"),
            F.xxhash64(text).alias("_sum"),
        )
        rows = staged(rows, "sizes")
        sizes = rows.groupBy("_source").agg(F.sum("size").alias("source_size"))
        targets = source_targets(sizes, "_source", cap)
        # One row per source: written once, so that every later use sees the same numbers.
        self.plan = staged(draw_plan(targets, "_source", block, seed), "draws")
        self.slots = mix_slots(self.plan, "_source", shards, block, seed)
        bunches = bunched(rows, ["_key", "_source", "_sum"], "size")
        self.places = staged(placed(bunches, "_source", ["_key", "size", "_sum", "_bunch"], "_span"), "places")
        self.pieces = self._pieces(block)

    def _pieces(self, block: int) -> DataFrame:
        """Stretches of bunches inside blocks, with how often the block is drawn and its words of the last draw."""
        drawn = self.slots.groupBy("_source", "block").agg(F.count("*").alias("_times"), F.sum("words").alias("_drawn"))
        first, final = F.floor(F.col("_at") / block), F.floor((F.col("_at") + F.col("_span") - 1) / block)
        pieces = self.places.where("size > 0").select(
            *self.BUNCH, "_span", "_at", F.explode(F.sequence(first, final)).alias("_block")
        )
        lo = F.greatest(F.col("_at") - F.col("_block") * block, F.lit(0))
        hi = F.least(F.col("_at") + F.col("_span") - F.col("_block") * block, F.lit(block))
        pieces = pieces.withColumn("_lo", lo).withColumn("_hi", hi)
        b = drawn.select(F.col("_source").alias("_s"), F.col("block").alias("_b"), "_times", "_drawn")
        # Both sides grow with the mix, and their sizes are underestimated after explode: never broadcast.
        met = pieces.join(b.hint("merge"), F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_block") == F.col("_b")), "left")
        p = self.plan.select(F.col("_source").alias("_p"), "_blocks", "_tail", "_passes")
        met = met.join(p, F.col("_source").eqNullSafe(F.col("_p")), "left")
        whole = F.when(F.col("_block") == F.col("_blocks") - 1, F.col("_tail")).otherwise(F.lit(block))
        # Every block is drawn once per whole pass; a draw of the last pass may stop before the block's end.
        last = F.col("_times") - F.col("_passes")
        stop = F.least(F.col("_hi"), whole - (F.col("_times") * whole - F.col("_drawn")))
        part = F.when(last > 0, F.greatest(stop - F.col("_lo"), F.lit(0))).otherwise(0)
        return met.select(
            *self.BUNCH, F.coalesce("_passes", F.lit(0)).alias("_passes"),
            (F.col("_block") * block + F.col("_lo") - F.col("_at")).alias("_from"),
            F.coalesce(part, F.lit(0)).cast("long").alias("_n"),
            (F.col("_hi") - F.col("_lo")).alias("_all"),
        )

    def shares(self) -> DataFrame:
        """(key, source, size, source_size, target, taken), one row per input row.

        The rows of a bunch are equal and share the words taken from it evenly.
        """
        words = F.sum(F.col("_passes") * F.col("_all") + F.col("_n")).cast("long").alias("_taken")
        taken = self.pieces.groupBy(*self.BUNCH).agg(words)
        none = self.places.where("size = 0").select(*self.BUNCH, F.lit(0).cast("long").alias("_taken"))
        rows = taken.unionByName(none).withColumn("_i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1)))
        over = (F.col("_i") < F.col("_taken") % F.col("_copies")).cast("long")
        rows = rows.withColumn("taken", F.floor(F.col("_taken") / F.col("_copies")).cast("long") + over)
        info = self.plan.select(F.col("_source").alias("_p"), "source_size", "target")
        out = rows.join(info, F.col("_source").eqNullSafe(F.col("_p")))
        return out.select(F.col("_key").alias(self.key), F.col("_source").alias(self.source), "size", "source_size", "target", "taken")

    def documents(self) -> DataFrame:
        """The mix as rows with the columns of the input: a row for every whole pass over a document,
        and one more with the words that the last pass takes from it, joined by spaces.

        Rows of equal key, source and text are one document with copies; their other columns are those
        of the copy with the smallest hash. The last pass over a bunch of copies gives one row.
        """
        ranges = F.sort_array(F.collect_list(F.when(F.col("_n") > 0, F.struct("_from", "_n"))))
        drawn = self.pieces.groupBy(*self.BUNCH).agg(F.first("_passes").alias("_passes"), ranges.alias("_ranges"))
        drawn = drawn.where((F.col("_passes") > 0) | (F.size("_ranges") > 0)).withColumnsRenamed(
            {"_source": "_s", "_sum": "_h", "_bunch": "_b"}
        )
        # The input row travels as one value, so its column names cannot clash with those used here.
        row = F.col("_row")
        hashable = [F.col(f.name) for f in self.docs.schema.fields if "map<" not in f.dataType.simpleString()]
        rows = self.docs.select(
            F.struct(*[F.col(c) for c in self.docs.columns]).alias("_row"), F.col(self.key).alias("_k"),
            F.col(self.source).alias("_from_source"), F.xxhash64(self.text).alias("_w"), F.xxhash64(*hashable).alias("_pick"),
        )
        texts = rows.groupBy("_k", "_from_source", "_w").agg(F.min_by("_row", "_pick").alias("_row"), F.count("*").alias("_rows"))
        # A text meets each of its bunches in a row of its own, so copies of one text are many tasks' work.
        last = F.floor((F.col("_rows") - 1) / rows_of_bunch(word_count(row.getField(self.text))))
        last = F.when(F.col("_rows") == 1, F.lit(0)).otherwise(last).cast("long")
        texts = texts.withColumn("_bunch", F.explode(F.sequence(F.lit(0).cast("long"), last)))
        same = F.col("_k").eqNullSafe(F.col("_key")) & (F.col("_w") == F.col("_h")) & F.col("_from_source").eqNullSafe(F.col("_s"))
        met = texts.join(drawn, same & (F.col("_bunch") == F.col("_b")))

        def part(words: Column) -> Column:
            """Words of the ranges, which count on from one copy to the next."""
            def one(r: Column) -> Column:
                return F.slice(words, (r["_from"] + 1).cast("int"), r["_n"].cast("int"))

            def across(r: Column) -> Column:
                at = F.sequence(r["_from"], r["_from"] + r["_n"] - 1)
                return F.transform(at, lambda i: F.get(words, (i % F.col("size")).cast("int")))

            taken = F.when(F.col("_copies") == 1, F.transform("_ranges", one)).otherwise(F.transform("_ranges", across))
            return F.concat_ws(" ", F.flatten(taken))

        whole = F.col("_passes") * F.col("_copies")
        turns = whole + (F.size("_ranges") > 0).cast("long")
        out = met.withColumn("_whole", whole).withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), turns)))
        text = F.when(F.col("_i") <= F.col("_whole"), row.getField(self.text)).otherwise(let(word_array(row.getField(self.text)), part))
        return out.select(*[text.alias(c) if c == self.text else row.getField(c).alias(c) for c in self.docs.columns])


def mix_sources(docs: DataFrame, **options) -> Mix:
    """Mix sources to target weights; ``options`` are the column names, block, shards, seed and cap of :class:`Mix`.

    A null or blank text has size 0 and takes part with 0 words. A null source is a source of its
    own, last in order. Null keys and repeated rows keep their rows; equal rows are counted first, lie
    side by side in the stream in bunches of bounded size, and share what is taken evenly. An empty table gives empty frames. Columns other than source, key and text
    are only read by ``documents``, and their names cannot clash. The result depends on the rows and the seed only, not on partitioning. No row gives more than ``cap`` times
    its size.
    """
    return Mix(docs, **options)
