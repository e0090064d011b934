"""Mixing sources to target weights by a low-discrepancy schedule.

Slot k of the schedule has the golden-ratio point ``k * 2654435769 mod 2**32``; the
source whose share of the cumulated targets covers that point gets the slot. The slots
of a source are ranked, and slot r of a source takes block r of its shuffled words:
its documents in hash order, end to end, and again from the start once all are used.
Blocks hold ``block_words`` words; the last one of a source is cut at its target, so
the words taken hit the target to the word.

Defined cases: a null text has size 0 and is never taken; null sources are one source,
last in order; repeated rows are documents of their own; an empty table gives an empty
result, and when all sizes are 0 all targets are 0. Other columns are ignored.

No source is gathered anywhere: running totals go over two levels of hash prefixes of
fixed count, then over the documents of one prefix.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airstrata.operators.ordering import global_index
from airstrata.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
GOLDEN, CIRCLE = 2654435769, 1 << 32
_CELL_BITS = 20
_CHUNK = 4096


@dataclass(frozen=True)
class MixConfig:
    weights: tuple[float, ...] = (5.0, 2.0, 1.0)
    share: float = 1.5
    most_passes: float = 2.0
    block_words: int = 256
    seed: str = "mix-"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, config: MixConfig) -> DataFrame:
    """source, source_size, target. The driver sees two sums per round, no sources."""
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    sizes = sizes.withColumn("_none", F.col("source").isNull())
    weights = F.array(*[F.lit(w) for w in config.weights])
    ranked = materialize(
        global_index(sizes, ["_none", "source"], "_rank")
        .withColumn("_w", F.element_at(weights, (F.col("_rank") % len(config.weights) + 1).cast("int")))
        .withColumn("_cap", F.col("source_size") * F.lit(config.most_passes))
        .drop("_none", "_rank"),
        "sources",
    )
    first = ranked.agg(F.sum("source_size"), F.sum("_w"), F.count("*")).first()
    total = (first[0] or 0) * config.share
    level, capped = (total / first[1] if first[2] else 0.0), 0
    while True:
        over = F.col("_w") * F.lit(level) > F.col("_cap")
        now = ranked.agg(
            F.coalesce(F.sum(F.when(over, F.col("_cap"))), F.lit(0.0)),
            F.sum(F.when(~over, F.col("_w"))),
            F.count(F.when(over, 1)),
        ).first()
        if now[2] == capped or not now[1]:
            break
        level, capped = (total - now[0]) / now[1], now[2]
    return ranked.select(
        "source", "source_size", F.least(F.col("_w") * F.lit(level), F.col("_cap")).alias("target")
    )


def _starts(sized: DataFrame) -> DataFrame:
    """Adds _start: the words of the same source before this document in hash order."""

    def before(by: list[str], order: str, size: str) -> Column:
        window = Window.partitionBy(*by).orderBy(order)
        return F.coalesce(F.sum(size).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    fine = sized.groupBy("source", "_b0", "_b1").agg(F.sum("size").alias("_size"))
    coarse = fine.groupBy("source", "_b0").agg(F.sum("_size").alias("_size"))
    coarse = coarse.withColumn("_off0", before(["source"], "_b0", "_size")).drop("_size")
    fine = fine.withColumn("_off1", before(["source", "_b0"], "_b1", "_size")).drop("_size")
    window = Window.partitionBy("source", "_b0", "_b1").orderBy("_hash", "doc_id", "size")
    running = F.sum("size").over(window.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    placed = sized.withColumn("_run", running)

    def join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
        right = right.select(*[F.col(k).alias(f"_r{k}") for k in keys], right.columns[-1])
        match = [left[k].eqNullSafe(right[f"_r{k}"]) for k in keys]
        return left.join(right, match).drop(*[f"_r{k}" for k in keys])

    placed = join(join(placed, fine, ["source", "_b0", "_b1"]), coarse, ["source", "_b0"])
    return placed.withColumn("_start", F.col("_off0") + F.col("_off1") + F.col("_run")).drop(
        "_off0", "_off1", "_run"
    )


def schedule(targets: DataFrame, config: MixConfig) -> DataFrame:
    """slot, source, rank: the slots in use, ranked per source from 0.

    A source leaves the schedule when its target is met; slots that fall to it later are
    passed over. So the walk goes on until the source that lags most has all its blocks.
    """
    spark = targets.sparkSession
    block = config.block_words
    need = F.ceil(F.round("target") / block).cast("long")
    # a share of whole points; sources are in code point order, so the circle is cut alike each time
    total = targets.agg(F.sum("target")).first()[0] or 0.0
    if not total:
        return targets.select(F.lit(0).cast("long").alias("slot"), "source", need.alias("rank")).limit(0)
    cut = targets.withColumn("_need", need).withColumn("_none", F.col("source").isNull())
    cut = global_index(cut.filter("_need > 0"), ["_none", "source"], "_rank")
    # cumulated targets: the sources' ranks in chunks, so that no task orders them all
    cut = cut.withColumn("_group", F.floor(F.col("_rank") / _CHUNK))
    within = Window.partitionBy("_group").orderBy("_rank")
    groups = cut.groupBy("_group").agg(F.sum("target").alias("_sum"))
    earlier = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select("_group", F.coalesce(F.sum("_sum").over(earlier), F.lit(0.0)).alias("_before"))
    cut = cut.join(groups, "_group").withColumn("_upto", F.col("_before") + F.sum("target").over(within))
    edge = lambda words: F.floor(words / F.lit(total) * F.lit(float(CIRCLE))).cast("long")
    cut = materialize(
        cut.select(
            "source",
            "_need",
            edge(F.col("_upto") - F.col("target")).alias("_lo"),
            edge(F.col("_upto")).alias("_hi"),
        ).withColumn("_hi", F.greatest(F.col("_hi"), F.col("_lo") + 1)),
        "shares",
    )
    cells = cut.select(
        "*",
        F.explode(
            F.sequence(F.shiftright("_lo", _CELL_BITS), F.shiftright(F.col("_hi") - 1, _CELL_BITS))
        ).alias("_cell"),
    )

    def deal(slots: int) -> DataFrame:
        low, high = F.col("id") % 65536, F.floor(F.col("id") / 65536) % 65536
        point = (low * GOLDEN + (high * GOLDEN) % 65536 * 65536) % CIRCLE
        points = spark.range(slots).select(F.col("id").alias("slot"), point.alias("_u"))
        points = points.withColumn("_cell", F.shiftright("_u", _CELL_BITS))
        dealt = points.join(cells, "_cell").filter("_u >= _lo AND _u < _hi")
        return dealt.select("slot", "source", "_need", F.floor(F.col("slot") / _CHUNK).alias("_chunk"))

    # the golden sequence is within a few points of fair on any arc; wait for the slowest source
    spare = 3
    while True:
        wait = (F.col("_need") + spare) * F.lit(float(CIRCLE)) / (F.col("_hi") - F.col("_lo"))
        dealt = deal(int(cut.agg(F.max(wait)).first()[0]) + 1)
        counts = materialize(
            dealt.groupBy("source", "_chunk").agg(F.count("*").alias("_n"), F.first("_need").alias("_need")),
            "slot-counts",
        )
        got = counts.groupBy("source").agg(F.sum("_n").alias("_n"), F.first("_need").alias("_need"))
        if got.filter("_n >= _need").count() == cut.count():
            break
        spare *= 2
    over = Window.partitionBy("source").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        F.col("source").alias("_s"), "_chunk", F.coalesce(F.sum("_n").over(over), F.lit(0)).alias("_off")
    )
    inside = Window.partitionBy("source", "_chunk").orderBy("slot")
    ranked = dealt.withColumn("_row", F.row_number().over(inside) - 1)
    match = [ranked["source"].eqNullSafe(counts["_s"]), ranked["_chunk"] == counts["_chunk"]]
    rank = F.col("_off") + F.col("_row")
    return (
        ranked.join(counts, match)
        .withColumn("rank", rank.cast("long"))
        .filter("rank < _need")
        .select("slot", "source", "rank")
    )


def prepare(documents: DataFrame, config: MixConfig) -> DataFrame:
    """doc_id, source, size, _key and the hash order; the only step that reads texts."""
    order = F.md5(F.concat(F.lit(config.seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    sized = documents.select(
        "doc_id",
        "source",
        F.md5(F.coalesce("text", F.lit(""))).alias("_key"),
        word_count(F.col("text")).alias("size"),
        order.alias("_hash"),
    )
    return materialize(
        sized.withColumn("_b0", F.substring("_hash", 1, 2)).withColumn("_b1", F.substring("_hash", 1, 4)),
        "sized",
    )


def mix(documents: DataFrame, config: MixConfig | None = None) -> tuple[DataFrame, DataFrame]:
    """The documents with their place and target, and the pieces in training order.

    Placed: doc_id, source, size, _key, _start, source_size, target, one row per input row.
    Pieces: slot, source, rank, doc_id, _key, _start, epoch, words (taken by this slot),
    word_from (the first of them within the document, from 0).
    """
    config = config or MixConfig()
    sized = prepare(documents, config)
    targets = source_targets(sized, config)
    targets = materialize(targets, "targets")
    slots = schedule(targets, config)
    goal = targets.select(F.col("source").alias("_s"), "source_size", "target")
    placed = _starts(sized)
    placed = placed.join(goal, placed["source"].eqNullSafe(goal["_s"])).drop("_s", "_hash", "_b0", "_b1")
    placed = materialize(placed, "placed")
    quota = F.round("target").cast("long")
    passes = F.ceil(quota / F.col("source_size")).cast("long")
    used = placed.filter("size > 0").withColumn("_quota", quota)
    used = used.filter("_quota > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), passes - 1)))
    begin = F.col("_start") + F.col("epoch") * F.col("source_size")
    used = used.withColumn("_a", begin).withColumn("_z", F.least(begin + F.col("size"), F.col("_quota")))
    used = used.filter("_a < _z")
    block = F.lit(config.block_words)
    pieces = used.withColumn(
        "rank",
        F.explode(F.sequence(F.floor(F.col("_a") / block), F.floor((F.col("_z") - 1) / block))),
    )
    lo = F.greatest(F.col("_a"), F.col("rank") * block)
    hi = F.least(F.col("_z"), (F.col("rank") + 1) * block)
    pieces = pieces.select(
        "source", "rank", "doc_id", "_key", "_start", "epoch",
        (hi - lo).alias("words"), (lo - F.col("_a")).alias("word_from"),
    )
    slots = slots.select("slot", F.col("source").alias("_s"), F.col("rank").alias("_r"))
    match = [pieces["source"].eqNullSafe(slots["_s"]), pieces["rank"] == slots["_r"]]
    return placed, pieces.join(slots, match).drop("_s", "_r")


def taken_words(documents: DataFrame, config: MixConfig | None = None) -> DataFrame:
    """doc_id, size, source_size, target, taken, one row per input row."""
    placed, pieces = mix(documents, config)
    took = pieces.groupBy("source", "_start").agg(F.sum("words").alias("taken"))
    took = took.select(F.col("source").alias("_s"), F.col("_start").alias("_at"), "taken")
    match = [
        placed["source"].eqNullSafe(took["_s"]),
        placed["_start"] == took["_at"],
        placed["size"] > 0,
    ]
    return placed.join(took, match, "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )


def mixed_documents(
    documents: DataFrame, config: MixConfig | None = None, whole: bool = False
) -> DataFrame:
    """The mixture as documents: one row for each time a document is taken.

    A document that its source's target cuts keeps its first words up to the cut, with
    n_chars (where that column exists) counted anew. With ``whole`` it is taken whole if at
    least half of its words are, else left out, so a source misses its target by half a
    document at most. Same columns as the input.
    """
    placed, pieces = mix(documents, config)
    took = pieces.groupBy("source", "_start", "epoch", "doc_id", "_key").agg(F.sum("words").alias("_words"))
    took = took.groupBy("source", "doc_id", "_key").agg(F.collect_list("_words").alias("_takes"))
    took = took.select(
        F.col("source").alias("_s"), F.col("doc_id").alias("_id"), F.col("_key").alias("_k"), "_takes"
    )
    keyed = documents.select(
        F.struct("*").alias("row"), "doc_id", "source", F.md5(F.coalesce("text", F.lit(""))).alias("_key")
    )
    once = keyed.dropDuplicates(["doc_id", "source", "_key"])
    match = [
        once["doc_id"].eqNullSafe(took["_id"]),
        once["source"].eqNullSafe(took["_s"]),
        once["_key"] == took["_k"],
    ]
    rows = once.join(took, match).select("row", F.explode("_takes").alias("_words"))
    text = F.col("row.text")
    if whole:
        return rows.filter(2 * F.col("_words") >= word_count(text)).select("row.*")
    words = F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    first = F.array_join(F.slice(words, F.lit(1), F.col("_words").cast("int")), "")
    cut = F.when(F.col("_words") < word_count(text), first).otherwise(text)
    row = F.col("row").withField("text", cut)
    if "n_chars" in documents.columns:
        kind = documents.schema["n_chars"].dataType
        row = row.withField("n_chars", F.length(cut).cast(kind))
    return rows.select(row.alias("row")).select("row.*")
