"""Mixing sources to target weights by hash-threshold histograms.

Every document has a 30-bit hash of its id.  A source's budget is met by the
documents whose hash lies below a threshold.  To find the threshold, sizes are
summed by source and the ten leading bits of the hash; the running sum shows
the one bucket in which the budget runs out; only that bucket's documents are
summed again by the next ten bits, and so on.  No document is sorted, and
each level moves at most 1,024 sums a source.

A source that must give more than it has repeats whole: its documents are all
taken ``floor(target / size)`` times, and the rest of the target is the
budget of the threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import lookup_groups, materialise, positional

#: Bits per level and levels of the histogram.
LEVEL_BITS = 10
LEVELS = 3
HASH_BITS = LEVEL_BITS * LEVELS
#: No source gives more than this many times its size.
MAX_REPEAT = 3

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str):
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Sources by code point, null last, weigh ``weights`` in turn and share the
    sum of all sizes.  A target stops at ``MAX_REPEAT`` times its source's
    size; what is over goes to the others by weight, until none is above.
    That fixed point gives every source ``least(cap, level * weight)``, and the
    level is what the capped sources leave over the weights of the rest.

    No task sees all sources: their places by name are counts of range
    partitions, and the level is raised by grouped sums.  What is over and the
    weight of the rest shrink by a factor of four or more together from sum to
    sum, so that a few dozen are the most for any number of sources.
    """
    ranged = materialise(sizes.repartitionByRange(F.col("source").asc_nulls_last())
                         .withColumn("__part", F.spark_partition_id()), "mix-ranges")
    # one row per range partition
    parts = ranged.groupBy("__part").agg(F.count("*").alias("__n"))
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("__part", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    by_name = Window.partitionBy("__part").orderBy(F.col("source").asc_nulls_last())
    s = ranged.join(F.broadcast(parts), "__part")
    k = (F.col("__before") + F.row_number().over(by_name) - 1) % len(weights)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (k + 1).cast("int"))
    s = s.select("source", "source_size", w.alias("__w"), (F.col("source_size") * float(MAX_REPEAT)).alias("__cap"))
    s = materialise(s, "mix-weights")
    total = float(s.agg(F.sum("source_size")).first()[0] or 0)
    level, capped = 0.0, -1
    while True:
        over = F.col("__cap") < F.col("__w") * level
        n, caps, free = s.agg(F.count(F.when(over, 1)), F.sum(F.when(over, F.col("__cap"))),
                              F.sum(F.when(~over, F.col("__w")))).first()
        if n <= capped or not free:
            break
        level, capped = (total - (caps or 0.0)) / free, n
    return s.select("source", "source_size", F.least(F.col("__cap"), F.lit(level) * F.col("__w")).alias("target"))


def _thresholds(sized: DataFrame, budgets: DataFrame, sources: int) -> DataFrame:
    """(__key, __below): a source's documents with a hash under __below meet its budget.

    A level works only on documents under the prefix found so far, so hot
    sources are summed in each task and spread over their buckets.
    """
    found = budgets.select("__key", "__budget", F.lit(0).cast("long").alias("__prefix"))
    for level in range(LEVELS):
        shift = HASH_BITS - LEVEL_BITS * (level + 1)
        rows = sized.select("__key", "size", F.shiftright("__hash", shift).alias("__bucket"),
                            F.shiftright("__hash", shift + LEVEL_BITS).alias("__prefix"))
        if level:
            rows = rows.join(found.select("__key", "__prefix"), ["__key", "__prefix"], "left_semi")
        sums = rows.groupBy("__key", "__bucket").agg(F.sum("size").alias("__sum"))
        run = Window.partitionBy("__key").orderBy("__bucket")
        sums = sums.withColumn("__upto", F.sum("__sum").over(run))
        sums = sums.join(found.select("__key", "__budget"), "__key")
        over = F.col("__upto") > F.col("__budget")
        step = sums.groupBy("__key").agg(
            # the bucket in which the budget runs out, and how much of it is left there
            F.min(F.when(over, F.struct("__bucket", "__sum"))).alias("__stop"),
            F.max(F.when(~over, F.col("__upto"))).alias("__used"),
            F.max("__bucket").alias("__last"))
        found = found.join(step, "__key", "left").select(
            "__key", (F.col("__budget") - F.coalesce("__used", F.lit(0))).alias("__budget"),
            # a prefix past every bucket if all of them are taken
            F.coalesce(F.col("__stop")["__bucket"], F.col("__last") + 1,
                       F.shiftleft("__prefix", LEVEL_BITS)).alias("__prefix"),
            F.col("__stop")["__sum"].alias("__stop_sum"))
        # the sums are sorted in these tasks, so they count, not the sources
        found = materialise(found, f"mix-level{level}", sources << LEVEL_BITS)
    # of the documents on the last bucket's one hash, the nearer choice
    take = F.coalesce(F.col("__budget") * 2 >= F.col("__stop_sum"), F.lit(False))
    return found.select("__key", (F.col("__prefix") + take.cast("long")).alias("__below"))


def _planned(docs: DataFrame, weights: tuple[int, ...], id_col: str, text_col: str, source_col: str):
    """(sized rows, plan of each source, row count)."""
    sized = materialise(docs.select(
        F.col(id_col).alias("__id"), word_count(text_col).alias("size"), F.col(source_col).alias("source"),
        _key(source_col).alias("__key"), _hash(id_col).alias("__hash")), "mix-sizes")
    by_source = materialise(sized.groupBy("source", "__key").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("__rows")), "mix-sources")
    sources = by_source.count()
    targets = source_targets(by_source.select("source", "source_size"), weights)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    targets = targets.select(_key("source").alias("__key"), "source_size", "target",
                             F.least(whole, F.lit(MAX_REPEAT)).cast("long").alias("__whole"))
    targets = materialise(targets.withColumn(
        "__budget", F.col("target") - F.col("__whole") * F.col("source_size")), "mix-targets", sources)
    plan = (targets.join(_thresholds(sized, targets, sources), "__key")
            .join(by_source.select("__key", "__rows"), "__key")
            .select("__key", "source_size", "target", "__whole", "__below", "__rows"))
    n = by_source.agg(F.sum("__rows")).first()[0] or 0
    return sized, materialise(plan, "mix-plan", sources), n


def _key(source: str):
    """A source's name as a key that is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("null"))


def _hash(id_col: str):
    return F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit(""))).bitwiseAND(F.lit((1 << HASH_BITS) - 1))


def _copies():
    # empty documents can lie below the threshold of a source that is taken whole already
    return F.least(F.col("__whole") + (F.col("__hash") < F.col("__below")).cast("long"), F.lit(MAX_REPEAT).cast("long"))


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), id_col: str = "doc_id",
                text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per row of ``docs``: (id, size, source_size, target, taken, copies).

    ``copies`` (0 to 3) is how often the mix takes the document, ``taken`` its
    words times that.  Words are counted over whole texts; a null text has size 0; a null source is a source of
    its own, last in order; rows of one id (null ids too) share their hash and
    are taken alike.  An empty table gives an empty result; other columns are
    ignored.  The hash depends on the id alone, so reruns agree.
    """
    sized, plan, n = _planned(docs, weights, id_col, text_col, source_col)
    out = lookup_groups(sized, plan, "__key", "__rows", n, F.col("__id"))
    return out.select(F.col("__id").alias(id_col), "size", "source_size", "target",
                      (_copies() * F.col("size")).alias("taken"), _copies().alias("copies"))


def take_mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), id_col: str = "doc_id",
             text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``docs`` as the mix takes them: a document taken n times gives n equal
    rows, one never taken gives none.  All columns stay; nulls and empty
    tables as in ``mix_sources``."""
    rows, (key, text, source) = positional(docs, id_col, text_col, source_col)
    _, plan, n = _planned(rows, weights, key, text, source)
    keyed = rows.withColumns({"__key": _key(source), "__hash": _hash(key)})
    out = lookup_groups(keyed, plan, "__key", "__rows", n, F.col("__hash")).filter(_copies() > 0)
    out = out.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), _copies())))
    return out.select(*rows.columns).toDF(*docs.columns)
