"""Document fingerprints: MinHash of one permutation, with optimal densification and packed low-order bits.

Every shingle of five words is hashed once; the top bits of the hash name one of ``BINS`` bins, which keeps its smallest
hash. An empty bin copies the bin that a fixed random sequence of its own meets first among those that are not empty.
Of every bin the low-order ``BITS`` are stored. Two fingerprints agree in a bin as often as their sets of shingles are
similar, and by chance in one of 2**BITS cases; ``likeness`` takes the latter off.

A word is a run of anything but ASCII white space; a text of fewer than five words has one shingle, that of all of them.
The fingerprint of a null or empty text, or of one of white space, is empty: it is wholly like another empty one and
not at all like others. Everything is built from Spark's own expressions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillroll.llm.expressions import let

BINS = 256
BITS = 8
WIDTH = 5
PROBES = 8
ROWS = 20_000  # documents of one stretch of neighbours


def words(text: Column) -> Column:
    blanks = reduce(lambda t, blank: F.replace(t, F.lit(blank), F.lit(" ")), "\t\n\x0b\x0c\r", text)
    return F.array_remove(F.split(blanks, " "), "")


def _shingles(w: Column) -> Column:
    """The sorted hashes of the shingles of the words ``w``."""
    hashes = F.transform(F.sequence(F.lit(0), F.size(w) - WIDTH), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WIDTH)]))
    short = F.array(F.xxhash64(F.array_join(w, " ")))
    none = F.array().cast("array<bigint>")
    return F.sort_array(F.when(F.size(w) >= WIDTH, hashes).when(F.size(w) > 0, short).otherwise(none))


def _bin(h: Column) -> Column:
    return F.shiftright(h, 64 - (BINS - 1).bit_length()) + BINS // 2


def _lanes(least: Column, dense: Column) -> Column:
    """The low-order bits by bin: ``dense`` has the smallest hash of every bin or null, ``least`` those that there are."""
    def value(b: Column) -> Column:
        order = F.transform(least, lambda h: F.struct(F.xxhash64(b, _bin(h)).alias("rank"), h.alias("h")))
        tries = [F.get(dense, F.get(F.array(*[F.lit(p) for p in at]), b)) for at in _PLACES]
        return F.coalesce(F.get(dense, b), *tries, F.array_min(order)["h"])

    low = F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda b: value(b).bitwiseAND(F.lit((1 << BITS) - 1)).cast("smallint"))
    return F.when(F.size(least) > 0, low).otherwise(F.array().cast("array<smallint>"))


def _mixed(x: int) -> int:
    mask = (1 << 64) - 1
    x = (x + 0x9E3779B97F4A7C15) & mask
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & mask
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB & mask
    return x ^ (x >> 31)


#: By try, the bin that each empty bin looks at.
_PLACES = [[_mixed(t * BINS + b) % BINS for b in range(BINS)] for t in range(1, PROBES + 1)]


def _least(h: Column) -> Column:
    """The first hash of every bin of the sorted hashes ``h``."""
    return F.filter(h, lambda x, i: (i == 0) | (_bin(x) != _bin(F.get(h, i - 1))))


def _dense(least: Column) -> Column:
    """By bin, its smallest hash or null."""
    by_bin = F.map_from_arrays(F.transform(least, lambda h: _bin(h).cast("int")), least)
    all_bins = F.sequence(F.lit(0), F.lit(BINS - 1))
    return let(by_bin, lambda m: F.transform(all_bins, lambda b: F.try_element_at(m, b)))


def with_lanes(rows: DataFrame, text_col: str, lanes_col: str) -> DataFrame:
    """``rows`` with the fingerprint of a text as an array."""
    text = F.coalesce(text_col, F.lit(""))
    least = let(words(text), lambda w: let(_shingles(w), _least))
    return rows.withColumn(lanes_col, let(least, lambda l: let(_dense(l), lambda d: _lanes(l, d))))


def packed(lanes: Column) -> Column:
    """The bits as lowercase hexadecimal digits."""
    return F.lower(F.array_join(F.transform(lanes, lambda x: F.lpad(F.hex(x), BITS // 4, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """The estimated similarity of two fingerprints, without the share of bins that agree by chance."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda e: e)) / F.lit(BINS)
    chance = 2.0**-BITS
    both = (F.size(a) > 0) & (F.size(b) > 0)
    return F.when(both, F.greatest(F.lit(0.0), (same - chance) / (1 - chance))).otherwise(
        F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(0.0)
    )


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id and its ``fingerprint``."""
    rows = with_lanes(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "text", "lanes")
    return rows.select(F.col("id").alias(id_col), packed(F.col("lanes")).alias("fingerprint"))


def with_next(docs: DataFrame, id_col: str, columns: list[str], tie: Column, rows_each: int = ROWS) -> DataFrame:
    """``docs`` with ``next_`` columns: those of the row with the next smaller id, after the last those of the first.

    Rows of one id follow each other by ``tie``; null ids come last. The ids are cut into stretches of about ``rows_each``
    rows, at least 1024, by their quantiles; the first row of a stretch is also dealt to the one before, so that one shuffle
    and a window per stretch suffice. On the driver there are the bounds of the stretches.
    """
    spark = docs.sparkSession
    ids = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("i"), tie.alias("t"))
    rows = ids.count()
    parts = max(1024, rows // rows_each)
    shares = F.array(*[F.lit(k / parts) for k in range(1, parts)])
    bounds = sorted(set(ids.agg(F.percentile_approx("i", shares, 10 * parts).alias("b")).first().b or []))
    steps = F.array(*[F.lit(1 << k) for k in range(len(bounds).bit_length() - 1, -1, -1)])
    limits = F.array(*[F.lit(b) for b in bounds]) if bounds else F.array().cast("array<bigint>")

    def stretch(i: Column) -> Column:
        # how many bounds are at least i, by halving: the larger the ids, the earlier the stretch
        less = lambda at, step: F.when(F.get(limits, at + step - 1) < i, at + step).otherwise(at)
        return F.aggregate(steps, F.lit(0), less)

    held = ids.withColumn("s", stretch(F.col("i"))).groupBy("s").agg(F.max(F.struct("i", "t")).alias("first"))
    firsts = held.orderBy(F.desc("s")).collect()  # one row per stretch
    before = [(r.s, r.first.i, r.first.t, firsts[n - 1].s) for n, r in enumerate(firsts)]
    before = spark.createDataFrame(before, "s int, fi long, ft long, p int")
    marked = docs.withColumn("i", F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))).withColumn("t", tie)
    marked = marked.withColumn("s", stretch(F.col("i"))).join(F.broadcast(before), "s")
    opens = (F.col("i") == F.col("fi")) & (F.col("t") == F.col("ft"))
    own, guest = F.struct(F.lit(0).alias("guest"), F.col("s")), F.struct(F.lit(1).alias("guest"), F.col("p").alias("s"))
    dealt = marked.withColumn("at", F.explode(F.when(opens, F.array(own, guest)).otherwise(F.array(own))))
    order = Window.partitionBy("at.s").orderBy("at.guest", F.desc("i"), F.desc("t"))
    seen = dealt.select(*docs.columns, "at", *[F.lead(c).over(order).alias(f"next_{c}") for c in columns])
    return seen.where("at.guest = 0").drop("at")


def edited(text: Column, following: Column) -> Column:
    """``text`` with its last third replaced by as much of the beginning of ``following``."""
    third = F.floor(F.length(text) / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - third), F.substring(following, F.lit(1), third))


def neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``n_chars``, ``edited`` (its text with the last third from the next document), the
    fingerprints ``lanes``, ``edited_lanes`` and ``next_lanes``."""
    base = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    base = with_lanes(base, "text", "lanes")
    rows = with_next(base, "id", ["text", "lanes"], F.xxhash64("text"))
    rows = rows.select("id", F.length("text").cast("long").alias("n_chars"), "lanes", "next_lanes", edited(F.col("text"), F.col("next_text")).alias("edited"))
    return with_lanes(rows, "edited", "edited_lanes").withColumnRenamed("id", id_col)
