"""Document fingerprints by one-permutation MinHash, in column expressions only.

Words are hashed, five neighbours make a shingle, and a shingle's 64-bit hash is
computed once. Its upper bits choose one of 256 bins, which keeps its least hash.
An empty bin takes the value of a filled one, found along a fixed sequence of
bins of its own: every filled bin is equally likely, and two texts whose bins are
both empty look in the same order. The low four bits of each bin are stored, as
one hex digit. Two unrelated bins agree in one of 16 cases, which the likeness
corrects.

Cases: case does not count. Fewer than five words are one shingle. Null and blank
texts have the fingerprint of 256 zeros. Equal texts have equal fingerprints and
likeness 1. Rows with a null id come after all others, rows with one id in the
order of their texts' hashes; repeated rows are documents of their own. The next
document of a table's only row is that row. An empty table gives no rows. Other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stockglass.llm.common import GAP, let, materialize

SHINGLE = 5
BIN_BITS = 8
BINS = 1 << BIN_BITS
LOW_BITS = 4  # one hex digit a bin
ROUNDS = 4  # steps all empty bins take together; what is left is filled one by one
_BLANKS = " \t\n\x0b\x0c\r"

#: Bin i looks at bins start[i] + step[i] * t for t = 0, 1, ...; an odd step visits all bins.
STARTS = [((i * 0x9E3779B1 + 0x7F4A7C15) >> 7) % BINS for i in range(BINS)]
STEPS = [((i + 1) * 0x85EBCA6B >> 9) % BINS | 1 for i in range(BINS)]
_INVERSES = [pow(step, -1, BINS) for step in STEPS]


def _constants(values: list) -> Column:
    return F.array(*map(F.lit, values))


def _modulo(value: Column) -> Column:
    return value.bitwiseAND(F.lit(BINS - 1))


def _bin(value: Column) -> Column:
    """The upper bits, in the order of the signed value."""
    return F.shiftright(value, 64 - BIN_BITS).cast("int") + F.lit(BINS // 2)


def _shingle_hashes(text: Column) -> Column:
    """A hash for each shingle, ascending; null without words."""

    def shingles(words: Column) -> Column:
        def shingle(i: Column) -> Column:
            # Missing words of a short text are nulls, which the hash passes over.
            return F.xxhash64(*[F.get(words, i + k) for k in range(SHINGLE)])

        last = F.greatest(F.size(words) - SHINGLE, F.lit(0))
        return F.transform(F.sequence(F.lit(0), last), shingle)

    words = F.transform(F.split(F.btrim(F.lower(text), F.lit(_BLANKS)), GAP), lambda w: F.xxhash64(w))
    hashes = F.sort_array(let(words, shingles))
    return F.when(F.btrim(text, F.lit(_BLANKS)) != "", hashes)


def _filled(hashes: Column) -> Column:
    """The least hash of every bin that has one; a bin's hashes lie side by side."""

    def first_of_bin(value: Column, at: Column) -> Column:
        return (at == 0) | (_bin(value) != _bin(F.get(hashes, at - 1)))

    return F.filter(hashes, first_of_bin)


def _by_bin(filled: Column) -> Column:
    """An array with a place for each bin, null where the bin is empty."""

    def nulls(count: Column) -> Column:
        return F.array_repeat(F.lit(None).cast("long"), count)

    def with_gap(value: Column, at: Column) -> Column:
        before = F.coalesce(_bin(F.get(filled, at - 1)), F.lit(-1))
        return F.concat(nulls(_bin(value) - before - 1), F.array(value))

    end = BINS - 1 - _bin(F.element_at(filled, -1))
    return F.concat(F.flatten(F.transform(filled, with_gap)), nulls(end))


def _densified(filled: Column) -> Column:
    starts, steps, inverses = map(_constants, (STARTS, STEPS, _INVERSES))

    def fill(own: Column) -> Column:
        def look(state: Column, t: Column) -> Column:
            def step(value: Column, i: Column) -> Column:
                at = _modulo(F.get(starts, i) + F.get(steps, i) * t)
                return F.coalesce(value, F.get(own, at))

            return F.transform(state, step)

        def nearest(i: Column) -> Column:
            def reached(value: Column) -> Column:
                t = _modulo((_bin(value) - F.get(starts, i)) * F.get(inverses, i))
                return F.struct(t.alias("t"), value.alias("value"))

            return F.array_min(F.transform(filled, reached))["value"]

        together = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), own, look)
        return F.transform(together, lambda value, i: F.coalesce(value, nearest(i)))

    return let(_by_bin(filled), fill)


def low_bits(text: Column) -> Column:
    """The stored bits of each bin, an array of 256 small numbers."""

    def bits(filled: Column) -> Column:
        values = F.when(F.size(filled) == BINS, filled).otherwise(_densified(filled))
        mask = F.lit((1 << LOW_BITS) - 1)
        return F.transform(values, lambda v, i: F.xxhash64(v, i).bitwiseAND(mask).cast("tinyint"))

    with_words = let(_shingle_hashes(text), lambda hashes: let(_filled(hashes), bits))
    return F.coalesce(with_words, F.array_repeat(F.lit(0).cast("tinyint"), BINS))


def packed(low: Column) -> Column:
    """``low_bits`` as one string of hex digits."""
    digits = _constants(list("0123456789abcdef"))
    return F.array_join(F.transform(low, lambda v: F.get(digits, v.cast("int"))), "")


def likeness(low: Column, other: Column) -> Column:
    """The estimated share of common shingles, 0 to 1, from two ``low_bits``."""
    same = F.size(F.filter(F.zip_with(low, other, lambda a, b: a == b), lambda hit: hit)) / BINS
    chance = 1 / (1 << LOW_BITS)
    return F.greatest(F.lit(0.0), (same - chance) / (1 - chance))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint."""
    return docs.select("doc_id", packed(low_bits(F.coalesce("text", F.lit("")))).alias("fingerprint"))


def _id_ranges(docs: DataFrame) -> Column:
    """The number of the id's range, descending, from quantiles of all ids."""
    ranges = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / ranges for i in range(1, ranges)]
    bounds = docs.agg(F.percentile_approx("doc_id", shares, 20 * ranges)).first()[0]
    bounds = sorted(set(bounds or [0]))
    steps = [1 << i for i in reversed(range(len(bounds).bit_length()))]
    literal = _constants(bounds)

    def halve(at: Column, step: Column) -> Column:
        # ``at`` bounds are below the id; try ``step`` more.
        return F.when(F.get(literal, at + step - 1) < F.col("doc_id"), at + step).otherwise(at)

    below = F.aggregate(_constants(steps), F.lit(0), halve)
    return F.when(F.col("doc_id").isNull(), len(bounds) + 1).otherwise(len(bounds) - below)


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, low and of the next document, in descending doc_id, next_text, next_low.

    Documents are dealt by ranges of ids. A range ends with a copy of the first
    document of the range after it, so that each range is sorted alone and no
    text moves more than once.
    """
    text = F.coalesce("text", F.lit("")).alias("text")
    ranged = docs.select("doc_id", text, _id_ranges(docs).alias("range"))
    heads = ranged.groupBy("range").agg(F.max("doc_id").alias("head_id"))
    order = W.orderBy("range")  # as many rows as ranges
    last = F.max("range").over(W.partitionBy())
    heads = materialize(
        heads.withColumn("before", F.coalesce(F.lag("range").over(order), last)), "minhash-heads"
    ).withColumnRenamed("range", "head_range")
    at_head = (F.col("range") == F.col("head_range")) & F.col("doc_id").eqNullSafe(F.col("head_id"))
    first = F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")
    guests = ranged.join(heads, at_head).groupBy(F.col("before").alias("range")).agg(first)
    own = ranged.withColumn("guest", F.lit(False))
    no_id, guest = F.lit(None).cast("long").alias("doc_id"), F.lit(True).alias("guest")
    guests = guests.select(no_id, "text", "range", guest)
    rows = own.unionAll(guests).withColumn("low", low_bits(F.col("text")))
    inside = W.partitionBy("range").orderBy(
        "guest", F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), "text"
    )
    following = F.lead(F.struct("text", "low")).over(inside).alias("following")
    next_text, next_low = (F.col(f"following.{c}").alias(f"next_{c}") for c in ("text", "low"))
    own = rows.select("*", following).filter(~F.col("guest"))
    return own.select("doc_id", "text", "low", next_text, next_low)


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Per document its fingerprint, that of its text with the second half replaced
    by the beginning of the next document, and the likeness to that and to the next."""
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half)
    )
    rows = with_next(docs).select(
        "doc_id", n.cast("long").alias("n_chars"), "low", "next_low", edited.alias("edited")
    )
    rows = rows.withColumn("edited_low", low_bits(F.col("edited")))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        packed(F.col("low")).alias("fingerprint"),
        packed(F.col("edited_low")).alias("edited_fingerprint"),
        likeness(F.col("low"), F.col("edited_low")).alias("near_edited"),
        likeness(F.col("low"), F.col("next_low")).alias("near_next"),
    )
