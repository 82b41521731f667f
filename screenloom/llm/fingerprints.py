"""Operator 7: Order MinHash fingerprints of whole texts, in DataFrame functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .columns import first_not_below, let, words

PLACE = (1 << 24) - 1  # the low bits of a hash give way to the k-mer's place in the text, from 1
BINS, BIN_BITS, TUPLE, HASH_BITS = 64, 6, 3, 39
PART_ROWS, MOST_PARTS = 500, 10_000


def order_minhash(text: Column) -> Column:
    """array<int>, one entry for each of 64 draws: entry * 65536 + a hash of three k-mers in text order; none for a text without words.

    K-mers are two neighbouring words, numbered by occurrence: a repeat is hashed with its number. A k-mer's hash deals it to
    one of 64 bins. An entry draws the three k-mers that come first from its bin on: at most three of each bin, smallest hash
    first, and from the last bin on to the first. So a draw of a long text is from its own bin, and one of a short text goes on into the
    next bins until it has three: every entry has an order. It hashes its k-mers in the order of
    the text, so reordered words change entries though their k-mers stay, and entries follow edit distance. A single word is a k-mer; a text of
    fewer than three k-mers draws those it has again. Places count modulo 2**24 words.
    """

    def hashed(w: Column) -> Column:
        n = F.size(w)
        at = F.when(n > 0, F.sequence(F.lit(0), F.greatest(n - 2, F.lit(0)))).otherwise(F.expr("cast(array() as array<int>)"))
        return F.sort_array(F.transform(at, lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1)).bitwiseAND(F.lit(~PLACE)).bitwiseOR((i + 1).bitwiseAND(F.lit(PLACE)).cast("long"))))

    def numbered(s: Column) -> Column:
        def one(x: Column, j: Column) -> Column:
            top = x.bitwiseAND(F.lit(~PLACE))
            again = (j > 0) & (F.get(s, j - 1).bitwiseAND(F.lit(~PLACE)) == top)
            other = F.xxhash64(top, j - first_not_below(s, top)).bitwiseAND(F.lit(~PLACE)).bitwiseOR(x.bitwiseAND(F.lit(PLACE)))
            return F.when(again, other).otherwise(x)

        return F.sort_array(F.transform(s, one))

    def bin_of(x: Column) -> Column:
        return F.shiftright(x, 64 - BIN_BITS)  # from -32

    def least(s: Column) -> Column:
        return F.filter(s, lambda x, j: (j < TUPLE) | (bin_of(x) != bin_of(F.get(s, j - TUPLE))))

    def entries(s: Column) -> Column:
        n = F.size(s)
        # the place goes to the front for the order, 39 bits of the hash stay behind it
        turned = F.transform(s, lambda x: F.shiftleft(x.bitwiseAND(F.lit(PLACE)), HASH_BITS).bitwiseOR(F.shiftrightunsigned(x, 64 - HASH_BITS)))
        ring = let(turned, lambda r: F.when(n >= TUPLE, F.concat(r, F.slice(r, F.lit(1), F.lit(TUPLE)))).otherwise(F.flatten(F.array_repeat(r, 2 * TUPLE))))
        # where the k-mers of each bin begin: the bins' least values, sorted in among them, less the bins before
        starts = F.array(*[F.lit(b << (64 - BIN_BITS)).cast("long") for b in range(-BINS // 2, BINS // 2)])
        among = F.transform(F.sort_array(F.concat(s, starts)), lambda x, i: F.when(x.bitwiseAND(F.lit((1 << (64 - BIN_BITS)) - 1)) == 0, i))

        def entry(r: Column):
            def one(at: Column, b: Column) -> Column:
                drawn = F.sort_array(F.slice(r, at - b + 1, F.lit(TUPLE)))
                hashes = F.transform(drawn, lambda y: y.bitwiseAND(F.lit((1 << HASH_BITS) - 1)))
                return (b * 65536 + F.xxhash64(hashes).bitwiseAND(F.lit(65535)).cast("int")).cast("int")

            return F.transform(F.array_compact(among), one)

        return F.when(n > 0, let(ring, entry)).otherwise(F.expr("cast(array() as array<int>)"))

    return let(words(text), lambda w: let(hashed(w), lambda h: let(numbered(h), lambda s: let(least(s), entries))))


def as_text(entries: Column) -> Column:
    return F.array_join(F.transform(entries, lambda v: F.lpad(F.lower(F.hex(v)), 6, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal entries; 1 for two texts without words, 0 if one has none."""
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / BINS)


def with_next(docs: DataFrame, carried: list[str]) -> DataFrame:
    """docs (doc_id, text, ...) with next_<c> of each carried column: its value in the next row by doc_id, after the last the first.

    Rows are dealt to ranges of doc_id (about 500 rows each, at most 10,000 ranges, whose bounds
    the driver holds); the first rows of a range are copied to the range before, so that each range
    is ordered alone and text is shuffled once. An id that takes several ranges has its rows dealt to them by a hash of the text:
    rows of one id follow each other in the order of that hash. A range's rows are sorted and taken in turn by Spark, which spills them.
    Null ids come first.
    """
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))
    tie = F.xxhash64("text", F.lit(7))
    ids = docs.select(key.alias("key"), tie.alias("tie"))
    parts = min(MOST_PARTS, max(1, ids.count() // PART_ROWS))
    cuts = ids.agg(F.percentile_approx("key", [i / parts for i in range(1, parts)] or [0.5], 20 * parts).alias("c")).first().c or []
    bounds = F.array(*[F.lit(c).cast("long") for c in sorted(cuts)])

    def dealt_to(b: Column) -> Column:
        low = first_not_below(b, F.col("key"))
        # how many bounds are the key itself: as many ranges are its own
        after = F.when(F.col("key") == 2**63 - 1, F.size(b)).otherwise(first_not_below(b, F.when(F.col("key") < 2**63 - 1, F.col("key") + 1)))
        own = F.when(F.get(b, low) == F.col("key"), after - low).otherwise(1)
        return low + F.floor((F.col("tie") / 2.0**64 + 0.5) * own).cast("int")

    part = F.least(let(bounds, dealt_to), F.lit(len(cuts)))
    row = F.struct("key", "tie")
    firsts = sorted((r.part, r.first.key, r.first.tie) for r in ids.withColumn("part", part).groupBy("part").agg(F.min(row).alias("first")).collect())
    spark = docs.sparkSession
    copies = [(k, t, firsts[i - 1][0], int(i == 0)) for i, (_, k, t) in enumerate(firsts)]
    copied = spark.createDataFrame(copies, "first_key long, first_tie long, to int, wrap int")  # a row for each range
    # of rows that are alike in both, each is copied: they have one text, so that any of them may come first
    dealt = docs.withColumn("key", key).withColumn("tie", tie).withColumn("part", part)
    dealt = dealt.join(F.broadcast(copied), (F.col("key") == F.col("first_key")) & (F.col("tie") == F.col("first_tie")), "left")
    homes = F.array(F.struct(F.col("part").alias("part"), F.lit(0).alias("wrap"), F.lit(True).alias("own")), F.struct(F.col("to").alias("part"), F.col("wrap"), F.lit(False).alias("own")))
    rows = dealt.select(*docs.columns, "key", "tie", F.explode(F.filter(homes, lambda h: h["part"].isNotNull())).alias("home"))
    rows = rows.select(*docs.columns, "key", "tie", "home.*")
    order = W.partitionBy("part").orderBy("wrap", "key", "tie")
    following = rows.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in carried])
    return following.where("own").drop("key", "tie", "part", "wrap", "own")


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of each row.

    The edited text is the text whose last half is replaced by the start of the next document's.
    Null and empty texts are alike: no characters, an empty fingerprint. Equal texts have equal
    fingerprints whatever their ids. A table of one row is its own next document. Other columns aren't read.
    """
    body = F.coalesce(F.col("text"), F.lit(""))
    own = docs.select("doc_id", body.alias("text")).withColumn("entries", order_minhash(F.col("text")))
    both = with_next(own, ["text", "entries"])
    n, half = F.length("text"), F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    both = both.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "entries", "next_entries")
    both = both.select("*", order_minhash(F.col("edited")).alias("edited_entries"))
    return both.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), as_text(F.col("entries")).alias("fingerprint"), as_text(F.col("edited_entries")).alias("edited_fingerprint"),
        likeness(F.col("entries"), F.col("edited_entries")).alias("near_edited"), likeness(F.col("entries"), F.col("next_entries")).alias("near_next"),
    )
