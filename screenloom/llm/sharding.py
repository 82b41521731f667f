"""Operator 9: shards cut from the Hilbert-curve order of several metadata dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import let
from .common import drop_table, free_name, numbered, table

BITS = 4


def gray(i: int) -> int:
    return i ^ (i >> 1)


def curve_tables(n: int) -> tuple[list[int], list[int]]:
    """Entry corner and direction of each of the 2**n sub-cubes along the curve."""
    entry, direction = [], []
    for w in range(2**n):
        entry.append(0 if w == 0 else gray(2 * ((w - 1) // 2)))
        odd = w if w % 2 else w - 1
        direction.append(0 if w == 0 else (odd ^ (odd + 1)).bit_length() - 1)
    return entry, [d % n for d in direction]


def hilbert_index(cells: list[Column], bits: int = BITS) -> Column:
    """Position on the Hilbert curve of the cell with these coordinates, each from 0 to 2**bits - 1.

    From the highest bit down, the sub-cube that the coordinates name is turned into the frame of
    the curve so far (entry corner e, direction d); its Gray code rank is the next digit.
    """
    n = len(cells)
    entry, direction = curve_tables(n)
    mask = 2**n - 1
    packed = F.lit(0)
    for cell in cells:
        packed = F.shiftleft(packed, bits).bitwiseOR(cell.cast("int"))

    def walk(all_cells: Column) -> Column:
        apart = [F.shiftright(all_cells, bits * (n - 1 - j)).bitwiseAND(2**bits - 1) for j in range(n)]
        return F.aggregate(F.sequence(F.lit(bits - 1), F.lit(0), F.lit(-1)), start, lambda s, k: step(s, k, apart), lambda s: s["h"])

    def shift(x: Column, by: Column, left: bool) -> Column:
        a, b = ("shiftleft", "shiftright") if left else ("shiftright", "shiftleft")
        return F.call_function(a, x, by).bitwiseOR(F.call_function(b, x, F.lit(n) - by)).bitwiseAND(mask)

    def step(s: Column, k: Column, cells: list[Column]) -> Column:
        corner = F.lit(0)
        for j, cell in enumerate(cells):
            corner = corner.bitwiseOR(F.shiftleft(F.call_function("shiftright", cell, k).bitwiseAND(1), j))
        turn = F.pmod(s["d"] + 1, F.lit(n))

        def moved(one: Column) -> Column:
            return F.struct(
                F.shiftleft(s["h"], n).bitwiseOR(one).alias("h"),
                s["e"].bitwiseXOR(shift(F.element_at(F.array(*map(F.lit, entry)), one + 1), turn, left=True)).alias("e"),
                F.pmod(s["d"] + F.element_at(F.array(*map(F.lit, direction)), one + 1) + 1, F.lit(n)).alias("d"),
            )

        def ranked(code: Column) -> Column:
            rank = code
            for by in range(1, n):
                rank = rank.bitwiseXOR(F.shiftright(code, by))
            return let(rank, moved)

        return let(shift(corner.bitwiseXOR(s["e"]), turn, left=False), ranked)

    start = F.struct(F.lit(0).alias("h"), F.lit(0).alias("e"), F.lit(0).alias("d"))
    return let(packed, walk)


def quantised(df: DataFrame, columns: list[str], bits: int = BITS) -> list[Column]:
    """Cells 0 .. 2**bits - 1 by quantiles of these columns' values (null: 0)."""
    shares = [i / 2**bits for i in range(1, 2**bits)]
    cuts = df.agg(*[F.percentile_approx(c, shares, 10_000).alias(c) for c in columns]).first()
    return [sum(((F.coalesce(F.col(c) > F.lit(cut), F.lit(False))).cast("int") for cut in (cuts[c] or [])), F.lit(0)) for c in columns]


def text_order(df: DataFrame, columns: list[str]) -> list[Column]:
    """Numbers in the order of string columns: the seven bytes that follow what all values of a column begin with (null: null).

    Values alike in those share a number, so a range of numbers is a range of values.
    """
    ends = df.agg(*[f(F.col(c).cast("binary")).alias(f"{c}_{n}") for c in columns for n, f in (("lo", F.min), ("hi", F.max))]).first()
    made = []
    for c in columns:
        low, high = ends[f"{c}_lo"] or b"", ends[f"{c}_hi"] or b""
        shared = next((i for i, (a, b) in enumerate(zip(low, high)) if a != b), min(len(low), len(high)))
        part = F.rpad(F.hex(F.substring(F.col(c).cast("binary"), F.lit(shared + 1), F.lit(7))), 14, "0")
        made.append(F.conv(part, 16, 10).cast("long"))
    return made


def facts(docs: DataFrame, *more: Column) -> DataFrame:
    """(doc_id, size, text_crc32, lang, source, tie) of every row, which the curve needs, and more columns."""
    body = F.coalesce(F.col("text"), F.lit(""))
    found = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(body) + F.lit(1)).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
        *more,
    )
    return found.select("*", F.xxhash64("doc_id", "text_crc32", "size").alias("tie"))


def on_curve(rows: DataFrame) -> DataFrame:
    """rows (with the columns of facts) with curve, their place on it by quantiles of doc_id, size, lang and source."""
    lang, source = text_order(rows, ["lang", "source"])
    named = rows.withColumn("lang_order", lang).withColumn("source_order", source)
    cells = quantised(named.select("doc_id", "size", "lang_order", "source_order"), ["doc_id", "size", "lang_order", "source_order"])
    return named.withColumn("curve", hilbert_index(cells)).drop("lang_order", "source_order")


def hilbert_order(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, curve, position): every document's place from 0 in curve order.

    The dimensions are doc_id, the text's size, lang and source, each by quantiles of its order.
    Ties on the curve are ordered by a hash of doc_id and text. Rows are dealt to ranges of that order,
    and a place is the number of rows in earlier ranges and the place in the own one (numbered), so that neither a
    cell with many rows nor a row that is there very often is one task's. Only these figures are shuffled, no text. Nulls: doc_id and text may be null (size 1, crc of no bytes); rows that repeat each
    other take places in no set order.
    """
    placed = table(on_curve(table(facts(docs), "facts")).select("doc_id", "size", "text_crc32", "curve", "tie"), "curve")
    return numbered(placed, [F.col("curve"), F.col("tie")]).select("doc_id", "size", "text_crc32", "curve", "position")


def shard_and_slot(n: int, shards: int) -> tuple[Column, Column]:
    """Shard of each position among n, and place from 0 in it: runs whose sizes are at most one apart."""
    n = max(1, n)
    return F.expr(f"cast(position * {shards}L div {n}L as int)"), F.expr(f"position - (((position * {shards}L div {n}L) * {n}L + {shards - 1}L) div {shards}L)")


def shard(docs: DataFrame, shards: int = 8) -> DataFrame:
    """(doc_id, size, text_crc32, curve, law, shard, slot, grown_shard): runs of the curve order with row counts at most one apart."""
    number, slot = shard_and_slot(docs.count(), shards)
    return hilbert_order(docs).select("doc_id", "size", "text_crc32", "curve", F.lit("rows").alias("law"), number.alias("shard"), slot.alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, shards: int = 8, rows_per_file: int = 1_000_000) -> None:
    """Write docs, all columns and rows, as one folder `shard_number=` for each shard; rows lie in the order of the curve.

    The law is that of shard(): row counts of shards are at most one apart. A run of the curve is a range of few values in each dimension, so
    the min and max statistics of files and row groups prune on each of doc_id, size, lang and source. Files have about rows_per_file rows; a column shard_number
    of docs would clash with the folders' and is an error. Rows are shuffled with their texts twice, for their places and for the files, and lie
    in the shared folder in between.
    """
    if free_name(docs, "shard_number") != "shard_number":
        raise ValueError("docs have a column shard_number")
    n = docs.count()
    number, slot = shard_and_slot(n, shards)
    whole = free_name(docs, "whole")
    placed = on_curve(facts(docs, F.struct("*").alias(whole)))
    ordered = numbered(placed.select(whole, "curve", "tie"), [F.col("curve"), F.col("tie")])
    laid = ordered.select(whole, number.alias("shard_number"), slot.alias("slot"))
    files = max(shards, -(-n // rows_per_file))
    laid.repartitionByRange(files, "shard_number", "slot").sortWithinPartitions("shard_number", "slot").select(f"{whole}.*", "shard_number").write.partitionBy("shard_number").parquet(path)
    drop_table(ordered)
