"""Perturbation effects from sufficient statistics, against all other cells."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import two_sided_p
from ..plans.store import dealt, written

EPSILON = 0.01
BLOCK = 250  # genes of a target that are laid out for one guide after the other
BATCH_ROWS = 1 << 16  # about the rows of an Arrow batch that is laid out


def sums_by_gene(counts: DataFrame, treated: DataFrame, unit: str | list[str], size: str, parts: int = 0) -> DataFrame:
    """(unit, gene, s1, q1, size): sum and sum of squares of the counts of each unit's cells, and how many cells the unit has; treated has each pair once.

    A unit may be named by several columns.

    A count goes with the list of its cell's units and is dealt by gene alone, the one time that it is shuffled: it is laid out as pairs where they
    are added up, and what follows by gene, or by gene and another column, takes place there too. Sizes, a row for each unit, are broadcast to the sums.
    """
    units = [unit] if isinstance(unit, str) else unit
    sizes = treated.groupBy(*units).agg(F.count("*").alias(size))
    met = by_gene(counts.join(listed(treated.select("cell", *units)), "cell").select("gene", "n", "_of"), parts).select(F.inline("_of"), "gene", "n")
    return met.groupBy(*units, "gene").agg(F.sum("n").alias("s1"), F.sum(F.col("n") * F.col("n")).alias("q1")).join(F.broadcast(sizes), units)


def listed(treated: DataFrame) -> DataFrame:
    """(cell, _of): a list of each cell's rows of treated."""
    return treated.groupBy("cell").agg(F.collect_list(F.struct(*[c for c in treated.columns if c != "cell"])).alias("_of"))


def by_gene(lists: DataFrame, parts: int = 0) -> DataFrame:
    """lists, whose column _of are lists of structs, dealt by gene; on the way each field is a list of its own, which is the smaller row."""
    fields = lists.schema["_of"].dataType.elementType.names
    flat = dealt(lists.select(*[c for c in lists.columns if c != "_of"], *[F.col(f"_of.{f}").alias(f"_of_{f}") for f in fields]), "gene", parts)
    return flat.select(*[c for c in lists.columns if c != "_of"], F.arrays_zip(*[F.col(f"_of_{f}").alias(f) for f in fields]).alias("_of"))


def sums(counts: DataFrame, treated: DataFrame, cells: DataFrame, unit: str | list[str] = "guide", parts: int = 0) -> DataFrame:
    """(unit, gene, cells, s1, q1, s, q, all_cells): sums_by_gene() with the gene's own sums over all cells and their number, all dealt by gene."""
    total = cells.agg(F.count("*").alias("all_cells"))  # one row
    genes = counts.groupBy("gene").agg(F.sum("n").alias("s"), F.sum(F.col("n") * F.col("n")).alias("q"))
    return sums_by_gene(counts, treated, unit, "cells", parts).join(genes.hint("shuffle_hash"), "gene").crossJoin(F.broadcast(total))


def tested(made: DataFrame, keep: list[str], digits: int = 6) -> DataFrame:
    """(keep, cells, log2_fc, z, p_value) of sums()."""
    m, rest = F.col("cells"), F.col("all_cells") - F.col("cells")
    mean1, mean0 = F.col("s1") / m, (F.col("s") - F.col("s1")) / rest
    var1 = (F.col("q1") - F.col("s1") * F.col("s1") / m) / F.nullif(m - 1, F.lit(0))
    var0 = ((F.col("q") - F.col("q1")) - (F.col("s") - F.col("s1")) * (F.col("s") - F.col("s1")) / rest) / F.nullif(rest - 1, F.lit(0))
    spread = F.sqrt(var1 / m + var0 / rest)
    raw = made.select(*keep, "cells", F.log2((mean1 + EPSILON) / (mean0 + EPSILON)).alias("log2_fc"), ((mean1 - mean0) / F.nullif(spread, F.lit(0.0))).alias("z"))
    return raw.select(*keep, "cells", F.round("log2_fc", digits).alias("log2_fc"), F.round("z", digits).alias("z"), F.round(two_sided_p(F.col("z")), digits).alias("p_value"))


def effects(counts: DataFrame, treated: DataFrame, cells: DataFrame, unit: str = "guide", digits: int = 6, parts: int = 0) -> DataFrame:
    """(unit, gene, cells, log2_fc, z, p_value) of every pair with a count in a treated cell.

    counts (cell, gene, n) holds non-zero counts; treated (cell, unit) has each pair once. Sums and
    squares of the treated are aggregated from the join of the two; those of the complement are the gene's totals less
    the treated's, so neither zeros nor control cells are ever laid out.
    """
    return tested(sums(counts, treated, cells, unit, parts), [unit, "gene"], digits)


def by_target(treated: DataFrame, guides: DataFrame) -> DataFrame:
    """(cell, target): cells with any guide of a target."""
    return treated.join(guides.select(F.col("guide_id").alias("guide"), "target"), "guide").select("cell", "target").distinct()


def merged(a: DataFrame, b: DataFrame, keys: list[str], null_safe: bool = False, names: tuple[str, str] = ("a", "b")) -> DataFrame:
    """Full outer join of two methods' results; null keys are equal where null_safe."""
    left = a.select(*[F.col(k).alias(f"_l_{k}") for k in keys], *[F.col(c).alias(f"{names[0]}_{c}") for c in a.columns if c not in keys])
    right = b.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[F.col(c).alias(f"{names[1]}_{c}") for c in b.columns if c not in keys])
    on = None
    for k in keys:
        one = F.col(f"_l_{k}").eqNullSafe(F.col(f"_r_{k}")) if null_safe else F.col(f"_l_{k}") == F.col(f"_r_{k}")
        on = one if on is None else on & one
    joined = left.join(right, on, "full_outer")
    return joined.select(*[F.coalesce(f"_l_{k}", f"_r_{k}").alias(k) for k in keys], *[c for c in joined.columns if not c.startswith(("_l_", "_r_"))])


def merged_by_guide(a: DataFrame, elements: DataFrame, guides: DataFrame) -> DataFrame:
    """(guide_id, gene, a_log2_fc, a_p_value, b_log2_fc, b_p_value): results by guide (a) in a full join with results by target, laid to all guides of each target.

    A target's row goes with a list of the rows of a that it meets, and is laid out over its guides where it is, so the rows of the answer, as many
    as guides times genes for a target of many guides, go through no shuffle. guides (guide_id, target) are broadcast.
    """
    known = F.broadcast(guides.where("guide_id is not null and target is not null").select("guide_id", "target"))
    own = a.select("guide_id", "gene", F.struct("guide_id", F.col("log2_fc").alias("a_log2_fc"), F.col("p_value").alias("a_p_value")).alias("own"))
    lists = own.join(known, "guide_id").groupBy("target", "gene").agg(F.collect_list("own").alias("own"))
    both = written(elements.select("target", "gene", F.col("log2_fc").alias("b_log2_fc"), F.col("p_value").alias("b_p_value"), F.lit(True).alias("tested")).join(lists, ["target", "gene"], "full_outer"), "by-element")
    rows = ["guide_id", "gene", "a_log2_fc", "a_p_value", "b_log2_fc", "b_p_value"]
    met = both.select("gene", "b_log2_fc", "b_p_value", F.inline("own"))
    none = F.lit(None).cast("double")
    alone = both.where("tested").join(known, "target")
    alone = alone.where(~F.coalesce(F.array_contains("own.guide_id", F.col("guide_id")), F.lit(False)))
    unknown = a.join(known.select("guide_id").distinct(), "guide_id", "left_anti").select("guide_id", "gene", F.col("log2_fc").alias("a_log2_fc"), F.col("p_value").alias("a_p_value"), none.alias("b_log2_fc"), none.alias("b_p_value"))
    return met.select(rows).unionByName(alone.select("guide_id", "gene", none.alias("a_log2_fc"), none.alias("a_p_value"), "b_log2_fc", "b_p_value")).unionByName(unknown)


def by_guide_and_target(counts: DataFrame, treated: DataFrame, cells: DataFrame, guides: DataFrame, digits: int = 6, parts: int = 0) -> DataFrame:
    """merged_by_guide() of the effects of guides and those of their targets, worked out together: (guide_id, gene, a_log2_fc, a_p_value, b_log2_fc, b_p_value).

    treated (cell, guide). A count goes to its gene with the list of its cell's guides and targets, the one time that it is shuffled. Results are sorted by
    target where they are, and the rows of the answer, guides times genes for a target of many guides, are laid out there in Arrow batches: some BLOCK
    genes for one guide after the other, which columnar files store in little. Guides' targets, a row for each guide, are held by the driver and every worker.
    """
    spark = counts.sparkSession
    known = guides.where("guide_id is not null and target is not null").select(F.col("guide_id").cast("long").alias("guide"), F.col("target").cast("string").alias("target")).toArrow().sort_by([("target", "ascending"), ("guide", "ascending")])
    ids = np.asarray(known.column("guide"))
    number = np.asarray(known.column("target").combine_chunks().dictionary_encode().indices, np.int64)  # of each target, in their order
    numbers = spark.createDataFrame(pa.table({"guide": ids, "number": number})) if len(ids) else spark.createDataFrame([], "guide long, number long")
    lists = treated.join(F.broadcast(numbers), "guide", "left").groupBy("cell").agg(F.collect_set("guide").alias("guides"), F.collect_set("number").alias("targets"))
    units = lists.select("cell", F.size("guides").alias("own"), F.posexplode(F.concat("guides", "targets")).alias("at", "unit")).select("cell", (F.col("at") >= F.col("own")).alias("is_target"), "unit")
    made = tested(sums(counts, units, cells, ["is_target", "unit"], parts), ["is_target", "unit", "gene"], digits)
    of = numbers.select(F.lit(False).alias("is_target"), F.col("guide").alias("unit"), "number").unionByName(numbers.select(F.lit(True).alias("is_target"), F.col("number").alias("unit"), "number").distinct())
    rows = made.join(F.broadcast(of), ["is_target", "unit"], "left").select("number", "gene", F.when(~F.col("is_target"), F.col("unit")).alias("guide"), "log2_fc", "p_value")
    starts = np.searchsorted(number, np.arange((number[-1] if len(number) else -1) + 2))  # where each target's guides begin, with the end
    return rows.sortWithinPartitions("number", "gene").mapInArrow(lambda batches: merged_batches(batches, ids, starts), "guide_id long, gene long, " + ", ".join(f"{m}_{c} double" for m in "ab" for c in ("log2_fc", "p_value")))


def merged_batches(batches, ids: np.ndarray, starts: np.ndarray, block: int = BLOCK, most: int = BATCH_ROWS):
    """Batches of by_guide_and_target() from its rows (number, gene, guide, log2_fc, p_value) in the order of number and gene; a target's own row has no guide.

    The guides of target t are ids[starts[t] : starts[t + 1]] in ascending order. Guides without a target come first and go on as they are.
    """
    names = ["guide_id", "gene", "a_log2_fc", "a_p_value", "b_log2_fc", "b_p_value"]
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if table.column("number").null_count:
            alone = table.filter(pc.is_null(table.column("number"))).combine_chunks()
            none = pa.nulls(alone.num_rows, pa.float64())
            yield from pa.table([alone.column("guide"), alone.column("gene"), alone.column("log2_fc"), alone.column("p_value"), none, none], names=names).to_batches()
            table = table.filter(pc.is_valid(table.column("number")))
        held = table if held is None else pa.concat_tables([held, table])
        at = pieces(held, block)
        if len(at) > 1:  # the last piece may go on
            yield from laid_out(held.slice(0, at[-1]), at, ids, starts, most, names)
            held = held.slice(at[-1])
    if held is not None and held.num_rows:
        yield from laid_out(held, np.append(pieces(held, block), held.num_rows), ids, starts, most, names)


def changes(*columns: np.ndarray) -> np.ndarray:
    """Whether a row differs from the one before in any column."""
    out = np.zeros(len(columns[0]), bool)
    out[:1] = True
    for c in columns:
        out[1:] |= c[1:] != c[:-1]
    return out


def plain(table: pa.Table, name: str) -> np.ndarray:
    return np.asarray(pc.fill_null(table.column(name), -1), np.int64)


def pieces(table: pa.Table, block: int) -> np.ndarray:
    """The rows where pieces begin: at most `block` genes of one target."""
    number, gene = plain(table, "number"), plain(table, "gene")
    target = changes(number)
    place = np.cumsum(changes(number, gene, np.asarray(pc.is_null(table.column("gene")))))  # of the gene
    first = place[np.flatnonzero(target)][np.cumsum(target) - 1] if len(place) else place
    return np.flatnonzero(changes(number, (place - first) // block))


def laid_out(table: pa.Table, at: np.ndarray, ids: np.ndarray, starts: np.ndarray, most: int, names: list[str]):
    """Batches of whole pieces, which begin at the rows `at` (with the end): a line for each piece and guide, with a row for each gene."""
    table = table.combine_chunks()
    number, gene = plain(table, "number"), plain(table, "gene")
    is_target = np.asarray(pc.is_null(table.column("guide")))
    piece = np.repeat(np.arange(len(at) - 1), np.diff(at))
    target, own = table.filter(pa.array(is_target)), table.filter(pa.array(~is_target))
    width = np.bincount(piece[is_target], minlength=len(at) - 1)  # genes of a piece
    begin = np.cumsum(width) - width
    place = np.cumsum(changes(piece, gene, np.asarray(pc.is_null(table.column("gene"))))) - 1  # of each row's gene among all targets' rows
    of = number[at[:-1]]
    many = starts[of + 1] - starts[of]
    line_piece = np.repeat(np.arange(len(of)), many)
    guide = ids[np.repeat(starts[of] - (np.cumsum(many) - many), many) + np.arange(many.sum())]
    line_rows = width[line_piece]
    ends = np.cumsum(line_rows)
    # the lines of each own row: those of its piece and guide
    every = np.unique(ids)
    line_key = line_piece * len(every) + np.searchsorted(every, guide)
    own_key = piece[~is_target] * len(every) + np.searchsorted(every, plain(own, "guide"))
    lo, hi = np.searchsorted(line_key, own_key), np.searchsorted(line_key, own_key, "right")
    entry = np.repeat(np.arange(len(own_key)), hi - lo)
    line = np.repeat(lo - (np.cumsum(hi - lo) - (hi - lo)), hi - lo) + np.arange(len(entry))
    row = (ends - line_rows)[line] + (place[~is_target] - begin[piece[~is_target]])[entry]
    order = np.argsort(row, kind="stable")
    row, entry = row[order], entry[order]
    columns = {c: target.column(c).combine_chunks() for c in ("gene", "log2_fc", "p_value")}
    own = {c: own.column(c).combine_chunks() for c in ("log2_fc", "p_value")}
    a = 0
    while a < len(guide):
        start = ends[a] - line_rows[a]
        b = max(a + 1, int(np.searchsorted(ends, start + most, "right")))
        n = int(ends[b - 1] - start)
        rows = line_rows[a:b]
        index = pa.array(np.repeat(begin[line_piece[a:b]] - (ends[a:b] - rows - start), rows) + np.arange(n))
        x, y = np.searchsorted(row, [start, start + n])
        if x < y:
            to, none = np.zeros(n, np.int64), np.ones(n, bool)
            to[row[x:y] - start], none[row[x:y] - start] = entry[x:y], False
            to = pa.array(to, mask=none)
            first = [own["log2_fc"].take(to), own["p_value"].take(to)]
        else:
            first = [pa.nulls(n, pa.float64())] * 2
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(guide[a:b], rows)), columns["gene"].take(index), *first, columns["log2_fc"].take(index), columns["p_value"].take(index)], names=names)
        a = b
