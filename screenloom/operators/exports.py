"""Result tables with their metadata, as they are handed on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import CONTROL
from ..plans.checks import CheckError


def with_guides(results: DataFrame, guides: DataFrame, columns: list[str]) -> DataFrame:
    """results with columns of their guide's metadata; results without one keep nulls."""
    return results.join(guides.select("guide_id", *columns), "guide_id", "left")


def beside(main: DataFrame, other: DataFrame, keys: list[str], names: tuple[str, str]) -> DataFrame:
    """Rows of main with the other method's values: columns other than keys get their method's name in front."""
    left = main.select(*keys, *[F.col(c).alias(f"{names[0]}_{c}") for c in main.columns if c not in keys])
    right = other.select(*keys, *[F.col(c).alias(f"{names[1]}_{c}") for c in other.columns if c not in keys])
    return left.join(right, keys, "left")


def side_by_side(rows: DataFrame, keys: list[str], methods: dict[str, list[Column | str]]) -> DataFrame:
    """beside() of methods whose results are columns of one table already: each method's columns with its name in front, and nothing joined."""
    columns = [(name, rows.select(c).columns[0], c) for name, own in methods.items() for c in own]
    return rows.select(*keys, *[(F.col(c) if isinstance(c, str) else c).alias(f"{name}_{n}") for name, n, c in columns])


def decoded(results: DataFrame, targets: DataFrame, key: str = "key") -> DataFrame:
    """results with the display columns of their target key; an unknown key is an error."""
    if missing := results.join(targets, key, "left_anti").select(key).distinct().limit(10).collect():
        raise CheckError(f"no target has the keys {[r[0] for r in missing]}")
    return results.join(targets, key, "left")


def average_expression(counts: DataFrame, genes: DataFrame, cells: DataFrame) -> DataFrame:
    """(symbol, avg_expression): mean count of a symbol's genes over all cells, zeros included."""
    every = cells.agg(F.count("*").alias("all_cells"))
    per = counts.groupBy("gene").agg(F.sum("n").alias("total"))
    summed = genes.select("gene", "symbol").join(per, "gene", "left").groupBy("symbol").agg(F.sum(F.coalesce("total", F.lit(0))).alias("total"), F.count("*").alias("genes"))
    return summed.crossJoin(F.broadcast(every)).select("symbol", F.round(F.col("total") / (F.col("genes") * F.col("all_cells")), 9).alias("avg_expression"))


def element_export(per_guide: DataFrame, firsts: list[str]) -> DataFrame:
    """(gene, target, guides, ...) of rows (gene, target, guide_id, ...): guide ids joined by commas in their order, other columns those of the first guide."""
    grouped = per_guide.groupBy("gene", "target").agg(F.array_join(F.array_sort(F.collect_list("guide_id")), ",").alias("guides"), F.min_by(F.struct(*firsts), "guide_id").alias("_row"))
    return grouped.select("gene", "target", "guides", "_row.*")


def collapsed_features(assigned: DataFrame, guides: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """Of cells (cell, guide) the joined guides and spacers of each target with the first guide's other columns, and the new features, each once.

    guides have guide_id, target, spacer and the columns.
    """
    named = assigned.join(guides.select(F.col("guide_id").alias("guide"), "target", "spacer", *columns), "guide")
    sorted_guides = F.array_sort(F.collect_list(F.struct("guide", "spacer")))
    cells = named.groupBy("cell", "target").agg(sorted_guides.alias("g"), F.min_by(F.struct(*columns), "guide").alias("_row"))
    cells = cells.select("cell", "target", F.array_join("g.guide", "|").alias("collapsed"), F.array_join("g.spacer", "|").alias("spacers"), "_row.*")
    rest = ["target", "spacers", *columns]
    features = cells.groupBy("collapsed").agg(F.min_by(F.struct(*rest), "cell").alias("_row")).select("collapsed", "_row.*")
    return cells, features


def element_means(results: DataFrame, by: list[str]) -> DataFrame:
    """Mean fold change and least p of each element."""
    return results.groupBy(*by).agg(F.round(F.avg("log2_fc"), 10).alias("log2_fc"), F.min("p_value").alias("p_value"))


def first_targets(results: DataFrame, n: int, target: str = "target") -> DataFrame:
    """The n targets with the least p, in its order; of equal ones the first by name."""
    return results.groupBy(target).agg(F.min("p_value").alias("p_value")).orderBy(F.asc_nulls_last("p_value"), target).limit(n)


def crosstab(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("n"))


def tag_shares(tags: Column) -> list[Column]:
    """Percent of cells that are negative, singlets and multiplets, by their joined tags."""
    kind = F.when(tags == "negative", "negative").when(tags.contains("-"), "multiplet").otherwise("singlet")
    return [F.round(100.0 * F.avg((kind == k).cast("double")), 6).alias(f"pct_{k}") for k in ("negative", "singlet", "multiplet")]


def edge_table(results: DataFrame, least: float | None = None, centre: str | None = None) -> DataFrame:
    """Distinct edges (src, dst, weight, p_value) of results with these columns, with |weight| of `least` or more, from the node `centre`, where these are given."""
    edges = results.select("src", "dst", "weight", "p_value").distinct()
    if least is not None:
        edges = edges.where(F.abs("weight") >= least)
    return edges.where(F.col("src") == centre) if centre is not None else edges


def node_sizes(edges: DataFrame, prefixes: tuple[str, str] = ("", "")) -> DataFrame:
    """(node, in_edges, min_p, size) of every node: size is -log10 of the least p of its in-edges times 100, and 100 without one.

    A node is its end of the edge behind the prefix for src or dst. In-edges are counted by dst as it is, so edges that lie dealt by it stay there, and
    only ends, once each, meet by name.
    """
    src, dst = (F.concat(F.lit(p), F.col(c).cast("string")).alias("node") for p, c in zip(prefixes, ("src", "dst")))
    into = edges.groupBy("dst").agg(F.count("*").alias("k"), F.min("p_value").alias("p_value")).select(dst, "p_value", "k")
    out = edges.select("src").distinct().select(src, F.lit(None).cast("double").alias("p_value"), F.lit(0).cast("long").alias("k"))
    per = into.unionByName(out).groupBy("node").agg(F.sum("k").alias("in_edges"), F.min("p_value").alias("min_p"))
    return per.withColumn("size", F.when(F.col("in_edges") > 0, F.round(-F.log10(F.greatest(F.col("min_p"), F.lit(1e-300))) * 100, 6)).otherwise(100.0))


def coordinates(genes: DataFrame, guides: DataFrame) -> DataFrame:
    """(name, chr, start, end): genes with coordinates, then targets that aren't among them; the exact name of controls is left out, the first guide of a target counts."""
    known = genes.where("start is not null and end is not null").select(F.col("gene").cast("string").alias("name"), "chr", "start", "end")
    per = guides.where(F.col("target") != CONTROL).groupBy(F.col("target").alias("name")).agg(F.min_by(F.struct("chr", "start", "end"), "guide_id").alias("at")).select("name", "at.*")
    return known.unionByName(per.join(known, "name", "left_anti"))


def guide_groups(cells: DataFrame, assigned: DataFrame) -> DataFrame:
    """(cells, with_guide, with_one, frac_with_guide, frac_with_one) over all cells."""
    per = assigned.groupBy("cell").agg(F.count("*").alias("k"))
    both = cells.select("cell").join(per, "cell", "left")
    some, one = F.count_if(F.col("k") >= 1), F.count_if(F.col("k") == 1)
    return both.agg(F.count("*").alias("cells"), some.alias("with_guide"), one.alias("with_one"), F.round(some / F.count("*"), 6).alias("frac_with_guide"), F.round(one / F.count("*"), 6).alias("frac_with_one"))


def guide_sums(guides: DataFrame, guide_counts: DataFrame) -> DataFrame:
    """(guide_id, total): counts of each guide over all cells, 0 for one without; to be read in ascending order."""
    per = guide_counts.groupBy(F.col("guide").alias("guide_id")).agg(F.sum("n").alias("total"))
    return guides.select("guide_id").join(per, "guide_id", "left").na.fill(0, ["total"])
