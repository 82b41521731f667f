"""Readers and writers of the screen's file formats."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.concat import stacked
from ..operators.order import running
from ..plans.checks import require_columns
from ..plans.store import written
from . import downloads

SHEET = "R1_path string, R2_path string, file_modality string, measurement_sets string, sequencing_run string, lane string, seqspec string, barcode_onlist string, guide_design string, barcode_hashtag_map string"
GTF = "seqname string, source string, feature string, start long, end long, score string, strand string, frame string, attributes string"


def read_sheet(spark: SparkSession, path: str) -> DataFrame:
    """Sample sheet with trimmed fields and the id of its sample; short rows end in nulls."""
    raw = spark.read.csv(path, header=True, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
    return raw.withColumn("id", F.concat_ws("_", F.lit("sample"), "file_modality", "measurement_sets"))


def samples(sheet: DataFrame) -> DataFrame:
    """One row a sample: its read files in order of run and lane, and its modality in lower case."""
    files = F.array_sort(F.collect_list(F.struct("sequencing_run", "lane", "R1_path", "R2_path")))
    grouped = sheet.groupBy("id", F.lower("file_modality").alias("modality")).agg(files.alias("f"))
    return grouped.select("id", "modality", F.flatten(F.transform("f", lambda x: F.array(x["R1_path"], x["R2_path"]))).alias("files"))


def listed(spark: SparkSession, paths: list[str]) -> list[str]:
    """The delimited files under these files and folders at any depth, each once by its resolved path, sorted."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    found = set()
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        store = path.getFileSystem(conf)
        if store.getFileStatus(path).isFile():
            found.add(store.resolvePath(path).toString())
            continue
        files = store.listFiles(path, True)
        while files.hasNext():
            name = store.resolvePath(files.next().getPath()).toString()
            if name.endswith((".tsv", ".tsv.gz", ".csv", ".csv.gz")):
                found.add(name)
    return sorted(found)


def read_table(spark: SparkSession, path: str | list[str], header: bool = True, required: list[str] | None = None) -> DataFrame:
    """Delimited text, gzip or not, from files and folders at any depth, each file once; commas where a name says .csv, else tabs.

    Columns are matched by name where there is a header. A missing required column, or no file, is an error.
    """
    files = listed(spark, [path] if isinstance(path, str) else path)
    if not files:
        raise FileNotFoundError(f"no delimited files under {path}")
    frames = []
    for sep, kind in ((",", True), ("\t", False)):
        if some := [f for f in files if f.endswith((".csv", ".csv.gz")) == kind]:
            frames.append(spark.read.csv(some, sep=sep, header=header))
    out = stacked(frames)
    return require_columns(out, *(required or ()))


def write_table(df: DataFrame, path: str, header: bool = True) -> None:
    df.write.mode("overwrite").csv(path, sep="\t", header=header, compression="gzip")


def read_gtf(spark: SparkSession, path: str, feature: str | None = None) -> DataFrame:
    rows = spark.read.csv(path, sep="\t", comment="#", schema=GTF)

    def attribute(name: str):
        return F.nullif(F.regexp_extract("attributes", f'{name} "([^"]+)"', 1), F.lit("")).alias(name)

    rows = rows.select("seqname", "source", "feature", "start", "end", "strand", attribute("gene_id"), attribute("gene_name"))
    rows = rows.withColumn("gene", F.split_part("gene_id", F.lit("."), F.lit(1)))
    return rows.where(F.col("feature") == feature) if feature else rows


def read_bed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", comment="#", schema="chr string, start long, stop long, name string, score double")


def read_peaks(spark: SparkSession, path: str) -> DataFrame:
    """A table of peaks with a header line, whatever its columns: chrom, start, end and score or other names; numbers where they are ones."""
    return spark.read.csv(path, sep="\t", comment="#", header=True, inferSchema=True)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line, value) of a text file, line from 0: the number of lines in earlier splits, which the driver adds up, and the place in the own."""
    lines = spark.read.text(path).select("value", F.monotonically_increasing_id().alias("i"))
    lines = lines.withColumn("part", F.shiftright("i", 33)).withColumn("at", F.col("i").bitwiseAND((1 << 33) - 1))
    sizes = lines.groupBy("part").agg(F.count("*").alias("n")).collect()  # a row for each split of the file
    before, total = {}, 0
    for r in sorted(sizes, key=lambda r: r.part):
        before[r.part], total = total, total + r.n
    offsets = spark.createDataFrame(sorted(before.items()) or [(0, 0)], "part long, before long")
    return lines.join(F.broadcast(offsets), "part").select((F.col("at") + F.col("before")).alias("line"), "value")


def read_matrix(spark: SparkSession, folder: str) -> DataFrame:
    """Matrix market folder (matrix, features and barcodes, gzip or not) to (cell, feature, n); the matrix holds features in rows."""
    text = spark.read.text(f"{folder}/matrix.mtx*").select("value", F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("i"))
    head = text.where(F.col("value").startswith("%%MatrixMarket")).select("file")
    body = text.where(~F.col("value").startswith("%"))
    first = body.join(F.broadcast(head), "file").agg(F.min("i").alias("first"))  # the line of sizes
    parts = body.crossJoin(F.broadcast(first)).where(F.col("i") != F.col("first")).select(F.split("value", " +").alias("p"))
    cells = parts.select(*[F.col("p")[i].cast("double").cast("long").alias(c) for i, c in enumerate(("row", "col", "n"))])

    def numbered(name: str, column: str) -> DataFrame:
        return numbered_lines(spark, f"{folder}/{name}.tsv*").select((F.col("line") + 1).alias("at"), F.split("value", "\t")[0].alias(column))

    out = cells.join(numbered("features", "feature"), F.col("row") == F.col("at")).drop("at")
    return out.join(numbered("barcodes", "cell"), F.col("col") == F.col("at")).select("cell", "feature", "n")


def write_matrix(counts: DataFrame, folder: str) -> None:
    """(cell, feature, n) as a matrix market folder: features in rows, both sorted by name, gzip; features.tsv, barcodes.tsv and matrix.mtx are folders of parts.

    Names take one part each, so that their lines keep their numbers; the matrix is as many as it needs, the head in the first.
    """
    spark = counts.sparkSession
    kept = written(counts.select(F.col("cell").cast("string").alias("cell"), F.col("feature").cast("string").alias("feature"), "n"), "counts")
    names = {}
    for column, file in (("feature", "features.tsv"), ("cell", "barcodes.tsv")):
        names[column] = written(by_name(kept.select(column).distinct(), column), column)
        names[column].orderBy("place").coalesce(1).select(column).write.text(f"{folder}/{file}.gz", compression="gzip")
    n, rows, cols = kept.count(), names["feature"].count(), names["cell"].count()
    entries = kept.join(names["feature"].withColumnRenamed("place", "row"), "feature").join(names["cell"].withColumnRenamed("place", "col"), "cell")
    lines = entries.select(F.col("col").alias("order"), F.concat_ws(" ", *[F.col(c).cast("string") for c in ("row", "col", "n")]).alias("value"))
    head = spark.createDataFrame([(-2, "%%MatrixMarket matrix coordinate integer general"), (-1, "%"), (0, f"{rows} {cols} {n}")], "order long, value string")
    lines.unionByName(head).repartitionByRange("order").sortWithinPartitions("order").select("value").write.text(f"{folder}/matrix.mtx.gz", compression="gzip")


def by_name(df: DataFrame, column: str) -> DataFrame:
    """df of distinct names with place, from 1 in their order: ranges of names are numbered alone, after the numbers of earlier ranges."""
    ranged = written(df.repartitionByRange(column).select(column, F.spark_partition_id().alias("_part")), "names")
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    before = sizes.select("_part", F.coalesce(F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"))  # a row a range
    return ranged.join(F.broadcast(before), "_part").select(column, (F.col("_before") + F.row_number().over(W.partitionBy("_part").orderBy(column))).alias("place"))


def read_fastq(spark: SparkSession, path: str, most: int | None = None) -> DataFrame:
    """Sequences of a FASTQ file, gzip or not; the first `most` where it is given. Records are four lines."""
    line = numbered_lines(spark, path).where("line % 4 = 1")
    reads = line.select(F.floor(F.col("line") / 4).alias("read_id"), F.col("value").alias("seq"))
    return reads.where(F.col("read_id") < most) if most is not None else reads


def read_fasta(spark: SparkSession, path: str, most: int | None = None) -> DataFrame:
    """(read_id, name, seq) of a FASTA file, gzip or not; the first `most` where it is given. A record's lines are joined."""
    lines = written(numbered_lines(spark, path).where("trim(value) != ''"), "fasta")
    head = F.col("value").startswith(">")
    placed = running(lines, "line", [], {"record": ("sum", head.cast("long"))})
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(~head, F.struct("line", "value")))), lambda x: F.trim(x["value"])), "")
    reads = placed.where("record > 0").groupBy((F.col("record") - 1).alias("read_id")).agg(F.max(F.when(head, F.trim(F.expr("substring(value, 2)")))).alias("name"), body.alias("seq"))
    return reads.where(F.col("read_id") < most) if most is not None else reads


def read_reads(spark: SparkSession, path: str, most: int | None = None) -> DataFrame:
    """(read_id, seq) of a FASTQ or a FASTA file, told apart by the first character."""
    first = spark.read.text(path).where("trim(value) != ''").first()
    read = read_fasta if first is not None and first.value.lstrip().startswith(">") else read_fastq
    return read(spark, path, most).select("read_id", "seq")


def read_run_info(spark: SparkSession, path: str) -> DataFrame:
    """One JSON object a sample to (parameter, value), value as text."""
    wide = spark.read.json(path, multiLine=True)
    return wide.select(*[F.col(c).cast("string") for c in wide.columns]).unpivot([], wide.columns, "parameter", "value")


def md5_of(spark: SparkSession, path: str | list[str], whole: int = 64 << 20) -> DataFrame:
    """(path, md5) of the whole files that paths or patterns name; one that names none is Spark's error. Files over `whole` bytes are read in pieces, smaller ones as a row each."""
    small, large = downloads.sums_below(spark, path, whole)
    return small.unionByName(downloads.streamed_sums(large))


def verified(files: DataFrame) -> DataFrame:
    """files (path, md5) with found, the sum of the file as it is, null where there is none, and matches. Files of any size are read in pieces, by paths that pyarrow opens."""
    sums = downloads.streamed_sums(files).withColumnRenamed("md5", "found")
    return files.join(sums, "path", "left").withColumn("matches", F.coalesce(F.lower("md5") == F.col("found"), F.lit(False)))
