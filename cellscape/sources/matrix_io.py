"""Matrix files and bundles.

S1 ``read_counts_csv``  delimited dense matrix: header = column names, first column = row names
S2 ``orient_matrix``    fewer columns than rows -> read as genes x cells and transposed (roles swapped, no data moved)
S3 ``read_counts_mtx``  Matrix Market coordinate file + barcodes + features (genes x cells on disk)
S4 ``load_counts``      format choice by extension (explicit format wins)
S5 ``write_bundle`` / ``read_bundle``  the whole annotated matrix as one parquet folder per table
S6 ``default_dataset``  the default table set when no path is given
S7/S8 ``write_table_csv`` one CSV with header, no index, written even when empty

Files are read with ``spark.read.text`` and split with column functions: a matrix with
tens of thousands of columns is never given to the CSV schema machinery.  Scratch
output goes under the session's checkpoint folder (shared storage on a cluster).
"""

from __future__ import annotations

import re
import uuid
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellscape.functions.windows import row_number_by_unique_key
from cellscape.matrix import CountMatrix
from cellscape.session import cut_lineage, ensure_checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/cellscape-io/{name}-{uuid.uuid4().hex}"


def _first_existing(spark: SparkSession, *paths: str) -> str:
    """The first of the paths that exists, so that a plain and a compressed copy are not both read."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        if at.getFileSystem(conf).exists(at):
            return path
    raise FileNotFoundError(f"none of these exists: {', '.join(paths)}")


def _file_order(path: Column) -> Column:
    """Orders numbered part files by their number and others by their path."""
    number = F.regexp_extract(path, r"/part-(\d+)[^/]*$", 1)
    return F.concat(F.regexp_extract(path, r"^(.*/)[^/]*$", 1), F.lpad(number, 12, "0"), F.regexp_extract(path, r"([^/]*)$", 1))


def _scanned_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line, path, start, at): text lines of a file or of all files under a folder, with ``path`` of the file, ``start``, the
    block's offset in it, and ``at``, which rises inside a block."""
    return (spark.read.option("recursiveFileLookup", "true").text(path)
            .select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("path"),
                    F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at")))


def _placed_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line, file, start, at): the lines of ``path``, ordered by the last three."""
    return _scanned_lines(spark, path).select("line", _file_order(F.col("path")).alias("file"), "start", "at")


def _numbered(lines: DataFrame) -> DataFrame:
    """``lines``, placed and written, with ln in place of file, start and at: the 0-based number of the line over all files.

    A line's number is the number of lines in the blocks before its own plus its place in the block.  The prefix sum runs over
    the blocks of a file and then over files, so its rows grow with the bytes divided by the block size only.
    """
    blocks = lines.groupBy("file", "start").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    files = blocks.groupBy("file").agg(F.sum("n").alias("n")).select(
        "file", F.coalesce(F.sum("n").over(before.orderBy("file")), F.lit(0)).alias("files"))
    inside = F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = blocks.withColumn("inside", inside).join(files, "file").select(
        "file", "start", (F.col("files") + F.col("inside") - F.col("first")).alias("offset"))
    return lines.join(offsets, ["file", "start"]).withColumn("ln", F.col("offset") + F.col("at")).drop("file", "start", "at", "offset")


def _numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line, ln) with ln the 0-based number of the line over all files."""
    return _numbered(cut_lineage(_placed_lines(spark, path)))


@contextmanager
def _small_batches(spark: SparkSession):
    """Lines with very many fields travel to and from Python a few at a time."""
    before = {key: spark.conf.get(key, None) for key in _BATCH}
    try:
        for key, value in _BATCH.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


#: At lines of 5 MB, a batch has 80 MB.
_BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "16"}
#: Bytes of dense text that are given back at once.
_TEXT_BYTES = 1 << 24


def _number(raw: Column) -> Column:
    """A trimmed field as a double; an empty field is null, anything else that is no number is an error."""
    text = F.trim(raw)
    return F.when(text != "", F.coalesce(text.try_cast("double"), F.raise_error(F.concat(F.lit("not a number: "), text)).cast("double")))


def _positions(df: DataFrame, key: str, out: str) -> DataFrame:
    """(key, out): the 0-based place of every row in the order of its unique integer key."""
    ranked = row_number_by_unique_key(df.select(key).withColumn("_all", F.lit(1)), ["_all"], key, out)
    return ranked.select(key, (F.col(out) - 1).alias(out))


# --------------------------------------------------------------------------- CSV

def write_counts_csv(m: CountMatrix, path: str, sep: str = ",", cell_name: str = "cell_name",
                     gene_name: str = "gene_name", codec: str | None = None) -> str:
    """Dense CSV of the matrix (one line per cell, one column per gene, zeros written out) as a folder.

    ``path/header`` holds the header line, ``path/rows`` the cells in order of their id in as many part files as there are
    range partitions.  A line is put together from the cell's own entries and pieces of a line of zeros; a task holds
    ``_TEXT_BYTES`` of lines, or one line.  ``codec``: compression of the text files, none by default.
    """
    genes = _positions(m.genes, "gene_id", "place").join(m.genes.select("gene_id", F.col(gene_name).cast("string").alias("name")), "gene_id")
    names = F.transform(F.array_sort(F.collect_list(F.struct("place", "name"))), lambda g: g["name"])
    genes.agg(F.concat_ws(sep, F.lit(""), names).alias("value")).write.mode("overwrite").text(f"{path}/header", compression=codec)
    width = m.genes.count()
    entries = (m.expr.join(genes.select("gene_id", "place"), "gene_id").groupBy("cell_id")
               .agg(F.collect_list("place").alias("places"), F.collect_list("value").alias("values")))
    zero = sep + repr(0.0)

    def lines(batches):
        zeros = zero * width
        for pdf in batches:
            out, held = [], 0
            for name, places, values in zip(pdf["name"], pdf["places"], pdf["values"]):
                pieces, done = [name], 0
                # Of entries at one place the last one counts.
                for place, value in sorted(dict(zip(places, values)).items()) if places is not None else ():
                    pieces += [zeros[done * len(zero):place * len(zero)], sep, repr(float(value))]
                    done = place + 1
                out.append("".join([*pieces, zeros[done * len(zero):]]))
                held += len(out[-1])
                if held > _TEXT_BYTES:
                    yield pd.DataFrame({"value": out})
                    out, held = [], 0
            yield pd.DataFrame({"value": out}, dtype=object)

    rows = (m.cells.select("cell_id", F.col(cell_name).cast("string").alias("name")).join(entries, "cell_id", "left")
            .repartitionByRange("cell_id").sortWithinPartitions("cell_id"))
    rows.select("name", "places", "values").mapInPandas(lines, "value string").write.mode("overwrite").text(f"{path}/rows", compression=codec)
    return path


_FIELDS = "file string, start long, at long, line string, blank boolean, name string, places array<int>, raws array<string>"


def _filled_fields(sep: str):
    """A function of batches of placed lines: (line, blank, name, places, raws) with the place and text of every field that is
    neither empty nor a plain zero.

    ``line`` is kept for the first line of a block that is not blank, as it may be the header.
    """
    plain = len(sep.encode()) == 1 and re.escape(sep) == sep or sep in ",;\t"

    def fields(text: bytes) -> tuple[str, np.ndarray, list[str]]:
        if not plain:
            name, *raws = re.split(sep, text.decode())
            places = np.array([i for i, raw in enumerate(raws) if raw not in ("", "0", "0.0")], dtype=np.int32)
            return name, places, [raws[i] for i in places]
        b = np.frombuffer(text + b"   ", dtype=np.uint8)  # three more bytes, so that every field can be looked at
        cuts = np.flatnonzero(b[:len(text)] == ord(sep))
        if not len(cuts):
            return text.decode(), np.empty(0, np.int32), []
        starts, ends = cuts + 1, np.append(cuts[1:], len(text))
        n, nought = ends - starts, b[starts] == ord("0")
        zero = (n == 0) | nought & ((n == 1) | (n == 3) & (b[starts + 1] == ord(".")) & (b[starts + 2] == ord("0")))
        places = np.flatnonzero(~zero).astype(np.int32)
        return text[:cuts[0]].decode(), places, [text[starts[i]:ends[i]].decode() for i in places]

    def parse(batches):
        seen = set()
        for batch in batches:
            kept = {"line": [], "blank": [], "name": [], "places": [], "raws": []}
            for line, file, start in zip(batch.column("line"), batch.column("file"), batch.column("start")):
                text = line.as_buffer().to_pybytes()
                blank = not text.strip(b" ")
                block = (file.as_py(), start.as_py())
                first = not blank and block not in seen
                if first:
                    seen.add(block)
                name, places, raws = fields(text)
                for key, value in zip(kept, (text.decode() if first else None, blank, name, places, raws)):
                    kept[key].append(value)
            types = {"line": pa.string(), "blank": pa.bool_(), "name": pa.string(), "places": pa.list_(pa.int32()), "raws": pa.list_(pa.string())}
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("file", "start", "at")] + [pa.array(kept[c], t) for c, t in types.items()],
                                             names=["file", "start", "at", *types])

    return parse


def read_counts_csv(spark: SparkSession, path: str, sep: str = ",") -> CountMatrix:
    """Header line = column (gene) names after the first field; every other line =
    row (cell) name then values.  Zeros and empty fields are dropped.

    ``cells(cell_id, cell_name)``: cell_id is the 0-based data line number.
    ``genes(gene_id, gene_name)``: gene_id is the 0-based column position.
    Dense lines are read once, and only their fields other than zeros are written.
    """
    with _small_batches(spark):
        filled = cut_lineage(_placed_lines(spark, path).select("line", "file", "start", "at").mapInArrow(_filled_fields(sep), _FIELDS))
    lines = _numbered(filled).where(~F.col("blank"))
    first = lines.select(F.min("ln")).scalar()
    head = lines.where(F.col("ln") == first).select(F.split("line", sep).alias("f"))
    genes = head.select(F.posexplode("f").alias("pos", "gene_name")).where(F.col("pos") > 0).select(
        (F.col("pos") - 1).cast("bigint").alias("gene_id"), F.trim("gene_name").alias("gene_name")
    )
    body = lines.where(F.col("ln") > first).withColumn("cell_id", F.col("ln") - first - 1)
    cells = body.select("cell_id", F.trim("name").alias("cell_name"))
    expr = (
        body.select("cell_id", F.inline(F.arrays_zip("places", "raws")))
        .select("cell_id", F.col("places").cast("bigint").alias("gene_id"), _number(F.col("raws")).alias("value"))
        .where(F.col("value").isNotNull() & (F.col("value") != 0))
    )
    return CountMatrix(cells=cells, genes=genes, expr=expr)


def orient_matrix(m: CountMatrix, layout: str = "auto") -> CountMatrix:
    """The CSV rule - when the file has fewer columns than rows it is taken as
    genes x cells and transposed.  ``layout`` = "cells_x_genes" / "genes_x_cells" forces it.

    Transposition swaps the roles of the two id columns with a ``select``; no data moves.
    """
    if layout == "cells_x_genes":
        return m
    if layout == "auto":
        n_rows, n_cols = m.cells.count(), m.genes.count()
        if not n_cols < n_rows:
            return m
    cells = m.genes.select(F.col("gene_id").alias("cell_id"), F.col("gene_name").alias("cell_name"))
    genes = m.cells.select(F.col("cell_id").alias("gene_id"), F.col("cell_name").alias("gene_name"))
    expr = m.expr.select(F.col("gene_id").alias("cell_id"), F.col("cell_id").alias("gene_id"), "value")
    return CountMatrix(cells=cells, genes=genes, expr=expr)


# --------------------------------------------------------------------------- MTX (S3)

def write_counts_mtx(m: CountMatrix, folder: str, cell_name: str = "cell_name", gene_name: str = "gene_name",
                     gene_symbol: str | None = None) -> str:
    """10x-style folder: matrix.mtx (genes x cells, 1-based), barcodes.tsv, features.tsv, each a folder of ordered part files."""
    spark = m.expr.sparkSession
    g = _positions(m.genes, "gene_id", "row").withColumn("row", F.col("row") + 1)
    c = _positions(m.cells, "cell_id", "col").withColumn("col", F.col("col") + 1)
    symbol = F.col(gene_symbol or gene_name).cast("string")

    def written(rows: DataFrame, order: str, name: str) -> None:
        rows.repartitionByRange(order).sortWithinPartitions(order).select("value").write.mode("overwrite").text(f"{folder}/{name}")

    written(m.genes.join(g, "gene_id").select(
        "row", F.concat_ws("\t", F.col(gene_name).cast("string"), symbol, F.lit("Gene Expression")).alias("value")), "row", "features.tsv")
    written(m.cells.join(c, "cell_id").select("col", F.col(cell_name).cast("string").alias("value")), "col", "barcodes.tsv")
    e = cut_lineage(m.expr.join(g, "gene_id").join(c, "cell_id").select("row", "col", "value"))
    head = ["%%MatrixMarket matrix coordinate real general", f"{m.genes.count()} {m.cells.count()} {e.count()}"]
    spark.range(1).select(F.lit("\n".join(head)).alias("value")).write.mode("overwrite").text(f"{folder}/matrix.mtx/header")
    # Coordinates may come in any order.
    e.select(F.concat_ws(" ", "row", "col", F.col("value").cast("string")).alias("value")).write.mode("overwrite").text(
        f"{folder}/matrix.mtx/rows")
    return folder


def read_counts_mtx(spark: SparkSession, folder: str, var_names: str = "gene_symbols", gex_only: bool = True,
                    make_unique: bool = True) -> CountMatrix:
    """S3: coordinate matrix (genes x cells on disk, 1-based) + barcodes + features.

    Comment lines (``%``) and the dimension line are skipped; features keep only
    "Gene Expression" rows when a type column exists; names are symbols (or ids) made
    unique.  A path to a file inside the folder is reduced to the folder.
    """
    from cellscape.operators.qc import unique_gene_names

    folder = folder.rstrip("/")
    if folder.endswith(".mtx") or folder.endswith(".mtx.gz"):
        folder = folder.rsplit("/", 1)[0]
    feats = _numbered_lines(spark, _first_existing(spark, f"{folder}/features.tsv", f"{folder}/features.tsv.gz")).select(
        (F.col("ln") + 1).alias("row"), F.split("line", "\t").alias("f"))
    feats = feats.select(
        "row", F.col("f")[0].alias("feature_id"),
        F.coalesce(F.get(F.col("f"), 1), F.col("f")[0]).alias("symbol"),
        F.get(F.col("f"), 2).alias("feature_type"),
    )
    if gex_only:
        feats = feats.where(F.col("feature_type").isNull() | (F.col("feature_type") == "Gene Expression"))
    name = "symbol" if var_names == "gene_symbols" else "feature_id"
    genes = feats.select(F.col("row").alias("gene_id"), F.col(name).alias("gene_name"), "feature_id")
    if make_unique:
        genes = unique_gene_names(genes).select("gene_id", F.col("gene_unique").alias("gene_name"), "feature_id")
    cells = _numbered_lines(spark, _first_existing(spark, f"{folder}/barcodes.tsv", f"{folder}/barcodes.tsv.gz")).select(
        (F.col("ln") + 1).alias("cell_id"), F.trim("line").alias("cell_name"))
    # Comment lines start with '%'; the first other line holds the dimensions.  Only that line is looked for by its place.
    lines = _scanned_lines(spark, _first_existing(spark, f"{folder}/matrix.mtx", f"{folder}/matrix.mtx.gz"))
    lines = lines.where(~F.col("line").startswith("%") & (F.trim("line") != ""))
    blocks = lines.groupBy("path", "start").agg(F.min("at").alias("at"))
    place = blocks.select(F.min(F.struct(_file_order(F.col("path")).alias("file"), "start", "at", "path"))).scalar()
    fields = F.split(F.trim("line"), r"\s+")
    expr = (
        lines.where((F.col("at") != place["at"]) | (F.col("start") != place["start"]) | (F.col("path") != place["path"]))
        .select(fields[1].cast("bigint").alias("cell_id"), fields[0].cast("bigint").alias("gene_id"), _number(fields[2]).alias("value"))
        .where(F.col("value") != 0)
        .join(genes.select("gene_id"), "gene_id", "left_semi")
    )
    return CountMatrix(cells=cells, genes=genes, expr=expr)


# --------------------------------------------------------------------------- choice of the reader

def _read_oriented_csv(spark: SparkSession, path: str) -> CountMatrix:
    return orient_matrix(read_counts_csv(spark, path))


def load_counts(spark: SparkSession, path: str | None, fmt: str = "auto", sf_dir: str | None = None) -> CountMatrix:
    """S4 + S6: the reader that ``fmt`` names, or the one that goes with the suffix; without a path the default dataset."""
    if path is None:
        return default_dataset(spark, sf_dir)
    names = [fmt] if fmt != "auto" else [name for suffix, name in SUFFIXES.items() if path.endswith(suffix)]
    if not names or names[0] not in READERS:
        raise ValueError(f"no matrix reader for {path!r} with format {fmt!r}: give a format out of {sorted(READERS)} "
                         f"or a path that ends in one of {sorted(SUFFIXES)}")
    return READERS[names[0]](spark, path)


# --------------------------------------------------------------------------- bundle (S5), default

def write_bundle(m: CountMatrix, path: str, extra: dict[str, DataFrame] | None = None) -> str:
    """One parquet folder per table.  ``expr`` is clustered by cell so that per-cell
    work after reading starts from contiguous rows."""
    m.cells.write.mode("overwrite").parquet(f"{path}/cells")
    m.genes.write.mode("overwrite").parquet(f"{path}/genes")
    m.expr.repartition("cell_id").sortWithinPartitions("cell_id", "gene_id").write.mode("overwrite").parquet(f"{path}/expr")
    for name, df in (extra or {}).items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")
    return path


def read_bundle(spark: SparkSession, path: str) -> CountMatrix:
    return CountMatrix(
        cells=spark.read.parquet(f"{path}/cells"),
        genes=spark.read.parquet(f"{path}/genes"),
        expr=spark.read.parquet(f"{path}/expr"),
    )


READERS = {"bundle": read_bundle, "csv": _read_oriented_csv, "mtx": read_counts_mtx}
SUFFIXES = {".bundle": "bundle", ".parquet": "bundle", ".csv": "csv", ".mtx": "mtx", ".mtx.gz": "mtx"}


def default_dataset(spark: SparkSession, sf_dir: str) -> CountMatrix:
    """The default matrix when no input is given: customers x part names."""
    from cellscape.sources.tables import customer_partname

    return customer_partname(spark, sf_dir)


# --------------------------------------------------------------------------- CSV sinks

def write_table_csv(df: DataFrame, path: str) -> str:
    """One CSV file with a header and no index column; written even when empty."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return path


def read_table_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)
