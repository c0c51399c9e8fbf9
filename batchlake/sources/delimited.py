"""Delimited text files whose columns are found by header name.

Spark maps columns of a folder by position, but files here differ in their extra columns and in
column order. So a first pass profiles every file (header, widest row, quoted line breaks), files
are grouped by header, and each group is read by the native reader with its own column list.

Files with line breaks inside cells are split as well. What a line does to the quoting is a function of
the state it begins in (outside or inside a quoted cell); such functions compose. Each block of a
file composes its lines on its own, the blocks of a file are composed in a second, small step, and
then every line knows its state and the line its record begins with. Only the lines of
records that run over several lines are put together.
"""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from batchlake.functions import dates, text
from batchlake.operators.validate import missing_columns
from batchlake.schemas import CLEAN, RAW, REQUIRED
from batchlake.session import entries, materialize
from batchlake.sources.listing import decoded_path, key_below, list_objects

FAILED = "raw_key string, reason string"

#: Characters of a record over several lines. A longer one is a quote that was never closed.
MAX_RECORD = 16 << 20

#: Quoting: in a cell without quotes, inside quotes, after a quote that closes a cell unless a second one
#: follows, and at the begin of a cell.
_PLAIN, _INSIDE, _CLOSED, _FRESH = 0, 1, 2, 3


def _after_piece(state: Column, piece: Column) -> Column:
    """The state after a stretch of a line without quotes."""
    moved = F.when(F.endswith(piece, F.lit(",")), _FRESH).otherwise(_PLAIN)
    return F.when((state == _INSIDE) | (piece == ""), state).otherwise(moved)


def _after_quote(state: Column) -> Column:
    return F.when(state == _INSIDE, _CLOSED).when(state == _PLAIN, _PLAIN).otherwise(_INSIDE)


def line_effect(value: Column) -> Column:
    """What a line does, as a struct: ``end0`` and ``end1``, whether it ends inside a quoted cell if it begins
    outside or inside one, and ``commas0`` and ``commas1``, its separators in either case.

    A quote opens a cell only where the cell begins; elsewhere it is an ordinary character.
    """
    commas = lambda c: F.length(c) - F.length(F.replace(c, F.lit(","), F.lit("")))

    def read(state: Column, count: Column, piece: Column) -> tuple[Column, Column]:
        return _after_piece(state, piece), count + F.when(state == _INSIDE, 0).otherwise(commas(piece))

    def both(a: Column, ca: Column, b: Column, cb: Column, piece: Column) -> Column:
        (a, ca), (b, cb) = read(a, ca, piece), read(b, cb, piece)
        return F.struct(a.alias("a"), ca.alias("ca"), b.alias("b"), cb.alias("cb"))

    def effect(end0: Column, end1: Column, commas0: Column, commas1: Column) -> Column:
        return F.struct(end0.alias("end0"), end1.alias("end1"), commas0.alias("commas0"), commas1.alias("commas1"))

    pieces, zero = F.split(value, '"'), F.lit(0)
    ends = F.aggregate(
        F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))),
        both(F.lit(_FRESH), zero, F.lit(_INSIDE), zero, F.element_at(pieces, 1)),
        lambda s, piece: both(_after_quote(s["a"]), s["ca"], _after_quote(s["b"]), s["cb"], piece),
        lambda s: effect((s["a"] == _INSIDE).cast("int"), (s["b"] == _INSIDE).cast("int"), s["ca"], s["cb"]),
    )
    plain = effect(zero, F.lit(1), commas(value), zero)
    return F.when(F.contains(value, F.lit('"')), ends).otherwise(plain)


def compose(frame: DataFrame, by: list[str], order: str) -> DataFrame:
    """``frame`` with the effects ``end0`` and ``end1`` of its rows composed along each group: ``before0`` and
    ``before1`` (the state a row begins in if the group begins outside or inside), ``after0`` and
    ``after1``.

    The state after a row depends on the last row that ends alike whatever it began in, and on the
    number of rows since then that change it: sums and lookups of a window, no recursion.
    """
    row = Window.partitionBy(*by).orderBy(order)
    upto = row.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    settles = F.col("end0") == F.col("end1")
    changed = frame.withColumn("_turns", F.sum((F.col("end0") > F.col("end1")).cast("int")).over(upto))
    last = lambda c: F.last(F.when(settles, c), ignorenulls=True).over(upto)
    since = changed.withColumns({"_settled": last(F.col("end0")), "_then": last(F.col("_turns"))})
    turned = lambda start: (start + F.col("_turns")) % 2
    settled = (F.col("_settled") + F.col("_turns") - F.col("_then")) % 2
    after = since.withColumns({f"after{s}": F.coalesce(settled, turned(F.lit(s))).cast("int") for s in (0, 1)})
    return after.withColumns(
        {f"before{s}": F.lag(f"after{s}", 1, s).over(row) for s in (0, 1)}
    ).drop("_turns", "_settled", "_then")


def _position() -> Column:
    """Position of a row in its file: start of its split (in KiB) above the row number in the task.

    Splits of one file differ in start; rows of one split share a task and keep their order.
    """
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return F.shiftleft(F.shiftright(F.col("_start"), 10), 33).bitwiseOR(row)


def _reader(spark: SparkSession, multi_line: bool):
    return (
        spark.read.option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("recursiveFileLookup", True)
    )


def _lines(spark: SparkSession, paths: list[str], name_filter: str, *more: Column) -> DataFrame:
    """Lines of files with their file, place and effect."""
    value = F.when(F.startswith("value", F.lit("\ufeff")), F.substring("value", 2, 2**31 - 1)).otherwise(F.col("value"))
    return (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", name_filter)
        .text(paths)
        .select(
            value.alias("value"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("_start"),
            *more,
        )
        .withColumn("_pos", _position())
    )


#: Bits of a header line's hash in a profile; its place stands above them.
_HASH_BITS = 60


def profile_files(spark: SparkSession, paths: list[str], name_filter: str = "*.csv") -> DataFrame:
    """Per file with any non-blank line: hash of the header line, most cells in a line, size, time, and
    whether some line ends inside a quoted cell.

    Every aggregate is a number, so rows are hashed, never sorted: the header is found as the least of
    place and hash in one number.
    """
    about = [F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_modification_time").alias("modified")]
    lines = _lines(spark, paths, name_filter, *about)
    lines = lines.where(F.trim("value") != "").withColumn("effect", line_effect(F.col("value")))
    hashed = F.xxhash64("value").bitwiseAND(F.lit((1 << _HASH_BITS) - 1)).cast("decimal(19,0)")
    placed = F.col("_pos").cast("decimal(19,0)") * F.lit(1 << _HASH_BITS).cast("decimal(19,0)") + hashed
    return (
        lines.groupBy("file")
        .agg(
            F.min(placed).alias("_first"),
            F.max(F.col("effect.commas0") + 1).alias("cells"),
            F.max(F.col("effect.end0") == 1).alias("multi_line"),
            F.max("size").alias("size"),
            F.max("modified").alias("modified"),
        )
        .withColumn("header_hash", (F.col("_first") % F.lit(1 << _HASH_BITS).cast("decimal(19,0)")).cast("bigint"))
        .drop("_first")
    )


def header_lines(spark: SparkSession, profile: DataFrame, name_filter: str = "*.csv") -> dict[int, str]:
    """The different header lines of profiled files by their hash: of each the smallest file is read again."""
    smallest = profile.groupBy("header_hash").agg(F.min(F.struct("size", "file"))["file"].alias("file"))
    paths = [r["file"] for r in smallest.select(decoded_path(F.col("file")).alias("file")).collect()]
    if not paths:
        return {}
    lines = _lines(spark, paths, name_filter).where(F.trim("value") != "")
    found = lines.groupBy("file").agg(F.min_by("value", "_pos").alias("header")).join(smallest, "file")
    return {r["header_hash"]: r["header"] for r in found.collect()}


def read_raw(
    spark: SparkSession,
    root: str,
    paths: list[str] | None = None,
    header: list[str] | None = None,
    name_filter: str = "*.csv",
) -> tuple[DataFrame, DataFrame]:
    """All rows of the files below ``root`` (or of ``paths``) and the files that cannot be read.

    Rows come as :data:`batchlake.schemas.RAW` plus ``raw_key``, missing-value tokens as NULL. A
    file fails as a whole when it is empty, lacks a required column or has a row longer than its
    header; a short row is padded with NULL. Passing ``header`` vouches that all files have
    exactly that header and saves the profiling pass.
    """
    where = paths or [root]
    if header is not None:
        return _read_group(spark, where, header, False, root, name_filter), _no_failures(spark)

    # One row per file; stored, so the text is read once however often the profile is used.
    profile = materialize(profile_files(spark, where, name_filter), "file-profile")
    # Headers, not files, come to the driver here: one row per distinct header line.
    lines = header_lines(spark, profile, name_filter)
    known = spark.createDataFrame(
        [(n, h, len(_split(h)), ", ".join(missing_columns(_split(h)))) for n, h in sorted(lines.items())],
        "header_hash bigint, header string, width int, missing string",
    )
    judged = profile.join(known, "header_hash").withColumn(
        "reason",
        F.when(
            F.col("missing") != "", F.concat(F.lit("missing required columns: "), F.col("missing"))
        ).when(
            ~F.col("multi_line") & (F.col("cells") > F.col("width")),
            F.lit("row longer than header"),
        ),
    )
    failed = judged.where("reason IS NOT NULL").select(
        key_below(decoded_path(F.col("file")), root).alias("raw_key"), "reason"
    )
    failed = failed.unionByName(_blank_files(spark, where, name_filter, root, profile))

    # File names only, as the readers' own file listings hold them too.
    good = judged.where("reason IS NULL").select(
        "header", "multi_line", decoded_path(F.col("file")).alias("file")
    )
    groups: dict[tuple[str, bool], list[str]] = {}
    for r in good.collect():
        groups.setdefault((r["header"], r["multi_line"]), []).append(r["file"])

    # Once a file, not once a row.
    ids = profile.select("file", *_batch(root, F.col("file"), F.col("modified"), F.col("size")))
    frames = []
    for (line, multi_line), names in sorted(groups.items()):
        names, cols = sorted(names), _split(line)
        if multi_line:
            rows, long = _read_multi_line(spark, names, cols, root, name_filter)
            failed = failed.unionByName(long)
        else:
            rows = _read_group(spark, names, cols, False, root, name_filter, ids)
        frames.append(rows)
    empty = spark.createDataFrame([], T.StructType([*RAW.fields, T.StructField("raw_key", T.StringType())]))
    return (reduce(DataFrame.unionByName, frames) if frames else empty), failed


def _split(line: str) -> list[str]:
    return next(csv.reader([line]))


def _wanted(cols: list[str], cell) -> list[Column]:
    return [text.null_tokens(cell(f"c{cols.index(c)}")).alias(c) for c in REQUIRED]


def _batch(root: str, file: Column, modified: Column, size: Column) -> list[Column]:
    key = key_below(decoded_path(file), root)
    return [dates.file_batch_id(key, F.unix_millis(modified), size).alias("batch_id"), key.alias("raw_key")]


def _batch_here(root: str) -> list[Column]:
    """The same for the rows of a scan."""
    about = ("file_path", "file_modification_time", "file_size")
    return _batch(root, *[F.col(f"_metadata.{c}") for c in about])


def _read_group(spark, paths, cols, multi_line, root, name_filter, ids: DataFrame | None = None) -> DataFrame:
    """Rows of files with one header; ``ids`` (file, batch_id, raw_key) has a row per file, of which the driver holds
    the names anyway."""
    schema = ", ".join(f"c{i} string" for i in range(len(cols)))
    reader = _reader(spark, multi_line).option("header", True).option("enforceSchema", True)
    rows = reader.option("pathGlobFilter", name_filter).schema(schema).csv(paths)
    start = F.col("_metadata.file_block_start").alias("_start")
    whose = _batch_here(root) if ids is None else [F.col("_metadata.file_path").alias("file")]
    placed = rows.select(start, *whose, *_wanted(cols, F.col)).withColumn("ord", _position())
    if ids is not None:
        placed = placed.join(F.broadcast(ids), "file")
    return placed.select(*RAW.names, "raw_key")


def records(spark: SparkSession, paths: list[str], root: str, name_filter: str = "*.csv") -> tuple[DataFrame, DataFrame]:
    """Records of files with line breaks inside cells: ``batch_id``, ``raw_key``, ``ord``, ``record``
    (line breaks as \\n) and ``cells``, the first one a file's header; and the files that hold an endless one.
    """
    lines = _lines(spark, paths, name_filter, *_batch_here(root))
    lines = lines.select("*", line_effect(F.col("value")).alias("_effect")).select("*", "_effect.*").drop("_effect")
    block = Window.partitionBy("file", "_start").orderBy("_pos")
    upto = block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    begun = lambda s: F.max(F.when(F.col(f"before{s}") == 0, F.col("_pos"))).over(upto)
    marked = compose(lines, ["file", "_start"], "_pos").withColumns(
        {"_row": F.row_number().over(block), "begin0": begun(0), "begin1": begun(1)}
    )
    marked = materialize(marked.drop("end0", "end1"), "marked-lines")

    # One row per block.
    ends = marked.groupBy("file", "_start").agg(
        F.max(F.col("_row").cast("bigint") * 4 + F.col("after0") * 2 + F.col("after1")).alias("_last"),
        *[F.max(f"begin{s}").alias(f"_begin{s}") for s in (0, 1)],
    )
    ends = ends.withColumns({"end0": F.col("_last").bitwiseAND(F.lit(2)) / 2, "end1": F.col("_last").bitwiseAND(F.lit(1))})
    ends = ends.withColumns({c: F.col(c).cast("int") for c in ("end0", "end1")})
    state = F.col("before0").alias("_state")
    opened = F.when(F.col("before0") == 0, F.col("_begin0")).otherwise(F.col("_begin1")).alias("_opened")
    blocks = compose(ends, ["file"], "_start").select("file", "_start", state, opened)
    earlier = Window.partitionBy("file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    blocks = materialize(
        blocks.withColumn("_carried", F.last("_opened", ignorenulls=True).over(earlier)).drop("_opened"), "line-blocks"
    )

    def chosen(name: str) -> Column:
        return F.when(F.col("_state") == 0, F.col(f"{name}0")).otherwise(F.col(f"{name}1"))

    before, commas = chosen("before"), F.when(chosen("before") == 0, F.col("commas0")).otherwise(F.col("commas1"))
    placed = marked.join(blocks, ["file", "_start"]).select(
        "batch_id",
        "raw_key",
        "_pos",
        F.coalesce(chosen("begin"), F.col("_carried")).alias("ord"),
        ((before == 0) & (chosen("after") == 0)).alias("_whole"),
        commas.alias("_commas"),
        "value",
    )
    whole = placed.where("_whole").select("batch_id", "raw_key", "ord", F.col("value").alias("record"), (F.col("_commas") + 1).alias("cells"))
    parts = placed.where("NOT _whole")
    endless = (
        parts.groupBy("raw_key", "ord")
        .agg(F.sum(F.length("value") + 1).alias("_chars"))
        .where(F.col("_chars") > MAX_RECORD)
        .select("raw_key")
        .distinct()
        .withColumn("reason", F.lit("quote that is not closed"))
    )
    endless = materialize(endless, "endless-records")
    joined = F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct("_pos", "value"))), lambda p: p["value"]), "\n"
    )
    several = (
        parts.join(endless, "raw_key", "left_anti")
        .groupBy("batch_id", "raw_key", "ord")
        .agg(joined.alias("record"), (F.sum("_commas") + 1).cast("int").alias("cells"))
    )
    whole = whole.join(endless, "raw_key", "left_anti").where(F.trim("record") != "")
    return whole.unionByName(several), endless


def _read_multi_line(spark, paths, cols, root, name_filter) -> tuple[DataFrame, DataFrame]:
    """Files with line breaks inside cells, and those of them that fail."""
    found, endless = records(spark, paths, root, name_filter)
    found = materialize(found, "multi-line-records")
    files = found.groupBy("raw_key").agg(F.min("ord").alias("_header"), F.max("cells").alias("_cells"))
    long = files.where(F.col("_cells") > len(cols)).select("raw_key", F.lit("row longer than header").alias("reason"))
    schema = ", ".join(f"c{i} string" for i in range(len(cols)))
    row = F.from_csv("record", schema, {"quote": '"', "escape": '"', "multiLine": "true"})
    good = files.where(F.col("_cells") <= len(cols)).select("raw_key", "_header")
    rows = found.join(good, "raw_key").where(F.col("ord") > F.col("_header")).withColumn("_row", row)
    wanted = rows.select("batch_id", "raw_key", "ord", *_wanted(cols, lambda c: F.col(f"_row.{c}")))
    return wanted.select(*RAW.names, "raw_key"), long.unionByName(endless)


def empty_files(spark: SparkSession, paths: list[str], name_filter: str, root: str) -> DataFrame:
    """Files without a byte. No scan returns them, so the names come from the file listing itself,
    which the driver holds for every scan."""
    scan = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", name_filter)
        .text(paths)
    )
    names = spark.createDataFrame([(f,) for f in scan.inputFiles()], "file string")
    key = key_below(decoded_path(F.col("file")), root).alias("raw_key")
    filled = list_objects(spark, root, "", name_filter, paths).select(F.col("key").alias("raw_key"))
    return names.select(key).join(filled, "raw_key", "left_anti").withColumn("reason", F.lit("empty file"))


def _blank_files(spark, paths, name_filter, root, profile) -> DataFrame:
    """Files without a single line that is not blank."""
    key = key_below(decoded_path(F.col("file")), root).alias("raw_key")
    listed = list_objects(spark, root, "", name_filter, paths).select(F.col("key").alias("raw_key"))
    blank = listed.join(profile.select(key), "raw_key", "left_anti").withColumn("reason", F.lit("empty file"))
    return blank.unionByName(empty_files(spark, paths, name_filter, root))


def _no_failures(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], FAILED)


def read_clean(spark: SparkSession, root: str, batches: list[str] | None = None) -> DataFrame:
    """Clean files (fixed header) as text columns, with the folder's ``batch_id``; all of them or
    only the named batches.

    Cells may hold line breaks, so a file is one task; the writer keeps files small. ``ord`` is a
    row's place in its batch: the number of the file, as the writer gave it, above the row's place
    in the file.
    """
    name = F.col("_metadata.file_name")
    part = F.coalesce(F.regexp_extract(name, r"^part-(\d+)", 1).try_cast("bigint"), F.lit(0))
    piece = F.coalesce(F.regexp_extract(name, r"[.-]c(\d+)\.", 1).try_cast("bigint"), F.lit(0))
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    schema = T.StructType([*CLEAN.fields, T.StructField("batch_id", T.StringType())])
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", True)
        .option("basePath", root)
        .csv([f"{root}/batch_id={b}" for b in batches] if batches else root)
        .select("*", part.alias("_part"), piece.alias("_piece"))
        .withColumn(
            "ord",
            F.shiftleft("_part", 43).bitwiseOR(F.shiftleft("_piece", 33)).bitwiseOR(row),
        )
        .drop("_part", "_piece")
    )


#: Folders of a root that hold no data files of their own.
NO_DATA = ("metadata", "checkpoints")


def infer_columns(spark: SparkSession, root: str, sample: float = 1.0) -> DataFrame:
    """(column_name, data_type) as found in the files below ``root``, but for those in its folders of
    documents and ledgers (``NO_DATA``) and hidden ones."""
    names = [n for n in entries(spark, root) if n[0] not in "_."]
    data = [f"{root.rstrip('/')}/{n}" for n in names if n not in NO_DATA]
    found = (
        spark.read.option("header", True)
        .option("inferSchema", True)
        .option("samplingRatio", sample)
        .option("basePath", root)
        .csv(data if len(data) < len(names) else root)
        .schema
    )
    return spark.createDataFrame(
        [(f.name, f.dataType.simpleString()) for f in found], "column_name string, data_type string"
    )
