"""Readers: CSV in three regimes, JDBC, Parquet, and optional or alternative tables."""

from __future__ import annotations

import csv
import re
from collections.abc import Callable, Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.operators.columns import standardize, union_all
from skyledger.storage import staged


def read_text_csv(spark: SparkSession, path: str | list[str], pattern: str = "*.csv") -> DataFrame:
    """Headered CSV with every column as text. A byte-order mark is not part of the first name."""
    return spark.read.option("header", True).option("pathGlobFilter", pattern).csv(path)


def read_typed_csv(spark: SparkSession, path: str, ddl: str, keep_corrupt: bool = False,
                   multi_line: bool = False) -> DataFrame:
    """Headered, quoted CSV straight into a declared schema.

    A value that does not fit its type is null; ``keep_corrupt`` also keeps the line it came from. With ``multi_line``
    quoted fields may hold line breaks, and a file is one task.
    """
    schema = f"{ddl}, _corrupt_record string" if keep_corrupt else ddl
    return (
        spark.read.schema(schema).option("header", True).option("quote", '"').option("escape", '"')
        .option("enforceSchema", True).option("mode", "PERMISSIVE").option("multiLine", multi_line).csv(path)
    )


def _first_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first line of a file, out of the lines of one piece of it; nothing of later pieces. The rest is not read."""
    for batch in batches:
        if batch.num_rows:
            if batch["start"][0].as_py() == 0:
                yield batch.slice(0, 1).select(["path", "line"])
            return


def file_headers(spark: SparkSession, path: str | list[str], pattern: str = "*.csv") -> list[tuple[str, str]]:
    """Path and first line of each file. Files without a line are left out.

    One job for all files. Each piece of a file is a task of its own here, so that it can stop after the first lines.
    """
    settings = {"spark.sql.files.openCostInBytes": spark.conf.get("spark.sql.files.maxPartitionBytes"),
                "spark.sql.execution.arrow.maxRecordsPerBatch": "1"}
    before = {name: spark.conf.get(name, None) for name in settings}
    lines = spark.read.option("pathGlobFilter", pattern).text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("line"))
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        found = lines.mapInArrow(_first_lines, "path string, line string").collect()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    return [(unquote(r.path), r.line) for r in found]


def column_names(header: str) -> list[str]:
    """Names of a header line, without a byte-order mark. A name that repeats in any case gets its position added."""
    names = next(csv.reader([header.removeprefix("\ufeff").rstrip("\r")]), [])
    lower = [n.lower() for n in names]
    return [f"_c{i}" if not n else f"{n}{i}" if lower.count(n.lower()) > 1 else n for i, n in enumerate(names)]


def files_by_header(spark: SparkSession, path: str | list[str], pattern: str = "*.csv") -> dict[tuple[str, ...], list[str]]:
    """Paths of files by the names in their first line, in the order of headers."""
    groups: dict[tuple[str, ...], list[str]] = {}
    for place, line in file_headers(spark, path, pattern):
        name = re.sub(r"([\\{}\[\]*?])", r"\\\1", place)  # a name, not a pattern
        groups.setdefault(tuple(column_names(line)), []).append(name)
    return {names: sorted(paths) for names, paths in sorted(groups.items())}


def ddl(names: tuple[str, ...]) -> str:
    return ", ".join(f"`{n.replace('`', '``')}` string" for n in names)


def read_csv_by_header(spark: SparkSession, path: str | list[str], pattern: str = "*.csv") -> list[DataFrame]:
    """Headered CSV files as text, each by its own header: one frame for each different header, in the order of headers.

    Columns may be reordered, missing or additional from file to file; Spark alone would name the columns of all files by
    one of them. The first lines are probed in one job, then each different header is one scan, however many files have it.
    What the driver holds is a path and a header for each file, as its file listing does. Folder names are not columns.
    """
    return [spark.read.schema(ddl(names)).option("header", True).option("escape", '"').csv(paths)
            for names, paths in files_by_header(spark, path, pattern).items()]


#: Characters of text in one piece of a file that is split.
PIECE = 1 << 20
#: From inside a quoted field through its closing quote; doubled quotes belong to the field.
CLOSING = re.compile(r'[^"]*+(?:""[^"]*+)*+"')


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a line ends inside a quoted field, given whether it starts in one. A quote opens a field only as its first character."""
    at = 0
    while True:
        if inside or line.startswith('"', at):
            closed = CLOSING.match(line, at if inside else at + 1)
            if not closed:
                return True
            at, inside = closed.end(), False
        comma = line.find(",", at)
        if comma < 0:
            return False
        at = comma + 1


def outline(text: str) -> list[tuple[bool, int, int]]:
    """For a start outside and one inside quotes: whether the end is inside, where the first record begins that the text does
    not get from before, and where the record begins that it leaves open (-1: none)."""
    found = []
    for start in (False, True):
        inside, at, body, tail = start, 0, len(text) + 1 if start else 0, -1
        while (quote := text.find('"', at)) >= 0:
            begin = max(at, text.rfind("\n", at, quote) + 1)
            stop = text.find("\n", quote)
            stop = len(text) if stop < 0 else stop
            was, inside = inside, ends_inside(text[begin:stop], inside)
            if was and not inside:
                body, tail = min(body, stop + 1), -1
            elif inside and not was:
                tail = begin
            at = stop + 1
        found.append((inside, body, tail))
    return found


def _pieces(size: int):
    """Lines of byte ranges to pieces of about ``size`` characters, each with its outline."""
    schema = pa.schema([("path", pa.string()), ("start", pa.int64()), ("n", pa.int64()), ("text", pa.string()),
                        ("ends", pa.list_(pa.bool_())), ("bodies", pa.list_(pa.int32())), ("tails", pa.list_(pa.int32()))])

    def piece(key: tuple[str, int], n: int, lines: list[str]) -> pa.RecordBatch:
        text = "\n".join(lines)
        ends, bodies, tails = map(list, zip(*outline(text), strict=True))
        row = {"path": key[0], "start": key[1], "n": n, "text": text, "ends": ends, "bodies": bodies, "tails": tails}
        return pa.RecordBatch.from_pylist([row], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, n, lines, length = ("", -1), 0, [], 0
        for batch in batches:
            for path, start, line in zip(*(batch[c].to_pylist() for c in ("path", "start", "line")), strict=True):
                if (path, start) != key or length >= size:
                    if lines:
                        yield piece(key, n, lines)
                    n = n + 1 if (path, start) == key else 0
                    key, lines, length = (path, start), [], 0
                if not lines and start == n == 0:
                    line = line.removeprefix("\ufeff")
                lines.append(line)
                length += len(line) + 1
        if lines:
            yield piece(key, n, lines)
    return run


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of stretches that begin and end between records; without the first record where ``headed``."""
    for batch in batches:
        for text, headed in zip(batch["text"].to_pylist(), batch["headed"].to_pylist(), strict=True):
            found, held = [], []
            for line in text.split("\n"):
                if held or '"' in line:
                    held.append(line)
                    if ends_inside(line, len(held) > 1):
                        continue
                    line, held = "\n".join(held), []
                found.append(line)
            yield pa.RecordBatch.from_pydict({"record": pa.array(found[int(headed):], pa.string())})


def quoted_records(spark: SparkSession, paths: list[str], size: int = PIECE) -> DataFrame:
    """``record``: each record of CSV files but their first ones, as text; quoted fields may hold line breaks.

    Files are read in byte ranges, all in parallel. A range cannot know whether it starts inside quotes, so its pieces are outlined
    for both cases. A prefix scan over the outlines (a few numbers for each piece, in order within a file) gives the case
    and the open record at each piece's start. Then records are cut piece by piece; only the edges of pieces meet, one
    group for each record that crosses one. Pieces are written to the shared folder, so both passes see the same ones.
    """
    lines = spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("line"))
    pieces = staged(lines.mapInArrow(_pieces(size), "path string, start long, n long, text string, ends array<boolean>, "
                                     "bodies array<int>, tails array<int>"), "pieces")
    before = Window.partitionBy("path").orderBy("start", "n").rowsBetween(Window.unboundedPreceding, -1)
    so_far = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    # a piece keeps the case, turns it, or ends alike from both: the last of the latter and the turns since then decide
    outside, inside = F.col("ends")[0].cast("long"), F.col("ends")[1].cast("long")
    turned = pieces.select("path", "start", "n", "ends", "tails").withColumn("_turns", so_far((outside > inside).cast("long")))
    fixed = turned.withColumn("_fixed", F.last(F.when(outside == inside, F.struct(
        outside.alias("case"), F.col("_turns").alias("turns"))), ignorenulls=True).over(before))
    case = F.pmod(F.col("_turns") + F.coalesce(F.col("_fixed.case") - F.col("_fixed.turns"), F.lit(0)), F.lit(2)).cast("int")
    cases = staged(fixed.withColumn("case", case).withColumn("open", so_far((F.col("tails")[F.col("case")] >= 0).cast("long"))).select(
        "path", "start", "n", "case", "open"), "cases")
    placed = pieces.join(cases, ["path", "start", "n"]).withColumns({"_body": F.col("bodies")[F.col("case")], "_tail": F.col("tails")[F.col("case")]})
    stop = F.when(F.col("_tail") >= 0, F.col("_tail") - 1).otherwise(F.char_length("text"))
    bodies = placed.where(F.col("_body") <= stop).select(
        F.substring("text", F.col("_body") + 1, stop - F.col("_body")).alias("text"),
        ((F.col("start") == 0) & (F.col("n") == 0)).alias("headed"))
    head = F.when(F.col("case") == 1, F.struct(F.col("open"), F.substring("text", F.lit(1), F.col("_body") - 1).alias("part")))
    tail = F.when(F.col("_tail") >= 0, F.struct((F.col("open") + 1).alias("open"), F.substring(
        "text", F.col("_tail") + 1, F.char_length("text")).alias("part")))
    edges = placed.where((F.col("case") == 1) | (F.col("_tail") >= 0)).select(
        "path", "start", "n", F.explode(F.array_compact(F.array(head, tail))).alias("e"))
    crossing = edges.groupBy("path", "e.open").agg(F.array_sort(F.collect_list(F.struct("start", "n", "e.part"))).alias("parts"))
    return bodies.mapInArrow(_records, "record string").unionByName(
        crossing.select(F.array_join(F.transform("parts", lambda x: x["part"]), "\n").alias("record")))


def read_multiline_csv(spark: SparkSession, path: str | list[str], size: int = PIECE) -> DataFrame:
    """Text CSV whose quoted fields may hold line breaks and doubled quotes; large files are read by many tasks.

    Each file is read by its own header, which is one line; a byte-order mark is not part of it. Columns that a file lacks are null.
    Empty lines are skipped. A break inside a field is read as one line feed, whether it was written with a carriage return or not.
    """
    groups = files_by_header(spark, path, "*")
    if not groups:
        return spark.read.option("header", True).csv(path)
    return union_all([
        quoted_records(spark, paths, size)
        .select(F.regexp_replace(F.regexp_replace("record", r"\r$", ""), "\r\n", "\n").alias("record")).where("record != ''")
        .select(F.from_csv("record", ddl(names), {"escape": '"', "multiLine": "true"}).alias("row")).select("row.*")
        for names, paths in groups.items()])


def read_weather_csvs(spark: SparkSession, families: list[tuple[str, str]]) -> DataFrame:
    """One table out of several CSV families, each ``(path, file pattern)``; every file is read by its own header.

    Families come in their order, and of a family one scan per different header. No file at all is an error.
    """
    frames = [standardize(frame) for path, pattern in families for frame in read_csv_by_header(spark, path, pattern)]
    if not frames:
        raise FileNotFoundError(f"no CSV file with a header in {families}")
    return union_all(frames)


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict[str, str],
              column: str, lower: str, upper: str, partitions: int) -> DataFrame:
    """A database table in ``partitions`` parallel ranges of ``column``.

    The bounds only shape the ranges; rows outside of them are read too.
    """
    return spark.read.jdbc(
        url=url, table=table, column=column, lowerBound=lower, upperBound=upper,
        numPartitions=partitions, properties=properties,
    )


#: Conditions that mean a source is not there: no such path, no such table, a folder without data files.
ABSENT = {"PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}


def try_read(load: Callable[[], DataFrame]) -> DataFrame | None:
    """The frame, or none where its source is absent. Looks at the schema only.

    Any other failure, such as a denied read or a corrupt file, is raised: it says nothing about absence.
    """
    try:
        frame = load()
        frame.schema
        return frame
    except AnalysisException as error:
        if error.getCondition() in ABSENT:
            return None
        raise


def read_available(loaders: list[Callable[[], DataFrame]],
                   fallback: Callable[[], DataFrame] | None = None) -> DataFrame:
    """Union of all readable sources; the fallback where none is; an error without a fallback."""
    frames = [frame for frame in map(try_read, loaders) if frame is not None]
    if frames:
        return union_all([standardize(frame) for frame in frames])
    if fallback is None:
        raise RuntimeError("none of the sources could be read")
    return fallback()


def read_optional(spark: SparkSession, load: Callable[[], DataFrame], ddl: str) -> DataFrame:
    """The source, or an empty frame of its schema where it is missing."""
    frame = try_read(load)
    return spark.createDataFrame([], ddl) if frame is None else frame


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    frame = spark.read.parquet(path)
    return frame.select(*columns) if columns else frame
