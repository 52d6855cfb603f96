"""Record tables in and out: JSON arrays, JSON lines, dataset folders, and single-file exports.

Records travel with `_source`, where they came from, and `_ord`, their place there, since
"first" and "last" mean places and not arrival. JSON arrays are read by Spark, so any store
works; tasks write the parts of single-file exports to the shared folder, and the driver joins
their bytes through Hadoop's file system. They are for results that one file may hold.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator

from py4j.java_gateway import JavaObject
from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.jsonx import nested_json
from ..plans.session import ensure_checkpoints

# The two files of a dataset folder, success first.
PARTS = (("success", "success_samples.json"), ("failed", "failed_samples.json"))

COMPARISON = "is_match boolean, match_score double, is_partial boolean, total_fields long, matched_fields long, mismatched_fields long, extra_fields long, missing_fields long, differences array<struct<field: string, type: string, ground_truth: string, predicted: string, gt_normalized: string, pred_normalized: string>>, error string, match_level string, matched_field_count long, total_field_count long"
RECORDS = (
    "sample_id string, status string, attempts int, original_sample string, cot_response string, full_api_response string, predicted_json string, ground_truth string, match_level string, error string, error_type string, "
    f"comparison_result struct<{COMPARISON}>, "
    "judge_result struct<overturned: boolean, pairs: array<struct<field: string, predicted: string, ground_truth: string>>, attempts: int, verdicts: string, content: string, error: string, failure: string>, "
    "polish_result struct<mode: string, applied: boolean, attempts: int, polished_cot: string, polished_answer: string, match_level: string, content: string, error: string, failure: string>"
)
#: Columns whose text is JSON; files hold the values themselves.
NESTED = ("original_sample", "full_api_response", "predicted_json", "ground_truth", "judge_result.verdicts", "polish_result.polished_answer")
SHAREGPT = "conversations array<struct<`from`: string, value: string>>, images array<string>"
#: Array files of so many bytes and more are cut up for many tasks, if they are laid out as exports are.
SPLIT_FROM = 16 << 20
#: What stands before each element of such a file, and nowhere else: JSON text has no raw line breaks.
_ELEMENT = "\n  {"
SAMPLES = "id string, messages array<struct<role: string, content: string>>, conversations array<struct<`from`: string, value: string>>, images array<string>"


def _at(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """A path's file system, and the path there."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _at(spark, path)
    return files.exists(place)


def is_folder(spark: SparkSession, path: str) -> bool:
    files, place = _at(spark, path)
    return files.exists(place) and files.getFileStatus(place).isDirectory()


def _scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the one that all executors share; it goes when the application ends."""
    ensure_checkpoints(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
    files, place = _at(spark, path)
    files.mkdirs(place)
    files.deleteOnExit(place)
    return path


def _drop(spark: SparkSession, path: str) -> None:
    files, place = _at(spark, path)
    files.delete(place, True)


def stored(rows: DataFrame) -> DataFrame:
    """The same rows, kept as Parquet until the application ends; each read takes the columns it needs."""
    path = f"{_scratch(rows.sparkSession, 'rows')}/table"
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], f"{schema}, _source string, _ord long")


def read_array(spark: SparkSession, path: str, schema: str, *, lines: bool | None = None) -> DataFrame:
    """Rows of a JSON array file, or of JSON lines; broken rows and files are left out.

    Nested objects of string columns stay raw JSON text. Lines are told by the suffix. Large
    array files are parsed at once and by many tasks, others by one task whenever they are read.
    """
    lines = path.endswith(".jsonl") if lines is None else lines
    if not lines and (rows := _in_pieces(spark, path, schema)) is not None:
        return rows
    fields = spark.createDataFrame([], schema).columns
    reader = spark.read.schema(f"{schema}, _bad string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad").option("multiLine", str(not lines).lower())
    rows = reader.json(path).select("*", F.lit(path).alias("_source"), F.monotonically_increasing_id().alias("_ord"))
    return rows.filter(F.col("_bad").isNull() & F.coalesce(*(F.col(f"`{f}`").cast("string") for f in fields)).isNotNull()).drop("_bad")


def _in_pieces(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """What read_array gives for an array file of two spaces a level, by as many tasks as it has splits.

    The file is cut before its elements, and the parsed rows are kept until the application ends.
    None if it is small, of another layout, or if any piece isn't one whole element that fits
    the schema, so that what is left out doesn't depend on the way of reading.
    """
    files, place = _at(spark, path)
    if not files.exists(place) or (status := files.getFileStatus(place)).isDirectory() or status.getLen() < SPLIT_FROM:
        return None
    start = f"[{_ELEMENT}".encode()
    stream = files.open(place)
    try:
        if bytes(stream.readNBytes(len(start))) != start:
            return None
    finally:
        stream.close()
    folder = _scratch(spark, "array")
    # the row of number 0 is the bracket; a comma follows each element, and a bracket the last
    cut = spark.read.option("lineSep", _ELEMENT).text(path).select(F.rtrim("value", F.lit(" \t\r\n")).alias("v"), F.monotonically_increasing_id().alias("i")).filter("i > 0")
    after = F.right("v", F.lit(1))
    end = F.when(after == ",", "0").when(after == "]", "1").otherwise("2")
    whole = F.concat(F.lit('{"_at":'), F.col("i").cast("string"), F.lit(',"_end":'), end, F.lit(',"_row":{'), F.expr("left(v, length(v) - 1)"), F.lit("}"))
    cut.select(whole.alias("value")).write.option("lineSep", "\x1e").option("compression", "none").text(f"{folder}/pieces")
    fields = spark.createDataFrame([], schema).columns
    reader = spark.read.schema(f"_at long, _end int, _row struct<{schema}>, _bad string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad").option("lineSep", "\x1e")
    some = F.coalesce(*(F.col(f"_row.`{f}`").cast("string") for f in fields)).isNotNull()
    parsed = reader.json(f"{folder}/pieces").select("_at", "_end", "_row", F.col("_bad").isNotNull().alias("_bad"), some.alias("_some"))
    parsed.write.parquet(f"{folder}/rows")
    _drop(spark, f"{folder}/pieces")
    rows = spark.read.schema(parsed.schema).parquet(f"{folder}/rows")
    part = F.shiftright("_at", 33)
    strange = F.count_if(F.col("_bad") | ~F.coalesce(F.col("_end").isin(0, 1), F.lit(False)))
    heads = rows.groupBy(part.alias("p")).agg(F.min("_at").alias("head"), F.count("*").alias("n"), strange.alias("strange"), F.count_if(F.col("_end") == 1).alias("ends"), F.max_by("_end", "_at").alias("last")).collect()
    heads.sort(key=lambda h: -1 if h["p"] is None else h["p"])  # one row a split
    if any(h["strange"] for h in heads) or sum(h["ends"] for h in heads) != 1 or heads[-1]["last"] != 1:
        _drop(spark, folder)
        return None
    places, before = [], 0
    for h in heads:
        places.append((h["p"], h["head"] - before))
        before += h["n"]
    shift = spark.createDataFrame(places, "p long, shift long")
    rows = rows.filter("_some").join(F.broadcast(shift), part == F.col("p"))
    return rows.select("_row.*", F.lit(path).alias("_source"), (F.col("_at") - F.col("shift")).alias("_ord"))


def read_required(spark: SparkSession, path: str, schema: str) -> DataFrame:
    if not exists(spark, path):
        raise FileNotFoundError(path)
    return read_array(spark, path, schema)


def read_optional(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return read_array(spark, path, schema) if exists(spark, path) else empty(spark, schema)


def read_dataset(spark: SparkSession, path: str, schema: str = RECORDS, only: str | None = None) -> DataFrame:
    """A dataset folder's success rows, then its failed ones; or a single file's rows.

    A missing part is empty, but a folder that holds neither is none. `only` reads one part; a
    file is read whatever it is.
    """
    if not is_folder(spark, path):
        return read_required(spark, path, schema)
    if not any(exists(spark, f"{path.rstrip('/')}/{file}") for _, file in PARTS):
        raise FileNotFoundError(f"{path} holds no {' and no '.join(file for _, file in PARTS)}")
    rows = empty(spark, schema)
    for number, (status, file) in enumerate(PARTS):
        if only in (None, status):
            part = read_optional(spark, f"{path.rstrip('/')}/{file}", schema)
            rows = rows.unionByName(part.withColumn("_source", F.lit(path)).withColumn("_ord", F.col("_ord") + F.lit(number << 60)))
    return rows


def read_samples(spark: SparkSession, path: str, n: int = 0, seed: int = 42) -> DataFrame:
    """Input samples; with 0 < n < all of them, the n whose seeded digests come first."""
    rows = read_required(spark, path, SAMPLES)
    rows = rows.withColumn("sample_id", F.coalesce("id", F.concat(F.lit("sample_"), F.col("_ord"))))
    return rows.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), "sample_id")), "_ord").limit(n) if n > 0 else rows


def head(rows: DataFrame, n: int) -> DataFrame:
    """The first n rows in input order."""
    return rows.orderBy("_ord").limit(n)


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """(path, url): files as data URLs; join them to samples on the left, unread ones are null."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", F.concat(F.lit("data:image/jpeg;base64,"), F.base64("content")).alias("url"))


def write_records(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A Parquet table in partitions by status, so that tools read what they need."""
    routed = F.when(F.col("status") == "success", "success").otherwise("failed")
    rows.withColumn("part", routed).write.mode(mode).partitionBy("part").parquet(path)


def processed_ids(spark: SparkSession, path: str) -> DataFrame:
    """Ids that a record table or a dataset folder holds already: the data is its own checkpoint."""
    if not exists(spark, path):
        return spark.createDataFrame([], "sample_id string")
    if any(exists(spark, f"{path.rstrip('/')}/{file}") for _, file in PARTS):
        return read_dataset(spark, path).select("sample_id").distinct()
    return spark.read.parquet(path).select("sample_id").distinct()


def _written(spark: SparkSession, path: str, fill: Callable[[JavaObject], None]) -> None:
    """Fills one file, which takes its name once it is whole."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    files, place = _at(spark, path)
    new = jvm.org.apache.hadoop.fs.Path(f"{path}.tmp")
    out = files.create(new, True)
    try:
        fill(out)
    except Py4JError:
        files.delete(new, False)
        raise
    finally:
        out.close()
    # one step, so there is a whole file at any time
    place, new = files.makeQualified(place), files.makeQualified(new)
    gateway = spark.sparkContext._gateway
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = gateway.new_array(kind, 1)
    how[0] = kind.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), conf).rename(new, place, how)


def _streamed(rows: DataFrame, path: str, pieces: Iterator[str]) -> None:
    """Writes text pieces to one file."""

    def fill(out: JavaObject) -> None:
        for piece in pieces:
            out.write(bytearray(piece.encode("utf-8", "surrogatepass")))

    _written(rows.sparkSession, path, fill)


def export_array(rows: DataFrame, path: str, order: list[str], *, as_lines: bool = False, json_column: str | None = None, nested: tuple[str, ...] = ()) -> None:
    """One file with all rows as a JSON array or as JSON lines, whole or not there at all.

    Tasks write the ordered rows as text to the shared folder, and the driver copies the bytes of
    these parts; no row passes through Python there. Non-ASCII text is kept as it is. Columns
    `nested` hold JSON text, whose values are written.
    """
    spark = rows.sparkSession
    text = F.col(json_column) if json_column else F.to_json(F.struct(*(c for c in rows.columns if c not in order or not c.startswith("_"))))
    text = F.coalesce(nested_json(nested)(text) if nested else text, F.lit("null"))
    between = "\n" if as_lines else ",\n"
    shown = text if as_lines else F.concat(F.lit("  "), F.replace(text, F.lit("\n"), F.lit("\n  ")))
    folder = _scratch(spark, "export")

    def fill(out: JavaObject) -> None:
        files, place = _at(spark, f"{folder}/parts")
        found = [(p.getPath().getName(), p.getLen(), p.getPath()) for p in files.listStatus(place)]
        parts = sorted((int(name.split("-")[1]), size, part) for name, size, part in found if name.startswith("part-") and size)
        if not as_lines:
            out.write(bytearray(b"[\n" if parts else b"["))
        for number, (_, size, part) in enumerate(parts, 1):
            stream = files.open(part)
            try:
                trailing = 0 if as_lines or number < len(parts) else len(between)
                spark.sparkContext._jvm.org.apache.commons.io.IOUtils.copyLarge(stream, out, 0, size - trailing)
            finally:
                stream.close()
        if not as_lines:
            out.write(bytearray(b"\n]\n" if parts else b"]\n"))

    try:
        ordered = rows.orderBy(*order).select(shown.alias("value"))
        ordered.write.option("lineSep", between).option("compression", "none").option("maxRecordsPerFile", 0).text(f"{folder}/parts")
        _written(spark, path, fill)
    finally:
        _drop(spark, folder)


def write_dataset(rows: DataFrame, path: str, order: list[str]) -> None:
    """Both parts of a dataset folder, as JSON arrays; anything but a success is failed."""
    good = F.coalesce(F.col("status") == "success", F.lit(False))
    for (_, file), part in zip(PARTS, (good, ~good), strict=True):
        export_array(rows.filter(part), f"{path.rstrip('/')}/{file}", order, nested=NESTED)


def export_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, whole or not there at all."""
    _streamed(spark.range(0), path, iter([text]))


def export_summary(row: DataFrame, path: str) -> None:
    """A one-row summary as a JSON file."""
    value = row.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).first()[0]
    _streamed(row, path, iter([json.dumps(json.loads(value), ensure_ascii=False, indent=2), "\n"]))


def append_events(events: DataFrame, path: str, fresh: bool = False) -> None:
    """Adds events as JSON lines; a fresh run replaces the log, a resumed one goes on with it."""
    events.write.mode("overwrite" if fresh else "append").text(path)
