"""Landed CSV and JSON sources brought into the unified record.

Fetching is not Spark's work: files or response bodies are landed first, and these
readers apply the row caps, stop rules, allow-lists and normalisation.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.functions.keys import first_rows
from corpusmill.functions.ranks import RANGE_ROWS, ranked
from corpusmill.functions.text import blank_to_null
from corpusmill.schema import UNIFIED_COLUMNS, UNIFIED_SCHEMA

# CSV cells that mean "missing" to a reader with default settings.
CSV_MISSING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
               "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")

# Names a split specification may use.
SPLIT_NAMES = ("train", "test", "validation", "unsupervised")

FILE_ORDER = ("file_no", "_file", "_block", "row_no")     # of rows in listed files

ENVELOPE_BATCH = 100
STRICT = {"mode": "FAILFAST"}
ALLOW_LOOKAHEAD = 8


def lines_are_records(spark: SparkSession, path) -> bool:
    """Whether no record of these CSV files goes over a line end, so that files can be read in splits.

    Quotes come in pairs within a record. If every line has an even number of them, every line
    ends outside of quotes. Lines of nothing but blanks are left to the reader of whole files.
    """
    line = F.col("value")
    open_quote = (F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))) % 2 == 1
    blank = (F.length(line) > 0) & ~line.rlike(r"[^\x00-\x20]")
    return spark.read.text(path).where(open_quote | blank).isEmpty()


def _scan_csv(spark: SparkSession, path, options: dict) -> DataFrame:
    opts = {"header": True, "escape": '"', "inferSchema": False, **options}
    if "multiLine" not in opts:
        plain = not {"quote", "escape", "encoding", "charset", "lineSep", "comment"} & set(options)
        opts["multiLine"] = not (plain and lines_are_records(spark, path))
    return spark.read.options(**opts).csv(path)


def _cells(columns, missing) -> list[Column]:
    if not missing:
        return [F.col(f"`{c}`") for c in columns]
    return [F.when(~F.col(f"`{c}`").isin(*missing), F.col(f"`{c}`")).alias(c) for c in columns]


def read_csv(spark: SparkSession, path, missing=CSV_MISSING, **options) -> DataFrame:
    """Header CSV as strings, with quoted newlines; cells in ``missing`` become null.

    Columns stay strings so a label ``1`` never turns into ``1.0``. Where a first pass over the lines finds no
    record of several lines, a large file is read by many tasks; ``multiLine`` decides it without that pass.
    """
    df = _scan_csv(spark, path, options)
    return df.select(_cells(df.columns, missing))


def read_csv_in_order(spark: SparkSession, paths, missing=CSV_MISSING, **options) -> DataFrame:
    """Listed CSV files or folders, with the columns of ``FILE_ORDER`` for caps that follow file order.

    A folder's files follow their names, their rows the place in the file, however Spark packs files into tasks.
    """
    parts = []
    for i, p in enumerate(paths):
        df = _scan_csv(spark, p, options)
        parts.append(df.select(
            F.lit(i).alias("file_no"), F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("row_no"),
            *_cells(df.columns, missing)))
    return merge(parts, columns=None)


def spread(scan: DataFrame, key: str) -> DataFrame:
    """A scan with fewer partitions than cores, spread by key; any other as it is.

    A few big unsplittable files would leave most cores idle in per-row text work. With
    as many splits as cores or more, which is the normal case, no shuffle is added.
    ``scan`` must be a plain read: asking it for its partitions then starts no job.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores, key)


def first_csv_below(spark: SparkSession, folder: str, max_rows: int | None = None, **options) -> DataFrame:
    """The CSV file with the smallest path anywhere under ``folder``, capped."""
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
                   .option("pathGlobFilter", "*.csv").load(folder).select("path"))
    first = listed.agg(F.min("path")).head()[0]
    if first is None:
        raise FileNotFoundError(f"no CSV file below {folder}")
    return capped_concat(read_csv_in_order(spark, [first], **options), max_rows).drop(*FILE_ORDER)


def capped_concat(df: DataFrame, max_rows: int | None, order=FILE_ORDER) -> DataFrame:
    """One cap over many files taken in order: later files fill what earlier ones leave.

    ``order`` names the columns that rows follow; those that ``df`` doesn't have are left out.
    """
    return first_rows(df, max_rows, [c for c in order if c in df.columns])


def allow_listed(df: DataFrame, label: str, allowed, max_rows: int | None, order) -> DataFrame:
    """First ``max_rows`` rows with an allowed label among the first 8 * ``max_rows``, if given."""
    seen = df if max_rows is None else first_rows(df, ALLOW_LOOKAHEAD * max_rows, order)
    kept = seen.where(F.col(label).cast("string").isin([str(a) for a in allowed]))
    return first_rows(kept, max_rows, order)


def parse_split(spec: str) -> tuple[str, int | None]:
    """``train[:500]`` -> (``train``, 500); without a bracket the cap is None."""
    m = re.fullmatch(rf"({'|'.join(SPLIT_NAMES)})(?:\[:(\d+)\])?", spec.replace(" ", ""))
    if m is None:
        raise ValueError(f"unsupported split {spec!r}; expected for example train[:N]")
    return m[1], int(m[2]) if m[2] else None


def take_split(df: DataFrame, spec: str, order, split: str = "split") -> DataFrame:
    name, cap = parse_split(spec)
    rows = df.where(F.col(split) == name)
    return rows if cap is None else first_rows(rows, cap, order)


def json_records(payload: Column, record: T.StructType, path: str | None = None) -> Column:
    """Array of records in a JSON body: a list as it is, one object as a list of one.

    ``path`` is dotted. Any other root, a missing body and malformed JSON are errors.
    """
    body = F.get_json_object(payload, "$." + path) if path else F.ltrim(payload)
    return (F.when(body.startswith("["), F.from_json(body, T.ArrayType(record), STRICT))
             .when(body.startswith("{"), F.array(F.from_json(body, record, STRICT)))
             .otherwise(F.raise_error(F.lit("JSON root must be a list or an object"))))


def paged_records(pages: DataFrame, record: T.StructType, max_rows: int | None = None,
                  page_size: int | None = None, path: str | None = None) -> DataFrame:
    """Records of landed ``(page, payload)`` rows, as a pager would have read them.

    Reading stops at an empty page, after a page shorter than ``page_size``, or at the
    cap, if there is one. Returns ``page``, ``pos`` and the record fields.
    """
    parsed = pages.select("page", json_records(F.col("payload"), record, path).alias("records"))
    short = F.size("records") < (page_size or 1)
    stop = parsed.agg(F.min(F.when(short, F.col("page"))).alias("_stop"))
    read = parsed.crossJoin(F.broadcast(stop)).where(
        F.col("_stop").isNull() | (F.col("page") <= F.col("_stop")))
    rows = read.select("page", F.posexplode("records").alias("pos", "record"))
    return first_rows(rows.select("page", "pos", "record.*"), max_rows, ["page", "pos"])


def envelope_rows(batches: DataFrame, record: T.StructType, max_rows: int | None = None) -> DataFrame:
    """Rows of landed ``(offset, payload)`` batches ``{"rows": [{"row": {...}}]}``.

    The ``row`` key is unwrapped where present. A batch that is empty or shorter than
    asked for ends the scan; a malformed or missing body is an error. Returns ``offset``, ``pos`` and the record fields.
    """
    item = T.StructType([T.StructField("row", record), *record.fields])
    body = T.StructType([T.StructField("rows", T.ArrayType(item))])
    payload = F.coalesce("payload", F.raise_error(F.lit("a batch has no body")).cast("string"))
    parsed = batches.select("offset", F.from_json(payload, body, STRICT)["rows"].alias("rows"))
    asked = F.lit(ENVELOPE_BATCH)
    if max_rows is not None:
        asked = F.least(asked, F.lit(max_rows) - F.col("offset"))
    n = F.coalesce(F.size("rows"), F.lit(0))
    stop = parsed.agg(F.min(F.when(n < asked, F.col("offset"))).alias("_stop"))
    read = parsed.crossJoin(F.broadcast(stop)).where(
        F.col("_stop").isNull() | (F.col("offset") <= F.col("_stop")))
    bare = F.struct(*[F.col(f"item.{f.name}").alias(f.name) for f in record.fields])
    rows = (read.select("offset", F.posexplode("rows").alias("pos", "item"))
                .select("offset", "pos", F.coalesce(F.col("item.row"), bare).alias("record")))
    return first_rows(rows.select("offset", "pos", "record.*"), max_rows, ["offset", "pos"])


def map_label(label: Column, label_map: dict | None) -> Column:
    """Mapped label; values outside the map pass through."""
    if not label_map:
        return label
    pairs = [F.lit(str(x)) for kv in label_map.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), label), label)


def normalise(df: DataFrame, source: str, collected_at: str, text="text", label="label",
              label_map: dict | None = None, keep=()) -> DataFrame:
    """Any frame -> the unified record (plus the columns in ``keep``).

    Text is trimmed and blank text is missing. A frame without the label column gets
    ``unknown``; a null label stays null.
    """
    none = F.lit(None).cast("string")
    body = blank_to_null(F.col(text).cast("string")) if text in df.columns else none
    tag = F.col(label).cast("string") if label in df.columns else F.lit("unknown")
    return df.select(
        *keep, body.alias("text"), none.alias("audio"), none.alias("image"),
        map_label(tag, label_map).alias("label"), F.lit(source).alias("source"),
        F.lit(collected_at).alias("collected_at"))


def merge(frames, columns=UNIFIED_COLUMNS, spark: SparkSession | None = None) -> DataFrame:
    """Stack frames by column name, missing columns as null, then project ``columns``."""
    frames = list(frames)
    if not frames:
        return (spark or SparkSession.active()).createDataFrame([], UNIFIED_SCHEMA)
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    if columns is None:
        return out
    return out.select([
        F.col(c) if c in out.columns else F.lit(None).cast("string").alias(c) for c in columns])


def sequential_id(df: DataFrame, key: str, name: str = "id", size: int = RANGE_ROWS) -> DataFrame:
    """``item_0000``, ``item_0001``, ... in the order of any sortable key, nulls first.

    Rows that repeat a key follow a digest of the row. No task sorts more than ``size`` rows.
    """
    out = ranked(df, key, "_rank", size)
    return out.select(F.format_string("item_%04d", "_rank").alias(name), *[f"`{c}`" for c in df.columns])
