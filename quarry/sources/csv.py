"""Puzzle / prediction CSV sources and sinks, JSON and text sinks.

CSV is read without a schema (a schema binds columns by position, not by
header name) and never inferred, so values like ``0110110`` or ``154.60``
stay text. Multi-line quoted fields need ``multiLine``, which makes each file
one split: ingest many files, then write Parquet once and work from that.
Sinks write a directory of part files in parallel (no funnel into one task).
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Records end at a line feed, so that line ends inside quoted fields stay as written.
READ_OPTS = {"header": "true", "inferSchema": "false", "multiLine": "true", "escape": '"', "encoding": "UTF-8", "lineSep": "\n"}
WRITE_OPTS = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "encoding": "UTF-8",
}


def read_csv(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """All-STRING CSV scan (SRC2).

    Where records end in CR LF, the CR is left on the last header name and on
    unquoted values of the last column; one is taken off each."""
    df = spark.read.options(**READ_OPTS).csv(paths if isinstance(paths, str) else list(paths))
    last = df.columns[-1] if df.columns else ""
    if not last.endswith("\r"):
        return df
    c = df[last]
    clean = F.nullif(F.when(c.endswith("\r"), F.left(c, F.length(c) - 1)).otherwise(c), F.lit(""))
    return df.select(*[df[x] for x in df.columns[:-1]], clean.alias(last[:-1]))


def read_puzzles(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """SRC1: columns by header name; ``id`` and ``prompt`` required; a missing or
    empty ``answer`` is null (whitespace-only stays)."""
    raw = read_csv(spark, paths)
    missing = [c for c in ("id", "prompt") if c not in raw.columns]
    if missing:
        raise KeyError(f"CSV is missing required column(s): {missing}")
    answer = F.nullif(F.col("answer"), F.lit("")) if "answer" in raw.columns else F.lit(None).cast("string")
    extra = [c for c in raw.columns if c not in ("id", "prompt", "answer")]
    return raw.select(
        F.coalesce(F.col("id"), F.lit("")).alias("id"), F.coalesce(F.col("prompt"), F.lit("")).alias("prompt"), answer.alias("answer"), *extra
    )


def _hadoop_fs(spark: SparkSession, pattern: str):
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    return jvm, path.getFileSystem(conf), path


def _plain(path: str) -> str:
    """A path in one spelling: no escapes, one slash after the scheme of a local file."""
    return re.sub(r"^file:/+", "file:/", unquote(path))


def _first_lines(spark: SparkSession, pattern: str) -> DataFrame:
    """(f, h0, h1, h2): what stands for the first line of every matching file, two hashes
    and the length, read by the tasks through Spark's text reader, which also opens
    compressed files.

    Numbers alone are aggregated: with a text as the aggregate's value Spark would sort
    every line of every file by its path."""
    lines = spark.read.text(pattern).select(F.ltrim("value", F.lit("\ufeff")).alias("v"), F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("i"))
    parts = [F.xxhash64("v"), F.hash("v"), F.length("v")]
    return lines.where("b = 0").groupBy("f").agg(*[F.min_by(p, "i").alias(f"h{k}") for k, p in enumerate(parts)])


def _headers(spark: SparkSession, pattern: str) -> dict[str, tuple[int, int, int]]:
    """One row per file reaches the driver, beside the file list it holds anyway."""
    return {_plain(r["f"]): (r["h0"], r["h1"], r["h2"]) for r in _first_lines(spark, pattern).collect()}


def _header(spark: SparkSession, file: str) -> str:
    first = spark.read.text(file).head()
    return first["value"].lstrip("\ufeff") if first else ""


def read_puzzle_glob(spark: SparkSession, pattern: str) -> DataFrame:
    """SRC3: every file matching ``pattern``, concatenated by column name
    (missing columns null). No match is an error. Files are grouped by their
    header line so files with different columns are each read by name. A header
    with a line break inside a column name is grouped by its first line only."""
    jvm, fs, path = _hadoop_fs(spark, pattern)
    statuses = fs.globStatus(path)
    files = sorted(str(s.getPath().toString()) for s in (statuses or []) if s.isFile())
    if not files:
        raise FileNotFoundError(f"no file matches {pattern}")
    groups: dict[tuple[int, int, int], list[str]] = {}
    headers = _headers(spark, pattern)
    for f in files:
        groups.setdefault(headers.get(_plain(f), (0, 0, 0)), []).append(f)
    out = None
    for fs_ in sorted(groups.values(), key=lambda fs_: _header(spark, fs_[0])):
        part = read_puzzles(spark, fs_)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def _has_any_answer(df: DataFrame, answer: str = "answer") -> bool:
    if answer not in df.columns:
        return False
    # stops at the first such row; nothing is computed for the rest
    return bool(df.where(F.col(answer).isNotNull()).select(F.lit(1)).take(1))


def write_puzzles(df: DataFrame, path: str, extra: Sequence[str] = (), mode: str = "overwrite") -> bool:
    """SNK1 / SNK5: ``id, prompt`` plus ``answer`` only if any row has one (null
    written empty), then ``extra`` columns. Returns whether ``answer`` was written."""
    has = _has_any_answer(df)
    cols = ["id", "prompt"] + (["answer"] if has else []) + list(extra)
    df.select(*cols).write.mode(mode).options(**WRITE_OPTS).csv(path)
    return has


def write_predictions(pred_table: DataFrame, path: str, mode: str = "overwrite") -> bool:
    """SNK2: ``id, prediction, raw_generation`` plus the three answer columns when
    any record has an answer (input: ``grade.prediction_table`` rows)."""
    has = bool(pred_table.agg(F.bool_or(F.col("answer") != "")).first()[0])
    cols = ["id", "prediction", "raw_generation"] + (["answer", "raw_exact", "normalized_exact"] if has else [])
    pred_table.select(*cols).write.mode(mode).options(**WRITE_OPTS).csv(path)
    return has


def write_json_artifact(one_row: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SNK3: a one-row metrics / metadata frame as JSON (non-ASCII and null keys kept).
    Any other number of rows is an error."""
    n = one_row.limit(2).count()
    if n != 1:
        raise ValueError("a JSON artifact holds one row; the frame has " + ("none" if not n else "more"))
    one_row.coalesce(1).write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_training_text(df: DataFrame, path: str, fmt: str = "json", mode: str = "overwrite") -> None:
    """SNK4: one ``text`` per row as JSON lines (or Parquet)."""
    out = df.select("text")
    if fmt == "parquet":
        out.write.mode(mode).parquet(path)
    else:
        out.write.mode(mode).json(path)


def corpus_text(df: DataFrame, prompt: str = "prompt", answer: str = "answer") -> DataFrame:
    """SNK6 rows: ``prompt + ' ' + answer`` (a null answer adds nothing)."""
    return df.select(F.concat_ws(" ", F.col(prompt), F.col(answer)).alias("value"))


def write_corpus(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SNK6: newline-separated plain-text corpus."""
    corpus_text(df).write.mode(mode).text(path)
