"""Report ingest (I1-I3): clean a stacked all-string report frame into typed
columns and load it into its table, all or nothing.

Only the named columns are typed; every other column passes through as a
string. A missing named column fails at analysis time, before any job runs;
a non-numeric value in a numeric column fails the single write job, whose
output is committed only when every task succeeds. ``bad_cells`` lists all such
values first: one pass types the batch, collects the cells that do not parse and
stages the rows; they are committed only if there is no such cell.

Dates are parsed cell by cell, or, with ``date_layout="column"``, by one layout
per file and column: the one that the column's first value shows. A cell of
another layout is then NULL.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from kasir.functions import casts
from kasir.operators.loads import new_load
from kasir.operators.sinks import write
from kasir.session import staged
from kasir.sources.reports import ReportSpec, first_rows, read_report, spec


def _require(df: DataFrame, cols: Sequence[str], what: str) -> None:
    have = {c.lower() for c in df.columns}
    missing = [c for c in cols if c.lower() not in have]
    if missing:
        raise ValueError(f"{what}: missing columns {missing}")


def _retype(df: DataFrame, mapping: dict[str, F.Column]) -> DataFrame:
    """Replace named columns in place, keeping column order."""
    lower = {k.lower(): v for k, v in mapping.items()}
    return df.select(*[lower[c.lower()].alias(c) if c.lower() in lower else F.col(f"`{c}`")
                       for c in df.columns])


def drop_blank(df: DataFrame, key: str) -> DataFrame:
    """IN1: drop rows whose key is NULL or only whitespace."""
    return df.where(casts.not_blank(key))


def _cast_numbers(df: DataFrame, cols: Sequence[str], cast: Callable[[str, Column], Column]) -> DataFrame:
    """Each cell is parsed once, into a hidden column."""
    tmp = {c: f"__x_{i}" for i, c in enumerate(cols)}
    df = df.select("*", *[F.col(f"`{c}`").try_cast("double").alias(t) for c, t in tmp.items()])
    return _retype(df, {c: cast(c, F.col(t)) for c, t in tmp.items()}).drop(*tmp.values())


def cast_strict(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """IN2: numeric, one bad value fails the batch."""
    _require(df, cols, "numeric")
    return _cast_numbers(df, cols, lambda c, x: casts.strict_double(c, c, x))


def cast_date(df: DataFrame, cols: Sequence[str], formats: Sequence[str] = casts.DATE_FORMATS) -> DataFrame:
    """IN3: lenient date."""
    _require(df, cols, "date")
    return _retype(df, {c: casts.lenient_date(c, formats) for c in cols})


def column_layouts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(_file, _layouts): per file the layout that the first non-NULL value of
    each column shows, in file order. One row per file."""
    return df.groupBy("_file").agg(F.array(*[
        casts.guessed_layout(F.min_by(F.col(f"`{c}`"), F.when(F.col(f"`{c}`").isNotNull(), F.col("_row"))))
        for c in cols]).alias("_layouts"))


def cast_date_by_column(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """IN3 by column: rows with ``_file`` and ``_row`` (see ``read_report``)."""
    _require(df, cols, "date")
    # One row per file; staged, it has bytes that the planner knows.
    at = df.join(staged(column_layouts(df, cols), "column-layouts", "zstd"), "_file", "left")
    return _retype(at, {c: casts.layout_date(c, F.get("_layouts", F.lit(i))) for i, c in enumerate(cols)}) \
        .select(*[F.col(f"`{c}`") for c in df.columns])


def cast_time(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """IN4: lenient H:M:S time of day, kept as 'HH:mm:ss' text."""
    _require(df, cols, "time")
    return _retype(df, {c: casts.lenient_time(c) for c in cols})


def cast_timestamp(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """IN5: lenient timestamp."""
    _require(df, cols, "timestamp")
    return _retype(df, {c: casts.lenient_timestamp(c) for c in cols})


def clean_durations(df: DataFrame, cols: Sequence[str], seconds: bool = False) -> DataFrame:
    """IN6: durations as their clock text (days dropped, as the loaded tables
    have them) or, with ``seconds=True``, as total seconds."""
    _require(df, cols, "duration")
    # Parse once into hidden columns; the text is then built from them, so
    # the regex is not repeated inside every piece of the formatted output.
    tmp = {c: f"__ns_{i}" for i, c in enumerate(cols)}
    df = df.select("*", *[casts.duration_nanos(c).alias(t) for c, t in tmp.items()])
    if seconds:
        out = {c: F.col(t).cast("double") / F.lit(float(casts.NS_PER_SEC)) for c, t in tmp.items()}
    else:
        out = {c: casts.clock_text(F.col(t)) for c, t in tmp.items()}
    return _retype(df, out).drop(*tmp.values())


DATE_LAYOUTS = ("cell", "column")


def cleanse(df: DataFrame, kind: str | ReportSpec, formats: Sequence[str] = casts.DATE_FORMATS,
            date_layout: str = "cell", strict: bool = True) -> DataFrame:
    """Type one report kind; unnamed columns pass through as strings.
    ``formats`` are the date layouts tried after ISO. With ``date_layout``
    "column" the rows must carry ``_file`` and ``_row``. Without ``strict`` a
    bad number is NULL."""
    sp = spec(kind) if isinstance(kind, str) else kind
    if date_layout not in DATE_LAYOUTS:
        raise ValueError(f"unknown date layout {date_layout!r}; use one of {DATE_LAYOUTS}")
    _require(df, sp.typed, sp.kind)
    if sp.required_key:
        df = drop_blank(df, sp.required_key)
    df = clean_durations(df, sp.durations) if sp.durations else df
    df = cast_strict(df, sp.numeric) if strict else _cast_numbers(df, sp.numeric, casts.lenient_double)
    df = cast_date(df, sp.dates, formats) if date_layout == "cell" else cast_date_by_column(df, sp.dates)
    return cast_timestamp(cast_time(df, sp.times), sp.timestamps)


def prepare(spark: SparkSession, paths: str | Sequence[str], kind: str, formats: Sequence[str] = casts.DATE_FORMATS,
            date_layout: str = "cell", only: DataFrame | None = None) -> DataFrame:
    """Read, stack and type all files of one kind (nothing is written).
    ``only``: the files to take, as for ``read_report``."""
    by_column = date_layout == "column"
    rows = read_report(spark, paths, kind, position=by_column, only=only)
    return cleanse(rows, kind, formats, date_layout).drop("_file", "_row")


def preview_files(spark: SparkSession, paths: str | Sequence[str], kind: str, n: int = 5,
                  formats: Sequence[str] = casts.DATE_FORMATS) -> DataFrame:
    """IN11: the first ``n`` typed rows of each file, in file order."""
    typed = cleanse(read_report(spark, paths, kind, position=True), kind, formats)
    return first_rows(typed, n)


def batch_shape(df: DataFrame) -> DataFrame:
    """IN9: rows and columns of a batch, and whether any cell is missing: what
    the upload screen showed. One pass; each column's NULLs are a sum."""
    missing = sum((F.col(f"`{c}`").isNull().cast("int") for c in df.columns), F.lit(0))
    return df.agg(F.count("*").alias("n_rows"), F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
                  F.coalesce(F.sum(missing.cast("bigint")), F.lit(0)).alias("n_missing"),
                  F.coalesce(F.max(missing > 0), F.lit(False)).alias("has_missing"))


def _with_bad(spark: SparkSession, paths: str | Sequence[str], kind: str, formats: Sequence[str],
              date_layout: str, only: DataFrame | None = None) -> DataFrame:
    """Typed rows with ``_file``, ``_row`` and ``_bad``: their numeric cells that
    are no numbers."""
    sp = spec(kind)
    raw = read_report(spark, paths, kind, position=True, only=only)
    _require(raw, sp.typed, sp.kind)
    bad = F.filter(F.array(*[
        F.when(casts.is_bad_number(c), F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("value")))
        for c in sp.numeric]), lambda x: x.isNotNull())
    return cleanse(raw.withColumn("_bad", bad), kind, formats, date_layout, strict=False)


def checked(spark: SparkSession, paths: str | Sequence[str], kind: str, formats: Sequence[str] = casts.DATE_FORMATS,
            date_layout: str = "cell", only: DataFrame | None = None) -> tuple[DataFrame, int]:
    """The typed rows of a batch, staged, with ``_file``, ``_row`` and ``_bad``
    (the numeric cells that are no numbers), and how many there are in all."""
    seen = Observation()
    typed = _with_bad(spark, paths, kind, formats, date_layout, only)
    rows = staged(typed.observe(seen, F.sum(F.size("_bad")).alias("n")), "checked-batch")
    return rows, seen.get["n"] or 0


def listed(rows: DataFrame, most: int | None = None) -> DataFrame:
    """(file, line, column, value, n_in_file): the bad cells of a checked
    batch, all or the first ``most`` of each file, and the number of all."""
    return _listed(_bad_ones(rows), most)


def _bad_ones(rows: DataFrame) -> DataFrame:
    """(_file, _row, _nth, _cell). An outer generator: Spark would test for an
    empty list below a plain one, and parse every cell twice."""
    cells = rows.select("_file", "_row", F.posexplode_outer("_bad").alias("_nth", "_cell"))
    return cells.where("_cell is not null")


def _listed(cells: DataFrame, most: int | None) -> DataFrame:
    counts = cells.groupBy("_file").agg(F.count("*").alias("n_in_file"))
    if most is not None:
        w = Window.partitionBy("_file").orderBy("_row", "_nth")
        cells = cells.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= most)
    return cells.join(counts, "_file").select(
        F.col("_file").alias("file"), (F.col("_row") + 1).alias("line"), "_cell.column", "_cell.value", "n_in_file")


def bad_cells(spark: SparkSession, paths: str | Sequence[str], kind: str, most: int | None = None) -> DataFrame:
    """Every cell of the files that would fail the load. Only such cells are
    staged."""
    rows = _with_bad(spark, paths, kind, casts.DATE_FORMATS, "cell")
    return _listed(staged(_bad_ones(rows), "bad-cells"), most)


class BadCells(ValueError):
    """A batch was refused. ``cells`` lists why (see ``listed``)."""

    def __init__(self, count: int, cells: DataFrame):
        super().__init__(f"{count} cells are not numbers; nothing was written")
        self.count, self.cells = count, cells


def ingest(spark: SparkSession, paths: str | Sequence[str], kind: str, mode: str = "append",
           table: str | None = None, formats: Sequence[str] = casts.DATE_FORMATS, date_layout: str = "cell",
           check: bool = False, once: bool = False) -> dict:
    """Load report files into the kind's table in one write job.

    Returns the batch summary the upload screen showed: shape and whether any
    NULL is present (a warning only; it never blocks the load). The NULL
    counts are observed on the write itself.

    ``check``: collect all bad cells first and raise ``BadCells`` if there are
    any. ``once``: leave out files whose content the table has loaded before
    (append only; see ``operators.loads``).
    """
    target = table or spec(kind).table
    if once and mode.lower() != "append":
        raise ValueError("once goes with append only")
    load = new_load(spark, target, paths) if once else None
    if once and load is None:
        return {"rows": 0, "columns": 0, "null_columns": []}

    def rows(files: str | Sequence[str], only: DataFrame | None) -> DataFrame:
        if not check:
            return prepare(spark, files, kind, formats, date_layout, only)
        got, n = checked(spark, files, kind, formats, date_layout, only)
        if n:
            raise BadCells(n, listed(got))
        return got.drop("_file", "_row", "_bad")

    df = rows(*load.source) if load else rows(paths, None)
    seen = Observation()
    counts = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"nulls_{i}") for i, c in enumerate(df.columns)]
    df = df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts)
    if load:
        load.save(df)
    else:
        write(df, target, mode)
    got = seen.get
    return {"rows": got["rows"], "columns": len(counts),
            "null_columns": sorted(c for i, c in enumerate(df.columns) if got[f"nulls_{i}"])}
