"""Profiles, summaries and delivery checks of tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _lit_rows(items: Sequence[Column]) -> Column:
    return F.explode(F.array(*items))


def missing_profile(df: DataFrame, nan: bool = False) -> DataFrame:
    """Null count per column as rows, from one aggregate; ``nan`` counts NaN too."""
    floating = {name for name, kind in df.dtypes if kind in ("double", "float")}

    def missing(name: str) -> Column:
        col = F.col(f"`{name}`")
        return col.isNull() | F.isnan(col) if nan and name in floating else col.isNull()

    counted = df.agg(
        *[F.count_if(missing(name)).alias(f"m{i}") for i, name in enumerate(df.columns)]
    )
    return counted.select(
        _lit_rows(
            [
                F.struct(F.lit(name).alias("column"), F.col(f"m{i}").alias("missing_count"))
                for i, name in enumerate(df.columns)
            ]
        ).alias("m")
    ).select("m.column", "m.missing_count")


def table_profile(df: DataFrame) -> DataFrame:
    """One row per column with its position and type, plus the row count of the table."""
    counted = df.agg(F.count("*").alias("rows"))
    items = [
        F.struct(
            F.lit(i + 1).alias("position"), F.lit(name).alias("column"), F.lit(kind).alias("dtype")
        )
        for i, (name, kind) in enumerate(df.dtypes)
    ]
    return counted.select(
        "rows", F.lit(len(df.columns)).alias("columns"), _lit_rows(items).alias("c")
    ).select("c.position", "c.column", "c.dtype", "rows", "columns")


def manifest(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Name, path, row count and columns of each (table, path)."""
    rows = [
        df.agg(F.count("*").alias("rows")).select(
            F.lit(name).alias("table"),
            F.lit(path).alias("path"),
            "rows",
            F.array(*[F.lit(c) for c in df.columns]).alias("columns"),
        )
        for name, (df, path) in tables.items()
    ]
    return reduce(DataFrame.unionByName, rows)


# --- numeric summary ---------------------------------------------------------------

SUMMARY_COLUMNS = (
    "trip_distance",
    "fare_amount",
    "total_amount",
    "trip_duration_min",
    "passenger_count",
)
QUARTILES = (0.25, 0.5, 0.75)
#: Accuracy of the sketch that brackets the wanted ranks, and the share of rows on either side of one.
_ACCURACY, _BRACKET = 50_000, 1e-4


def _long_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value) rows without null and NaN."""
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]
    values = df.select(F.explode(F.array(*pairs)).alias("v")).select("v.column", "v.value")
    return values.filter(F.col("value").isNotNull() & ~F.isnan("value"))


def numeric_summary(
    df: DataFrame, columns: Sequence[str] = SUMMARY_COLUMNS, exact: bool = False
) -> DataFrame:
    """Count, mean, standard deviation, minimum, quartiles and maximum per column.

    The approximate form is one pass with a quantile sketch of fixed size. The
    exact form interpolates between the two neighbouring ranks and never sorts the
    table: a sketch gives a value below and one above each wanted rank, values are
    counted once between those, and only the distinct values of the cells that hold
    a wanted rank are put in order. The cells hold shares of the rows, not of the
    range, so outliers do not fill one; a poor sketch would cost time, not rightness.
    """
    values = _long_values(df, columns)
    moments = [
        F.count("*").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("stddev"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    ]
    names = ("q25", "q50", "q75")
    if not exact:
        sketch = F.percentile_approx("value", list(QUARTILES), 10_000)
        table = values.groupBy("column").agg(*moments, sketch.alias("q"))
        quartiles = [F.element_at("q", i + 1).alias(n) for i, n in enumerate(names)]
        return table.select("column", "count", "mean", "stddev", "min", *quartiles, "max")

    stats = values.groupBy("column").agg(*moments)
    counts = values.groupBy("column", "value").agg(F.count("*").alias("n"))
    quartiles = F.broadcast(_exact_quartiles(values, counts, names))
    return stats.join(quartiles, "column").select(
        "column", "count", "mean", "stddev", "min", *names, "max"
    )


def _exact_quartiles(values: DataFrame, counts: DataFrame, names: Sequence[str]) -> DataFrame:
    shares = sorted(min(max(q + side, 0.0), 1.0) for q in QUARTILES for side in (-_BRACKET, _BRACKET))
    edges = F.percentile_approx("value", shares, _ACCURACY)
    extent = values.groupBy("column").agg(F.count("*").alias("total"), edges.alias("edges"))
    cell = F.size(F.filter("edges", lambda e: e <= F.col("value")))
    # hints below are safe at any size: one row per summarised column, times six at most
    placed = counts.join(F.broadcast(extent), "column").withColumn("cell", cell)

    running = Window.partitionBy("column").orderBy("cell")
    cells = placed.groupBy("column", "cell").agg(F.sum("n").alias("n"))
    cells = cells.withColumn("upto", F.sum("n").over(running)).withColumn(
        "before", F.col("upto") - F.col("n")
    )

    # ranks are counted from 0; a quantile lies between two neighbouring ranks
    wanted = extent.select(
        "column",
        F.explode(
            F.array(*[F.struct(F.lit(n).alias("name"), F.lit(q).alias("q")) for n, q in zip(names, QUARTILES)])
        ).alias("w"),
        (F.col("total") - 1).alias("last"),
    ).select("column", "w.name", (F.col("last") * F.col("w.q")).alias("place"))
    wanted = wanted.select(
        "column",
        "name",
        (F.col("place") - F.floor("place")).alias("share"),
        F.explode(F.array_distinct(F.array(F.floor("place"), F.ceil("place")))).alias("rank"),
    )
    hits = wanted.join(
        cells.select("column", "cell", "before", "upto"), "column"
    ).filter((F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("upto")))

    inside = Window.partitionBy("column", "cell").orderBy("value")
    busy = hits.select("column", "cell", "before").distinct()
    ordered = (
        placed.select("column", "cell", "value", "n")
        .join(F.broadcast(busy), ["column", "cell"])
        .withColumn("last_rank", F.col("before") + F.sum("n").over(inside))
        .select("column", "cell", "value", "last_rank", (F.col("last_rank") - F.col("n")).alias("first_rank"))
    )
    found = hits.drop("before", "upto").join(ordered, ["column", "cell"]).filter(
        (F.col("rank") >= F.col("first_rank")) & (F.col("rank") < F.col("last_rank"))
    )
    quartiles = []
    for name in names:
        mine = F.when(F.col("name") == name, F.col("value"))
        share = F.max(F.when(F.col("name") == name, F.col("share")))
        quartiles.append((F.min(mine) + (F.max(mine) - F.min(mine)) * share).alias(name))
    return found.groupBy("column").agg(*quartiles)


# --- quartiles from sketches kept in a table --------------------------------------------

#: Size of a sketch; its quantiles are off by well under a hundredth of the rows.
SKETCH_SIZE = 1_024


def sketch_cube(df: DataFrame, keys: Sequence[str], columns: Sequence[str] = SUMMARY_COLUMNS, size: int = SKETCH_SIZE) -> DataFrame:
    """A row for each group with a quantile sketch of every column, null and NaN left out.

    Sketches merge, so quartiles of any coarser grouping come from this table, and a new
    day is a few rows more instead of another pass over all days.
    """
    values = {c: F.col(c).cast("double") for c in columns}
    sketches = [
        F.kll_sketch_agg_double(F.when(~F.isnan(v), v), F.lit(size)).alias(f"{c}_sketch") for c, v in values.items()
    ]
    return df.groupBy(*keys).agg(*sketches)


def sketch_quartiles(cube: DataFrame, keys: Sequence[str] = (), columns: Sequence[str] = SUMMARY_COLUMNS) -> DataFrame:
    """(keys, column, count, quartile, value) from the merged sketches of each group of ``keys``."""
    merged = cube.groupBy(*keys).agg(*[F.kll_merge_agg_double(f"{c}_sketch").alias(f"{c}_sketch") for c in columns])
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"{c}_sketch").alias("sketch")) for c in columns]
    merged = merged.select(*keys, F.explode(F.array(*rows)).alias("s")).select(*keys, "s.column", "s.sketch")
    counted = merged.withColumn("count", F.kll_sketch_get_n_double("sketch")).filter("count > 0")
    shares = F.array(*[F.lit(q) for q in QUARTILES])
    values = F.arrays_zip(shares.alias("quartile"), F.kll_sketch_get_quantile_double("sketch", shares).alias("value"))
    return counted.select(*keys, "column", "count", F.explode(values).alias("q")).select(*keys, "column", "count", "q.quartile", "q.value")


def rank_distances(df: DataFrame, quartiles: DataFrame, columns: Sequence[str] = SUMMARY_COLUMNS) -> DataFrame:
    """``quartiles`` (column, quartile, value) with ``distance``: by what share of the rows the value misses its rank."""
    # a quartile is one row for each summarised column
    met = _long_values(df, columns).withColumnRenamed("value", "v").join(F.broadcast(quartiles), "column")
    found = met.groupBy("column", "quartile", "value").agg(
        F.count("*").alias("rows"), F.count_if(F.col("v") < F.col("value")).alias("below"), F.count_if(F.col("v") <= F.col("value")).alias("upto")
    )
    share = F.col("quartile")
    off = F.greatest(F.lit(0.0), F.col("below") / F.col("rows") - share, share - F.col("upto") / F.col("rows"))
    return found.select("column", F.col("rows").alias("count"), "quartile", "value", off.alias("distance"))


# --- delivery checks -----------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """A check on one table.

    ``kind`` is ``rows`` (at least ``floor`` rows), ``columns`` (all present),
    ``filled`` (no null in the columns), ``values`` (each of ``values`` occurs in the
    first column), or ``bounds`` (the first column is a number from ``low`` to ``high`` in
    every row). On a bundle, ``sections`` asks that each of ``values`` is a section with
    records, ``keys`` that every record of ``section`` has the keys ``columns``, and with
    ``section`` the other kinds look at the fields of its records.
    """

    table: str
    kind: str
    columns: tuple[str, ...] = ()
    floor: int = 1
    values: tuple[str, ...] = ()
    section: str | None = None
    low: float = float("-inf")
    high: float = float("inf")

    @property
    def name(self) -> str:
        detail = {
            "rows": str(self.floor),
            "values": ",".join(self.values),
            "sections": ",".join(self.values),
            "bounds": ",".join(map(str, (*self.columns, self.low, self.high))),
        }.get(self.kind, ",".join(self.columns))
        place = self.table if self.section is None else f"{self.table}.{self.section}"
        return f"{place}.{self.kind}({detail})"


def _occurring(column: Column, values: Sequence[str]) -> Column:
    """How many of ``values`` occur in a column."""
    hits = [F.max((column == v).cast("int")) for v in values]
    return reduce(lambda a, b: a + b, [F.coalesce(h, F.lit(0)) for h in hits]).cast("bigint")


def _observed(rule: Rule, df: DataFrame) -> tuple[Column, int]:
    """The measured number and the number it must reach, as an aggregate over the table."""
    if rule.section is not None or rule.kind == "sections":
        return _observed_in_bundle(rule, df)
    if rule.kind == "rows":
        return F.count("*"), rule.floor
    if rule.kind == "columns":
        present = sum(name in df.columns for name in rule.columns)
        return F.lit(present).cast("bigint"), len(rule.columns)
    if any(name not in df.columns for name in rule.columns):
        return F.lit(-1).cast("bigint"), 0
    if rule.kind == "filled":
        broken = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in rule.columns])
        return -F.count_if(broken), 0
    if rule.kind == "bounds":
        return -F.count_if(_outside(F.col(rule.columns[0]).cast("double"), rule)), 0
    return _occurring(F.col(rule.columns[0]), rule.values), len(rule.values)


def _outside(value: Column, rule: Rule) -> Column:
    # NaN is larger than any number here
    return ~F.coalesce(~F.isnan(value) & (value >= F.lit(rule.low)) & (value <= F.lit(rule.high)), F.lit(False))


def _observed_in_bundle(rule: Rule, df: DataFrame) -> tuple[Column, int]:
    if rule.kind == "sections":
        return _occurring(F.when(F.col("record").isNotNull(), F.col("section")), rule.values), len(rule.values)
    mine = F.col("section") == rule.section
    if rule.kind == "rows":
        return F.count_if(mine), rule.floor
    keys = F.coalesce(F.json_object_keys("record"), F.array().cast("array<string>"))
    if rule.kind == "keys":
        lacking = F.size(F.array_except(F.array(*[F.lit(c) for c in rule.columns]), keys)) > 0
        return -F.count_if(mine & lacking), 0
    fields = [F.get_json_object("record", f"$.{c}") for c in rule.columns]
    if rule.kind == "filled":
        return -F.count_if(mine & reduce(lambda a, b: a | b, [f.isNull() for f in fields])), 0
    if rule.kind == "bounds":
        return -F.count_if(mine & _outside(fields[0].try_cast("double"), rule)), 0
    if rule.kind == "values":
        return _occurring(F.when(mine, fields[0]), rule.values), len(rule.values)
    raise ValueError(f"rule {rule.kind!r} does not apply to a section")


def expectations(tables: Mapping[str, DataFrame], rules: Sequence[Rule]) -> DataFrame:
    """One row per rule: what was measured, what is needed, and whether it holds.

    All rules of a table share one aggregate. ``observed`` of ``filled``, ``bounds`` and
    ``keys`` is the number of offending rows with a minus sign.
    """
    parts = []
    for table in dict.fromkeys(rule.table for rule in rules):
        df = tables[table]
        own = [rule for rule in rules if rule.table == table]
        measured = [_observed(rule, df) for rule in own]
        row = df.agg(*[F.coalesce(m, F.lit(0)).alias(f"o{i}") for i, (m, _) in enumerate(measured)])
        items = [
            F.struct(
                F.lit(rule.name).alias("rule"),
                F.lit(rule.table).alias("table"),
                F.col(f"o{i}").cast("bigint").alias("observed"),
                F.lit(needed).cast("bigint").alias("needed"),
            )
            for i, (rule, (_, needed)) in enumerate(zip(own, measured))
        ]
        parts.append(
            row.select(F.explode(F.array(*items)).alias("r"))
            .select("r.*")
            .withColumn("ok", F.col("observed") >= F.col("needed"))
        )
    return reduce(DataFrame.unionByName, parts)
