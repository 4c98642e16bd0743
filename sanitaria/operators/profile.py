"""Column statistics, summaries, histograms and the data dictionary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sanitaria.functions import columns as C
from sanitaria.operators.distinct import with_distinct_counts
from sanitaria.operators.enrich import MUNICIPALITY_COLUMNS
from sanitaria.sources.footers import column_facts
from sanitaria.sources.store import data_files, scan_store, store_layout
from sanitaria.systems import System, get_system

STATS_VERSION = 3
STATS_SCHEMA = "column string, row_count bigint, null_pct double, fill_pct double, distinct_count bigint"


def is_empty(name: str, kind: T.DataType) -> Column:
    c = C.quoted(name)
    return c.isNull() | (F.size(c) == 0) if isinstance(kind, T.ArrayType) else c.isNull()


#: Groups in which the states of tasks are merged before the last step merges the groups.
MERGE_GROUPS = 64


def distinct_sketch(name: str) -> Column:
    """A small binary sketch of the distinct values, about 1.6 % off.

    Values of any type enter by their hash, since a sketch takes whole numbers.
    """
    c = C.quoted(name)
    return F.hll_sketch_agg(F.when(c.isNotNull(), F.xxhash64(c)), F.lit(12))


#: Values a top-values sketch tracks at first; its counters take about 100 bytes each.
TRACKED = 10_000
#: Share of all rows up to which a value may occur and not be named by a sketch, times the values it tracks.
SKETCH_ERROR = 7.0


def heavy_hitters(df: DataFrame, column: str, k: int = 10, tracked: int = TRACKED) -> DataFrame:
    """The ``k`` most frequent values of a column of many values: ``value, count, certain``, largest first, ties by value.

    Every task keeps a sketch of at most ``tracked`` counters; sketches merge by group of tasks, then at last, and name
    the candidates.  A second pass counts only these, so counts are exact.  A value that no candidate stands for
    occurs at most ``SKETCH_ERROR / tracked`` of the rows; ``certain`` says that a value occurs more often than that, so
    no other can take its place.  Null is no value.  Values are text; :func:`histogram` groups them all.
    """
    value = F.when(C.quoted(column).isNotNull(), C.quoted(column).cast("string"))
    values = df.select(value.alias("value")).where("value is not null")
    parts = values.groupBy(F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS)).alias("_group")).agg(
        F.expr(f"approx_top_k_accumulate(value, {tracked})").alias("sketch")
    )
    found = parts.agg(F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch")).select(
        F.expr(f"inline(approx_top_k_estimate(sketch, {tracked}))")
    )
    counted = values.join(F.broadcast(found.select(F.col("item").alias("value"))), "value").groupBy("value").agg(
        F.count(F.lit(1)).alias("count")
    )
    total = values.agg(F.count(F.lit(1))).scalar()
    certain = (F.col("count") > F.ceil(total * SKETCH_ERROR / tracked)).alias("certain")
    return counted.select("value", "count", certain).orderBy(F.desc("count"), "value").limit(k)


def _premerged(df: DataFrame, measures: list[Column]) -> DataFrame:
    """The measures of each of ``MERGE_GROUPS`` groups of tasks: many tasks' sketches never meet in one."""
    return df.groupBy(F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS)).alias("_group")).agg(*measures)


def column_stats(df: DataFrame, exact: bool = False) -> DataFrame:
    """One row per column: ``row_count``, ``null_pct``, ``fill_pct``, ``distinct_count``.

    A single pass over the data.  Distinct counts are approximate by default:
    fixed-size sketches are merged map-side, then by group of tasks, then at last; ``exact`` marks small whole
    numbers in bitmaps and shuffles every distinct value of the other columns.  An array counts as null when it is NULL or
    empty.  An empty table has no rows in the result.
    """
    first, last = [F.count(F.lit(1)).alias("n")], [F.sum("n").alias("n")]
    for i, f in enumerate(df.schema.fields):
        first.append(F.count_if(is_empty(f.name, f.dataType)).alias(f"e{i}"))
        last.append(F.sum(f"e{i}").alias(f"e{i}"))
        if not exact:
            first.append(distinct_sketch(f.name).alias(f"d{i}"))
            last.append(F.hll_sketch_estimate(F.hll_union_agg(f"d{i}")).alias(f"d{i}"))
    entries = [
        F.struct(
            F.lit(f.name).alias("column"),
            F.col("n").alias("row_count"),
            F.round(F.try_divide(F.col(f"e{i}") * 100.0, F.col("n")), 2).alias("null_pct"),
            F.col(f"d{i}").alias("distinct_count"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    if exact:
        totals = with_distinct_counts(df, (), first, {f"d{i}": name for i, name in enumerate(df.columns)})
    else:
        totals = _premerged(df, first).agg(*last)
    long = totals.where("n > 0").select(F.inline(F.array(*entries)))
    return long.select(
        "column",
        "row_count",
        "null_pct",
        F.round(100 - F.col("null_pct"), 2).alias("fill_pct"),
        "distinct_count",
    )


FOOTER_SCHEMA = "column string, row_count bigint, null_pct double, fill_pct double, min string, max string, scanned boolean"


def _bound(fact, side: str, kind: T.DataType) -> str | None:
    whole, real, text = (fact[f"{side}_{k}"] for k in ("int", "real", "text"))
    if isinstance(kind, T.BooleanType):
        return None if whole is None else str(bool(whole)).lower()
    return next((str(v) for v in (whole, real, text) if v is not None), None)


def footer_stats(spark: SparkSession, root: str, system: str | System) -> DataFrame:
    """Fill, bounds and row count of every column of a store, from the footers of its files: no row is read.

    Two kinds of columns are scanned after all, and only they (``scanned``): arrays some of whose elements or lists
    are missing, because a footer counts missing elements and empty lists alike and an empty list counts as null here;
    and columns of files written without statistics.  A column that a file lacks is null in all rows of that file.
    Bounds are those of the footers: texts and dates as text, none for arrays and for columns without any value.
    An empty or absent store has no rows in the result.
    """
    spec = get_system(system)
    layout = store_layout(spark, root, spec)
    if layout is None:
        return spark.createDataFrame([], FOOTER_SCHEMA)
    partitions = ["uf"] if layout == "state" else ["uf", "source_file"]
    facts = {f["column"]: f for f in column_facts(data_files(spark, root, spec), partitions)}
    total, empty, unclear = facts[None]["rows"] or 0, {}, []
    for f in spec.schema.fields:
        fact = facts.get(f.name)
        if fact is None:
            empty[f.name] = total
        elif fact["nulls"] is None or (fact["repeated"] and fact["nulls"]):
            unclear.append(f)
        else:
            empty[f.name] = fact["nulls"] + total - fact["rows"]
    if unclear:
        rows = scan_store(spark, root, spec, filename=False)
        empty |= rows.agg(*(F.count_if(is_empty(f.name, f.dataType)).alias(f.name) for f in unclear)).first().asDict()
    if not total:
        return spark.createDataFrame([], FOOTER_SCHEMA)
    entries = []
    for f in spec.schema.fields:
        fact, missing = facts.get(f.name), round(empty[f.name] * 100.0 / total, 2)
        known = fact is not None and fact["bounded"] and not fact["repeated"]
        bounds = [_bound(fact, side, f.dataType) if known else None for side in ("low", "high")]
        entries.append((f.name, total, missing, round(100 - missing, 2), *bounds, f in unclear))
    return spark.createDataFrame(entries, FOOTER_SCHEMA)


def filename_stats(df: DataFrame, filename: str = "filename") -> DataFrame:
    """Statistics of the virtual file column: always filled, one value per data file.

    ``df`` is the listing of the data files (``data_files``, whose ``path`` is the file column) or
    any table with such a column; a listing spares reading the rows.
    """
    names = df.select(C.quoted("path" if filename not in df.columns else filename).alias("f")).distinct()
    return names.agg(F.count("f").alias("distinct_count")).select(
        F.lit(filename).alias("column"), F.lit(100.0).alias("fill_pct"), "distinct_count"
    )


def enriched_stats(stats: DataFrame, dim: DataFrame, residence: str) -> DataFrame:
    """Statistics of the municipality columns, without touching the facts.

    Fill comes from the residence column, distinct counts from the dimension;
    both are bounds and marked approximate.
    """
    fill = stats.where(F.col("column") == residence).select("fill_pct").scalar()
    counts = dim.agg(*[F.countDistinct(C.quoted(src)).alias(out) for out, src in MUNICIPALITY_COLUMNS.items()])
    return (
        counts.select(
            F.inline(
                F.array(
                    *[
                        F.struct(F.lit(out).alias("column"), F.col(out).alias("distinct_count"))
                        for out in MUNICIPALITY_COLUMNS
                    ]
                )
            )
        )
        .withColumn("fill_pct", fill)
        .select(
            "column",
            "fill_pct",
            F.col("fill_pct").isNotNull().alias("fill_pct_approx"),
            "distinct_count",
            F.lit(True).alias("distinct_count_approx"),
        )
    )


def summarize(df: DataFrame, quantiles: bool = True) -> DataFrame:
    """Per column: type, min, max, approximate unique, mean, deviation, quartiles, count, null share.

    One pass, long result; mean, deviation and quartiles are NULL for columns
    that are not numeric.  Sketches of distinct values and quantiles are merged map-side, then by
    group of tasks, then at last; quartiles are those of a sketch, about 1.3 % of the rows off.
    """
    first, last = [F.count(F.lit(1)).alias("n")], [F.coalesce(F.sum("n"), F.lit(0)).alias("n")]
    entries = []
    for i, f in enumerate(df.schema.fields):
        c, number = C.quoted(f.name), isinstance(f.dataType, T.NumericType)
        nested = isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))
        first += [F.count(c).alias(f"count{i}"), distinct_sketch(f.name).alias(f"unique{i}")]
        last += [
            F.coalesce(F.sum(f"count{i}"), F.lit(0)).alias(f"count{i}"),
            F.hll_sketch_estimate(F.hll_union_agg(f"unique{i}")).alias(f"unique{i}"),
        ]
        for name, pick in (("min", F.min), ("max", F.max)):
            first.append((F.lit(None).cast("string") if nested else pick(c)).alias(f"{name}{i}"))
            last.append((F.max(f"{name}{i}") if nested else pick(f"{name}{i}").cast("string")).alias(f"{name}{i}"))
        nothing = F.lit(None).cast("double")
        if number:
            value = c.cast("double")
            first += [F.sum(value).alias(f"sum{i}"), F.var_pop(value).alias(f"var{i}"), F.avg(value).alias(f"avg{i}")]
            # Deviations about the groups' means and of these means about the whole one.
            weight = F.col(f"count{i}")
            mean = F.try_divide(F.sum(f"sum{i}"), F.sum(weight))
            last.append(mean.alias(f"avg{i}"))
            last.append(F.collect_list(F.when(weight > 0, F.struct(weight.alias("w"), F.col(f"avg{i}").alias("m"), F.col(f"var{i}").alias("v")))).alias(f"parts{i}"))
            if quantiles:
                first.append(F.kll_sketch_agg_double(value).alias(f"q{i}"))
                last.append(F.kll_merge_agg_double(f"q{i}").alias(f"q{i}"))
        spread = F.expr(
            f"sqrt(try_divide(aggregate(parts{i}, 0D, (s, p) -> s + p.w * (p.v + (p.m - avg{i}) * (p.m - avg{i}))), count{i} - 1))"
        )
        quartile = lambda q: F.when(F.col(f"count{i}") > 0, F.kll_sketch_get_quantile_double(F.col(f"q{i}"), F.lit(q))) if number and quantiles else nothing  # noqa: B023, E731
        entries.append(
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("column_type"),
                F.col(f"min{i}").alias("min"),
                F.col(f"max{i}").alias("max"),
                F.col(f"unique{i}").alias("approx_unique"),
                (F.col(f"avg{i}") if number else nothing).alias("avg"),
                (spread if number else nothing).alias("std"),
                quartile(0.25).alias("q25"),
                quartile(0.5).alias("q50"),
                quartile(0.75).alias("q75"),
                F.col("n").alias("count"),
                F.round(F.try_divide((F.col("n") - F.col(f"count{i}")) * 100.0, F.col("n")), 2).alias(
                    "null_percentage"
                ),
            )
        )
    return _premerged(df, first).agg(*last).select(F.inline(F.array(*entries)))


def histogram(df: DataFrame, column: str) -> DataFrame:
    """Value, count and share of all rows, largest first; fractional numbers grouped at 2 decimals.

    The total comes from the grouped counts through a scalar subquery, so the
    data is scanned and shuffled once.
    """
    kind = df.schema[column].dataType
    value = C.quoted(column)
    if isinstance(kind, T.FractionalType):
        value = value.try_cast("decimal(38,2)")
    counts = df.groupBy(value.alias(column)).agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count")).scalar()
    share = F.round(F.col("count") * 100.0 / total, 1).alias("pct_population")
    return counts.select(C.quoted(column), "count", share).orderBy(
        F.desc("count"), C.quoted(column).asc_nulls_last()
    )


def _views_of(spark: SparkSession, system: System) -> list[tuple[str, str, str | None, str | None, str | None]]:
    """Views a system shows: its explicit list, else the naming convention."""
    if system.views is not None:
        return [(v.name, v.role, v.label_pt, v.label_en, v.description) for v in system.views]
    names = sorted(t.name for t in spark.catalog.listTables() if t.isTemporary)
    main = [(system.name, "main")] if system.name in names else []
    dims = [(n, "dim") for n in names if n.startswith(f"{system.name}_dim_")]
    return [(name, role, None, None, None) for name, role in main + dims]


def dictionary(
    spark: SparkSession,
    system: str | System,
    stats: DataFrame | None = None,
    dim: DataFrame | None = None,
    filename: DataFrame | None = None,
    descriptions: DataFrame | None = None,
) -> DataFrame:
    """System, view and column tree with types, descriptions and column statistics.

    ``stats`` is the result of :func:`column_stats` over the raw view,
    ``filename`` that of :func:`filename_stats`, ``descriptions`` any table of
    ``(column, description)``.  Only the schema of the views is read here.
    """
    spec = get_system(system)
    entries = [
        (spec.name, spec.title, name, role, pt, en, text, position, f.name, f.dataType.simpleString())
        for name, role, pt, en, text in _views_of(spark, spec)
        for position, f in enumerate(spark.table(name).schema.fields)
    ]
    tree = spark.createDataFrame(
        entries,
        "system string, system_label string, view string, role string, label_pt string, label_en string,"
        " view_description string, position int, column string, type string",
    )
    facts = spark.createDataFrame(
        [],
        "column string, fill_pct double, fill_pct_approx boolean, distinct_count bigint, distinct_count_approx boolean",
    )
    exactly = [F.lit(False).alias("fill_pct_approx"), "distinct_count", F.lit(False).alias("distinct_count_approx")]
    if stats is not None:
        own = stats.where(~F.col("column").isin("filename", *MUNICIPALITY_COLUMNS))
        facts = facts.unionByName(own.select("column", "fill_pct", *exactly))
        if dim is not None and spec.residence:
            facts = facts.unionByName(enriched_stats(stats, dim, spec.residence))
    if filename is not None:
        facts = facts.unionByName(filename.select("column", "fill_pct", *exactly))
    if descriptions is None:
        descriptions = spark.createDataFrame([], "column string, description string")
    return (
        tree.join(facts, "column", "left")
        .join(descriptions.select("column", "description"), "column", "left")
        .select(
            "system", "system_label", "view", "role", "label_pt", "label_en", "view_description", "position",
            "column", "type", F.coalesce("description", F.lit("")).alias("description"),
            "fill_pct", F.coalesce("fill_pct_approx", F.lit(False)).alias("fill_pct_approx"),
            "distinct_count", F.coalesce("distinct_count_approx", F.lit(False)).alias("distinct_count_approx"),
        )
        .orderBy("view", "position")
    )


def schema_table(df: DataFrame) -> DataFrame:
    """Columns of a table as rows, in order."""
    spark = df.sparkSession
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "position int, column_name string, column_type string, nullable boolean")


def tables(spark: SparkSession) -> DataFrame:
    """Names of the tables and views of the session."""
    rows = [(t.name, t.tableType, t.isTemporary) for t in spark.catalog.listTables()]
    return spark.createDataFrame(rows, "name string, table_type string, is_temporary boolean")


def table_stats(df: DataFrame, name: str) -> DataFrame:
    """Rows, number of columns and column names of one table."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(name).alias("table_name"),
        "row_count",
        F.lit(len(df.columns)).alias("column_count"),
        F.lit(",".join(df.columns)).alias("columns"),
    )
