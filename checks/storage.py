"""Loads, writes and exports: every query writes the whole derived data and reads it back."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import registry as R
from checks import views as V
from checks.landing_files import write_named_files
from checks.registry import register
from sanitaria.operators import coverage as K
from sanitaria.operators import profile as P
from sanitaria.operators.transform import transform
from sanitaria.plans.common import rows
from sanitaria.session import scratch_dir
from sanitaria.sinks import export as E
from sanitaria.sinks import manifest as M
from sanitaria.sinks.store import insert_new_files, write_store
from sanitaria.sources import dimensions as D
from sanitaria.sources.fixed_width import FILE_COLUMN, scan_fixed_width
from sanitaria.sources.inventory import with_period
from sanitaria.sources.landing import scan_landing
from sanitaria.sources.store import data_files, register_views, scan_store
from sanitaria.streaming.ingest import load_batch, load_report, start_ingest

_COUNTS = "count(*) AS n, count(munic_res) AS munic_res, count(dt_inter) AS dt_inter"
_DEATH_COUNTS = "count(*) AS n, count(codmunres) AS codmunres, count(dtobito) AS dtobito"


def _counts(df, *columns, by=("uf",)):
    return df.groupBy(*by).agg(rows().alias("n"), *[F.count(c).alias(c) for c in columns])


# -- store -------------------------------------------------------------------


@register("snk_01_write_store", f"WITH {R.ADMISSIONS} SELECT uf, {_COUNTS} FROM adm GROUP BY uf")
def write_and_read(spark, sf):
    """Load all raw admissions into a fresh state-partitioned store."""
    root = scratch_dir(spark, "snk01")
    write_store(transform(V.admissions(spark, sf), "sihsus", fill=False), root, "sihsus", rebalance=True, fill=True)
    return _counts(scan_store(spark, root, "sihsus"), "munic_res", "dt_inter")


@register("snk_01_write_deaths", f"WITH {R.DEATHS} SELECT uf, {_DEATH_COUNTS} FROM dth GROUP BY uf")
def write_and_read_deaths(spark, sf):
    root = scratch_dir(spark, "snk01d")
    typed = transform(V.deaths(spark, sf), "sim", fill=False)
    write_store(typed, root, "sim", compression="snappy", rebalance=True, fill=True)
    return _counts(scan_store(spark, root, "sim"), "codmunres", "dtobito")


@register(
    "snk_02_write_modes",
    f"WITH {R.ADMISSIONS}, doubled AS (SELECT uf FROM adm UNION ALL SELECT uf FROM adm WHERE uf >= 'PB') "
    "SELECT uf, count(*) AS n FROM doubled GROUP BY uf",
)
def write_modes(spark, sf):
    """Append all rows twice, then replace the states before PB: only those return to one copy."""
    root = scratch_dir(spark, "snk02")
    typed = R.narrow_admissions(spark, sf)
    write_store(typed, root, "sihsus", fill=True)
    write_store(typed, root, "sihsus", mode="append", fill=True)
    write_store(typed.where("uf < 'PB'"), root, "sihsus", mode="replace", fill=True)
    return _counts(scan_store(spark, root, "sihsus"))


@register(
    "snk_03_insert_new_files",
    f"WITH {R.ADMISSIONS}, early AS (SELECT * FROM adm WHERE substr(source_file, 5, 2) < '17') "
    "SELECT (SELECT count(*) FROM early) AS first_run, (SELECT count(*) FROM adm) - (SELECT count(*) FROM early) "
    "AS second_run, CAST(0 AS BIGINT) AS third_run, (SELECT count(*) FROM adm) AS stored",
)
def insert_three_times(spark, sf):
    """Half of the files, then all of them, then all again: nothing is stored twice."""
    root = scratch_dir(spark, "snk03")
    typed = R.narrow_admissions(spark, sf)
    early = typed.where(F.substring("source_file", 5, 2) < "17")
    runs = [insert_new_files(part, root, "sihsus", fill=True) for part in (early, typed, typed)]
    stored = scan_store(spark, root, "sihsus")
    return stored.agg(rows().alias("stored")).select(
        *[F.lit(n).cast("bigint").alias(name) for n, name in zip(runs, ("first_run", "second_run", "third_run"))],
        "stored",
    )


_MANIFEST = f"WITH {R.FILES}"


@register(
    "snk_04_manifest",
    f"{_MANIFEST} SELECT uf, CAST(row_number() OVER (PARTITION BY uf ORDER BY year, month, name) AS INTEGER) "
    "AS position, name AS source_file, year, month FROM files WHERE uf <> 'SP'",
)
def manifest_events(spark, sf):
    """Clear, add all, remove one state's files: the listing shows the others by period."""
    root = scratch_dir(spark, "snk04")
    names = V.inventory(spark, sf).select(F.col("name").alias("source_file"))
    M.add_files(names, root, "sihsus")
    M.clear(spark, root, "sihsus")
    M.add_files(names, root, "sihsus")
    M.remove_files(names.where(F.substring("source_file", 3, 2) == "SP"), root, "sihsus")
    return M.listed_files(spark, root, "sihsus")


register(
    "cov_08_processed_files",
    f"WITH {R.ADMISSIONS_RAW} SELECT DISTINCT source_file FROM adm_raw",
)(lambda spark, sf: M.processed_files(spark, R.store(spark, sf, "sihsus"), "sihsus"))

register(
    "src_01_scan_store",
    f"WITH {R.ADMISSIONS} SELECT uf, {_COUNTS}, TRUE AS has_filename FROM adm GROUP BY uf",
)(
    lambda spark, sf: scan_store(spark, R.store(spark, sf, "sihsus"), "sihsus")
    .groupBy("uf")
    .agg(
        rows().alias("n"), F.count("munic_res").alias("munic_res"), F.count("dt_inter").alias("dt_inter"),
        F.bool_and(F.col("filename").contains(F.concat(F.lit("uf="), F.col("uf")))).alias("has_filename"),
    )
)
register(
    "src_02_scan_states",
    f"WITH {R.ADMISSIONS} SELECT uf, {_COUNTS} FROM adm WHERE uf IN ('SP', 'RJ') GROUP BY uf",
)(
    lambda spark, sf: _counts(
        scan_store(spark, R.store(spark, sf, "sihsus"), "sihsus", ufs=["sp", "RJ"], filename=False), "munic_res", "dt_inter"
    )
)


@register(
    "set_01_schema_drift",
    f"WITH {R.ADMISSIONS} SELECT uf, count(*) AS n, count(CASE WHEN uf < 'PB' THEN proc_rea END) AS early_only, "
    "count(CASE WHEN uf >= 'PB' THEN sexo END) AS late_only FROM adm GROUP BY uf",
)
def schema_drift(spark, sf):
    """Two halves of a store with different columns read back as one table by name."""
    root = scratch_dir(spark, "drift")
    typed = R.admissions(spark, sf)
    early, late = F.col("proc_rea").alias("early_only"), F.col("sexo").alias("late_only")
    write_store(typed.where("uf < 'PB'").select("uf", "source_file", early), root, "sihsus")
    write_store(typed.where("uf >= 'PB'").select("uf", "source_file", late), root, "sihsus")
    return _counts(scan_store(spark, root, "sihsus", merge_schema=True), "early_only", "late_only")


@register(
    "joi_01_registered_views",
    f"WITH {R.ADMISSIONS}, {R.DEATHS}, {R.MUNICIPALITIES} SELECT 'sihsus' AS system, count(*) AS n, "
    "count(m.nome_municipio) AS enriched FROM adm LEFT JOIN muni m ON adm.munic_res = m.codigo_municipio_6_digitos "
    "UNION ALL SELECT 'sim', count(*), count(m.nome_municipio) FROM dth LEFT JOIN muni m ON "
    "CASE WHEN codmunres >= 1000000 THEN codmunres // 10 ELSE codmunres END = m.codigo_municipio_6_digitos",
)
def registered_views(spark, sf):
    """Both enriched views of one session through SQL."""
    register_views(spark, R.store(spark, sf))
    return spark.sql(
        "SELECT 'sihsus' AS system, count(*) AS n, count(municipio_res) AS enriched FROM sihsus "
        "UNION ALL SELECT 'sim', count(*), count(municipio_res) FROM sim"
    )


# -- profiles and coverage of a store ---------------------------------------

register("prf_04_filename_stats", "SELECT 'filename' AS \"column\", CAST(100 AS DOUBLE) AS fill_pct, TRUE AS per_file")(
    lambda spark, sf: (lambda stored, files: P.filename_stats(stored).select(
        "column", "fill_pct", (F.col("distinct_count") == files.agg(rows()).scalar()).alias("per_file")
    ))(data_files(spark, R.store(spark, sf, "sihsus"), "sihsus"), scan_store(spark, R.store(spark, sf, "sihsus"), "sihsus").select("filename").distinct())
)


@register(
    "prf_03_stats_cache",
    "SELECT TRUE AS stale_before, TRUE AS fresh_after, TRUE AS stale_after_append, 2 AS saved, "
    "(SELECT count(*) FROM orders) AS row_count",
)
def stats_cache(spark, sf):
    """Statistics are computed once per state of the data files."""
    from sanitaria.operators import stats_cache as S

    root = scratch_dir(spark, "prf03")
    typed = R.admissions(spark, sf).select("uf", "source_file", "sexo")
    write_store(typed, root, "sihsus")
    before = S.fresh_stats(spark, root, "sihsus") is None
    S.cached_stats(spark, root, "sihsus")
    after = S.fresh_stats(spark, root, "sihsus") is not None
    row_count = S.cached_stats(spark, root, "sihsus").agg(F.max("row_count")).scalar()
    stored = spark.range(1).select(row_count.alias("row_count")).first()[0]
    write_store(typed, root, "sihsus")
    stale = S.fresh_stats(spark, root, "sihsus") is None
    S.cached_stats(spark, root, "sihsus")
    saved = S.saved_versions(spark, root, "sihsus")
    return spark.createDataFrame(
        [(before, after, stale, saved, stored)],
        "stale_before boolean, fresh_after boolean, stale_after_append boolean, saved int, row_count bigint",
    )


@register(
    "prf_08_dictionary",
    f"WITH {R.ADMISSIONS} SELECT 'sihsus' AS \"view\", 'munic_res' AS \"column\", 'int' AS type, "
    "CAST(round(100.0 * count(munic_res) / count(*), 2) AS DOUBLE) AS fill_pct FROM adm "
    "UNION ALL SELECT 'sihsus', 'municipio_res', 'string', CAST(round(100.0 * count(munic_res) / count(*), 2) AS DOUBLE) "
    "FROM adm UNION ALL SELECT 'sihsus', 'dt_inter', 'date', CAST(round(100.0 * count(dt_inter) / count(*), 2) AS DOUBLE) "
    "FROM adm UNION ALL SELECT 'sihsus', 'filename', 'string', CAST(100 AS DOUBLE)",
)
def dictionary(spark, sf):
    root = R.store(spark, sf)
    register_views(spark, root)
    stored = scan_store(spark, root, "sihsus")
    tree = P.dictionary(
        spark, "sihsus", P.column_stats(stored.select("munic_res", "dt_inter")), R.municipalities(spark, sf),
        P.filename_stats(data_files(spark, root, "sihsus")),
    )
    return tree.where(F.col("column").isin("munic_res", "municipio_res", "dt_inter", "filename")).select(
        "view", "column", "type", "fill_pct"
    )


@register(
    "cov_01_store_files",
    f"WITH {R.ADMISSIONS_RAW} SELECT uf, TRUE AS same_files, TRUE AS has_bytes FROM adm_raw GROUP BY uf",
)
def store_files(spark, sf):
    """The listing's file counts against the files that rows are read from."""
    stats = K.storage_stats(data_files(spark, R.store(spark, sf, "sihsus"), "sihsus"))
    read = scan_store(spark, R.store(spark, sf, "sihsus"), "sihsus").groupBy("uf").agg(F.countDistinct("filename").alias("read"))
    return stats.join(read, "uf").select(
        "uf", (F.col("files") == F.col("read")).alias("same_files"), (F.col("size_bytes") > 0).alias("has_bytes")
    )


# -- loads -------------------------------------------------------------------


_LANDED_SQL = f"""WITH {R.DEATHS} SELECT uf, source_file, count(*) AS n, count(codmunres) AS codmunres,
  count(dtobito) AS dtobito, count(causabas) AS causabas FROM dth GROUP BY uf, source_file"""


def _loaded(typed):
    return _counts(typed, "codmunres", "dtobito", "causabas", by=("uf", "source_file"))


@register("src_03_scan_landing", _LANDED_SQL)
def landing(spark, sf):
    """One delimited file per state and year, read in one scan and typed."""
    folder = write_named_files(V.deaths(spark, sf), scratch_dir(spark, "src03"), "csv")
    return _loaded(transform(scan_landing(spark, "sim", [f"{folder}/*"]), "sim"))


@register("src_04_scan_fixed_width", _LANDED_SQL)
def fixed_width(spark, sf):
    """The same rows as fixed-width record files."""
    folder = write_named_files(V.deaths(spark, sf), scratch_dir(spark, "src04"), "dbf")
    schema = T.StructType([*V.DEATH_FIELDS, T.StructField(FILE_COLUMN, T.StringType())])
    return _loaded(transform(scan_fixed_width(spark, "sim", folder, schema), "sim"))


@register(
    "str_01_available_now",
    f"WITH {R.DEATHS} SELECT 2 AS runs, (SELECT count(*) FROM dth) AS stored, "
    "(SELECT count(DISTINCT source_file) FROM dth) AS listed",
)
def available_now(spark, sf):
    """Stream all landing files into a store, restart the stream, and add nothing the second time."""
    folder = write_named_files(V.deaths(spark, sf), scratch_dir(spark, "str01_in"), "csv")
    root, checkpoint = (scratch_dir(spark, p) for p in ("str01_store", "str01_log"))
    for _ in range(2):
        start_ingest(spark, f"{folder}/*", root, "sim", checkpoint).awaitTermination()
    listed = M.listed_files(spark, root, "sim")
    stored = scan_store(spark, root, "sim")
    return stored.agg(rows().alias("stored")).select(
        F.lit(2).alias("runs"), "stored", listed.agg(rows()).scalar().alias("listed")
    )


@register(
    "str_01_pieces_in_batches",
    f"WITH {R.DEATHS} SELECT source_file, count(*) AS n, count(codmunres) AS codmunres, count(dtobito) AS dtobito, "
    "count(causabas) AS causabas, count(sexo) AS sexo FROM dth GROUP BY source_file",
)
def pieces_in_batches(spark, sf):
    """Files of one name in two folders, with their columns in two orders, streamed in small batches: all are kept."""
    place = scratch_dir(spark, "str01_pieces")
    deaths = V.deaths(spark, sf)
    moved = deaths.select(*reversed(deaths.columns), F.lit("x").alias("new_column"))
    half = F.col("idade") < F.lit("5")
    write_named_files(deaths.where(half), f"{place}/a", "csv")
    write_named_files(moved.where(~F.coalesce(half, F.lit(False))), f"{place}/b", "csv")
    root, checkpoint = (scratch_dir(spark, p) for p in ("str01_pieces_store", "str01_pieces_log"))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(place).count()
    start_ingest(spark, f"{place}/*/*", root, "sim", checkpoint, max_files=files // 2 + 1).awaitTermination()
    return _counts(scan_store(spark, root, "sim"), "codmunres", "dtobito", "causabas", "sexo", by=("source_file",))


@register(
    "src_03_drifting_headers",
    f"WITH {R.DEATHS} SELECT source_file, count(*) AS n, count(sexo) AS sexo, count(racacor) AS racacor, "
    "count(DISTINCT sexo) AS sexes FROM dth GROUP BY source_file",
)
def drifting_headers(spark, sf):
    """Two column orders and one column more, in one scan."""
    place = scratch_dir(spark, "src03_drift")
    deaths = V.deaths(spark, sf)
    early = F.col("source_file") < "DOPB"
    write_named_files(deaths.where(early), f"{place}/a", "csv")
    write_named_files(
        deaths.where(~early).select(*reversed(deaths.columns), F.lit("x").alias("new_column")), f"{place}/b", "csv"
    )
    typed = transform(scan_landing(spark, "sim", [place]), "sim")
    return typed.groupBy("source_file").agg(
        rows().alias("n"), F.count("sexo").alias("sexo"), F.count("racacor").alias("racacor"),
        F.countDistinct("sexo").alias("sexes"),
    )


@register(
    "snk_03_reload_changed_files",
    f"WITH {R.DEATHS} SELECT source_file, count(*) AS n, "
    "sum(CASE WHEN uf < 'PB' OR racacor = 'Branca' THEN 1 ELSE 0 END)::BIGINT AS branca FROM dth GROUP BY source_file",
)
def reload_changed_files(spark, sf):
    """All files, then those of the states before PB corrected: skipped at first, replaced by a reload."""
    root = scratch_dir(spark, "snk03r")
    raw = V.deaths(spark, sf)
    corrected = raw.where("uf < 'PB'").withColumn("racacor", F.lit("1"))
    load_batch(raw, root, "sim")
    if load_batch(corrected, root, "sim", batch=1):
        raise ValueError("listed files were loaded again")
    load_batch(corrected, root, "sim", batch=2, reload=True)
    return scan_store(spark, root, "sim").groupBy("source_file").agg(
        rows().alias("n"), F.count_if(F.col("racacor") == "Branca").alias("branca")
    )


@register(
    "cov_11_load_report",
    f"WITH {R.ADMISSIONS} SELECT 'sihsus' AS system, CAST(1 AS BIGINT) AS batch, count(DISTINCT source_file) AS files, "
    "count(*) AS rows FROM adm",
)
def report(spark, sf):
    root = scratch_dir(spark, "cov11")
    load_batch(V.admissions(spark, sf), root, "sihsus", batch=1, audit=True)
    return load_report(spark, root).where("lost_values > 0 AND bytes > 0 AND unplaced = 0").select(
        "system", "batch", "files", "rows"
    )


# -- exports -----------------------------------------------------------------

_EXPORT_SQL = f"""WITH {R.ADMISSIONS} SELECT uf, count(*) AS n, count(dt_inter) AS dt_inter,
  CAST(sum(dias_perm) AS BIGINT) AS days FROM adm GROUP BY uf"""
_EXPORT_SCHEMA = "uf string, source_file string, dt_inter date, diag_princ string, val_tot float, dias_perm smallint"


def _totals(df):
    return df.groupBy("uf").agg(rows().alias("n"), F.count("dt_inter").alias("dt_inter"), F.sum("dias_perm").alias("days"))


@register("snk_05_export_csv", _EXPORT_SQL)
def export_csv(spark, sf):
    path = scratch_dir(spark, "snk05")
    E.export_csv(R.admissions(spark, sf), path)
    return _totals(spark.read.csv(path, sep=";", header=True).withColumn("dias_perm", F.col("dias_perm").cast("smallint")))


@register("snk_06_export_json", _EXPORT_SQL)
def export_json(spark, sf):
    path = scratch_dir(spark, "snk06")
    E.export_json(R.admissions(spark, sf), path)
    return _totals(spark.read.schema(_EXPORT_SCHEMA).json(path))


_RANGE_SQL = """ FROM adm WHERE dt_inter BETWEEN DATE '2016-01-01' AND DATE '2017-12-31' GROUP BY """


@register(
    "snk_07_export_by_file",
    f"WITH {R.ADMISSIONS} SELECT source_file, source_file AS by_source_file, count(*) AS n{_RANGE_SQL}source_file",
)
def export_by_file(spark, sf):
    path = scratch_dir(spark, "snk07")
    E.export_by_partition(R.admissions(spark, sf), "sihsus", date(2016, 1, 1), date(2017, 12, 31), path, file_format="parquet")
    return spark.read.parquet(path).groupBy("source_file", "by_source_file").agg(rows().alias("n"))


@register("snk_07_export_by_state_csv", f"WITH {R.ADMISSIONS} SELECT uf, uf AS by_uf, count(*) AS n{_RANGE_SQL}uf")
def export_by_state(spark, sf):
    path = scratch_dir(spark, "snk07c")
    E.export_by_partition(R.admissions(spark, sf), "sihsus", "2016-01-01", "2017-12-31", path, partition_column="uf")
    return spark.read.csv(path, sep=";", header=True).groupBy("uf", "by_uf").agg(rows().alias("n"))


_ORDERS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")


def _literal_sql(name):
    text = f"CAST({name} AS VARCHAR)"
    if name in ("o_orderstatus", "o_orderdate", "o_orderpriority"):
        text = f"chr(39) || replace({text}, chr(39), repeat(chr(39), 2)) || chr(39)"
    return f"coalesce({text}, 'NULL')"


@register(
    "snk_08_export_inserts",
    f"SELECT 'INSERT INTO orders ({', '.join(_ORDERS)}) VALUES (' || "
    f"concat_ws(', ', {', '.join(map(_literal_sql, _ORDERS))}) || ');' AS statement FROM orders",
)
def export_inserts(spark, sf):
    path = scratch_dir(spark, "snk08")
    E.export_inserts(V.table(spark, sf, "orders"), "orders", path)
    return spark.read.text(path).select(F.col("value").alias("statement"))


@register("snk_09_export_row_cap", "SELECT least(count(*), 5000) AS n FROM orders")
def export_row_cap(spark, sf):
    path = scratch_dir(spark, "snk09")
    E.export_capped(spark, V.table(spark, sf, "orders"), path, max_rows=5000)
    return spark.read.csv(path, header=True).agg(rows().alias("n"))


@register(
    "snk_09_export_byte_cap",
    # One line is 7 digits and CRLF, 9 bytes; the header is 3 bytes and CRLF.
    "SELECT least(count(*), CAST(100 * ceil((20000 - 5) / 900.0) AS BIGINT)) AS n FROM lineitem",
)
def export_byte_cap(spark, sf):
    """Equal line lengths make the cut predictable: whole batches of 100 until 20,000 bytes are passed."""
    line = F.lpad(F.col("l_orderkey").cast("string"), 7, "1").alias("key")
    return E.capped_rows(V.table(spark, sf, "lineitem").select(line), max_bytes=20_000).agg(rows().alias("n"))


@register("snk_10_export_sample", "SELECT least(count(*), 1000) AS n FROM lineitem")
def export_sample(spark, sf):
    path = scratch_dir(spark, "snk10")
    E.export_sample(V.table(spark, sf, "lineitem"), path, 1000, seed=3)
    return spark.read.csv(path, sep=";", header=True).agg(rows().alias("n"))


def _summary_sql(name):
    return (
        f"SELECT '{name}' AS column_name, CAST(count(*) AS VARCHAR) AS count, CAST(min({name}) AS VARCHAR) AS min, "
        f"CAST(max({name}) AS VARCHAR) AS max, CAST(round((count(*) - count({name})) * 100.0 / count(*), 2) AS DOUBLE) "
        "AS null_percentage FROM orders"
    )


@register("snk_11_export_summary", " UNION ALL ".join(map(_summary_sql, _ORDERS)))
def export_summary(spark, sf):
    """Of the figures those that are exact; estimates and quartiles have queries of their own."""
    path = scratch_dir(spark, "snk11")
    E.export_summary(V.table(spark, sf, "orders"), path)
    found = spark.read.csv(path, sep=";", header=True)
    return found.select("column_name", "count", "min", "max", F.col("null_percentage").cast("double"))


# -- dimensions --------------------------------------------------------------


@register(
    "src_05_register_csv",
    "SELECT c_custkey, c_name, CAST(c_nationkey AS INTEGER) AS c_nationkey, c_mktsegment FROM customer",
)
def register_csv(spark, sf):
    path = scratch_dir(spark, "src05")
    E.export_csv(V.table(spark, sf, "customer"), path)
    view = D.register_csv(spark, path, "check_customer")
    return view.select(F.col("c_custkey").cast("bigint"), "c_name", "c_nationkey", "c_mktsegment")


@register(
    "src_06_load_dimension",
    "SELECT c_mktsegment, 2 * count(*) AS n FROM customer GROUP BY c_mktsegment",
)
def load_dimension(spark, sf):
    """Replace, then append: every row of the file is in the table twice."""
    path, location, name = scratch_dir(spark, "src06"), scratch_dir(spark, "src06_table"), "check_dimension"
    E.export_csv(V.table(spark, sf, "customer"), path)
    for replace in (True, False):
        D.load_dimension(spark, name, path, replace=replace, location=location)
    spark.sql(f"DROP TABLE {name}")
    return spark.read.parquet(location).groupBy("c_mktsegment").agg(rows().alias("n"))


@register(
    "cov_06_dimension_status",
    "SELECT 'check_status' AS dimension, count(*) AS row_count, count(*) > 0 AS loaded FROM customer "
    "UNION ALL SELECT 'check_absent', CAST(-1 AS BIGINT), FALSE",
)
def dimension_status(spark, sf):
    path, location = scratch_dir(spark, "cov06"), scratch_dir(spark, "cov06_table")
    E.export_csv(V.table(spark, sf, "customer"), path)
    D.load_dimension(spark, "check_status", path, location=location)
    status = D.dimension_status(spark, ("check_status", "check_absent"))
    spark.sql("DROP TABLE check_status")
    return status


@register("snk_12_copy_range", f"WITH {R.ADMISSIONS} SELECT uf, count(*) AS n{_RANGE_SQL}uf")
def copy_range(spark, sf):
    location = scratch_dir(spark, "snk12")
    E.copy_range(
        R.admissions(spark, sf), "sihsus", "2016-01-01", "2017-12-31", "check_copy", path=location
    )
    spark.sql("DROP TABLE check_copy")
    return spark.read.parquet(location).groupBy("uf").agg(rows().alias("n"))


register(
    "cov_02_store_overview",
    f"WITH {R.DEATH_FILES} SELECT 'sim' AS system, count(*) AS files, min(printf('%04d-01', year)) AS first_period, "
    "max(printf('%04d-01', year)) AS last_period, (SELECT count(*) FROM orders) AS row_count FROM files",
)(
    lambda spark, sf: K.overview(
        with_period(V.death_inventory(spark, sf), "sim"), "sim", R.deaths(spark, sf)
    ).select("system", "files", "first_period", "last_period", "row_count")
)
