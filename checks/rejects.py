"""Landing files with lines that are no rows: every line is accepted or rejected, and counted."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import registry as R
from checks import views as V
from checks.landing_files import write_named_files
from checks.registry import register
from sanitaria.session import scratch_dir
from sanitaria.sources.store import scan_store
from sanitaria.streaming.ingest import load_files, load_report, rejected_lines

_MARK = "right(idade, 1)"


def _loaded(spark, sf, purpose):
    """A store of all deaths, loaded from files with ragged and undecodable lines."""
    root = scratch_dir(spark, purpose)
    folder = write_named_files(V.deaths(spark, sf), f"{root}/landing", "ragged")
    load_files(spark, root, "sim", [f"{folder}/*"])
    return root


@register(
    "cov_11_rejects",
    f"""WITH {R.DEATHS_RAW} SELECT source_file, count(*) AS lines,
      count(*) FILTER (coalesce({_MARK}, '') NOT IN ('3', '7', '9')) AS accepted,
      count(*) FILTER ({_MARK} IN ('3', '7')) AS bad_fields, count(*) FILTER ({_MARK} = '9') AS bad_bytes
      FROM dth_raw GROUP BY source_file""",
)
def rejects(spark, sf):
    """Stored rows and kept rejects of every file, together all its lines."""
    root = _loaded(spark, sf, "cov11r")
    stored = scan_store(spark, root, "sim").groupBy("source_file").agg(F.count("*").alias("accepted"))
    bad = rejected_lines(spark, root, "sim").groupBy("source_file").agg(
        F.count_if(F.col("reason") == "fields").alias("bad_fields"), F.count_if(F.col("reason") == "bytes").alias("bad_bytes")
    )
    none = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return stored.join(bad, "source_file", "full").select(
        "source_file", (none("accepted") + none("bad_fields") + none("bad_bytes")).alias("lines"),
        none("accepted"), none("bad_fields"), none("bad_bytes"),
    )


@register(
    "cov_11_rejects_report",
    f"""WITH {R.DEATHS_RAW} SELECT count(DISTINCT source_file) AS files,
      count(*) FILTER (coalesce({_MARK}, '') NOT IN ('3', '7', '9')) AS rows,
      count(*) FILTER ({_MARK} IN ('3', '7', '9')) AS rejected, CAST(0 AS BIGINT) AS failed FROM dth_raw""",
)
def rejects_report(spark, sf):
    """What the report of that load says; landing files of one name are pieces of one file."""
    root = _loaded(spark, sf, "cov11s")
    names = scan_store(spark, root, "sim").select("source_file").union(rejected_lines(spark, root, "sim").select("source_file"))
    names = names.distinct().count()
    return load_report(spark, root).select(F.lit(names).cast("bigint").alias("files"), "rows", "rejected", "failed")
