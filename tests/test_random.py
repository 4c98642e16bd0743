"""Random raw text through Spark and through the checking SQL."""

import random

import pytest
from pyspark.sql import functions as F

from checks import registry as R
from sanitaria.functions import columns as C

ALPHABETS = {
    "digits": "0123456789",
    "dates": "0123456789-",
    "codes": "AaJjZ019./* ",
    "mixed": "aB1 \t\n\r\x0c.,é\xa0 ",
    "numbers": "0123456789.-+e",
}


def texts(kind, n=3000):
    rng = random.Random(kind)
    made = {"".join(rng.choice(ALPHABETS[kind]) for _ in range(rng.randint(0, 10))) for _ in range(n)}
    if kind in ("digits", "dates"):
        for _ in range(n):
            y, m, d = rng.randint(1890, 2030), rng.randint(0, 14), rng.randint(0, 33)
            made.add(rng.choice([f"{y:04d}{m:02d}{d:02d}", f"{d:02d}{m:02d}{y:04d}", f"{d % 10}{m:02d}{y:04d}", f"{y:04d}-{m:02d}-{d:02d}"]))
    return sorted(made)


RULES = [
    ("mixed", C.clean, R.sql_clean("v")),
    ("codes", C.diagnosis_code, R.sql_code("v")),
    ("codes", C.diagnosis_list, R.sql_codes("v")),
    ("digits", C.parse_date, R.sql_date("v")),
    ("dates", C.parse_date, R.sql_date("v")),
    ("digits", lambda c: C.to_integer(c, "tinyint"), "TRY_CAST(v AS TINYINT)"),
    ("digits", lambda c: C.to_integer(c, "int"), "TRY_CAST(v AS INTEGER)"),
    ("digits", C.age_value, R.SQL_AGE_VALUE.replace("idade", "v")),
    ("digits", C.age_unit, R.SQL_AGE_UNIT.replace("idade", "v")),
    ("digits", C.parse_time, R.SQL_TIME.replace("horaobito", "v")),
]


@pytest.mark.parametrize("at", range(len(RULES)))
def test_same_as_sql(spark, at):
    import duckdb
    import pandas as pd

    kind, rule, sql = RULES[at]
    values = pd.DataFrame({"v": texts(kind)})
    ours = {r.v: r.out for r in spark.createDataFrame(values).select("v", rule(F.col("v")).alias("out")).collect()}
    connection = duckdb.connect()
    connection.execute("CREATE TABLE t (v VARCHAR)")
    connection.executemany("INSERT INTO t VALUES (?)", [[v] for v in values["v"]])
    theirs = dict(connection.execute(f"SELECT v, {sql} FROM t").fetchall())
    differing = {v: (ours[v], theirs[v]) for v in ours if ours[v] != theirs[v]}
    assert not differing, list(differing.items())[:10]
