"""Every decoder on hand-made values."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from sanitaria.functions import columns as C
from sanitaria.functions import filenames as N
from sanitaria.systems import DEATH, HOSPITAL



def shown(period):
    parts = [F.coalesce(period[p].cast("string"), F.lit("-")) for p in ("uf", "year", "month", "revision")]
    return F.when(period.isNotNull(), F.concat_ws(",", *parts))


CASES = {
    "clean": (C.clean, {
        " a\tb\n": "ab", "\0": None, "  ": None, None: None, "\xa0 x  ": "x", "a b": "a b", "\x0c": None,
        "é\r": "é",
    }),
    "clean_upper": (C.clean_upper, {" a\tb\0": "A B", "\n": "", None: None, "straße": "STRAẞE"}),
    "date": (C.parse_date, {
        "20200131": date(2020, 1, 31), "31012020": date(2020, 1, 31), "2020-01-31": date(2020, 1, 31),
        "1012023": date(2023, 1, 1), "3112023": date(2023, 11, 3), "9052023": date(2023, 5, 9),
        "20230230": None, "20991231": None, "abc": None, "2020": None, "2020-01": None, None: None, "": None,
        "2020/1/5": date(2020, 1, 5), "2020-01-31 10:00:00": date(2020, 1, 31), "00000000": None, "29022019": None,
        "29022020": date(2020, 2, 29), "20201301": None,
    }),
    "any date": (lambda c: C.parse_date(c, allow_future=True), {"20991231": date(2099, 12, 31), "31122099": date(2099, 12, 31)}),
    "tinyint": (lambda c: C.to_integer(c, "tinyint"), {
        "3.7": 4, "300": None, "045": 45, "-3": -3, "abc": None, None: None, "2.5": 3, "1e2": 100, "-128": -128,
        "128": None, "1,5": None, "99999999999999999999": None,
    }),
    "integer": (lambda c: C.to_integer(c, "int"), {"1e2": 100, "2.5": 3, "-2.5": -3, "+7": 7, "2147483648": None}),
    "unsigned": (lambda c: C.to_integer(c, "int", 65535), {"65535": 65535, "65536": None, "-1": None}),
    "float": (C.to_float, {"1,5": None, "1.5": 1.5, "12d": None, "12f": None, ".5": 0.5, "1e3": 1000.0, "x": None}),
    "boolean": (C.to_boolean, {"1": True, "true": True, "TRUE": True, "0": False, "FALSE": False, "2": None, None: None}),
    "acidtrab": (lambda c: C.to_boolean(c, *DEATH.booleans["acidtrab"]), {"1": True, "2": False, "9": None}),
    "tppos": (lambda c: C.to_boolean(c, *DEATH.booleans["tppos"]), {"S": True, "N": False, "1": True, "2": False}),
    "time": (C.parse_time, {
        "0905": "09:05:00", "09:05": "09:05:00", "2510": None, "905": None, "2359": "23:59:00", "0960": None, "ab:cd": None,
    }),
    "code": (C.diagnosis_code, {
        "j18.0": "J180", "A1": None, "A1234": None, "123": None, "J18": "J18", None: None, "J18\n": None,
    }),
    "codes": (C.diagnosis_list, {
        "*A01*J128": ["A01", "J128"], "A001/I12*H890": ["A001", "I12", "H890"], "*": None, "J18.0": None,
        None: None, " a01 ": ["A01"], "x*B20": ["B20"],
    }),
    "sex hospital": (lambda c: C.recode(c, HOSPITAL.sex, HOSPITAL.sex_default), {
        "0": "I", "1": "M", "3": "F", "2": None, "M": None, None: None,
    }),
    "sex death": (lambda c: C.recode(c, DEATH.sex, DEATH.sex_default), {"1": "M", "F": "F", "9": "I", None: "I", "X": "I"}),
    "race hospital": (lambda c: C.recode(c, HOSPITAL.race, "Ignorado"), {"03": "Parda", "04": "Amarela", "3": "Ignorado"}),
    "race death": (lambda c: C.recode(c, DEATH.race, "Ignorado"), {"3": "Amarela", "4": "Parda", None: "Ignorado"}),
    "age value": (C.age_value, {
        "401": 1, "311": 11, "505": 105, "999": None, "012": None, "40": None, None: None, "4ab": None,
    }),
    "age unit": (C.age_unit, {
        "401": "anos", "311": "meses", "505": "anos", "999": "ignorado", "012": None, "40": None, "130": "minutos",
        "215": "horas",
    }),
    "hospital name": (lambda c: shown(N.hospital_period(c)), {
        "RDSP2301.dbc": "SP,2023,1,-", "RDSP9912.dbc": "SP,1999,12,-", "RDSP2313.dbc": None, "INVALID.dbc": None,
        "RD.dbc": None, "DOSP2023.dbc": None, "RDSP9201.DBC": "SP,1992,1,-", "RDSP9101.dbc": "SP,2091,1,-",
    }),
    "death name": (lambda c: shown(N.death_period(c)), {
        "DORJ2023.dbc": "RJ,2023,-,CID10", "DORSP80.dbc": "SP,1980,-,CID9", "DOSP1995.dbc": None,
        "DORSP96.dbc": None, "RDSP2023.dbc": None, "dosp2023.dbc": "SP,2023,-,CID10",
    }),
    "default name": (lambda c: shown(N.default_period(c, "PA")), {
        "PASP4912.dbc": "SP,2049,12,-", "PASP5001.dbc": "SP,1950,1,-", "PASP4900.dbc": None,
    }),
}


@pytest.mark.parametrize("name", CASES)
def test_decoder(spark, name):
    rule, expected = CASES[name]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(expected)], "i int, v string")
    got = [r.out for r in rows.select("i", rule(F.col("v")).alias("out")).orderBy("i").collect()]
    assert dict(zip(expected, got)) == expected


def test_six_digit_municipality(spark):
    rows = spark.createDataFrame([(355030,), (3550308,), (None,)], "v int")
    got = [r[0] for r in rows.select(C.six_digit_municipality(F.col("v"))).collect()]
    assert got == [355030, 355030, None]


def test_age_in_years(spark):
    rows = spark.createDataFrame(
        [(30, "anos"), (11, "meses"), (None, "ignorado"), (5, None)], "v smallint, u string"
    )
    assert [r[0] for r in rows.select(C.age_in_years(F.col("v"), F.col("u"))).collect()] == [30, 0, None, None]
