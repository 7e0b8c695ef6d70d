"""Small source tables with the edge rows a load must cope with."""

import datetime as dt
from decimal import Decimal as D

from starloom import schemas as S
from starloom.sources import with_audit

RUN = dt.datetime(2024, 1, 1)


def d(year, month=1, day=1):
    return dt.date(year, month, day)


ACCOUNT = [
    (1, 10, " poplatek mesicne ", d(1995, 3, 24)), (1, 10, " poplatek mesicne ", d(1995, 3, 24)),
    (2, None, "POPLATEK TYDNE", d(1990, 1, 1)), (3, 99, "Poplatek po obratu", None),
    (4, 20, "nothing known", d(1999, 1, 1)), (5, 20, None, d(1989, 1, 1)), (None, 20, "x", d(1995)),
    (6, 10, "POPLATEK TYDNE", d(1994, 6, 30)), (7, 30, "  ", d(1998, 12, 31)),
]
DISTRICT = [
    (10, "  Praha ", "Prague", 1204953, D("12541.50"), D("0.29"), D("0.43"), 167, 85677, 99107),
    (20, "   ", None, 42821, D("8173.49"), D("1.67"), None, 124, 1358, None),
    (30, "Benesov", " Bohemia", 88884, None, None, None, None, None, None),
    (30, "Benesov", " Bohemia", 88884, None, None, None, None, None, None),
]
CLIENT = [
    (1, d(1970, 12, 13), 10), (2, d(1945, 2, 4), None), (3, None, 99), (4, d(1956, 12, 1), 20),
]
DISP = [
    (5, 1, 1, "DISPONENT"), (6, 1, 2, "owner "), (7, 1, 4, "OWNER"), (8, 2, 2, "x"), (9, 3, 3, "Disponent"),
]
LOAN = [
    (1, 1, d(1997, 1, 5), D("1000.00"), 12, D("90.00"), " a "), (2, 2, d(1996, 2, 1), D("500.00"), 24, D("25.50"), "B"),
    (3, 99, d(1998, 3, 1), D("100.00"), 12, D("9.00"), "C"), (4, 4, None, D("100.00"), 12, D("9.00"), "D"),
    (5, 5, d(2001, 1, 1), D("100.00"), 12, D("9.00"), "d"), (6, 1, d(1997, 1, 1), D("0.00"), 12, D("9.00"), "A"),
    (7, 1, d(1997, 1, 1), D("10.00"), 0, D("9.00"), "A"), (8, 1, d(1997, 1, 1), D("10.00"), 12, D("-1.00"), "A"),
    (9, 6, d(1997, 1, 1), D("10.00"), 12, D("1.00"), "Q"), (10, 7, d(1997, 1, 1), D("10.00"), 12, D("1.00"), "  "),
    (11, 3, d(1997, 1, 1), D("10.00"), 12, D("1.00"), None),
]
TRANS = [
    (1, 1, d(1997, 1, 5), " prijem", "vklad", D("100.00"), D("100.00"), "sipo"),
    (1, 1, d(1997, 1, 5), " prijem", "vklad", D("100.00"), D("100.00"), "sipo"),
    (2, 1, d(1997, 1, 6), "VYDAJ", " vyber kartou", D("30.00"), None, None),
    (3, 2, d(1997, 2, 6), "VYBER", "", D("5.50"), D("1.00"), " "),
    (4, 4, d(1997, 2, 7), "other", "akreditiv", D("7.00"), D("1.00"), None),
    (5, 99, d(1997, 2, 7), "PRIJEM", None, D("7.00"), D("1.00"), None),
    (6, 1, None, "PRIJEM", None, D("7.00"), D("1.00"), None),
    (7, 1, d(1997, 2, 7), "PRIJEM", None, None, D("1.00"), None),
    (8, 5, d(2001, 2, 7), "PRIJEM", None, D("8.00"), D("1.00"), None),
    (9, 3, d(1997, 2, 8), None, None, D("9.00"), None, None),
]


def sources(spark):
    frames = {
        "account": (ACCOUNT, S.ACCOUNT), "district": (DISTRICT, S.DISTRICT), "client": (CLIENT, S.CLIENT),
        "disp": (DISP, S.DISP), "loan": (LOAN, S.LOAN), "trans": (TRANS, S.TRANS),
    }
    return {name: spark.createDataFrame(data, schema) for name, (data, schema) in frames.items()}


def staged(spark):
    return {name: with_audit(df, RUN) for name, df in sources(spark).items()}
