"""Small series made up for these tests."""

import datetime as dt

IPCA = [1.25, 0.5, 2.0, 1.75, 0.25, -0.5, 1.0, 0.75, 1.5, 2.25, 0.1, 3.0]
SELIC = [20.0, 19.5, 19.0, 19.0, 18.0, 17.5, 17.0, 16.0, 16.0, 15.5, 15.0, 14.0]
PIB = [10.0, 12.5, 8.0, 11.0]
CAMBIO = [2.0, 2.5, 2.25, 3.0, 2.75, 2.5, 3.25, 3.5, 3.0, 2.8, 3.2, 4.0]
UNEMPLOYMENT = [6.0, 7.5, 5.0, 4.0]
IPCA_YEAR = [9.0, 8.5, 9.5, 10.0, 7.0, 6.5, 6.0, 7.5, 8.0, 9.25, 9.75, 11.0]
CAMBIO_VOLATILITY = [0.5, 0.25, 0.75, 0.5, 0.3, 0.2, 0.6, 0.9, 0.4, 0.35, 0.45, 0.8]


def month_starts(n, step=1):
    return [dt.date(2023, 1 + i * step, 1) for i in range(n)]


def bronze(spark, name, values, step=1):
    dates = month_starts(len(values), step)
    return spark.createDataFrame(
        [(d, v, name) for d, v in zip(dates, values)], f"data date, {name} double, indicator string")


def silver(spark, name, values, step=1, **extra):
    columns = ["date", "value", "indicator_name", "unit", *extra]
    data = [(d, v, name.upper(), "%", *(extra[c][i] for c in extra))
            for i, (d, v) in enumerate(zip(month_starts(len(values), step), values))]
    types = "date date, value double, indicator_name string, unit string" + "".join(
        f", {c} double" for c in extra)
    return spark.createDataFrame(data, types).select(*columns)
