"""Small fact tables for the unit tests."""

from runwaylens.schema import FACT_COLUMNS, FACT_SCHEMA


def facts(spark, *rows):
    """Fact rows given as dicts; columns left out are NULL."""
    defaults = {"cancelled": 0.0, "year": 2024}
    filled = [tuple((defaults | r).get(c) for c in FACT_COLUMNS) for r in rows]
    return spark.createDataFrame(filled, FACT_SCHEMA)


def raw(spark, *rows):
    schema = ", ".join(f"{c} string" for c in FACT_COLUMNS)
    return spark.createDataFrame([tuple(r.get(c) for c in FACT_COLUMNS) for r in rows], schema)


def flight(carrier="AA", origin="JFK", month=1, dep=None, arr=None, **more):
    row = {"op_unique_carrier": carrier, "origin": origin, "month": month, "dep_delay": dep, "arr_delay": arr}
    row = {k: float(v) if k.endswith("_delay") and v is not None else v for k, v in row.items()}
    return row | more


def rows(df):
    return [tuple(r) for r in df.collect()]
