from datetime import date

from twinloom.operators.generate import generate_table, generate_tables
from twinloom.plans.spec import read_tables

AS_OF = date(2025, 6, 30)


def col(name, kind, output=None, **constraints):
    spec = {"name": name, "generator_data_type": kind, "constraints": constraints}
    return spec | ({"output_data_type": output} if output else {})


def ref(name, table, column, cardinality="ONE_TO_MANY", **constraints):
    link = {"table_name": table, "column_name": column, "cardinality": cardinality}
    return {"name": name, "reference": link, "constraints": constraints}


def table(name, rows, *columns):
    return {"table_name": name, "total_rows": rows, "columns": list(columns)}


def specs(*tables):
    return read_tables(list(tables), AS_OF)


def build(spark, *tables, seed=1, **options):
    return generate_tables(spark, specs(*tables), seed, **options)


def values(spark, rows, kind, output=None, seed=1, **constraints):
    """The values of a single generated column, in row order."""
    spec = specs(table("t", rows, col("v", kind, output, **constraints)))[0]
    return [row.v for row in generate_table(spark, spec, seed).collect()]
