"""SQL access: the plan, customer and state data as temp views, so joins,
groupings and rankings can be written in SQL over them.

Text keys and numbers are converted with ``try_cast`` when the views are
made (customer id to int, age to double), so SQL that compares the customer
id with an int plan column, or averages the age, never fails on a bad value
under ANSI mode.  The cleaner and protocol functions are registered for SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowforge.functions.sql import register_sql_functions
from rowforge.plans.insurance import customers_and_states, insure_view


def register_views(spark: SparkSession, plans: DataFrame, custs_states_ragged: DataFrame,
                   names: tuple[str, str, str] = ("insureview", "custview", "statesview")) -> None:
    """``plans``: the typed plan table; ``custs_states_ragged``: the mixed
    customer/state file read as 5 string columns."""
    custs, states = customers_and_states(custs_states_ragged)
    custs = custs.withColumns({"Id": F.col("Id").try_cast("int"),
                               "Age": F.col("Age").try_cast("double")})
    insure_view(plans).createOrReplaceTempView(names[0])
    custs.createOrReplaceTempView(names[1])
    states.createOrReplaceTempView(names[2])
    register_sql_functions(spark)
