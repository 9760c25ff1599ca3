"""Column expressions. Everything here returns a ``pyspark.sql.Column`` built from
``pyspark.sql.functions`` so it stays inside whole-stage codegen; nothing is a Python UDF."""

from geomedallion.functions.columns import *  # noqa: F401,F403
from geomedallion.functions.geo import *  # noqa: F401,F403
from geomedallion.functions.nested import *  # noqa: F401,F403
