"""tessera: table-in / table-out preparation and modelling operators on Spark.

Every public operator takes a DataFrame plus column roles and returns a
DataFrame.  Work stays inside Spark SQL expressions, joins, windows and
Spark ML; nothing data-sized is collected to the driver.
"""

from tessera.roles import Roles
from tessera.session import get_session, checkpoint_dir

__all__ = ["Roles", "get_session", "checkpoint_dir"]
