"""Writers: landed CSV (K1), CSV exports (K2/K3), staging loads (K4/K5), catalog tables
(K6/K7) and snapshot replacement of merged tables."""

from geomedallion.sinks.tables import *  # noqa: F401,F403
