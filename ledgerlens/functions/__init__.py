"""Column-level expressions; everything here compiles to native Spark SQL expressions."""

from ledgerlens.functions.risk import off_hours, planar_distance, velocity
from ledgerlens.functions.sampling import hash_bucket
from ledgerlens.functions.time import epoch_micros

__all__ = ["epoch_micros", "hash_bucket", "off_hours", "planar_distance", "velocity"]
