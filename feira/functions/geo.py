from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean Earth radius in km.
EARTH_RADIUS_KM = 6371.0


def haversine_km(lat1, lng1, lat2, lng2) -> Column:
    """Great-circle distance in km between two points given in degrees.

    The sine term is held at 1 so that rounding at opposite points cannot push
    ``asin`` out of its domain. Any null coordinate gives null.
    """
    phi1, phi2 = F.radians(lat1), F.radians(lat2)
    half_dphi = (phi2 - phi1) / 2
    half_dlambda = (F.radians(lng2) - F.radians(lng1)) / 2
    term = F.pow(F.sin(half_dphi), 2) + F.cos(phi1) * F.cos(phi2) * F.pow(F.sin(half_dlambda), 2)
    # least() skips nulls, so the null has to be kept by hand
    held = F.when(term.isNotNull(), F.least(term, F.lit(1.0)))
    return 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(held))
