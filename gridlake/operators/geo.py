"""Approximate respondent coordinates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values: respondent code, latitude, longitude, label ----------------

COORDINATES = (
    ("AECI", 37.2089, -93.2923, "AECI"),
    ("AVA", 47.6588, -117.4260, "Avista"),
    ("AZPS", 33.4484, -112.0740, "APS"),
    ("BANC", 38.5816, -121.4944, "BANC"),
    ("BPAT", 45.5152, -122.6784, "BPA"),
    ("CAL", 38.5816, -121.4944, "California"),
    ("CAR", 35.2271, -80.8431, "Carolinas"),
    ("CENT", 39.0997, -94.5786, "Central"),
    ("CHPD", 47.4235, -120.3103, "Chelan PUD"),
    ("CISO", 38.5816, -121.4944, "CAISO"),
    ("CPLE", 35.7796, -78.6382, "Duke Progress East"),
    ("CPLW", 35.5951, -82.5515, "Duke Progress West"),
    ("DOPD", 47.4157, -120.2931, "Douglas PUD"),
    ("DUK", 35.2271, -80.8431, "Duke"),
    ("EPE", 31.7619, -106.4850, "El Paso Electric"),
    ("ERCO", 30.2672, -97.7431, "ERCOT"),
    ("FLA", 28.5383, -81.3792, "Florida"),
    ("FMPP", 28.5383, -81.3792, "FMPP"),
    ("FPC", 27.9506, -82.4572, "Duke Florida"),
    ("FPL", 26.8468, -80.0870, "FPL"),
    ("GCPD", 47.3174, -119.5533, "Grant PUD"),
    ("GVL", 29.6516, -82.3248, "Gainesville"),
    ("HST", 25.4687, -80.4776, "Homestead"),
    ("IID", 32.7920, -115.5631, "Imperial Irrigation"),
    ("IPCO", 43.6150, -116.2023, "Idaho Power"),
    ("ISNE", 42.3601, -71.0589, "ISO-NE"),
    ("JEA", 30.3322, -81.6557, "JEA"),
    ("LDWP", 34.0522, -118.2437, "LADWP"),
    ("LGEE", 38.2527, -85.7585, "LG&E/KU"),
    ("MIDA", 39.9526, -75.1652, "Mid-Atlantic"),
    ("MIDW", 41.8781, -87.6298, "Midwest"),
    ("MISO", 39.9784, -86.1180, "MISO"),
    ("NE", 42.3601, -71.0589, "New England"),
    ("NEVP", 36.1699, -115.1398, "Nevada Power"),
    ("NW", 45.5152, -122.6784, "Northwest"),
    ("NWMT", 45.7833, -108.5007, "NorthWestern"),
    ("NY", 42.6526, -73.7562, "New York"),
    ("NYIS", 42.6526, -73.7562, "NYISO"),
    ("PACE", 40.7608, -111.8910, "PacifiCorp East"),
    ("PACW", 45.5152, -122.6784, "PacifiCorp West"),
    ("PGE", 45.5152, -122.6784, "Portland General"),
    ("PJM", 39.9526, -75.1652, "PJM"),
    ("PNM", 35.0844, -106.6504, "PNM"),
    ("PSCO", 39.7392, -104.9903, "PSCo"),
    ("PSEI", 47.6101, -122.2015, "Puget Sound Energy"),
    ("SC", 34.0007, -81.0348, "South Carolina"),
    ("SCEG", 34.0007, -81.0348, "Dominion South Carolina"),
    ("SCL", 47.6062, -122.3321, "Seattle City Light"),
    ("SE", 33.7490, -84.3880, "Southeast"),
    ("SEC", 27.9506, -82.4572, "Seminole Electric"),
    ("SOCO", 33.5186, -86.8104, "Southern"),
    ("SPA", 36.1540, -95.9928, "Southwestern Power"),
    ("SRP", 33.4484, -112.0740, "SRP"),
    ("SW", 35.0844, -106.6504, "Southwest"),
    ("SWPP", 34.7465, -92.2896, "SPP"),
    ("TAL", 30.4383, -84.2807, "Tallahassee"),
    ("TEC", 27.9506, -82.4572, "Tampa Electric"),
    ("TEN", 36.1627, -86.7816, "Tennessee"),
    ("TEPC", 32.2226, -110.9747, "TEP"),
    ("TEX", 31.9686, -99.9018, "Texas"),
    ("TIDC", 37.4947, -120.8466, "Turlock Irrigation"),
    ("TPWR", 47.2529, -122.4443, "Tacoma Power"),
    ("TVA", 35.9606, -83.9207, "TVA"),
    ("US48", 39.8283, -98.5795, "Lower 48"),
    ("WACM", 40.3978, -105.0749, "WAPA Rocky Mountain"),
    ("WALC", 33.4484, -112.0740, "WAPA Desert Southwest"),
    ("WAUW", 44.3633, -98.2143, "WAPA Upper Great Plains"),
)


def with_coordinates(df: DataFrame, measured: str) -> DataFrame:
    """Rows with a known location and a value in ``measured``.

    The lookup is the constant table above, so broadcasting it is safe.
    """
    places = df.sparkSession.createDataFrame(
        list(COORDINATES), "respondent string, lat double, lon double, location_label string"
    )
    return df.filter(F.col(measured).isNotNull()).join(F.broadcast(places), "respondent")
