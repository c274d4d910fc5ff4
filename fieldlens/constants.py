"""Fixed values of the domain: band names, scene classes, targets, map zone."""

# --- fixed values -----------------------------------------------------------
BANDS_10M = ("B02_10m", "B03_10m", "B04_10m", "B08_10m", "TCI_10m")
BANDS_20M = (
    "B02_20m", "B03_20m", "B04_20m", "B05_20m", "B06_20m", "B07_20m",
    "B8A_20m", "B11_20m", "B12_20m", "SCL_20m", "TCI_20m",
)
BANDS_60M = (
    "B01_60m", "B02_60m", "B03_60m", "B04_60m", "B05_60m", "B06_60m",
    "B07_60m", "B8A_60m", "B09_60m", "B11_60m", "B12_60m", "SCL_60m",
)
ALL_BANDS = BANDS_10M + BANDS_20M + BANDS_60M

# bands shown in the per-field summaries
SUMMARY_BANDS = ("TCI_20m", "SCL_20m", "TCI_10m", "SCL_60m")
# bands that carry no reflectance and are dropped before analysis
NON_ANALYSIS_BANDS = ("SCL_20m", "SCL_60m", "TCI_10m", "TCI_20m")
ANALYSIS_BANDS = tuple(b for b in ALL_BANDS if b not in NON_ANALYSIS_BANDS)
# bands of the exhaustive band search, in search order
SEARCH_BANDS = (
    "B08_10m", "B02_10m", "B04_10m", "B03_10m", "B03_20m", "B04_20m",
    "B05_20m", "B06_20m", "B07_20m", "B8A_20m", "B11_20m", "B12_20m",
)
# bands of the classifier comparison
QUICKLOOK_BANDS = ("B08_10m", "B02_10m", "B04_10m", "B03_10m")
HISTOGRAM_BANDS = ("B02_10m", "B03_10m", "B04_10m", "B08_10m")

# scene classification: medium cloud, high cloud, thin cirrus, defective, cloud shadow
NOT_CLEAR_CLASSES = (8, 9, 10, 1, 3)
# the narrower set behind the cloud alert label
CLOUD_CLASSES = (8, 9, 10)
CLOUD_ALERT = "Cloudy"

TARGETS = ("carbon_rating", "nitrogen_rating", "potassium_rating", "phosphorus_rating")

GRANULES = ("T43PFS", "T43PGS")
PLATFORM = "Sentinel-2"
PROCESSING_LEVEL = "Level-2A"

# sheet header (after cleaning) -> canonical column
SOIL_RENAMES = {
    "field_ids": "field_id",
    "o.c._(1_=_low;_2_=_med;_3_=_high)": "carbon_rating",
    "n(1_=_low;_2_=_med;_3_=_high)": "nitrogen_rating",
    "p_(1_=_low;_5_=_high)": "phosphorus_rating",
    "k_(1_=_low;_2_=_med;_3_=_high)": "potassium_rating",
}
# columns that are read of the two kinds of field sheets
FIELD_SHEET_COLUMNS = ("field_id", "farm_name", "field_boundary", "Date of survey")
GNUM_SHEET_COLUMNS = ("Sl.No", "Farmer name", "Date of survey")
GNUM_RENAMES = {"Sl.No": "field_id", "Farmer name": "farm_name"}

# WGS84 ellipsoid and UTM zone 43 N
SEMI_MAJOR_AXIS = 6378137.0
FLATTENING = 1.0 / 298.257223563
CENTRAL_MERIDIAN = 75.0
SCALE_FACTOR = 0.9996
FALSE_EASTING = 500000.0

SCORE_COLUMNS = ("scores_stratified_KFold", "scores_cross_val", "accuracy_score")
# --- end of fixed values ----------------------------------------------------


def resolution(band):
    """Pixel size in metres, read off the band's suffix."""
    return int(band.rsplit("_", 1)[1].removesuffix("m"))
