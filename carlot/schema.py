"""Column names, schemas and fixed values of the listing tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Wire columns, in file order.  `seri` is the series level and `model` the trim.
LISTING_COLUMNS = [
    "marka", "seri", "model", "baslik", "yil", "km", "fiyat", "il_ilce", "image_path",
]
KEY_COLUMNS = ["site", "page", "idx"]
IDENTITY_COLUMNS = [c for c in LISTING_COLUMNS if c != "image_path"]
HIERARCHY_COLUMNS = ["marka", "seri", "model", "image_path"]

LISTING_RAW = T.StructType([T.StructField(c, T.StringType()) for c in LISTING_COLUMNS])
KEYED_LISTING_RAW = T.StructType(
    [
        T.StructField("site", T.IntegerType()),
        T.StructField("page", T.LongType()),
        T.StructField("idx", T.LongType()),
        *LISTING_RAW.fields,
    ]
)
LISTING_CLEAN = T.StructType(
    [
        T.StructField("marka", T.StringType()),
        T.StructField("seri", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("baslik", T.StringType()),
        T.StructField("yil", T.IntegerType()),
        T.StructField("km", T.DoubleType()),
        T.StructField("fiyat", T.DoubleType()),
        T.StructField("il_ilce", T.StringType()),
        T.StructField("image_path", T.StringType()),
    ]
)
LISTING_PAGE = T.StructType(
    [
        T.StructField("site", T.IntegerType()),
        T.StructField("page", T.LongType()),
        T.StructField("html", T.StringType()),
    ]
)

# The tokens a default pandas CSV read takes as missing.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Brands written with more than one word.
MULTI_WORD_BRANDS = ["Alfa Romeo", "Aston Martin", "DS Automobiles", "Mercedes - Benz"]

# Cleaning, image and model constants.
MIN_BRAND_ROWS = 5
PROCESSED_IMAGE_DIR = "data/processed_images"
RAW_IMAGE_DIR = "data/images"
VEHICLE_CLASSES = [2, 3, 5, 7]
IMAGE_BOX = (240, 180)
CHANNEL_MEAN = (0.485, 0.456, 0.406)
CHANNEL_STD = (0.229, 0.224, 0.225)
DECODE_TEMPERATURE = 0.1
LABEL_SMOOTHING = 0.1
LEVEL_WEIGHTS = {"brand": 1.0, "series": 0.5, "trim": 0.25}
CONFIDENCE_GATE = 0.5
PATIENCE = 5
BATCH_SIZE = 32
MIXUP_ALPHA = 0.2
SALIENCY_RULES = {"brand": (0.85, 0.0), "series": (0.80, 0.2), "trim": (0.75, 0.3)}

# Price rows kept for training (all bounds strict).
PRICE_BOUNDS = (10000, 5000000)
KM_BOUNDS = (0, 500000)
MIN_YEAR = 1990

# Markup that each page dialect is read by.
CELLS9_TABLE_ID = "searchResultsTable"
CELLS9_CELL_ORDER = [0, 1, 2, 3, 4, 5, 6, 8]
CELLS9_CELLS = 9
CELLS8_TABLE_CLASS = "listing-table"
CELLS8_MIN_CELLS = 8
CARD_PREFIX = "do-vehicle-card__"
CARD_PARTS = ["figure", "title", "summary", "specs-summary", "price", "footer-title"]
GRID_SECTION = ("product", "horizontal")
GRID_SLIDE, GRID_IMAGE, GRID_TITLE = "swiper-slide", "image", "advert"
GRID_PROPERTIES, GRID_PROPERTY = "propertyGrid", "propertyName"
GRID_DESCRIPTION, GRID_PRICE_BOX, GRID_PRICE = "description", "text-xs", "text-"

# Paging.
OFFSET_PARAMETER, SIZE_PARAMETER = "pagingOffset", "pagingSize"
OFFSET_STEP = 50
ROWS_PER_PAGE = 15
DEFAULT_PAGES = 50
