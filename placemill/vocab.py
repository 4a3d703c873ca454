"""Fixed values of the food-shop domain: categories, chains, tags, labels, reference counts.

Every table below holds values that results depend on; operators take them as parameters.
"""

from __future__ import annotations

# --- fixed values: extraction window and categories -------------------------------------------
BBOX = (122.5, 24.0, 154.0, 45.8)  # lon min, lat min, lon max, lat max
FOOD_CATEGORIES = (
    "convenience_store", "pharmacy", "grocery_store", "supermarket", "discount_store",
    "drugstore", "butcher_shop", "farmers_market", "department_store", "seafood_market",
)
NON_FOOD_CATEGORIES = ("pharmacy", "discount_store", "department_store")
HOME_COUNTRY = "JP"
UMBRELLA_DATASET = "Overture"

# --- fixed values: chains, in match order, and the provider kept for each ----------------------
CHAIN_PATTERNS = (
    ("セブンイレブン", ("%セブン%イレブン%",)),
    ("ローソン", ("%ローソン%",)),
    ("ファミリーマート", ("%ファミリーマート%", "%ファミマ%")),
    ("ミニストップ", ("%ミニストップ%",)),
    ("デイリーヤマザキ", ("%デイリーヤマザキ%",)),
)
OTHER_CHAIN = "その他"
BRANCH_SUFFIX = "%店"
CHAIN_PROVIDER = (
    ("セブンイレブン", "Foursquare"),
    ("ローソン", "AllThePlaces"),
    ("ファミリーマート", "AllThePlaces"),
    ("ミニストップ", "meta"),
    ("デイリーヤマザキ", "AllThePlaces"),
)

# --- fixed values: grocery clean-up ------------------------------------------------------------
NOISE_TAGS = (
    "restaurant", "cafe", "bar", "eat_and_drink", "japanese_restaurant", "smoothie_juice_bar",
    "food_beverage_service_distribution", "home_goods_store", "shopping",
)
FOOD_TAGS = (
    "supermarket", "grocery_store", "health_food_store", "bakery", "liquor_store", "delicatessen",
    "specialty_grocery_store", "fishmonger", "fruits_and_vegetables", "butcher",
    "convenience_store", "farm",
)
NOISE_NAME_PATTERNS = (
    "%カフェ%", "%coffee%", "%cafe%", "%食堂%", "%ZAKKA%", "%雑貨%", "%セレクトショップ%", "%レストラン%",
)

# --- fixed values: distances -------------------------------------------------------------------
DUPLICATE_DEGREES = 0.0011
DUPLICATE_METRES = 50.0
METRES_PER_DEGREE_LON = 111320.0
METRES_PER_DEGREE_LAT = 110540.0

# --- fixed values: map-community tags and the buckets used in comparisons ----------------------
FRESH_PLACE_CATEGORIES = ("butcher_shop", "seafood_market")
FRESH_SHOP_TAGS = ("greengrocer", "butcher", "seafood")
BUCKETS = (
    ("super", "スーパー"),
    ("conv", "コンビニ"),
    ("drug", "ドラッグストア"),
    ("grocery", "食料品店"),
    ("fresh", "生鮮専門店・直売所"),
)
CATEGORY_BUCKET = (
    ("supermarket", "super"),
    ("convenience_store", "conv"),
    ("drugstore", "drug"),
    ("grocery_store", "grocery"),
)
SHOP_BUCKET = (
    ("super", ("supermarket",)),
    ("conv", ("convenience",)),
    ("drug", ("chemist", "drugstore", "drug store", "drugs", "dragstore", "cosmetics")),
    ("grocery", ("grocery", "food", "general", "deli", "confectionery")),
    ("fresh", ("greengrocer", "seafood", "butcher", "farm")),
)
FRESH_AMENITY = "marketplace"
MASTER_LABELS = (
    ("supermarket", "食品スーパー・各種食料品 (supermarket)"),
    ("convenience", "コンビニ (convenience)"),
    ("drugstore", "ドラッグストア (drugstore)"),
    ("fresh_food", "生鮮専門店 (fresh_food)"),
)
OTHER_LABEL = "その他/未分類"
NO_NAME = "(名称なし)"

# --- fixed values: official store counts the coverage report divides by ------------------------
OFFICIAL_COUNTS = (("conv", 56352), ("super", 23078), ("drug", 17622))

# --- fixed values: license register ------------------------------------------------------------
REGISTER_COLUMNS = (
    "prefecture", "city", "city_raw", "name", "name_kana", "business_type", "address", "lat", "lng",
    "geocoding_level", "phone", "license_no", "license_date", "expire_date", "sources", "licenses",
)
ERA_BASE = (
    ("M", 1867), ("T", 1911), ("S", 1925), ("H", 1988), ("R", 2018),
    ("明治", 1867), ("大正", 1911), ("昭和", 1925), ("平成", 1988), ("令和", 2018),
)
BLANK_DATE_WORDS = ("nan", "none", "-", "—")
EXCEL_EPOCH = "1899-12-30"
EXCEL_SERIAL_RANGE = (20000, 60000)
