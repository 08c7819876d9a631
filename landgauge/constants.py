"""Fixed values of the trade domain."""

# Trade columns in payload order.
TRADE_COLUMNS = [
    "sggCd", "umdNm", "jibun", "mhouseNm", "buildYear",
    "houseType", "excluUseAr", "landAr", "floor",
    "dealYear", "dealMonth", "dealDay", "dealAmount",
    "buyerGbn", "slerGbn", "dealingGbn", "estateAgentSggNm",
    "cdealType", "cdealDay", "rgstDate",
]

# Official province name -> short name used by the land-price index.
PROVINCE_SHORT_NAMES = {
    "서울특별시": "서울",
    "부산광역시": "부산",
    "대구광역시": "대구",
    "인천광역시": "인천",
    "광주광역시": "광주",
    "대전광역시": "대전",
    "울산광역시": "울산",
    "세종특별자치시": "세종",
    "경기도": "경기",
    "강원특별자치도": "강원",
    "강원도": "강원",
    "충청북도": "충북",
    "충청남도": "충남",
    "전라북도": "전북",
    "전북특별자치도": "전북",
    "전라남도": "전남",
    "경상북도": "경북",
    "경상남도": "경남",
    "제주특별자치도": "제주",
    "제주도": "제주",
}

# Labels found in the trade data.
CANCELLED = "O"
DIRECT_DEAL = "직거래"
MIXED_HOUSE_TYPE = "연립다세대"
ROW_HOUSE = "연립"
UNNAMED_COMPLEX = "미명명 단지"
SINGLE_REGION_LABEL = "세종특별자치시"

# Price bounds in 10,000 KRW, distance limits in metres.
PRICE_LOWER = 3_900
PRICE_UPPER = 82_000
SUBWAY_CAP_M = 1_500
SUBWAY_AREA_M = 500
EARTH_RADIUS_M = 6_371_000.0
ELEVATOR_YEAR = 2015
HIGH_FLOOR = 4

# Building facts used when a register has no answer.
BUILDING_DEFAULTS = {
    "parking_ratio": 0.8,
    "has_elevator": 0,
    "building_structure": 1,
    "is_commercial_villa": 0,
    "total_floors": 4,
}
DEFAULT_APPROVAL_DATE = "20100101"

# Lookup keys and result columns.
GEO_KEYS = ["sido", "region", "umdNm", "jibun"]
GEO_COLUMNS = ["lat", "lng", "subway_name", "subway_dist"]
BUILDING_KEYS = ["sggCd", "umdNm", "jibun"]
BUILDING_COLUMNS = [*BUILDING_DEFAULTS, "approval_date"]
INDEX_KEYS = ["sido", "land_region"]

# Model inputs.
BASE_FEATURES = [
    "excluUseAr", "landAr", "floor", "Age", "land_index",
    "parking_ratio", "has_elevator", "total_floors", "subway_dist",
    "houseType_연립", "umdNm_encoded",
]
ADVANCED_FEATURES = [*BASE_FEATURES, "is_high_floor_without_elevator", "area_ratio"]
TARGET = "Price_per_m2_log"
LABEL_COLUMNS = ["sido", "region", "umdNm", "houseType"]
SCALED_COLUMNS = ["excluUseAr", "landAr", "parking_ratio", "subway_dist", "total_floors"]
COMPLETENESS_COLUMNS = [
    "parking_ratio", "has_elevator", "total_floors",
    "umdNm_encoded", "Price_per_m2_log", "adjusted_price_per_m2",
]

# Profile columns by kind.
NUMERIC_COLUMNS = [
    "excluUseAr", "landAr", "floor", "dealAmount", "Age",
    "land_index", "current_land_index", "total_floors",
    "lat", "lng", "subway_dist",
]
TEXT_COLUMNS = [
    "sggCd", "umdNm", "jibun", "mhouseNm", "houseType",
    "subway_name", "building_structure", "has_elevator", "is_commercial_villa",
]
COUNT_COLUMNS = ["dealYear", "dealMonth", "dealDay"]
DATE_COLUMNS = ["approval_date"]
ZERO_CHECK_COLUMNS = ["excluUseAr", "landAr", "dealAmount", "total_floors"]
