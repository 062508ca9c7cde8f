"""Fixed values of the listing domain.

These labels, bounds and names must equal the values the original pipeline
emits, otherwise tier, segment and category columns would not match.  They are
stated once here, in their natural order, and used everywhere else.
"""

# ---- fixed values (must match the original pipeline) --------------------------------

# Price tiers in billions VND; lower bound inclusive, listed cheapest first.
PRICE_TIER_BOUNDS = [2, 5, 10, 20]
PRICE_TIER_LABELS = ["Dưới 2 tỷ", "2-5 tỷ", "5-10 tỷ", "10-20 tỷ", "Trên 20 tỷ"]

# Area tiers in square metres; lower bound inclusive, smallest first.
AREA_TIER_BOUNDS = [40, 80, 150, 300]
AREA_TIER_LABELS = ["Dưới 40m²", "40-80m²", "80-150m²", "150-300m²", "Trên 300m²"]

# K-Means market segments, cheapest cluster first.
SEGMENT_NAMES = ["Bình dân", "Tầm trung", "Khá", "Cao cấp", "Siêu cao cấp"]

# Listing category slug -> property type, and the type used for unknown slugs.
CATEGORY_TYPES = {
    "ban-nha-tp-hcm": "Nhà phố/Vila",
    "ban-can-ho-chung-cu": "Căn hộ chung cư",
    "ban-dat-tp-hcm": "Đất nền",
    "ban-biet-thu-lien-ke": "Biệt thự/liền kề",
    "ban-nha-rieng": "Nhà riêng",
}
DEFAULT_PROPERTY_TYPE = "Bất động sản"

# Price text units: billions and millions.
UNIT_BILLION = "tỷ"
UNIT_MILLION = "triệu"

# Dashboard facet value meaning "no filter".
ALL_FACET = "Tất cả"

# Outlier window on price_billion, both ends inclusive.
PRICE_MIN = 0.1
PRICE_MAX = 500.0

# Regression metric names, in output order.
METRIC_NAMES = ["R²", "RMSE (tỷ)", "MAE (tỷ)", "Train rows", "Test rows"]

# Regression feature names as published in the coefficient table.
COEF_FEATURES = ["area_m2", "bedrooms", "bathrooms", "floors", "property_type_idx", "district_idx"]

# Display label of each regression feature.
FEATURE_LABELS = {
    "area_m2": "Diện tích (m²)",
    "bedrooms": "Số phòng ngủ",
    "bathrooms": "Số phòng tắm",
    "floors": "Số tầng",
    "property_type_idx": "Loại BĐS (index)",
    "district_idx": "Quận/Huyện (index)",
}

# Dashboard limits.
TOP_DISTRICTS = 15
LATEST_FEED_ROWS = 8
DETAIL_ROWS = 100
SAMPLE_ROWS = 500
PREDICTION_ROWS = 800
RECENT_FILES = 8
TITLE_MAX_CHARS = 60
EMPTY_TITLE = "Không có tiêu đề"
ELLIPSIS = "…"

# Data-quality null bands (percent of rows).
NULL_BAD_PCT = 30.0
NULL_WARN_PCT = 5.0

# Profiling: categories shown, histogram bins.
PROFILE_TOPK = 12
HISTOGRAM_BINS = 50

# ---- end of fixed values -------------------------------------------------------------
