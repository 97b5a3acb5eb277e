"""Fixed values of the listing domain: labels, word lists, codes, thresholds."""

# Property categories.
APARTMENT = "Căn hộ/Chung cư"
HOUSE = "Nhà ở"
LAND = "Đất"
OFFICE = "Văn phòng, Mặt bằng kinh doanh"
LAND_CATEGORIES = [LAND, OFFICE]
APARTMENT_CATEGORIES = [APARTMENT]
HOUSE_CATEGORIES = [HOUSE]

# Furnishing states that count as furnished.
FURNISHED = ["Nội thất cao cấp", "Nội thất đầy đủ"]

# Words of the property description.
GOOD_TRAITS = ["Hẻm xe hơi", "Nhà nở hậu", "Nở hậu", "Mặt tiền", "Thổ cư toàn bộ"]
RISK_TRAITS = [
    "Đất chưa chuyển thổ",
    "Nhà chưa hoàn công",
    "Nhà dính quy hoạch / lộ giới",
    "Chưa có thổ cư",
    "Không có thổ cư",
    "Thổ cư 1 phần",
]

# Legal documents by how safe they are.
FULLY_LEGAL = ["Đã có sổ", "Sổ hồng riêng"]
SEMI_LEGAL = ["Đang chờ sổ", "Sổ chung / Công chứng vi bằng", "Hợp đồng mua bán", "Hợp đồng đặt cọc"]
RISK_LEGAL = ["Không có sổ", "Giấy tờ viết tay", "Giấy tờ khác", "1"]

# The district suffix that ward names carried before the merger.
OLD_DISTRICT_SUFFIX = r"\s*\(Quận.*?cũ\)"

# JSON paths of the four listing parameters.
PARAM_PATHS = {
    "param_furnishing_sell": "$.ad_params.furnishing_sell.value",
    "param_property_legal_document": "$.ad_params.property_legal_document.value",
    "param_price_m2": "$.ad_params.price_m2.value",
    "param_pty_characteristics": "$.ad_params.pty_characteristics.value",
}

# Search keywords and the column each one gets.
KEYWORDS = {
    "bất động sản": "bat_dong_san",
    "mua nhà": "mua_nha",
    "căn hộ": "can_ho",
    "chung cư": "chung_cu",
    "đất nền": "dat_nen",
}

# Spellings of the keyword columns in older extracts.
LEGACY_KEYWORD_COLUMNS = {
    "batongsan": "bat_dong_san",
    "muanha": "mua_nha",
    "canho": "can_ho",
    "chungcu": "chung_cu",
    "datnen": "dat_nen",
    "batongsantphcm": "bat_dong_san",
    "bat_dong_san_tp_hcm": "bat_dong_san",
    "chungcutphcm": "chung_cu",
    "chung_cu_tp_hcm": "chung_cu",
    "canhotphcm": "can_ho",
    "can_ho_tp_hcm": "can_ho",
    "muanhatphcm": "mua_nha",
    "mua_nha_tp_hcm": "mua_nha",
    "atnentphcm": "dat_nen",
    "dat_nen_tp_hcm": "dat_nen",
}

# The search category dimension.
SEARCH_CATEGORIES = [
    (1, APARTMENT, "Căn hộ, Chung cư"),
    (2, HOUSE, "Nhà, Nhà ở, Nhà riêng"),
    (3, LAND, "Đất, Đất nền"),
    (4, "Bất động sản", "Tất cả loại hình"),
]

# Labels in reports.
TYPE_APARTMENT, TYPE_HOUSE, TYPE_LAND, TYPE_UNKNOWN, TYPE_OTHER = (
    "Can ho / Chung cu",
    "Nha o",
    "Dat",
    "Khong xac dinh",
    "Khac",
)
METRO_NEAR, METRO_NOT_NEAR, METRO_OTHER = "Gan metro", "Khong gan metro", "Khac"
TREND_UNCLEAR = "Khong ro xu huong"
TRENDS = {
    (1, 1): "Cung tang - Gia tang",
    (1, -1): "Cung tang - Gia giam",
    (-1, 1): "Cung giam - Gia tang",
    (-1, -1): "Cung giam - Gia giam",
}

# Age bands in days and metro distance bands in metres.
AGE_EDGES, AGE_LABELS = (7, 30, 90), ("New (0-7d)", "Active (8-30d)", "Aging (31-90d)", "Old (90d+)")
METRO_EDGES, METRO_LABELS = (500, 1500), ("Near_Metro", "Close_To_Metro", "Far_From_Metro")
NO_METRO = "No_Metro_In_Ward"

# Score steps (threshold, score) of the hotspot report.
VOLUME_STEPS = [(30, 1.0), (15, 0.8), (8, 0.6), (3, 0.4)]
LISTING_GROWTH_STEPS = [(0.5, 1.0), (0.3, 0.8), (0.1, 0.6)]
PRICE_GROWTH_STEPS = [(0.3, 1.0), (0.15, 0.8), (0.05, 0.6)]
SELLER_STEPS = [(15, 1.0), (8, 0.8), (4, 0.6), (2, 0.4)]
QUALITY_STEPS = [(80, 1.0), (60, 0.8), (40, 0.6)]
POSITIVE_SCORE = 0.4
HOTSPOT_WEIGHTS = {
    "listing_volume_score": 0.25,
    "listing_growth_score": 0.25,
    "price_growth_score": 0.20,
    "seller_score": 0.20,
    "quality_score_norm": 0.10,
}

# Range of the calendar dimension.
CALENDAR_START, CALENDAR_END = "2024-01-01", "2027-12-31"
