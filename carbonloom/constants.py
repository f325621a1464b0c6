"""Thresholds, labels and code lists that results must reproduce exactly.

Every operator takes them as a parameter with the value here as its default.
"""

# --- years -----------------------------------------------------------------
FIRST_YEAR = 1970
LAST_YEAR = 2050
MILESTONE_YEARS = (2030, 2050)
REFORM_YEAR = 1986

# Upper year (inclusive) of each plan phase, in time order, and the label after the last.
PLAN_PHASES = (
    (1975, "Giai đoạn trước 1976"),
    (1980, "Kế hoạch 5 năm lần II (1976-1980)"),
    (1985, "Kế hoạch 5 năm lần III (1981-1985)"),
    (1990, "Kế hoạch 5 năm lần IV - Đổi mới (1986-1990)"),
    (1995, "Kế hoạch 5 năm 1991-1995"),
    (2000, "Kế hoạch 5 năm 1996-2000"),
    (2005, "Kế hoạch 5 năm 2001-2005"),
    (2010, "Kế hoạch 5 năm 2006-2010"),
    (2015, "Kế hoạch 5 năm 2011-2015"),
    (2020, "Kế hoạch 5 năm 2016-2020"),
    (2025, "Kế hoạch 5 năm 2021-2025"),
    (2030, "Kế hoạch 5 năm 2026-2030 (NDC Milestone)"),
    (2035, "Kế hoạch 5 năm 2031-2035"),
    (2040, "Kế hoạch 5 năm 2036-2040"),
    (2045, "Kế hoạch 5 năm 2041-2045"),
)
PLAN_PHASE_AFTER = "Kế hoạch 5 năm 2046-2050 (Net-Zero Target)"

POLICY_PERIODS = (
    (1985, "Trước Đổi Mới (Trước 1986)"),
    (2020, "Thời kỳ Đổi Mới & Công nghiệp hóa"),
    (2030, "Thập kỷ Hành động NDC 2030"),
)
POLICY_PERIOD_AFTER = "Lộ trình Chuyển dịch Net-Zero 2050"

# --- hours -----------------------------------------------------------------
# Buckets and rush hours disagree on purpose (06-09 against 7, 8, 9): two independent columns.
TIME_BUCKETS = (
    (5, "Ban Đêm (00:00 - 05:00)"),
    (9, "Giờ Cao Điểm Sáng (06:00 - 09:00)"),
    (15, "Giờ Bình Thường Ban Ngày (10:00 - 15:00)"),
    (19, "Giờ Cao Điểm Chiều (16:00 - 19:00)"),
)
TIME_BUCKET_AFTER = "Buổi Tối (20:00 - 23:00)"
RUSH_HOURS = (7, 8, 9, 17, 18, 19)
RUSH_LABELS = ("Giờ Cao Điểm", "Giờ Bình Thường")

# --- provinces -------------------------------------------------------------
HUB_LABELS = ("Cực tăng trưởng công nghiệp", "Khu vực thông thường")
MACRO_REGIONS = {
    "Đồng bằng sông Hồng": "Miền Bắc",
    "Trung du và miền núi phía Bắc": "Miền Bắc",
    "Bắc Trung Bộ và Duyên hải miền Trung": "Miền Trung",
    "Tây Nguyên": "Miền Trung",
    "Đông Nam Bộ": "Miền Nam",
    "Đồng bằng sông Cửu Long": "Miền Nam",
}
MACRO_REGION_OTHER = "Khác"
NAME_ALIASES = {"condao": "bariavungtau", "hanoit": "hanoi", "thienthienhue": "thuathienhue"}

# --- sectors ---------------------------------------------------------------
TOTAL_SECTOR = "TOT"
DEFAULT_SCOPE = "Scope 1 & 2"
SECTOR_SEED = (
    ("AGR", "Agriculture", "Nông nghiệp & Trồng lúa nước", "Agriculture", "Scope 1"),
    ("BLD", "Building", "Tòa nhà & Dân dụng", "Building", "Scope 1/2"),
    ("ELE", "Electricity/Heat", "Sản xuất Điện & Nhiệt", "Energy", "Scope 1"),
    ("ENG", "Energy", "Năng lượng & Khai khoáng", "Energy", "Scope 1"),
    ("IND", "Manufacturing/Construction", "Công nghiệp Chế biến & Xây dựng", "Industry", "Scope 1/2"),
    ("TRA", "Transportation", "Giao thông Vận tải", "Transportation", "Scope 1"),
    ("WAS", "Waste", "Chất thải & Xử lý nước thải", "Waste", "Scope 1"),
    ("OTH", "Other Fuel Combustion", "Sử dụng Nhiên liệu khác", "Other", "Scope 1"),
    ("TOT", "Total National Emissions", "Tổng phát thải toàn quốc", "National Total", "Scope 1/2/3"),
)
# raw sector name -> code, Vietnamese name, category
SECTOR_MAP = {
    "Energy": ("ENG", "Năng lượng & Khai khoáng", "Energy"),
    "Electricity/Heat": ("ELE", "Sản xuất Điện & Nhiệt", "Energy"),
    "Manufacturing/Construction": ("IND", "Công nghiệp Chế biến & Xây dựng", "Industry"),
    "Industrial Processes": ("IPU", "Quá trình Công nghiệp (Xi măng, Thép)", "Industry"),
    "Agriculture": ("AGR", "Nông nghiệp & Trồng lúa nước", "Agriculture"),
    "Transportation": ("TRA", "Giao thông Vận tải", "Transport"),
    "Waste": ("WST", "Xử lý Chất thải & Nước thải", "Waste"),
    "Building": ("BLD", "Tòa nhà & Dân dụng", "Building"),
    "Total excluding LULUCF": ("TOT", "Tổng phát thải quốc gia (trừ LULUCF)", "Total"),
}
UNMAPPED_SECTOR = ("OTH", "Other")
GASES = ("All GHG", "CO2")
ALL_GASES = "All GHG"

# --- national indicators ---------------------------------------------------
INDICATORS = {
    "EN.GHG.ALL.MT.CE.AR5": "Total_GHG_MtCO2e",
    "EN.GHG.CO2.MT.CE.AR5": "CO2_MtCO2e",
    "EN.GHG.CH4.MT.CE.AR5": "Methane_MtCO2e",
    "EN.GHG.CO2.PC.CE.AR5": "CO2_Per_Capita_Tonnes",
    "EG.FEC.RNEW.ZS": "Renewable_Energy_Pct",
    "NY.GDP.MKTP.CD": "GDP_USD",
}

# --- decoupling ------------------------------------------------------------
TAPIO_LABELS = (
    "Tách rời mạnh (Strong Decoupling)",
    "Tách rời yếu (Weak Decoupling)",
    "Mở rộng đồng tốc (Expansive Coupling)",
    "Tăng trưởng thâm dụng carbon (Negative Decoupling)",
)
TAPIO_WEAK, TAPIO_COUPLED = 0.8, 1.2
GREEN_LABELS = (
    "Kinh tế Tăng trưởng Xanh (Decoupled)",
    "Tăng trưởng trung gian",
    "Thâm dụng Carbon cao (Risk Area)",
)
GREEN_HIGH, GREEN_MIDDLE = 100, 70
STATUS_LABELS = (
    "No Data",
    "Strong Decoupling",
    "Weak Decoupling",
    "Coupling",
    "Negative Decoupling (Carbon Intensive)",
)
STATUS_COLORS = ("#9CA3AF", "#10B981", "#F59E0B", "#EF4444")
QUADRANTS = (
    "Góc I: Tiên phong Xanh (Kinh tế cao, Phát thải thấp)",
    "Góc II: Cần Chuyển dịch (Kinh tế cao, Phát thải cao)",
    "Góc III: Rủi ro cao (Kinh tế thấp, Phát thải cao)",
    "Góc IV: Đang phát triển (Kinh tế thấp, Phát thải thấp)",
)

# --- air -------------------------------------------------------------------
AQI_CATEGORIES = ((50, "Tốt"), (100, "Trung bình"), (150, "Kém"), (200, "Xấu"))
AQI_CATEGORY_AFTER = "Rất xấu"
AQI_COLORS = (
    (50, "#10B981"),
    (100, "#F59E0B"),
    (150, "#F97316"),
    (200, "#EF4444"),
    (300, "#8B5CF6"),
)
AQI_COLOR_AFTER, AQI_COLOR_NONE = "#7F1D1D", "#9CA3AF"
AQI_PM25, AQI_NO2, AQI_LOW, AQI_HIGH = 2.2, 0.4, 15, 320
PM25_LIMIT = 50
LIMIT_LABELS = ("Vượt chuẩn QCVN 05:2023", "Đạt chuẩn an toàn")

# --- targets ---------------------------------------------------------------
BASELINE_YEAR = 2020
TARGET_CUT = 0.435
CAGR_YEARS = 5

# --- allocation ------------------------------------------------------------
NATIONAL_GRDP = {
    2015: 4192862, 2016: 4502733, 2017: 5005975, 2018: 5542832, 2019: 6037348,
    2020: 6293145, 2021: 8479600, 2022: 9513300, 2023: 10221800, 2024: 10980000,
}
NATIONAL_GHG = {
    2015: 350.2, 2016: 375.4, 2017: 395.1, 2018: 432.5, 2019: 470.8,
    2020: 492.9, 2021: 486.8, 2022: 494.5, 2023: 542.9, 2024: 584.3,
}
NATIONAL_GRDP_MISSING, NATIONAL_GHG_MISSING = 10000000, 500.0
HUB_WEIGHT, OTHER_WEIGHT = 1.6, 0.75
BASE_POPULATION_THOUSANDS = {
    "01": 8400, "79": 9300, "31": 2080, "74": 2600, "75": 3200, "27": 1450,
    "22": 1350, "48": 1190, "77": 1170, "38": 3700, "40": 3400, "24": 1880,
}
POPULATION_GROWTH, POPULATION_BASE_YEAR = 0.011, 2015
POPULATION_PER_KM2, POPULATION_FLOOR = 0.25, 800

# --- report texts ----------------------------------------------------------
NO_SELECTION = "National Overview (63 Provinces)"
CARD_TITLE = "Green Economy & Carbon Emission Report: "
GAP_NONE = "No comparison data for 2030 target"
GAP_WITHIN = ("Within NDC 2030 Target Safety Limit (Surplus: ", " MtCO2e)")
GAP_OVER = ("Exceeding NDC 2030 Emission Quota (+ ", " MtCO2e)")
NARRATIVE_TITLE = "📌 DETAILED PROVINCIAL ANALYSIS: "
NARRATIVE_ECONOMY = (
    "• Economic Scale: GRDP reached ",
    " Billion VND; Total GHG Emissions: ",
    " Million Tonnes CO2e.",
)
NARRATIVE_INDEX = ("• Tapio Decoupling Index: ", " pts — Classification: ", ".")
NARRATIVE_QUOTA = (
    "• 2030 Quota Realization: Currently at ",
    " of allocated Net-Zero 2030 target quota.",
)
NARRATIVE_AIR = (
    "• Micro Big Data Air Monitoring 2024: Recorded ",
    " hours exceeding QCVN 05:2023 safety thresholds.",
)
NARRATIVE_ADVICE = (
    "💡 STRATEGIC GREEN TRANSITION RECOMMENDATIONS:",
    "1. Industrial Emission Cap: Enforce stricter carbon quotas across concentrated industrial parks during peak hours.",
    "2. Clean Energy Transition: Accelerate DPPA mechanism for rooftop solar and wind energy adoption.",
    "3. Ecological Carbon Sinks: Expand conservation forestry to monetize provincial forest carbon offsets.",
)

# --- quality gate ----------------------------------------------------------
MAX_NULL_PCT = 5.0
MIN_COMMON_YEARS = 5
REQUIRED_YEARS = (2015, 2023)
PROVINCE_COUNT = 63
# Limits of a map's bounding box: min lon, min lat, max lon, max lat.
MAP_LIMITS = ((100.0, 104.0), (8.0, 10.0), (108.0, 120.0), (22.0, 25.0))
MAP_LAYERS = ("vietnam_provinces", "provinces", "tracts")
MAP_KB = (50, 1500)
