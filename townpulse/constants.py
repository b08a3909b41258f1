"""Values that results depend on: word lists, lookup tables, formats, thresholds."""

# --- fixed values -----------------------------------------------------------
# Complaint cleaning
BANGKOK_PATTERN = r"(?i)กรุงเทพ|Bangkok"
NO_COMMENT = "ไม่มีคำอธิบาย"
NO_ORGANIZATION = "ไม่ระบุหน่วยงาน"
NO_TYPE = "ไม่ระบุ"
EMPTY_FILL = "Not define"
UNKNOWN_TYPE = "Unknown"

# Keyword flags on the complaint type
FLOOD_PATTERN = "น้ำท่วม"
TRAFFIC_PATTERN = "จราจร|ถนน"
WASTE_PATTERN = "ความสะอาด|ขยะ"

# Serving-time defaults of the anomaly features
DEFAULT_LAT = 13.7563
DEFAULT_LON = 100.5018
DEFAULT_HOUR = 0
DEFAULT_DAY_OF_WEEK = 0
DEFAULT_MONTH = 1

COMPLETED_STATE = "เสร็จสิ้น"
WEEKDAY_NAMES_TH = ["จันทร์", "อังคาร", "พุธ", "พฤหัสบดี", "ศุกร์", "เสาร์", "อาทิตย์"]

# Outage cleaning: columns that may be neither null nor 'unknown'
OUTAGE_REQUIRED = [
    "date", "day_of_week", "start", "end", "name", "location",
    "district", "province", "temp", "rain", "wind_gust",
]
OUTAGE_COLUMNS = [
    "date", "day_of_week", "start", "end", "name", "district",
    "province", "temp", "rain", "wind_gust", "time_range", "duration_minutes",
]

# Notice text
STOP_PHRASES = [
    "We sincerely apologize",
    "In case of any inquiries",
    "In the meantime you can also check",
    "Metropolitan Electricity Authority",
]
MONTH_PREFIXES = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
NOTICE_SOURCE = "MEA"
NOTICE_SITE = "https://www.mea.or.th"
NEWS_PATH = "/news/"

# Place name found in a location text -> district; earlier entries win
AREA_TO_DISTRICT = {
    # roads, English
    "Sukhumvit": "วัฒนา",
    "Rama 9": "ห้วยขวาง",
    "Rama IX": "ห้วยขวาง",
    "Phetchaburi": "ราชเทวี",
    "Petchaburi": "ราชเทวี",
    "Lat Phrao": "ลาดพร้าว",
    "Latphrao": "ลาดพร้าว",
    "Ramkhamhaeng": "บางกะปิ",
    "Ram Khamhaeng": "บางกะปิ",
    "Ratchada": "ดินแดง",
    "Ratchadaphisek": "ดินแดง",
    "Vibhavadi": "จตุจักร",
    "Viphavadi": "จตุจักร",
    "Sathorn": "สาทร",
    "Sathon": "สาทร",
    "Silom": "บางรัก",
    "Nawamin": "บึงกุ่ม",
    # roads, Thai
    "สุขุมวิท": "วัฒนา",
    "พระราม 9": "ห้วยขวาง",
    "เพชรบุรี": "ราชเทวี",
    "ลาดพร้าว": "ลาดพร้าว",
    "รามคำแหง": "บางกะปิ",
    "รัชดา": "ดินแดง",
    "วิภาวดี": "จตุจักร",
    "สาทร": "สาทร",
    "สีลม": "บางรัก",
    # areas, English
    "Siam": "ปทุมวัน",
    "Chidlom": "ปทุมวัน",
    "Asoke": "วัฒนา",
    "Ekkamai": "วัฒนา",
    "Thong Lo": "วัฒนา",
    "Thonglor": "วัฒนา",
    "Ari": "พญาไท",
    "Huai Khwang": "ห้วยขวาง",
    "On Nut": "ประเวศ",
    "Onnut": "ประเวศ",
    "Bang Na": "ประเวศ",
    "Bangna": "ประเวศ",
    "Lat Krabang": "ลาดกระบัง",
    # areas, Thai
    "สยาม": "ปทุมวัน",
    "ชิดลม": "ปทุมวัน",
    "อโศก": "วัฒนา",
    "เอกมัย": "วัฒนา",
    "ทองหล่อ": "วัฒนา",
    "อารีย์": "พญาไท",
    "ห้วยขวาง": "ห้วยขวาง",
    "รัชดาภิเษก": "ดินแดง",
    "อ่อนนุช": "ประเวศ",
    "บางนา": "ประเวศ",
    "ลาดกระบัง": "ลาดกระบัง",
    # districts, English
    "Pathumwan": "ปทุมวัน",
    "Bang Kapi": "บางกะปิ",
    "Din Daeng": "ดินแดง",
    "Vadhana": "วัฒนา",
    "Watthana": "วัฒนา",
    "Khlong Toei": "คลองเตย",
    "Klong Toei": "คลองเตย",
    "Don Mueang": "ดอนเมือง",
    "Bang Khen": "บางเขน",
    "Prawet": "ประเวศ",
    "Saphan Sung": "สะพานสูง",
    # subdistricts, Thai
    "คลองเตย": "คลองเตย",
    "ปทุมวัน": "ปทุมวัน",
    "บางกะปิ": "บางกะปิ",
}

# District -> (latitude, longitude) of its centre; earlier entries win on partial matches
DISTRICT_COORDS = {
    "ปทุมวัน": (13.75, 100.53),
    "บางกะปิ": (13.76, 100.64),
    "ดินแดง": (13.76, 100.54),
    "ห้วยขวาง": (13.78, 100.57),
    "วัฒนา": (13.73, 100.56),
    "คลองเตย": (13.72, 100.58),
    "ดอนเมือง": (13.91, 100.61),
    "บางเขน": (13.85, 100.60),
    "ประเวศ": (13.70, 100.66),
    "สะพานสูง": (13.80, 100.65),
    "บางพลัด": (13.79, 100.49),
    "บางกอกน้อย": (13.76, 100.48),
    "บางกอกใหญ่": (13.73, 100.50),
    "ธนบุรี": (13.73, 100.49),
    "ราชเทวี": (13.75, 100.54),
    "พญาไท": (13.78, 100.54),
    "จตุจักร": (13.81, 100.56),
    "ลาดพร้าว": (13.82, 100.60),
    "วังทองหลาง": (13.78, 100.59),
    "บึงกุ่ม": (13.81, 100.64),
    "สาทร": (13.72, 100.53),
    "บางรัก": (13.73, 100.52),
    "ยานนาวา": (13.69, 100.53),
    "ราษฎร์บูรณะ": (13.66, 100.51),
    "ทุ่งครุ": (13.62, 100.50),
    "ลาดกระบัง": (13.73, 100.78),
    "เมืองนนทบุรี": (13.86, 100.52),
    "เมืองปทุมธานี": (14.02, 100.53),
    "เมืองสมุทรปราการ": (13.60, 100.60),
    "default": (13.75, 100.50),
}

# Forecasting
LOOKBACK_DAYS = 30
FORECAST_HORIZON = 7
SERIES_FEATURES = [
    "complaint_count", "dayofweek", "month", "is_weekend",
    "roll_mean_7", "roll_std_7", "roll_mean_30",
]
BAND_LOW, BAND_HIGH = 0.85, 1.15

# Anomaly detection
ANOMALY_FEATURES = [
    "hour", "day_of_week", "month", "complaint_count", "lat", "lon",
    "solve_days", "is_flood", "is_traffic", "is_waste", "district_daily_count",
]
# --- end of fixed values ------------------------------------------------------
